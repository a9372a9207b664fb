"""The booster against a plain version on one array, on held-out rows, and through the model store."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from hazeline.operators import boosting as B
from hazeline.operators import models as M


def plain(x, y, w, cuts, many, rounds, rate, depth, l2, leaf, mass, doubled=False):
    """Scores of the rows after boosting, by loops over nodes, features and cuts."""
    bins = np.array([[B.BINS if np.isnan(v) else int((c < v).sum()) for v, c in zip(row, cuts)] for row in x])
    prior = np.array([w[y == k].sum() for k in range(many)]) / w.sum()
    scores = np.tile(np.log(np.maximum(prior, 1e-9)), (len(x), 1))
    for _ in range(rounds):
        p = np.exp(scores - scores.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        change = np.zeros_like(scores)
        for k in range(many):
            g, h = w * (p[:, k] - (y == k)), w * np.maximum(p[:, k] * (1 - p[:, k]) * (2 if doubled else 1), 1e-16)
            todo = [(np.arange(len(x)), 0)]
            while todo:
                rows, level = todo.pop()
                change[rows, k] = -g[rows].sum() / (h[rows].sum() + l2) * rate
                if level == depth or len(rows) < 2 * leaf or h[rows].sum() < 2 * mass:
                    continue
                best = (B._LEAST_GAIN, None)
                score = lambda r: g[r].sum() ** 2 / (h[r].sum() + l2)
                for f in range(x.shape[1]):
                    b = bins[rows, f]
                    for c in range(B.BINS - 1):
                        if not (b == c).any() and c:
                            continue
                        for side in (False, True):
                            go = np.where(b == B.BINS, side, b <= c)
                            left, right = rows[go], rows[~go]
                            if min(len(left), len(right)) < leaf or min(h[left].sum(), h[right].sum()) < mass:
                                continue
                            gain = score(left) + score(right) - score(rows)
                            if gain > best[0] + 1e-12:
                                best = (gain, (left, right))
                if best[1]:
                    todo += [(r, level + 1) for r in best[1]]
        scores += change
    return scores


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(300, 3)), 1)
    x[rng.random(x.shape) < 0.1] = np.nan
    y = np.where(np.nan_to_num(x[:, 0], nan=2.0) > 0.5, 2, np.where(np.nan_to_num(x[:, 1]) > 0, 1, 0))
    return x, y, np.round(rng.random(300) + 0.5, 2)


def frame(spark, rows, parts):
    x, y, w = rows
    return spark.createDataFrame([(a.tolist(), int(b), float(c)) for a, b, c in zip(x, y, w)], "v array<double>, y int, w double").repartition(parts)


@pytest.mark.parametrize("parts, block", [(1, 1000), (3, 40)])
def test_trees_of_the_plain_version(spark, rows, parts, block, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", block)
    monkeypatch.setattr(B, "KEEP", 2)
    df = frame(spark, rows, parts)
    options = dict(rounds=5, rate=0.3, depth=3, l2=0.5, leaf=5, mass=1e-3)
    model = B.BoostedTrees(featuresCol="v", labelCol="y", weightCol="w", **options).fit(df)
    x, y, w = rows
    want = plain(x, y, w, B.cut_points(df, "v", 3), 3, **options)
    want = np.exp(want) / np.exp(want).sum(1, keepdims=True)
    got = {(tuple(map(str, r["v"])), r["y"], r["w"]): r["probability"].toArray() for r in model.transform(df).collect()}
    for a, b, c, p in zip(x.tolist(), y.tolist(), w.tolist(), want):
        assert np.abs(got[tuple(map(str, a)), b, c] - p).max() < 1e-6


def test_held_out_rows_samples_and_store(spark, tmp_path):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(int) + 2 * (x[:, 2] > 0.7)
    df = spark.createDataFrame([(*map(float, a), float(b), i) for i, (a, b) in enumerate(zip(x, y))], "a double, b double, c double, d double, target double, id int")
    train, test = df.where("id < 2400"), df.where("id >= 2400")
    model = M.fit(M.boost_sampled(rounds=20, depth=4), train, ["a", "b", "c", "d"])
    out = model.transform(test)
    assert out.agg(F.avg((F.col("prediction") == F.col("target")).cast("double"))).first()[0] > 0.9
    again = M.fit(M.boost_sampled(rounds=20, depth=4), train, ["a", "b", "c", "d"]).transform(test)
    assert [r["prediction"] for r in again.orderBy("id").collect()] == [r["prediction"] for r in out.orderBy("id").collect()]
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m")).transform(test)
    assert [r["probability"] for r in loaded.orderBy("id").collect()] == [r["probability"] for r in out.orderBy("id").collect()]
    p = M.probabilities(out).first()
    assert abs(sum(p["probabilities"].values()) - 1) < 1e-9


def test_odd_tables(spark):
    one = spark.createDataFrame([([1.0, None], 1)] * 50, "features array<double>, label int")
    out = B.BoostedTrees(rounds=3).fit(one).transform(one).first()
    assert out["prediction"] == 1.0 and out["probability"].size == 2
    with pytest.raises(ValueError):
        B.BoostedTrees().fit(one.limit(0))
    unknown = spark.createDataFrame([(None,), ([float("nan"), 2.0],)], "features array<double>")
    got = B.BoostedTrees(rounds=3).fit(one).transform(unknown).collect()
    assert got[0]["prediction"] is None and got[1]["prediction"] == 1.0
