"""Ward clusters, Euclidean silhouettes, hashed neighbours, networks and copulas against plain NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline.operators import cluster as C
from hazeline.operators import hierarchy as H
from hazeline.operators import models as M
from hazeline.operators import near as N
from hazeline.operators import networks as W
from hazeline.plans import synthetic as Y


def frame(spark, x, *more, names=()):
    rows = [(i, [float(v) for v in r], *[m[i] for m in more]) for i, r in enumerate(x.tolist())]
    return spark.createDataFrame(rows, ", ".join(["id long", "vec array<double>", *names])).repartition(5)


def ward_by_hand(x, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        best = None
        for a in range(len(groups)):
            for b in range(a):
                p, q = x[groups[a]], x[groups[b]]
                rise = len(p) * len(q) / (len(p) + len(q)) * ((p.mean(0) - q.mean(0)) ** 2).sum()
                if best is None or rise < best[0]:
                    best = (rise, a, b)
        groups[best[2]] += groups.pop(best[1])
    return {frozenset(g) for g in groups}


@pytest.mark.parametrize("k", [1, 3, 7])
def test_ward_of_few_rows_is_exact(spark, k):
    x = np.random.default_rng(k).normal(size=(60, 3))
    x[50:] = x[:10]  # equal rows
    out = H.ward(frame(spark, x), k, "vec").transform(frame(spark, x)).collect()
    got = {}
    for r in out:
        got.setdefault(r["cluster"], set()).add(r["id"])
    assert {frozenset(g) for g in got.values()} == ward_by_hand(x, k)
    sizes = [len(got[c]) for c in sorted(got)]
    assert sizes == sorted(sizes, reverse=True)


def test_ward_of_many_rows_goes_through_features(spark):
    rng = np.random.default_rng(2)
    centre = np.array([[0, 0], [10, 0], [0, 10], [10, 10]])
    label = np.repeat(np.arange(4), [1500, 400, 300, 200])
    x = centre[label] + rng.normal(size=(len(label), 2))
    df = frame(spark, x, label.tolist(), names=["label int"])
    model = H.ward(df, 4, "vec", most=50)
    assert len(model.centres) <= 50
    pairs = model.transform(df).groupBy("cluster", "label").count().collect()
    assert len(pairs) == 4 and sum(r["count"] for r in pairs) == len(x)
    odd = spark.createDataFrame([(None,), ([float("nan"), 1.0],), ([0.0, 0.0],)], "vec array<double>")
    assert [r["cluster"] for r in model.transform(odd).collect()] == [None, None, 0]
    with pytest.raises(ValueError):
        H.ward(df.limit(0), 4, "vec")


def test_ward_with_partitions_without_rows(spark):
    df = frame(spark, np.array([[0.0, 0], [9, 0]]))
    assert df.rdd.getNumPartitions() == 5
    assert sorted(r["cluster"] for r in H.ward(df, 2, "vec").transform(df).collect()) == [0, 1]


def test_silhouette_by_hand(spark):
    rng = np.random.default_rng(3)
    x, c = rng.normal(size=(90, 3)), rng.integers(0, 3, 90).tolist()
    c[0] = 9  # alone
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    c = np.array(c)
    want = []
    for i in range(len(x)):
        own = (c == c[i]) & (np.arange(len(x)) != i)
        b = min(d[i][c == o].mean() for o in set(c.tolist()) if o != c[i])
        a = d[i][own].mean() if own.any() else None
        want.append(0 if a is None else (b - a) / max(a, b))
    df = frame(spark, x, c.tolist(), names=["cluster int"])
    assert abs(H.euclidean_silhouette(df, "vec", tile=16) - np.mean(want)) < 1e-6
    some = H.euclidean_silhouette(df, "vec", sample=30)
    assert abs(some - np.mean(want)) < 0.2
    assert H.euclidean_silhouette(df.where("cluster = 1"), "vec") is None


def test_hashed_neighbours_find_nine_in_ten(spark, monkeypatch):
    monkeypatch.setattr(N, "PIECE", 64)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(40, 8)) * 3
    at = rng.integers(0, 40, 3000)
    x = centre[at] + rng.normal(size=(3000, 8))
    x[:600] = x[0]  # a fifth of the rows are one vector
    train, asked = x[:2700], x[2700:]
    label = [int(v % 5) for v in at]
    df = frame(spark, x, label, names=["label long"])
    out = {r["id"]: r["predicted"] for r in N.knn_hashed(df.where("id < 2700"), df.where("id >= 2700"), "vec", "label", "id").collect()}
    same = 0
    for i, q in enumerate(asked):
        near = np.lexsort((np.arange(2700), ((train - q) ** 2).sum(1)))[:5]
        votes = np.bincount([label[j] for j in near])
        same += out[2700 + i] == votes.argmax()
    assert len(out) == 300 and same >= 290
    # the same vector as the frequent one: its smallest keys vote
    got = N.knn_hashed(df.where("id < 2700"), frame(spark, x[:1]).select((F.col("id") + 9000).alias("id"), "vec"), "vec", "label", "id").collect()
    assert [r["predicted"] for r in got] == [np.bincount(label[:5]).argmax()]
    assert N.knn_hashed(df.limit(0), df, "vec", "label", "id").count() == 0


def test_exact_neighbours_by_pieces_are_those_of_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(N, "EXACT_PIECE", 50)
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(400, 2)), 1)  # many equal distances and vectors
    df = frame(spark, x, [int(v) for v in rng.integers(0, 4, 400)], names=["label long"])
    train, asked = df.where("id % 4 <> 0"), df.where("id % 4 = 0").drop("label")
    want = sorted(C.knn(train.selectExpr("id", "vec", "label"), asked, "vec", "label", "id").collect())
    assert sorted(N.knn_exact(train, asked, "vec", "label", "id").collect()) == want and len(want) == 100
    assert N.knn_exact(train.limit(0), asked, "vec", "label", "id").count() == 0


def test_hashed_checks_run_beyond_the_limit_of_a_broadcast(spark, tmp_path, monkeypatch):
    from hazeline.catalog import QUERIES

    monkeypatch.setattr(C.knn, "__defaults__", (5, 100))
    x = np.random.default_rng(6).normal(size=(400, 4))
    df = frame(spark, x, [i % 3 for i in range(400)], names=["label int"])
    df.select(F.col("id").alias("vec_id"), F.col("vec").alias("embedding"), "label").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert [tuple(r) for r in QUERIES["m12_knn_hashed"](spark, str(tmp_path)).collect()] == [(100, True)]


def test_too_few_rows_are_compared_with_all(spark):
    x = np.array([[0.0, 0], [1, 0], [1000, 0], [0, 5000]])
    df = frame(spark, x, [1, 1, 2, 3], names=["label long"])
    got = {r["id"]: r["predicted"] for r in N.knn_hashed(df, frame(spark, np.array([[0.4, 0], [900.0, 0]])), "vec", "label", "id", k=3).collect()}
    assert got == {0: 1, 1: 1}


def test_gradients_by_difference():
    rng = np.random.default_rng(6)
    weights = W._start([3, 5, 4, 3], 1)
    x, y, w = rng.normal(size=(20, 3)), rng.integers(0, 3, 20), rng.random(20) + 0.5
    loss = lambda ws: -(w * np.log(W.outputs(ws, x)[-1][np.arange(20), y])).sum()
    for g, at in zip(W.gradients(weights, x, y, w), range(len(weights))):
        for place in list(np.ndindex(g.shape))[:6]:
            up, down = [v.copy() for v in weights], [v.copy() for v in weights]
            up[at][place] += 1e-5
            down[at][place] -= 1e-5
            assert abs((loss(up) - loss(down)) / 2e-5 - g[place]) < 1e-4


def test_network_learns_and_stops(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 2))
    y = ((x ** 2).sum(1) > 1.4).astype(int).tolist()
    df = frame(spark, x, y, names=["target int"])
    train, test = df.where("id < 2400"), df.where("id >= 2400")
    model = W.ReluNetwork(layers=[2, 16, 8, 2], featuresCol="vec", labelCol="target", epochs=40, rate=0.01).fit(train)
    out = model.transform(test)
    assert out.where("prediction = target").count() > 0.93 * out.count()
    p = out.first()["probability"].toArray()
    assert abs(p.sum() - 1) < 1e-9
    still = W.ReluNetwork(layers=[2, 4, 2], featuresCol="vec", labelCol="target", epochs=50, rate=0.0, patience=1).fit(train)
    assert np.allclose(still.fitted()["w0"], W._start([2, 4, 2], 42)[0])
    unknown = spark.createDataFrame([(None,)], "vec array<double>")
    assert model.transform(unknown).first()["prediction"] is None
    with pytest.raises(ValueError):
        W.ReluNetwork(layers=[2, 2], featuresCol="vec", labelCol="target").fit(train.limit(0))


def test_copula_keeps_margins_and_correlation(spark):
    rng = np.random.default_rng(8)
    a = rng.exponential(10, 4000)
    b = np.round(a * 0.5 + rng.exponential(2, 4000), 1)
    c = np.where(rng.random(4000) < 0.4, 0.0, rng.random(4000))
    df = spark.createDataFrame(list(zip(a.tolist(), b.tolist(), c.tolist(), [5.0] * 4000)), "a double, b double, c double, flat double")
    rows = Y.synthesise_copula(spark, Y.fit_copula(df, ["a", "b", "c", "flat"]), 8000, 3).toPandas()
    for n, v in (("a", a), ("b", b), ("c", c)):
        assert rows[n].min() >= v.min() and rows[n].max() <= v.max()
        assert abs(rows[n].mean() - v.mean()) < 0.05 * v.mean() and 0.9 < rows[n].std() / v.std() < 1.1
    assert (rows["flat"] == 5.0).all() and abs((rows["c"] == 0).mean() - 0.4) < 0.03
    assert abs(rows["a"].rank().corr(rows["b"].rank()) - np.corrcoef(a.argsort().argsort(), b.argsort().argsort())[0, 1]) < 0.05
    with pytest.raises(ValueError):
        Y.fit_copula(df.limit(0), ["a"])


def test_published_network_and_boosters():
    assert M.mlp([12, 64, 32, 6]).getOrDefault("epochs") == 200
    b = M.boost_hist()
    assert [b.getOrDefault(p) for p in ("rounds", "rate", "depth", "l2")] == [250, 0.08, 5, 0.05]
    s = M.boost_sampled()
    assert [s.getOrDefault(p) for p in ("rounds", "rate", "depth", "rows", "columns")] == [200, 0.05, 8, 0.8, 0.8]
