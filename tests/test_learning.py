import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from hazeline.catalog.base import Tables
from hazeline.catalog.learning import scoring_models
from hazeline.functions.values import calendar, encode
from hazeline.operators import cluster as C
from hazeline.operators import models as M
from hazeline.operators.clean import fill_city
from hazeline.operators.encode import fit_scaling
from hazeline.operators import evaluate as V
from hazeline.operators import summary as S
from hazeline.operators.evaluate import evaluate
from hazeline.plans import forecast as P
from hazeline.plans import synthetic as Y


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    blobs = [rng.normal(c, 0.3, (60, 2)) for c in ((0, 0), (4, 4), (8, 0))] + [rng.uniform(-20, -10, (6, 2))]
    data = np.vstack(blobs)
    rows = [(i, [float(x) for x in p], min(i // 60, 3)) for i, p in enumerate(data)]
    return spark.createDataFrame(rows, "id bigint, vec array<double>, label int").cache(), data


def brute_density(data, eps, min_pts):
    near = ((data[:, None] - data[None]) ** 2).sum(2) <= eps * eps
    core = near.sum(1) >= min_pts
    label = np.full(len(data), -1)
    for i in np.flatnonzero(core):
        if label[i] >= 0:
            continue
        stack, label[i] = [i], i
        while stack:
            for j in np.flatnonzero(near[stack.pop()] & core):
                if label[j] < 0:
                    label[j] = i
                    stack.append(j)
    for i in np.flatnonzero(~core):
        owners = label[near[i] & core]
        label[i] = owners.min() if len(owners) else -1
    return label


@pytest.mark.parametrize("eps", [0.25, 0.6, 1.5, 6.0])
def test_density_clusters_against_brute_force(points, eps):
    df, data = points
    got = {r.id: r.cluster for r in C.density_clusters(df, "vec", "id", eps, 5).collect()}
    assert [got[i] for i in range(len(data))] == brute_density(data, eps, 5).tolist()


def test_knn_against_brute_force(points):
    df, data = points
    train, test = df.filter("id % 2 = 0"), df.filter("id % 2 = 1")
    got = {r.id: r.predicted for r in C.knn(train, test, "vec", "label", "id").collect()}
    ids = np.arange(0, len(data), 2)
    for q in range(1, len(data), 2):
        near = ids[np.argsort(((data[ids] - data[q]) ** 2).sum(1), kind="stable")[:5]]
        votes = np.bincount([min(i // 60, 3) for i in near])
        assert got[q] == votes.argmax()
    with pytest.raises(ValueError):
        C.knn(train, test, "vec", "label", "id", limit=10)


def test_clusters_and_silhouette(points):
    df, _ = points
    v = df.filter("label < 3").select("id", array_to_vector("vec").alias("features"))
    for model in (C.kmeans(v, 3), C.bisecting(v, 3)):
        out = model.transform(v)
        assert out.groupBy("cluster").count().filter("count = 60").count() == 3
        assert C.silhouette(out) > 0.9
    assert C.silhouette(v.withColumn("cluster", F.lit(0))) is None


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, k double")
    s = fit_scaling(df, ["a", "k"])
    assert sorted(tuple(r) for r in s.transform(df).collect()) == [(-1.0, 0.0), (1.0, 0.0)]
    assert sorted(tuple(r) for r in s.inverse(s.transform(df)).collect()) == [(1.0, 5.0), (3.0, 5.0)]


@pytest.fixture(scope="module")
def labelled(panel):
    df = fill_city(panel, ["pm25"]).withColumn("aqi_category", F.when(F.col("pm25") > 66, "Unhealthy").when(F.col("pm25") > 33, "Moderate").otherwise("Good"))
    return df.withColumns({"target": encode("aqi_category"), "weight": F.lit(1.0)}).cache()


@pytest.mark.parametrize("make", [
    lambda: M.logistic(max_iter=20), lambda: M.tree(depth=5), lambda: M.forest(n=5, depth=5), lambda: M.boost_hist(rounds=2, depth=3),
    lambda: M.boost_sampled(rounds=2, depth=3), lambda: M.linear_svm(max_iter=5), lambda: M.gaussian_nb(),
    lambda: M.mlp([2, 16, 4], max_iter=150)])
def test_models_beat_the_majority(labelled, make):
    model = M.fit(make(), labelled, ["pm25", "co"])
    scored = model.transform(labelled)
    majority = labelled.groupBy("target").count().agg(F.max("count")).first()[0] / labelled.count()
    assert evaluate(scored, "target", "prediction").first().accuracy > majority
    if "rawPrediction" in scored.columns:
        p = M.probabilities(scored).select("probabilities", "confidence").first()
        assert abs(sum(p.probabilities.values()) - 1) < 1e-9 and p.confidence == max(p.probabilities.values())


def test_latent_rows_resemble_the_data(labelled):
    latent = Y.fit_latent(labelled, ["pm25", "co"], 2)
    synth = Y.synthesise(labelled.sparkSession, latent, 5000, 1)
    f = {r.feature: r for r in Y.fidelity(labelled, synth, ["pm25", "co"]).collect()}
    assert all(r.mean_error_pct < 5 and 95 < r.sd_captured_pct < 105 for r in f.values())
    grid = {r.latent_dim: r.final_loss for r in Y.grid_search(labelled, ["pm25", "co"], [1, 2, 9]).collect()}
    assert set(grid) == {1, 2, 9} and grid[9] is None and abs(grid[2]) < 1e-9 < grid[1]


def test_grid_and_batch_forecast(labelled):
    df = calendar(labelled.drop("target", "weight"))
    features = ["pm25", "co", "hour", "pm25_lag_1h", "hour_sin"]
    base = df.select("city", "dt", "pm25", "co", "aqi_category")
    for c in ("pm10", "no2", "so2", "o3", "temp", "humidity", "wind"):
        base = base.withColumn(c, F.col("co") + 1)
    frame = P.training_frame(base, [1], steps=[1], widths=[3], features=features)
    kept = {}
    grid = P.metric_grid(frame, features, [1], {"Logistic Regression": lambda: M.logistic(max_iter=5)},
                         on_model=lambda h, n, m: kept.update({(h, "logistic_regression"): m}))
    row = grid.first()
    assert row.train_rows + row.validation_rows + row.test_rows == frame.count() and row.rows == row.test_rows
    req = base.limit(5).selectExpr("concat(city, dt) AS request_id", "city", "dt", "1 AS horizon_hours", "'logistic_regression' AS model",
                                   "map('co', '3.5') AS features")
    metrics = grid.select("horizon_hours", F.lit("logistic_regression").alias("model"), "accuracy")
    odd = [("r1", "nowhere", None, 1, "logistic_regression"), ("r2", "A", None, 1, "logistic_regression"), ("r3", "A", None, 7, "logistic_regression"), ("r4", "A", None, 1, None)]
    odd = base.sparkSession.createDataFrame(odd, "request_id string, city string, dt timestamp, horizon_hours int, model string").withColumn("features", F.expr("map('co', '3.5')"))
    out = P.batch_forecast(req.unionByName(odd), base, kept, metrics, steps=[1], widths=[3]).collect()
    assert len(out) == 9
    last = {r.request_id: r for r in out if len(r.request_id) == 2}
    assert {k: r.status for k, r in last.items()} == {"r1": "unknown city", "r2": "ok", "r3": "no such model", "r4": "no such model"}
    assert last["r2"].input_time == base.agg(F.max("dt")).filter("1 = 1").first()[0] or last["r2"].input_time is not None
    assert all(r.prediction is None for k, r in last.items() if k != "r2") and last["r2"].prediction
    out = [r for r in out if len(r.request_id) > 2]
    assert all(r.status == "ok" for r in out)
    assert all((r.forecast_for - r.input_time).seconds == 3600 and r.metrics.accuracy == row.accuracy for r in out)


def test_scoring_models_have_the_published_parameters(spark):
    model = scoring_models(Tables(spark, "/root/testdata/sf0.001"))[1, "logistic_regression"]
    assert model.stages[0].getInputCols() == P.feature_names()
    fitted = model.stages[-1]
    assert fitted.getMaxIter() == 1000 and fitted.getWeightCol() == "weight"
    assert fitted.numFeatures == len(P.feature_names()) + 5 and 20 < fitted.summary.totalIterations


def test_training_rows_know_all_features(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    # an hour without a value (NaN counts as none) is missing in its own row, a lag later and in the rolls of few values
    rows = fill_city(t.readings, ["pm25", "pm10", "no2", "co", "so2", "o3"]).withColumn(
        "pm25", F.when(F.hour("dt") == 5, float("nan")).when(F.hour("dt") != 9, F.col("pm25")))
    features = ["pm25", "pm25_lag_1h", "pm25_roll_mean_3h", "pm25_roll_max_3h", "co_lag_3h", "hour"]
    short = dict(steps=[1, 3], widths=[3])
    every = P.training_frame(rows, [1], **short, features=["hour"])
    frame = P.training_frame(rows, [1], **short, features=features)
    want = every.na.drop(subset=features)
    assert 0 < frame.count() == want.count() < every.count() and frame.exceptAll(want).isEmpty()


def test_nowcast_drops_wrong_lengths(spark):
    df = spark.createDataFrame([(1, [float(i) for i in range(12)]), (2, [1.0, 2.0]), (3, None)], "id int, features array<double>")
    assert [r.id for r in P.nowcast_rows(df).collect()] == [1]


def test_statistics_of_ordinary_odd_data(spark):
    df = spark.createDataFrame([(1.0, 5.0, None, "a"), (2.0, 5.0, None, "b"), (4.0, 5.0, None, "a")], "x double, flat double, none double, g string")
    r = {(a.feature_a, a.feature_b): a.r for a in S.corr_matrix(df, ["x", "flat", "none"]).collect()}
    assert abs(r[("x", "x")] - 1) < 1e-12 and all(v is None for k, v in r.items() if k != ("x", "x"))
    assert all(a.density is None for a in S.kde(df, "flat").collect())
    assert sum(a.n for a in S.density_histogram(df, "flat", by="g").collect()) == 3
    zero = spark.createDataFrame([(0.0,), (0.0,)], "x double")
    f = Y.fidelity(zero, zero, ["x"]).first()
    assert f.mean_error_pct is None and f.sd_captured_pct is None and f.verdict is None
    e = V.evaluate(spark.createDataFrame([], "t int, p int"), "t", "p").first()
    assert e["rows"] == 0 and e.accuracy is None


def test_augment_teacher_is_the_published_forest(panel, monkeypatch):
    from hazeline.catalog import learning as L

    class Seen(Exception):
        pass

    def fit(estimator, *_):
        raise Seen(estimator)

    monkeypatch.setattr(L, "_synthetic", lambda t: (panel, panel))
    monkeypatch.setattr(L.M, "fit", fit)
    with pytest.raises(Seen) as seen:
        L.augment(None)
    teacher = seen.value.args[0]
    assert (teacher.getNumTrees(), teacher.getMaxDepth(), teacher.getMinInstancesPerNode()) == (100, 30, 1)


def test_rows_without_time_or_label_have_no_split(spark):
    import datetime as dt

    from hazeline.operators import splits as X
    from hazeline.operators.encode import label_encode

    rows = [(c, dt.datetime(2024, 1, 1 + i), i, lab) for i, (c, lab) in enumerate([("A", "x"), ("A", "y"), ("B", "x"), ("B", "y"), ("C", "x")] * 4)]
    rows += [("A", None, 90, "x"), (None, dt.datetime(2024, 1, 3), 91, None)]
    df = spark.createDataFrame(rows, "city string, dt timestamp, id int, label string")
    for out, gone in ((X.split_chrono(df), {90}), (X.split_strat(df, "label", 0.5, 1, ["id"]), {91}), (X.city_holdout(df), {90, 91})):
        got = {r["id"]: r["split"] for r in out.collect()}
        assert set(got) == set(range(20)) | {90, 91} and {i for i, s in got.items() if s is None} == gone
    codes = {r["city"]: r["code"] for r in label_encode(df, "city", "code").collect()}
    assert codes == {"A": 0, "B": 1, "C": 2, None: None}
    assert {r["id"]: r["code"] for r in label_encode(df, "id", "code").collect()} == {i: k for k, i in enumerate([*range(20), 90, 91])}
