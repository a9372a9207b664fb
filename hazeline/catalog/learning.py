"""Learners, clusters, synthetic rows and scoring.

Fits are re-run per call. A fit has no SQL, but what it must satisfy has: the
queries return the test rows of each label and flags computed from the fit.
"""

from functools import partial

import numpy as np
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from hazeline.catalog.base import OBS_CTE, ordinal, query, rn, with_readings
from hazeline.catalog.series import requests
from hazeline.functions.values import decode, encode
from hazeline.operators import cluster as C
from hazeline.operators import hierarchy as H
from hazeline.operators import models as M
from hazeline.operators import near as N
from hazeline.operators.clean import fill_city
from hazeline.operators.evaluate import class_report, confusion
from hazeline.operators.filters import sample_n
from hazeline.operators.splits import balanced_weights, split_strat
from hazeline.plans import forecast as P
from hazeline.plans import synthetic as Y
from hazeline.schema import GASES, LABELS, WEATHER, feature_set
from hazeline.session import materialise, scratch_path
from hazeline.sources.models import load_model, save_model

NOWCAST = feature_set("nowcast")
SYNTH = feature_set("synthetic")


def complete(t):
    """Readings with gases filled per city, as the sequence models see them."""
    return materialise(fill_city(t.readings, GASES), "complete")


def nowcast_split(t):
    df = P.nowcast_table(complete(t)).select("city", "dt", *[F.col(c).cast("double").alias(c) for c in NOWCAST], "target")
    df = materialise(split_strat(materialise(df, "nowcast"), "target", 0.8, 42, ["city", "dt"]), "nowcast-split")
    train = balanced_weights(df.filter("split = 'train'").drop("split"), "target").persist()
    return train, df.filter("split = 'test'").drop("split")


def _scored(t, estimator):
    train, test = nowcast_split(t)
    model = M.fit(estimator, train, NOWCAST)
    return model.transform(test)


# Test rows of each label after a stratified 80 percent split, as every fit must report them.
_SUPPORT = with_readings(f"""SELECT label_id, coalesce(n - CAST(round(0.8 * n) AS BIGINT), 0) AS support,
  sum(coalesce(n - CAST(round(0.8 * n) AS BIGINT), 0)) OVER () AS total, TRUE AS beats_chance, TRUE AS all_predicted
FROM (SELECT unnest(range({len(LABELS)})) AS label_id) LEFT JOIN (SELECT {ordinal('aqi_category')} AS label_id, count(*) AS n FROM readings GROUP BY 1) USING (label_id)""")


def _evaluated(t, estimator):
    """(label_id, support, total, beats_chance, all_predicted) of the test rows of a fitted model.

    ``beats_chance``: the mean recall of the labels is above that of a constant answer.
    """
    cm = materialise(confusion(_scored(t, estimator), "target", "prediction"), "confusion")
    report = class_report(cm)
    flags = report.agg((F.avg(F.when(F.col("support") > 0, F.col("recall"))) > F.try_divide(F.lit(1.0), F.count_if(F.col("support") > 0))).alias("beats_chance"),
                       (F.sum("predicted") == F.sum("support")).alias("all_predicted"), F.sum("support").alias("total"))
    return report.select("label_id", "support").crossJoin(flags).select("label_id", "support", "total", "beats_chance", "all_predicted")


@query("m7_logistic", _SUPPORT)
def logistic(t):
    return _evaluated(t, M.logistic())


@query("m8_tree", _SUPPORT)
def tree(t):
    return _evaluated(t, M.tree())


@query("m9_forest", _SUPPORT)
def forest(t):
    return _evaluated(t, M.forest())


@query("m10_boost_hist", _SUPPORT)
def boost_hist(t):
    return _evaluated(t, M.boost_hist(rounds=50))


@query("m11_boost_sampled", _SUPPORT)
def boost_sampled(t):
    return _evaluated(t, M.boost_sampled(rounds=25))


@query("m13_linear_svm", _SUPPORT)
def linear_svm(t):
    return _evaluated(t, M.linear_svm())


@query("m14_gaussian_nb", _SUPPORT)
def gaussian_nb(t):
    return _evaluated(t, M.gaussian_nb())


@query("m14_gaussian_moments", with_readings(
    "SELECT aqi_category, round(n / sum(n) OVER (PARTITION BY feature), 9) AS prior, feature, round(mean, 9) AS mean, round(variance, 9) AS variance FROM ("
    + " UNION ALL ".join(f"SELECT aqi_category, '{c}' AS feature, count(*) AS n, avg({c}) AS mean, avg({c} * {c}) - avg({c}) * avg({c}) AS variance "
                         "FROM readings GROUP BY aqi_category" for c in ("co", "humidity", "pm25")) + ")"))
def gaussian_moments(t):
    return M.gaussian_moments(t.readings, ["co", "humidity", "pm25"], "aqi_category")


@query("m15_mlp", _SUPPORT)
def mlp(t):
    return _evaluated(t, M.mlp([12, 64, 32, 6]))


@query("m15_mlp_large", _SUPPORT)
def mlp_large(t):
    return _evaluated(t, M.mlp([12, 128, 64, 32, 6]))


@query("m21_probabilities", with_readings("""SELECT CAST(sum(n - round(0.8 * n)) AS BIGINT) AS rows, TRUE AS sums_to_one, TRUE AS largest_wins, count(*) AS labels
FROM (SELECT count(*) AS n FROM readings GROUP BY aqi_category)"""))
def probabilities(t):
    """All rows have probabilities that sum to one, and the label of the largest."""
    p = F.map_values("probabilities")
    out = M.probabilities(_scored(t, M.logistic()))
    return out.agg(F.count(F.lit(1)).alias("rows"), F.bool_and(F.abs(F.aggregate(p, F.lit(0.0), lambda s, v: s + v) - 1) < 1e-9).alias("sums_to_one"),
                   F.bool_and((F.col("confidence") == F.array_max(p)) & (F.try_element_at("probabilities", F.col("prediction_label")) == F.col("confidence"))).alias("largest_wins"),
                   F.count_distinct("target").alias("labels"))


_TEST_ROWS = f"SELECT CAST(sum(n - round(0.8 * n)) AS BIGINT) AS rows FROM (SELECT count(*) AS n FROM readings GROUP BY aqi_category)"


@query("s7_save_and_load", with_readings(f"SELECT 'logistic_regression' AS model_used, rows, 0::BIGINT AS changed FROM ({_TEST_ROWS})"))
def save_and_load(t):
    """Rows whose prediction differs after the model was stored and loaded: none."""
    train, test = nowcast_split(t)
    root = scratch_path(t.spark, "models")
    fitted = M.fit(M.logistic(), train, NOWCAST)
    save_model(fitted, root, 1, "logistic_regression")
    model, used = load_model(t.spark, root, 1, "random_forest")
    before = fitted.transform(test).select("city", "dt", F.col("prediction").alias("before"))
    both = model.transform(test).select("city", "dt", F.col("prediction").alias("after")).join(before, ["city", "dt"])
    return both.agg(F.first(F.lit(used)).alias("model_used"), F.count(F.lit(1)).alias("rows"),
                    F.count_if(F.col("before") != F.col("after")).alias("changed"))


def vectors(t):
    return t("embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vec"), "label")


@query("m12_knn", """WITH s AS (SELECT vec_id, embedding::DOUBLE[] AS v, label, vec_id IN (SELECT vec_id FROM embeddings ORDER BY md5('3|' || vec_id) LIMIT 200) AS train FROM embeddings),
d AS (SELECT q.vec_id, r.label, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_sum(list_transform(list_zip(q.v, r.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), r.vec_id) AS rn
  FROM s q, s r WHERE r.train AND NOT q.train)
SELECT vec_id, CAST(arg_max(label, c * 1000 - label) AS BIGINT) AS predicted FROM (SELECT vec_id, label, count(*) AS c FROM d WHERE rn <= 5 GROUP BY ALL) GROUP BY vec_id""")
def knn(t):
    v = vectors(t)
    train = sample_n(v, 200, 3, ["vec_id"])
    return C.knn(train, v.join(train.select("vec_id"), "vec_id", "left_anti"), "vec", "label", "vec_id")


def cluster_vectors(t):
    v = vectors(t).select("vec_id", array_to_vector("vec").alias("features"))
    return v.persist()


def _cluster_checks(model, v):
    """(clusters, rows, misplaced, in_range): rows that some other centre is nearer to, and whether the silhouette is one."""
    out = model.transform(v)
    score = C.silhouette(out)
    square = lambda c: F.aggregate(F.zip_with(vector_to_array("features"), F.array(*[F.lit(float(x)) for x in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    far = F.array(*[square(c) for c in model.clusterCenters()])
    out = out.withColumn("far", far)
    return out.agg(F.count_distinct("cluster").alias("clusters"), F.count(F.lit(1)).alias("rows"),
                   F.count_if(F.element_at("far", F.col("cluster") + 1) > F.array_min("far") + 1e-9).alias("misplaced"),
                   F.first(F.lit(score is not None and -1 <= score <= 1)).alias("in_range"))


@query("m16_m19_kmeans", "SELECT 6::BIGINT AS clusters, count(*) AS rows, 0::BIGINT AS misplaced, TRUE AS in_range FROM embeddings")
def kmeans(t):
    v = cluster_vectors(t)
    return _cluster_checks(C.kmeans(v, 6, starts=10), v)


@query("m17_bisecting", "SELECT 6::BIGINT AS clusters, count(*) AS rows, TRUE AS in_range FROM embeddings")
def bisecting(t):
    v = cluster_vectors(t)
    return _cluster_checks(C.bisecting(v, 6), v).drop("misplaced")


@query("m17_ward", "SELECT 6::BIGINT AS clusters, count(*) AS rows, TRUE AS rises_are_sorted, TRUE AS explains_some FROM embeddings")
def ward(t):
    """Ward clusters of all vectors: whether merges cost ever more, and rows are nearer to their cluster's centre than to the centre of all."""
    v = vectors(t).select("vec_id", "vec")
    model = H.ward(v, 6, "vec")
    out = model.transform(v).select("cluster", F.posexplode("vec").alias("place", "x"))
    n = F.col("n")
    inside = out.groupBy("cluster", "place").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"), F.count(F.lit(1)).alias("n"))
    by_place = inside.groupBy("place").agg(F.sum(F.col("q") - F.col("s") * F.col("s") / n).alias("within"), F.sum("q").alias("q"), F.sum("s").alias("s"),
                                           F.sum("n").alias("n"), F.count_distinct("cluster").alias("clusters"))
    total = F.sum(F.col("q") - F.col("s") * F.col("s") / n)
    return by_place.agg(F.max("clusters").alias("clusters"), F.max("n").alias("rows"), F.lit(model.rises == sorted(model.rises)).alias("rises_are_sorted"),
                        (F.sum("within") < total).alias("explains_some"))


@query("m19_silhouette_euclid", """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings),
d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.v, b.v)) AS s, count(*) AS n FROM v a, v b GROUP BY ALL),
m AS (SELECT vec_id, max(CASE WHEN own = other THEN n END) AS n, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a,
  min(CASE WHEN own <> other THEN s / n END) AS b FROM d GROUP BY vec_id)
SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette, count(*) AS rows FROM m""")
def silhouette(t):
    """Silhouette of the vectors' own labels as clusters, in Euclidean distance, over all rows."""
    v = vectors(t).withColumnRenamed("label", "cluster")
    score = H.euclidean_silhouette(v, "vec", sample=100_000)
    return v.agg(F.lit(round(score, 6)).alias("silhouette"), F.count(F.lit(1)).alias("rows"))


def standard_rows(t):
    """Clustering columns, standardised, as arrays."""
    cols = feature_set("clustering_used")
    df = VectorAssembler(inputCols=cols, outputCol="raw").transform(complete(t))
    df = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(df).transform(df)
    return df.select(F.concat_ws("|", "city", F.col("dt").cast("string")).alias("key"), "city", "dt", "features",
                     vector_to_array("features").alias("vec"))


@query("m12_knn_hashed", """SELECT count(*) AS rows, TRUE AS recall_reached FROM embeddings WHERE vec_id % 4 = 0""")
def knn_hashed(t):
    """Every fourth vector against all others by hashed projections; at least nine votes in ten are those of the exact search."""
    v = vectors(t)
    train, asked = v.where("vec_id % 4 <> 0"), v.where("vec_id % 4 = 0").drop("label")
    found = N.knn_hashed(train, asked, "vec", "label", "vec_id").withColumnRenamed("predicted", "hashed")
    exact = N.knn_exact(train, asked, "vec", "label", "vec_id")
    return asked.join(found, "vec_id", "left").join(exact, "vec_id").agg(
        F.count("hashed").alias("rows"), (F.avg((F.col("hashed") == F.col("predicted")).cast("double")) >= 0.9).alias("recall_reached"))


@query("m18_density_clusters")
def density(t):
    rows = sample_n(standard_rows(t), 20000, 42, ["city", "dt"])
    out = C.density_clusters(rows.select("key", "vec"), "vec", "key", 1.5, 10)
    return out.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("m20_pca")
def pca(t):
    df = complete(t)
    model, ratio = M.pca(df, feature_set("clustering_used"), 2)
    out = M.pca_points(df, model, ["city", "dt", "aqi_category"])
    return out.withColumns({"ratio1": F.lit(ratio[0]), "ratio2": F.lit(ratio[1])})


@query("m20_pca_checks", with_readings("SELECT count(*) AS rows, TRUE AS orthonormal, TRUE AS ratios_fall, TRUE AS ratios_are_variances FROM readings"))
def pca_checks(t):
    """Components of length one at right angles, whose share of the variance falls and is that of the points."""
    df = complete(t)
    cols = feature_set("clustering_used")
    model, ratio = M.pca(df, cols, 3)
    pc = model.stages[-1].pc.toArray()
    square = abs(pc.T @ pc - np.eye(3)).max() < 1e-9
    points = M.pca_points(df, model, ["city"])
    share = [F.abs(F.var_samp(f"pc{i + 1}") / len(cols) - r) < 1e-6 for i, r in enumerate(ratio)]
    return points.agg(F.count(F.lit(1)).alias("rows"), F.lit(bool(square)).alias("orthonormal"),
                      F.lit(ratio == sorted(ratio, reverse=True) and sum(ratio) <= 1 + 1e-9).alias("ratios_fall"),
                      (share[0] & share[1] & share[2]).alias("ratios_are_variances"))


@query("m31_grid_checks", "SELECT CAST(latent_dim AS INT) AS latent_dim, latent_dim <= 8 AS has_loss, TRUE AS falls FROM (SELECT unnest([2, 4, 8, 16]) AS latent_dim), (SELECT count(*) FROM events)")
def grid_checks(t):
    """A loss for each size that a linear model can have, and never more than that of the size before."""
    grid = Y.grid_search(complete(t), SYNTH, [2, 4, 8, 16])
    before = F.lag("final_loss").over(Window.orderBy("latent_dim"))
    return grid.select("latent_dim", F.col("final_loss").isNotNull().alias("has_loss"), F.coalesce(F.col("final_loss") <= before + 1e-12, F.lit(True)).alias("falls"))


BASE = [*GASES, *WEATHER, *P.CALENDAR]
SHORT = dict(steps=[1, 3], widths=[3])


def forecast_rows(t, horizons):
    features = P.feature_names(BASE, **SHORT)
    return P.training_frame(complete(t), horizons, features=features, **SHORT), features


@query("m30_metric_grid")
def metric_grid(t):
    frame, features = forecast_rows(t, [1, 24])
    makers = {"Logistic Regression": partial(M.logistic, max_iter=20), "Random Forest": partial(M.forest, n=10, depth=6)}
    return P.metric_grid(frame, features, [1, 24], makers).drop("train_time_seconds")


@query("m31_grid_search")
def grid_search(t):
    return Y.grid_search(complete(t), SYNTH, [4, 8, 16])


def _synthetic(t):
    df = complete(t)
    return df, Y.synthesise(t.spark, Y.fit_latent(df, SYNTH, 8), df.count(), 42)


@query("m33_synthesise")
def synthesise(t):
    return _synthetic(t)[1]


@query("m33_m35_copula", with_readings("SELECT feature, (SELECT count(*) FROM readings) AS rows, TRUE AS in_range, 'EXCELLENT' AS verdict, TRUE AS spread_kept FROM (SELECT unnest(["
    + ", ".join(f"'{c}'" for c in SYNTH) + "]) AS feature)"))
def copula(t):
    """Rows of the copula: none outside the observed range (so no negative concentration), means and deviations as in the data."""
    df = complete(t)
    synth = materialise(Y.synthesise_copula(t.spark, Y.fit_copula(df, SYNTH), df.count(), 42), "copula")
    span = lambda rows, tag: rows.agg(F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{n}_{c}") for c in SYNTH for n, f in (("lo", F.min), ("hi", F.max))]).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col("rows"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi")) for c in SYNTH]))).select(
        "feature", *[F.col(c).alias(f"{tag}_{c}") for c in ("rows", "lo", "hi")])
    both = span(df, "real").join(span(synth, "own"), "feature").join(Y.fidelity(df, synth, SYNTH), "feature")
    return both.select("feature", F.col("own_rows").alias("rows"), ((F.col("own_lo") >= F.col("real_lo")) & (F.col("own_hi") <= F.col("real_hi"))).alias("in_range"),
                       "verdict", F.col("sd_captured_pct").between(90, 110).alias("spread_kept"))


@query("m32_m34_augment")
def augment(t):
    real, synth = _synthetic(t)
    train = real.withColumn("target", encode("aqi_category"))
    # published without a depth limit and with leaves of one row; 30 is as deep as MLlib goes
    teacher = M.fit(M.forest(weight=None, depth=30, leaf=1), train, SYNTH)
    labelled = Y.teacher_label(teacher, synth).withColumn("aqi_category", decode("target"))
    out = Y.augment(real.select(*SYNTH, "aqi_category"), labelled.select(*SYNTH, "aqi_category"))
    return out.groupBy("origin", "aqi_category").agg(F.count(F.lit(1)).alias("n"))


@query("m34_augment_rule", with_readings(
    f"""SELECT city, dt, {rn('co')}, aqi_category, 'real' AS origin FROM readings
UNION ALL SELECT city, dt, round(co + 1, 9), aqi_category, 'synthetic' FROM readings WHERE aqi_category IN ('Hazardous', 'Severe', 'Very_Unhealthy', 'Unhealthy')"""))
def augment_rule(t):
    r = t.readings.select("city", "dt", "co", "aqi_category")
    return Y.augment(r, r.withColumn("co", F.col("co") + 1))


@query("m35_fidelity", with_readings(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(rm, 9) AS real_mean, round(rs, 9) AS real_sd, round(sm, 9) AS synthetic_mean, round(ss, 9) AS synthetic_sd,
  round(abs(rm - sm) / abs(rm) * 100, 9) AS mean_error_pct, round(ss / rs * 100, 9) AS sd_captured_pct,
  CASE WHEN abs(rm - sm) / abs(rm) * 100 < 5 THEN 'EXCELLENT' WHEN abs(rm - sm) / abs(rm) * 100 < 15 THEN 'GOOD' ELSE 'FAIR' END AS verdict
FROM (SELECT avg({c}) FILTER (WHERE city <> 'S0') AS rm, stddev_samp({c}) FILTER (WHERE city <> 'S0') AS rs,
  avg({c}) FILTER (WHERE city = 'S0') AS sm, stddev_samp({c}) FILTER (WHERE city = 'S0') AS ss FROM readings)""" for c in ("pm25", "co", "no2"))))
def fidelity(t):
    r = t.readings
    return Y.fidelity(r.filter("city <> 'S0'"), r.filter("city = 'S0'"), ["pm25", "co", "no2"])


@query("m36_loss_check", """SELECT CAST(l_linenumber AS BIGINT) AS epochs, round(loss, 9) AS loss, round(rec + 0.001::DOUBLE * kl, 9) AS computed,
  abs(rec + 0.001::DOUBLE * kl - loss) < 0.0005 AS consistent, round(kl / 8, 9) AS kl_per_dim, kl / 8 > 0.5 AS healthy, l_orderkey
FROM (SELECT l_orderkey, l_linenumber, l_discount / 10.0::DOUBLE AS rec, l_quantity / 5.0::DOUBLE AS kl,
  l_discount / 10.0::DOUBLE + l_quantity / 5.0::DOUBLE * 0.001::DOUBLE + CASE WHEN l_linenumber % 2 = 0 THEN 0.01::DOUBLE ELSE 0 END AS loss FROM lineitem)""")
def loss_check(t):
    li = t("lineitem").selectExpr(
        "l_orderkey", "CAST(l_linenumber AS BIGINT) AS epochs", "l_discount / 10 AS reconstruction_loss", "l_quantity / 5D AS kl_loss",
        "l_discount / 10 + l_quantity / 5D * 0.001D + CASE WHEN l_linenumber % 2 = 0 THEN 0.01D ELSE 0D END AS loss")
    rows = F.collect_list(F.struct("epochs", "loss", "reconstruction_loss", "kl_loss"))
    hist = li.groupBy("l_orderkey").agg(rows.alias("r")).select(
        "l_orderkey", F.lit(8).alias("latent_dim"), *[F.col(f"r.{c}").alias(c) for c in ("epochs", "loss", "reconstruction_loss", "kl_loss")])
    return Y.loss_check(hist, keep=["l_orderkey"])


def scoring_models(t):
    """The published logistic forecast of one hour: all lags and rolls, labels balanced by weights, up to 1,000 iterations."""
    frame = materialise(P.training_frame(complete(t), [1]), "forecast")
    return {(1, "logistic_regression"): M.fit(M.logistic(), balanced_weights(frame, "target"), P.feature_names(), "city")}


@query("m37_batch_forecast", f"""WITH {OBS_CTE} SELECT event_id AS request_id, city, 1 AS horizon_hours, 'logistic_regression' AS model, ts AS input_time,
  ts + INTERVAL 1 HOUR AS forecast_for, 'Logistic Regression' AS model_label, 'ok' AS status, TRUE AS is_label, TRUE AS is_most_likely
FROM obs WHERE event_type = 'purchase'""")
def batch_forecast(t):
    req = requests(t).withColumns({"horizon_hours": F.lit(1), "model": F.lit("logistic_regression")})
    out = P.batch_forecast(req, complete(t), scoring_models(t))
    p = F.map_values("probabilities")
    return out.select("request_id", "city", "horizon_hours", "model", "input_time", "forecast_for", "model_label", "status",
                      F.col("prediction").isin(*LABELS).alias("is_label"),
                      ((F.col("confidence") == F.array_max(p)) & (F.try_element_at("probabilities", F.col("prediction")) == F.col("confidence"))).alias("is_most_likely"))


@query("m38_batch_nowcast")
def batch_nowcast(t):
    train, test = nowcast_split(t)
    models = {"logistic": M.fit(M.logistic(max_iter=20), train, NOWCAST), "tree": M.fit(M.tree(depth=8), train, NOWCAST),
              "naive_bayes": M.fit(M.gaussian_nb(), train, NOWCAST)}
    rows = test.select(F.concat_ws("|", "city", F.col("dt").cast("string")).alias("row_id"), F.array(*NOWCAST).alias("features"))
    return P.batch_nowcast(rows, models, "row_id")
