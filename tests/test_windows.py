import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows_of
from hazeline.operators import windows as W
from hazeline.operators.clean import fill_city, fill_global, interpolate, median_fill
from hazeline.operators.joins import asof_attach, asof_history
from hazeline.operators.panel import chunked, own_rows


def test_chunks_equal_whole_windows(panel):
    cols = {**W.lag_columns(["pm25"]), **W.roll_columns(["pm25"])}
    whole = rows_of(W.past_features(panel, ["pm25"]), "city", "dt")
    for rows in (24, 37, 199):
        base = chunked(panel, 24, 0, rows=rows).select("*", *[e.alias(n) for n, e in cols.items()])
        assert rows_of(own_rows(base), "city", "dt") == whole


def test_rolls_match_pandas(panel):
    got = W.rolls(panel, ["pm25"], [3, 24], ("mean", "max")).orderBy("city", "dt").toPandas()
    src = panel.orderBy("city", "dt").toPandas()
    for w in (3, 24):
        for kind in ("mean", "max"):
            want = src.groupby("city")["pm25"].transform(lambda s: getattr(s.shift(1).rolling(w, min_periods=max(2, w // 2)), kind)())
            pd.testing.assert_series_equal(got[f"pm25_roll_{kind}_{w}h"], want, check_names=False)


def test_lags_stay_in_their_city(panel):
    first = W.lags(panel, ["co"], [1]).groupBy("city").agg(F.min_by("co_lag_1h", "dt").alias("x"), F.count_if(F.col("co_lag_1h").isNull()).alias("n"))
    assert all(r.n == 1 for r in first.collect())


def test_no_future_row_changes_a_feature(panel):
    cut = panel.agg(F.expr("percentile(unix_timestamp(dt), 0.5)").alias("c")).first().c
    later = F.unix_timestamp("dt") > cut
    changed = panel.withColumns({"pm25": F.when(later, -99.0).otherwise(F.col("pm25")), "co": F.when(later, 1e6).otherwise(F.col("co"))})
    upto = F.unix_timestamp("dt") <= cut
    a = W.past_features(panel, ["pm25", "co"]).filter(upto)
    b = W.past_features(changed, ["pm25", "co"]).filter(upto)
    assert rows_of(a, "city", "dt") == rows_of(b, "city", "dt")


def test_forecast_frame_skips_gaps(panel):
    f = W.forecast_frame(panel, [1, 4])
    w = Window.partitionBy("city").orderBy("dt")
    for h in (1, 4):
        want = panel.withColumn("t", F.lead("dt", h).over(w)).filter(F.col("t") == F.col("dt") + F.expr(f"INTERVAL {h} HOUR")).count()
        assert f.filter(f"horizon_hours = {h}").count() == want < panel.count() - 2 * h


def test_sequences(panel):
    s = W.sequences(panel, ["co"], 12, 4).orderBy("city", "dt").collect()
    src = panel.orderBy("city", "dt").toPandas()
    want = []
    for _, g in src.groupby("city"):
        v = g["co"].tolist()
        want += [v[i - 11:i + 1] for i in range(11, len(v) - 4)]
    assert [[x[0] for x in r.sequence] for r in s] == want


def brute_asof(req, hist):
    out = {}
    for r in req.collect():
        rows = [h for h in hist if h.city == r.city and h.dt < r.dt]
        out[r.request_id] = [h.co for h in sorted(rows, key=lambda h: h.dt)[-3:]] or None
    return out


def test_asof_against_brute_force(spark, panel):
    req = panel.select(F.monotonically_increasing_id().alias("request_id"), "city",
                       (F.col("dt") + F.expr("make_interval(0, 0, 0, 0, 0, 30 * pmod(hash(dt), 3))")).alias("dt"))
    extra = spark.sql("SELECT -1L AS request_id, 'A' AS city, timestamp'2020-01-01' AS dt UNION ALL SELECT -2L, 'B', timestamp'2030-01-01' "
                      "UNION ALL SELECT -3L, 'C', timestamp'2024-01-26'")
    req = req.unionByName(extra).cache()
    want = brute_asof(req, panel.collect())
    got = asof_history(req, panel, 3, ["co"])
    assert {r.request_id: [h.co for h in r.history] if r.history else None for r in got.collect()} == want
    salted = asof_attach(req, panel, ["city"], "dt", "co", salts=3)
    assert {r.request_id: r.co for r in salted.collect()} == {k: v[-1] if v else None for k, v in want.items()}


def test_serving_equals_training_on_full_history(panel):
    df = panel.na.fill(0.0, ["pm25"])
    train = W.past_features(df, ["co"], [1, 6], [3]).withColumn("n", F.row_number().over(Window.partitionBy("city").orderBy("dt"))).filter("n > 24")
    req = df.selectExpr("concat(city, dt) AS request_id", "city", "dt", "CAST(NULL AS map<string,string>) AS features")
    serve = W.serve_features(req, df, ["co"], [1, 6], [3])
    cols = ["city", "dt", "co_lag_1h", "co_lag_6h", "co_roll_mean_3h", "co_roll_max_3h"]
    a, b = train.select(*cols), serve.select(*cols)
    assert a.exceptAll(b).count() == 0


def test_fills(panel):
    src = panel.orderBy("city", "dt").toPandas()
    got = fill_city(panel, ["pm25"]).orderBy("city", "dt").toPandas()
    want = src.groupby("city")["pm25"].transform(lambda s: s.ffill().bfill())
    pd.testing.assert_series_equal(got["pm25"], want)
    g = fill_global(panel, ["pm25"]).orderBy("dt", "city").toPandas()
    w = src.sort_values(["dt", "city"])["pm25"].ffill().bfill().reset_index(drop=True)
    pd.testing.assert_series_equal(g["pm25"], w)


def test_interpolation_respects_gap_length(spark):
    rows = [(h, v) for h, v in enumerate([0.0, None, None, None, 8.0, None, None, None, None, 1.0])]
    df = spark.createDataFrame(rows, "h int, v double").selectExpr("'A' AS city", "timestamp'2024-01-31 20:00:00' + make_interval(0,0,0,0,h) AS dt", "v")
    got = [r.v for r in interpolate(df, ["v"]).orderBy("dt").collect()]
    assert got == [0.0, 2.0, 4.0, 6.0, 8.0, None, None, None, None, 1.0]


def test_median_fill(spark):
    df = spark.sql("SELECT 'A' AS city, timestamp'2024-01-01' + make_interval(0,0,0,0,CAST(id AS INT)) AS dt, CASE WHEN id % 5 = 0 THEN NULL ELSE double(id) END AS v FROM range(20)")
    got = median_fill(df, ["v"]).orderBy("dt").toPandas()["v"]
    src = df.orderBy("dt").toPandas()["v"]
    pd.testing.assert_series_equal(got, src.fillna(src.median()))
