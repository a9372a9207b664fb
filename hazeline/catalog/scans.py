"""Sources and sinks."""

from pyspark.sql import functions as F

from hazeline.catalog.base import BREAKS_CTE, OBS_CTE, query, rn, with_readings
from hazeline.catalog.metrics import METRIC_CTES, METRIC_SELECT, baseline_metrics
from hazeline.functions.index import add_index
from hazeline.functions.values import calendar, parse_ts
from hazeline.schema import GASES, feature_set
from hazeline.session import scratch_path
from hazeline.sources.live import flatten_live
from hazeline.sources.readings import read_readings, standardise_names, write_readings
from hazeline.sources.reports import read_metrics, write_report

READING_COLUMNS = ["city", "dt", *GASES, "temp", "humidity", "wind", "aqi_category"]
_ROUND = "city, dt, " + rn(*GASES, "temp", "humidity", "wind") + ", aqi_category"

_DOMINANT = ("CASE WHEN i1 = top THEN 'PM2.5' WHEN i2 = top THEN 'PM10' WHEN i3 = top THEN 'NO2' "
             "WHEN i4 = top THEN 'CO' WHEN i5 = top THEN 'SO2' ELSE 'O3' END")
_BAND = ("CASE WHEN top <= 50 THEN 'Good' WHEN top <= 100 THEN 'Satisfactory' WHEN top <= 200 THEN 'Moderate' "
         "WHEN top <= 300 THEN 'Poor' WHEN top <= 400 THEN 'Very Poor' ELSE 'Severe' END")

# Index of the readings in SQL: pivot of the long sub-index table.
INDEX_CTE = f"""wide AS (
  SELECT city, dt, max(idx) FILTER (WHERE gas = 'pm25') AS i1, max(idx) FILTER (WHERE gas = 'pm10') AS i2,
    max(idx) FILTER (WHERE gas = 'no2') AS i3, max(idx) FILTER (WHERE gas = 'co') AS i4,
    max(idx) FILTER (WHERE gas = 'so2') AS i5, max(idx) FILTER (WHERE gas = 'o3') AS i6, max(idx) AS top
  FROM fx GROUP BY city, dt),
indexed AS (SELECT r.*, i1, i2, i3, i4, i5, i6, top, round(top, 2) AS aqi, {_BAND} AS band, {_DOMINANT} AS dominant
  FROM readings r JOIN wide USING (city, dt))"""


@query("flagship_city_index", with_readings(
    f"""SELECT city, count(*) AS records, round(avg(aqi), 9) AS mean_aqi, max(aqi) AS max_aqi,
  count(*) FILTER (WHERE band IN ('Poor', 'Very Poor', 'Severe')) AS bad_hours FROM indexed GROUP BY city""", INDEX_CTE))
def flagship(t):
    return add_index(t.readings).groupBy("city").agg(
        F.count(F.lit(1)).alias("records"), F.avg("aqi").alias("mean_aqi"), F.max("aqi").alias("max_aqi"),
        F.count_if(F.col("band").isin("Poor", "Very Poor", "Severe")).alias("bad_hours"))


@query("fixture_readings", with_readings(f"SELECT {_ROUND} FROM readings"))
def fixture(t):
    return t.readings.select(*READING_COLUMNS)


@query("s1_csv_scan", with_readings(f"SELECT {_ROUND} FROM readings"))
def csv_scan(t):
    path = scratch_path(t.spark, "csv")
    write_readings(t.readings, path, fmt="csv")
    return read_readings(t.spark, path, fmt="csv").select(*READING_COLUMNS)


@query("s2_pruned_scan", "SELECT event_id, user_id FROM events")
def pruned(t):
    return read_readings(t.spark, f"{t.folder}/events.parquet", columns=["event_id", "user_id"])


@query("s3_parse_ts", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts)
  WHEN 1 THEN date_trunc('second', ts) WHEN 2 THEN date_trunc('minute', ts) END AS dt FROM events""")
def lenient_times(t):
    ts, k = F.col("ts").cast("timestamp"), F.col("event_id") % 4
    text = (F.when(k == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).when(k == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
            .when(k == 2, F.date_format(ts, "dd/MM/yyyy HH:mm")).otherwise("not a time"))
    return t("events").select("event_id", parse_ts(text).alias("dt"))


@query("s4_partitioned_sink", with_readings(f"SELECT {_ROUND} FROM readings"))
def stored(t):
    path = scratch_path(t.spark, "readings")
    write_readings(t.readings, path)
    return standardise_names(read_readings(t.spark, path)).select(*READING_COLUMNS)


@query("s5_s6_report_round_trip", with_readings(METRIC_SELECT, *METRIC_CTES))
def report_round_trip(t):
    path = scratch_path(t.spark, "report")
    write_report(baseline_metrics(t), path)
    m = read_metrics(t.spark, path)
    return m.withColumns({"horizon_hours": F.col("horizon_hours").cast("int"), "rows": F.col("rows").cast("bigint")})


def payloads(t):
    """Live payload text built from observations: one gas per event, weather from k."""
    o = t.observations
    v = F.col("cents") / F.lit(100.0)

    def of(kind):
        return F.when(F.col("event_type") == kind, v)

    comp = F.struct(of("view").alias("pm2_5"), of("click").alias("pm10"), of("purchase").alias("no2"),
                    (F.col("k") * 100.0).alias("co"), of("error").alias("so2"), of("signup").alias("o3"))
    air = F.to_json(F.struct(F.when(F.col("k") == 99, F.array().cast("array<struct<components:struct<pm2_5:double,pm10:double,no2:double,co:double,so2:double,o3:double>>>"))
                             .otherwise(F.array(F.struct(comp.alias("components")))).alias("list")))
    wx = F.to_json(F.struct(F.struct((F.col("k") / 2.0).alias("temp"), F.col("k").cast("double").alias("humidity")).alias("main"),
                            F.struct((F.col("k") / 4.0).alias("speed")).alias("wind")))
    return o.select("event_id", "city", "ts", air.alias("air"), wx.alias("weather"))


LIVE_CTES = (OBS_CTE, BREAKS_CTE, """live AS (
  SELECT event_id, city, ts,
    CASE WHEN event_type = 'view' THEN cents / 100.0::DOUBLE ELSE 0 END AS pm25,
    CASE WHEN event_type = 'click' THEN cents / 100.0::DOUBLE ELSE 0 END AS pm10,
    CASE WHEN event_type = 'purchase' THEN cents / 100.0::DOUBLE ELSE 0 END AS no2, k * 100.0::DOUBLE / 1000 AS co,
    CASE WHEN event_type = 'error' THEN cents / 100.0::DOUBLE ELSE 0 END AS so2,
    CASE WHEN event_type = 'signup' THEN cents / 100.0::DOUBLE ELSE 0 END AS o3,
    k / 2.0::DOUBLE AS temp, k::DOUBLE AS humidity, k / 4.0::DOUBLE * 3.6 AS wind
  FROM obs WHERE k <> 99)""")


@query("s8_flatten_live", f"WITH {', '.join(LIVE_CTES)} SELECT event_id, city, ts, "
       f"{rn(*GASES, 'temp', 'humidity', 'wind')} FROM live")
def live(t):
    return flatten_live(payloads(t))


@query("s9_feature_set", with_readings(
    f"""SELECT city, dt, {rn(*GASES, 'temp', 'humidity', 'wind')}, CAST(hour(dt) AS INT) AS hour,
  CAST(month(dt) AS INT) AS month, CAST((dayofweek(dt) + 6) % 7 AS INT) AS day_of_week FROM readings"""))
def features(t):
    return calendar(t.readings).select("city", "dt", *feature_set("nowcast"))
