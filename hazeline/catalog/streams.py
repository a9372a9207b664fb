"""Streaming operators over the events file as a stream, drained to the end."""

from pyspark.sql import functions as F

from hazeline.catalog.base import BREAKS_CTE, OBS_CTE, query, sub_index_sql, with_readings
from hazeline.catalog.learning import complete, scoring_models
from hazeline.catalog.scans import LIVE_CTES, payloads
from hazeline.functions.index import sub_index
from hazeline.plans.forecast import batch_forecast
from hazeline.schema import GASES, WEATHER
from hazeline.sources.fixture import EVENT_GASES, observations
from hazeline.streaming import live as L
from hazeline.streaming import state as S
from hazeline.streaming.run import drain_append, drain_complete, drain_update, event_stream


class _Stream:
    """Stands in for the static tables: ``observations`` is a stream."""

    def __init__(self, t):
        self.observations = observations(event_stream(t.spark, t.folder, "events.parquet", t("events").schema))


def gas_stream(t):
    """Observations with one column per gas; CO comes from k."""
    o = _Stream(t).observations
    cols = [F.expr(f"CASE WHEN event_type = '{kind}' THEN CAST(cents AS DOUBLE) / 100D END AS {g}") for g, kind in EVENT_GASES.items()]
    return o.select("event_id", "city", "ts", *cols, F.expr("CAST(k AS DOUBLE) / 10D AS co"))


_SRC = f"""WITH {OBS_CTE}, src AS (SELECT event_id, city, ts, {', '.join(f"CASE WHEN event_type = '{kind}' THEN cents / 100.0::DOUBLE END AS {g}" for g, kind in EVENT_GASES.items())},
  k / 10.0::DOUBLE AS co FROM obs)"""


@query("t1_stream_nowcast", f"""WITH {', '.join(LIVE_CTES)}, {sub_index_sql('live', 'event_id', GASES)},
w AS (SELECT event_id, max(idx) AS top, {', '.join(f"max(idx) FILTER (WHERE gas = '{g}') AS i_{g}" for g in GASES)} FROM parts GROUP BY event_id)
SELECT l.event_id, l.city, l.ts, round(top, 2) AS aqi, CASE WHEN top <= 50 THEN 'Good' WHEN top <= 100 THEN 'Satisfactory' WHEN top <= 200 THEN 'Moderate'
  WHEN top <= 300 THEN 'Poor' WHEN top <= 400 THEN 'Very Poor' ELSE 'Severe' END AS band,
  CASE WHEN i_pm25 = top THEN 'PM2.5' WHEN i_pm10 = top THEN 'PM10' WHEN i_no2 = top THEN 'NO2' WHEN i_co = top THEN 'CO' WHEN i_so2 = top THEN 'SO2' ELSE 'O3' END AS dominant
FROM live l JOIN w USING (event_id)""")
def nowcast(t):
    out = L.stream_nowcast(payloads(_Stream(t)))
    return drain_append(out.select("event_id", "city", "ts", "aqi", "band", "dominant"), "nowcast")


@query("t2_stream_dedupe", """SELECT DISTINCT 'S' || CAST(user_id % 5 AS VARCHAR) AS city, date_trunc('hour', ts) AS dt FROM events""")
def dedupe(t):
    s = _Stream(t).observations.select("city", F.date_trunc("hour", "ts").alias("dt"))
    return drain_append(L.stream_dedupe(s), "dedupe")


@query("t3_stream_hourly", f"""{_SRC} SELECT city, date_trunc('hour', ts) AS dt, {', '.join(f'round(avg({g}), 9) AS {g}' for g in GASES)} FROM src GROUP BY 1, 2""")
def hourly(t):
    return drain_update(L.stream_hourly(gas_stream(t)), ["city", "dt"], "hourly")


def _rolling_sql(hours):
    cols = ", ".join(f"round(avg({g}), 9) AS {g}_mean_{hours}h, round(max({g}), 9) AS {g}_max_{hours}h" for g in ("co", "pm25"))
    return f"""{_SRC} SELECT city, date_trunc('hour', ts) + to_hours(CAST(i + 1 AS INTEGER)) AS dt, {cols} FROM src, range({hours}) r(i) GROUP BY 1, 2"""


def _rolling(t, hours):
    return drain_update(L.stream_rolling(gas_stream(t), hours, ["co", "pm25"]), ["city", "dt"], "rolling")


@query("t4_stream_rolling_3h", _rolling_sql(3))
def rolling3(t):
    return _rolling(t, 3)


@query("t4_stream_rolling_24h", _rolling_sql(24))
def rolling24(t):
    return _rolling(t, 24)


@query("t5_stream_latest", f"""WITH {OBS_CTE} SELECT city, time_bucket(INTERVAL 15 MINUTE, ts) AS slot, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id,
  arg_max(k, (ts, event_id)) AS k FROM obs GROUP BY 1, 2""")
def latest(t):
    s = _Stream(t).observations.select("city", "ts", "event_id", "k")
    return drain_update(L.stream_latest(s, 900, tie="event_id"), ["city", "slot"], "latest")


@query("t5_stream_expiring", f"""WITH {OBS_CTE}, firsts AS (SELECT city, ts, max(event_id) AS event_id, arg_max(k, event_id) AS k FROM obs GROUP BY city, ts),
nexts AS (SELECT *, lead(ts) OVER (PARTITION BY city ORDER BY ts) AS later, max(ts) OVER () - INTERVAL 15 MINUTE AS mark FROM firsts)
SELECT city, ts, event_id, k, 'expired' AS status FROM nexts WHERE ts + INTERVAL 15 MINUTE <= mark AND (later IS NULL OR later > ts + INTERVAL 15 MINUTE)
UNION ALL SELECT city, ts, event_id, k, 'current' FROM nexts WHERE later IS NULL""")
def expiring(t):
    """Readings that expired without a successor, and the newest of each city."""
    s = _Stream(t).observations.select("city", "ts", "event_id", "k")
    with S.with_store(t.spark):
        out = drain_append(S.stream_expiring(s, 900), "expiring")
    newest = out.filter("status = 'current'").groupBy("city").agg(F.max_by(F.struct(*[c for c in out.columns if c != "city"]), F.struct("ts", "event_id")).alias("r"))
    return out.filter("status = 'expired'").unionByName(newest.select("city", "r.*"))


@query("t6_stream_forecast", with_readings("""SELECT event_id AS request_id, city, 1 AS horizon_hours, 'logistic_regression' AS model, newest AS input_time,
  newest + INTERVAL 1 HOUR AS forecast_for, 'ok' AS status, TRUE AS as_in_batch
FROM obs JOIN (SELECT city, max(dt) AS newest FROM readings GROUP BY city) USING (city) WHERE event_type = 'purchase'"""))
def forecast(t):
    """Live requests answered from the rows kept in state; ``as_in_batch``: the batch plan gives the same prediction."""
    history, models = complete(t), scoring_models(t)
    asked = [F.col("event_id").alias("request_id"), "city", F.lit(None).cast("timestamp").alias("dt"),
             F.create_map(F.lit("co"), F.col("k").cast("string")).alias("features"), F.lit(1).alias("horizon_hours"),
             F.lit("logistic_regression").alias("model")]
    none = [F.lit(None).cast("double").alias(c) for c in [*GASES, *WEATHER]]
    stream = _Stream(t).observations.filter("event_type = 'purchase'").select(*asked, *none)
    with S.with_store(t.spark):
        out = drain_append(S.stream_forecasts(stream, history, models), "scored")
    batch = batch_forecast(t.observations.filter("event_type = 'purchase'").select(*asked), history, models)
    batch = batch.select("request_id", F.col("prediction").alias("p"), F.col("confidence").alias("c"))
    same = F.col("prediction").eqNullSafe(F.col("p")) & F.coalesce(F.abs(F.col("confidence") - F.col("c")) < 1e-9, F.lit(False))
    return out.join(batch, "request_id", "left").select("request_id", "city", "horizon_hours", "model", "input_time", "forecast_for", "status",
                                                        same.alias("as_in_batch"))


@query("t7_bad_air_sessions", f"""WITH {OBS_CTE}, {BREAKS_CTE}, src AS (SELECT event_id, city, ts, cents / 100.0::DOUBLE AS pm25 FROM obs WHERE event_type = 'view'),
{sub_index_sql('src', 'event_id', ['pm25'])}, hits AS (SELECT s.city, s.ts, p.idx FROM src s JOIN parts p USING (event_id) WHERE p.idx >= 200),
marked AS (SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY city ORDER BY ts) + INTERVAL 90 MINUTE THEN 1 ELSE 0 END AS cut FROM hits),
runs AS (SELECT *, sum(cut) OVER (PARTITION BY city ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM marked)
SELECT city, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n, round(max(idx), 9) AS peak FROM runs GROUP BY city, run""")
def sessions(t):
    s = gas_stream(t).filter("pm25 IS NOT NULL").select("city", "ts", sub_index("pm25", "pm25").alias("score"))
    return drain_complete(L.bad_air_sessions(s, "score", 200), "sessions")
