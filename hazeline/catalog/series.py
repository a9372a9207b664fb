"""Time-series windows, splits and weights."""

from pyspark.sql import functions as F

from hazeline.catalog.base import ordinal, plain, query, with_readings
from hazeline.functions.values import encode
from hazeline.operators import splits as S
from hazeline.operators import windows as W
from hazeline.operators.joins import asof_history
from hazeline.operators.panel import chunked, own_rows
from hazeline.operators.summary import trend
from hazeline.schema import GASES, HORIZONS, LAG_STEPS, ROLL_WIDTHS

_W = "PARTITION BY city ORDER BY dt"


@query("w1_lags", with_readings("SELECT city, dt, " + ", ".join(
    f"round(lag({c}, {k}) OVER ({_W}), 9) AS {c}_lag_{k}h" for c in GASES for k in LAG_STEPS) + " FROM readings"))
def lags(t):
    return W.lags(t.readings.select("city", "dt", *GASES)).drop(*GASES)


def _roll(c, n, f, kind):
    frame = f"({_W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"round(CASE WHEN count({c}) OVER {frame} >= {max(2, n // 2)} THEN {f}({c}) OVER {frame} END, 9) AS {c}_roll_{kind}_{n}h"


@query("w2_roll_mean", with_readings("SELECT city, dt, " + ", ".join(
    _roll(c, n, "avg", "mean") for c in GASES for n in ROLL_WIDTHS) + " FROM readings"))
def roll_mean(t):
    return W.rolls(t.readings.select("city", "dt", *GASES), kinds=("mean",)).drop(*GASES)


@query("w3_roll_max", with_readings("SELECT city, dt, " + ", ".join(
    _roll(c, n, "max", "max") for c in GASES for n in ROLL_WIDTHS) + " FROM readings"))
def roll_max(t):
    return W.rolls(t.readings.select("city", "dt", *GASES), kinds=("max",)).drop(*GASES)


@query("w1_w3_chunk_edges", with_readings("SELECT city, dt, " + ", ".join(
    [f"round(lag({c}, {k}) OVER ({_W}), 9) AS {c}_lag_{k}h" for c in ("co", "pm25") for k in LAG_STEPS]
    + [_roll(c, n, f, kind) for c in ("co", "pm25") for n in ROLL_WIDTHS for f, kind in (("avg", "mean"), ("max", "max"))])
    + " FROM readings"))
def chunk_edges(t):
    """The same features with chunks so short that every city is cut many times."""
    base = chunked(t.readings.select("city", "dt", "co", "pm25"), 24, 0, rows=50)
    new = {**W.lag_columns(["co", "pm25"]), **W.roll_columns(["co", "pm25"])}
    return own_rows(base.select("*", *[e.alias(n) for n, e in new.items()])).drop("co", "pm25")


@query("w1_time_lags", with_readings(
    "SELECT r.city, r.dt, round(p.co, 9) AS co_at_6h FROM readings r LEFT JOIN readings p ON p.city = r.city AND p.dt = r.dt - INTERVAL 6 HOUR"))
def time_lags(t):
    return W.time_lags(t.readings.select("city", "dt", "co"), ["co"], 6).drop("co")


@query("w4_w5_lead_label", with_readings(
    f"""SELECT city, dt, lead(aqi_category, 4) OVER ({_W}) AS target_category,
  coalesce(lead(dt, 4) OVER ({_W}) = dt + INTERVAL 4 HOUR, false) AS exact FROM readings"""))
def lead_label(t):
    return W.lead_label(t.readings.select("city", "dt", "aqi_category"), 4).drop("aqi_category")


@query("w6_forecast_frame", with_readings(
    "SELECT city, dt, round(co, 9) AS co, horizon_hours, target_category, CAST(target AS INT) AS target FROM (" + " UNION ALL ".join(
        f"""SELECT city, dt, co, pm25, {h} AS horizon_hours, lead(aqi_category, {h}) OVER ({_W}) AS target_category,
  lead({ordinal('aqi_category')}, {h}) OVER ({_W}) AS target, lead(dt, {h}) OVER ({_W}) AS tdt FROM readings""" for h in HORIZONS)
    + ") WHERE tdt = dt + to_hours(horizon_hours) AND target IS NOT NULL AND pm25 IS NOT NULL"))
def forecast_frame(t):
    f = W.forecast_frame(t.readings.select("city", "dt", "co", "pm25", "aqi_category"), HORIZONS, ["co", "pm25"])
    return f.select("city", "dt", "co", "horizon_hours", "target_category", "target")


def _sequence_sql(source, part, length, h, cols, keys):
    arms = ", ".join(f"lag({c}, {length} - step) OVER w AS {c}" for c in cols)
    return f"""SELECT {keys}, dt, step, target, {', '.join(f'round({c}, 4) AS {c}' for c in cols)} FROM (
  SELECT {keys}, dt, step, {arms}, lead({ordinal('aqi_category')}, {h}) OVER w AS target,
    row_number() OVER w AS rn FROM {source}, range(1, {length} + 1) s(step)
  WINDOW w AS (PARTITION BY {part}, step ORDER BY dt)) WHERE rn >= {length} AND target IS NOT NULL"""


_SEQ = ["co", "humidity", "temp"]


def _exploded(seq, keys, cols):
    out = seq.select(*keys, "dt", "target", F.posexplode("sequence").alias("p", "v"))
    return out.select(*keys, "dt", "target", (F.col("p") + 1).alias("step"),
                      *[F.round(F.col("v")[i].cast("double"), 4).alias(c) for i, c in enumerate(cols)])


@query("w7_sequences", with_readings(_sequence_sql("readings", "city", 12, 4, _SEQ, "city")), digits=None)
def sequences(t):
    base = t.readings.select("city", "dt", "aqi_category", *_SEQ)
    return plain(_exploded(W.sequences(base, _SEQ, 12, 4), ["city"], _SEQ))


@query("w8_split_sequences", with_readings(
    _sequence_sql("parts", "city, split", 24, 1, ["co", "humidity"], "city, split"),
    """parts AS (SELECT *, CASE WHEN p < floor(0.7::DOUBLE * n) THEN 'train' WHEN p < floor(0.8::DOUBLE * n) THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY dt) - 1 AS p, count(*) OVER (PARTITION BY city) AS n FROM readings))"""),
    digits=None)
def split_sequences(t):
    df = S.split_position(t.readings.select("city", "dt", "aqi_category", "co", "humidity"), by=["city"])
    return plain(_exploded(W.sequences(df, ["co", "humidity"], 24, 1, by=["city", "split"]), ["city", "split"], ["co", "humidity"]))


def requests(t):
    """One forecast request per purchase, some overriding the current CO value."""
    return t.observations.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("request_id"), "city", F.col("ts").alias("dt"),
        F.when(F.col("event_id") % 3 == 0, F.create_map(F.lit("co"), F.col("k").cast("string")))
        .when(F.col("event_id") % 3 == 1, F.create_map(F.lit("co"), F.lit("bad"))).alias("features"))


_REQ = """req AS (SELECT event_id AS request_id, city, ts AS dt, CASE WHEN event_id % 3 = 0 THEN CAST(k AS DOUBLE) END AS over_co
  FROM obs WHERE event_type = 'purchase'),
newest AS (SELECT city, arg_max(co, dt) AS co, arg_max(humidity, dt) AS humidity FROM readings GROUP BY city),
hist AS (SELECT q.request_id, r.dt AS rdt, r.co, r.humidity, r.pm25, row_number() OVER (PARTITION BY q.request_id ORDER BY r.dt DESC) AS rn
  FROM req q JOIN readings r ON r.city = q.city AND r.dt < q.dt)"""


@query("j1_asof_history", with_readings(
    """SELECT q.request_id, q.city, q.dt, count(h.rn) AS have, max(h.rdt) AS last_dt, round(max(h.co) FILTER (WHERE h.rn = 1), 9) AS last_co,
  round(avg(h.co), 9) AS mean_co FROM req q LEFT JOIN hist h ON h.request_id = q.request_id AND h.rn <= 5 GROUP BY ALL""", _REQ))
def asof(t):
    out = asof_history(requests(t).drop("features"), t.readings.select("city", "dt", "co"), 5, ["co"])
    h = F.col("history")
    total = F.aggregate(h, F.lit(0.0), lambda a, x: a + x["co"])
    n = F.when(h.isNotNull(), F.size(h)).otherwise(0)
    return out.select("request_id", "city", "dt", n.cast("bigint").alias("have"), F.try_element_at(h, F.lit(-1))["dt"].alias("last_dt"),
                      F.try_element_at(h, F.lit(-1))["co"].alias("last_co"), (total / F.size(h)).alias("mean_co"))


def _serve_sql():
    out = ["coalesce(q.over_co, n.co) AS co"]
    for k in (1, 6, 24):
        out.append(f"""CASE WHEN count(h.rn) >= {k} THEN max(h.co) FILTER (WHERE h.rn = {k}) ELSE coalesce(q.over_co, n.co) END AS co_lag_{k}h""")
    for w in (3, 24):
        out += [f"avg(h.co) FILTER (WHERE h.rn <= {w}) AS co_roll_mean_{w}h", f"max(h.co) FILTER (WHERE h.rn <= {w}) AS co_roll_max_{w}h"]
    return ", ".join(f"round({o.rsplit(' AS ', 1)[0]}, 9) AS {o.rsplit(' AS ', 1)[1]}" for o in out)


@query("w9_serve_features", with_readings(
    f"""SELECT q.request_id, q.city, q.dt, {_serve_sql()} FROM req q JOIN newest n ON n.city = q.city
LEFT JOIN both_hist h ON h.request_id = q.request_id GROUP BY q.request_id, q.city, q.dt, q.over_co, n.co""", _REQ,
    """late AS (SELECT q.request_id, r.dt AS rdt, r.co, row_number() OVER (PARTITION BY q.request_id ORDER BY r.dt DESC) AS rn
  FROM req q JOIN readings r ON r.city = q.city WHERE q.request_id NOT IN (SELECT request_id FROM hist)),
both_hist AS (SELECT request_id, rdt, co, rn FROM hist WHERE rn <= 48 UNION ALL SELECT request_id, rdt, co, rn FROM late WHERE rn <= 48)"""))
def serve(t):
    return W.serve_features(requests(t), t.readings.select("city", "dt", "co"), ["co"], [1, 6, 24], [3, 24])


@query("w10_serve_sequence", with_readings(
    """SELECT request_id, city, dt, step, step_dt AS step_time,
  round(coalesce(last_value(pm25 IGNORE NULLS) OVER (u ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(pm25 IGNORE NULLS) OVER (u ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 9) AS pm25, round(co, 9) AS co
FROM (SELECT q.request_id, q.city, q.dt, 11 - h.rn AS step, h.rdt AS step_dt, h.pm25, h.co FROM req q JOIN pick h ON h.request_id = q.request_id
  UNION ALL SELECT q.request_id, q.city, q.dt, 11, q.dt, n.pm25, coalesce(q.over_co, n.co)
  FROM req q JOIN (SELECT DISTINCT ON (city) city, pm25, co FROM readings ORDER BY city, dt DESC) n ON n.city = q.city)
WINDOW u AS (PARTITION BY request_id ORDER BY step)""".replace("OVER (u ROWS", "OVER (PARTITION BY request_id ORDER BY step ROWS").replace(
        "WINDOW u AS (PARTITION BY request_id ORDER BY step)", ""), _REQ,
    """enough AS (SELECT request_id FROM hist GROUP BY request_id HAVING count(*) >= 11),
pick AS (SELECT request_id, rn, rdt, pm25, co FROM hist WHERE rn <= 11 AND request_id IN (SELECT request_id FROM enough)
  UNION ALL SELECT * FROM (SELECT q.request_id, row_number() OVER (PARTITION BY q.request_id ORDER BY r.dt DESC) AS rn, r.dt AS rdt, r.pm25, r.co
    FROM req q JOIN readings r ON r.city = q.city WHERE q.request_id NOT IN (SELECT request_id FROM enough)) WHERE rn <= 11)"""))
def serve_sequence(t):
    return W.serve_sequence(requests(t), t.readings.select("city", "dt", "pm25", "co"), ["pm25", "co"])


@query("w11_timeline", with_readings(
    """SELECT dt, round(pm25, 9) AS pm25, round(co, 9) AS co, aqi_category FROM readings WHERE city = 'S3' AND pm25 IS NOT NULL AND co IS NOT NULL
ORDER BY dt DESC LIMIT 24"""))
def timeline(t):
    return W.timeline(t.readings.select("city", "dt", "pm25", "co", "aqi_category"), "s3", 24, ["pm25", "co"]).select("dt", "pm25", "co", "aqi_category")


@query("w12_smooth", with_readings(
    f"""SELECT hour, round(v, 9) AS avg_aqi_score, round(avg(v) OVER (ORDER BY hour ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 9) AS avg_aqi_score_smooth
FROM (SELECT CAST(hour(dt) AS INT) AS hour, avg({ordinal('aqi_category')}) AS v FROM readings GROUP BY 1)"""))
def smooth(t):
    return W.smooth(trend(t.readings, "hour"), "hour", "avg_aqi_score")


_TIMES = """times AS (SELECT dt, row_number() OVER (ORDER BY dt) - 1 AS p, count(*) OVER () AS n FROM (SELECT DISTINCT dt FROM readings)),
cuts AS (SELECT max(dt) FILTER (WHERE p = CAST(floor(0.7::DOUBLE * n) AS BIGINT)) AS a, max(dt) FILTER (WHERE p = CAST(floor(0.85::DOUBLE * n) AS BIGINT)) AS b FROM times)"""


@query("m1_split_chrono", with_readings(
    "SELECT city, r.dt, CASE WHEN r.dt < a THEN 'train' WHEN r.dt < b THEN 'validation' ELSE 'test' END AS split FROM readings r, cuts", _TIMES))
def chrono(t):
    return S.split_chrono(t.readings.select("city", "dt"))


_KEY = "city || '|' || strftime(dt, '%Y-%m-%d %H:%M:%S')"


@query("m2_split_strat", with_readings(
    f"""SELECT city, dt, aqi_category, CASE WHEN rn <= round(0.8::DOUBLE * n) THEN 'train' ELSE 'test' END AS split FROM (
  SELECT *, row_number() OVER (PARTITION BY aqi_category ORDER BY md5('42|' || {_KEY})) AS rn, count(*) OVER (PARTITION BY aqi_category) AS n FROM readings)"""))
def strat(t):
    return S.split_strat(t.readings.select("city", "dt", "aqi_category"), "aqi_category", 0.8, 42, ["city", "dt"])


@query("m3_split_random", with_readings(
    f"SELECT city, dt, CASE WHEN substr(md5('42|' || {_KEY}), 1, 5) < 'ccccc' THEN 'train' ELSE 'test' END AS split FROM readings"))
def random(t):
    return S.split_random(t.readings.select("city", "dt"), 0.8, 42, ["city", "dt"])


@query("m4_split_position", with_readings(
    """SELECT city, dt, CASE WHEN p < floor(0.7::DOUBLE * n) THEN 'train' WHEN p < floor(0.8::DOUBLE * n) THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY dt) - 1 AS p, count(*) OVER () AS n FROM readings WHERE city = 'S1')"""))
def position(t):
    return S.split_position(t.readings.filter("city = 'S1'").select("city", "dt"))


@query("m5_city_holdout", with_readings(
    """SELECT city, dt, CASE WHEN p < floor(0.8::DOUBLE * n) THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY city, dt) - 1 AS p, count(*) OVER () AS n FROM readings)"""))
def holdout(t):
    return S.city_holdout(t.readings.select("city", "dt"))


@query("m6_class_weights", with_readings(
    f"""SELECT CAST(l.i AS INT) AS y, coalesce(n, 0) AS n, round(coalesce(total / (k * n), 1.0), 9) AS weight FROM range(8) l(i)
LEFT JOIN (SELECT y, count(*) AS n, sum(count(*)) OVER () AS total, count(*) OVER () AS k FROM (SELECT {ordinal('aqi_category')} AS y FROM readings)
  GROUP BY y) c ON c.y = l.i"""))
def weights(t):
    return S.class_weights(t.readings.select(encode("aqi_category").alias("y")), "y", list(range(8)))


@query("m6_balanced_weights", with_readings(
    """SELECT city, dt, round(CAST(count(*) OVER () AS DOUBLE) / ((SELECT count(DISTINCT aqi_category) FROM readings) * count(*) OVER (PARTITION BY aqi_category)), 9) AS weight
FROM readings"""))
def row_weights(t):
    return S.balanced_weights(t.readings.select("city", "dt", "aqi_category"), "aqi_category").drop("aqi_category")
