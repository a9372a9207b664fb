"""Profiling, cleaning, filters and samples."""

from pyspark.sql import functions as F

from hazeline.catalog.base import query, rn, with_readings
from hazeline.operators import clean as C
from hazeline.operators import filters as FL
from hazeline.operators import profile as P
from hazeline.schema import GASES

_G6 = rn(*GASES)


@query("p1_head_tail", with_readings(
    """SELECT * FROM (SELECT city, dt, round(co, 9) AS co, 'head' AS part FROM readings ORDER BY city, dt LIMIT 5)
UNION ALL SELECT * FROM (SELECT city, dt, round(co, 9) AS co, 'tail' AS part FROM readings ORDER BY city DESC, dt DESC LIMIT 5)"""))
def head_tail(t):
    return P.head_tail(t.readings.select("city", "dt", "co"), ["city", "dt"], 5)


@query("p2_shape", with_readings("SELECT count(*) AS n_rows, 12 AS n_columns FROM readings"))
def shape(t):
    return P.shape(t.readings)


_GROUPS = {"pollutant": GASES, "weather": ["temp", "humidity", "wind"], "time": ["dt"], "target": ["aqi_category"], "others": ["city"]}


@query("p3_categorise", with_readings(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{g}' AS category, count(*) - count({c}) AS missing FROM readings""" for g, cols in _GROUPS.items() for c in cols)))
def categories(t):
    """Category of every column, with its missing values."""
    return P.categorise(t.readings).join(P.null_profile(t.readings).select("column", "missing"), "column")


_COLS = ["city", "dt", *GASES, "temp", "humidity", "wind", "aqi_category"]


@query("p4_null_profile", with_readings(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{'string' if c in ('city', 'aqi_category') else 'timestamp' if c == 'dt' else 'double'}' AS data_type,
  count(*) - count({c}) AS missing FROM readings""" for c in _COLS) + ') ORDER BY missing DESC, "column" LIMIT 10'))
def nulls(t):
    return P.null_profile(t.readings, 10)


def _doubled(t):
    """Readings with copies, a constant column and an empty column."""
    return t.readings.withColumns({"pm25_copy": F.col("pm25"), "humidity_copy": F.col("humidity"), "wind_text": F.col("wind").cast("string"),
                                   "flag": F.lit(1), "blank": F.lit(None).cast("double")})


_DOUBLED = "doubled AS (SELECT *, pm25 AS pm25_copy, humidity AS humidity_copy, 1 AS flag, NULL::DOUBLE AS blank FROM readings)"
_NUMERIC = [*GASES, "temp", "humidity", "wind", "pm25_copy", "humidity_copy", "blank"]


@query("p5_duplicate_columns", with_readings(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, count(*) FILTER (WHERE {a} IS DISTINCT FROM {b}) AS d FROM doubled"
        for i, a in enumerate(_NUMERIC) for b in _NUMERIC[i + 1:]) + ") WHERE d = 0", _DOUBLED).replace(
            "SELECT * FROM (", "SELECT column_a, column_b FROM (", 1))
def duplicates(t):
    return P.duplicate_columns(_doubled(t))


@query("p6_constant_columns", with_readings(
    'SELECT "column" FROM (' + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS d FROM doubled""" for c in [*_COLS, *_NUMERIC[-3:], "flag"]) + ") WHERE d = 1",
    _DOUBLED))
def constants(t):
    return P.constant_columns(_doubled(t))


@query("p7_type_counts", with_readings("SELECT 'numerical' AS kind, 9 AS n_columns, " + " + ".join(
    f"count({c})" for c in [*GASES, "temp", "humidity", "wind"]) + " AS n_values FROM readings UNION ALL "
    "SELECT 'categorical', 3, count(city) + count(dt) + count(aqi_category) FROM readings"))
def types(t):
    """Number of columns per kind, with the values they hold."""
    r = t.readings
    kinds = P.null_profile(r).select(F.when(F.col("data_type") == "double", "numerical").otherwise("categorical").alias("kind"), "missing")
    held = kinds.groupBy("kind").agg((F.count(F.lit(1)) * r.agg(F.count(F.lit(1)).alias("n")).scalar() - F.sum("missing")).alias("n_values"))
    return P.type_counts(r).join(held, "kind")


@query("p8_drop_existing", with_readings(f"SELECT city, dt, {_G6} FROM readings"))
def dropped(t):
    wide = C.drop_useless(t.readings.withColumn("US_AQI", F.lit(1)).withColumn("UV_Index", F.lit(None).cast("double")))
    return C.drop_existing(wide, ["temp", "humidity", "wind", "aqi_category", "not_there"])


@query("p9_drop_duplicate_columns", with_readings(
    f"SELECT {', '.join(['city', 'dt', _G6, rn('temp', 'humidity', 'wind')])}, aqi_category, CAST(wind AS VARCHAR) AS wind_text, "
    "flag, round(blank, 9) AS blank FROM doubled", _DOUBLED))
def deduplicated(t):
    return C.drop_duplicate_columns(_doubled(t))


@query("p10_require", with_readings(f"SELECT city, dt, {_G6} FROM readings WHERE pm25 IS NOT NULL AND o3 IS NOT NULL"))
def required(t):
    return C.require(t.readings.select("city", "dt", *GASES), ["pm25", "o3"])


@query("p11_label_counts", with_readings("SELECT aqi_category, count(*) AS n FROM readings GROUP BY aqi_category"))
def label_counts(t):
    return P.label_counts(t.readings)


@query("p12_allowed_labels", with_readings("SELECT city, dt, aqi_category FROM readings WHERE aqi_category IN ('Good', 'Hazardous')"))
def allowed(t):
    return C.allowed_labels(t.readings.select("city", "dt", "aqi_category"), labels=["Good", "Hazardous"])


def _filled(cols, part):
    def one(c):
        up = f"last_value({c} IGNORE NULLS) OVER ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        down = f"first_value({c} IGNORE NULLS) OVER ({part} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        return f"round(coalesce({up}, {down}), 9) AS {c}"
    return ", ".join(one(c) for c in cols)


@query("p13_fill_city", with_readings(f"SELECT city, dt, {_filled(GASES, 'PARTITION BY city ORDER BY dt')} FROM readings"))
def fill_city(t):
    return C.fill_city(t.readings.select("city", "dt", *GASES), GASES)


@query("p14_fill_global", with_readings(f"SELECT city, dt, {_filled(GASES, 'ORDER BY dt, city')} FROM readings"))
def fill_global(t):
    return C.fill_global(t.readings.select("city", "dt", *GASES), GASES)


def _line(c):
    b = f"(SELECT max(p.dt) FROM readings p WHERE p.city = r.city AND p.dt < r.dt AND p.{c} IS NOT NULL)"
    a = f"(SELECT min(p.dt) FROM readings p WHERE p.city = r.city AND p.dt > r.dt AND p.{c} IS NOT NULL)"
    return f"{b} AS b_{c}, {a} AS a_{c}"


@query("p15_interpolate", with_readings(
    "SELECT e.city, e.dt, " + ", ".join(
        f"""round(coalesce(e.{c}, CASE WHEN epoch(a_{c}) - epoch(b_{c}) <= 4 * 3600 THEN
  bb_{c}.{c} + (aa_{c}.{c} - bb_{c}.{c}) * (epoch(e.dt) - epoch(b_{c})) / (epoch(a_{c}) - epoch(b_{c})) END), 9) AS {c}""" for c in ("pm25", "o3")) +
    " FROM ends e " + " ".join(
        f"LEFT JOIN readings bb_{c} ON bb_{c}.city = e.city AND bb_{c}.dt = b_{c} LEFT JOIN readings aa_{c} ON aa_{c}.city = e.city AND aa_{c}.dt = a_{c}"
        for c in ("pm25", "o3")),
    f"ends AS (SELECT city, dt, pm25, o3, {_line('pm25')}, {_line('o3')} FROM readings r)"))
def interpolated(t):
    return C.interpolate(t.readings.select("city", "dt", "pm25", "o3"), ["pm25", "o3"], 3)


@query("p16_median_fill", with_readings(
    "SELECT r.city, r.dt, " + ", ".join(f"round(coalesce(r.{c}, m.{c}), 9) AS {c}" for c in ("pm25", "so2")) +
    " FROM readings r JOIN med m ON m.city = r.city AND m.m = month(r.dt)",
    "med AS (SELECT city, month(dt) AS m, quantile_cont(pm25, 0.5) AS pm25, quantile_cont(so2, 0.5) AS so2 FROM readings GROUP BY ALL)"))
def medians(t):
    return C.median_fill(t.readings.select("city", "dt", "pm25", "so2"), ["pm25", "so2"])


@query("p17_coerce", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(round(value * 100) AS BIGINT) / 100.0::DOUBLE WHEN 1 THEN -1 WHEN 2 THEN -1 ELSE -1 END AS v
FROM events""")
def coerced(t):
    k = F.col("event_id") % 4
    text = F.when(k == 0, (F.round(F.col("value") * 100).cast("bigint") / 100).cast("string")).when(k == 1, "").when(k == 2, "n/a")
    from hazeline.functions.values import coerce

    return t("events").select("event_id", coerce(text, -1.0).alias("v"))


@query("p18_dedupe_ts", """WITH s AS (SELECT 'S' || CAST(user_id % 5 AS VARCHAR) AS city, date_trunc('hour', ts) AS dt, event_id, event_type,
  row_number() OVER (PARTITION BY user_id % 5, date_trunc('hour', ts) ORDER BY event_id) AS rn FROM events)
SELECT city, dt, event_id, event_type FROM s WHERE rn = 1""")
def dedupe(t):
    o = t.observations.select("city", F.date_trunc("hour", "ts").alias("dt"), "event_id", "event_type")
    return C.dedupe_ts(o, ["city", "dt"], ["event_id"])


@query("p19_audit_report", with_readings(
    f"""SELECT coalesce(s.measure, a.measure) AS measure,
  round(CASE WHEN s.measure LIKE 'accuracy%' AND s.v > 1 THEN s.v / 100 ELSE s.v END, 9) AS stored_value, round(a.v, 9) AS actual_value,
  CASE WHEN a.measure IS NULL THEN 'not_recomputed' WHEN s.measure IS NULL THEN 'not_stored'
    WHEN abs(s.v - a.v) <= 1e-6 * greatest(1.0, abs(a.v)) THEN 'ok' ELSE 'differs' END AS status
FROM stored s FULL JOIN actual a ON a.measure = s.measure""",
    """actual AS (SELECT 'label:' || aqi_category AS measure, CAST(count(*) AS DOUBLE) AS v FROM readings GROUP BY 1
  UNION ALL SELECT 'rows', CAST(count(*) AS DOUBLE) FROM readings UNION ALL SELECT 'mean:co', avg(co) FROM readings),
stored AS (SELECT 'rows' AS measure, CAST(count(*) AS DOUBLE) AS v FROM readings UNION ALL SELECT 'mean:co', avg(co) + 1 FROM readings
  UNION ALL SELECT 'label:Good', CAST(count(*) AS DOUBLE) FROM readings WHERE aqi_category = 'Good'
  UNION ALL SELECT 'accuracy:x', CAST(86 AS DOUBLE))"""))
def audit(t):
    r = t.readings
    agg = r.agg(F.count(F.lit(1)).cast("double").alias("n"), (F.avg("co") + 1).alias("m"),
                F.count_if(F.col("aqi_category") == "Good").cast("double").alias("g"))
    stored = agg.selectExpr("inline(array(named_struct('measure', 'rows', 'stored_value', n), named_struct('measure', 'mean:co', 'stored_value', m), "
                            "named_struct('measure', 'label:Good', 'stored_value', g), named_struct('measure', 'accuracy:x', 'stored_value', 86D)))")
    return P.audit_report(r, stored, means=["co"])


@query("p20_missing_features", with_readings(
    """SELECT * FROM (VALUES ('nh3', 'absent'), ('blank', 'all_null')) v(feature, status)
UNION ALL SELECT 'pm25', 'some_null' FROM doubled HAVING count(pm25) < count(*)
UNION ALL SELECT 'co', 'some_null' FROM doubled HAVING count(co) < count(*)""", _DOUBLED))
def missing(t):
    return P.missing_features(_doubled(t), ["pm25", "co", "blank", "nh3"])


@query("f1_slice", with_readings("SELECT city, dt, round(co, 9) AS co FROM readings WHERE city = 'S1' AND month(dt) = 1"))
def sliced(t):
    return FL.slice_readings(t.readings.select("city", "dt", "co"), "S1", 1)


@query("f1_slice_all", with_readings("SELECT city, dt, round(co, 9) AS co FROM readings"))
def unsliced(t):
    return FL.slice_readings(t.readings.select("city", "dt", "co"), "ALL", "ALL")


@query("f2_validate_slice", """WITH req AS (SELECT user_id, CASE WHEN user_id % 7 = 0 THEN 'ALL' ELSE 'S' || CAST(user_id % 8 AS VARCHAR) END AS city,
  CASE WHEN user_id % 5 = 0 THEN 'ALL' WHEN user_id % 5 = 1 THEN 'x' ELSE CAST(user_id % 15 AS VARCHAR) END AS month FROM (SELECT DISTINCT user_id FROM events)),
known AS (SELECT DISTINCT 'S' || CAST(user_id % 5 AS VARCHAR) AS city FROM events),
judged AS (SELECT *, CASE WHEN city <> 'ALL' AND city NOT IN (SELECT city FROM known) THEN 'unknown city'
  WHEN month <> 'ALL' AND coalesce(TRY_CAST(month AS INTEGER) NOT BETWEEN 1 AND 12, true) THEN 'invalid month' END AS reason FROM req)
SELECT * FROM judged WHERE reason IS NOT NULL""")
def validated(t):
    u = t("events").select("user_id").distinct()
    req = u.selectExpr("user_id", "CASE WHEN user_id % 7 = 0 THEN 'ALL' ELSE concat('S', user_id % 8) END AS city",
                       "CASE WHEN user_id % 5 = 0 THEN 'ALL' WHEN user_id % 5 = 1 THEN 'x' ELSE string(user_id % 15) END AS month")
    return FL.validate_slice(t.readings, req)


@query("f3_recent", """SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 18 MONTH""")
def recent(t):
    return FL.recent(t("orders").select("o_orderkey", "o_orderdate"), 18, "o_orderdate")


@query("f4_city_or_all", with_readings(
    "SELECT city, dt, 'found' AS kind FROM readings WHERE city = 'S2' UNION ALL SELECT city, dt, 'all' FROM readings"))
def city_or_all(t):
    r = t.readings.select("city", "dt")
    return (FL.city_or_all(r, "s2").withColumn("kind", F.lit("found"))
            .unionByName(FL.city_or_all(r, "nowhere").withColumn("kind", F.lit("all"))))


@query("f5_min_rows", with_readings("SELECT city, dt FROM readings WHERE aqi_category = 'Moderate' AND "
                                    "(SELECT count(*) FROM readings WHERE aqi_category = 'Moderate') >= 10"))
def min_rows(t):
    r = t.readings.select("city", "dt", "aqi_category")
    few = FL.min_rows(r.filter("aqi_category = 'Hazardous' and city = 'S0' and dt < timestamp'2020-01-01'"), 10)
    return FL.min_rows(r.filter("aqi_category = 'Moderate'"), 10).unionByName(few).select("city", "dt")


@query("f6_cities", with_readings("SELECT DISTINCT city FROM readings ORDER BY city"))
def cities(t):
    return FL.cities(t.readings)


@query("f7_sample_n", with_readings(
    """SELECT city, dt FROM readings ORDER BY md5('42|' || city || '|' || strftime(dt, '%Y-%m-%d %H:%M:%S')), city, dt LIMIT 500"""))
def sample(t):
    return FL.sample_n(t.readings.select("city", "dt"), 500, 42, ["city", "dt"])


@query("f8_sample_strat", with_readings(
    """SELECT r.city, r.dt, r.aqi_category FROM (SELECT *, row_number() OVER (PARTITION BY aqi_category
  ORDER BY md5('7|' || city || '|' || strftime(dt, '%Y-%m-%d %H:%M:%S'))) AS rn FROM readings) r JOIN quota q USING (aqi_category) WHERE rn <= q.quota""",
    """shares AS (SELECT aqi_category, 600 * n // total AS base, 600 * n % total AS rest FROM (
  SELECT aqi_category, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM readings GROUP BY aqi_category)),
quota AS (SELECT aqi_category, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, aqi_category) <= 600 - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM shares)"""))
def strat(t):
    return FL.sample_strat(t.readings.select("city", "dt", "aqi_category"), 600, "aqi_category", 7, ["city", "dt"])


@query("f9_tail_before", with_readings(
    """SELECT city, dt, round(co, 9) AS co FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY dt DESC) AS rn
  FROM readings WHERE dt < TIMESTAMP '2024-01-15 00:00:00') WHERE rn <= 48"""))
def tail(t):
    return FL.tail_before(t.readings.select("city", "dt", "co"), "2024-01-15 00:00:00", 48)
