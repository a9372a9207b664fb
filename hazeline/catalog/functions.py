"""Scalar functions and encoders."""

from pyspark.sql import functions as F

from hazeline.catalog.base import BREAKS_CTE, ordinal, query, rn, sub_index_sql, with_readings
from hazeline.catalog.scans import INDEX_CTE
from hazeline.functions import values as V
from hazeline.functions.index import add_index, band, eligible, sub_index
from hazeline.operators.encode import fit_scaling, label_encode, onehot
from hazeline.operators.splits import split_chrono
from hazeline.schema import GASES, LABELS


@query("e1_sub_index", with_readings(
    "SELECT city, dt, gas, round(idx, 9) AS idx FROM fx"))
def sub_indices(t):
    items = F.array(*[F.struct(F.lit(g).alias("gas"), sub_index(g, g).alias("idx")) for g in GASES])
    return t.readings.select("city", "dt", F.inline(items))


@query("e1_sub_index_wide_range", f"""WITH prices AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice / 50.0::DOUBLE AS pm25, l_quantity * 10.0::DOUBLE - 20 AS pm10,
    l_tax * 1000.0::DOUBLE AS no2, l_quantity - 2.0::DOUBLE AS co, l_extendedprice / 50.0::DOUBLE AS so2,
    l_discount * 10000.0::DOUBLE AS o3 FROM lineitem),
{BREAKS_CTE}, {sub_index_sql('prices', 'l_orderkey, l_linenumber', ['pm25', 'pm10', 'no2', 'co', 'so2', 'o3'])}
SELECT l_orderkey, l_linenumber, round(sum(idx), 9) AS idx, round(max(idx), 9) AS top FROM parts GROUP BY ALL""")
def wide_range(t):
    p = t("lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 50).alias("pm25"), (F.col("l_quantity") * 10 - 20).alias("pm10"),
        (F.col("l_tax") * 1000).alias("no2"), (F.col("l_quantity") - 2).cast("double").alias("co"),
        (F.col("l_extendedprice") / 50).alias("so2"), (F.col("l_discount") * 10000).alias("o3"))
    parts = [sub_index(g, g) for g in GASES]
    out = p.select("l_orderkey", "l_linenumber", F.array(*parts).alias("p"))
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    out = out.select("l_orderkey", "l_linenumber", total.alias("s"), F.array_max("p").alias("m"))
    return out.groupBy("l_orderkey", "l_linenumber").agg(F.sum("s").alias("idx"), F.max("m").alias("top"))


@query("e2_e5_overall_index", with_readings(
    "SELECT city, dt, aqi, band, dominant FROM indexed", INDEX_CTE))
def overall(t):
    return add_index(t.readings).select("city", "dt", "aqi", "band", "dominant")


@query("e4_band", with_readings(
    """SELECT city, dt, CASE WHEN i4 <= 50 THEN 'Good' WHEN i4 <= 100 THEN 'Satisfactory' WHEN i4 <= 200 THEN 'Moderate'
  WHEN i4 <= 300 THEN 'Poor' WHEN i4 <= 400 THEN 'Very Poor' ELSE 'Severe' END AS band FROM wide""", INDEX_CTE))
def bands(t):
    return t.readings.select("city", "dt", sub_index("co", "co").alias("i")).select("city", "dt", band("i").alias("band"))


@query("e6_eligible", with_readings(
    """SELECT city, dt, (CAST(pm25 IS NOT NULL AS INT) + CAST(pm10 IS NOT NULL AS INT) + CAST(no2 IS NOT NULL AS INT)
  + CAST(co IS NOT NULL AS INT) + CAST(so2 IS NOT NULL AS INT) + CAST(o3 IS NOT NULL AS INT)) >= 3
  AND (pm25 IS NOT NULL OR pm10 IS NOT NULL) AS eligible FROM readings"""))
def eligibility(t):
    return t.readings.select("city", "dt", eligible().alias("eligible"))


@query("e7_encode_decode", with_readings(
    f"""SELECT city, dt, CAST({ordinal('aqi_category')} AS INT) AS code,
  CASE WHEN hour(dt) = 0 THEN 'Unknown' ELSE aqi_category END AS back FROM readings"""))
def encoded(t):
    df = t.readings.select("city", "dt", V.encode("aqi_category").alias("code"))
    return df.select("city", "dt", "code", V.decode("CASE WHEN hour(dt) = 0 THEN 99 ELSE code END").alias("back"))


@query("e8_label_encode", with_readings(
    "SELECT city, dt, CAST(dense_rank() OVER (ORDER BY aqi_category) - 1 AS INT) AS code FROM readings"))
def alphabetical(t):
    return label_encode(t.readings, "aqi_category", "code").select("city", "dt", "code")


@query("e9_cyclical", with_readings(
    """SELECT city, dt, round(sin(2 * pi() * hour(dt) / 24), 9) + 0 AS hour_sin, round(cos(2 * pi() * hour(dt) / 24), 9) + 0 AS hour_cos,
  round(sin(2 * pi() * (month(dt) - 1) / 12), 9) + 0 AS month_sin, round(cos(2 * pi() * (month(dt) - 1) / 12), 9) + 0 AS month_cos
FROM readings"""))
def cycles(t):
    c = ["hour_sin", "hour_cos", "month_sin", "month_cos"]
    return V.cyclical(t.readings).select("city", "dt", *[(F.round(x, 9) + 0.0).alias(x) for x in c])


@query("e10_calendar", """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
  CAST(day(o_orderdate) AS INT) AS day, CAST(hour(o_orderdate) AS INT) AS hour,
  CAST((dayofweek(o_orderdate) + 6) % 7 AS INT) AS day_of_week FROM orders""")
def calendar_parts(t):
    return V.calendar(t("orders"), "o_orderdate").select("o_orderkey", "year", "month", "day", "hour", "day_of_week")


@query("e11_target_time", "SELECT event_id, ts + to_hours(CAST(event_id % 25 AS INTEGER)) AS target FROM events")
def targets(t):
    return t("events").select("event_id", V.target_time(F.col("ts"), (F.col("event_id") % 25).cast("int")).alias("target"))


@query("e12_scaling", with_readings(
    """SELECT city, dt, round((co - (SELECT avg(co) FROM cutoff)) / (SELECT stddev_pop(co) FROM cutoff), 9) AS co,
  round((humidity - (SELECT avg(humidity) FROM cutoff)) / (SELECT stddev_pop(humidity) FROM cutoff), 9) AS humidity
FROM readings""", """times AS (SELECT dt, row_number() OVER (ORDER BY dt) - 1 AS p, count(*) OVER () AS n
  FROM (SELECT DISTINCT dt FROM readings)), cutoff AS (SELECT * FROM readings WHERE dt <
  (SELECT dt FROM times WHERE p = CAST(floor(n * 0.7::DOUBLE) AS BIGINT)))"""))
def scaled(t):
    split = split_chrono(t.readings)
    fitted = fit_scaling(split.filter("split = 'train'"), ["co", "humidity"])
    return fitted.transform(t.readings.select("city", "dt", "co", "humidity"))


@query("e12_inverse_scaling", with_readings(f"SELECT city, dt, {rn('co', 'humidity')} FROM readings"))
def unscaled(t):
    df = t.readings.select("city", "dt", "co", "humidity")
    s = fit_scaling(df, ["co", "humidity"])
    return s.inverse(s.transform(df))


@query("e13_onehot", with_readings(
    "SELECT city, dt, " + ", ".join(f"CAST(city = 'S{i}' AS INT) AS city_S{i}" for i in range(3)) + ", " +
    ", ".join(f"CAST(aqi_category = '{lab}' AS INT) AS label_{lab}" for lab in LABELS) + " FROM readings"))
def flags(t):
    df = onehot(t.readings.select("city", "dt", "aqi_category"), "city", ["S0", "S1", "S2"])
    return onehot(df, "aqi_category", LABELS, "label").drop("aqi_category")


@query("e15_sentiment_label", """SELECT doc_id, CASE WHEN quality - toxic > 0 THEN 'Positive' WHEN quality - toxic < 0 THEN 'Negative'
  ELSE 'Neutral' END AS sentiment FROM labels""")
def sentiments(t):
    return t("labels").select("doc_id", V.sentiment_label(F.col("quality") - F.col("toxic")).alias("sentiment"))
