"""Exploratory summaries and rankings."""

from pyspark.sql import functions as F

from hazeline.catalog.base import ordinal, query, rn, with_readings
from hazeline.operators import summary as A
from hazeline.operators import topk as K
from hazeline.operators.sets import labels_present
from hazeline.schema import GASES, LABELS

_Y = ordinal("aqi_category")
_SCORED = f"scored AS (SELECT *, {_Y} AS y FROM readings)"


@query("a1_distribution", with_readings(
    "SELECT aqi_category, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 9) AS percent FROM readings GROUP BY aqi_category"))
def distribution(t):
    return A.distribution(t.readings)


def _summary(key):
    return f"""SELECT {key}, CAST(sum(n) AS BIGINT) AS records, round(sum(y * n) / CAST(sum(n) AS DOUBLE), 9) AS avg_aqi_score,
  arg_max(aqi_category, n * 100 - y) AS dominant_category FROM cells GROUP BY {key}"""


@query("a2_city_summary", with_readings(_summary("city"), f"cells AS (SELECT city, aqi_category, {_Y} AS y, count(*) AS n FROM readings GROUP BY ALL)"))
def city_summary(t):
    return A.city_summary(t.readings)


@query("a3_month_summary", """WITH o AS (SELECT CAST(month(o_orderdate) AS INT) AS month,
  CASE o_orderstatus WHEN 'F' THEN 'Good' WHEN 'O' THEN 'Moderate' ELSE 'Hazardous' END AS lab,
  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 5 END AS y FROM orders), cells AS (SELECT month, lab, y, count(*) AS n FROM o GROUP BY ALL)
SELECT month, CAST(sum(n) AS BIGINT) AS records, round(sum(y * n) / CAST(sum(n) AS DOUBLE), 9) AS avg_aqi_score,
  arg_max(lab, n * 100 - y) AS dominant_category FROM cells GROUP BY month""")
def month_summary(t):
    o = t("orders").selectExpr("o_orderdate AS dt", "CASE o_orderstatus WHEN 'F' THEN 'Good' WHEN 'O' THEN 'Moderate' ELSE 'Hazardous' END AS lab")
    return A.month_summary(o, label="lab")


@query("a4_dominant_label", with_readings(
    "SELECT hour, arg_max(aqi_category, n * 100 - y) AS dominant_category FROM cells GROUP BY hour",
    f"cells AS (SELECT CAST(hour(dt) AS INT) AS hour, aqi_category, {_Y} AS y, count(*) AS n FROM readings GROUP BY ALL)"))
def dominant(t):
    return A.dominant_label(t.readings.withColumn("hour", F.hour("dt")), ["hour"])


_SERIES = "SELECT strftime(dt, '%Y-%m-%d %H:%M') AS timestamp, round(avg(y), 9) AS aqi_score, " + ", ".join(
    f"round(avg({c}), 9) AS {c}" for c in GASES)


@query("a5_raw_series", with_readings(f"{_SERIES} FROM scored GROUP BY dt", _SCORED))
def raw_series(t):
    return A.stamp(A.raw_series(t.readings))


@query("a6_downsample", with_readings(
    f"""SELECT timestamp, aqi_score, {', '.join(GASES)} FROM numbered WHERE n <= 400 OR p IN (SELECT CAST(floor(i * (n - 1) / 399) AS BIGINT)
  FROM (SELECT DISTINCT n FROM numbered), range(400) r(i))""", _SCORED,
    f"numbered AS (SELECT *, row_number() OVER (ORDER BY timestamp) - 1 AS p, count(*) OVER () AS n FROM ({_SERIES} FROM scored GROUP BY dt))"))
def downsample(t):
    return A.stamp(A.downsample(A.raw_series(t.readings), 400))


def _trend(part, name):
    return with_readings(f"SELECT CAST({part} AS INT) AS {name}, round(avg(y), 9) AS avg_aqi_score FROM scored GROUP BY 1", _SCORED)


@query("a7_trend_hour", _trend("hour(dt)", "hour"))
def trend_hour(t):
    return A.trend(t.readings, "hour")


@query("a7_trend_month", _trend("month(dt)", "month"))
def trend_month(t):
    return A.trend(t.readings, "month")


@query("a7_trend_weekday", _trend("(dayofweek(dt) + 6) % 7", "day_of_week"))
def trend_weekday(t):
    return A.trend(t.readings, "day_of_week")


@query("a8_trend_sd", with_readings(
    """SELECT CAST(hour(dt) AS INT) AS hour, round(avg(y), 9) AS mean, round(stddev_samp(y), 9) AS sd,
  round(avg(y) - stddev_samp(y), 9) AS low, round(avg(y) + stddev_samp(y), 9) AS high FROM scored GROUP BY 1""", _SCORED))
def trend_sd(t):
    return A.trend_sd(t.readings)


@query("a9_daily", """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 5 END AS y FROM orders), span AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM o)
SELECT span.day, round(avg(y), 9) AS avg_aqi_score FROM span LEFT JOIN o ON o.day = span.day GROUP BY span.day""")
def daily(t):
    o = t("orders").selectExpr("o_orderdate AS dt", "CASE o_orderstatus WHEN 'F' THEN 'Good' WHEN 'O' THEN 'Moderate' ELSE 'Hazardous' END AS lab")
    return A.daily(o, label="lab")


def _bins(source, col, k):
    return f"""SELECT b.bin, round(lo + b.bin * w, 9) AS low, round(lo + (b.bin + 1) * w, 9) AS high, count(c.x) AS n FROM (SELECT range AS bin FROM range({k})) b
CROSS JOIN (SELECT min({col}) AS lo, (max({col}) - min({col})) / {k} AS w FROM {source}) e
LEFT JOIN (SELECT least(CAST(floor(({col} - (SELECT min({col}) FROM {source})) / ((SELECT max({col}) - min({col}) FROM {source}) / {k})) AS BIGINT), {k - 1}) AS x
  FROM {source} WHERE {col} IS NOT NULL) c ON c.x = b.bin GROUP BY ALL"""


@query("a10_histogram_50", with_readings(_bins("readings", "pm25", 50)))
def histogram50(t):
    return A.histogram(t.readings, "pm25", 50)


@query("a10_histogram_60", _bins("lineitem", "l_extendedprice", 60))
def histogram60(t):
    return A.histogram(t("lineitem"), "l_extendedprice", 60)


@query("a11_density_histogram", """SELECT l_returnflag, bin, n, round(n / (sum(n) OVER (PARTITION BY l_returnflag) * w), 9) AS density FROM (
  SELECT l_returnflag, least(CAST(floor((l_extendedprice - lo) / w) AS BIGINT), 49) AS bin, count(*) AS n, any_value(w) AS w
  FROM lineitem, (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 50 AS w FROM lineitem) GROUP BY ALL)""")
def density(t):
    return A.density_histogram(t("lineitem"), "l_extendedprice", 50, "l_returnflag")


@query("a12_kde", with_readings(
    """SELECT CAST(i AS INT) AS i, round(lo + i * (hi - lo) / 199, 9) AS x,
  round(sum(c.n * exp(-power((lo + i * (hi - lo) / 199 - mid) / bw, 2) / 2) / (s.n * bw * sqrt(2 * pi()))), 9) AS density
FROM range(200) g(i), stats s, bins c GROUP BY i, lo, hi""",
    """stats AS (SELECT count(pm25) AS n, min(pm25) AS lo, max(pm25) AS hi, stddev_samp(pm25) * power(count(pm25)::DOUBLE, -0.2) AS bw FROM readings),
bins AS (SELECT ((lo + b * (hi - lo) / 512) + (lo + (b + 1) * (hi - lo) / 512)) / 2 AS mid, h.n FROM stats, (SELECT least(CAST(floor((pm25 - lo) / ((hi - lo) / 512)) AS BIGINT), 511) AS b,
  count(*) AS n FROM readings, (SELECT lo, hi FROM stats) WHERE pm25 IS NOT NULL GROUP BY 1) h)"""))
def kde(t):
    return A.kde(t.readings, "pm25")


def _box(source, cols, by):
    keys = "".join(f"{b}, " for b in by)
    longs = " UNION ALL ".join(f"SELECT {keys}'{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM {source} WHERE {c} IS NOT NULL" for c in cols)
    on = " AND ".join(f"q.{k} = l.{k}" for k in [*by, "feature"])
    groups = ", ".join(f"l.{k}" for k in [*by, "feature"])
    inside = "l.v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return f"""SELECT {groups}, max(q.n) AS n, round(max(q1), 9) AS q1, round(max(median), 9) AS median, round(max(q3), 9) AS q3,
  round(min(l.v) FILTER (WHERE {inside}), 9) AS low, round(max(l.v) FILTER (WHERE {inside}), 9) AS high, count(*) FILTER (WHERE NOT ({inside})) AS outliers
FROM l JOIN q ON {on} GROUP BY {groups}""", f"""l AS ({longs}),
q AS (SELECT {keys}feature, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM l GROUP BY ALL)"""


_B0 = _box("readings", GASES, [])


@query("a13_box_stats", with_readings(_B0[0], _B0[1]))
def box(t):
    return A.box_stats(t.readings, GASES)


_B1 = _box("readings", GASES, ["aqi_category"])


@query("a14_box_by_label", with_readings(_B1[0], _B1[1]))
def box_by_label(t):
    return A.box_stats(t.readings, GASES, ["aqi_category"])


_B2 = _box("lineitem", ["l_extendedprice", "l_quantity"], ["l_returnflag"])


@query("a14_box_lineitem", "WITH " + _B2[1] + " " + _B2[0])
def box_lineitem(t):
    return A.box_stats(t("lineitem"), ["l_extendedprice", "l_quantity"], ["l_returnflag"])


_CORR = [*GASES, "temp", "humidity", "wind", "hour", "aqi_score"]
_CSRC = f"c AS (SELECT *, hour(dt) AS hour, {_Y} AS aqi_score FROM readings)"


def _corr_sql(where=""):
    arms = " UNION ALL ".join(f"SELECT '{_CORR[a]}' AS feature_a, '{_CORR[b]}' AS feature_b, {a} AS i, {b} AS j, round(corr({_CORR[a]}, {_CORR[b]}), 9) AS r FROM c"
                              for a in range(len(_CORR)) for b in range(a + 1))
    return f"SELECT * FROM ({arms}) {where}"


def _corr(t):
    return A.corr_matrix(A.with_score(t.readings).withColumn("hour", F.hour("dt")), _CORR)


@query("a15_corr_matrix", with_readings(_corr_sql(), _CSRC))
def corr(t):
    return _corr(t)


@query("a16_lower_triangle", with_readings(_corr_sql("WHERE i > j"), _CSRC))
def triangle(t):
    return A.lower_triangle(_corr(t))


@query("a17_moments", with_readings(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 9) AS mean, round(stddev_pop({c}), 9) AS sd_pop, round(stddev_samp({c}), 9) AS sd_samp FROM readings"
    for c in [*GASES, "temp", "humidity"])))
def moments(t):
    return A.moments(t.readings, [*GASES, "temp", "humidity"])


@query("a18_scatter_sample", with_readings(
    f"""SELECT city, dt, round(humidity, 9) AS humidity, CAST({_Y} AS INT) AS aqi_score FROM readings
ORDER BY md5('42|' || city || '|' || strftime(dt, '%Y-%m-%d %H:%M:%S')) LIMIT 2000"""))
def scatter(t):
    return A.scatter_sample(t.readings, "humidity", 2000, 42, ["city", "dt"])


def _scatter(col):
    @query(f"a18_scatter_{col}", with_readings(f"""SELECT city, dt, round({col}, 9) AS {col}, CAST({_Y} AS INT) AS aqi_score FROM readings
ORDER BY md5('42|' || city || '|' || strftime(dt, '%Y-%m-%d %H:%M:%S')) LIMIT 2000"""))
    def sample(t):
        return A.scatter_sample(t.readings, col, 2000, 42, ["city", "dt"])


for _col in ("temp", "wind"):
    _scatter(_col)


@query("k1_sort_panel", with_readings(f"SELECT city, dt, {rn('co')} FROM readings ORDER BY city, dt"))
def sort_panel(t):
    return K.sort_panel(t.readings.select("city", "dt", "co"))


@query("k2_top_cities", """WITH c AS (SELECT n_name AS city, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 5 END AS y
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)
SELECT city, count(*) AS records, round(avg(y), 9) AS avg_aqi_score FROM c GROUP BY city ORDER BY records DESC, avg(y) DESC, city LIMIT 12""")
def top_cities(t):
    o = (t("orders").join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
         .selectExpr("n_name AS city", "CASE o_orderstatus WHEN 'F' THEN 'Good' WHEN 'O' THEN 'Moderate' ELSE 'Hazardous' END AS aqi_category"))
    return K.top_cities(A.city_summary(o), 12).drop("dominant_category")


@query("k3_top_corr", with_readings(
    f"""SELECT feature, r FROM (SELECT CASE WHEN feature_a = 'aqi_score' THEN feature_b ELSE feature_a END AS feature, r FROM ({_corr_sql("WHERE i <> j AND (feature_a = 'aqi_score' OR feature_b = 'aqi_score')")}))
ORDER BY abs(r) DESC, feature LIMIT 5""", _CSRC))
def top_corr(t):
    return K.top_corr(_corr(t), "aqi_score", 5, absolute=True)


@query("k3_top_corr_signed", with_readings(
    f"""SELECT feature, r FROM (SELECT CASE WHEN feature_a = 'aqi_score' THEN feature_b ELSE feature_a END AS feature, r FROM ({_corr_sql("WHERE i <> j AND (feature_a = 'aqi_score' OR feature_b = 'aqi_score')")}))
ORDER BY r DESC, feature LIMIT 15""", _CSRC))
def top_corr_signed(t):
    return K.top_corr(_corr(t), "aqi_score", 15)


@query("u4_labels_present", with_readings(f"SELECT aqi_category, CAST(min({_Y}) AS INT) AS label_id FROM readings GROUP BY aqi_category"))
def present(t):
    return labels_present(t.readings, labels=LABELS)
