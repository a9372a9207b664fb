"""City mentions and set operations."""

from pyspark.sql import functions as F

from hazeline.catalog.base import query, rn, with_readings
from hazeline.operators import joins as J
from hazeline.operators import sets as U
from hazeline.operators.profile import null_profile
from hazeline.schema import GASES


def _words(t):
    """Names to look for: the words of the benchmark texts, without edge punctuation."""
    word = F.explode(F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " "))
    return t("benchmark").select("item_id", word.alias("w")).select("item_id", F.regexp_replace("w", r"[^\p{L}]+$", "").alias("city"))


def _names(t):
    """The first word of each benchmark text."""
    first = F.split_part(F.trim(F.regexp_replace("text", r"\s+", " ")), F.lit(" "), F.lit(1))
    return t("benchmark").select(F.regexp_replace(first, r"[^\p{L}]+$", "").alias("city"))


_TIDY = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"
_FIRST = f"SELECT regexp_replace(split_part({_TIDY}, ' ', 1), '[^\\p{{L}}]+$', '') AS city FROM benchmark"
_ALL = f"SELECT regexp_replace(unnest(string_split({_TIDY}, ' ')), '[^\\p{{L}}]+$', '') AS city FROM benchmark"


def _mentions(names: str) -> str:
    return f"""WITH names AS (SELECT lower(city) AS k, min(city) AS city FROM ({names}) WHERE city <> '' GROUP BY 1),
found AS (SELECT d.doc_id, min(n.city) AS city FROM documents d JOIN names n ON contains(lower(d.text), n.k) GROUP BY d.doc_id)
SELECT d.doc_id, coalesce(f.city, 'Delhi') AS city FROM documents d LEFT JOIN found f USING (doc_id)"""


@query("j6_city_mentions", _mentions(_FIRST))
def mentions(t):
    return J.city_mentions(t("documents"), _names(t))


@query("j6_city_mentions_long_list", _mentions(_ALL))
def mentions_long(t):
    return J.city_mentions(t("documents"), _words(t))


@query("u1_union_rows", with_readings(
    f"""SELECT city, dt, {rn('co')}, NULL::VARCHAR AS origin FROM readings
UNION ALL SELECT city, dt, {rn('co')}, 'copy' FROM readings WHERE aqi_category = 'Hazardous'"""))
def union_rows(t):
    r = t.readings.select("city", "dt", "co", "aqi_category")
    return U.union_rows(r.drop("aqi_category"), r.filter("aqi_category = 'Hazardous'").drop("aqi_category").withColumn("origin", F.lit("copy")))


@query("u2_append_current", with_readings(
    f"""SELECT city, dt, {rn('co')}, {rn('pm25')} FROM readings
UNION ALL SELECT city, max(dt) + INTERVAL 1 HOUR, round(arg_max(co, dt), 9), NULL FROM readings GROUP BY city"""))
def append_current(t):
    r = t.readings.select("city", "dt", "co", "pm25")
    now = r.groupBy("city").agg((F.max("dt") + F.expr("INTERVAL 1 HOUR")).alias("dt"), F.max_by("co", "dt").alias("co"))
    return U.append_current(r, now.withColumn("extra", F.lit(1)))


_SIDES = [(c, "both") for c in GASES] + [(c, "frame_only") for c in ("city", "dt", "temp", "humidity", "wind", "aqi_category")]


@query("u3_column_sets", with_readings(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{side}' AS side, count({c}) AS held FROM readings""" for c, side in _SIDES)
    + """ UNION ALL SELECT 'nh3', 'list_only', NULL"""))
def column_sets(t):
    """Wanted columns against those of the table, with the values held."""
    r = t.readings
    rows = r.agg(F.count(F.lit(1)).alias("n")).scalar()
    held = null_profile(r).select("column", (rows - F.col("missing")).alias("held"))
    return U.column_sets(r, [*GASES, "nh3"]).join(held, "column", "left")
