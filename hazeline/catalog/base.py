"""Registry of checked queries: a Spark callable and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.schema import BREAKPOINTS, INDEX_LEVELS, LABELS
from hazeline.sources.fixture import observations, readings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy views of one test-data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def readings(self) -> DataFrame:
        return readings(self("events"))

    @cached_property
    def observations(self) -> DataFrame:
        return observations(self("events"))


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, so that they compare with SQL TIMESTAMP."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
                       else F.col(f.name) for f in df.schema.fields])


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round double columns for comparison."""
    return df.select(*[F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                       else F.col(f.name) for f in df.schema.fields])


def query(name: str, sql: str | None = None, digits: int | None = 9):
    """Register ``f(tables)``; results are rounded and freed of time zones."""

    def wrap(f: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            out = f(Tables(spark, folder))
            return plain(rounded(out, digits) if digits is not None else out)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return f

    return wrap


def values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


SEGMENTS = values([(g, float(c[i]), float(c[i + 1]), float(INDEX_LEVELS[i]), float(INDEX_LEVELS[i + 1]), i)
                   for g, c in BREAKPOINTS.items() for i in range(5)])

# Sub-index of one gas in SQL: the segment is looked up in a table of breakpoints.
BREAKS_CTE = f"breaks(gas, lo, hi, ilo, ihi, seg) AS (VALUES {SEGMENTS})"


def sub_index_sql(source: str, key: str, gases: list[str], name: str = "parts") -> str:
    """CTEs ``<name>`` (key, gas, v, idx) for the gases of a source; null values give 0."""
    arms = " UNION ALL ".join(f"SELECT {key}, '{g}' AS gas, CAST({g} AS DOUBLE) AS v FROM {source}" for g in gases)
    return f"""{name}_long AS ({arms}),
{name} AS (
  SELECT l.*, CASE WHEN l.v IS NULL THEN 0.0
    WHEN b.seg IS NULL THEN l.v - top.hi + 400.0
    ELSE (l.v - b.lo) * ((b.ihi - b.ilo) / (b.hi - b.lo)) + b.ilo END AS idx
  FROM {name}_long l
  LEFT JOIN breaks b ON b.gas = l.gas AND l.v <= b.hi AND (l.v > b.lo OR b.seg = 0)
  JOIN breaks top ON top.gas = l.gas AND top.seg = 4)"""


def _mean(cond: str, field: str, per: int) -> str:
    f = f" FILTER (WHERE {cond})" if cond else ""
    return (f"CAST(sum({field}){f} AS DOUBLE) / NULLIF(CAST(count(*){f} * {per} AS DOUBLE), 0)")


ORDINAL = "CASE {c} " + " ".join(f"WHEN '{lab}' THEN {i}" for i, lab in enumerate(LABELS)) + " END"


def ordinal(col: str) -> str:
    return ORDINAL.format(c=col)


def name_of(col: str) -> str:
    return f"CASE {col} " + " ".join(f"WHEN {i} THEN '{lab}'" for i, lab in enumerate(LABELS)) + " ELSE 'Unknown' END"


OBS_CTE = """obs AS (
  SELECT event_id, 'S' || CAST(user_id % 5 AS VARCHAR) AS city, ts, date_trunc('hour', ts) AS dt, event_type,
    CAST(round(value * 100) AS BIGINT) AS cents, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
  FROM events)"""

_GASES = ["pm25", "pm10", "no2", "co", "so2", "o3"]

READINGS_CTE = f"""{OBS_CTE},
{BREAKS_CTE},
panel AS (
  SELECT city, dt,
    {_mean("event_type = 'view'", 'cents', 100)} AS pm25,
    {_mean("event_type = 'click'", 'cents', 100)} AS pm10,
    {_mean("event_type = 'purchase'", 'cents', 100)} AS no2,
    {_mean("", 'k', 10)} AS co,
    {_mean("event_type = 'error'", 'cents', 100)} AS so2,
    {_mean("event_type = 'signup'", 'cents', 100)} AS o3,
    round(15 + 10 * sin(2 * pi() * hour(dt) / 24), 6) AS temp,
    {_mean("", 'k', 1)} AS humidity,
    CAST(count(*) AS DOUBLE) AS wind
  FROM obs GROUP BY city, dt),
{sub_index_sql('panel', 'city, dt', _GASES, 'fx')},
top_index AS (SELECT city, dt, max(CASE WHEN v IS NOT NULL THEN idx END) AS top FROM fx GROUP BY city, dt),
readings AS (
  SELECT p.*, CASE WHEN top <= 50 THEN 'Good' WHEN top <= 100 THEN 'Moderate' WHEN top <= 200 THEN 'Unhealthy_Sensitive'
    WHEN top <= 300 THEN 'Unhealthy' WHEN top <= 400 THEN 'Very_Unhealthy' ELSE 'Hazardous' END AS aqi_category
  FROM panel p JOIN top_index USING (city, dt))"""


def with_readings(body: str, *ctes: str) -> str:
    """SQL over the derived readings; ``ctes`` come between them and the body."""
    return f"WITH {', '.join([READINGS_CTE, *ctes])}\n{body}"


def rn(*cols: str) -> str:
    return ", ".join(f"round({c}, 9) AS {c}" for c in cols)
