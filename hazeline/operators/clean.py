"""Cleaning: drops, fills, interpolation, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.operators.panel import chunked, fill_both_ways, month_bucket, own_rows, window
from hazeline.operators.profile import duplicate_columns
from hazeline.operators.quantiles import quantiles, unpivot
from hazeline.schema import CONSTANT_COLUMNS, DERIVED_COLUMNS, EMPTY_COLUMNS, LABELS, canonical


def drop_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop the listed columns that are there."""
    return df.drop(*cols)


def drop_useless(df: DataFrame) -> DataFrame:
    """Drop the columns known to be empty, constant or derived from the target."""
    names = EMPTY_COLUMNS + CONSTANT_COLUMNS + DERIVED_COLUMNS
    return df.drop(*names, *[canonical(c) for c in names])


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Keep the first of each set of identical columns."""
    return df.drop(*[r.column_b for r in duplicate_columns(df).toLocalIterator()])


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.drop(subset=cols)


def allowed_labels(df: DataFrame, label: str = "aqi_category", labels=LABELS) -> DataFrame:
    return df.filter(F.col(label).isin(*labels))


def fill_city(df: DataFrame, cols: list[str], city: str = "city", time: str = "dt") -> DataFrame:
    """Forward then backward fill within each city."""
    return fill_both_ways(df, [city], month_bucket(time), [time], cols)


def fill_global(df: DataFrame, cols: list[str], time: str = "dt", ties: tuple = ("city",)) -> DataFrame:
    """Forward then backward fill in overall time order, across cities.

    Each distinct time is a bucket. Values are carried between months, then
    between the times of a month, then between the rows of a time, so only the table of months is ordered as a whole.
    """
    return fill_both_ways(df, [], F.col(time), [time, *ties], cols, month_bucket)


def interpolate(df: DataFrame, cols: list[str], max_gap: int = 3, city: str = "city",
                time: str = "dt") -> DataFrame:
    """Linear interpolation in time over gaps of at most ``max_gap`` missing hours.

    With hourly rows the known neighbours of such a gap lie within ``max_gap``
    rows, so the windows are short.
    """
    base = chunked(df, max_gap, max_gap, [city], time)
    w = window([city])
    before, after = w.rowsBetween(-max_gap, -1), w.rowsBetween(1, max_gap)
    point = {c: F.when(F.col(c).isNotNull(), F.struct(F.unix_timestamp(time).alias("t"), F.col(c).alias("v")))
             for c in cols}
    base = base.select("*", *[F.last(point[c], ignorenulls=True).over(before).alias(f"_b_{c}") for c in cols],
                       *[F.first(point[c], ignorenulls=True).over(after).alias(f"_a_{c}") for c in cols])
    base = own_rows(base)
    now = F.unix_timestamp(time)

    def filled(c):
        b, a = F.col(f"_b_{c}"), F.col(f"_a_{c}")
        span = a["t"] - b["t"]
        line = b["v"] + (a["v"] - b["v"]) * (now - b["t"]) / span
        return F.coalesce(F.col(c), F.when(span <= (max_gap + 1) * 3600, line)).alias(c)

    return base.select(*[filled(c) if c in cols else F.col(c) for c in df.columns])


def median_fill(df: DataFrame, cols: list[str], city: str = "city", time: str = "dt") -> DataFrame:
    """Fill nulls with the exact median of the same city and calendar month."""
    keyed = df.withColumn("_m", F.month(time))
    long = unpivot(keyed, [city, "_m"], cols)
    med = quantiles(long, [city, "_m", "feature"], "value", [0.5])
    wide = med.groupBy(city, "_m").agg(*[F.max(F.when(F.col("feature") == c, F.col("q0"))).alias(f"_q_{c}")
                                         for c in cols])
    out = keyed.join(wide, [city, "_m"], "left")
    return out.select(*[F.coalesce(c, f"_q_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def dedupe_ts(df: DataFrame, keys: list[str], tie: list[str]) -> DataFrame:
    """One row per key: the first in ``tie`` order.

    An aggregation with map-side combine, so that a heavily copied key does not
    gather its copies in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*tie)).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])
