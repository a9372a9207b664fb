"""Exact positions in an ordered group without sorting the group in one task.

A group (a city, a label) may hold a third of all rows. Each group is cut into
buckets that follow the order (a month, a hash prefix). A narrow pass counts
rows per bucket, a running sum over the small bucket table gives each bucket's
offset, and a window inside the bucket supplies the rest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket_offsets(df: DataFrame, by: list[str], bucket: Column) -> DataFrame:
    """(by, _bucket, _offset, _size, _total): rows before the bucket, in it, in the group."""
    counts = (df.select(*by, bucket.alias("_bucket")).filter("_bucket is not null").groupBy(*by, "_bucket")
              .agg(F.count(F.lit(1)).alias("_size")))
    w = Window.partitionBy(*by)
    return counts.select(
        *by, "_bucket", "_size",
        (F.sum("_size").over(w.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
         - F.col("_size")).alias("_offset"),
        F.sum("_size").over(w).alias("_total"))


def ranked(df: DataFrame, by: list[str], bucket: Column, order: list,
           name: str = "_pos", keep_total: str | None = None) -> DataFrame:
    """Append the 0-based position of each row within ``by`` in ``order``.

    ``bucket`` must be monotone in ``order``; rows with equal order keys need a
    further key in ``order`` for a fixed result. Rows with a null key or a null
    bucket have no place in the order: they stay, with a null position.
    """
    offsets = bucket_offsets(df, by, bucket)
    inner = df.withColumn("_bucket", bucket).withColumn(
        "_rn", F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(*order)))
    keys = [*by, "_bucket"]
    out = inner.join(offsets.select(*keys, "_offset", "_total"), keys, "left")
    extra = [F.col("_total").alias(keep_total)] if keep_total else []
    return out.select(*[F.col(c) for c in df.columns],
                      (F.col("_offset") + F.col("_rn") - 1).alias(name), *extra)


def hash_key(seed: int | str, *cols: str) -> Column:
    """md5 of the seed and the key columns: the same order in every engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def hash_bucket(col: Column | str = "_hash", digits: int = 4) -> Column:
    """Leading hex digits of a hash: 16**digits even buckets in hash order."""
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(c, 1, digits)


def hash_cuts(df: DataFrame, by: list[str], quota: Callable[[Column], Column]) -> DataFrame:
    """(by, _cut): hash of the quota-th row of each group in ``_hash`` order.

    ``quota`` maps the group size to a number of rows. Counts per hash bucket
    show which bucket holds that row, and only that bucket is ranked. Comparing
    hashes with the cut then needs no shuffle of the rows themselves.
    """
    want = F.least(quota(F.col("_total")).cast("bigint"), F.col("_total"))
    edge = bucket_offsets(df, by, hash_bucket()).withColumn("_want", want).filter(
        (F.col("_offset") < F.col("_want")) & (F.col("_want") <= F.col("_offset") + F.col("_size")))
    rows = df.select(*by, "_hash", hash_bucket().alias("_bucket")).join(edge, [*by, "_bucket"])
    w = Window.partitionBy(*by, "_bucket").orderBy("_hash")
    hit = rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == F.col("_want") - F.col("_offset"))
    return hit.select(*by, F.col("_hash").alias("_cut"))


# Rows of a table that may become a constant relation in a plan.
SMALL_ROWS = 10_000


def constant_if_small(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """A table of at most ``limit`` rows as a constant of known size, a larger one as it is.

    Spark then joins the small table without moving the other side, by its own
    size threshold. At most ``limit`` + 1 rows are read to find out.
    """
    rows = df.limit(limit + 1).toArrow()
    return df.sparkSession.createDataFrame(rows, df.schema) if rows.num_rows <= limit else df


def lookup(small: DataFrame, key: str, value: str) -> Column:
    """A small keyed table as one map value, for tables with one row per label."""
    return small.agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("m")).scalar()
