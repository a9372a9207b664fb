"""Row-based windows over long per-city series, split into chunks with overlap.

``chunked`` numbers the rows of a city, cuts the numbering into chunks of equal
length and copies the last ``back`` rows of each chunk to the next one and the
first ``ahead`` rows to the previous one. A window over (city, chunk) then sees
exactly the rows an undivided window would see, and no task holds a whole city.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hazeline.operators.ranks import ranked

CHUNK_ROWS = 65536


def month_bucket(time: str = "dt") -> Column:
    return F.year(time) * 12 + F.month(time)


def chunked(df: DataFrame, back: int, ahead: int = 0, by: list[str] | None = None,
            time: str = "dt", ties: tuple = (), rows: int = CHUNK_ROWS, last: str | None = None) -> DataFrame:
    """``df`` with ``_pos``, ``_chunk`` and ``_own`` (false on copied rows).

    ``last`` names a flag for the final row of each series. A row without a key
    or a time is a chunk of its own, so it stays and sees no other row.
    """
    by = by or ["city"]
    rows = max(rows, back, ahead, 1)
    df = ranked(df, by, month_bucket(time), [time, *ties], keep_total="_all" if last else None)
    if last:
        df = df.withColumn(last, F.col("_pos") == F.col("_all") - 1).drop("_all")
    home = F.coalesce(F.floor(F.col("_pos") / rows), -1 - F.monotonically_increasing_id())
    within = F.col("_pos") % rows
    targets = [home]
    if back:
        targets.append(F.when(within >= rows - back, home + 1))
    if ahead:
        targets.append(F.when((within < ahead) & (home > 0), home - 1))
    out = df.select("*", home.alias("_home"), F.explode(F.array_compact(F.array(*targets))).alias("_chunk"))
    return out.withColumn("_own", F.col("_chunk") == F.col("_home")).drop("_home")


def window(by: list[str] | None = None) -> WindowSpec:
    """Window over the rows of a chunk in time order."""
    return Window.partitionBy(*(by or ["city"]), "_chunk").orderBy("_pos")


def own_rows(df: DataFrame) -> DataFrame:
    """Drop copied rows and helper columns."""
    return df.filter("_own").drop("_pos", "_chunk", "_own")


def carry_bounds(df: DataFrame, by: list[str], bucket: Column, order: Column,
                 cols: list[str], coarse=None) -> DataFrame:
    """Per bucket: last non-null value of each column before it, first one after it.

    One aggregation with map-side combine, then a window over the bucket table.
    Where that table is long, ``coarse`` (a function of the bucket's column, rising with it) cuts it: values
    are carried between the coarse buckets, and inside each of them between its buckets.
    """
    agg = df.select(*by, bucket.alias("_bucket"), order.alias("_ord"), *cols).groupBy(*by, "_bucket").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_ord"))).alias(f"_l_{c}") for c in cols],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_ord"))).alias(f"_f_{c}") for c in cols])

    def carried(rows: DataFrame, within: list[str], along: str, before: str, after: str) -> DataFrame:
        w = Window.partitionBy(*within).orderBy(along)
        prev, nxt = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
        return rows.select(
            *within, along,
            *[F.last(f"_l_{c}", ignorenulls=True).over(prev).alias(f"{before}{c}") for c in cols],
            *[F.first(f"_f_{c}", ignorenulls=True).over(nxt).alias(f"{after}{c}") for c in cols])

    if coarse is None:
        return carried(agg, by, "_bucket", "_p_", "_n_")
    agg = agg.withColumn("_part", coarse("_bucket"))
    parts = agg.groupBy(*by, "_part").agg(
        *[F.max_by(f"_l_{c}", F.when(F.col(f"_l_{c}").isNotNull(), F.col("_bucket"))).alias(f"_l_{c}") for c in cols],
        *[F.min_by(f"_f_{c}", F.when(F.col(f"_f_{c}").isNotNull(), F.col("_bucket"))).alias(f"_f_{c}") for c in cols])
    outer = carried(parts, by, "_part", "_op_", "_on_")
    inner = carried(agg, [*by, "_part"], "_bucket", "_ip_", "_in_")
    return inner.join(outer, [*by, "_part"], "left").select(
        *by, "_bucket", *[F.coalesce(f"_i{x}_{c}", f"_o{x}_{c}").alias(f"_{x}_{c}") for x in "pn" for c in cols])


def fill_both_ways(df: DataFrame, by: list[str], bucket: Column, order: list[str],
                   cols: list[str], coarse=None) -> DataFrame:
    """Forward fill, then backward fill, of ``cols`` along ``order`` within ``by``."""
    # a single order column keeps the aggregation in hash form
    bounds = carry_bounds(df, by, bucket, F.col(order[0]) if len(order) == 1 else F.struct(*order), cols, coarse)
    keys = [*by, "_bucket"]
    w = Window.partitionBy(*keys).orderBy(*order)
    upto, onward = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    inner = df.withColumn("_bucket", bucket).withColumns({
        **{f"_u_{c}": F.last(c, ignorenulls=True).over(upto) for c in cols},
        **{f"_o_{c}": F.first(c, ignorenulls=True).over(onward) for c in cols}})
    joined = inner.join(bounds, keys, "left")
    return joined.select(*[
        F.coalesce(f"_u_{c}", f"_p_{c}", f"_o_{c}", f"_n_{c}").alias(c) if c in cols else F.col(c)
        for c in df.columns])
