"""Exact interpolated quantiles of groups of any size.

``percentile`` keeps every distinct value of a group in one aggregation buffer.
Here an approximate quantile sketch only supplies cut points. Counts per
interval between cuts show which intervals hold the wanted ranks; each of those
is split again into equal steps, and only values of the steps that hold a wanted
rank are shuffled and sorted, in a second scan. A poor sketch costs time, never
exactness. The cuts and the steps found are read to the driver while they are
small, so that they join without moving the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.operators.ranks import constant_if_small

SKETCH_ACCURACY = 2000
MARGIN = 0.001
STEPS = 4096


def unpivot(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """(by, feature, value) rows with null values dropped."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                      for c in cols])
    return (df.select(*by, F.inline(pairs)).filter(F.col("value").isNotNull() & ~F.isnan("value")))


def quantiles(df: DataFrame, by: list[str], value: str, probs: list[float]) -> DataFrame:
    """(by, n, q0, q1, ...) with linear interpolation at ``probs``."""
    marks = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-MARGIN, MARGIN)})
    rows = df.select(*by, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    cuts = constant_if_small(rows.groupBy(*by).agg(F.expr(
        f"percentile_approx(_v, array({', '.join(map(str, marks))}), {SKETCH_ACCURACY})").alias("_cuts")))
    keyed = rows.join(cuts, by) if by else rows.withColumn("_cuts", cuts.scalar())
    interval = " + ".join(f"CAST(_v > _cuts[{i}] AS INT)" for i in range(len(marks)))
    # position between the two cuts around the value; the open ends are one step
    keyed = keyed.select(*by, "_v", "_cuts", F.expr(interval).alias("_iv"))
    low, high = "try_element_at(_cuts, nullif(_iv, 0))", "try_element_at(_cuts, _iv + 1)"
    step = F.expr(f"coalesce(CAST(floor({STEPS} * try_divide(_v - {low}, {high} - {low})) AS INT), 0)")
    keyed = keyed.select(*by, "_iv", step.alias("_step"), "_v")
    # a table of steps, whatever the number of rows: it is counted in the map tasks
    sizes = keyed.groupBy(*by, "_iv", "_step").agg(F.count(F.lit(1)).alias("_size"))
    outer = sizes.groupBy(*by, "_iv").agg(F.sum("_size").alias("_size"))
    totals = Window.partitionBy(*by)
    outer = _prefix(outer, by, "_iv").withColumn("_total", F.sum("_size").over(totals))
    wanted = F.expr("array(" + ", ".join(
        f"named_struct('i', {i}, 'hi', {hi}, 'rank', CAST({f}({p}D * (_total - 1)) AS BIGINT))"
        for i, p in enumerate(probs) for hi, f in ((0, "floor"), (1, "ceil"))) + ")")
    outer = _holding(outer.withColumn("_ranks", wanted)).withColumnRenamed("_before", "_base")
    inner = sizes.join(outer.select(*by, "_iv", "_base", "_total", "_ranks"), [*by, "_iv"])
    inner = _prefix(inner, [*by, "_iv"], "_step").withColumn("_before", F.col("_before") + F.col("_base"))
    hit = constant_if_small(_holding(inner).select(*by, "_iv", "_step", "_before", "_total", "_ranks"))
    # second scan: only values in the steps that hold a rank; equal ones collapse before the shuffle
    near = keyed.join(hit.select(*by, "_iv", "_step"), [*by, "_iv", "_step"]).groupBy(*by, "_iv", "_step", "_v").agg(
        F.count(F.lit(1)).alias("_n")).join(hit, [*by, "_iv", "_step"])
    w = Window.partitionBy(*by, "_iv", "_step").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("_end", F.col("_before") + F.sum("_n").over(w))
    found = near.select(*by, "_total", "_v", F.expr(
        "inline(filter(_ranks, r -> r.rank < _end AND r.rank >= _end - _n))"))
    picks = []
    for i, p in enumerate(probs):
        lo, hi = (f"max(_v) FILTER (WHERE i = {i} AND hi = {side})" for side in (0, 1))
        at = f"{p}D * (max(_total) - 1)"
        picks.append(F.expr(f"{lo} + ({hi} - {lo}) * ({at} - floor({at}))").alias(f"q{i}"))
    return found.groupBy(*by).agg(F.max("_total").alias("n"), *picks)


def _prefix(sizes: DataFrame, by: list[str], bucket: str) -> DataFrame:
    """Append ``_before``: the size of all earlier buckets."""
    w = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    return sizes.withColumn("_before", F.sum("_size").over(w) - F.col("_size"))


def _holding(buckets: DataFrame) -> DataFrame:
    """Buckets that hold a wanted rank, with those ranks only."""
    kept = F.expr("filter(_ranks, r -> r.rank >= _before AND r.rank < _before + _size)")
    return buckets.withColumn("_ranks", kept).filter(F.size("_ranks") > 0)
