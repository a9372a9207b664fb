"""Exploratory summaries. Each is one pass with map-side combine over the readings."""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.functions.values import encode
from hazeline.operators.filters import sample_n
from hazeline.operators.panel import month_bucket
from hazeline.operators.quantiles import quantiles, unpivot
from hazeline.operators.ranks import constant_if_small, ranked
from hazeline.schema import GASES

PAIRS_PER_AGG = 120


def with_score(df: DataFrame, label: str = "aqi_category") -> DataFrame:
    return df.withColumn("aqi_score", encode(label))


def distribution(df: DataFrame, label: str = "aqi_category") -> DataFrame:
    """(label, n, percent)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))


def _summary(df: DataFrame, key: Column, name: str, label: str) -> DataFrame:
    """records, mean score and dominant label per key, from one count per (key, label)."""
    cells = (df.select(key.alias(name), F.col(label)).filter(F.col(name).isNotNull())
             .groupBy(name, label).agg(F.count(F.lit(1)).alias("n")).withColumn("s", encode(label)))
    scored = F.when(F.col("s").isNotNull(), F.col("n"))
    return cells.groupBy(name).agg(
        F.sum("n").alias("records"),
        (F.sum(F.col("s") * F.col("n")) / F.sum(scored)).alias("avg_aqi_score"),
        F.max_by(label, F.when(F.col(label).isNotNull(), F.struct("n", -F.coalesce("s", F.lit(99)))))
        .alias("dominant_category"))


def city_summary(df: DataFrame, city: str = "city", label: str = "aqi_category") -> DataFrame:
    """records, mean score and dominant label per city; ties go to the milder label."""
    return (_summary(df, F.col(city), city, label)
            .orderBy(F.col("records").desc(), F.col("avg_aqi_score").desc(), city))


def month_summary(df: DataFrame, time: str = "dt", label: str = "aqi_category") -> DataFrame:
    return _summary(df, F.month(time), "month", label).orderBy("month")


def dominant_label(df: DataFrame, by: list[str], label: str = "aqi_category") -> DataFrame:
    """Mode of the label per group; ties go to the milder label."""
    cells = (df.filter(F.col(label).isNotNull()).groupBy(*by, label).agg(F.count(F.lit(1)).alias("n")))
    order = F.struct("n", -F.coalesce(encode(label), F.lit(99)))
    return cells.groupBy(*by).agg(F.max_by(label, order).alias("dominant_category"))


def raw_series(df: DataFrame, cols=GASES, time: str = "dt", label: str = "aqi_category") -> DataFrame:
    """Means over cities per timestamp."""
    means = [F.avg(c).alias(c) for c in cols]
    return with_score(df, label).filter(F.col(time).isNotNull()).groupBy(time).agg(
        F.avg("aqi_score").alias("aqi_score"), *means)


def stamp(df: DataFrame, time: str = "dt") -> DataFrame:
    """Replace the time by minute text, for display."""
    return df.select(F.date_format(time, "yyyy-MM-dd HH:mm").alias("timestamp"),
                     *[c for c in df.columns if c != time])


def downsample(series: DataFrame, points: int = 400, time: str = "dt") -> DataFrame:
    """Rows at positions floor(i * (n - 1) / (points - 1)); all rows when there are no more than ``points``."""
    r = ranked(series, [], month_bucket(time), [time], keep_total="_all")
    last, steps = F.col("_all") - 1, points - 1
    i = F.ceil(F.col("_pos") * F.lit(steps) / last)
    hit = F.floor(i * last / steps) == F.col("_pos")
    return r.filter((F.col("_all") <= points) | hit).drop("_pos", "_all")


def trend(df: DataFrame, unit: str, time: str = "dt", label: str = "aqi_category") -> DataFrame:
    """Mean score by ``hour``, ``month`` or ``day_of_week``."""
    part = {"hour": F.hour, "month": F.month, "day_of_week": F.weekday}[unit](time)
    return with_score(df, label).groupBy(part.alias(unit)).agg(F.avg("aqi_score").alias("avg_aqi_score"))


def trend_sd(df: DataFrame, time: str = "dt", label: str = "aqi_category") -> DataFrame:
    """Mean score by hour with one standard deviation either side."""
    g = with_score(df, label).groupBy(F.hour(time).alias("hour")).agg(
        F.avg("aqi_score").alias("mean"), F.stddev_samp("aqi_score").alias("sd"))
    return g.withColumns({"low": F.col("mean") - F.col("sd"), "high": F.col("mean") + F.col("sd")})


def daily(df: DataFrame, time: str = "dt", label: str = "aqi_category") -> DataFrame:
    """Mean score per calendar day; days without readings are present with null."""
    days = with_score(df, label).groupBy(F.to_date(time).alias("day")).agg(F.avg("aqi_score").alias("avg_aqi_score"))
    span = days.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    cal = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day"))
    return cal.join(days, "day", "left")


def histogram(df: DataFrame, col: str, k: int = 50) -> DataFrame:
    """(bin, low, high, n) over k equal bins from min to max, the last bin closed; empty bins kept."""
    v = df.select(F.col(col).cast("double").alias("v")).filter("v is not null and not isnan(v)")
    ends = v.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("e"))
    e = ends.scalar()
    width = (e["hi"] - e["lo"]) / k
    # a constant column spans half a unit either side of its value
    lo = F.when(e["hi"] > e["lo"], e["lo"]).otherwise(e["lo"] - 0.5)
    w = F.when(e["hi"] > e["lo"], width).otherwise(F.lit(1.0 / k))
    counts = v.select(F.least(F.floor((F.col("v") - lo) / w), F.lit(k - 1)).alias("bin")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"))
    grid = ends.filter("e.lo is not null").select("e", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_b"))
    glo = F.when(F.col("e.hi") > F.col("e.lo"), F.col("e.lo")).otherwise(F.col("e.lo") - 0.5)
    gw = F.when(F.col("e.hi") > F.col("e.lo"), (F.col("e.hi") - F.col("e.lo")) / k).otherwise(F.lit(1.0 / k))
    grid = grid.select(F.col("_b").cast("bigint").alias("bin"), (glo + F.col("_b") * gw).alias("low"),
                       (glo + (F.col("_b") + 1) * gw).alias("high"))
    return grid.join(counts, "bin", "left").select("bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n"))


def density_histogram(df: DataFrame, col: str, k: int = 50, by: str | None = None) -> DataFrame:
    """Histogram scaled to area one; ``by`` gives one histogram per group over shared bins.

    A constant column has one bin of no width and so no density: null.
    """
    if by is None:
        h = histogram(df, col, k)
        total = F.sum("n").over(Window.partitionBy())
        return h.withColumn("density", F.try_divide("n", total * (F.col("high") - F.col("low"))))
    v = df.select(by, F.col(col).cast("double").alias("v")).filter("v is not null and not isnan(v)")
    e = v.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("e")).scalar()
    width = (e["hi"] - e["lo"]) / k
    cells = v.withColumn("bin", F.least(F.floor(F.coalesce(F.try_divide(F.col("v") - e["lo"], width), F.lit(0.0))), F.lit(k - 1))).groupBy(by, "bin").agg(
        F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(by))
    return cells.select(by, "bin", "n", F.try_divide("n", total * width).alias("density"))


def kde(df: DataFrame, col: str, grid: int = 200, bins: int = 512) -> DataFrame:
    """(x, density): Gaussian kernel curve with Scott's bandwidth over binned values.

    The readings are only counted into ``bins`` fine bins; the curve is a sum
    over those, so its cost does not grow with the table. A constant column has
    no bandwidth, and its density is null.
    """
    h = histogram(df, col, bins).filter("n > 0").withColumn("mid", (F.col("low") + F.col("high")) / 2)
    m = df.agg(F.struct(F.count(col).alias("n"), F.stddev_samp(col).alias("sd"), F.min(col).cast("double").alias("lo"),
                        F.max(col).cast("double").alias("hi")).alias("m")).scalar()
    pts = h.withColumn("m", m).withColumn("bw", F.col("m.sd") * F.pow(F.col("m.n").cast("double"), F.lit(-0.2)))
    pts = pts.select("mid", "n", "bw", "m", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
    x = F.col("m.lo") + F.col("i") * (F.col("m.hi") - F.col("m.lo")) / (grid - 1)
    z = F.try_divide(x - F.col("mid"), "bw")
    term = F.try_divide(F.col("n") * F.exp(-z * z / 2), F.col("m.n") * F.col("bw") * math.sqrt(2 * math.pi))
    return pts.groupBy("i").agg(F.max(x).alias("x"), F.sum(term).alias("density"))


def box_stats(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """(by, feature, n, q1, median, q3, low, high, outliers).

    Whiskers end at the furthest values within 1.5 interquartile ranges.
    """
    by = by or []
    keys = [*by, "feature"]
    long = unpivot(df, by, cols)
    for b in by:
        long = long.filter(F.col(b).isNotNull())
    q = constant_if_small(quantiles(long, keys, "value", [0.25, 0.5, 0.75]).select(
        *keys, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    ends = long.join(q, keys).groupBy(*keys).agg(
        F.max("n").alias("n"), F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col("value"))).alias("low"), F.max(F.when(inside, F.col("value"))).alias("high"),
        F.count_if(~inside).alias("outliers"))
    return ends


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature_a, feature_b, i, j, r): pairwise-complete Pearson correlations, i >= j.

    One aggregation per ``PAIRS_PER_AGG`` pairs keeps generated code small. A
    column that doesn't vary over the rows of a pair has no correlation: null.
    """
    def r(a: str, b: str) -> str:
        both = f"`{a}` IS NOT NULL AND `{b}` IS NOT NULL"
        spread = " * ".join(f"stddev_pop(CASE WHEN {both} THEN `{c}` END)" for c in (a, b))
        return f"try_divide(covar_pop(`{a}`, `{b}`), {spread})"

    pairs = [(a, b) for b, a in combinations_with_replacement(range(len(cols)), 2)]
    parts = []
    for s in range(0, len(pairs), PAIRS_PER_AGG):
        chunk = pairs[s:s + PAIRS_PER_AGG]
        agg = df.agg(*[F.expr(f"{r(cols[a], cols[b])} AS r{a}_{b}") for a, b in chunk])
        items = F.expr("array(" + ", ".join(
            f"named_struct('feature_a', '{cols[a]}', 'feature_b', '{cols[b]}', 'i', {a}, 'j', {b}, 'r', r{a}_{b})"
            for a, b in chunk) + ")")
        parts.append(agg.select(F.inline(items)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def lower_triangle(corr: DataFrame) -> DataFrame:
    return corr.filter("i > j")


def moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, n, mean, sd_pop, sd_samp)."""
    agg = df.agg(*[F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd_pop"),
                            F.stddev_samp(c).alias("sd_samp")).alias(c) for c in cols])
    items = F.array(*[F.struct(F.lit(c).alias("feature"), f"{c}.n", f"{c}.mean", f"{c}.sd_pop", f"{c}.sd_samp")
                      for c in cols])
    return agg.select(F.inline(items))


def scatter_sample(df: DataFrame, x: str, n: int, seed: int, key: list[str],
                   label: str = "aqi_category") -> DataFrame:
    """n sampled (key, x, score) rows."""
    return sample_n(with_score(df, label).select(*key, x, "aqi_score"), n, seed, key)
