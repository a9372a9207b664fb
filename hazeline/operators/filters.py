"""Filters, guards and deterministic samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.operators.ranks import hash_cuts, hash_key, lookup


def slice_readings(df: DataFrame, city: str | None = None, month: int | str | None = None,
                   time: str = "dt") -> DataFrame:
    """City and month filter; ``None`` or "ALL" selects everything."""
    if city and city != "ALL":
        df = df.filter(F.col("city") == city)
    if month and str(month) != "ALL":
        df = df.filter(F.month(time) == int(month))
    return df


def validate_slice(df: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests (city, month) that are not valid, with the reason."""
    known = df.filter("city is not null").select("city").distinct().withColumn("_known", F.lit(True))
    month = F.col("month").try_cast("int")
    bad_city = F.col("city").isNotNull() & (F.col("city") != "ALL") & F.col("_known").isNull()
    bad_month = (F.col("month").isNotNull() & (F.col("month") != "ALL")
                 & ~F.coalesce(month.between(1, 12), F.lit(False)))
    return (requests.join(known, "city", "left")
            .withColumn("reason", F.when(bad_city, "unknown city").when(bad_month, "invalid month"))
            .filter("reason is not null").drop("_known"))


def recent(df: DataFrame, months: int = 18, time: str = "dt") -> DataFrame:
    """Rows of the last ``months`` months before the newest time."""
    newest = df.agg(F.max(time).alias("m")).scalar()
    return df.filter(F.col(time) >= newest - F.make_ym_interval(months=F.lit(months)))


def city_or_all(df: DataFrame, city: str) -> DataFrame:
    """Case-insensitive city filter; the whole table when the city is unknown."""
    match = F.lower("city") == city.lower()
    hits = df.filter(match).limit(1).agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.filter(F.coalesce(match, F.lit(False)) | (hits == 0))


def min_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """``df``, or no rows when it has fewer than ``n``; the check reads at most n rows."""
    have = df.limit(n).agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.filter(have >= n)


def cities(df: DataFrame) -> DataFrame:
    return df.filter("city is not null").select("city").distinct().orderBy("city")


def sample_n(df: DataFrame, n: int, seed: int, key: list[str]) -> DataFrame:
    """Exactly n rows (or all), chosen by hash order of a unique key."""
    h = df.withColumn("_hash", hash_key(seed, *key))
    cut = hash_cuts(h, [], lambda total: F.lit(n)).select("_cut").scalar()
    return h.filter(F.col("_hash") <= cut).drop("_hash")


def sample_strat(df: DataFrame, n: int, label: str, seed: int, key: list[str]) -> DataFrame:
    """Exactly n rows (or all) with the label shares of ``df``; rounding goes to the largest remainders."""
    h = df.filter(F.col(label).isNotNull()).withColumn("_hash", hash_key(seed, *key))
    quotas = lookup(_quotas(df, n, label), label, "_quota")
    cuts = lookup(hash_cuts(h, [label], lambda size: F.element_at(quotas, F.col(label))), label, "_cut")
    return h.filter(F.col("_hash") <= F.try_element_at(cuts, F.col(label))).drop("_hash")


def _quotas(df: DataFrame, n: int, label: str) -> DataFrame:
    """(label, _quota) with quotas that add up to n; a table with one row per label."""
    sizes = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    every = Window.partitionBy()
    sizes = sizes.withColumn("_all", F.sum("_n").over(every))
    sizes = sizes.withColumn("_want", F.least(F.lit(n), "_all"))
    # whole-number arithmetic: n * size = all * share + remainder
    share = sizes.withColumn("_share", F.expr("_want * _n DIV _all")).withColumn("_rest", F.expr("_want * _n % _all"))
    order = F.row_number().over(Window.orderBy(F.col("_rest").desc(), label))
    left = F.col("_want") - F.sum("_share").over(every)
    return share.select(label, (F.col("_share") + F.when(order <= left, 1).otherwise(0)).alias("_quota"))


def tail_before(df: DataFrame, t, n: int, city: str = "city", time: str = "dt") -> DataFrame:
    """Last n rows of each city before ``t``; a city with none gives its last n rows overall.

    Ranking with a top-n bound lets Spark keep n rows per city in each map task.
    """
    t = F.lit(t).cast("timestamp")
    early = F.coalesce(F.col(time) < t, F.lit(False))
    w = Window.partitionBy(city, "_early").orderBy(F.col(time).desc())
    ranked_rows = (df.withColumn("_early", early).withColumn("_rn", F.row_number().over(w))
                   .filter(F.col("_rn") <= n))
    has = Window.partitionBy(city)
    return (ranked_rows.withColumn("_has", F.max("_early").over(has))
            .filter(F.col("_early") == F.col("_has")).drop("_early", "_rn", "_has"))
