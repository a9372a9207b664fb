"""Train, validation and test splits, and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.operators.panel import month_bucket
from hazeline.operators.ranks import bucket_offsets, hash_cuts, hash_key, lookup, ranked


def split_chrono(df: DataFrame, train: float = 0.70, valid: float = 0.85, time: str = "dt") -> DataFrame:
    """``split`` by time, cut at the distinct timestamps in positions int(.70 n) and int(.85 n). Rows without a time have none."""
    times = df.select(time).filter(F.col(time).isNotNull()).distinct()
    pos = ranked(times, [], month_bucket(time), [time], keep_total="_all")
    cuts = pos.agg(F.struct(*[F.max(F.when(F.col("_pos") == F.floor(F.lit(p) * F.col("_all")), F.col(time)))
                              .alias(n) for p, n in ((train, "a"), (valid, "b"))]).alias("c")).scalar()
    return df.withColumn("split", F.when(F.col(time) < cuts["a"], "train").when(F.col(time) < cuts["b"], "validation")
                         .when(F.col(time).isNotNull(), "test"))


def split_strat(df: DataFrame, label: str, share: float, seed: int, key: list[str]) -> DataFrame:
    """``split`` train/test with exactly round(share * n) training rows per label. Rows without a label have none."""
    h = df.withColumn("_hash", hash_key(seed, *key))
    known = h.filter(F.col(label).isNotNull())
    cuts = lookup(hash_cuts(known, [label], lambda size: F.round(F.lit(share) * size)), label, "_cut")
    chosen = F.coalesce(F.col("_hash") <= F.try_element_at(cuts, F.col(label)), F.lit(False))
    return h.withColumn("split", F.when(chosen, "train").when(F.col(label).isNotNull(), "test")).drop("_hash")


def split_random(df: DataFrame, share: float, seed: int, key: list[str]) -> DataFrame:
    """``split`` train/test by a hash threshold: no shuffle, the same rows on every run."""
    cut = f"{int(share * 0x100000):05x}"
    return df.withColumn("split", F.when(F.substring(hash_key(seed, *key), 1, 5) < cut, "train").otherwise("test"))


def split_position(df: DataFrame, train: float = 0.70, valid: float = 0.80, by: list[str] | None = None,
                   time: str = "dt") -> DataFrame:
    """``split`` by position in time order within ``by``, cut at int(.70 n) and int(.80 n).

    Rows without a time or a key are in no split: theirs is null.
    """
    r = ranked(df, by or [], month_bucket(time), [time], keep_total="_all")
    a, b = (F.floor(F.lit(p) * F.col("_all")) for p in (train, valid))
    placed = F.when(F.col("_pos") < a, "train").when(F.col("_pos") < b, "validation").otherwise("test")
    return r.withColumn("split", F.when(F.col("_pos").isNotNull(), placed)).drop("_pos", "_all")


def city_holdout(df: DataFrame, share: float = 0.8, city: str = "city", time: str = "dt") -> DataFrame:
    """``split`` at position int(share * n) of the city-sorted table: whole cities end up in test.

    Unlike :func:`split_chrono` this measures transfer to other cities, not to
    later times. Row counts per city show the city with the cut, only that city
    is ranked, and every row is then compared with the (city, time) found.
    Rows without a city or a time are in no split: theirs is null.
    """
    placed = F.col(city).isNotNull() & F.col(time).isNotNull()
    everything, df = df, df.filter(placed)
    sizes = bucket_offsets(df, [], F.col(city))
    at = F.floor(F.lit(share) * F.col("_total"))
    edge = sizes.filter((F.col("_offset") <= at) & (at < F.col("_offset") + F.col("_size"))).select(
        F.col("_bucket").alias(city), (at - F.col("_offset")).alias("_want"))
    inside = ranked(df.select(city, time).join(edge, city), [], month_bucket(time), [time])
    cut = inside.filter(F.col("_pos") == F.col("_want")).agg(F.first(F.struct(city, time)).alias("c")).scalar()
    before = F.coalesce(F.struct(city, time) < cut, F.lit(True))
    return everything.withColumn("split", F.when(placed & before, "train").when(placed, "test"))


def class_weights(df: DataFrame, label: str, classes: list | None = None) -> DataFrame:
    """(label, n, weight) with weight n / (k * n_label); a listed class without rows weighs 1."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()
    w = counts.withColumn("weight", F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n")))
    if classes is None:
        return w
    grid = df.sparkSession.createDataFrame([(c,) for c in classes], f"{label} {df.schema[label].dataType.simpleString()}")
    return grid.join(w, label, "left").select(label, F.coalesce("n", F.lit(0)).alias("n"),
                                              F.coalesce("weight", F.lit(1.0)).alias("weight"))


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Append the balanced class weight of each row; rows without a label are dropped."""
    weights = lookup(class_weights(df, label), label, "weight")
    return df.filter(F.col(label).isNotNull()).withColumn(out, F.element_at(weights, F.col(label)))
