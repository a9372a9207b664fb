"""Ordering and top-k on small summary and metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sort_panel(df: DataFrame, city: str = "city", time: str = "dt") -> DataFrame:
    """Range-partitioned global order; for output only."""
    return df.orderBy(city, time)


def top_cities(summary: DataFrame, n: int) -> DataFrame:
    return summary.orderBy(F.col("records").desc(), F.col("avg_aqi_score").desc(), "city").limit(n)


def top_corr(corr: DataFrame, target: str, n: int, absolute: bool = False) -> DataFrame:
    """Strongest partners of ``target`` in a long correlation table, itself excluded."""
    other = F.when(F.col("feature_a") == target, F.col("feature_b")).otherwise(F.col("feature_a"))
    rows = corr.filter(((F.col("feature_a") == target) | (F.col("feature_b") == target))
                       & (F.col("feature_a") != F.col("feature_b"))).select(other.alias("feature"), "r").distinct()
    key = F.abs("r") if absolute else F.col("r")
    return rows.filter("r is not null").orderBy(key.desc(), "feature").limit(n)


def leaderboard(metrics: DataFrame, by: str, fallback: str | None = None, name: str = "model") -> DataFrame:
    """Rank by a metric; where it is 0 or null the fallback metric counts, then 0.

    ``place`` marks the best and the worst row.
    """
    score = F.nullif(F.col(by), F.lit(0.0))
    score = F.coalesce(score, F.col(fallback), F.lit(0.0)) if fallback else F.coalesce(score, F.lit(0.0))
    w = Window.orderBy(F.col("score").desc(), name)
    out = metrics.withColumn("score", score).withColumn("rank", F.row_number().over(w))
    last = F.count(F.lit(1)).over(Window.partitionBy())
    return out.withColumn("place", F.when(F.col("rank") == 1, "best").when(F.col("rank") == last, "worst"))


def best_per_horizon(metrics: DataFrame) -> DataFrame:
    best = metrics.groupBy("horizon_hours").agg(
        F.max_by(F.struct("model", "accuracy"), F.struct(F.col("accuracy"), F.col("model"))).alias("b"))
    return best.select("horizon_hours", "b.model", "b.accuracy").orderBy("horizon_hours")


def sort_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("horizon_hours", F.col("accuracy").desc(), "model")


def best_config(grid: DataFrame, loss: str = "final_loss", tie: str = "config_label") -> DataFrame:
    best = grid.agg(F.min_by(F.struct(*grid.columns), F.struct(loss, tie)).alias("b"))
    return best.select("b.*")


def display_metrics(metrics: DataFrame, cols: list[str], name: str = "model") -> DataFrame:
    """Percent with one digit, and the first word of the model name."""
    return metrics.select(F.split_part(F.col(name), F.lit(" "), F.lit(1)).alias("name"),
                          F.col(name).alias("full_name"),
                          *[F.round(F.coalesce(F.col(c), F.lit(0.0)) * 100, 1).alias(c) for c in cols])
