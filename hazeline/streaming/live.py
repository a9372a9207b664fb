"""Streaming operators. Each takes and returns a streaming DataFrame and works on a batch as well."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions.index import add_index
from hazeline.plans.forecast import batch_forecast
from hazeline.schema import GASES
from hazeline.sources.live import flatten_live


def stream_nowcast(stream: DataFrame, air: str = "air", weather: str = "weather") -> DataFrame:
    """Live payloads to index, band and dominant pollutant; stateless."""
    return add_index(flatten_live(stream, air, weather))


def stream_dedupe(stream: DataFrame, delay: str = "15 minutes", keys=("city", "dt"), time: str = "dt") -> DataFrame:
    """First row per key; rows later than the watermark are dropped, and so is their state."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_hourly(stream: DataFrame, cols=GASES, time: str = "ts", delay: str = "15 minutes") -> DataFrame:
    """Tumbling hourly means per city."""
    g = stream.withWatermark(time, delay).groupBy("city", F.window(time, "1 hour").alias("w"))
    return g.agg(*[F.avg(c).alias(c) for c in cols]).select("city", F.col("w.start").alias("dt"), *cols)


def stream_rolling(stream: DataFrame, hours: int, cols=GASES, time: str = "ts", delay: str = "15 minutes") -> DataFrame:
    """Mean and maximum over sliding windows of ``hours`` hours that move by one hour.

    Windows are by the clock and include the current hour.
    """
    g = stream.withWatermark(time, delay).groupBy("city", F.window(time, f"{hours} hours", "1 hour").alias("w"))
    out = g.agg(*[a for c in cols for a in (F.avg(c).alias(f"{c}_mean_{hours}h"), F.max(c).alias(f"{c}_max_{hours}h"))])
    return out.select("city", F.col("w.end").alias("dt"), *[c for c in out.columns if c not in ("city", "w")])


def stream_latest(stream: DataFrame, ttl_seconds: int = 900, time: str = "ts", tie: str | None = None) -> DataFrame:
    """Latest reading per city and window of ``ttl_seconds``; the watermark expires old windows."""
    order = F.struct(time, tie) if tie else F.col(time)
    rest = [c for c in stream.columns if c != "city"]
    g = stream.withWatermark(time, f"{ttl_seconds} seconds").groupBy(
        "city", F.window(time, f"{ttl_seconds} seconds").alias("w"))
    out = g.agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return out.select("city", F.col("w.start").alias("slot"), *[F.col(f"_r.{c}").alias(c) for c in rest])


def stream_forecast(history: DataFrame, models: dict[tuple[int, str], PipelineModel],
                    write: Callable[[DataFrame, int], None], **kw) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: score the requests of a micro-batch against the stored history."""

    def step(batch: DataFrame, batch_id: int) -> None:
        write(batch_forecast(batch, history, models, **kw), batch_id)

    return step


def bad_air_sessions(stream: DataFrame, score: str, threshold: float, gap: str = "90 minutes", time: str = "ts",
                     delay: str = "15 minutes") -> DataFrame:
    """Runs of observations at or above a level, per city, closed after ``gap`` without one."""
    hits = stream.filter(F.col(score) >= threshold).withWatermark(time, delay)
    g = hits.groupBy("city", F.session_window(time, gap).alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.max(score).alias("peak"), F.max(time).alias("last_seen"))
    return g.select("city", F.col("s.start").alias("first_seen"), "last_seen", "n", "peak")
