"""Drive a streaming frame over the data that is there and hand back its result as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.session import scratch_path


def event_stream(spark: SparkSession, folder: str, pattern: str, schema) -> DataFrame:
    """File stream over the Parquet files of ``folder`` whose names match ``pattern``."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def drain_append(stream: DataFrame, kind: str) -> DataFrame:
    """Append-only result: Parquet sink in the shared folder."""
    spark, out = stream.sparkSession, scratch_path(stream.sparkSession, kind)
    q = (stream.writeStream.format("parquet").outputMode("append").option("path", f"{out}/rows")
         .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def drain_update(stream: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """Result with revisions: each micro-batch writes its own folder, the newest row per key counts.

    A batch that is replayed after a failure overwrites its folder.
    """
    spark, out = stream.sparkSession, scratch_path(stream.sparkSession, kind)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")

    q = (stream.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    cols = [c for c in stream.columns if c not in keys]
    rows = spark.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows")
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), "batch").alias("_r"))
    return latest.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in stream.columns])


def drain_complete(stream: DataFrame, kind: str) -> DataFrame:
    """Whole result after the last micro-batch.

    For session windows, which have no update mode, when the open sessions at
    the end of the input are wanted too. A stream that runs on uses append mode.
    """
    spark, out = stream.sparkSession, scratch_path(stream.sparkSession, kind)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")

    q = (stream.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows")
    newest = rows.agg(F.max("batch").alias("b")).scalar()
    return rows.filter(F.col("batch") == newest).drop("batch")
