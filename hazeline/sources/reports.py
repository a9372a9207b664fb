"""JSON metric reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.schema import LABELS

# Policy texts and task name stored with a forecast report.
REPORT_META = {
    "task": "future_aqi_category_forecasting",
    "target": "AQI_Category shifted forward by horizon per city",
    "feature_policy": "No AQI-derived columns. Lag and rolling features use past observations only.",
    "split_policy": "Chronological 70/15/15 split by timestamp.",
}


def report(metrics: DataFrame, meta: dict[str, str] | None = None) -> DataFrame:
    """One row: the policy texts, label ids as ``category_mapping``, and all metric rows as ``results``. Metric tables are small."""
    return metrics.agg(
        *[F.lit(v).alias(k) for k, v in (meta or REPORT_META).items()],
        F.struct(*[F.lit(i).alias(label) for i, label in enumerate(LABELS)]).alias("category_mapping"),
        F.sort_array(F.collect_set("horizon_hours")).alias("horizons_hours"),
        F.sort_array(F.collect_list(F.struct(*metrics.columns))).alias("results"))


def write_report(metrics: DataFrame, path: str, meta: dict[str, str] | None = None,
                 mode: str = "errorifexists") -> None:
    report(metrics, meta).write.mode(mode).json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metric rows of a report: JSON with nested ``results``, a plain JSON list, or CSV."""
    if path.rstrip("/").endswith(".csv"):
        return spark.read.csv(path, header=True, inferSchema=True)
    df = spark.read.json(path, multiLine=True)
    return df.select(F.inline("results")) if "results" in df.columns else df
