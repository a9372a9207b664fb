"""Scan and store the readings table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions.values import TIME_FORMATS, nan_to_null, parse_ts
from hazeline.schema import RENAME, canonical, raw_schema


def standardise_names(df: DataFrame) -> DataFrame:
    """Published column names to the engine's short names."""
    return df.withColumnsRenamed({c: canonical(c) for c in df.columns if canonical(c) != c})


def published_names(df: DataFrame) -> DataFrame:
    """Short names back to the published ones, where one is listed."""
    back = {v: k for k, v in RENAME.items()}
    return df.withColumnsRenamed({c: back[c] for c in df.columns if c in back})


def _schema_of(spark: SparkSession, path: str) -> T.StructType:
    """Declared types in the file's own column order; only the header line is read."""
    types = {name: f.dataType for f in raw_schema() for name in (f.name, canonical(f.name))}
    return T.StructType([T.StructField(c, types.get(c, T.StringType()))
                         for c in spark.read.csv(path, header=True).columns])


def read_readings(spark: SparkSession, path: str, schema: T.StructType | None = None,
                  columns: list[str] | None = None, formats=TIME_FORMATS, fmt: str | None = None) -> DataFrame:
    """CSV, gzipped CSV or Parquet of the published layout, in canonical names.

    Text times are parsed leniently (bad ones become null) and NaN becomes null.
    ``columns`` prunes the scan. A gzip file is read by one task, so store it once
    as Parquet with :func:`write_readings` before repeated work.
    """
    if fmt is None:
        fmt = "csv" if path.rstrip("/").endswith((".csv", ".csv.gz", ".csv.bz2")) else "parquet"
    if fmt == "csv":
        df = spark.read.csv(path, header=True, schema=schema or _schema_of(spark, path))
    else:
        # folder names are text: a city 00123 stays that
        option = "spark.sql.sources.partitionColumnTypeInference.enabled"
        before = spark.conf.get(option)
        spark.conf.set(option, "false")
        df = spark.read.parquet(path)
        spark.conf.set(option, before)
    df = standardise_names(df)
    if columns is not None:
        df = df.select(*[canonical(c) for c in columns if canonical(c) in df.columns])
    if "dt" in df.columns and isinstance(df.schema["dt"].dataType, T.StringType):
        df = df.withColumn("dt", parse_ts("dt", formats))
    return nan_to_null(df)


def write_readings(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                   rows_per_file: int = 5_000_000) -> None:
    """Store partitioned by city.

    Rows are rebalanced by city: adaptive execution splits a city that holds much
    of the table over as many tasks as its bytes need.
    """
    out = df.hint("rebalance", "city").write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy("city")
    if fmt == "csv":
        out.csv(path, header=True, timestampFormat="yyyy-MM-dd HH:mm:ss", compression="gzip")
    else:
        out.parquet(path)
