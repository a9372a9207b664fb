"""Profiling: previews, shape, nulls, duplicate and constant columns, consistency audit."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline import schema as S


def head_tail(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """First and last n rows in key order, tagged ``part``."""
    head = df.orderBy(*[F.col(k).asc() for k in keys]).limit(n)
    tail = df.orderBy(*[F.col(k).desc() for k in keys]).limit(n)
    return (head.withColumn("part", F.lit("head"))
            .unionByName(tail.withColumn("part", F.lit("tail"))))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def categorise(df: DataFrame) -> DataFrame:
    """(column, category); a column outside every listed group is "others"."""
    groups = {"pollutant": S.POLLUTANT_COLUMNS, "weather": S.WEATHER_COLUMNS,
              "time": S.TIME_COLUMNS, "target": S.TARGET_COLUMNS, "derived": S.DERIVED_COLUMNS}
    known = {name: g for g, cols in groups.items() for c in cols for name in (c, S.canonical(c))}
    rows = [(c, known.get(c, "others")) for c in df.columns]
    return df.sparkSession.createDataFrame(rows, "column string, category string")


def null_profile(df: DataFrame, k: int | None = None) -> DataFrame:
    """(column, data_type, missing) in descending order of missing values; one pass."""
    floats = (T.DoubleType, T.FloatType)
    counts = df.agg(*[
        F.count_if(F.col(f.name).isNull() | F.isnan(f.name)).alias(f.name)
        if isinstance(f.dataType, floats) else F.count_if(F.col(f.name).isNull()).alias(f.name)
        for f in df.schema.fields])
    items = F.array(*[F.struct(F.lit(f.name).alias("column"),
                               F.lit(f.dataType.simpleString()).alias("data_type"),
                               F.col(f.name).alias("missing")) for f in df.schema.fields])
    out = counts.select(F.inline(items)).orderBy(F.col("missing").desc(), "column")
    return out.limit(k) if k else out


def _same_type_pairs(df: DataFrame) -> list[tuple[str, str]]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [(a, b) for a, b in combinations(df.columns, 2) if types[a] == types[b]]


def duplicate_columns(df: DataFrame) -> DataFrame:
    """(column_a, column_b) pairs of one type that agree on every row, null = null.

    A first pass sums one 64-bit hash per column; only pairs with equal sums are
    compared value by value in a second pass.
    """
    spark = df.sparkSession
    empty = spark.createDataFrame([], "column_a string, column_b string")
    pairs = _same_type_pairs(df)
    if not pairs:
        return empty
    marks = df.agg(*[F.sum(F.xxhash64(c).cast("decimal(38,0)")).alias(c) for c in df.columns]).first()
    pairs = [(a, b) for a, b in pairs if marks[a] == marks[b]]
    if not pairs:
        return empty
    differ = df.agg(*[F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias(f"d{i}")
                      for i, (a, b) in enumerate(pairs)])
    items = F.array(*[F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                               F.col(f"d{i}").alias("_d")) for i, (a, b) in enumerate(pairs)])
    return differ.select(F.inline(items)).filter("_d = 0").drop("_d")


def constant_columns(df: DataFrame) -> DataFrame:
    """Columns with one distinct non-null value."""
    aggs = df.agg(*[F.coalesce(F.min(c) == F.max(c), F.lit(False)).alias(c) for c in df.columns])
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("_k")) for c in df.columns])
    return aggs.select(F.inline(items)).filter("_k").drop("_k")


def type_counts(df: DataFrame) -> DataFrame:
    """Number of numeric and of other columns."""
    numeric = sum(isinstance(f.dataType, T.NumericType) for f in df.schema.fields)
    return df.sparkSession.createDataFrame(
        [("numerical", numeric), ("categorical", len(df.columns) - numeric)],
        "kind string, n_columns int")


def label_counts(df: DataFrame, label: str = "aqi_category") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def missing_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, status) of wanted columns that are absent, all null or partly null."""
    present = [c for c in cols if c in df.columns]
    gone = [c for c in cols if c not in df.columns]
    aggs = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in present])
    items = [F.struct(F.lit(c).alias("feature"), F.when(F.col(c) == 0, "all_null")
                      .when(F.col(c) < F.col("_n"), "some_null").alias("status")) for c in present]
    items += [F.struct(F.lit(c).alias("feature"), F.lit("absent").alias("status")) for c in gone]
    return aggs.select(F.inline(F.array(*items))).filter("status is not null")


def audit_report(df: DataFrame, stored: DataFrame, label: str = "aqi_category",
                 means: list[str] | None = None) -> DataFrame:
    """Stored figures against recomputed ones; nothing is overwritten.

    ``stored`` holds (measure, stored_value) with measures ``rows``,
    ``label:<name>`` and ``mean:<column>``. A stored accuracy above 1 is read as
    a percentage.
    """
    means = means or []
    counts = label_counts(df.filter(F.col(label).isNotNull()), label).select(
        F.concat(F.lit("label:"), F.col(label)).alias("measure"), F.col("n").cast("double").alias("actual_value"))
    totals = df.agg(F.count(F.lit(1)).cast("double").alias("rows"), *[F.avg(c).alias(c) for c in means])
    items = [F.struct(F.lit("rows").alias("measure"), F.col("rows").alias("actual_value"))]
    items += [F.struct(F.lit(f"mean:{c}").alias("measure"), F.col(c).alias("actual_value")) for c in means]
    actual = counts.unionByName(totals.select(F.inline(F.array(*items))))
    joined = stored.join(actual, "measure", "full")
    value = F.when(F.col("measure").startswith("accuracy") & (F.col("stored_value") > 1),
                   F.col("stored_value") / 100).otherwise(F.col("stored_value"))
    return joined.select(
        "measure", value.alias("stored_value"), "actual_value",
        F.when(F.col("actual_value").isNull(), "not_recomputed")
        .when(F.col("stored_value").isNull(), "not_stored")
        .when(F.abs(value - F.col("actual_value")) <= 1e-6 * F.greatest(F.lit(1.0), F.abs("actual_value")), "ok")
        .otherwise("differs").alias("status"))
