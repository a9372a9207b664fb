"""Encoders fitted on one frame and applied to another."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from hazeline.operators.ranks import constant_if_small, ranked


@dataclass(frozen=True)
class Scaling:
    """Means and population standard deviations, one row, as a DataFrame."""

    stats: DataFrame
    cols: tuple[str, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        s = self.stats.scalar()
        df = df.withColumn("_s", s)
        return df.select(*[((F.col(c) - F.col(f"_s.m_{c}")) / F.col(f"_s.s_{c}")).alias(c)
                           if c in self.cols else F.col(c) for c in df.columns if c != "_s"])

    def inverse(self, df: DataFrame) -> DataFrame:
        df = df.withColumn("_s", self.stats.scalar())
        return df.select(*[(F.col(c) * F.col(f"_s.s_{c}") + F.col(f"_s.m_{c}")).alias(c)
                           if c in self.cols else F.col(c) for c in df.columns if c != "_s"])


def fit_scaling(train: DataFrame, cols: list[str]) -> Scaling:
    """Standard scaling as the source system does it: population deviation, 1 where it is 0.

    The training rows are read once, here; the statistics are kept as one constant row.
    """
    stats = train.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in cols], *[
        F.when(F.stddev_pop(c) == 0, 1.0).otherwise(F.stddev_pop(c)).alias(f"s_{c}") for c in cols]).alias("s"))
    return Scaling(constant_if_small(stats), tuple(cols))


def label_encode(df: DataFrame, col: str, out: str) -> DataFrame:
    """Alphabetical integer code from 0; a null has none.

    The distinct values are ranked in buckets by their first letters, so many of them aren't ordered in one task. A short table
    of codes is then looked up without moving the rows.
    """
    values = df.select(F.col(col)).distinct().filter(F.col(col).isNotNull())
    bucket = (F.floor(F.col(col).cast("double") / 4096) if isinstance(df.schema[col].dataType, NumericType)
              else F.substring(F.hex(F.col(col).cast("string")), 1, 6))
    codes = ranked(values, [], bucket, [col]).select(F.col(col).alias("_value"), F.col("_pos").cast("int").alias(out))
    codes = constant_if_small(codes)
    return df.join(codes, F.col(col) == F.col("_value"), "left").select(*df.columns, out)


def onehot(df: DataFrame, col: str, values: list[str], prefix: str | None = None) -> DataFrame:
    """0/1 columns for the given values; a value outside the list gives zeros."""
    p = prefix or col
    return df.withColumns({f"{p}_{v}": F.coalesce((F.col(col) == v).cast("int"), F.lit(0)) for v in values})
