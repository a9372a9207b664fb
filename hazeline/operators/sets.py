"""Set operations on rows and columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions.values import encode
from hazeline.schema import LABELS


def union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def append_current(history: DataFrame, current: DataFrame) -> DataFrame:
    """Current rows after the history; columns only the history has become null."""
    return history.unionByName(current.select(*[c for c in history.columns if c in current.columns]),
                               allowMissingColumns=True)


def column_sets(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, side): in both, only in the frame, only in the list."""
    have, want = set(df.columns), set(cols)
    rows = ([(c, "both") for c in df.columns if c in want] + [(c, "frame_only") for c in df.columns if c not in want]
            + [(c, "list_only") for c in cols if c not in have])
    return df.sparkSession.createDataFrame(rows, "column string, side string")


def labels_present(df: DataFrame, label: str = "aqi_category", labels=LABELS) -> DataFrame:
    """Distinct labels of the table in canonical order."""
    return (df.select(label).distinct().withColumn("label_id", encode(label, labels))
            .filter("label_id is not null").orderBy("label_id"))
