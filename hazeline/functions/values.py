"""Scalar helpers: parsing, coercion, labels, calendar."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.schema import BANDS, LABELS

TIME_FORMATS = (
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm", "dd-MM-yyyy HH:mm", "dd/MM/yyyy HH:mm", "yyyy-MM-dd",
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_if_nan(col: Column | str) -> Column:
    """NaN -> null, so that aggregates and comparisons skip it."""
    return F.when(~F.isnan(_c(col)), _c(col))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Apply :func:`null_if_nan` to every floating column."""
    floats = {f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[null_if_nan(c).alias(c) if c in floats else F.col(c) for c in df.columns])


def parse_ts(col: Column | str, formats=TIME_FORMATS) -> Column:
    """First format that fits; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(_c(col), F.lit(f)) for f in formats])


def coerce(col: Column | str, fallback: Column | float) -> Column:
    """Text to double; empty, null or bad text gives the fallback."""
    fb = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.coalesce(F.trim(_c(col)).try_cast("double"), fb.cast("double"))


def encode(col: str, labels=LABELS) -> Column:
    """Ordinal 0..k-1 of a label column, null when unknown."""
    pairs = ", ".join(f"'{lab}', {i}" for i, lab in enumerate(labels))
    return F.expr(f"try_element_at(map({pairs}), {col})")


def decode(col: str, labels=LABELS, unknown: str = "Unknown") -> Column:
    """Label of an ordinal (column name or SQL expression), ``unknown`` when out of range or null."""
    pairs = ", ".join(f"{i}, '{lab}'" for i, lab in enumerate(labels))
    return F.expr(f"coalesce(try_element_at(map({pairs}), CAST({col} AS INT)), '{unknown}')")


def band_ordinal(col: str) -> Column:
    """Ordinal of an index band, so that it can be compared with the target's ordinal."""
    return encode(col, BANDS)


def cyclical(df: DataFrame, time: str = "dt") -> DataFrame:
    """hour_sin/cos over 24 hours, month_sin/cos over 12 months counted from January = 0."""
    h = F.lit(2 * math.pi) * F.hour(time) / 24
    m = F.lit(2 * math.pi) * (F.month(time) - 1) / 12
    return df.withColumns({"hour_sin": F.sin(h), "hour_cos": F.cos(h),
                           "month_sin": F.sin(m), "month_cos": F.cos(m)})


def calendar(df: DataFrame, time: str = "dt") -> DataFrame:
    """year, month, day, hour and day_of_week with Monday = 0."""
    return df.withColumns({"year": F.year(time), "month": F.month(time), "day": F.day(time),
                           "hour": F.hour(time), "day_of_week": F.weekday(time)})


def target_time(time: Column | str, hours: Column | int) -> Column:
    h = hours if isinstance(hours, Column) else F.lit(hours)
    return _c(time) + F.make_interval(hours=h)


def sentiment_label(polarity: Column | str) -> Column:
    p = _c(polarity)
    return F.when(p > 0, "Positive").when(p < 0, "Negative").otherwise("Neutral")


def slug(model: Column | str) -> Column:
    """File-name form of a model name: lower case, blanks to underscores."""
    return F.replace(F.lower(_c(model)), F.lit(" "), F.lit("_"))


def horizon_slug(model: Column | str, horizon: Column | str) -> Column:
    return F.format_string("forecast_%dh_%s", _c(horizon), slug(model))
