"""Joins: as-of history, labels, metrics, city mentions."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.operators.panel import chunked, own_rows, window

# Bytes of city names that one automaton holds.
NAME_BYTES = 8 << 20


def day_bucket(time: str) -> Column:
    return F.unix_date(F.to_date(time))


def asof_attach(left: DataFrame, right: DataFrame, by: list[str], time: str, payload: str,
                salts: int = 1) -> DataFrame:
    """Each left row with the ``payload`` of the last right row strictly before it.

    Union and carry: both sides share one window per (by, day), and the last
    payload of earlier days arrives from a small per-day table. No pair of rows
    is ever compared, and no task holds a whole city. Where one day of one city
    holds too many left rows, ``salts`` splits them and repeats that day's right
    rows, of which there are at most 24 in an hourly panel.
    """
    keys = [*by, "_bucket"]
    day = day_bucket(time).alias("_bucket")
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    l = left.select(*by, time, day, F.struct(*left.columns).alias("_row"), F.lit(0).alias("_side"),
                    (spread if salts > 1 else F.lit(0)).alias("_salt"))
    r = right.select(*by, time, day, F.col(payload).alias("_pay"), F.lit(1).alias("_side"))
    spots = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))) if salts > 1 else F.lit(0)
    both = l.unionByName(r.select("*", spots.alias("_salt")), allowMissingColumns=True)
    # at equal times the left row comes first, so an equal time does not match
    w = (Window.partitionBy(*keys, "_salt").orderBy(time, "_side")
         .rowsBetween(Window.unboundedPreceding, 0))
    carried = both.withColumn("_in", F.last("_pay", ignorenulls=True).over(w)).filter("_side = 0")
    ends = r.groupBy(*keys).agg(F.max_by("_pay", time).alias("_end"))
    seen = left.select(*by, day).distinct()
    grid = ends.join(seen, keys, "full")
    wb = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = grid.select(*keys, F.last("_end", ignorenulls=True).over(wb).alias("_prev"))
    out = carried.join(before, keys, "left")
    return out.select("_row.*", F.coalesce("_in", "_prev").alias(payload))


def asof_history(requests: DataFrame, df: DataFrame, n: int, cols: list[str], city: str = "city",
                 time: str = "dt") -> DataFrame:
    """Requests with the array ``history`` of the last n rows before their time, oldest first."""
    base = chunked(df, n - 1, 0, [city], time)
    w = window([city]).rowsBetween(1 - n, 0)
    hist = own_rows(base.withColumn("history", F.collect_list(F.struct(time, *cols)).over(w)))
    return asof_attach(requests, hist, [city], time, "history")


def attach_label(df: DataFrame, labels: DataFrame, on: str) -> DataFrame:
    """Name of a label id; Spark broadcasts the label table while it is small."""
    return df.join(labels, on, "left")


def label_table(spark, labels: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(labels)), "label_id int, label_name string")


def attach_metrics(preds: DataFrame, metrics: DataFrame, on=("horizon_hours", "model")) -> DataFrame:
    return preds.join(metrics, list(on), "left")


def replace_models(metrics: DataFrame, new: DataFrame, names: list[str]) -> DataFrame:
    """Rows of the named models out, the new rows in."""
    kept = metrics.filter(F.col("model").isNull() | ~F.col("model").isin(*names))
    return kept.unionByName(new, allowMissingColumns=True)


def update_metrics(metrics: DataFrame, new: DataFrame, on=("model",), keep: tuple = ()) -> DataFrame:
    """New values where a row matches; otherwise, and for ``keep``, the old ones."""
    on = list(on)
    cols = [c for c in new.columns if c not in on and c not in keep and c in metrics.columns]
    fresh = new.select(*on, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in cols])
    out = metrics.join(fresh, on, "left")
    return out.select(*[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
                        if c in cols else F.col(c) for c in metrics.columns])


def city_mentions(docs: DataFrame, cities: DataFrame, default: str = "Delhi", key: str = "doc_id",
                  text: str = "text", block_bytes: int = NAME_BYTES) -> DataFrame:
    """(key, city): first city in alphabetical order whose name occurs in the text, in any case of letters; one row per document.

    Names are compiled into automata, each of a bounded number of bytes, and each text is streamed through them once. So
    a list of any length takes the same way, the texts stay where they are, and repeated keys need no care. A null
    text mentions nobody.
    """
    names = (cities.filter("city is not null and city <> ''").groupBy(F.lower("city").alias("_name")).agg(F.min("city").alias("city")))
    size = names.agg(F.coalesce(F.sum(F.octet_length("_name")), F.lit(0)).alias("n")).first().n
    blocks = size // block_bytes + 1
    found = []
    for b in range(blocks):
        own = names if blocks == 1 else names.filter(F.pmod(F.xxhash64("_name"), F.lit(blocks)) == b)
        rows = [tuple(r) for r in own.collect()]
        if rows:
            found.append(_finder(rows)("_body"))
    best = F.least(*found) if len(found) > 1 else found[0] if found else F.lit(None).cast("string")
    return docs.select(key, F.lower(text).alias("_body")).select(key, F.coalesce(best, F.lit(default)).alias("city"))


def _finder(names: list[tuple[str, str]]):
    """A column function: the least city of those whose lower-case name occurs in a lower-case text."""

    @F.pandas_udf("string")
    def find(bodies: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = ahocorasick.Automaton()
        for name, city in names:
            machine.add_word(name, city)
        machine.make_automaton()
        for body in bodies:
            yield body.map(lambda t: min((c for _, c in machine.iter(t)), default=None) if t else None)

    return find
