"""Registry of this subpackage's queries, and helpers that its operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    """Register ``f(spark, folder)``, with its SQL where there is one."""

    def wrap(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, so that extra columns never clash with an operator's own."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def word_count(text) -> F.Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, within: str, by: str, rows: int, per_block: int = 100_000) -> DataFrame:
    """Add ``number``, gapless from 0 in each value of ``within``, without one task that sees all rows.

    Rows fall into hash blocks of about ``per_block`` rows by the unique column ``by``. They are numbered inside their block,
    and a block starts at the count of the blocks before it. Only that table of counts meets in one place.
    """
    blocks = rows // per_block + 1
    df = df.withColumn("__block", F.pmod(F.xxhash64(by), F.lit(blocks)))
    before = Window.partitionBy(within).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (df.groupBy(within, "__block").agg(F.count("*").alias("__n"))
              .select(F.col(within).alias("__w"), F.col("__block").alias("__b"),
                      F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")))
    inside = F.row_number().over(Window.partitionBy(within, "__block").orderBy(by)) - 1
    return (df.withColumn("__in", inside)
            .join(starts, F.col(within).eqNullSafe(F.col("__w")) & (F.col("__block") == F.col("__b")), "left")
            .withColumn("number", F.col("__start") + F.col("__in"))
            .drop("__in", "__w", "__b", "__start", "__block"))


def keyed(docs: DataFrame, **more) -> DataFrame:
    """Add ``__h`` (hash of text and source) and ``__k`` (1, 2, .. among rows that also share the id): a key of each row.

    Given ``more`` columns, the result holds these and doc_id instead of all columns, so the texts aren't shuffled. Rows that
    share the key are numbered by a hash of all columns (but maps, which have none), so every run numbers them alike;
    rows that share that as well are alike.
    """
    plain = [f"`{f.name}`" for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    own = Window.partitionBy("doc_id", "__h").orderBy("__all")
    hashed = docs.withColumns({"__h": F.xxhash64("text", "source"), "__all": F.xxhash64(*plain)})
    if more:
        hashed = hashed.select("doc_id", "__h", "__all", *[c.alias(n) for n, c in more.items()])
    return hashed.withColumn("__k", F.row_number().over(own)).drop("__all")
