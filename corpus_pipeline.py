"""A training corpus from raw documents: toxicity, near copies, benchmark leaks, source mix, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared folder and reads it again as
the next stage's input. All stages but the last return the columns of ``documents``; the last gives each row's shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from hazeline.llm.base import table
from hazeline.session import materialise


_READ = ("doc_id", "text", "source")


def _packed(docs: DataFrame) -> DataFrame:
    """The columns that stages read, and all others in one column, so that no name of theirs can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in _READ]
    return docs.select(*_READ, (F.struct(*rest) if rest else F.lit(0)).alias("__rest"))


def _unpacked(out: DataFrame, columns: list[str]) -> DataFrame:
    return out.select(*[F.col(c) if c in _READ else F.col("__rest").getField(c).alias(c) for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the classifier chain doesn't reject. It learns from ``labels`` and the documents that these name.

    A null or empty text stays. Repeated rows are judged alike. Empty tables give an empty result.
    """
    chain = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return _unpacked(chain.scored(_packed(docs)).where(F.col("p_toxic") < toxicity.THRESHOLD), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies: the one with the group's smallest doc_id.

    Documents without words are in no group and all stay. A group of which no row has a doc_id keeps one row, too. Of rows
    that repeat a doc_id in a group, one stays: the one of the largest set, then of the first text. Groups that share a
    doc_id keep a row each.
    """
    found = ngram_join.joined(docs).where(F.col("root").isNotNull())
    # the signature of a set is in one group only, so (doc_id, signature) names the rows of one group
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", -F.col("n_shingles"), F.bitwise_not("class").alias("last"), "class"))
    classes = found.groupBy("root").agg(best.alias("b")).select(F.col("b")["doc_id"].alias("__d"), F.col("b")["class"].alias("__c"))
    tagged = ngram_join.tagged(_packed(docs))
    kept = tagged.join(classes, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("__class") == F.col("__c")), "left_semi")
    # combined in the map tasks, so copies without a doc_id don't meet in one of them
    first = kept.groupBy("doc_id", "__class").agg(F.min_by(F.struct("text", "source", "__rest"), "text").alias("__row"))
    first = first.select("doc_id", "__row.text", "__row.source", "__row.__rest")
    return _unpacked(first.unionByName(tagged.where(F.col("__class").isNull()).drop("__class")), docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in which no benchmark item occurs within the allowed edits. Null and empty texts stay."""
    out = decontaminate.flagged(_packed(docs), table(spark, sf_dir, "benchmark"))
    return _unpacked(out.where(F.size("__items") == 0), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all up to three times."""
    return _unpacked(mixing.take(_packed(docs)), docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, shard and slot of every row, copies of a text in one shard where it has room."""
    return sharding.sharded(docs).select("doc_id", "size", "text_crc32", "shard", "slot", "linked")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("mix", mix_sources),
    ("shard", shard),
]

#: Classifiers, the cube method and the walks have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
