"""Mixing sources to target weights by the cube method.

Every document starts with the inclusion probability target / source size. Its whole part is taken for sure; the fraction
goes through the cube method: in the flight phase three undecided documents at a time move along the null space of the
constraints (total of words, number of documents) until one of them reaches 0 or 1, so both totals stay as they are. What
no such move can decide is carried to the next round, where the leftovers of many blocks meet, and the last few documents
of a source land on the combination whose total is nearest.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazeline.llm.base import keyed, query, table, word_count
from hazeline.session import materialise

WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3
BLOCK = 2_000
LANDING = 10
#: A document with more than this share of its source's words is decided before the flight; a source has fewer than 200 such.
GIANT = 0.005
_NEAR = 1e-9


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Target of each source. ``sizes`` has one row (source, source_size, ..) for each source.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all sizes. A target stops at ``most``
    times its source's size, and the excess goes to the others by weight: sources are filled in the order of size for each
    unit of weight, and each first gets the level that what is left allows. No rows give no rows.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1,
                                  F.lit(len(weights))) + 1).cast("int"))
    order = Window.orderBy("cap_level", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = (sizes.withColumn("weight", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
           .withColumn("cap_level", F.col("cap") / F.col("weight"))
           .withColumn("left", F.sum("source_size").over(everything).cast("double")
                       - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("rest", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
           .withColumn("level", F.col("left") / F.col("rest"))
           .withColumn("open", F.col("cap_level") > F.col("level")))
    level = F.min(F.when(F.col("open"), F.struct(F.col("cap_level"), F.col("level")))).over(everything)["level"]
    return (out.withColumn("at", level)
            .withColumn("target", F.when(F.col("at").isNull() | (F.col("cap") <= F.col("at") * F.col("weight")), F.col("cap"))
                        .otherwise(F.col("at") * F.col("weight")))
            .drop("cap", "cap_level", "left", "rest", "level", "open", "at"))


def fly(chance: np.ndarray, size: np.ndarray, keep: int, rng: np.random.Generator) -> np.ndarray:
    """Flight phase: probabilities after moves in the null space, with at most ``max(keep, 2)`` left undecided."""
    p = chance.astype(float).tolist()
    s = size.astype(float).tolist()
    todo = [i for i, x in enumerate(p) if _NEAR < x < 1 - _NEAR]
    todo.reverse()
    alive, open_ = [], len(todo)
    while open_ > max(keep, 2):
        while len(alive) < 3:
            alive.append(todo.pop())
        a, b, c = alive
        move = (s[b] - s[c], s[c] - s[a], s[a] - s[b])
        if move == (0.0, 0.0, 0.0):
            move = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i, u in zip(alive, move):
            if u > 0:
                up, down = min(up, (1 - p[i]) / u), min(down, p[i] / u)
            elif u < 0:
                up, down = min(up, -p[i] / u), min(down, -(1 - p[i]) / u)
        step = up if rng.random() * (up + down) < down else -down
        for i, u in zip(alive, move):
            p[i] = min(1.0, max(0.0, p[i] + step * u))
            if p[i] < _NEAR or p[i] > 1 - _NEAR:
                p[i] = float(round(p[i]))
        left = [i for i in alive if 0 < p[i] < 1]
        open_ -= len(alive) - len(left)
        alive = left
    return np.array(p)


def land(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Landing phase: of all decisions on the undecided few, the one nearest in words, then in documents."""
    out, few = chance.copy(), np.flatnonzero((chance > 0) & (chance < 1))
    if len(few):
        every = (np.arange(1 << len(few))[:, None] >> np.arange(len(few))) & 1
        words = np.abs(every @ size[few] - chance[few] @ size[few])
        rows = np.abs(every.sum(1) - chance[few].sum())
        out[few] = every[np.lexsort((rows, np.round(words, 6)))[0]]
    return out


def _round(turn: int, last: str = "last"):
    def one(rows: pd.DataFrame) -> pd.DataFrame:
        # the longest and the shortest come first, in turn: exchanging them is what decides a very long document, and the
        # undecided few at the end are of middling length and land near the target
        rows = rows.sort_values(["size", "dice", "row"], ascending=[False, True, True], kind="stable")
        turns = np.empty(len(rows), int)
        turns[::2], turns[1::2] = np.arange((len(rows) + 1) // 2), np.arange(len(rows) - 1, (len(rows) + 1) // 2 - 1, -1)
        rows = rows.iloc[turns]
        source, block, final = rows["source"].iloc[0], int(rows["block"].iloc[0]), bool(rows[last].iloc[0])
        seed = zlib.crc32(f"{turn}/{block}/{source!r}".encode())
        size, chance = rows["size"].to_numpy(float), rows["chance"].to_numpy(float)
        chance = fly(chance, size, LANDING if final else 2, np.random.default_rng(seed))
        return rows.assign(chance=land(chance, size) if final else chance)

    return one


def decide(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Turn ``chance`` of rows (row, dice, source, size, chance) into 0 or 1, in rounds over blocks of a source.

    A source's rows are spread over blocks of about ``block`` rows by ``dice``, whatever share of the table it has. Each
    round leaves two rows of a block at most, so the number of rounds is the logarithm of the rows to the base of ``block``/2.
    """
    done, turn, open_ = None, 0, rows
    while True:
        counts = open_.groupBy("source").agg(F.ceil(F.count("*") / F.lit(block)).alias("blocks"))
        parts = (open_.join(counts.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
                 .withColumn("block", F.pmod(F.xxhash64("dice", F.lit(turn)), F.col("blocks")).cast("int"))
                 .withColumn("last", F.col("blocks") == 1))
        schema = parts.schema
        out = materialise(parts.groupBy("source", "block").applyInPandas(_round(turn), schema)
                          .drop("block", "last", "blocks"), "cube")
        is_open = (F.col("chance") > 0) & (F.col("chance") < 1)
        settled = out.where(~is_open)
        done = settled if done is None else done.unionByName(settled)
        open_ = out.where(is_open)
        if open_.isEmpty():
            return done
        turn += 1


def _giants(rows: pd.DataFrame) -> pd.DataFrame:
    """Round the longest documents of a source one after the other, each making up for the error so far.

    A document is rounded to the nearer side unless all documents after it couldn't make up for that.
    """
    rows = rows.sort_values(["size", "dice", "row"], ascending=[False, True, True], kind="stable")
    error, out, rest = 0.0, [], float(rows["source_size"].iloc[0])
    for size, chance in zip(rows["size"].to_numpy(float), rows["chance"]):
        error += chance * size
        rest -= size
        over, under = max(0.0, size - error - chance * rest), max(0.0, error - (1 - chance) * rest)
        out.append(float(over < under or (over == under and error >= size / 2)))
        error -= out[-1] * size
    return rows.assign(chance=out)


def _giants_first(rows: DataFrame) -> DataFrame:
    """Decide documents that outweigh the others, and let the chance of the others make up for it."""
    giant = (F.col("size") > F.lit(GIANT) * F.col("source_size")) & (F.col("chance") > 0)
    big = materialise(rows.where(giant).groupBy("source").applyInPandas(_giants, rows.schema), "giants")
    drift = (big.groupBy("source").agg(F.sum(F.col("chance") * F.col("size")).alias("__taken"), F.sum("size").alias("__size"))
             .withColumnRenamed("source", "__s"))
    left = F.col("source_size") - F.col("__size")
    rest = (rows.where(~giant).join(drift, F.col("source").eqNullSafe(F.col("__s")), "left")
            .withColumn("chance", F.when(F.col("__size").isNull() | (F.col("chance") == 0), F.col("chance")).otherwise(
                F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(
                    F.col("chance") * F.col("source_size") - F.col("__taken"), left.cast("double")), F.lit(0.0))))))
            .drop("__s", "__taken", "__size"))
    return rest.unionByName(big)


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row for each document: its key, size, its source's size and target, and ``copies``, how often the mix takes it.

    ``docs`` has doc_id, text, source; other columns are ignored. A null text has size 0; a null source is a source of its
    own, the last one. Repeated rows count one by one. Documents without words are never undecided and get the whole part
    of their source's ratio. An empty table gives an empty result. Equal input gives equal results: all choices follow from hashes of the rows.
    """
    rows = materialise(keyed(docs, source=F.col("source"), size=word_count(F.col("text"))), "mix")
    sizes = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, float(most))
    rows = (rows.join(sizes.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s", "weight")
            .withColumn("ratio", F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0)))
            .withColumn("whole", F.floor(F.col("ratio") + F.lit(_NEAR)))
            .withColumn("chance", F.greatest(F.lit(0.0), F.col("ratio") - F.col("whole")))
            .withColumn("chance", F.when((F.col("size") == 0) | (F.col("chance") < _NEAR), 0.0).otherwise(F.col("chance")))
            .withColumn("dice", F.xxhash64("doc_id", "__h", "__k")))
    plain = ["doc_id", "source", "size", "source_size", "target", "whole", "chance", "dice"]
    rows = rows.select(*plain, F.col("__h").alias("text_hash"), F.col("__k").alias("repeat"),
                       F.concat_ws("/", F.col("doc_id").cast("string"), F.col("__h").cast("string"),
                                   F.col("__k").cast("string")).alias("row"))
    return decide(materialise(_giants_first(rows), "chances")).select(
        "doc_id", "source", "size", "source_size", "target", "text_hash", "repeat",
        (F.col("whole") + F.col("chance")).cast("int").alias("copies"))


def take(docs: DataFrame) -> DataFrame:
    """The mix itself: the documents, each as often as it is taken, with the columns of ``docs``."""
    plan = mixed(docs).select(F.col("doc_id").alias("__d"), "text_hash", "repeat", "copies").where("copies > 0")
    own = keyed(docs)
    return (own.join(plan, F.col("doc_id").eqNullSafe(F.col("__d")) & F.col("__h").eqNullSafe(F.col("text_hash"))
                     & (F.col("__k") == F.col("repeat")))
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns))


@query("op9_mix_cube")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    out = mixed(table(spark, folder, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                      "source", "copies")
