"""Quality by Bradley-Terry pairwise ranking.

A document's strength is a linear function of features of its text. In a preference pair the better document wins with the
logistic probability of the difference in strength, so a logistic regression without intercept on feature differences learns
the weights. The threshold is the quantile of the training strengths at the share of poor documents.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm.base import numbered, query, table
from hazeline.llm.words import texts
from hazeline.operators.quantiles import quantiles
from hazeline.session import materialise

PAIRS = 6
CUT = 0.3
FEATURES = ["upper", "digits", "marks", "symbols", "other", "lines", "word_length", "long_words", "distinct", "top_word", "marked_words", "upper_words",
            "words", "few_words", "repeats"]

_KIND = np.zeros(256, np.int64)
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[33, 63]] = 3
_KIND[[35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 124, 125, 126]] = 4
_KIND[[34, 39, 40, 41, 44, 45, 46, 47, 58, 59]] = 5
_KIND[10] = 6


def _features(batch: pa.RecordBatch) -> np.ndarray:
    """One row of features for each text, all between 0 and about 1."""
    out = np.zeros((batch.num_rows, len(FEATURES)))
    for w in texts(batch, "text"):
        h, n, size = w.hashes(), w.counts(), np.diff(w.bounds)
        text = np.repeat(np.arange(w.texts), size)
        kinds = np.bincount(text * 8 + _KIND[w.data], minlength=8 * w.texts).reshape(-1, 8)[:, 1:7] / np.maximum(size, 1)[:, None]
        length = w.end - w.start
        total = lambda x: np.bincount(w.text, weights=x, minlength=w.texts) / np.maximum(n, 1)
        last, head = _KIND[w.data[w.end - 1]] if len(h) else h, _KIND[w.data[w.start]] if len(h) else h
        again = np.append(False, (h[1:] == h[:-1]) & (w.text[1:] == w.text[:-1]))[:len(h)]
        first = np.cumsum(n) - n
        distinct, top = np.zeros(w.texts), np.zeros(w.texts)
        for i, c in enumerate(n):
            if c:
                many = np.unique(h[first[i]:first[i] + c], return_counts=True)[1]
                distinct[i], top[i] = len(many) / c, many.max() / c
        rows = slice(w.first, w.first + w.texts)
        out[rows, :6] = np.minimum(1, kinds * np.array([1, 4, 8, 8, 4, 8]))
        out[rows, 6] = np.minimum(1, total(length) / 20)
        out[rows, 7] = total(length > 25)
        out[rows, 8], out[rows, 9] = distinct, top
        out[rows, 10] = total((last == 4) | (last == 3))
        out[rows, 11] = total(head == 1)
        out[rows, 12] = np.log1p(n) / 12
        out[rows, 13] = np.exp(-n / 8.0)
        out[rows, 14] = total(again)
    return out


def _measure(batches):
    for batch in batches:
        x = _features(batch)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "x"])


def _strength(weights: np.ndarray, middle: float):
    def run(batches):
        for batch in batches:
            s = _features(batch) @ weights - middle + math.log(CUT / (1 - CUT))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(s, -500, 500))))], ["doc_id", "score"])

    return run


def fitted(docs: DataFrame, labels: DataFrame, pairs: int = PAIRS) -> tuple[np.ndarray, float]:
    """Weights and the threshold strength, from all labelled documents.

    ``labels`` has doc_id and quality. Each document of the smaller class meets ``pairs`` of the other, spread evenly. With one
    class only all weights are 0, and everything is at the threshold if that class is the good one or there are no labels, and
    below it if it is the poor one.
    """
    own = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).agg(F.max("quality").alias("quality"))
    # measured before the join, so that no text is shuffled
    x = docs.select("doc_id", "text").mapInArrow(_measure, "doc_id long, x array<double>")
    rows = x.join(own, F.col("doc_id") == F.col("__id")).select("doc_id", "quality", "x").dropDuplicates(["doc_id"])
    rows = materialise(rows, "measured")
    many = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    good, poor = many.get(1, 0), many.get(0, 0)
    zero = np.zeros(len(FEATURES))
    if not good or not poor:
        return zero, 1e-9 if poor else 0.0
    rows = numbered(rows, "quality", "doc_id", sum(many.values())).withColumnRenamed("number", "n")
    scale = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.stddev_pop("v").alias("s")).orderBy("i").collect()
    spread = np.array([r["s"] or 1.0 for r in scale])
    less, more = (0, 1) if poor <= good else (1, 0)
    size = good if more else poor
    left = rows.where(F.col("quality") == less).select("n", F.col("x").alias("a")).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(pairs - 1))))
    left = left.withColumn("m", F.pmod(F.xxhash64("n", "j"), F.lit(size)))
    right = rows.where(F.col("quality") == more).select(F.col("n").alias("m"), F.col("x").alias("b"))
    sign = 1.0 if less else -1.0
    # each pair once from either side, so that both outcomes occur
    turn = F.when(F.pmod(F.xxhash64("n", "j", F.lit(2)), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    unit = F.array(*[F.lit(float(1 / s)) for s in spread])
    table_ = (left.join(right, "m").withColumn("turn", turn)
              .withColumn("d", F.zip_with(F.zip_with("a", "b", lambda p, q: p - q), unit, lambda p, q: p * q))
              .select(array_to_vector(F.transform("d", lambda v: v * F.col("turn") * F.lit(sign))).alias("features"), ((F.col("turn") + 1) / 2).alias("label")))
    model = LogisticRegression(fitIntercept=False, regParam=1e-3, maxIter=60, standardization=False).fit(materialise(table_, "pairs"))
    weights = model.coefficients.toArray() / spread
    dot = F.aggregate(F.zip_with("x", F.array(*[F.lit(float(v)) for v in weights]), lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    share = poor / (good + poor)
    return weights, float(quantiles(rows.select(dot.alias("s")), [], "s", [share]).first()["q0"])


def scored(docs: DataFrame, labels: DataFrame, model: tuple[np.ndarray, float] | None = None) -> DataFrame:
    """doc_id and score (0 to 1; ``CUT`` is the threshold) of every row.

    Null and empty texts have no words and get the score of their features. Rows with a null or repeated doc_id are scored like
    others; other columns are ignored; an empty table gives an empty result.
    """
    weights, middle = model or fitted(docs, labels)
    return docs.select("doc_id", "text").mapInArrow(_strength(weights, middle), "doc_id long, score double")


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query("op7_quality_pairs")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    learn = table(spark, folder, "labels").where(~held_out("doc_id"))
    out = scored(docs, learn)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
