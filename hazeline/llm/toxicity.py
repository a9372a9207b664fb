"""Toxicity by a classifier chain.

Categories are predicted one after the other by regularised logistic regressions on the words of a text. Each later model
also sees the probabilities of the earlier categories. For training these are out-of-fold predictions, so that a later
model learns from probabilities as good as those it gets when it scores.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm.base import query, table
from hazeline.session import materialise

#: Labelled documents that the models are fitted on at most, those with the smallest hashes of doc_id.
SAMPLE = 10_000
FOLDS = 3
WORDS, SEEN_IN = 20_000, 4
STEM = 4
LAMBDA, ROUNDS = 0.0005, 25
THRESHOLD = 0.3
#: Categories in the order of the chain, as expressions on ``labels``. Documents of low quality are told first.
CHAIN = {"low_quality": "1 - quality", "toxic": "toxic"}


def words(text: Column) -> Column:
    """Distinct lower-case words, and the stems (first four letters) of longer ones; a null text has none."""
    found = F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"), lambda w: w != ""))
    stems = F.array_distinct(F.transform(F.filter(found, lambda w: F.length(w) > STEM), lambda w: F.concat(F.left(w, F.lit(STEM)), F.lit("-"))))
    return F.concat(found, stems)


@dataclass
class Chain:
    names: list[str]
    bag: CountVectorizerModel | None
    models: list[LogisticRegressionModel | float]

    def scored(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a column ``p_<category>`` for each category; all other columns stay. ``text`` is read."""
        if self.bag is None:
            return rows.withColumns({f"p_{n}": F.lit(float(m)) for n, m in zip(self.names, self.models)})
        keep = rows.columns
        out = self.bag.transform(rows.withColumn("__words", words(F.col("text"))))
        for i, (name, model) in enumerate(zip(self.names, self.models)):
            out = _predicted(out, self.names[:i], model, f"p_{name}")
        return out.select(*keep, *[f"p_{n}" for n in self.names])


def _gathered(rows: DataFrame, earlier: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=["__bag", *[f"p_{n}" for n in earlier]], outputCol="__features").transform(rows)


def _fit(rows: DataFrame, earlier: list[str], label: str) -> LogisticRegressionModel | float:
    """A model, or the share of ones where there is one class only (no rows: 0)."""
    known = rows.where(F.col(label).isNotNull())
    kinds = {r[label]: r["count"] for r in known.groupBy(label).count().collect()}
    if len(kinds) < 2:
        return float(next(iter(kinds), 0.0))
    return LogisticRegression(featuresCol="__features", labelCol=label, regParam=LAMBDA, maxIter=ROUNDS, standardization=False,
                              aggregationDepth=2).fit(_gathered(known, earlier).select("__features", label))


def _predicted(rows: DataFrame, earlier: list[str], model: LogisticRegressionModel | float, name: str) -> DataFrame:
    if isinstance(model, float):
        return rows.withColumn(name, F.lit(model))
    drop = ["__features", "__raw", "__probability", "__prediction"]
    model = (model.setFeaturesCol("__features").setRawPredictionCol("__raw").setProbabilityCol("__probability").setPredictionCol("__prediction"))
    out = model.transform(_gathered(rows, earlier))
    return out.withColumn(name, vector_to_array("__probability")[1]).drop(*drop)


def fitted(docs: DataFrame, labels: DataFrame, chain: dict[str, str] = CHAIN, sample: int = SAMPLE, folds: int = FOLDS) -> Chain:
    """Fit the chain on at most ``sample`` labelled documents.

    ``chain`` gives each category's 0/1 value as an expression on ``labels``. Rows without doc_id or text, and labels without a document, teach
    nothing; a repeated doc_id counts once. A category with one class only becomes that constant; without any labelled
    documents all probabilities are 0.
    """
    own = labels.where("doc_id IS NOT NULL").select("doc_id", *[F.expr(e).cast("double").alias(f"y_{n}") for n, e in chain.items()])
    own = own.groupBy("doc_id").agg(*[F.max(f"y_{n}").alias(f"y_{n}") for n in chain])
    few = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumnRenamed("doc_id", "__id")
    rows = (docs.select("doc_id", "text").where("text IS NOT NULL").join(few, F.col("doc_id") == F.col("__id"))
            .groupBy("doc_id", *[f"y_{n}" for n in chain]).agg(F.min("text").alias("text"))
            .select("doc_id", *[f"y_{n}" for n in chain], words(F.col("text")).alias("__words"),
                    F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(folds)).alias("fold")))
    rows = materialise(rows.repartition(4, "doc_id"), "labelled")
    names = list(chain)
    if rows.where(F.size("__words") > 0).isEmpty():
        return Chain(names, None, [0.0] * len(names))
    bag = CountVectorizer(inputCol="__words", outputCol="__bag", vocabSize=WORDS, minDF=float(min(SEEN_IN, rows.count())), binary=True).fit(rows)
    if not bag.vocabulary:
        return Chain(names, None, [0.0] * len(names))
    bagged = materialise(bag.transform(rows).drop("__words"), "bagged")
    models: list[LogisticRegressionModel | float] = []
    for i, name in enumerate(names):
        models.append(_fit(bagged, names[:i], f"y_{name}"))
        if name != names[-1]:
            parts = None
            for k in range(folds):
                model = _fit(bagged.where(F.col("fold") != k), names[:i], f"y_{name}")
                part = _predicted(bagged.where(F.col("fold") == k), names[:i], model, f"p_{name}")
                parts = part if parts is None else parts.unionByName(part)
            bagged = materialise(parts, "folds")
    return Chain(names, bag, models)


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with p_low_quality, p_toxic and ``toxic`` (0 or 1), one row for each row.

    A null or empty text has no words, so its probabilities are the models' intercepts. Rows without doc_id are judged like others.
    """
    out = fitted(docs, labels).scored(docs)
    return out.withColumn("toxic", (F.col("p_toxic") >= threshold).cast("int"))


@query("op5_toxicity_chain")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return judged(docs, table(spark, folder, "labels")).drop("text")
