"""Distributed learners and scoring."""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, LinearSVC, LogisticRegression,
    NaiveBayes, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.feature import PCA, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.functions.values import decode
from hazeline.operators.boosting import BoostedTrees
from hazeline.operators.networks import ReluNetwork
from hazeline.schema import LABELS


def prepare(features: list[str], city: str | None = None) -> list:
    """Assemble, standardise and, if asked, append the one-hot city (all zero for an unknown one)."""
    stages = [VectorAssembler(inputCols=features, outputCol="_num", handleInvalid="error"),
              StandardScaler(inputCol="_num", outputCol="_std" if city else "features", withMean=True, withStd=True)]
    if city:
        stages += [StringIndexer(inputCol=city, outputCol="_city_id", handleInvalid="keep"),
                   OneHotEncoder(inputCol="_city_id", outputCol="_city", dropLast=True),
                   VectorAssembler(inputCols=["_std", "_city"], outputCol="features")]
    return stages


def fit(estimator: Estimator, train: DataFrame, features: list[str], city: str | None = None) -> PipelineModel:
    """Fit the preparation and the estimator.

    One-vs-rest learners need every class from 0 up. Where the training rows
    lack one, the classes are numbered without gaps for the fit, and the model
    turns its predictions back and names its ``classes``.
    """
    pipeline = Pipeline(stages=[*prepare(features, city), estimator])
    if not isinstance(estimator, OneVsRest):
        return pipeline.fit(train)
    label = estimator.getLabelCol()
    classes = sorted(int(r[0]) for r in train.select(label).distinct().collect())
    if classes == list(range(len(classes))):
        return pipeline.fit(train)
    codes = ", ".join(f"{c}, {i}" for i, c in enumerate(classes))
    dense = train.withColumn(label, F.expr(f"CAST(element_at(map({codes}), CAST({label} AS INT)) AS DOUBLE)"))
    known = f"array({', '.join(map(str, classes))})"
    back = SQLTransformer(statement=(
        f"SELECT * EXCEPT (prediction), {known} AS classes, "
        f"CAST(element_at({known}, CAST(prediction AS INT) + 1) AS DOUBLE) AS prediction FROM __THIS__"))
    return PipelineModel(stages=[*pipeline.fit(dense).stages, back])


def logistic(label: str = "target", weight: str | None = "weight", max_iter: int = 1000) -> Estimator:
    return _weighted(LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter), weight)


def tree(label: str = "target", weight: str | None = "weight", leaf: int = 5, depth: int = 30) -> Estimator:
    return _weighted(DecisionTreeClassifier(labelCol=label, minInstancesPerNode=leaf, maxDepth=depth, seed=42), weight)


def forest(label: str = "target", weight: str | None = "weight", n: int = 100, depth: int = 18,
           leaf: int = 5) -> Estimator:
    """Class balancing uses row weights for every tree, not one weighting per bootstrap."""
    return _weighted(RandomForestClassifier(labelCol=label, numTrees=n, maxDepth=depth, minInstancesPerNode=leaf,
                                            seed=42), weight)


def boost_hist(label: str = "target", weight: str | None = "weight", rounds: int = 250, rate: float = 0.08,
               depth: int = 5, l2: float = 0.05) -> Estimator:
    """Multiclass boosting over 255 bins: softmax loss, an l2 term in the leaves, leaves of at least 20 rows."""
    return _weighted(BoostedTrees(labelCol=label, rounds=rounds, rate=rate, depth=depth, l2=l2, leaf=20), weight)


def boost_sampled(label: str = "target", rounds: int = 200, rate: float = 0.05, depth: int = 8) -> Estimator:
    """Multiclass boosting of deeper trees, each on 0.8 of the rows and of the columns; leaves of hessian 1 at least."""
    return BoostedTrees(labelCol=label, rounds=rounds, rate=rate, depth=depth, l2=1.0, leaf=1, mass=1.0, rows=0.8, columns=0.8, doubled=True)


def linear_svm(label: str = "target", weight: str | None = "weight", max_iter: int = 100) -> Estimator:
    return _one_vs_rest(LinearSVC(maxIter=max_iter), label, weight)


def gaussian_nb(label: str = "target", weight: str | None = "weight") -> Estimator:
    return _weighted(NaiveBayes(labelCol=label, modelType="gaussian"), weight)


def mlp(layers: list[int], label: str = "target", max_iter: int = 200) -> Estimator:
    """Layer sizes including input and output: rectified hidden units, mini-batch steps, early stop on a tenth of the rows."""
    return ReluNetwork(labelCol=label, layers=layers, epochs=max_iter)


def _weighted(est: Estimator, weight: str | None) -> Estimator:
    return est.setWeightCol(weight) if weight else est


def _one_vs_rest(base: Estimator, label: str, weight: str | None) -> Estimator:
    ovr = OneVsRest(classifier=base, labelCol=label, featuresCol="features", parallelism=2)
    return ovr.setWeightCol(weight) if weight else ovr


def probabilities(scored: DataFrame, labels=LABELS) -> DataFrame:
    """Append ``prediction_label``, ``probabilities`` (label -> p) and ``confidence``.

    One-vs-rest models give no probability; there the raw scores are passed
    through a softmax.
    """
    if "probability" in scored.columns:
        p = vector_to_array("probability")
    else:
        raw = vector_to_array("rawPrediction")
        e = F.transform(raw, lambda x: F.exp(x - F.array_max(raw)))
        p = F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))
    out = scored.withColumn("_p", p)
    every = F.array(*[F.lit(x) for x in labels])
    names = (F.transform("classes", lambda i: F.element_at(every, i + 1)) if "classes" in scored.columns
             else F.slice(every, F.lit(1), F.size("_p")))
    return out.withColumns({"prediction_label": decode("prediction", labels),
                            "probabilities": F.map_from_arrays(names, F.col("_p")),
                            "confidence": F.array_max("_p")}).drop("_p")


def pca(df: DataFrame, features: list[str], k: int = 2, scale: bool = True) -> tuple[PipelineModel, list[float]]:
    """Fitted centring and projection (``pca`` column), and the variance ratios."""
    model = Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="_num"),
        StandardScaler(inputCol="_num", outputCol="_std", withMean=True, withStd=scale),
        PCA(inputCol="_std", outputCol="pca", k=k)]).fit(df)
    return model, [float(x) for x in model.stages[-1].explainedVariance]


def pca_points(df: DataFrame, model: PipelineModel, keep: list[str]) -> DataFrame:
    k = model.stages[-1].getK()
    out = model.transform(df).withColumn("_p", vector_to_array("pca"))
    return out.select(*keep, *[F.col("_p")[i].alias(f"pc{i + 1}") for i in range(k)])


def gaussian_moments(df: DataFrame, features: list[str], label: str, weight: str | None = None) -> DataFrame:
    """(label, prior, feature, mean, variance): the weighted moments behind Gaussian naive Bayes."""
    w = F.col(weight) if weight else F.lit(1.0)
    aggs = [F.sum(w).alias("_w")]
    for c in features:
        wc = F.when(F.col(c).isNotNull(), w)
        aggs += [(F.sum(w * F.col(c)) / F.sum(wc)).alias(f"m_{c}"),
                 (F.sum(w * F.col(c) * F.col(c)) / F.sum(wc)).alias(f"q_{c}")]
    g = df.groupBy(label).agg(*aggs)
    prior = F.col("_w") / F.sum("_w").over(Window.partitionBy())
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"),
                               (F.col(f"q_{c}") - F.col(f"m_{c}") ** 2).alias("variance")) for c in features])
    return g.withColumn("prior", prior).select(label, "prior", F.inline(items))
