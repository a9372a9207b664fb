"""Models that are kept as arrays and score rows in blocks, and the blocks that they are fitted on."""

from __future__ import annotations

import base64
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block.
BLOCK = 16_384


def values(df: DataFrame, features: str) -> Column:
    """A vector or array column as array<double>."""
    if df.schema[features].dataType.simpleString().startswith("array"):
        return F.col(features).cast("array<double>")
    return vector_to_array(features)


def matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Arrays of a column as a matrix; a null element is NaN."""
    return np.array([[np.nan if v is None else v for v in r] for r in rows] if rows.map(lambda r: any(v is None for v in r)).any()
                    else rows.tolist(), float).reshape(len(rows), width)


def spread(rows: DataFrame, n: int) -> DataFrame:
    """Rows over as many partitions as there are blocks, while these are fewer than cores."""
    want = min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // BLOCK))
    return rows.repartition(want) if n <= want * BLOCK else rows


def packed(**arrays: np.ndarray) -> str:
    """Arrays as text, so that they are saved with a model's other parameters."""
    out = io.BytesIO()
    np.savez_compressed(out, **arrays)
    return base64.b64encode(out.getvalue()).decode()


def unpacked(text: str) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(base64.b64decode(text))))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class ArrayModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (vector) and ``prediction``; rows without features get nulls."""

    arrays = Param(Params._dummy(), "arrays", "packed arrays", TypeConverters.toString)

    def __init__(self, featuresCol: str = "features", arrays: str | None = None):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction", probabilityCol="probability")
        self._set(featuresCol=featuresCol, **({"arrays": arrays} if arrays else {}))

    def fitted(self) -> dict[str, np.ndarray]:
        return unpacked(self.getOrDefault("arrays"))

    @staticmethod
    def scorer(arrays: dict[str, np.ndarray]):
        """A function from a matrix of feature values to probabilities, and the number of features."""
        raise NotImplementedError

    def _transform(self, df: DataFrame) -> DataFrame:
        text, scorer = df.sparkSession.sparkContext.broadcast(self.getOrDefault("arrays")), type(self).scorer

        @F.pandas_udf("array<double>")
        def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            score, width = scorer(unpacked(text.value))
            for x in batches:
                out = np.empty(len(x), object)
                known = np.flatnonzero(x.notna().to_numpy())
                for start in range(0, len(known), BLOCK):
                    at = known[start:start + BLOCK]
                    for j, p in zip(at.tolist(), score(matrix(x.iloc[at], width))):
                        out[j] = p
                yield pd.Series(out)

        out = df.withColumn("_p", probability(values(df, self.getFeaturesCol())))
        best = F.array_position("_p", F.array_max("_p")) - 1
        return out.withColumns({self.getProbabilityCol(): F.when(F.col("_p").isNotNull(), array_to_vector("_p")), self.getPredictionCol(): best.cast("double")}).drop("_p")
