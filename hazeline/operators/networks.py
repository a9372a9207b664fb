"""Multilayer networks with rectified hidden units, fitted by synchronous mini-batch steps on all partitions.

A step takes the next share of every block's rows: tasks compute the sums of the gradients of their rows, the sums are added up a
tree, and the driver moves the weights by Adam. An epoch is over when every row has been used once. A tenth of the rows, chosen by
hash, only measures the accuracy after each epoch; when it hasn't risen for some epochs the weights of the best one are kept.
Rows stay in memory as blocks of arrays between steps, hence the RDD; what goes to and fro is as large as the network.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.operators.arrays import BLOCK, ArrayModel, matrix, packed, softmax, spread, values
from hazeline.session import materialise

#: Rows of a mini-batch on one machine; a step here is never smaller, and an epoch has no more steps than ``most_steps``.
BATCH = 200


def outputs(weights: list[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
    """Values of all layers; ``weights`` alternates matrices and biases."""
    out = [x]
    for i in range(0, len(weights), 2):
        z = out[-1] @ weights[i] + weights[i + 1]
        out.append(np.maximum(z, 0) if i + 2 < len(weights) else softmax(z))
    return out


def gradients(weights: list[np.ndarray], x: np.ndarray, y: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
    """Sums over rows of the gradients of the weighted cross entropy."""
    layers = outputs(weights, x)
    back = layers[-1].copy()
    back[np.arange(len(y)), y] -= 1
    back *= w[:, None]
    out: list[np.ndarray] = []
    for i in range(len(weights) - 2, -1, -2):
        before = layers[i // 2]
        out = [before.T @ back, back.sum(0), *out]
        if i:
            back = (back @ weights[i].T) * (before > 0)
    return out


class Adam:
    """Step sizes by running means of gradients and their squares."""

    def __init__(self, weights: list[np.ndarray], rate: float):
        self.rate, self.turn = rate, 0
        self.first, self.second = ([np.zeros_like(w) for w in weights] for _ in range(2))

    def step(self, weights: list[np.ndarray], grads: list[np.ndarray]) -> list[np.ndarray]:
        # fixed values: the method's usual constants
        b1, b2, tiny = 0.9, 0.999, 1e-8
        self.turn += 1
        self.first = [b1 * m + (1 - b1) * g for m, g in zip(self.first, grads)]
        self.second = [b2 * v + (1 - b2) * g * g for v, g in zip(self.second, grads)]
        size = self.rate * np.sqrt(1 - b2 ** self.turn) / (1 - b1 ** self.turn)
        return [w - size * m / (np.sqrt(v) + tiny) for w, m, v in zip(weights, self.first, self.second)]


def _start(layers: list[int], seed: int) -> list[np.ndarray]:
    """Uniform weights within sqrt(6 / (inputs + outputs))."""
    rng, out = np.random.default_rng(seed), []
    for a, b in zip(layers, layers[1:]):
        bound = np.sqrt(6 / (a + b))
        out += [rng.uniform(-bound, bound, (a, b)), rng.uniform(-bound, bound, b)]
    return out


def _sums(weights, epoch: int, step: int, steps: int, seed: int, check: bool):
    """Of a partition: gradient sums and weight of this step's rows; before an epoch, the right and all validation rows."""

    def run(blocks: Iterator[tuple]) -> Iterator[tuple]:
        total, mass, right, seen = None, 0.0, 0.0, 0.0
        for number, x, y, w, valid in blocks:
            if check and valid.any():
                right += float((outputs(weights, x[valid])[-1].argmax(1) == y[valid]).sum())
                seen += float(valid.sum())
            rows = np.flatnonzero(~valid)
            rows = np.random.default_rng((seed, epoch, number)).permutation(rows)[step::steps]
            if len(rows):
                grads = gradients(weights, x[rows], y[rows], w[rows])
                total = grads if total is None else [a + b for a, b in zip(total, grads)]
                mass += float(w[rows].sum())
        yield total, mass, right, seen

    return run


def _added(a: tuple, b: tuple) -> tuple:
    total = a[0] if b[0] is None else b[0] if a[0] is None else [x + y for x, y in zip(a[0], b[0])]
    return total, a[1] + b[1], a[2] + b[2], a[3] + b[3]


class ReluNetwork(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Network of the given ``layers`` (inputs, hidden .., classes) for labels from 0.

    At most ``epochs`` epochs; with ``patience`` epochs without a better validation accuracy (by more than ``least``) it stops.
    ``l2`` shrinks the matrices. Rows with a null label, or a null or NaN feature, are left out; no rows raise ValueError.
    """

    layers = Param(Params._dummy(), "layers", "layer sizes", TypeConverters.toListInt)
    epochs = Param(Params._dummy(), "epochs", "most epochs", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "step size", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "weight penalty", TypeConverters.toFloat)
    patience = Param(Params._dummy(), "patience", "epochs without a rise", TypeConverters.toInt)
    least = Param(Params._dummy(), "least", "smallest rise that counts", TypeConverters.toFloat)
    most_steps = Param(Params._dummy(), "most_steps", "most steps of an epoch", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, layers, featuresCol="features", labelCol="label", weightCol=None, seed=42, epochs=200, rate=1e-3, l2=1e-4,
                 patience=10, least=1e-4, most_steps=16):
        super().__init__()
        self._setDefault(seed=42, epochs=200, rate=1e-3, l2=1e-4, patience=10, least=1e-4, most_steps=16)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setWeightCol(self, value: str) -> "ReluNetwork":
        return self._set(weightCol=value)

    def _blocks(self, df: DataFrame):
        width, seed = self.getOrDefault("layers")[0], self.getOrDefault("seed")
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet("weightCol") else F.lit(1.0)
        rows = df.select(values(df, self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("int").alias("y"), weight.alias("w"))
        good = F.coalesce(~F.exists("x", lambda v: v.isNull() | F.isnan(v)), F.lit(False))
        rows = rows.where(good & F.col("y").isNotNull()).withColumn("valid", F.pmod(F.xxhash64("x", "y", F.lit(seed)), F.lit(10)) == 0)
        n = rows.count()
        if not n:
            raise ValueError("no rows to fit")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for start in range(0, len(batch), BLOCK):
                    part = batch.iloc[start:start + BLOCK]
                    yield pd.DataFrame({"n": [len(part)], "x": [matrix(part["x"], width).tobytes()], "y": [part["y"].to_numpy(np.int32).tobytes()],
                                        "w": [part["w"].to_numpy(float).tobytes()], "valid": [part["valid"].to_numpy(bool).tobytes()]})

        stored = materialise(spread(rows, n).mapInPandas(run, "n int, x binary, y binary, w binary, valid binary"), "network-rows")

        def block(r) -> tuple:
            arrays = (np.frombuffer(r[c], t) for c, t in (("y", np.int32), ("w", float), ("valid", bool)))
            return r["number"], np.frombuffer(r["x"], float).reshape(r["n"], width), *arrays

        return stored.withColumn("number", F.crc32(F.concat("x", "y"))).rdd.map(block).persist(StorageLevel.MEMORY_AND_DISK), n

    def _fit(self, df: DataFrame) -> "ReluNetworkModel":
        opt = lambda name: self.getOrDefault(name)
        sizes, l2, seed = opt("layers"), opt("l2"), opt("seed")
        blocks, n = self._blocks(df)
        steps = min(opt("most_steps"), max(1, n // BATCH))
        weights = _start(sizes, seed)
        adam, best, kept, idle = Adam(weights, opt("rate")), -1.0, weights, 0
        for epoch in range(opt("epochs") + 1):
            last = epoch == opt("epochs")
            start = weights
            for step in range(1 if last else steps):
                total, mass, right, seen = blocks.mapPartitions(_sums(weights, epoch, step, steps, seed, step == 0)).treeReduce(_added)
                if step == 0 and seen:
                    # the accuracy of the epoch before
                    score = right / seen
                    idle = 0 if score > best + opt("least") else idle + 1
                    if score > best:
                        best, kept = score, start
                if last or idle > opt("patience"):
                    break
                if total is not None:
                    grads = [g / mass + (l2 * w / mass if w.ndim == 2 else 0) for g, w in zip(total, weights)]
                    weights = adam.step(weights, grads)
            if last or idle > opt("patience"):
                break
        blocks.unpersist()
        if best < 0:
            kept = weights
        return ReluNetworkModel(self.getFeaturesCol(), packed(n=np.array(len(kept)), **{f"w{i}": w for i, w in enumerate(kept)}))


class ReluNetworkModel(ArrayModel):
    """Fitted weights as arrays."""

    @staticmethod
    def scorer(arrays: dict[str, np.ndarray]):
        weights = [arrays[f"w{i}"] for i in range(int(arrays["n"]))]
        return (lambda x: outputs(weights, x)[-1]), weights[0].shape[0]
