"""Clustering, nearest neighbours and their scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# The sample a brute-force neighbour search is allowed to broadcast.
SAMPLE_LIMIT = 50_000
BLOCK_CELLS = 4_000_000


def kmeans(vectors: DataFrame, k: int = 6, seed: int = 42, starts: int = 1):
    """The best of ``starts`` fits, by their summed squared distances."""
    fits = [KMeans(k=k, seed=seed + i, featuresCol="features", predictionCol="cluster").fit(vectors) for i in range(starts)]
    return min(fits, key=lambda m: m.summary.trainingCost)


def bisecting(vectors: DataFrame, k: int = 6, seed: int = 42):
    """Top-down hierarchical clustering in place of the agglomerative form."""
    return BisectingKMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(vectors)


def silhouette(clustered: DataFrame) -> float | None:
    """Mean silhouette with squared Euclidean distance; None with fewer than two clusters."""
    if len(clustered.select("cluster").distinct().limit(2).collect()) < 2:
        return None
    return ClusteringEvaluator(predictionCol="cluster", featuresCol="features").evaluate(clustered)


def _bounded_sample(sample: DataFrame, cols: list[str], limit: int) -> pd.DataFrame:
    """Collect a sample whose size is checked first."""
    rows = sample.select(*cols).limit(limit + 1).toPandas()
    if len(rows) > limit:
        raise ValueError(f"the neighbour search takes a sample of at most {limit} rows; draw one with sample_strat")
    return rows


def knn(train: DataFrame, queries: DataFrame, vector: str, label: str, key: str, k: int = 5,
        limit: int = SAMPLE_LIMIT) -> DataFrame:
    """(key, predicted): vote of the k nearest training rows.

    The training side is a sample of bounded size, checked and broadcast. The
    queries stay partitioned and are compared in blocks. Equal distances go to
    the smaller key, equal votes to the smaller label.
    """
    rows = _bounded_sample(train, [key, vector, label], limit).sort_values(key)
    spark = queries.sparkSession
    data = spark.sparkContext.broadcast((
        np.array(rows[vector].tolist(), dtype=np.float64), rows[label].to_numpy()))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points, labels = data.value
        block = max(1, BLOCK_CELLS // max(1, points.size))
        for batch in batches:
            q = np.array(batch[vector].tolist(), dtype=np.float64)
            votes, kinds = [], np.unique(labels)
            for s in range(0, len(q), block):
                d = ((q[s:s + block, None, :] - points[None, :, :]) ** 2).sum(axis=2)
                near = np.argsort(d, axis=1, kind="stable")[:, :k]
                counts = (labels[near][:, :, None] == kinds).sum(axis=1)
                votes += kinds[counts.argmax(axis=1)].tolist()
            yield pd.DataFrame({key: batch[key].to_numpy(), "predicted": votes})

    kind = queries.schema[key].dataType.simpleString()
    return queries.select(key, vector).mapInPandas(predict, f"{key} {kind}, predicted bigint")


def density_clusters(sample: DataFrame, vector: str, key: str, eps: float = 1.5, min_pts: int = 10,
                     limit: int = SAMPLE_LIMIT) -> DataFrame:
    """(key, cluster): density-based clusters of a bounded sample; noise is -1.

    Tasks compare their points with the broadcast sample block by block and keep
    no list of pairs: a first pass counts neighbours, later passes take the
    smallest label among core neighbours until nothing changes. Cluster ids are
    the smallest position of their core points; a border point joins the
    smallest such cluster.
    """
    rows = _bounded_sample(sample, [key, vector], limit).sort_values(key, ignore_index=True)
    spark = sample.sparkSession
    n = len(rows)
    points = spark.sparkContext.broadcast(np.array(rows[vector].tolist(), dtype=np.float64).reshape(n, -1))
    ids = spark.range(n, numPartitions=max(1, min(n // 500 + 1, spark.sparkContext.defaultParallelism)))

    def blocks(batch: pd.DataFrame):
        p = points.value
        step = max(1, BLOCK_CELLS // max(1, p.size))
        idx = batch["id"].to_numpy()
        for s in range(0, len(idx), step):
            part = idx[s:s + step]
            yield part, ((p[part][:, None, :] - p[None, :, :]) ** 2).sum(axis=2) <= eps * eps

    def count(batches):
        for batch in batches:
            for part, near in blocks(batch):
                yield pd.DataFrame({"id": part, "n": near.sum(axis=1)})

    core = np.zeros(n, dtype=bool)
    for r in ids.mapInPandas(count, "id bigint, n bigint").filter(F.col("n") >= min_pts).toLocalIterator():
        core[r.id] = True
    label = np.where(core, np.arange(n), n)
    while True:
        state = spark.sparkContext.broadcast((core, label))

        def spread(batches):
            is_core, now = state.value
            for batch in batches:
                for part, near in blocks(batch):
                    seen = np.where(near & is_core[None, :], now[None, :], len(now))
                    yield pd.DataFrame({"id": part, "l": seen.min(axis=1)})

        new = label.copy()
        for r in ids.mapInPandas(spread, "id bigint, l bigint").toLocalIterator():
            if core[r.id]:
                new[r.id] = min(new[r.id], r.l)
        # labels are positions of core points: jump to the label of the label
        while True:
            jumped = np.where(core, new[np.minimum(new, n - 1)], n) if n else new
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            break
        label = new

    final = spark.sparkContext.broadcast((core, label))

    def assign(batches):
        is_core, now = final.value
        for batch in batches:
            for part, near in blocks(batch):
                best = np.where(near & is_core[None, :], now[None, :], len(now)).min(axis=1)
                yield pd.DataFrame({"id": part, "cluster": np.where(best == len(now), -1, best)})

    names = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), key: rows[key]}))
    return ids.mapInPandas(assign, "id bigint, cluster bigint").join(names, "id").select(key, "cluster")
