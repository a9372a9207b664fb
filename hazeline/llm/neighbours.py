"""Approximate nearest neighbours by inner product on robust-pruned directed graphs.

Equal vectors are searched once: a vector stands for its rows, of which the ``k + 1`` smallest ids can ever be among the
``k`` nearest. Distinct vectors are spread over shards of a bounded size. In each shard a graph is grown in batches: a
greedy search from the entry point proposes neighbours, and relaxed distance pruning keeps a diverse few of them. A query
walks the graph of every shard with a beam; the candidates of all shards are ranked by their exact inner product.

Inner product becomes Euclidean distance by one more coordinate (the length missing to the longest vector of the shard).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazeline.llm.base import query, table
from hazeline.session import materialise

K = 20
SHARD_ROWS = 4_000
QUERY_BLOCK = 8_000
DEGREE, BUILD_BEAM, BEAM, RELAX = 28, 48, 96, 1.2
_WIDE, _SLICE, _BATCH = 4, 256, 256


def beam(vectors: np.ndarray, edges: np.ndarray, start: int, points: np.ndarray, width: int) -> np.ndarray:
    """Ids of the ``width`` best found for each point, nearest first; the number of vectors stands for none."""
    n, many = len(vectors), len(points)
    padded = np.vstack([vectors, np.zeros((1, vectors.shape[1]), vectors.dtype)])
    square = np.append((vectors * vectors).sum(1), np.float32(np.inf))
    row = np.arange(many)[:, None]
    seen = np.zeros((many, n + 1), bool)
    seen[:, [start, n]] = True
    ids = np.full((many, width), n)
    ids[:, 0] = start
    far = np.full((many, width), np.inf, np.float32)
    far[:, 0] = square[start] - 2 * points @ vectors[start]
    done = np.zeros((many, width), bool)
    while True:
        todo = ~done & np.isfinite(far)
        live = np.flatnonzero(todo.any(1))
        if not len(live):
            return ids
        at = np.argsort(~todo[live], axis=1, kind="stable")[:, :_WIDE]
        r = live[:, None]
        picked = np.where(todo[r, at], ids[r, at], n)
        done[r, at] = True
        near = np.sort(edges[picked].reshape(len(live), -1), axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        near[seen[r, near]] = n
        seen[r, near] = True
        found = square[near] - 2 * np.einsum("bcd,bd->bc", padded[near], points[live], optimize=True)
        every = np.concatenate([far[live], found], 1)
        order = np.argsort(every, axis=1, kind="stable")[:, :width]
        rows = row[:len(live)]
        ids[live] = np.concatenate([ids[live], near], 1)[rows, order]
        far[live] = every[rows, order]
        done[live] = np.concatenate([done[live], np.zeros_like(near, bool)], 1)[rows, order]


def prune(vectors: np.ndarray, owner: np.ndarray, options: np.ndarray, degree: int) -> np.ndarray:
    """Robust pruning: take the nearest option, drop those that it is ``RELAX`` times nearer to than the owner is, repeat."""
    n = len(vectors)
    padded = np.vstack([vectors, np.zeros((1, vectors.shape[1]), vectors.dtype)])
    options = np.sort(np.where(options == owner[:, None], n, options), axis=1)
    options[:, 1:][options[:, 1:] == options[:, :-1]] = n
    v = padded[options]
    square = (v * v).sum(2)
    own = padded[owner]
    far = square + (own * own).sum(1)[:, None] - 2 * np.einsum("bcd,bd->bc", v, own, optimize=True)
    far = np.where(options == n, np.inf, np.maximum(far, 0))
    between = square[:, :, None] + square[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    out, row, left = np.full((len(owner), degree), n), np.arange(len(owner)), far.copy()
    for j in range(degree):
        best = left.argmin(1)
        live = np.isfinite(left[row, best])
        if not live.any():
            break
        out[live, j] = options[row, best][live]
        left[(RELAX * RELAX * between[row, best] <= far) | ~live[:, None]] = np.inf
        left[row, best] = np.inf
    return out


def build(vectors: np.ndarray) -> tuple[np.ndarray, int]:
    """Edges of the graph (padded with the number of vectors) and its entry point."""
    n = len(vectors)
    edges = np.full((n + 1, DEGREE), n)
    start = int(((vectors - vectors.mean(0)) ** 2).sum(1).argmin())
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    at = 1
    while at < n:
        batch = order[at:min(n, at + min(_BATCH, at))]
        at += len(batch)
        found = beam(vectors, edges, start, vectors[batch], BUILD_BEAM)
        edges[batch] = prune(vectors, batch, found, DEGREE)
        # each new edge also leads back; a node with too many is pruned again
        source, goal = np.repeat(batch, DEGREE), edges[batch].ravel()
        source, goal = source[goal < n], goal[goal < n]
        by = np.argsort(goal, kind="stable")
        source, goal = source[by], goal[by]
        nodes, first, many = np.unique(goal, return_index=True, return_counts=True)
        more = np.full((len(nodes), int(many.max()) if len(many) else 0), n)
        more[np.repeat(np.arange(len(nodes)), many), np.arange(len(goal)) - np.repeat(first, many)] = source
        options = np.concatenate([edges[nodes], more], 1)
        fits = (options < n).sum(1) <= DEGREE
        edges[nodes[fits]] = np.sort(options[fits], axis=1)[:, :DEGREE]
        over = np.flatnonzero(~fits)
        for piece in np.array_split(over, max(1, len(over) // _SLICE)):
            if len(piece):
                edges[nodes[piece]] = prune(vectors, nodes[piece], options[piece], DEGREE)
    return edges, start


def _matrix(column: pa.ChunkedArray, n: int, kind) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(n, -1) if n else np.zeros((0, 0), kind)


def _lifted(x: np.ndarray) -> np.ndarray:
    square = (x.astype(float) ** 2).sum(1)
    return np.hstack([x, np.sqrt(np.maximum(square.max() - square, 0))[:, None]]).astype(np.float32)


_INDEX = "shard int, node int, key string, id long, v array<{}>, edges array<int>, entry int"


def _index(part: pa.Table) -> pa.Table:
    part = part.sort_by([("id", "ascending"), ("key", "ascending")])
    n = part.num_rows
    edges, start = build(_lifted(_matrix(part["v"], n, np.float32)))
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * DEGREE + 1, DEGREE), pa.int32()),
                                     pa.array(edges[:n].ravel(), pa.int32()))
    return pa.table({"shard": part["shard"].cast(pa.int32()), "node": pa.array(np.arange(n), pa.int32()), "key": part["key"],
                     "id": part["id"], "v": part["v"], "edges": lists, "entry": pa.array(np.full(n, start), pa.int32())})


def _search(index: pa.Table, asked: pa.Table) -> pa.Table:
    names = ["query_id", "key", "id", "score"]
    schema = pa.schema([("query_id", pa.int64()), ("keys", pa.list_(pa.string())), ("ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])
    n, many = index.num_rows, asked.num_rows
    if not n or not many:
        return schema.empty_table()
    index = index.sort_by("node")
    exact = _matrix(index["v"], n, np.float64)
    lifted = _lifted(exact.astype(np.float32))
    edges = np.vstack([_matrix(index["edges"], n, np.int64), np.full((1, DEGREE), n)])
    entry, want = index["entry"][0].as_py(), min(n, K + 1)
    keys, ids = np.array(index["key"].to_pylist(), object), index["id"].to_numpy()
    asks = _matrix(asked["v"], many, np.float64)
    out: dict[str, list] = {c: [] for c in names}
    for at in range(0, many, _SLICE):
        q = asks[at:at + _SLICE]
        found = beam(lifted, edges, entry, np.hstack([q, np.zeros((len(q), 1))]).astype(np.float32), BEAM)
        score = np.einsum("bcd,bd->bc", np.vstack([exact, np.zeros((1, exact.shape[1]))])[found], q)
        score[found == n] = -np.inf
        order = np.lexsort((np.append(ids, np.iinfo(np.int64).max)[found], -score), axis=1)[:, :want]
        r = np.arange(len(q))[:, None]
        best, score = found[r, order], score[r, order]
        for b, s in zip(best, score):
            good = b < n
            out["key"].append(keys[b[good]].tolist())
            out["id"].append(ids[b[good]].tolist())
            out["score"].append(s[good].tolist())
    return pa.table([asked["query_id"].combine_chunks(), out["key"], out["id"], out["score"]], schema=schema)


def usable(rows: DataFrame, vector: str = "v") -> DataFrame:
    """Rows whose vector isn't null or zero, has no null or non-finite component, and has the most frequent length."""
    good = (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = rows.where(F.col(vector).isNotNull()).where(F.coalesce(good, F.lit(False)))
    usual = rows.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size(vector) == (usual["n"] if usual else 0))


def nearest(rows: DataFrame, asked: DataFrame, k: int = K) -> DataFrame:
    """The ``k`` nearest rows found for each query: query_id, rank, vec_id, score.

    ``rows`` and ``asked`` have id and v. A query never finds its own id. Rows with a null id, or with a vector that
    ``usable`` leaves out, take no part, as rows or queries; rows that repeat an id and its vector count once. Fewer rows than
    ``k`` give them all; ties go to the smaller id. Empty tables give an empty result.
    """
    if k > K:
        raise ValueError(f"at most {K} neighbours")
    # the score is that of the vectors as they are
    kind = "float" if "float" in rows.schema["v"].dataType.simpleString() else "double"
    rows, asked = (x.withColumn("v", F.col("v").cast(f"array<{kind}>")) for x in (rows, asked))
    key = F.concat_ws("/", F.hex(F.xxhash64("v")), F.hex(F.hash("v")))
    rows = materialise(usable(rows.where("id IS NOT NULL").select("id", "v").distinct()).withColumn("key", key), "vectors")
    first = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    kept = materialise(rows.withColumn("n", first).where(F.col("n") <= k + 1), "distinct")
    members = kept.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("members"))
    single = kept.where("n = 1")
    shards = max(1, -(-single.count() // SHARD_ROWS))
    single = single.select(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), "key", "id", "v")
    index = materialise(single.groupBy("shard").applyInArrow(_index, _INDEX.format(kind)), "graph")
    asked = usable(asked.where("id IS NOT NULL").select("id", "v").distinct())
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = (asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
             .select("shard", "block", F.col("id").alias("query_id"), "v"))
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (spread.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
             .applyInArrow(_search, "query_id long, keys array<string>, ids array<long>, scores array<double>"))
    found = found.select("query_id", F.explode(F.arrays_zip("keys", "ids", "scores")).alias("f")).select(
        "query_id", F.col("f.keys").alias("key"), F.col("f.ids").alias("id"), F.col("f.scores").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n", "id")
    out = (found.join(members, "key").select("query_id", "score", F.explode("members").alias("vec_id"))
           .where("vec_id != query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


@query("op10_ann_pruned_graph")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return nearest(rows, rows.where("id % 20 = 0"))
