"""Nearest neighbours of many queries among many rows, by hashed projections.

Vectors are projected on random directions, and the cells that they fall into along some directions make a bucket; several tables
of buckets use other directions. A query looks into its own bucket of each table and into those next to it across the nearest cell
borders. What it finds is ranked by exact distance. Number of directions and width of cells are the cheapest ones that find the
true neighbours of some queries; where all rows are about as far, such cells compare more than a search of all rows, which is
done instead. Rows and queries of a bucket are compared in pieces of bounded size, so a full bucket is many small tasks; equal
vectors are compared once. Queries that find too few rows are compared with all.
``knn_exact`` compares every query with all rows, in larger pieces.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.operators.arrays import matrix
from hazeline.operators.hierarchy import distances
from hazeline.session import materialise

#: Rows, or queries, of a bucket that one group holds.
PIECE = 2_048
#: Rows looked at, and queries answered exactly, to set the cells; the share of those answers that the cells must find.
LOOK, ASKED, RECALL = 1_000, 256, 0.98
_MANY = (16, 12, 8, 6, 5, 4, 3, 2, 1)
#: The same where all rows meet all queries: larger pieces are copied less often. Distances that are held at once.
EXACT_PIECE = 16_384
_CELLS = 524_288


def smallest(rows: DataFrame, by: list[str], order: list, k: int, spread: str) -> DataFrame:
    """The first ``k`` rows of each key; a key of many rows is cut by the hash of ``spread`` first."""
    part = F.pmod(F.xxhash64(spread), F.lit(64))
    first = rows.withColumn("_part", part).withColumn("_n", F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order))).where(F.col("_n") <= k)
    return first.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= k).drop("_n", "_part")


class Cells:
    """Directions, offsets and cell width of all tables; ``many`` directions make a bucket."""

    def __init__(self, dims: int, many: int, width: float, tables: int, seed: int):
        rng = np.random.default_rng(seed)
        self.many, self.width = many, width
        self.directions = rng.normal(size=(tables, max(_MANY), dims))[:, :many]
        self.offsets = rng.random((tables, max(_MANY)))[:, :many] * width

    def buckets(self, x: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, table, bucket): the row's own bucket and those across the ``probes`` nearest borders, one and two at a time."""
        row, table, bucket = [], [], []
        for t, (d, b) in enumerate(zip(self.directions, self.offsets)):
            place = (x @ d.T + b) / self.width
            cell = np.floor(place).astype(np.int64)
            left = place - cell
            side = np.where(left < 0.5, -1, 1)
            order = np.argsort(np.minimum(left, 1 - left), axis=1)[:, :probes]
            moves = [()] + [(i,) for i in range(order.shape[1])] + ([(0, 1)] if order.shape[1] > 1 else [])
            for move in moves:
                own = cell.copy()
                for i in move:
                    at = order[:, i]
                    own[np.arange(len(own)), at] += side[np.arange(len(own)), at]
                key = np.zeros(len(own), np.uint64)
                for j in range(self.many):
                    key = (key ^ own[:, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(29)
                row.append(np.arange(len(x)))
                table.append(np.full(len(x), t))
                bucket.append(key.astype(np.int64))
        return tuple(np.concatenate(v) for v in (row, table, bucket))


def cells_for(look: np.ndarray, asked: np.ndarray, owner: np.ndarray, near: np.ndarray, tables: int, probes: int, seed: int) -> Cells | None:
    """The cells with the fewest comparisons that find enough of the true neighbours ``near`` of some queries; ``owner`` is the
    query of each. None if these would compare as much as a search of all rows."""
    far = distances(look, look)
    np.fill_diagonal(far, np.inf)
    least = np.sqrt(far.min(1))
    least = least[np.isfinite(least) & (least > 0)]
    unit, best, cost = float(np.median(least)) if len(least) else 1.0, None, 1.0
    for many in _MANY:
        for width in (unit, 2 * unit, 4 * unit, 8 * unit):
            cells = Cells(look.shape[1], many, width, tables, seed)
            places = pd.DataFrame(dict(zip(("q", "t", "b"), cells.buckets(asked, probes)))).drop_duplicates()
            some = pd.DataFrame(dict(zip(("i", "t", "b"), cells.buckets(look, 0)))).groupby(["t", "b"], as_index=False).agg(n=("i", "size"))
            mean = places.merge(some, on=["t", "b"])["n"].sum() / (len(asked) * len(look))
            if mean < cost:
                true = pd.DataFrame(dict(zip(("i", "t", "b"), cells.buckets(near, 0))))
                true["q"] = owner[true["i"]]
                if places.merge(true, on=["q", "t", "b"])["i"].nunique() >= RECALL * len(near):
                    best, cost = cells, mean
    return best


def _hashed(rows: DataFrame, cells: Cells, probes: int) -> DataFrame:
    """Rows (id, x) once for each of their buckets."""

    def run(batches):
        for batch in batches:
            x = matrix(batch["x"], cells.directions.shape[2])
            row, table, bucket = cells.buckets(x, probes)
            yield pd.DataFrame({"id": batch["id"].to_numpy()[row], "x": batch["x"].to_numpy()[row], "t": table, "bucket": bucket})

    return rows.mapInPandas(run, "id long, x array<double>, t int, bucket long").dropDuplicates(["id", "t", "bucket"])


def _nearest(q: np.ndarray, x: np.ndarray, ids: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, d): the ``few`` nearest of x for each of q, by the sums of squared differences themselves, then by id."""
    far = distances(q, x)
    cut = np.partition(far, few - 1, axis=1)[:, few - 1:few]
    # products are rounded, so that what lies that close behind the last one is measured as well
    at, to = np.nonzero(far <= cut + 1e-9 * ((q * q).sum(1)[:, None] + cut))
    d = ((x[to] - q[at]) ** 2).sum(1)
    order = np.lexsort((ids[to], d, at))
    order = order[np.arange(len(order)) - np.searchsorted(at, at) < few]
    return at[order], ids[to[order]], d[order]


def _compared(rows: DataFrame, asked: DataFrame, k: int, width: int, piece: int | None = None) -> DataFrame:
    """(q, id, d): for each query the nearest rows of its buckets, by pieces of buckets."""
    keys, piece = ["t", "bucket"], piece or PIECE
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / piece).alias("rows")).join(
        asked.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / piece).alias("asks")), keys)
    sizes = materialise(sizes, "pieces")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(f"p_{own}")
        every = F.explode(F.sequence(F.lit(0), F.col(other).cast("int") - 1)).alias(f"p_{other}")
        return side.join(sizes, keys).select("id", "x", *keys, mine, every)

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"q": [], "id": [], "d": []}).astype({"q": "int64", "id": "int64", "d": float})
        x, ids, few, out = matrix(left["x"], width), left["id"].to_numpy(), min(k, len(left)), []
        step = max(1, _CELLS // len(x))
        for start in range(0, len(right), step):
            part = right.iloc[start:start + step]
            at, to, d = _nearest(matrix(part["x"], width), x, ids, few)
            out.append(pd.DataFrame({"q": part["id"].to_numpy()[at], "id": to, "d": d}))
        return pd.concat(out)

    group = [*keys, "p_rows", "p_asks"]
    return dealt(rows, "rows", "asks").groupBy(*group).cogroup(dealt(asked, "asks", "rows").groupBy(*group)).applyInPandas(
        nearest, "q long, id long, d double")


def _known(rows: DataFrame, vector: str, key: str, name: str, *more: Column) -> DataFrame:
    known = rows.where(F.col(vector).isNotNull() & F.col(key).isNotNull())
    return known.select(F.col(key).cast("long").alias(name), F.col(vector).alias("x"), *more)


def _training(train: DataFrame, vector: str, label: str, key: str, k: int) -> tuple[DataFrame, DataFrame]:
    """Rows (key, x, label) that can be asked for, and (x, id) of each distinct vector."""
    rows = _known(train, vector, key, "key", F.col(label).alias("label"))
    # of equal vectors only the k smallest keys can ever be asked for
    rows = materialise(smallest(rows, ["x"], ["key"], k, "key"), "neighbours")
    return rows, rows.groupBy("x").agg(F.min("key").alias("id"))


def _together(df: DataFrame) -> DataFrame:
    """All rows as one bucket."""
    return df.select("id", "x", F.lit(0).alias("t"), F.lit(0).cast("long").alias("bucket"))


def _voted(found: DataFrame, rows: DataFrame, single: DataFrame, k: int, key: str) -> DataFrame:
    """(key, predicted): vote of the k nearest rows of each query among those with the vectors found."""
    best = smallest(found, ["q"], ["d", "id"], k, "id")
    # every row that shares a chosen vector
    members = rows.join(single, "x").select("id", F.col("key").alias("row"), "label")
    near = smallest(best.join(members, "id"), ["q"], ["d", "row"], k, "row")
    votes = near.groupBy("q", "label").agg(F.count(F.lit(1)).alias("c"))
    picked = votes.groupBy("q").agg(F.max_by("label", F.struct("c", -F.col("label"))).alias("predicted"))
    return picked.select(F.col("q").alias(key), F.col("predicted").cast("bigint").alias("predicted"))


def knn_exact(train: DataFrame, queries: DataFrame, vector: str, label: str, key: str, k: int = 5) -> DataFrame:
    """(key, predicted): vote of the k nearest training rows of each query, which is compared with all of them.

    Time grows with the product of both sides; a task holds a piece of each. Types, ties and nulls are those of ``knn_hashed``.
    """
    rows, single = _training(train, vector, label, key, k)
    first = single.first()
    if first is None:
        return queries.select(F.col(key), F.lit(None).cast("bigint").alias("predicted")).limit(0)
    asked = _known(queries, vector, key, "id")
    found = _compared(_together(single), _together(asked), k, len(first["x"]), EXACT_PIECE)
    return _voted(materialise(found, "found"), rows, single, k, key)


def knn_hashed(train: DataFrame, queries: DataFrame, vector: str, label: str, key: str, k: int = 5, tables: int = 8, probes: int = 4,
               seed: int = 42) -> DataFrame:
    """(key, predicted): vote of about the k nearest training rows of each query.

    ``vector`` is array<double>, ``key`` and ``label`` are whole numbers. Equal distances go to the smaller key, equal votes to
    the smaller label. Rows or queries with a null vector or key take no part. No training rows give no answers.
    """
    rows, single = _training(train, vector, label, key, k)
    n = single.count()
    look = single.orderBy(F.xxhash64("id", F.lit(seed))).limit(LOOK).toPandas()
    if not n:
        return queries.select(F.col(key), F.lit(None).cast("bigint").alias("predicted")).limit(0)
    width = len(look["x"].iloc[0])
    asked = _known(queries, vector, key, "id")
    some = materialise(asked.orderBy(F.xxhash64("id", F.lit(seed))).limit(ASKED), "some")
    near = smallest(_compared(_together(single), _together(some), k, width, EXACT_PIECE), ["q"], ["d", "id"], k, "id")
    near = near.join(single, "id").select("q", "x").toPandas()
    some = some.dropDuplicates(["id"]).toPandas()
    cells = None
    if len(near):
        owner = near["q"].map(pd.Series(np.arange(len(some)), some["id"])).to_numpy()
        cells = cells_for(matrix(look["x"], width), matrix(some["x"], width), owner, matrix(near["x"], width), tables, probes, seed)
    if cells is None:
        return _voted(materialise(_compared(_together(single), _together(asked), k, width, EXACT_PIECE), "found"), rows, single, k, key)
    found = materialise(_compared(_hashed(single, cells, 0), _hashed(asked, cells, probes), k, width).groupBy("q", "id").agg(F.min("d").alias("d")), "found")
    enough = found.groupBy("q").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(k, n)).select(F.col("q").alias("id"))
    rest = asked.join(enough, "id", "left_anti")
    found = found.join(enough.withColumnRenamed("id", "q"), "q", "left_semi").unionByName(_compared(_together(single), _together(rest), k, width, EXACT_PIECE))
    return _voted(found, rows, single, k, key)
