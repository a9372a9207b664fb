"""Multiclass gradient boosting over binned features, grown level by level on all rows.

Features are binned once. Each round fits one tree a class to the gradients of the softmax loss. For a level of all these trees
the map tasks sum gradient, hessian and count by (class, feature, node, bin); the sums meet by (class, feature), where the
best cut of each node is found, and only the cuts reach the driver. Of two sibling nodes the one with fewer rows is summed, the
other is what is left of their parent. So a level costs one pass and one small shuffle, whatever the number of rows.

The loop keeps its rows as blocks of arrays and the sums of the level before next to where they are needed, which DataFrames
can't express between two jobs; hence the RDDs. Scores are checkpointed every few rounds in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

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
from hazeline.session import materialise, scratch_path

#: Bins of a feature; a null or NaN has one more of its own, the last.
BINS = 255
#: Rounds between two checkpoints of the scores.
KEEP = 20
_LEAST_GAIN = 1e-7


@dataclass
class Block:
    """Rows as arrays. ``number`` names the block, so that its sample is the same whenever it is drawn."""

    number: int
    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    scores: np.ndarray


@dataclass
class Tree:
    """Nodes in order of birth. ``feature`` is -1 at a leaf; rows with a bin up to ``cut`` go left, missing ones as ``missing_left`` says."""

    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    missing_left: list = field(default_factory=lambda: [False])
    left: list = field(default_factory=lambda: [0])
    right: list = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.missing_left[node] = feature, cut, missing_left
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for _ in range(2):
            for column, x in zip((self.feature, self.cut, self.missing_left, self.left, self.right, self.value), (-1, 0, False, 0, 0, 0.0)):
                column.append(x)
        return self.left[node], self.right[node]

    def arrays(self) -> tuple[np.ndarray, ...]:
        kinds = (np.int32, np.int16, bool, np.int32, np.int32, np.float64)
        return tuple(np.array(c, k) for c, k in zip((self.feature, self.cut, self.missing_left, self.left, self.right, self.value), kinds))


def leaves(tree: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """Node that each row of ``bins`` ends in."""
    feature, cut, missing_left, left, right, _ = tree
    node = np.zeros(len(bins), np.int32)
    row = np.arange(len(bins))
    while len(row):
        at = node[row]
        row, at = row[feature[at] >= 0], at[feature[at] >= 0]
        b = bins[row, feature[at]]
        go = np.where(b == BINS, missing_left[at], b <= cut[at])
        node[row] = np.where(go, left[at], right[at])
    return node


def cut_points(df: DataFrame, vector: str, size: int, accuracy: int = 10_000) -> list[np.ndarray]:
    """Upper ends of the bins of each feature, from quantiles; a feature of few values has a bin for each."""
    steps = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    known = lambda i: F.when(~F.isnan(F.col(vector)[i]), F.col(vector)[i])
    row = df.agg(*[F.percentile_approx(known(i), steps, F.lit(accuracy)).alias(f"q{i}") for i in range(size)],
                 *[F.max(known(i)).alias(f"m{i}") for i in range(size)]).first()
    # the largest value ends no bin: nothing would be right of it
    return [np.array([x for x in np.unique(row[f"q{i}"] or []) if x < row[f"m{i}"]], float) for i in range(size)]


def binned(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    out = np.empty(values.shape, np.uint8)
    for f, c in enumerate(cuts):
        out[:, f] = np.where(np.isnan(values[:, f]), BINS, np.searchsorted(c, values[:, f], side="left"))
    return out


def _blocks(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """(number, n, bins, label, weight) of blocks of rows (x, y, w)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                part = batch.iloc[start:start + BLOCK]
                bins = binned(matrix(part["x"], len(cuts)), cuts)
                yield pd.DataFrame({"n": [len(part)], "bins": [bins.tobytes()], "label": [part["y"].to_numpy(np.int32).tobytes()],
                                    "weight": [part["w"].to_numpy(float).tobytes()]})

    stored = materialise(rows.mapInPandas(run, "n int, bins binary, label binary, weight binary"), "blocks")
    return stored.withColumn("number", F.crc32(F.concat("bins", "label")))


@dataclass
class Plan:
    """What is asked of a level: for each class its tree so far, its features, and the nodes to sum."""

    turn: int
    seed: int
    share: float
    floor: float
    double: bool
    trees: list
    features: list
    nodes: list


def _sums(plan: Plan):
    """((class, feature), (cells, sums)) of a partition's blocks; a cell is node place * (BINS + 1) + bin."""

    def run(blocks: Iterator[Block]):
        for block in blocks:
            p = softmax(block.scores)
            rows = np.arange(len(block.label))
            if plan.share < 1:
                rows = rows[np.random.default_rng((plan.seed, plan.turn, block.number)).random(len(rows)) < plan.share]
            for k, wanted in enumerate(plan.nodes):
                if not wanted:
                    continue
                place = np.full(len(plan.trees[k][0]), -1, np.int64)
                place[wanted] = np.arange(len(wanted))
                own = place[leaves(plan.trees[k], block.bins)][rows]
                r, own = rows[own >= 0], own[own >= 0] * (BINS + 1)
                if not len(r):
                    continue
                w, q = block.weight[r], p[r, k]
                g = w * (q - (block.label[r] == k))
                h = w * np.maximum(q * (1 - q) * (2 if plan.double else 1), plan.floor)
                for f in plan.features[k]:
                    at = own + block.bins[r, f]
                    n = np.bincount(at)
                    cell = np.flatnonzero(n)
                    yield (k, int(f)), (cell, np.stack([np.bincount(at, g)[cell], np.bincount(at, h)[cell], n[cell]], 1))

    return run


def _added(a, b):
    cell, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    both = np.concatenate([a[1], b[1]])
    return cell, np.stack([np.bincount(at, both[:, i], len(cell)) for i in range(3)], 1)


def _dense(sums, places: int) -> np.ndarray:
    out = np.zeros((places * (BINS + 1), 3))
    if sums is not None:
        out[sums[0]] = sums[1]
    return out.reshape(places, BINS + 1, 3)


def _level(places: list, parents: list):
    """Sums of all nodes of a level from those that were summed and, for their siblings, the parents' sums.

    ``parents[k]`` has, for each node of the level, (place among the summed ones or -1, place of the parent or -1, place of the
    summed sibling or -1).
    """

    def run(item):
        (k, f), (before, now) = item
        now = _dense(next(iter(now), None), places[k])
        before = next(iter(before), None)
        out = np.empty((len(parents[k]), BINS + 1, 3))
        for i, (own, parent, sibling) in enumerate(parents[k]):
            out[i] = now[own] if own >= 0 else before[parent] - now[sibling]
        return (k, f), out

    return run


def _best(l2: float, least: int, mass: float):
    """(class, place, feature, gain, cut, missing left, sums on the left, sums of the node) for each node of a level."""

    def score(x):
        return x[..., 0] ** 2 / np.maximum(x[..., 1] + l2, 1e-12)

    def run(item):
        (k, f), sums = item
        total, missing = sums.sum(1), sums[:, BINS]
        right = np.cumsum(sums[:, :BINS - 1], 1)
        left = np.stack([right, right + missing[:, None]], 2)
        rest = total[:, None, None] - left
        ok = ((left[..., 2] >= least) & (rest[..., 2] >= least) & (left[..., 1] >= mass) & (rest[..., 1] >= mass))
        gain = np.where(ok, score(left) + score(rest) - score(total)[:, None, None], -np.inf).reshape(len(sums), -1)
        at = gain.argmax(1)
        return [(k, i, f, float(gain[i, a]), int(a // 2), bool(a % 2), left[i, a // 2, a % 2].tolist(), total[i].tolist())
                for i, a in enumerate(at.tolist())]

    return run


class BoostedTrees(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees for several classes; labels count from 0.

    ``rounds`` rounds of one tree a class and depth up to ``depth``; ``l2`` in the leaves; leaves of at least ``leaf`` rows and
    hessian ``mass``; each tree sees the share ``rows`` of the rows (the same for all classes of a round) and ``columns`` of
    the features. ``doubled`` takes twice the diagonal of the hessian. Missing values go to the better side of each cut.
    Classes without rows get probabilities near 0. No rows raise ValueError.
    """

    rounds = Param(Params._dummy(), "rounds", "trees of each class", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of each tree's values", TypeConverters.toFloat)
    depth = Param(Params._dummy(), "depth", "largest depth", TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "penalty of leaf values", TypeConverters.toFloat)
    leaf = Param(Params._dummy(), "leaf", "fewest rows of a leaf", TypeConverters.toInt)
    mass = Param(Params._dummy(), "mass", "smallest hessian of a leaf", TypeConverters.toFloat)
    rows = Param(Params._dummy(), "rows", "share of rows for a round", TypeConverters.toFloat)
    columns = Param(Params._dummy(), "columns", "share of features for a tree", TypeConverters.toFloat)
    doubled = Param(Params._dummy(), "doubled", "twice the diagonal hessian", TypeConverters.toBoolean)
    classes = Param(Params._dummy(), "classes", "number of classes; 0 counts them", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, seed=42, rounds=100, rate=0.1, depth=5, l2=0.0,
                 leaf=20, mass=1e-3, rows=1.0, columns=1.0, doubled=False, classes=0):
        super().__init__()
        self._setDefault(seed=42, rounds=100, rate=0.1, depth=5, l2=0.0, leaf=20, mass=1e-3, rows=1.0, columns=1.0, doubled=False, classes=0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setWeightCol(self, value: str) -> "BoostedTrees":
        return self._set(weightCol=value)

    def _fit(self, df: DataFrame) -> "BoostedTreesModel":
        opt = lambda name: self.getOrDefault(name)
        spark = df.sparkSession
        sc = spark.sparkContext
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet("weightCol") else F.lit(1.0)
        x = values(df, self.getFeaturesCol())
        rows = df.select(x.alias("x"), F.col(self.getLabelCol()).cast("int").alias("y"), weight.alias("w"))
        first = rows.agg(F.max(F.size("x")).alias("n"), F.max("y").alias("k"), F.count("*").alias("rows")).first()
        if not first["rows"]:
            raise ValueError("no rows to fit")
        size, many = first["n"], max(first["k"] + 1, opt("classes"))
        rows = spread(rows, first["rows"])
        cuts = cut_points(rows, "x", size)
        blocks = _blocks(rows, cuts)
        prior = {r["y"]: r["w"] for r in rows.groupBy("y").agg(F.sum("w").alias("w")).collect()}
        total = sum(prior.values())
        base = np.log(np.maximum([prior.get(k, 0.0) / total for k in range(many)], 1e-9))

        def block(r) -> Block:
            return Block(r["number"], np.frombuffer(r["bins"], np.uint8).reshape(r["n"], size), np.frombuffer(r["label"], np.int32),
                         np.frombuffer(r["weight"], float), np.tile(base, (r["n"], 1)))

        if not sc.getCheckpointDir():
            sc.setCheckpointDir(scratch_path(spark, "boosting"))
        state = blocks.rdd.map(block).persist(StorageLevel.MEMORY_AND_DISK)
        # a level has one table of sums for each class and feature; few rows are summed in as few tasks as they are read in
        reducers = max(1, min(sc.defaultParallelism, many * size, state.getNumPartitions()))
        old, forest = None, []
        for turn in range(opt("rounds")):
            trees = self._grow(state, turn, many, size, reducers)
            if old is not None:
                old.unpersist()
            forest.append(trees)
            if all(len(t.feature) == 1 and t.value[0] == 0 for t in trees):
                break
            flat, old = [t.arrays() for t in trees], state

            def step(b: Block, flat=flat) -> Block:
                gain = np.stack([t[5][leaves(t, b.bins)] for t in flat], 1)
                return Block(b.number, b.bins, b.label, b.weight, b.scores + gain)

            state = old.map(step).persist(StorageLevel.MEMORY_AND_DISK)
            if turn % KEEP == KEEP - 1:
                state.checkpoint()
        state.unpersist()
        if old is not None:
            old.unpersist()
        return BoostedTreesModel(self.getFeaturesCol(), _pack(cuts, base, forest))

    def _grow(self, state, turn: int, many: int, size: int, reducers: int) -> list[Tree]:
        """One tree for each class, level by level."""
        opt = lambda name: self.getOrDefault(name)
        rng = np.random.default_rng((opt("seed"), turn))
        take = max(1, round(opt("columns") * size))
        features = [np.sort(rng.permutation(size)[:take]).tolist() for _ in range(many)]
        trees = [Tree() for _ in range(many)]
        rate, l2, leaf, mass = opt("rate"), opt("l2"), opt("leaf"), opt("mass")
        level = [[0] for _ in range(many)]
        asked, parents = [[0] for _ in range(many)], [[(0, -1, -1)] for _ in range(many)]
        before, held = None, []
        for depth in range(opt("depth")):
            plan = Plan(turn, opt("seed"), opt("rows"), 1e-16, opt("doubled"), [t.arrays() for t in trees], features, asked)
            now = state.mapPartitions(_sums(plan)).reduceByKey(_added, reducers)
            sums = (before.cogroup(now, reducers) if before is not None else now.mapValues(lambda x: ((), (x,))))
            sums = sums.filter(lambda x, p=parents: bool(p[x[0][0]])).map(_level([len(a) for a in asked], parents), True).persist()
            held.append(sums)
            found = sums.flatMap(_best(l2, leaf, mass)).collect()
            if depth and len(held) > 1:
                held.pop(0).unpersist()
            best: dict = {}
            for k, i, f, gain, cut, side, left, all_ in found:
                # equal gains: the first feature
                if (k, i) not in best or (-gain, f) < (-best[k, i][0], best[k, i][1]):
                    best[k, i] = (gain, f, cut, side, np.array(left), np.array(all_))
            value = lambda s: float(-s[0] / max(s[1] + l2, 1e-12) * rate)
            able = lambda s: depth + 1 < opt("depth") and s[2] >= 2 * leaf and s[1] >= 2 * mass
            after, wanted, family = ([[] for _ in range(many)] for _ in range(3))
            for (k, i), (gain, f, cut, side, left, all_) in sorted(best.items(), key=lambda x: x[0]):
                node = level[k][i]
                if not depth:
                    trees[k].value[0] = value(all_)
                if not gain > _LEAST_GAIN:
                    continue
                ends = trees[k].split(node, f, cut, side)
                sides = [left, all_ - left]
                for n, s in zip(ends, sides):
                    trees[k].value[n] = value(s)
                go = [able(s) for s in sides]
                small = 0 if sides[0][2] <= sides[1][2] else 1
                if all(go):
                    own = len(wanted[k])
                    wanted[k].append(ends[small])
                    for j in (0, 1):
                        after[k].append(ends[j])
                        family[k].append((own, -1, -1) if j == small else (-1, i, own))
                elif any(go):
                    family[k].append((len(wanted[k]), -1, -1))
                    wanted[k].append(ends[go.index(True)])
                    after[k].append(ends[go.index(True)])
            if not any(after):
                break
            level, asked, parents, before = after, wanted, family, sums
        for x in held:
            x.unpersist()
        return trees


class BoostedTreesModel(ArrayModel):
    """Fitted trees as arrays."""

    @staticmethod
    def scorer(arrays: dict[str, np.ndarray]):
        cuts = np.split(arrays["cuts"], np.cumsum(arrays["cut_sizes"])[:-1])
        ends = np.cumsum(arrays["sizes"])[:-1]
        trees = list(zip(*[np.split(arrays[f"c{i}"], ends) for i in range(6)])) if len(arrays["sizes"]) else []
        base = arrays["base"]

        def score(x: np.ndarray) -> np.ndarray:
            bins, scores = binned(x, cuts), np.tile(base, (len(x), 1))
            for i, t in enumerate(trees):
                scores[:, i % len(base)] += t[5][leaves(t, bins)]
            return softmax(scores)

        return score, len(cuts)


def _pack(cuts: list[np.ndarray], base: np.ndarray, forest: list[list[Tree]]) -> str:
    flat = [t.arrays() for turn in forest for t in turn]
    columns = {f"c{i}": np.concatenate([t[i] for t in flat]) if flat else np.zeros(0) for i in range(6)}
    return packed(base=base, sizes=np.array([len(t[0]) for t in flat], np.int64), cut_sizes=np.array([len(c) for c in cuts], np.int64),
                  cuts=np.concatenate(cuts) if cuts else np.zeros(0), **columns)
