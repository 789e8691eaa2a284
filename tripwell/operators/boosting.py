"""Boosted regression trees over packed rows, for tables on which MLlib's passes take too long.

The trees are those of MLlib: borders of at most 32 bins per feature from a seeded sample
of about 10,000 rows, variance gain, one Spark job per level. Rows are packed once into
numpy blocks that hold their bins and what the trees so far leave unexplained; every task
adds up histograms of its blocks, which are summed over tasks and searched for the best
splits. Tables that are fitted with the same settings, like the folds of a search, share these jobs. Features with few bins share a byte, which is taken apart after counting. Gains
that differ by rounding only count as equal, and the first feature wins, so the order of
summation does not decide. What reaches the driver is bounded by bins, nodes and the sample.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwell.operators.bounded import cached, in_parallel
from tripwell.sources.storage import new_path

FEW_ROWS = 500_000
BLOCK_ROWS, WIDTH, SAMPLE_ROWS = 30_000, 64, 10_000
PLAIN_TASKS = 32
_EQUAL = 1e-11


def bin_borders(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds between the distinct values, evenly spaced by rows as in MLlib."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) <= most:
        return middles
    stride = len(values) / (most + 1)
    chosen, target, seen = [], stride, np.cumsum(counts)
    for i in range(1, len(distinct)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            chosen.append(middles[i - 1])
            target += stride
    return np.array(chosen[:most])


@dataclass
class Layout:
    """Where the bins of every feature lie: its byte, the factor and number of its bins there."""

    borders: list[np.ndarray]
    byte: list[int] = field(default_factory=list)
    factor: list[int] = field(default_factory=list)
    widths: list[int] = field(default_factory=list)

    def __post_init__(self):
        for bins in self.bins:
            at = next((i for i, w in enumerate(self.widths) if w * bins <= WIDTH), len(self.widths))
            if at == len(self.widths):
                self.widths.append(1)
            self.byte.append(at)
            self.factor.append(self.widths[at])
            self.widths[at] *= bins

    @property
    def bins(self) -> list[int]:
        return [len(b) + 1 for b in self.borders]

    def codes(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.widths)), dtype=np.uint8)
        for j, borders in enumerate(self.borders):
            out[:, self.byte[j]] += (np.searchsorted(borders, x[:, j]) * self.factor[j]).astype(np.uint8)
        return out

    def by_feature(self, table: np.ndarray, byte: int) -> Iterator[tuple[int, np.ndarray]]:
        """Sums over nodes and codes of a byte as sums over nodes and bins of its features."""
        for j, bins in enumerate(self.bins):
            if self.byte[j] == byte:
                used = table[:, :self.widths[byte]].reshape(len(table), -1, bins, self.factor[j])
                yield j, used.sum(axis=(1, 3))


@dataclass
class Tree:
    """Nodes in order of level; a feature of -1 marks a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    count: np.ndarray
    total: np.ndarray
    squares: np.ndarray
    gain: np.ndarray

    def next_nodes(self, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
        """The byte that every node looks at, and the node that follows for each of its codes."""
        inner, node = self.feature >= 0, np.arange(len(self.feature))
        at = np.where(inner, self.feature, 0)
        bins = (np.arange(WIDTH) // np.array(layout.factor)[at][:, None]) % np.array(layout.bins)[at][:, None]
        follow = self.left[:, None] + (bins > self.cut[:, None])
        return (np.array(layout.byte, dtype=np.intp)[at],
                np.where(inner[:, None], follow, node[:, None]).astype(np.intp).ravel())

    def descend(self, codes: np.ndarray, steps: int, byte: np.ndarray, follow: np.ndarray) -> np.ndarray:
        flat, row, node = codes.ravel("F"), np.arange(len(codes)), np.zeros(len(codes), dtype=np.intp)
        column = byte * len(codes)
        for _ in range(steps):
            at = column.take(node)
            at += row
            node *= WIDTH
            node += flat.take(at)
            node = follow.take(node)
        return node


def _pack(layout: Layout, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0

    def block() -> pa.RecordBatch:
        codes, labels = (np.concatenate(part) for part in zip(*held))
        return pa.RecordBatch.from_arrays([pa.array([codes.tobytes("F")], pa.binary()),
                                           pa.array([labels.tobytes()], pa.binary())], names=["codes", "rest"])

    for batch in batches:
        if batch.num_rows:
            if batch.column(1).null_count or not np.isfinite(y := batch.column(1).to_numpy(zero_copy_only=False)).all():
                raise ValueError("labels must be finite numbers")
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            held.append((layout.codes(x), y))
            rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield block()
            held, rows = [], 0
    if held:
        yield block()


def packed_blocks(df: DataFrame, layout: Layout, part: int = 0) -> DataFrame:
    """Blocks of bins and labels, marked with the number of their table; ``df`` has columns ``x`` and ``y``."""
    blocks = df.mapInArrow(lambda batches: _pack(layout, batches), "codes binary, rest binary")
    return blocks.select(F.lit(part).alias("part"), "codes", "rest")


def packed_rows(blocks: DataFrame, layouts: Sequence[Layout]) -> RDD:
    """The blocks as arrays, bins column by column, dealt evenly over the cores, so that each holds a share of every table."""
    dealt = blocks.repartition(max(blocks.sparkSession.sparkContext.defaultParallelism, 1)).rdd
    widths = [len(layout.widths) for layout in layouts]
    return dealt.map(lambda r: (r[0], np.frombuffer(r[1], np.uint8).reshape(widths[r[0]], -1).T, np.frombuffer(r[2]), None))


class _Sums:
    """Rows and sums per code of every byte, and squares, of the nodes of a level."""

    def __init__(self, layout: Layout, tree: Tree, first: int, level: int):
        self.layout, self.first, self.level = layout, first, level
        self.byte, self.follow = tree.next_nodes(layout)
        self.nodes = len(tree.feature) - first
        size = (self.nodes + 1) * WIDTH
        self.counts, self.sums = ([np.zeros(size) for _ in layout.widths] for _ in range(2))
        self.squares = np.zeros(self.nodes + 1)

    def add(self, tree: Tree, codes: np.ndarray, rest: np.ndarray, weights: np.ndarray | None = None) -> None:
        slot = tree.descend(codes, self.level, self.byte, self.follow) - self.first
        slot[slot < 0] = self.nodes  # rows of finished leaves
        taken = rest if weights is None else weights * rest
        self.squares += np.bincount(slot, taken * rest, self.nodes + 1)
        start = slot * WIDTH
        for j, (counts, sums) in enumerate(zip(self.counts, self.sums)):
            at = start + codes[:, j]
            counts += np.bincount(at, weights, len(counts))
            sums += np.bincount(at, taken, len(sums))

    def by_feature(self) -> list[np.ndarray]:
        out = []
        for tables in (self.counts, self.sums):
            found = [None] * len(self.layout.bins)
            for i, table in enumerate(tables):
                for j, mine in self.layout.by_feature(table.reshape(-1, WIDTH)[:self.nodes], i):
                    found[j] = mine
            out.append(np.concatenate(found, axis=1))
        return [*out, self.squares[:self.nodes]]


def _histograms(layouts: Sequence[Layout], growing: dict[int, tuple[Tree, int]], level: int, ended: Sequence[int],
                blocks: Iterator) -> Iterator[list]:
    """The sums of every table whose tree still grows, then the squares per leaf that blocks bring along."""
    sums = {p: _Sums(layouts[p], tree, first, level) for p, (tree, first) in growing.items()}
    leaves = [np.zeros(n) for n in ended]
    for part, codes, rest, squares in blocks:
        if part in sums:
            sums[part].add(growing[part][0], codes, rest)
        if leaves:
            leaves[part] += squares
    yield [*(a for found in sums.values() for a in found.by_feature()), *leaves]


def _added(a: list, b: list) -> list:
    return [x + y for x, y in zip(a, b)]


def _summed(parts: RDD) -> list:
    return parts.reduce(_added) if parts.getNumPartitions() <= PLAIN_TASKS else parts.treeReduce(_added)


@dataclass
class Splits:
    """The best split of every node of a level, whose feature is -1 where none gains, and what lies left of it."""

    count: np.ndarray
    total: np.ndarray
    squares: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    left_count: np.ndarray
    left_total: np.ndarray


def best_splits(layout: Layout, whole: Sequence[np.ndarray], found: Sequence[np.ndarray], squares: np.ndarray,
                open_to: np.ndarray | None = None, least: int = 1) -> Splits:
    """Splits of nodes from their rows and sums (``whole``) and those per bin of every feature (``found``).

    ``open_to`` tells which features a node may use; both sides of a split have ``least`` rows.
    """
    bins, rows = layout.bins, np.arange(len(squares))
    ends = np.cumsum(bins)
    cuts = np.concatenate([np.arange(e - b, e - 1) for e, b in zip(ends, bins)]).astype(int)  # one per threshold
    owner = np.repeat(np.arange(len(bins)), [b - 1 for b in bins])
    starts = (ends - bins)[owner]
    none = Splits(*whole, squares, np.full(len(rows), -1), *(np.zeros(len(rows), dtype=t) for t in (int, float, float, float)))
    # Running sums restart at every feature.
    running = [np.cumsum(p, axis=1) for p in found]
    left = [r[:, cuts] - np.where(starts > 0, r[:, starts - 1], 0.0) for r in running]
    (n, s), (nl, sl) = (w[:, None] for w in whole), left
    nr, sr = n - nl, s - sl
    allowed = (nl >= least) & (nr >= least)
    if open_to is not None:
        allowed &= open_to[:, owner]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(allowed, sl * sl / nl + sr * sr / nr - s * s / n, -np.inf)
    if not gain.size:
        return none
    best = gain.max(axis=1)
    near = best[:, None] - _EQUAL * squares[:, None]
    chosen = (gain >= near).argmax(axis=1)
    split = rows[best > _EQUAL * squares]
    none.feature[split], none.cut[split] = owner[chosen[split]], (cuts - starts)[chosen[split]]
    none.gain[split] = best[split] / whole[0][split]
    for side, mine in zip((none.left_count, none.left_total), left):
        side[split] = mine[split, chosen[split]]
    return none


def grown(tree: Tree, first: int, found: Splits) -> Tree | None:
    """The tree with the splits of its last level, whose nodes start at ``first``; nothing if there are none."""
    tree.count[first:], tree.total[first:], tree.squares[first:] = found.count, found.total, found.squares
    split = np.flatnonzero(found.feature >= 0)
    if not len(split):
        return None
    at, new = first + split, len(tree.feature) + 2 * np.arange(len(split))
    tree.feature[at], tree.left[at] = found.feature[split], new
    tree.cut[at], tree.gain[at] = found.cut[split], found.gain[split]
    below = [np.column_stack([mine[split], parent[split] - mine[split]]).ravel() for parent, mine in (
        (found.count, found.left_count), (found.total, found.left_total))]
    empty, none = np.full(2 * len(split), -1), np.zeros(2 * len(split))
    return Tree(*(np.concatenate([a, b]) for a, b in zip(
        (tree.feature, tree.cut, tree.left, tree.count, tree.total, tree.squares, tree.gain),
        (empty, empty, empty, *below, none, none))))


def _next_level(layout: Layout, tree: Tree, first: int, found: list[np.ndarray]) -> Tree | None:
    """The tree with the best splits of its last level, whose nodes start at ``first``; nothing if none gains."""
    *found, squares = found
    whole = [part[:, :layout.bins[0]].sum(axis=1) for part in found]
    return grown(tree, first, best_splits(layout, whole, found, squares))


def single_node() -> Tree:
    return Tree(np.array([-1]), np.array([0]), np.array([-1]), *(np.zeros(1) for _ in range(4)))


def grow_trees(points: RDD, layouts: Sequence[Layout], depth: int, ended: Sequence[int] = ()) -> tuple[list[Tree], list]:
    """One tree per table on what its blocks leave unexplained, a job per level for all of them.

    The squares of nodes at the last level are left open: the blocks of the next round bring them along. Those of the
    trees before, of ``ended`` nodes each, are returned beside the new trees.
    """
    trees = [single_node() for _ in layouts]
    first, leaves = dict.fromkeys(range(len(layouts)), 0), []
    for level in range(depth):
        growing = {p: (trees[p], f) for p, f in first.items()}
        carried = ended if level == 0 else ()
        found = _summed(points.mapPartitions(
            lambda blocks, g=growing, n=level, c=carried: _histograms(layouts, g, n, c, blocks)))
        if carried:
            leaves = found[-len(carried):]
        for i, (p, (_, f)) in enumerate(growing.items()):
            tree = _next_level(layouts[p], trees[p], f, found[3 * i:3 * i + 3])
            if tree is None:
                del first[p]
            else:
                first[p], trees[p] = len(trees[p].feature), tree
        if not first:
            break
    return trees, leaves


def boosted_together(blocks: DataFrame, layouts: Sequence[Layout], depth: int, rounds: int, step: float) -> list[list[Tree]]:
    """Trees of gradient boosting with squared error, for every table; all but the first are fitted to twice the residuals.

    The tables take their rounds side by side, since a job costs the same for one as for all.
    """
    sc = blocks.sparkSession.sparkContext
    trees: list[list[Tree]] = [[] for _ in layouts]
    points, before, sent = packed_rows(blocks, layouts).persist(StorageLevel.MEMORY_AND_DISK), None, []

    def close(leaves: list) -> None:
        """Squares of the leaves and, after the first tree, twice the residuals."""
        for mine, squares in zip(trees, leaves):
            tree = mine[-1]
            tree = replace(tree, squares=np.where(tree.feature < 0, squares, tree.squares))
            mine[-1] = tree if len(mine) == 1 else replace(
                tree, total=2 * tree.total, squares=4 * tree.squares, gain=4 * tree.gain)

    try:
        for done in range(rounds):
            grown, leaves = grow_trees(points, layouts, depth, [len(t[-1].feature) for t in trees if done])
            close(leaves)
            if before is not None:
                before.unpersist()
            sent.append(sc.broadcast([
                (t, t.total / np.maximum(t.count, 1) * (2 * step if done else 1.0)) for t in grown]))

            def unexplained(found, b=sent[-1]):
                nodes = [tree.next_nodes(layout) for (tree, _), layout in zip(b.value, layouts)]
                for part, codes, rest, _ in found:
                    tree, moved = b.value[part]
                    node = tree.descend(codes, depth, *nodes[part])
                    yield part, codes, rest - moved.take(node), np.bincount(node, rest * rest, len(moved))

            before, points = points, points.mapPartitions(unexplained).persist(StorageLevel.MEMORY_AND_DISK)
            for mine, tree in zip(trees, grown):
                mine.append(tree)
        if rounds:
            ended = [len(t[-1].feature) for t in trees]
            close(_summed(points.mapPartitions(lambda found: _histograms(layouts, {}, 0, ended, found))))
    finally:
        for kept in (before, points):
            if kept is not None:
                kept.unpersist()
        for b in sent:
            b.destroy()
    return trees


def boosted_trees(df: DataFrame, layout: Layout, depth: int, rounds: int, step: float) -> list[Tree]:
    return boosted_together(packed_blocks(df, layout), [layout], depth, rounds, step)[0]


_NODES = """treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>,
  rawCount: bigint, gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int,
  leftCategoriesOrThreshold: array<double>, numCategories: int>>"""


def _node_rows(number: int, tree: Tree, borders: Sequence[np.ndarray]) -> Iterator[tuple]:
    for i, (f, cut, left, n, s, q, gain) in enumerate(zip(*(a.tolist() for a in vars(tree).values()))):
        shared = (i, s / n, max(q / n - (s / n) ** 2, 0.0), [n, s, q], int(n))
        yield number, ((*shared, gain, left, left + 1, (f, [float(borders[f][cut])], -1)) if f >= 0 else
                       (*shared, -1.0, -1, -1, (-1, [], -1)))


def as_library_model(spark: SparkSession, trees: Sequence[Tree], made: Estimator, borders: Sequence[np.ndarray]):
    """The trees of a booster or a forest as MLlib's model, by way of its stored form."""
    boosted = isinstance(made, GBTRegressor)
    kind = "GBTRegressionModel" if boosted else "RandomForestRegressionModel"

    def about(kind: str, uid: str, **more) -> str:
        value = {p.name: v for p, v in made.extractParamMap().items() if not kind.startswith("Decision") or p.name in (
            "featuresCol", "labelCol", "predictionCol", "maxDepth", "maxBins", "seed")}
        return json.dumps({"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000),
                           "sparkVersion": spark.version, "uid": uid, "paramMap": value, "defaultParamMap": {}, **more})

    path = new_path(spark, "booster" if boosted else "forest")
    rows = [r for i, t in enumerate(trees) for r in _node_rows(i, t, borders)]
    spark.createDataFrame(rows, _NODES).write.parquet(f"{path}/data")
    weights = [1.0, *[made.getStepSize() if boosted else 1.0] * (len(trees) - 1)]
    spark.createDataFrame([(i, about("DecisionTreeRegressionModel", f"{made.uid}_{i}"), w) for i, w in enumerate(weights)],
                          "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    whole = about(kind, made.uid, numFeatures=len(borders), numTrees=len(trees))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return (GBTRegressionModel if boosted else RandomForestRegressionModel).load(path)


class PackedFit:
    """What estimators share that fit large tables on packed rows if only the parameters in ``_HERE`` are set."""

    _HERE = {"featuresCol", "labelCol", "predictionCol", "maxDepth", "maxBins", "seed", "maxMemoryInMB", "cacheNodeIds",
             "checkpointInterval"}

    def bare(self, dataset: DataFrame) -> DataFrame:
        return dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))

    def layout(self, dataset: DataFrame) -> Layout | None:
        """The bins of the packed form, or nothing where the library makes the fit."""
        about = json.dumps(dataset.schema[self.getFeaturesCol()].metadata)
        other = any(p.name not in self._HERE and self.isSet(p) for p in self.params)
        if other or self.getMaxBins() > WIDTH or not self.getMaxDepth() or "nominal" in about or "binary" in about:
            return None
        count = dataset.count()
        if count <= FEW_ROWS:
            return None
        rows = self.bare(dataset)
        wanted = max(SAMPLE_ROWS, self.getMaxBins() ** 2)
        some = rows.select("x") if count <= wanted else rows.select("x").sample(wanted / count, self.getSeed())
        sample = np.array([r[0] for r in some.collect()])
        return Layout([bin_borders(v, min(self.getMaxBins(), count) - 1) for v in sample.T])


class BoostedTrees(PackedFit, GBTRegressor):
    """MLlib's booster, with packed rows above ``FEW_ROWS`` rows if only depth, rounds, step, bins and seed are set."""

    _HERE = PackedFit._HERE | {"maxIter", "stepSize"}

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        layout = self.layout(dataset)
        if layout is None:
            return super()._fit(dataset)
        trees = boosted_trees(self.bare(dataset), layout, self.getMaxDepth(), self.getMaxIter(), self.getStepSize())
        return as_library_model(dataset.sparkSession, trees, self, layout.borders)


def fit_depths(booster: BoostedTrees, depths: Sequence[int], tables: Sequence[DataFrame],
               parallelism: int) -> dict[tuple[int, int], GBTRegressionModel]:
    """The booster with every depth on every table, by depth and number of the table.

    Large tables are packed once for all depths, and fits of a depth share their jobs.
    """
    made = {d: booster.copy({booster.maxDepth: d}) for d in depths}
    layouts = in_parallel([lambda t=t: made[depths[0]].layout(t) for t in tables], parallelism)
    if any(layout is None for layout in layouts) or not all(depths):
        plan = [(d, i) for d in made for i in range(len(tables))]
        return dict(zip(plan, in_parallel([lambda d=d, i=i: made[d].fit(tables[i]) for d, i in plan], parallelism)))
    blocks = cached(reduce(DataFrame.union, [packed_blocks(booster.bare(t), layouts[i], i) for i, t in enumerate(tables)]))

    def run(depth: int) -> dict:
        trees = boosted_together(blocks, layouts, depth, booster.getMaxIter(), booster.getStepSize())
        return {(depth, i): as_library_model(blocks.sparkSession, found, made[depth], layouts[i].borders)
                for i, found in enumerate(trees)}

    try:
        blocks.count()
        found = in_parallel([lambda d=d: run(d) for d in made], parallelism)
    finally:
        blocks.unpersist()
    return {at: model for part in found for at, model in part.items()}
