"""K-Means and bisecting K-Means over packed points, for tables on which the library's passes take too long.

Vectors are packed once into numpy blocks, eight bytes a coordinate, which stay cached. Many runs of
K-Means advance in one job per iteration; starting centers come from all points by the parallel
seeding of :mod:`clustering`. Bisecting follows the library step by step, with its random
numbers, and takes one job per iteration for all clusters that are being split. Centers come
back as the library's models.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.clustering import BisectingKMeans, BisectingKMeansModel, KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.mllib.linalg import Vectors as StoredVectors, VectorUDT as StoredVectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwell.operators.boosting import _summed
from tripwell.sources.storage import new_path

FEW_ROWS = 1_000_000
BLOCK_POINTS, SLICE = 30_000, 4096
PLAIN_TASKS = 32


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0

    def block() -> pa.RecordBatch:
        points = np.concatenate(held).T
        return pa.RecordBatch.from_arrays([pa.array([points.tobytes()], pa.binary()), pa.array([rows], pa.int32())],
                                          names=["points", "rows"])

    for batch in batches:
        if batch.num_rows:
            held.append(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
            rows += batch.num_rows
        if rows >= BLOCK_POINTS:
            yield block()
            held, rows = [], 0
    if held:
        yield block()


def packed_vectors(vectors: DataFrame) -> RDD:
    """(number, coordinates by points) of every block of the column ``features``, cached; the caller releases it."""
    cores = max(vectors.sparkSession.sparkContext.defaultParallelism, 1)
    blocks = vectors.select(vector_to_array("features").alias("x")).mapInArrow(_pack, "points binary, rows int")
    blocks = blocks.withColumn("number", F.monotonically_increasing_id())
    if vectors.rdd.getNumPartitions() < cores:
        blocks = blocks.repartition(cores)
    return blocks.rdd.map(lambda r: (r[2], np.frombuffer(r[0]).reshape(-1, r[1]))).persist(StorageLevel.MEMORY_AND_DISK)


def _slices(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
    for _, points in blocks:
        for at in range(0, points.shape[1], SLICE):
            yield points[:, at:at + SLICE]


def _gaps(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of every center (rows) to every point, less the point's own square."""
    return (centers * centers).sum(axis=1)[:, None] - 2.0 * (centers @ x)


def _nearest(gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least gap of every point and, center by center, which points are nearest to it; the first center wins a tie."""
    least = gaps.min(axis=0)
    hit = gaps == least
    if np.count_nonzero(hit) != len(least):
        hit = np.arange(len(gaps))[:, None] == gaps.argmin(axis=0)
    return least, hit.astype("float64")


def _middle(groups: Sequence[np.ndarray]) -> np.ndarray:
    """A point amid all centers, from which coordinates are measured to keep their digits."""
    return np.concatenate(groups).mean(axis=0)


def cluster_sums(points: RDD, groups: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """For every group of centers the sizes, sums and squared deviations from ``_middle`` of its clusters, and the cost."""
    middle = _middle(groups)

    def sums(blocks: Iterator[tuple]) -> Iterator[list]:
        moved = [g - middle for g in groups]
        every, ends = np.concatenate(moved), np.cumsum([len(g) for g in groups])
        totals = [np.zeros((len(g), len(middle) + 2)) for g in groups]
        costs = np.zeros(len(groups))
        for x in _slices(blocks):
            x = x - middle[:, None]
            own = (x * x).sum(axis=0)
            columns = np.vstack([np.ones(len(own)), own, x]).T
            gaps, whole = _gaps(x, every), own.sum()
            for i, end in enumerate(ends):
                least, hit = _nearest(gaps[end - len(groups[i]):end])
                totals[i] += hit @ columns
                costs[i] += max(least.sum() + whole, 0.0)
        yield [*totals, costs]

    *found, costs = _summed(points.mapPartitions(sums))
    return [(t[:, 0], t[:, 2:] + t[:, :1] * middle, t[:, 1], float(c)) for t, c in zip(found, costs)]


def parallel_starts(points: RDD, runs: Sequence[tuple[int, int]], rounds: int = 2) -> list[np.ndarray]:
    """Starting centers of runs (k, seed), as of ``clustering.parallel_seeds`` on points that all weigh the same.

    The exponential draws come from the run's seed, the round and the number of the block.
    """
    from tripwell.operators.clustering import plus_plus_centers

    each = [2 * k for k, _ in runs]
    found: list[np.ndarray] = []

    def best(times: np.ndarray, chosen: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(times, kind="stable")[:most]
        return times[order], chosen[:, order]

    def merged(a: list, b: list) -> list:
        return [best(np.concatenate([s[0], t[0]]), np.concatenate([s[1], t[1]], axis=1), n) for s, t, n in zip(a, b, each)]

    for turn in range(rounds + 1):
        def race(blocks: Iterator[tuple], turn=turn, centers=tuple(found)) -> Iterator[list]:
            kept: list = [None] * len(runs)
            for number, x in blocks:
                if centers:
                    middle = _middle(centers)
                    near = x - middle[:, None]
                    own = (near * near).sum(axis=0)
                for i, (_, seed) in enumerate(runs):
                    times = np.random.default_rng([seed % 2 ** 63, turn, number]).standard_exponential(x.shape[1])
                    if centers:
                        pull = np.maximum(_least(near, centers[i] - middle) + own, 0.0)
                        with np.errstate(divide="ignore"):
                            times = times / pull
                    good = np.flatnonzero(times < (kept[i][0][-1] if kept[i] and len(kept[i][0]) == each[i] else np.inf))
                    new = best(times[good], x[:, good], each[i])
                    kept[i] = new if kept[i] is None else best(
                        np.concatenate([kept[i][0], new[0]]), np.concatenate([kept[i][1], new[1]], axis=1), each[i])
            if kept and kept[0] is not None:
                yield kept

        winners = points.mapPartitions(race)
        winners = winners.reduce(merged) if points.getNumPartitions() <= PLAIN_TASKS else winners.treeReduce(merged)
        fresh = [chosen.T for _, chosen in winners]
        found = [np.concatenate([a, b]) for a, b in zip(found, fresh)] if found else fresh
    found = [np.unique(candidates, axis=0) for candidates in found]
    shares = [t[0] for t in cluster_sums(points, found)]
    return [c if len(c) <= k else plus_plus_centers(c, k, seed, w) for c, (k, seed), w in zip(found, runs, shares)]


def _least(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Least gap of every point, a slice at a time."""
    return np.concatenate([_gaps(x[:, at:at + SLICE], centers).min(axis=0) for at in range(0, x.shape[1], SLICE)])


@dataclass
class Run:
    """One run of K-Means; its cost is that of the centers before their last move, as in the library."""

    centers: np.ndarray
    cost: float = 0.0
    iterations: int = 0
    done: bool = False


def lloyd_together(points: RDD, starts: Sequence[np.ndarray], max_iter: int, tol: float = 1e-4) -> list[Run]:
    """Runs from given centers, a job per iteration for all that still move; an empty cluster stays where it is."""
    runs = [Run(c) for c in starts]
    for _ in range(max_iter):
        active = [r for r in runs if not r.done]
        if not active:
            break
        for r, (sizes, sums, _, cost) in zip(active, cluster_sums(points, [r.centers for r in active])):
            moved = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], r.centers)
            r.done = bool((((moved - r.centers) ** 2).sum(axis=1) <= tol * tol).all())
            r.centers, r.cost, r.iterations = moved, cost, r.iterations + 1
    return runs


def silhouettes(points: RDD, groups: Sequence[np.ndarray]) -> list[float]:
    """Mean silhouettes with squared Euclidean distance of the clusterings by several groups of centers.

    The definition is that of ``cluster_quality.silhouette_sq``: distances to a cluster follow
    from its size, mean and variance.
    """
    middle, tables = _middle(groups), []
    for sizes, sums, squares, _ in cluster_sums(points, groups):
        means = sums / np.maximum(sizes, 1)[:, None] - middle
        spread = squares / np.maximum(sizes, 1) - (means ** 2).sum(axis=1)
        tables.append((sizes, means, np.maximum(spread, 0.0)))
    if any(np.count_nonzero(t[0]) < 2 for t in tables):
        raise ValueError("a silhouette needs at least two clusters")

    def scores(blocks: Iterator[tuple]) -> Iterator[list]:
        totals = np.zeros(len(groups))
        for x in _slices(blocks):
            x = x - middle[:, None]
            own = (x * x).sum(axis=0)
            for i, (centers, (sizes, means, spread)) in enumerate(zip(groups, tables)):
                hit = _nearest(_gaps(x, centers - middle))[1].astype(bool)
                gaps = np.maximum(_gaps(x, means) + own, 0.0) + spread[:, None]
                gaps[sizes == 0] = np.inf
                home = (hit * sizes[:, None]).sum(axis=0)
                inside = np.where(hit, gaps, 0.0).sum(axis=0) * home / np.maximum(home - 1, 1)
                nearest = np.where(hit, np.inf, gaps).min(axis=0)
                top = np.maximum(inside, nearest)
                totals[i] += np.where((home > 1) & (top > 0), (nearest - inside) / np.where(top > 0, top, 1.0), 0.0).sum()
        yield [totals]

    return [float(s / t[0].sum()) for s, t in zip(_summed(points.mapPartitions(scores))[0], tables)]


def _about(spark: SparkSession, kind: str, made: Estimator) -> str:
    return json.dumps({"class": f"org.apache.spark.ml.clustering.{kind}", "timestamp": int(time.time() * 1000),
                       "sparkVersion": spark.version, "uid": made.uid, "defaultParamMap": {},
                       "paramMap": {p.name: v for p, v in made.extractParamMap().items() if p.name != "weightCol"}})


def _text(spark: SparkSession, value: str, path: str) -> None:
    spark.createDataFrame([(value,)], "value string").coalesce(1).write.text(path)


def kmeans_model(spark: SparkSession, centers: np.ndarray, made: KMeans) -> KMeansModel:
    """Centers as the library's model, by way of its stored form."""
    path = new_path(spark, "kmeans")
    schema = T.StructType([T.StructField("clusterIdx", T.IntegerType()), T.StructField("clusterCenter", VectorUDT())])
    spark.createDataFrame([(i, Vectors.dense(c)) for i, c in enumerate(centers.tolist())], schema).write.parquet(f"{path}/data")
    _text(spark, _about(spark, "KMeansModel", made), f"{path}/metadata")
    return KMeansModel.load(path)


class _JavaRandom:
    """The doubles of java.util.Random, which the library moves centers by."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def bits(self, count: int) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & (1 << 48) - 1
        return self.state >> 48 - count

    def double(self) -> float:
        return ((self.bits(26) << 27) + self.bits(27)) * 2.0 ** -53


@dataclass
class Cluster:
    size: int
    center: np.ndarray
    cost: float


def _split_sums(points: RDD, centers: dict[int, np.ndarray], parents: Sequence[int]) -> dict[int, Cluster]:
    """The clusters that the children of ``parents`` get, whose centers are given; children of node i are 2i and 2i + 1."""
    order = sorted(parents)

    def descended(x: np.ndarray, node: int) -> Iterator[tuple[int, np.ndarray]]:
        if node in parents or not x.shape[1]:
            yield node, x
            return
        below = [c for c in (2 * node, 2 * node + 1) if c in centers]
        if len(below) == 2:
            right = _right(x, *(centers[c] for c in below))
            yield from descended(x[:, ~right], below[0])
            yield from descended(x[:, right], below[1])
        elif below:
            yield from descended(x, below[0])

    def sums(blocks: Iterator[tuple]) -> Iterator[list]:
        width = len(next(iter(centers.values())))
        totals = {(p, side): np.zeros(width + 2) for p in order for side in (0, 1)}
        for x in _slices(blocks):
            for node, mine in descended(x, 1):
                if node not in parents or not mine.shape[1]:
                    continue
                below = [c for c in (2 * node, 2 * node + 1) if c in centers]
                mine = mine - centers[below[0]][:, None]
                columns = np.vstack([np.ones(mine.shape[1]), (mine * mine).sum(axis=0), mine])
                whole = columns.sum(axis=1)
                share = np.zeros(len(whole))
                if len(below) == 2:
                    right = _right(mine, np.zeros(width), centers[below[1]] - centers[below[0]])
                    share = columns @ right.astype("float64")
                totals[node, below[0] % 2] += whole - share
                if len(below) == 2:
                    totals[node, 1] += share
        yield list(totals.values())

    found = iter(_summed(points.mapPartitions(sums)))
    clusters = {}
    for p in order:
        origin = centers[min(c for c in (2 * p, 2 * p + 1) if c in centers)]
        for side in (0, 1):
            size, squares, *total = next(found)
            if size > 0:
                off = np.array(total) / size
                clusters[2 * p + side] = Cluster(int(size), origin + off, max(float(squares - size * (off @ off)), 0.0))
    return clusters


def _right(x: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which points are nearer to the right center; the left one wins a tie."""
    way = right - left
    return way @ x > way @ (left + right) / 2


def bisected(points: RDD, k: int, seed: int, max_iter: int) -> dict[int, Cluster]:
    """All clusters of the tree by index, the root being 1, following the library's bisecting K-Means."""
    first = cluster_sums(points, [np.zeros((1, points.first()[1].shape[0]))])[0]
    mean = first[1][0] / first[0][0]
    sizes, _, squares, cost = cluster_sums(points, [mean[None]])[0]
    found = active = {1: Cluster(int(sizes[0]), mean, cost)}
    draw, needed, level = _JavaRandom(seed), k - 1, 1
    while active and needed > 0 and level < 63:
        chosen = {i: c for i, c in active.items() if c.size >= 1 and c.cost > 2.220446049250313e-16 * c.size}
        if len(chosen) > needed:
            chosen = dict(sorted(chosen.items(), key=lambda c: -c[1].size)[:needed])
        if not chosen:
            break
        centers = {}
        for i, c in chosen.items():
            reach = 1e-4 * math.sqrt(c.center @ c.center)
            noise = reach * np.array([draw.double() for _ in c.center])
            centers[2 * i], centers[2 * i + 1] = c.center - noise, c.center + noise
        above = {i: c.center for i, c in found.items()}
        for _ in range(max_iter):
            new = _split_sums(points, {**above, **centers}, list(chosen))
            moved = {i: c.center for i, c in new.items()}
            same = moved.keys() == centers.keys() and all((moved[i] == centers[i]).all() for i in moved)
            centers = moved
            if same:  # every further round gives these again
                break
        found, active = {**found, **new}, new
        needed -= len(chosen)
        level += 1
    return found


def bisecting_model(spark: SparkSession, clusters: dict[int, Cluster], made: BisectingKMeans) -> BisectingKMeansModel:
    """The tree of clusters as the library's model, by way of its stored form."""
    rows, numbers = [], {"leaf": 0, "inner": -1}

    def add(at: int) -> int:
        cluster, below = clusters[at], [c for c in (2 * at, 2 * at + 1) if c in clusters]
        inner = 2 * at in clusters
        number = numbers["inner" if inner else "leaf"]
        numbers["inner" if inner else "leaf"] += -1 if inner else 1
        children = [add(c) for c in below] if inner else []
        height = max((math.dist(cluster.center, clusters[c].center) for c in below), default=0.0) if inner else 0.0
        rows.append((number, cluster.size, StoredVectors.dense(cluster.center.tolist()), float(np.linalg.norm(cluster.center)),
                     cluster.cost, height, children))
        return number

    root = add(1)
    path = new_path(spark, "bisecting")
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("index", T.IntegerType()), ("size", T.LongType()), ("center", StoredVectorUDT()), ("norm", T.DoubleType()), ("cost", T.DoubleType()),
        ("height", T.DoubleType()), ("children", T.ArrayType(T.IntegerType())))])
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/data/data")
    cost = sum(r[4] for r in rows if not r[6])
    _text(spark, json.dumps({"class": "org.apache.spark.mllib.clustering.BisectingKMeansModel", "version": "3.0", "rootId": root,
                             "distanceMeasure": "euclidean", "trainingCost": cost}), f"{path}/data/metadata")
    _text(spark, _about(spark, "BisectingKMeansModel", made), f"{path}/metadata")
    return BisectingKMeansModel.load(path)
