"""Grouping trips: library models, own Lloyd rounds, restarts and stability."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwell.functions.hashing import LANES, key_digest, lane_poisson_weight, unit_hash
from tripwell.operators import packed_means
from tripwell.operators.bounded import bounded_rows, cached, in_parallel, spread_rows
from tripwell.operators.cluster_quality import silhouette_sq

CLUSTER_FEATURES = ("trip_distance", "fare_amount", "trip_duration_min")


def scaled_vectors(df: DataFrame, features: Sequence[str] = CLUSTER_FEATURES,
                   centered: bool = True) -> DataFrame:
    """Add ``features``: the standardised vector of the feature columns.

    Without centering the vectors are only brought to unit deviation, which is
    the same clustering problem moved away from the origin.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="features_raw")
    assembled = assembler.transform(df)
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withStd=True,
                            withMean=centered)
    return scaler.fit(assembled).transform(assembled).drop("features_raw")


NARROW_CELLS = 64  # clusters times coordinates up to which a row's distances are columns


def silhouette_of(model, vectors: DataFrame) -> float:
    """Mean silhouette with squared Euclidean distance of a fitted model over all rows.

    Coordinates become columns, which take less time than the library's evaluator; of many
    clusters or wide vectors the evaluator works it out.
    """
    labelled = model.transform(vectors)
    centers = model.clusterCenters()
    if len(centers) * len(centers[0]) > NARROW_CELLS:
        return ClusteringEvaluator(featuresCol="features", metricName="silhouette").evaluate(labelled)
    names = [f"_x{j}" for j in range(len(centers[0]))]
    values = labelled.select("prediction", vector_to_array("features").alias("_values"))
    points = values.select("prediction", *[F.get("_values", F.lit(j)).alias(x) for j, x in enumerate(names)])
    return silhouette_sq(points, names, "prediction").first()["silhouette"]


@dataclass
class KMeansTrial:
    k: int
    silhouette: float
    cost: float
    model: object


def kmeans_search(vectors: DataFrame, ks: Sequence[int] = (3, 4, 5, 6), seed: int = 42,
                  max_iter: int = 20) -> list[KMeansTrial]:
    """One K-Means fit per k with its silhouette; of large tables all fits share the passes over packed points."""
    def made(k: int) -> KMeans:
        return KMeans(featuresCol="features", k=k, seed=seed, maxIter=max_iter, solver="block")

    if vectors.count() > packed_means.FEW_ROWS:
        points = packed_means.packed_vectors(vectors)
        try:
            starts = packed_means.parallel_starts(points, [(k, seed) for k in ks])
            runs = packed_means.lloyd_together(points, starts, max_iter)
            scores = packed_means.silhouettes(points, [r.centers for r in runs])
        finally:
            points.unpersist()
        return [KMeansTrial(k, s, r.cost, packed_means.kmeans_model(vectors.sparkSession, r.centers, made(k)))
                for k, r, s in zip(ks, runs, scores)]

    def trial(k: int) -> KMeansTrial:
        model = made(k).fit(vectors)
        return KMeansTrial(k, silhouette_of(model, vectors), model.summary.trainingCost, model)

    return in_parallel([lambda k=k: trial(k) for k in ks])


def best_trial(trials: Sequence[KMeansTrial]) -> KMeansTrial:
    """Highest silhouette; the smaller k wins a tie."""
    return max(trials, key=lambda t: (t.silhouette, -t.k))


def fit_bisecting(vectors: DataFrame, k: int = 5, seed: int = 42, max_iter: int = 20):
    """Bisecting K-Means; pass vectors that are not centered.

    A cluster is split by moving its center by a small fraction of the center's
    length. The center of centered data has no length, so its first split would
    depend on rounding noise. Large tables are split by the same steps over packed points.
    """
    made = BisectingKMeans(featuresCol="features", k=k, seed=seed, maxIter=max_iter)
    if vectors.count() <= packed_means.FEW_ROWS:
        return made.fit(vectors)
    points = packed_means.packed_vectors(vectors)
    try:
        clusters = packed_means.bisected(points, k, seed, max_iter)
    finally:
        points.unpersist()
    return packed_means.bisecting_model(vectors.sparkSession, clusters, made)


def fit_gaussian_mixture(vectors: DataFrame, k: int = 5, seed: int = 42, max_iter: int = 20):
    return GaussianMixture(featuresCol="features", k=k, seed=seed, maxIter=max_iter).fit(vectors)


def kmeans_restarts(vectors: DataFrame, k: int = 4, restarts: int = 10, seed: int = 42,
                    max_iter: int = 300) -> list[KMeansTrial]:
    """Independent initialisations; the caller keeps the one of least cost.

    On large tables all of them advance together, a job per iteration over packed points.
    """
    def made(s: int) -> KMeans:
        return KMeans(featuresCol="features", k=k, seed=s, maxIter=max_iter, solver="block")

    if vectors.count() > packed_means.FEW_ROWS:
        seeds, points = range(seed, seed + restarts), packed_means.packed_vectors(vectors)
        try:
            runs = packed_means.lloyd_together(points, packed_means.parallel_starts(points, [(k, s) for s in seeds]), max_iter)
        finally:
            points.unpersist()
        return [KMeansTrial(k, math.nan, r.cost, packed_means.kmeans_model(vectors.sparkSession, r.centers, made(s)))
                for s, r in zip(seeds, runs)]

    def trial(s: int) -> KMeansTrial:
        model = made(s).fit(vectors)
        return KMeansTrial(k, math.nan, model.summary.trainingCost, model)

    return in_parallel([lambda s=seed + i: trial(s) for i in range(restarts)])


def assign_nearest(df: DataFrame, features: Sequence[str], centers: Sequence[Sequence[float]],
                   label: str = "cluster", distance: str | None = None) -> DataFrame:
    """Nearest center per row, the lowest index on a tie; optionally its squared distance."""
    squared = []
    for center in centers:
        terms = [(F.col(f) - F.lit(float(x))) * (F.col(f) - F.lit(float(x)))
                 for f, x in zip(features, center)]
        squared.append(sum(terms[1:], terms[0]))
    names = [f"_d{i}" for i in range(len(squared))]
    out = df.withColumns(dict(zip(names, squared)))
    least = F.least(*names) if len(names) > 1 else F.col(names[0])
    index = None
    for i, name in enumerate(names):
        hit = F.col(name) == least
        index = F.when(hit, F.lit(i)) if index is None else index.when(hit, F.lit(i))
    extra = {label: index}
    if distance:
        extra[distance] = least
    return out.withColumns(extra).drop(*names)


@dataclass
class LloydRun:
    """One K-Means run: which replicate's weights it sees and where its centers are."""

    replicate: int
    centers: np.ndarray
    cost: float = math.inf
    iterations: int = 0
    done: bool = False

    def move(self, counts: np.ndarray, sums: np.ndarray, cost: float, tol: float) -> None:
        """Take the means of the assigned points; an empty cluster stays where it is."""
        filled = counts > 0
        moved = self.centers.copy()
        moved[filled] = sums[filled] / counts[filled, None]
        self.cost = cost
        self.iterations += 1
        self.done = bool(np.linalg.norm(moved - self.centers) < tol)
        self.centers = moved


def first_rows_as_centers(df: DataFrame, features: Sequence[str], keys: Sequence[str], k: int,
                          seed: int = 42) -> np.ndarray:
    """k distinct points as starting centers: those that come first in hash order.

    Each distinct point counts once, with its smallest hash; k rows reach the driver.
    """
    first = (df.groupBy(*features).agg(F.min(unit_hash(keys, seed)).alias("_u"))
             .orderBy("_u", *features).limit(k).collect())
    if len(first) < k:
        raise ValueError(f"fewer than {k} distinct points")
    return np.array([[r[f] for f in features] for r in first], dtype="float64")


def plus_plus_centers(points: np.ndarray, k: int, seed: int, weights: np.ndarray | None = None) -> np.ndarray:
    """k-means++ seeding on a few weighted candidates held by the driver."""
    draw = np.random.default_rng(seed)
    weights = np.ones(len(points)) if weights is None or not weights.any() else weights.astype("float64")
    chosen = [points[draw.choice(len(points), p=weights / weights.sum())]]
    for _ in range(k - 1):
        gaps = weights * np.min([((points - c) ** 2).sum(axis=1) for c in chosen], axis=0)
        pull = gaps if gaps.sum() > 0 else weights
        chosen.append(points[draw.choice(len(points), p=pull / pull.sum())])
    return np.array(chosen)


def lloyd_kmeans(df: DataFrame, features: Sequence[str], keys: Sequence[str], k: int = 5,
                 max_iter: int = 100, tol: float = 1e-4, seed: int = 42) -> LloydRun:
    """Plain Lloyd K-Means from k random distinct rows.

    Each round is one map-side aggregated job; k sums return to the driver. It
    ends when the centers move less than ``tol`` in Frobenius norm.
    """
    points = cached(df.select(*features, *keys))
    try:
        run = LloydRun(0, first_rows_as_centers(points, features, keys, k, seed))
        while not run.done and run.iterations < max_iter:
            rows = (assign_nearest(points, features, run.centers.tolist(), "_cluster", "_gap")
                    .groupBy("_cluster")
                    .agg(F.count(F.lit(1)).alias("n"), F.sum("_gap").alias("cost"),
                         *[F.sum(f).alias(f"s{j}") for j, f in enumerate(features)]).collect())
            counts, sums = np.zeros(k), np.zeros((k, len(features)))
            for r in rows:
                counts[r["_cluster"]] = r["n"]
                sums[r["_cluster"]] = [r[f"s{j}"] for j in range(len(features))]
            run.move(counts, sums, sum(r["cost"] for r in rows), tol)
        return run
    finally:
        points.unpersist()


BLOCK_POINTS = 4096
CELL_BUDGET = 500_000  # distances held at once by a task
DIRECT_CELLS = 20_000  # partial sums that the driver adds up itself


def point_blocks(points: DataFrame, features: Sequence[str], weights: Sequence[str]) -> DataFrame:
    """Points as numpy blocks of bounded size, for jobs that read them many times over.

    A row holds up to 4096 points in ``data``: features, weights and a hash of the features.
    """
    columns = [F.col(c).cast("double").alias(c) for c in [*features, *weights]]
    digest = F.xxhash64(*[F.col(f).cast("double") for f in features])

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes = batch.pop("_hash").to_numpy("int64")
            table = np.column_stack([batch.to_numpy("float64"), hashes.view("float64")])
            parts = [table[i:i + BLOCK_POINTS] for i in range(0, len(table), BLOCK_POINTS)]
            yield pd.DataFrame({"data": [np.ascontiguousarray(p).tobytes() for p in parts]})

    return points.select(*columns, digest.alias("_hash")).mapInPandas(pack, "data binary")


def _slices(batches: Iterator[pd.DataFrame], width: int, weights: int, cells: int) -> Iterator[tuple]:
    """(features, weights, hashes) of a few points at a time, so that cells x points stays bounded."""
    step = max(1, CELL_BUDGET // cells)
    for batch in batches:
        for data in batch["data"]:
            table = np.frombuffer(data).reshape(-1, width + weights + 1)
            for i in range(0, len(table), step):
                part = table[i:i + step]
                yield part[:, :width], part[:, width:-1], np.ascontiguousarray(part[:, -1]).view("uint64")


def _squared_gaps(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """(points, runs, centers) squared distances, from differences."""
    gaps = np.zeros((len(x), *centers.shape[:2]))
    for j in range(centers.shape[2]):
        off = x[:, j, None, None] - centers[None, :, :, j]
        off *= off
        gaps += off
    return gaps


def _partial_sums(batches: Iterator[pd.DataFrame], centers: np.ndarray, columns: list[int],
                  weights: int) -> Iterator[pd.DataFrame]:
    """Weighted sums per run and cluster over one partition.

    ``centers`` is (runs, k, features); ``columns`` names the weight column of
    each run. Emits runs * k rows per partition.
    """
    runs, k, width = centers.shape
    totals = np.zeros((runs, k, 2 + width))
    for x, w, _ in _slices(batches, width, weights, runs * k):
        gaps = _squared_gaps(x, centers)
        nearest, w = gaps.argmin(axis=2), w[:, columns]
        least = np.take_along_axis(gaps, nearest[:, :, None], 2)[:, :, 0]
        share = ((nearest[:, :, None] == np.arange(k)) * w[:, :, None]).reshape(len(x), runs * k)
        totals[:, :, 0] += share.sum(axis=0).reshape(runs, k)
        totals[:, :, 1] += np.einsum("prk,pr->rk", share.reshape(len(x), runs, k), least)
        totals[:, :, 2:] += (share.T @ x).reshape(runs, k, width)
    out = pd.DataFrame(totals.reshape(runs * k, 2 + width),
                       columns=["n", "cost", *[f"s{j}" for j in range(width)]])
    out.insert(0, "cell", np.arange(runs * k, dtype="int32"))
    yield out


def _sums(blocks: DataFrame, partitions: int, centers: np.ndarray, columns: list[int], weights: int) -> np.ndarray:
    """(runs, k, 2 + features): weight, cost and weighted feature sums of every cluster of every run.

    Few partitions send their sums straight to the driver, more are added up by the cluster first.
    """
    runs, k, width = centers.shape
    schema = "cell int, n double, cost double, " + ", ".join(f"s{j} double" for j in range(width))
    cells = blocks.mapInPandas(lambda batches: _partial_sums(batches, centers, columns, weights), schema)
    if partitions * runs * k > DIRECT_CELLS:
        cells = cells.groupBy("cell").agg(*[F.sum(c).alias(c) for c in cells.columns[1:]])
    table = cells.toPandas()
    totals = np.zeros((runs * k, 2 + width))
    np.add.at(totals, table["cell"].to_numpy(), table.to_numpy()[:, 1:])
    return totals.reshape(runs, k, 2 + width)


def _race_times(hashes: np.ndarray, turn: int, salts: np.ndarray) -> np.ndarray:
    """(points, runs) exponential draws that depend on the point, the run's salt and the round only."""
    with np.errstate(over="ignore"):
        z = hashes[:, None] ^ (salts[None, :] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn + 1))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        z ^= z >> np.uint64(31)
    return -np.log(((z >> np.uint64(11)).astype("float64") + 0.5) / 2.0 ** 53)


def parallel_seeds(blocks: DataFrame, width: int, weights: int, runs: Sequence[tuple[int, int]], k: int,
                   rounds: int = 2, oversample: int | None = None) -> list[np.ndarray]:
    """Starting centers of many runs (weight column, seed), from all weighted points.

    Each round adds to every run ``oversample`` (2k) points, drawn without replacement by
    weight times squared distance to the run's candidates (the first round by weight).
    A point's draw is an exponential time divided by that product, and the smallest times
    win, so one pass needs no total and partitioning does not matter. Candidates then
    weigh what lies nearest to them, and k-means++ picks k of them on the driver, which
    holds runs x (rounds + 1) x ``oversample`` points.
    """
    each = oversample or 2 * k
    columns, salts = [r for r, _ in runs], np.array([s for _, s in runs], dtype="uint64")
    schema = "run int, time double, " + ", ".join(f"c{j} double" for j in range(width))
    partitions, found = blocks.rdd.getNumPartitions(), None
    for turn in range(rounds + 1):
        def race(batches, centers=found, turn=turn):
            times, points = np.full((len(runs), each), np.inf), np.zeros((len(runs), each, width))
            cells = len(runs) * (1 if centers is None else centers.shape[1])
            for x, w, hashes in _slices(batches, width, weights, cells):
                pull = w[:, columns]
                if centers is not None:
                    pull = pull * _squared_gaps(x, centers).min(axis=2)
                with np.errstate(divide="ignore"):
                    new = (_race_times(hashes, turn, salts) / pull).T
                first = np.argpartition(new, min(each, len(x)) - 1, axis=1)[:, :each]
                times = np.concatenate([times, np.take_along_axis(new, first, 1)], axis=1)
                points = np.concatenate([points, x[first]], axis=1)
                best = np.argsort(times, axis=1, kind="stable")[:, :each]
                times = np.take_along_axis(times, best, 1)
                points = np.take_along_axis(points, best[:, :, None], 1)
            hit = np.isfinite(times)
            out = pd.DataFrame(points[hit], columns=[f"c{j}" for j in range(width)])
            out.insert(0, "time", times[hit])
            out.insert(0, "run", np.nonzero(hit)[0].astype("int32"))
            yield out

        rows = blocks.mapInPandas(race, schema)
        if partitions * len(runs) * each > DIRECT_CELLS:
            order = Window.partitionBy("run").orderBy("time", *[f"c{j}" for j in range(width)])
            rows = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= each).drop("_n")
        rows = rows.toPandas()
        # Where a run has fewer points left than it asks for, it repeats its first one.
        fresh = np.empty((len(runs), each, width))
        for r in range(len(runs)):
            mine = rows[rows["run"] == r].sort_values(list(rows.columns)).to_numpy()[:each, 2:]
            if not len(mine):
                if found is None:
                    raise ValueError("no points to start from")
                mine = found[r][:1]
            fresh[r] = mine[np.minimum(np.arange(each), len(mine) - 1)] if len(mine) < each else mine
        found = fresh if found is None else np.concatenate([found, fresh], axis=1)
    shares = _sums(blocks, partitions, found, columns, weights)[:, :, 0]
    return [plus_plus_centers(found[i], k, seed, shares[i]) for i, (_, seed) in enumerate(runs)]


def lloyd_many(points: DataFrame, features: Sequence[str], weights: Sequence[str],
               runs: list[LloydRun], max_iter: int = 300, tol: float = 1e-2) -> list[LloydRun]:
    """Advance many runs together: one job per iteration for however many runs.

    ``points`` has the feature columns and one weight column per replicate.
    Each partition is summed in vectorised batches and sends runs * k rows on.
    """
    blocks = cached(point_blocks(points, features, weights))
    try:
        return lloyd_blocks(blocks, len(weights), runs, max_iter, tol)
    finally:
        blocks.unpersist()


def lloyd_blocks(blocks: DataFrame, weights: int, runs: list[LloydRun], max_iter: int = 300,
                 tol: float = 1e-2) -> list[LloydRun]:
    """``lloyd_many`` over packed blocks."""
    partitions = blocks.rdd.getNumPartitions()
    for _ in range(max_iter):
        active = [r for r in runs if not r.done]
        if not active:
            break
        centers, columns = np.array([r.centers for r in active]), [r.replicate for r in active]
        table = _sums(blocks, partitions, centers, columns, weights)
        for r, cell in zip(active, table):
            r.move(cell[:, 0], cell[:, 2:], float(cell[:, 1].sum()), tol)
    return runs


def centers_frame(spark, centers: np.ndarray, features: Sequence[str], **constants) -> DataFrame:
    """Small table of centers: constants, ``cluster`` and one column per feature."""
    names = list(constants)
    rows = [(*constants.values(), i, *map(float, c)) for i, c in enumerate(centers)]
    schema = "".join(f"{n} int, " for n in names) + "cluster int, " + ", ".join(
        f"{f} double" for f in features)
    return spark.createDataFrame(rows, schema)


def center_shift(base: DataFrame, other: DataFrame, features: Sequence[str],
                 by: Sequence[str] = ()) -> DataFrame:
    """Mean distance between two sets of k centers, two ways.

    ``shift_sorted`` sorts every coordinate on its own before pairing (which can
    mix coordinates of different clusters); ``shift_nearest`` pairs each base
    center with the closest one of the other set. Both inputs have k rows (per
    group of ``by``), and the base centers become literals.
    """
    centers = np.array([list(r) for r in bounded_rows(base.select(*features), "centers", 1000)], dtype="float64")
    in_order = np.sort(centers, axis=0)
    grouped = other.groupBy(*by).agg(
        F.collect_list(F.struct(*features)).alias("_points"),
        *[F.sort_array(F.collect_list(f)).alias(f"_s_{f}") for f in features])

    def distance(values, point):
        gaps = [(v - F.lit(float(x))) * (v - F.lit(float(x))) for v, x in zip(values, point)]
        return F.sqrt(sum(gaps[1:], gaps[0]))

    by_rank = [distance([F.get(f"_s_{f}", F.lit(i)) for f in features], in_order[i])
               for i in range(len(centers))]
    def gap_to_closest(center):
        return F.array_min(F.transform("_points", lambda p: distance([p[f] for f in features], center)))

    closest = [gap_to_closest(c) for c in centers]
    return grouped.select(*by, (sum(by_rank[1:], by_rank[0]) / len(centers)).alias("shift_sorted"),
                          (sum(closest[1:], closest[0]) / len(centers)).alias("shift_nearest"))


def replicate_weights(df: DataFrame, keys: Sequence[str], bootstraps: int, seed: int) -> DataFrame:
    """Add ``_w0`` = 1 and the Poisson counts ``_w1``, ``_w2``, ... of the bootstraps."""
    blocks = -(-bootstraps // LANES)
    digests = df.withColumns({f"_h{b}": key_digest([*keys, F.lit(b)], seed) for b in range(blocks)})
    weights = {"_w0": F.lit(1)}
    for i in range(bootstraps):
        weights[f"_w{i + 1}"] = lane_poisson_weight(F.col(f"_h{i // LANES}"), i % LANES)
    return digests.withColumns(weights).drop(*[f"_h{b}" for b in range(blocks)])


def cluster_stability(df: DataFrame, features: Sequence[str], keys: Sequence[str], k: int = 4,
                      bootstraps: int = 10, restarts: int = 5, seed: int = 42,
                      max_iter: int = 300, tol: float = 1e-4) -> DataFrame:
    """Refit on bootstraps and measure how far the centers move.

    ``df`` holds standardised features. Replicate 0 is the unweighted baseline,
    the others weight each row by its Poisson count. Rows with equal features are
    one point with their summed weights. All replicates and restarts advance in the
    same jobs over all points; the best restart of a replicate counts. Starting
    centers are drawn from all points by the replicate's weights. Returns
    (replicate, cost, shift_sorted, shift_nearest).
    """
    spark = df.sparkSession
    narrow = df.select(*features, *keys)
    weights = [f"_w{i}" for i in range(bootstraps + 1)]
    points = spread_rows(replicate_weights(narrow, keys, bootstraps, seed).groupBy(*features).agg(
        *[F.sum(w).cast("double").alias(w) for w in weights]))
    blocks = cached(point_blocks(points, features, weights))
    try:
        plans = [(rep, seed + rep * restarts + i) for rep in range(bootstraps + 1) for i in range(restarts)]
        starts = parallel_seeds(blocks, len(features), len(weights), plans, k)
        runs = [LloydRun(rep, at) for (rep, _), at in zip(plans, starts)]
        lloyd_blocks(blocks, len(weights), runs, max_iter, tol)
    finally:
        blocks.unpersist()
    best = {}
    for r in runs:
        if r.replicate not in best or r.cost < best[r.replicate].cost:
            best[r.replicate] = r
    base = centers_frame(spark, best[0].centers, features)
    schema = "replicate int, cost double, " + ", ".join(f"{f} double" for f in features)
    others = spark.createDataFrame([(rep, float(best[rep].cost), *map(float, c)) for rep in range(1, bootstraps + 1)
                                    for c in best[rep].centers], schema)
    return center_shift(base, others, features, ["replicate", "cost"]).select(
        "replicate", "shift_sorted", "shift_nearest", "cost")


def stability_summary(shifts: DataFrame, shift: str = "shift_sorted", limit: float = 0.1) -> DataFrame:
    """Mean and population deviation of the shift and the verdict."""
    return (shifts.agg(F.count(F.lit(1)).alias("bootstraps"), F.avg(shift).alias("mean_shift"),
                       F.stddev_pop(shift).alias("std_shift"))
            .withColumn("stable", F.col("mean_shift") < F.lit(limit)))
