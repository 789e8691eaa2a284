"""How good a clustering is, from per-cluster summaries.

Every metric starts from one map-side aggregated table with a row per cluster.
The mean squared distance from a point x to a cluster with mean m and total
within-cluster variance v is ``|x - m|^2 + v``, so even the squared-distance
silhouette needs no pairs of points.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwell.functions.hashing import unit_hash
from tripwell.operators.bounded import bounded_rows, cached, in_parallel, pin_small

# Clusters become columns of the next plan, so their number is limited.
MAX_CLUSTERS = 1000


def cluster_table(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Per cluster: ``label, n, ss`` (squared deviations from its mean) and means ``m_<f>``."""
    spread = sum((F.var_pop(f) for f in features), F.lit(0.0))
    return (df.groupBy(F.col(label).alias("label"))
            .agg(F.count(F.lit(1)).alias("n"),
                 *[F.avg(f).alias(f"m_{f}") for f in features],
                 spread.alias("_v"))
            .withColumn("ss", F.col("_v") * F.col("n")).drop("_v"))


def cluster_size_share(df: DataFrame, label: str) -> DataFrame:
    """Size and share of every cluster that has rows."""
    sizes = df.groupBy(F.col(label).alias("cluster")).agg(F.count(F.lit(1)).alias("size"))
    total = sizes.agg(F.sum("size")).scalar()
    return sizes.select("cluster", "size", (F.col("size") / total).alias("share"))


def cluster_count_distinct(df: DataFrame, label: str) -> DataFrame:
    return (df.agg(F.count_distinct(label).alias("n_clusters"))
            .withColumn("can_evaluate", F.col("n_clusters") >= 2))


def cluster_profile(df: DataFrame, label: str, features: Sequence[str], fare: str) -> DataFrame:
    """Mean fare and centroid of each cluster, cheapest cluster first."""
    return (df.groupBy(F.col(label).alias("cluster"))
            .agg(F.count(F.lit(1)).alias("size"), F.avg(fare).alias("avg_fare"),
                 *[F.avg(f).alias(f"center_{f}") for f in features])
            .orderBy("avg_fare", "cluster"))


def wssse(table: DataFrame) -> DataFrame:
    """Sum of squared distances to the recomputed cluster means."""
    return table.agg(F.sum("ss").alias("wssse"))


def cluster_entropy(table: DataFrame) -> DataFrame:
    """-sum p ln p over cluster shares, written as ln N - sum n ln n / N."""
    total = F.sum("n")
    weighted = F.sum(F.col("n") * F.ln("n"))
    return table.agg((F.ln(total) - weighted / total).alias("entropy"))


def calinski_harabasz(table: DataFrame, features: Sequence[str]) -> DataFrame:
    """(between / (k - 1)) / (within / (n - k)); 1 when no cluster has any spread."""
    center = table.agg(F.struct(*[
        (F.sum(F.col("n") * F.col(f"m_{f}")) / F.sum("n")).alias(f) for f in features]).alias("c")).scalar()
    offset = sum(((F.col(f"m_{f}") - center[f]) ** 2 for f in features), F.lit(0.0))
    sums = table.agg(F.sum(F.col("n") * offset).alias("between"), F.sum("ss").alias("within"),
                     F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    ratio = ((F.col("between") / F.nullif(F.col("k") - 1, F.lit(0)))
             / F.nullif(F.col("within") / F.nullif(F.col("n") - F.col("k"), F.lit(0)), F.lit(0.0)))
    score = F.when(F.col("within") == 0, F.lit(1.0)).otherwise(ratio)
    return sums.select(score.alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, features: Sequence[str], label: str,
                   table: DataFrame | None = None) -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d_ij; coinciding centers count as 0."""
    table = pin_small(cluster_table(df, features, label)) if table is None else table
    own = sum(((F.col(f) - F.col(f"m_{f}")) ** 2 for f in features), F.lit(0.0))
    means = [f"m_{f}" for f in features]
    scatter = (df.select(*features, F.col(label).alias("_own"))
               .join(table.select("label", *means), F.col("_own") == F.col("label"))
               .groupBy("label", *means).agg(F.avg(F.sqrt(own)).alias("s")))
    cluster = F.struct("label", "s", *means)
    everyone = scatter.agg(F.collect_list(cluster).alias("all"))

    def ratio(a: Column, b: Column) -> Column:
        gap = F.sqrt(sum(((a[f"m_{f}"] - b[f"m_{f}"]) ** 2 for f in features), F.lit(0.0)))
        return F.coalesce((a["s"] + b["s"]) / F.nullif(gap, F.lit(0.0)), F.lit(0.0))

    return (everyone.select(F.explode("all").alias("me"), "all")
            .select(F.array_max(F.transform("all", lambda other: ratio(F.col("me"), other))).alias("worst"))
            .agg(F.avg("worst").alias("davies_bouldin")))


def with_silhouette_sq(df: DataFrame, features: Sequence[str], label: str, clusters: list) -> DataFrame:
    """Per row: ``_label``, squared distance to its own center ``_gap`` and ``_silhouette``.

    The silhouette uses squared Euclidean distance; a row alone in its cluster
    scores 0. The steps build on each other so that no distance is computed twice.
    """
    gaps = {f"_g{i}": sum(((F.col(f) - F.lit(c[f"m_{f}"])) ** 2 for f in features), F.lit(0.0))
            for i, c in enumerate(clusters)}
    own, inside, others = None, None, []
    for i, c in enumerate(clusters):
        hit = F.col("_label") == F.lit(c["label"])
        mean_sq = F.col(f"_g{i}") + F.lit(c["ss"] / c["n"])
        within = mean_sq * F.lit(c["n"] / (c["n"] - 1)) if c["n"] > 1 else F.lit(None).cast("double")
        own = F.when(hit, F.col(f"_g{i}")) if own is None else own.when(hit, F.col(f"_g{i}"))
        inside = F.when(hit, within) if inside is None else inside.when(hit, within)
        others.append(F.when(~hit, mean_sq))
    top = F.greatest("_inside", "_nearest")
    score = F.when(F.col("_inside").isNull() | (top == 0), F.lit(0.0)).otherwise(
        (F.col("_nearest") - F.col("_inside")) / F.nullif(top, F.lit(0.0)))
    return (df.select(F.col(label).alias("_label"), *[g.alias(n) for n, g in gaps.items()])
            .select("_label", own.alias("_gap"), inside.alias("_inside"), F.least(*others).alias("_nearest"))
            .select("_label", "_gap", score.alias("_silhouette")))


def silhouette_sq(df: DataFrame, features: Sequence[str], label: str,
                  table: DataFrame | None = None) -> DataFrame:
    """Mean silhouette with squared Euclidean distance over all rows."""
    clusters = bounded_rows(cluster_table(df, features, label) if table is None else table, "clusters", MAX_CLUSTERS)
    if len(clusters) < 2:
        raise ValueError("a silhouette needs at least two clusters")
    return (with_silhouette_sq(df, features, label, clusters)
            .agg(F.avg("_silhouette").alias("silhouette")))


def _distance_sums(mine: np.ndarray, everyone: np.ndarray, first: np.ndarray, count: np.ndarray,
                   rows: int = 64, columns: int = 2048) -> np.ndarray:
    """Sum of distances from each of my points to all points of each cluster.

    ``everyone`` is ordered by cluster. Works in tiles that stay in the cache.
    """
    sums = np.zeros((len(mine), len(first)))
    tile, gap = np.empty((rows, columns)), np.empty((rows, columns))
    for c, (start, size) in enumerate(zip(first, count)):
        for left in range(start, start + size, columns):
            theirs = everyone[left:min(left + columns, start + size)]
            for top in range(0, len(mine), rows):
                part = mine[top:top + rows]
                total, off = tile[:len(part), :len(theirs)], gap[:len(part), :len(theirs)]
                total[:] = 0.0
                for j in range(mine.shape[1]):
                    np.subtract(part[:, j, None], theirs[None, :, j], out=off)
                    np.multiply(off, off, out=off)
                    np.add(total, off, out=total)
                np.sqrt(total, out=total)
                sums[top:top + rows, c] += total.sum(axis=1)
    return sums


SILHOUETTE_POINTS = 50_000
LEAST_POINTS = 100  # of every cluster that has as many rows, while they fit
_TILE = 256


def _stratified(labelled: DataFrame, keys: Sequence[str], points: int, seed: int) -> tuple[DataFrame, dict]:
    """Rows to measure and the size of every cluster: all rows, or a share of each cluster first in hash order.

    Before rows are ranked, a hash threshold lets little more than the wanted number of a
    cluster through, so no task ranks a whole cluster.
    """
    sizes = {r["_label"]: r["n"] for r in bounded_rows(
        labelled.groupBy("_label").agg(F.count("*").alias("n")), "clusters", MAX_CLUSTERS)}
    if len(sizes) < 2:
        raise ValueError("a silhouette needs at least two clusters")
    total = sum(sizes.values())
    if total <= points:
        return labelled, sizes
    kind = labelled.schema["_label"].dataType.simpleString()
    least = min(LEAST_POINTS, points // len(sizes))
    wanted = {c: max(-(-points * n // total), min(n, least)) for c, n in sizes.items()}
    quota = labelled.sparkSession.createDataFrame(
        [(c, w, min(1.0, (w + 6 * w ** 0.5 + 20) / sizes[c])) for c, w in wanted.items()],
        f"_label {kind}, _wanted long, _below double")
    near = (labelled.withColumn("_draw", unit_hash(keys, seed)).join(F.broadcast(quota), "_label")
            .where(F.col("_draw") <= F.col("_below")))
    order = Window.partitionBy("_label").orderBy("_draw", *keys)
    return near.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= F.col("_wanted")), sizes


def silhouette_euclid(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
                      points: int = SILHOUETTE_POINTS, seed: int = 42) -> DataFrame:
    """Mean silhouette with Euclidean distance: (silhouette, points, standard_error).

    Up to ``points`` rows all are measured against all, and the error is zero. Of more
    rows a sample of about that size is measured against itself, drawn from each cluster
    in proportion to its size, but ``LEAST_POINTS`` at least; clusters then count by
    their sizes, and the standard error is that of the stratified mean.
    The sample is what the driver holds and every task gets, so its size bounds both;
    each task measures a tile of its points.
    """
    spark = df.sparkSession
    labelled = df.select(*keys, *features, F.col(label).alias("_label"))
    chosen, sizes = _stratified(labelled, keys, points, seed)
    rows = chosen.select("_label", *features).toPandas()
    names = sorted(sizes)
    number = rows["_label"].map({c: i for i, c in enumerate(names)}).to_numpy(dtype="int64")
    order = np.argsort(number, kind="stable")
    everyone, own = rows[list(features)].to_numpy(dtype="float64")[order], number[order]
    count = np.bincount(own, minlength=len(names))
    first = np.cumsum(count) - count
    shared = spark.sparkContext.broadcast((everyone, own))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, home = shared.value
        for batch in batches:
            for tile in batch["id"]:
                part = slice(int(tile) * _TILE, (int(tile) + 1) * _TILE)
                sums, mine = _distance_sums(x[part], x, first, count), home[part]
                place = np.arange(len(mine))
                inside = sums[place, mine] / np.maximum(count[mine] - 1, 1)
                others = np.where(count > 0, sums / np.maximum(count, 1), np.inf)
                others[place, mine] = np.inf
                nearest = others.min(axis=1)
                top = np.maximum(inside, nearest)
                score = np.where((count[mine] > 1) & (top > 0), (nearest - inside) / np.where(top > 0, top, 1), 0.0)
                yield pd.DataFrame({"cluster": mine, "score": score})

    tiles = -(-len(everyone) // _TILE)
    tasks = min(tiles, 4 * spark.sparkContext.defaultParallelism)
    scored = spark.range(0, tiles, 1, tasks).mapInPandas(measure, "cluster long, score double").groupBy("cluster").agg(
        F.avg("score").alias("mean"), F.coalesce(F.var_samp("score"), F.lit(0.0)).alias("var"), F.count("*").alias("m"))
    share = F.broadcast(spark.createDataFrame([(i, sizes[c]) for i, c in enumerate(names)], "cluster long, n long"))
    part = F.col("n") / F.lit(float(sum(sizes.values())))
    return scored.join(share, "cluster").agg(
        F.sum(part * F.col("mean")).alias("silhouette"), F.sum("m").alias("points"),
        F.sqrt(F.sum(part * part * F.col("var") / F.col("m") * (1 - F.col("m") / F.col("n")))).alias("standard_error"))


def quality_row(df: DataFrame, features: Sequence[str], label: str) -> dict:
    """Clusters, rows, squared silhouette and the other four metrics of a labelling.

    Two passes over the rows: one for the cluster table, one for everything that
    needs the centers. What remains is arithmetic on k rows.
    """
    clusters = sorted(bounded_rows(cluster_table(df, features, label), "clusters", MAX_CLUSTERS), key=lambda c: c["label"])
    if len(clusters) < 2:
        raise ValueError("cluster quality needs at least two clusters")
    second = {r["_label"]: r for r in with_silhouette_sq(df, features, label, clusters)
              .groupBy("_label").agg(F.avg(F.sqrt("_gap")).alias("scatter"),
                                     F.sum("_silhouette").alias("silhouette")).collect()}
    sizes = np.array([c["n"] for c in clusters], dtype="float64")
    means = np.array([[c[f"m_{f}"] for f in features] for c in clusters])
    scatter = np.array([second[c["label"]]["scatter"] for c in clusters])
    k, n, within = len(clusters), sizes.sum(), sum(c["ss"] for c in clusters)
    middle = (sizes[:, None] * means).sum(axis=0) / n
    between = (sizes * ((means - middle) ** 2).sum(axis=1)).sum()
    gaps = np.sqrt(((means[:, None, :] - means[None, :, :]) ** 2).sum(axis=2))
    gaps[gaps == 0] = np.inf  # a cluster and itself, and centers that coincide
    ratios = (scatter[:, None] + scatter[None, :]) / gaps
    return {"k": k, "rows": int(n), "wssse": float(within),
            "silhouette": sum(r["silhouette"] for r in second.values()) / float(n),
            "calinski_harabasz": float((between / (k - 1)) / (within / (n - k))) if within > 0 else 1.0,
            "davies_bouldin": float(ratios.max(axis=1).mean()),
            "entropy": float(-(sizes / n * np.log(sizes / n)).sum())}


def cluster_report(labelled: dict[str, DataFrame], features: Sequence[str], label: str,
                   keys: Sequence[str], points: int = SILHOUETTE_POINTS, seed: int = 42) -> DataFrame:
    """One row per model: clusters, rows, five quality metrics, and size and share of every cluster.

    All rows enter the metrics; the Euclidean silhouette and its standard error are those
    of :func:`silhouette_euclid`. Models are evaluated side by side.
    """
    def evaluate(position: int, name: str, df: DataFrame) -> tuple:
        rows = cached(df.select(*keys, *features, label))
        try:
            row = quality_row(rows, features, label)
            row["silhouette"], used, error = silhouette_euclid(rows, features, label, keys, points, seed).first()
            sizes = [(r["cluster"], r["size"], r["share"]) for r in cluster_size_share(rows, label).collect()]
        finally:
            rows.unpersist()
        return (position, name, row["k"], row["rows"], used, row["silhouette"], error, row["calinski_harabasz"],
                row["davies_bouldin"], row["wssse"], row["entropy"], sorted(sizes))

    rows = in_parallel([lambda i=i, n=n, d=d: evaluate(i, n, d)
                        for i, (n, d) in enumerate(labelled.items())])
    first = next(iter(labelled.values()))
    kind = first.schema[label].dataType.simpleString()
    return first.sparkSession.createDataFrame(
        rows, "position int, model string, k long, n_rows long, silhouette_points long, silhouette double, "
              "standard_error double, calinski_harabasz double, davies_bouldin double, wssse double, entropy double, "
              f"sizes array<struct<cluster:{kind},size:long,share:double>>")
