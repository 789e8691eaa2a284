"""Clustering invariants and quality metrics against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tripwell.operators import cluster_quality as quality
from tripwell.operators import clustering, ranking
from tripwell.operators.scaling import inverse_scale, standard_scale

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def blobs(spark):
    draw = np.random.default_rng(3)
    centers = [(0, 0), (10, 0), (0, 12), (14, 14)]
    rows = [(i * 100 + n, float(x + draw.normal()), float(y + draw.normal()), i)
            for i, (x, y) in enumerate(centers) for n in range(60)]
    rows.append((9999, 50.0, 50.0, 4))  # a cluster of one
    return spark.createDataFrame(rows, "id long, a double, b double, label int").persist()


def matrix(df):
    rows = df.select(*FEATURES, "label").collect()
    return np.array([[r["a"], r["b"]] for r in rows]), np.array([r["label"] for r in rows])


def brute_silhouette(x, labels, squared):
    gaps = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    gaps = gaps if squared else np.sqrt(gaps)
    scores = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        inside = gaps[i, own].sum() / (own.sum() - 1)
        nearest = min(gaps[i, labels == c].mean() for c in set(labels) if c != labels[i])
        scores.append((nearest - inside) / max(nearest, inside))
    return float(np.mean(scores))


def test_squared_silhouette(blobs):
    x, labels = matrix(blobs)
    got = quality.silhouette_sq(blobs, FEATURES, "label").first()[0]
    assert got == pytest.approx(brute_silhouette(x, labels, True), abs=1e-9)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="v").transform(
        blobs.withColumn("prediction", F.col("label").cast("double")))
    library = ClusteringEvaluator(featuresCol="v", metricName="silhouette").evaluate(vectors)
    assert got == pytest.approx(library, abs=1e-9)


def test_euclidean_silhouette(blobs):
    x, labels = matrix(blobs)
    row = quality.silhouette_euclid(blobs, FEATURES, "label", ["id"]).first()
    assert row["silhouette"] == pytest.approx(brute_silhouette(x, labels, False), abs=1e-9)
    assert row["points"] == len(x)


def test_euclidean_silhouette_of_a_stratified_sample(blobs):
    x, labels = matrix(blobs)
    clusters = len(set(labels))
    row = quality.silhouette_euclid(blobs, FEATURES, "label", ["id"], points=50).first()
    assert 50 <= row["points"] <= 50 + clusters and row["standard_error"] > 0
    assert quality.silhouette_euclid(blobs, FEATURES, "label", ["id"]).first()["standard_error"] == 0
    assert row["silhouette"] == pytest.approx(brute_silhouette(x, labels, False), abs=max(0.05, 5 * row["standard_error"]))


def test_every_cluster_has_points_in_a_silhouette(spark):
    rows = [(i, float(i % 7), float(i % 11), 0) for i in range(4000)] + [(5000 + i, 50.0 + i, 50.0, 1) for i in range(3)]
    df = spark.createDataFrame([*rows, (6000, 90.0, 0.0, 2)], "id long, a double, b double, label int")
    row = quality.silhouette_euclid(df, FEATURES, "label", ["id"], points=400).first()
    assert row["points"] == -(-400 * 4000 // 4004) + 3 + 1
    assert row["silhouette"] > 0.8


def test_silhouette_needs_two_clusters(blobs):
    one = blobs.filter("label = 0")
    with pytest.raises(ValueError):
        quality.silhouette_sq(one, FEATURES, "label")
    with pytest.raises(ValueError):
        quality.silhouette_euclid(one, FEATURES, "label", ["id"])


def test_other_metrics(blobs):
    x, labels = matrix(blobs)
    names = sorted(set(labels))
    means = np.array([x[labels == c].mean(axis=0) for c in names])
    within = sum(((x[labels == c] - m) ** 2).sum() for c, m in zip(names, means))
    between = sum((labels == c).sum() * ((m - x.mean(axis=0)) ** 2).sum() for c, m in zip(names, means))
    k, n = len(names), len(x)
    scatter = [np.sqrt(((x[labels == c] - m) ** 2).sum(axis=1)).mean() for c, m in zip(names, means)]
    worst = [max((scatter[i] + scatter[j]) / np.linalg.norm(means[i] - means[j])
                 for j in range(k) if j != i) for i in range(k)]
    shares = np.array([(labels == c).mean() for c in names])
    row = quality.quality_row(blobs, FEATURES, "label")
    assert row["k"] == k and row["rows"] == n
    assert row["wssse"] == pytest.approx(within)
    assert row["calinski_harabasz"] == pytest.approx((between / (k - 1)) / (within / (n - k)))
    assert row["davies_bouldin"] == pytest.approx(np.mean(worst))
    assert row["entropy"] == pytest.approx(-(shares * np.log(shares)).sum())


def test_quality_of_degenerate_clusters(spark):
    # Two clusters of copies on the same spot and one apart: no spread anywhere.
    rows = [(0.0, 0.0, 0), (0.0, 0.0, 0), (0.0, 0.0, 1), (0.0, 0.0, 1), (5.0, 5.0, 2), (5.0, 5.0, 2)]
    df = spark.createDataFrame(rows, "a double, b double, label int")
    row = quality.quality_row(df, FEATURES, "label")
    assert row["davies_bouldin"] == 0.0 and row["calinski_harabasz"] == 1.0
    assert quality.davies_bouldin(df, FEATURES, "label").first()[0] == 0.0
    assert quality.calinski_harabasz(quality.cluster_table(df, FEATURES, "label"), FEATURES).first()[0] == 1.0
    assert row["silhouette"] == pytest.approx(np.mean([0, 0, 0, 0, 1, 1]))
    assert quality.silhouette_sq(df, FEATURES, "label").first()[0] == pytest.approx(row["silhouette"])


def test_nearest_center_takes_the_lowest_index_on_a_tie(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)], "a double, b double")
    rows = clustering.assign_nearest(df, FEATURES, [(0, 0), (2, 0)], distance="d").collect()
    assert [r["cluster"] for r in rows] == [0, 0, 1] and [r["d"] for r in rows] == [0.0, 1.0, 0.0]


def test_lloyd_ends_at_a_fixed_point(blobs):
    run = clustering.lloyd_kmeans(blobs, FEATURES, ["id"], k=4)
    x, _ = matrix(blobs)
    gaps = ((x[:, None, :] - run.centers[None, :, :]) ** 2).sum(axis=2)
    nearest = gaps.argmin(axis=1)
    for c in range(4):
        if (nearest == c).any():
            assert np.allclose(run.centers[c], x[nearest == c].mean(axis=0), atol=1e-3)
    assert run.cost == pytest.approx(gaps.min(axis=1).sum(), rel=1e-3)


def test_empty_cluster_keeps_its_center():
    run = clustering.LloydRun(0, np.array([[0.0, 0.0], [9.0, 9.0]]))
    run.move(np.array([2.0, 0.0]), np.array([[2.0, 4.0], [0.0, 0.0]]), 1.0, 1e-4)
    assert run.centers.tolist() == [[1.0, 2.0], [9.0, 9.0]] and not run.done


def test_many_runs_equal_single_runs(blobs):
    x, _ = matrix(blobs)
    start = x[:3].copy()
    weighted = clustering.replicate_weights(blobs.select(*FEATURES, "id"), ["id"], 2, 42)
    runs = clustering.lloyd_many(weighted, FEATURES, ["_w0", "_w1", "_w2"],
                                 [clustering.LloydRun(r, start.copy()) for r in (0, 1, 2)], max_iter=4, tol=0.0)
    rows = weighted.collect()
    for run in runs:
        points = np.array([[r["a"], r["b"]] for r in rows])
        w = np.array([r[f"_w{run.replicate}"] for r in rows], dtype=float)
        centers = start.copy()
        for _ in range(4):
            nearest = ((points[:, None, :] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
            centers = np.array([np.average(points[nearest == c], axis=0, weights=w[nearest == c])
                                if w[nearest == c].sum() else centers[c] for c in range(3)])
        assert np.allclose(run.centers, centers)


def test_seeds_are_points_and_do_not_depend_on_partitions(blobs, monkeypatch):
    x, _ = matrix(blobs)
    weighted = clustering.replicate_weights(blobs.select(*FEATURES, "id"), ["id"], 1, 42)
    names, plans = ["_w0", "_w1"], [(0, 1), (0, 2), (1, 3)]

    def seeds(parts):
        blocks = clustering.point_blocks(weighted.repartition(parts), FEATURES, names)
        return np.array(clustering.parallel_seeds(blocks, 2, 2, plans, 4))

    found = seeds(1)
    assert found.shape == (3, 4, 2)
    known = {tuple(p) for p in x}
    assert all(tuple(c) in known for run in found for c in run)
    assert np.array_equal(found, seeds(7))
    monkeypatch.setattr(clustering, "DIRECT_CELLS", 0)
    assert np.array_equal(found, seeds(3))


def test_seeds_reach_far_groups_and_skip_points_without_weight(spark):
    rows = [(i, float(i % 50) / 100, 0.0, 1.0) for i in range(3000)]
    rows += [(3000, 900.0, 0.0, 1.0), (3001, 0.0, 900.0, 1.0), (3002, -9000.0, 0.0, 0.0)]
    points = spark.createDataFrame(rows, "id int, a double, b double, w double")
    blocks = clustering.point_blocks(points, FEATURES, ["w"])
    for at in clustering.parallel_seeds(blocks, 2, 1, [(0, s) for s in range(5)], 3):
        assert {(900.0, 0.0), (0.0, 900.0)} <= {tuple(c) for c in at.tolist()}
        assert at.min() >= 0
    few = clustering.point_blocks(points.where("id in (3000, 3001)"), FEATURES, ["w"])
    assert clustering.parallel_seeds(few, 2, 1, [(0, 1)], 2)[0].shape == (2, 2)
    with pytest.raises(ValueError):
        clustering.parallel_seeds(clustering.point_blocks(points.where("id < 0"), FEATURES, ["w"]), 2, 1, [(0, 1)], 2)


def test_stability_of_separated_blobs(blobs):
    scaled = standard_scale(blobs.filter("label < 4"), FEATURES, population=True)
    shifts = clustering.cluster_stability(scaled.select("id", "a_scaled", "b_scaled"), ["a_scaled", "b_scaled"],
                                          ["id"], k=4, bootstraps=3, restarts=3)
    summary = clustering.stability_summary(shifts).first()
    assert summary["bootstraps"] == 3 and summary["stable"] and 0 < summary["mean_shift"] < 0.1


def test_center_shift_forms(spark):
    base = spark.createDataFrame([(0.0, 5.0), (4.0, 1.0)], "a double, b double")
    other = spark.createDataFrame([(4.0, 5.0), (0.0, 1.0)], "a double, b double")
    row = clustering.center_shift(base, other, FEATURES).first()
    assert row["shift_sorted"] == 0.0 and row["shift_nearest"] == 4.0


def test_library_models(blobs):
    vectors = clustering.scaled_vectors(blobs, FEATURES)
    trials = clustering.kmeans_search(vectors, (3, 4))
    assert [t.k for t in trials] == [3, 4] and all(-1 <= t.silhouette <= 1 for t in trials)
    assert clustering.best_trial(trials).silhouette == max(t.silhouette for t in trials)
    restarts = clustering.kmeans_restarts(vectors, 4, 3)
    assert len(restarts) == 3 and all(t.cost > 0 for t in restarts)
    mixture = clustering.fit_gaussian_mixture(vectors, k=3)
    assert sum(mixture.weights) == pytest.approx(1.0)
    bisecting = clustering.fit_bisecting(clustering.scaled_vectors(blobs, FEATURES, centered=False), k=4)
    assert len(bisecting.clusterCenters()) == 4
    model = trials[0].model
    centers = np.array(model.clusterCenters())
    for r in model.transform(vectors).select("features", "prediction").collect():
        gaps = ((centers - r["features"].toArray()) ** 2).sum(axis=1)
        assert gaps[r["prediction"]] == pytest.approx(gaps.min())


def test_packed_means_give_the_clusters_of_the_library(blobs, monkeypatch):
    from tripwell.operators import packed_means

    vectors = clustering.scaled_vectors(blobs, FEATURES).select("features").persist()
    plain = clustering.scaled_vectors(blobs, FEATURES, centered=False).select("features").persist()

    def made():
        bisecting = clustering.fit_bisecting(plain, k=5)
        sizes = {r["prediction"]: r["count"] for r in bisecting.transform(plain).groupBy("prediction").count().collect()}
        return clustering.kmeans_search(vectors, (3, 4)), clustering.kmeans_restarts(vectors, 3, 4), bisecting, sizes

    wanted, calls = made(), []
    monkeypatch.setattr(packed_means, "FEW_ROWS", 10)
    monkeypatch.setattr(packed_means, "SLICE", 7)
    real = packed_means._summed
    monkeypatch.setattr(packed_means, "_summed", lambda parts: calls.append(1) or real(parts))
    found = made()
    assert calls  # large tables are packed
    assert np.array(found[2].clusterCenters()) == pytest.approx(np.array(wanted[2].clusterCenters()), rel=1e-9)
    assert found[3] == wanted[3]
    best = [min(t.cost for t in trials[1]) for trials in (found, wanted)]
    assert len(found[1]) == 4 and best[0] == pytest.approx(best[1], rel=1e-6)
    for trial in found[0]:
        assert trial.silhouette == pytest.approx(clustering.silhouette_of(trial.model, vectors), rel=1e-9)
        assert len(trial.model.clusterCenters()) == trial.k
    points = packed_means.packed_vectors(vectors)
    again = packed_means.lloyd_together(points, [np.array(t.model.clusterCenters()) for t in wanted[0]], 50)
    for run, trial in zip(again, wanted[0]):  # where the library stopped, centers hardly move
        assert run.centers == pytest.approx(np.array(trial.model.clusterCenters()), abs=1e-3)
    empty = np.vstack([wanted[0][0].model.clusterCenters(), [[1e6] * len(FEATURES)]])
    assert (packed_means.lloyd_together(points, [empty], 3)[0].centers[-1] == 1e6).all()
    points.unpersist()


def test_packed_means_of_few_distinct_points(spark, monkeypatch):
    from tripwell.operators import packed_means

    monkeypatch.setattr(packed_means, "FEW_ROWS", 10)
    rows = spark.range(60).select((F.col("id") % 2 * 1.0).alias("a"), (F.col("id") % 2 * 3.0 + 1000).alias("b"))
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    trials = clustering.kmeans_restarts(vectors, 4, 2)  # like the library, no more centers than points
    assert [len(t.model.clusterCenters()) for t in trials] == [2, 2] and all(t.cost == pytest.approx(0, abs=1e-9) for t in trials)
    bisecting = clustering.fit_bisecting(vectors, k=5)
    found = sorted((c.tolist() for c in bisecting.clusterCenters()), key=lambda c: c[1])
    assert np.array(found) == pytest.approx(np.array([[0.0, 1000.0], [1.0, 1003.0]]), abs=1e-9)


def test_silhouette_of_a_model_is_that_of_the_library(blobs, monkeypatch):
    vectors = clustering.scaled_vectors(blobs, FEATURES)
    model = clustering.kmeans_search(vectors, (3,))[0].model
    made = []
    real = clustering.ClusteringEvaluator
    monkeypatch.setattr(clustering, "ClusteringEvaluator", lambda **k: made.append(1) or real(**k))
    found = clustering.silhouette_of(model, vectors)
    assert not made
    monkeypatch.setattr(clustering, "NARROW_CELLS", 5)
    assert found == pytest.approx(clustering.silhouette_of(model, vectors), rel=1e-12) and made == [1]


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (3.0, None)], "a double, b double")
    for population in (False, True):
        rows = standard_scale(df, FEATURES, population).collect()
        assert [r["b_scaled"] for r in rows] == [0.0, 0.0, None]
    scaled = standard_scale(df, ["a"], True).select("a_scaled")
    back = inverse_scale(scaled, df, ["a"])
    assert sorted(round(r["a"], 9) for r in back.collect()) == [1.0, 2.0, 3.0]


def test_selection_ties(spark):
    models = spark.createDataFrame([("x", 0, 2.0), ("y", 1, 1.0), ("z", 2, 1.0), ("n", 3, float("nan"))],
                                   "model string, position int, rmse double")
    assert ranking.best_model_select(models).first()["model"] == "y"
    ks = spark.createDataFrame([(5, 0.9), (4, 0.9), (3, 0.1)], "k int, silhouette double")
    assert ranking.best_k_select(ks).first()["k"] == 4
    names = ranking.persona_rank(spark.createDataFrame(
        [(i, float(10 - i)) for i in range(5)], "cluster int, avg_fare double")).collect()
    assert [r["cluster"] for r in names] == [4, 3, 2, 1, 0] and names[4]["persona"] is None
    best = {r["metric"]: r["model"] for r in ranking.best_per_metric(spark.createDataFrame(
        [("x", 0, 1.0, 2.0), ("y", 1, 1.0, 1.0)], "model string, position int, up double, down double"),
        {"up": True, "down": False}).collect()}
    assert best == {"up": "x", "down": "y"}
    assert math.isclose(ranking.speedup_ratio(spark.createDataFrame(
        [("cpu", 4.0), ("gpu", 1.0)], "environment string, seconds double"), "gpu")
        .filter("environment = 'cpu'").first()["ratio"], 4.0)
