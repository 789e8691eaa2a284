"""Regression, tuning, scoring and explanation on planted data."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tripwell.operators import explain, ranking, regression, stochastic, tree_shapley
from tripwell.operators.aggregates import histogram
from tripwell.operators.regression_quality import regression_metrics
from tripwell.operators.sampling import kfold_assign
from tripwell.plans.training import train_fare_model
from tripwell.sources import sinks

FEATURES = ["trip_distance", "trip_duration_min", "passenger_count"]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(3000).select(
        "id", (F.col("id") % 37).cast("double").alias("trip_distance"),
        (F.col("id") * 7 % 53).cast("double").alias("trip_duration_min"),
        (F.col("id") * 3 % 5).cast("double").alias("passenger_count"))
    return df.withColumn("fare_amount", 3 + 2.5 * F.col("trip_distance") + 0.5 * F.col("trip_duration_min")).persist()


@pytest.fixture(scope="module")
def forest(rows):
    return regression.fit_pipeline(rows, FEATURES, regression.random_forest(trees=5, depth=5))


def test_planted_coefficients_are_recovered(rows):
    model = regression.fit_pipeline(rows, FEATURES, regression.ordinary_least_squares())
    found = regression.coefficients(model, FEATURES)
    assert found["intercept"] == pytest.approx(3, abs=1e-6)
    assert found["trip_distance"] == pytest.approx(2.5, abs=1e-6)
    assert found["trip_duration_min"] == pytest.approx(0.5, abs=1e-6)
    assert found["passenger_count"] == pytest.approx(0, abs=1e-6)


def test_metrics_equal_the_library(rows):
    df = rows.withColumn("prediction", F.col("fare_amount") + (F.col("id") % 4) - 1.0)
    got = regression_metrics(df, "fare_amount", "prediction").first()
    for m in ("rmse", "r2", "mae"):
        library = RegressionEvaluator(labelCol="fare_amount", metricName=m).evaluate(df)
        assert got[m] == pytest.approx(library, rel=1e-9)


def test_constant_label_has_no_r2(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 0.0)], "y double, p double")
    row = regression_metrics(df, "y", "p", metrics=["r2", "explained_variance", "mape"]).first()
    assert row["r2"] is None and row["explained_variance"] is None and row["mape"] == pytest.approx(2 / 3)


def test_grid_search_equals_the_cross_validator(rows):
    some = rows.limit(600)
    points = regression.cv_grid_search(some, FEATURES, ["id"], depths=(2, 3), iterations=(2, 4), folds=3)
    booster = regression.gradient_boosted_trees()
    grid = ParamGridBuilder().addGrid(booster.maxDepth, [2, 3]).addGrid(booster.maxIter, [2, 4]).build()
    library = CrossValidator(
        estimator=Pipeline(stages=[*regression.preparation(FEATURES), booster]), estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol="fare_amount"), numFolds=3, foldCol="fold").fit(
        kfold_assign(some, ["id"], 3).select(*FEATURES, "fare_amount", "fold"))
    want = {(dict((p.name, v) for p, v in m.items())["maxDepth"], dict((p.name, v) for p, v in m.items())["maxIter"]): s
            for m, s in zip(library.getEstimatorParamMaps(), library.avgMetrics)}
    for p in points:
        assert p.rmse == pytest.approx(want[p.depth, p.iterations], rel=1e-6)
    best = regression.best_grid_point(points)
    assert best.rmse == min(p.rmse for p in points)
    assert regression.tuned_booster(best).getMaxDepth() == best.depth


def test_bakeoff_stores_the_winner(spark, rows, tmp_path):
    path = str(tmp_path / "best")
    result = train_fare_model(rows, ["id"], model_path=path)
    assert [e.model for e in result.entries] == ["LinearRegression", "RandomForest", "GBT"]
    assert result.winner.rmse == min(e.rmse for e in result.entries)
    loaded = sinks.load_model(spark, path)
    again = regression.model_metrics(loaded, rows)
    assert again == pytest.approx(regression.model_metrics(result.winner.fitted, rows))


def test_rows_with_missing_features_are_skipped(spark, rows):
    df = rows.select(*FEATURES, "fare_amount").limit(50).unionByName(spark.createDataFrame(
        [(None, 1.0, 1.0, 5.0)], "trip_distance double, trip_duration_min double, passenger_count double, fare_amount double"))
    model = regression.fit_pipeline(df, FEATURES, regression.elastic_net())
    assert regression.score_batch(model, df).count() == 50


def test_fold_metrics(rows):
    found = regression.cross_validate_metrics(rows.limit(800), FEATURES, ["id"],
                                              regression.ordinary_least_squares(), folds=4)
    assert [f["fold"] for f in found] == [0, 1, 2, 3] and all(f["rmse"] < 1e-6 for f in found)


def test_forest_keeps_node_ids_and_grows_the_same_trees(rows):
    made = regression.random_forest(trees=4, depth=6)
    assert made.getCacheNodeIds() and made.getCheckpointInterval() == -1
    plain = regression.random_forest(trees=4, depth=6, cacheNodeIds=False, checkpointInterval=10)
    found, wanted = (regression.fit_pipeline(rows, FEATURES, e).stages[-1].toDebugString for e in (made, plain))
    assert found.splitlines()[1:] == wanted.splitlines()[1:]


def test_packed_booster_grows_the_trees_of_the_library(spark, rows, monkeypatch, tmp_path):
    from tripwell.operators import boosting

    df = rows.select(*FEATURES, (F.col("id") % 2).cast("double").alias("flag"), F.lit(4.0).alias("same"), (
        F.col("fare_amount") + F.col("passenger_count") ** 2 * (F.col("id") % 2) + F.hash("id") % 100 / 30).alias("fare_amount"))
    names, made = [*FEATURES, "flag", "same"], regression.gradient_boosted_trees(maxDepth=5, maxIter=4)
    plain = regression.fit_pipeline(df, names, made)
    calls, real = [], boosting.boosted_trees
    monkeypatch.setattr(boosting, "boosted_trees", lambda *a: calls.append(a[2:]) or real(*a))
    monkeypatch.setattr(boosting, "FEW_ROWS", 1000)
    packed = regression.fit_pipeline(df, names, made)
    assert calls == [(5, 4, 0.1)]
    a, b = plain.stages[-1], packed.stages[-1]
    assert (a.getNumTrees, a.treeWeights) == (b.getNumTrees, b.treeWeights)
    assert b.featureImportances.toArray() == pytest.approx(a.featureImportances.toArray(), rel=1e-9)
    ready = PipelineModel(plain.stages[:-1]).transform(df)
    assert b.evaluateEachIteration(ready, "squared") == pytest.approx(a.evaluateEachIteration(ready, "squared"), rel=1e-9)
    again = sinks.load_model(spark, sinks.save_model(packed, str(tmp_path / "packed")))
    assert regression.model_metrics(again, df, metrics=["rmse"]) == pytest.approx(regression.model_metrics(plain, df, metrics=["rmse"]))
    flat = regression.fit_pipeline(df.select("same", F.lit(2.0).alias("fare_amount"), *FEATURES[:0]), ["same"], made)
    assert regression.model_metrics(flat, df.withColumn("fare_amount", F.lit(2.0)), metrics=["mae"])["mae"] == 0
    assert len(calls) == 2
    monkeypatch.setattr(boosting, "FEW_ROWS", 0)
    weighted = regression.gradient_boosted_trees(maxDepth=2, maxIter=1, subsamplingRate=0.5)
    regression.fit_pipeline(df.limit(50), names, weighted)
    assert len(calls) == 2  # what the packed form does not know is left to the library


def test_packed_forest_grows_the_trees_of_the_library(spark, rows, monkeypatch, tmp_path):
    from tripwell.operators import boosting, forests

    df = rows.withColumn("fare_amount", F.col("fare_amount") + F.hash("id") % 100 / 30)
    calls, real = [], forests.forest_trees
    monkeypatch.setattr(forests, "forest_trees", lambda *a: calls.append(a[2:]) or real(*a))

    def both(forest, few=100):
        made = []
        for limit in (10 ** 9, few):
            monkeypatch.setattr(boosting, "FEW_ROWS", limit)
            made.append(regression.fit_pipeline(df, FEATURES, forest))
        return made

    def error(model):
        return regression.model_metrics(model, df, metrics=["rmse"])["rmse"]

    plain, packed = both(regression.random_forest(trees=1, depth=6, bootstrap=False, minInstancesPerNode=15))
    assert calls == [(1, 6, 15, len(FEATURES), False, 42)]
    a, b = plain.stages[-1], packed.stages[-1]
    assert a.totalNumNodes == b.totalNumNodes
    assert b.featureImportances.toArray() == pytest.approx(a.featureImportances.toArray(), rel=1e-9)
    assert error(packed) == pytest.approx(error(plain), rel=1e-12)
    monkeypatch.setattr(forests, "TABLE_BYTES", 1)  # a job per tree and level
    monkeypatch.setattr(forests, "CHUNK_NODES", 3)
    one = regression.fit_pipeline(df, FEATURES, regression.random_forest(trees=3, depth=4))
    monkeypatch.undo()
    monkeypatch.setattr(boosting, "FEW_ROWS", 100)
    again = regression.fit_pipeline(df, FEATURES, regression.random_forest(trees=3, depth=4))
    assert one.stages[-1].toDebugString.split("\n")[1:] == again.stages[-1].toDebugString.split("\n")[1:]
    errors = [[error(m) for m in both(regression.random_forest(trees=20, depth=5, seed=s))] for s in (1, 2, 3)]
    assert np.mean(errors, axis=0)[1] == pytest.approx(np.mean(errors, axis=0)[0], rel=0.1)
    path = sinks.save_model(again, str(tmp_path / "packed"))
    stored = tree_shapley.ensemble_nodes(spark, path).collect()
    for t in range(3):  # every tree counts about as many rows as there are, some repeatedly
        nodes = {r.id: r for r in stored if r.tree == t}
        assert 0 < abs(nodes[0].cover - df.count()) < 0.1 * df.count()
        for r in nodes.values():
            assert r.left < 0 or r.cover == nodes[r.left].cover + nodes[r.right].cover
    values = tree_shapley.tree_shapley_values(sinks.load_model(spark, path), path, df, FEATURES, ["id"])
    sums = values.select("id", sum((F.col(f) for f in FEATURES), F.col("expected")).alias("s"))
    gaps = sums.join(again.transform(df), "id").agg(F.max(F.abs(F.col("s") - F.col("prediction")))).first()[0]
    assert gaps < 1e-9
    before = len(calls)
    both(regression.random_forest(trees=2, depth=2, subsamplingRate=0.5))
    assert len(calls) == before  # what the packed form does not know is left to the library


def test_poisson_draws_have_the_shares_of_the_distribution():
    from tripwell.operators.forests import open_features, poisson_draws

    drawn = poisson_draws([42, 0, 7], 1_000_000)
    shares = np.bincount(drawn, minlength=6)[:6] / len(drawn)
    assert shares == pytest.approx([math.exp(-1) / math.factorial(k) for k in range(6)], abs=2e-3)
    assert drawn.max() >= 7 and (drawn == poisson_draws([42, 0, 7], 1_000_000)).all()
    chosen = open_features(42, 1, 3, 5000, 7, 3)
    assert (chosen.sum(axis=1) == 3).all() and chosen.mean(axis=0) == pytest.approx(3 / 7, abs=0.03)


def test_folds_of_a_packed_grid_share_their_jobs(rows, monkeypatch):
    from tripwell.operators import boosting

    df = rows.select("id", *FEATURES, (F.col("fare_amount") + F.col("passenger_count") ** 2 + F.hash("id") % 100 / 30).alias("fare_amount"))

    def search() -> list:
        return regression.cv_grid_search(df, FEATURES, ["id"], depths=(2, 4), iterations=(1, 3))

    plain, jobs, real = search(), [], boosting._summed
    monkeypatch.setattr(boosting, "_summed", lambda parts: jobs.append(1) or real(parts))
    monkeypatch.setattr(boosting, "FEW_ROWS", 1000)
    packed = search()
    assert 0 < len(jobs) <= 3 * (2 + 4) + 2  # a job per level and round, and one for the last leaves, whatever the folds
    assert [(p.depth, p.iterations) for p in packed] == [(p.depth, p.iterations) for p in plain]
    for a, b in zip(packed, plain):
        assert (a.rmse, a.deviation) == pytest.approx((b.rmse, b.deviation), rel=1e-9)


def test_bin_borders_follow_the_library():
    from tripwell.operators.boosting import Layout, bin_borders

    assert bin_borders(np.array([3.0, 1.0, 1.0, 2.0]), 31).tolist() == [1.5, 2.5]
    assert bin_borders(np.array([5.0, 5.0]), 31).tolist() == []
    assert bin_borders(np.arange(64.0), 3).tolist() == [15.5, 31.5, 47.5]
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(size=400), rng.integers(0, 2, 400), rng.integers(0, 7, 400), rng.normal(size=400)])
    layout = Layout([bin_borders(v, 31) for v in x.T])
    codes = layout.codes(x)
    for j, borders in enumerate(layout.borders):
        bins = codes[:, layout.byte[j]] // layout.factor[j] % layout.bins[j]
        assert (bins == np.searchsorted(borders, x[:, j])).all()


def test_large_fits_run_one_at_a_time(rows, monkeypatch):
    from tripwell.operators import bounded

    assert [bounded.side_by_side(n, 3) for n in (0, 3000, 2_000_000, 30_000_000)] == [3, 3, 2, 1]
    widths, real = [], regression.in_parallel
    monkeypatch.setattr(regression, "in_parallel", lambda tasks, width=4: widths.append(width) or real(tasks, width))
    wanted = regression.cross_validate_metrics(rows, FEATURES, ["id"], regression.ordinary_least_squares(), folds=3)
    monkeypatch.setattr(bounded, "ROWS_AT_ONCE", 3000)
    found = regression.cross_validate_metrics(rows, FEATURES, ["id"], regression.ordinary_least_squares(), folds=3)
    assert widths == [3, 1] and found == wanted


def test_random_search(rows):
    some = rows.limit(400)
    trials = regression.param_random_search(some, some, FEATURES, trials=2, trees=(2, 4), depth=(2, 4))
    assert len(trials) == 2 and all(2 <= t.trees <= 4 and t.rmse > 0 for t in trials)


def test_what_if_replaces_the_scenario_columns(rows, forest):
    profiles = rows.groupBy("passenger_count").agg(*[F.avg(f).alias(f"{f}_") for f in FEATURES]).select(
        *[F.col(f"{f}_").alias(f) for f in FEATURES])
    out = regression.predict_what_if(forest, profiles).collect()
    assert len(out) == 5
    assert {(r["trip_distance"], r["trip_duration_min"], r["passenger_count"]) for r in out} == {(20.0, 10.0, 2.0)}
    assert len({r["prediction"] for r in out}) == 1


def test_shapley_values_add_up(rows, forest):
    picked = rows.filter("id in (5, 36, 700)")
    parts = explain.shapley_values(forest, picked, rows, FEATURES, ["id"], permutations=4)
    sums = {r["id"]: r["s"] for r in parts.groupBy("id").agg(F.sum("contribution").alias("s")).collect()}
    base = forest.transform(rows.agg(*[F.avg(f).alias(f) for f in FEATURES])).first()["prediction"]
    for r in forest.transform(picked).collect():
        assert sums[r["id"]] == pytest.approx(r["prediction"] - base, abs=1e-9)
    assert parts.count() == 9


def test_shapley_values_of_a_linear_model_are_exact(rows):
    model = regression.fit_pipeline(rows, FEATURES, regression.ordinary_least_squares())
    slopes = regression.coefficients(model, FEATURES)
    slopes.pop("intercept")
    picked = rows.filter("id < 4")
    sampled = {(r["id"], r["feature_name"]): r["contribution"] for r in explain.shapley_values(
        model, picked, rows, FEATURES, ["id"], permutations=2).collect()}
    for r in explain.shapley_linear(picked, rows, slopes, ["id"]).collect():
        assert sampled[r["id"], r["feature_name"]] == pytest.approx(r["contribution"], abs=1e-6)


def bin_of(value, edges):
    return int(np.searchsorted(edges, value, side="left"))


def test_local_surrogate_equals_a_plain_twin(rows, forest):
    row = ranking.argmax_row(rows, "fare_amount", ["id"])
    bins = explain.quartile_bins(rows, FEATURES)
    table = rows.select(*FEATURES).toPandas()
    here = {f: float(x) for f, x in row.select(*FEATURES).first().asDict().items()}
    draws = explain.perturbations(row, bins, ["id"], 1500, 42)
    got = draws.orderBy("_sample").toPandas()
    for f in FEATURES:
        edges = sorted(set(np.quantile(table[f], [0.25, 0.5, 0.75])))
        held = np.searchsorted(edges, table[f], side="left")
        assert bins[f].edges == pytest.approx(edges)
        assert bins[f].shares == pytest.approx([(held == b).mean() for b in range(len(edges) + 1)])
        drawn = np.searchsorted(edges, got[f], side="left")
        assert np.bincount(drawn[1:], minlength=len(edges) + 1) / 1499 == pytest.approx(bins[f].shares, abs=0.05)
        assert (got[f"z_{f}"] == (drawn == bin_of(here[f], edges))).all() and got[f][0] == here[f]
    z, w = got[[f"z_{f}" for f in FEATURES]].to_numpy(), got["_weight"].to_numpy()
    assert w == pytest.approx(np.sqrt(np.exp(-((1 - z) ** 2).sum(axis=1) / (0.75 * np.sqrt(3)) ** 2)))
    y = forest.transform(draws).orderBy("_sample").toPandas()["prediction"].to_numpy()
    for top in (3, 10, 2):
        def fit(chosen, penalty):  # weighted ridge with an intercept, as stacked least squares
            a = np.column_stack([np.ones(len(y)), z[:, chosen]]) * np.sqrt(w)[:, None]
            extra = np.sqrt(penalty) * np.eye(len(chosen) + 1)[1:]
            return np.linalg.lstsq(np.vstack([a, extra]), np.concatenate([y * np.sqrt(w), np.zeros(len(chosen))]), rcond=None)[0]
        chosen = []
        while top <= 6 and len(chosen) < top:
            def miss(j):
                b = fit([*chosen, j], 0.0)
                return (w * (y - b[0] - z[:, [*chosen, j]] @ b[1:]) ** 2).sum()
            chosen.append(min((j for j in range(3) if j not in chosen), key=miss))
        chosen = chosen or [0, 1, 2]
        want = dict(zip((FEATURES[j] for j in chosen), fit(chosen, 1.0)[1:]))
        found = explain.local_surrogate(forest, row, rows, FEATURES, ["id"], samples=1500, top=top)
        assert {f: x for f, _, x in found} == pytest.approx(want, rel=1e-6, abs=1e-8)
        assert found[0][0] == "trip_distance" and found[0][1].startswith("trip_distance > ")
        assert [abs(x) for _, _, x in found] == sorted((abs(x) for _, _, x in found), reverse=True)


def test_quartile_bins_of_awkward_features(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (1.0, 5.0, 2.0), (1.0, 5.0, float("nan")), (9.0, 5.0, 4.0)], "a double, b double, c double")
    bins = explain.quartile_bins(df, ["a", "b", "c"])
    assert bins["a"].edges == [1.0, 3.0] and bins["a"].shares == [0.75, 0.0, 0.25]
    assert bins["b"].edges == [5.0] and bins["b"].shares == [1.0, 0.0]
    assert sum(bins["c"].shares) == 1.0 and bins["c"].named("c", 0) == "c <= 2.50"
    row = df.limit(1).select(F.lit(1).alias("id"), "a", "b", F.lit(2.0).alias("c"))
    drawn = explain.perturbations(row, bins, ["id"], 200, 1).toPandas()
    assert set(drawn["a"]) == {1.0, 9.0} and set(drawn["b"]) == {5.0} and set(drawn["c"]) == {2.0, 4.0}
    with pytest.raises(ValueError):
        explain.quartile_bins(df.filter("c is null"), ["c"])


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.99,), (10.0,)], "x double")
    got = {r["bin"]: r["frequency"] for r in histogram(df, F.col("x"), 10).collect()}
    assert got == {0: 1, 1: 1, 9: 2, **{i: 0 for i in range(2, 9)}}
    flat = histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), F.col("x"), 4).collect()
    assert sum(r["frequency"] for r in flat) == 2


# ---- exact Shapley values of trees

def known_value(nodes, x, known, at=0):
    """What a tree predicts for ``x`` when only the features in ``known`` are known."""
    prediction, cover, left, right, feature, threshold = nodes[at]
    if left < 0:
        return prediction
    if feature in known:
        return known_value(nodes, x, known, left if x[feature] <= threshold else right)
    return sum(nodes[c][1] / cover * known_value(nodes, x, known, c) for c in (left, right))


def brute_shapley(nodes, x, count):
    found = np.zeros(count)
    for i in range(count):
        rest = [j for j in range(count) if j != i]
        for size in range(count):
            weight = math.factorial(size) * math.factorial(count - size - 1) / math.factorial(count)
            for s in itertools.combinations(rest, size):
                found[i] += weight * (known_value(nodes, x, {*s, i}) - known_value(nodes, x, set(s)))
    return found


def test_tree_values_equal_all_subsets():
    rng = np.random.default_rng(4)
    for count, depth in ((1, 2), (3, 4), (5, 6)):
        nodes = {}

        def grow(cover, level):
            at = len(nodes)
            nodes[at] = None
            if level == depth or cover < 2 or rng.random() < 0.1:
                nodes[at] = (float(rng.normal()), cover, -1, -1, -1, 0.0)
            else:
                part = int(rng.integers(1, cover))
                feature, threshold = int(rng.integers(count)), float(rng.normal())
                nodes[at] = (0.0, cover, grow(part, level + 1), grow(cover - part, level + 1), feature, threshold)
            return at

        grow(1000, 0)
        x = rng.normal(size=(40, count))
        x[0] = [n[5] for n in nodes.values()][0]  # on a threshold
        got = tree_shapley.leaf_contributions(tree_shapley.tree_leaves(nodes), x)
        assert np.allclose(got, [brute_shapley(nodes, row, count) for row in x], atol=1e-12)


def test_patterns_of_a_leaf_are_worked_out_once_for_all_batches(monkeypatch):
    nodes = {0: (0.0, 10, 1, 2, 0, 0.5), 1: (1.0, 4, -1, -1, -1, 0.0), 2: (0.0, 6, 3, 4, 1, 0.5),
             3: (2.0, 2, -1, -1, -1, 0.0), 4: (5.0, 4, -1, -1, -1, 0.0)}
    leaves, x = tree_shapley.tree_leaves(nodes), np.random.default_rng(2).random((60, 2))
    calls, values = [], tree_shapley.pattern_values
    monkeypatch.setattr(tree_shapley, "pattern_values", lambda *a: calls.append(1) or values(*a))
    tables = {}
    got = np.concatenate([tree_shapley.leaf_contributions(leaves, x[at:at + 20], tables) for at in (0, 20, 40)])
    assert len(calls) == 3 and len(tables) == 3
    assert np.allclose(got, [brute_shapley(nodes, row, 2) for row in x], atol=1e-12)
    monkeypatch.setattr(tree_shapley, "TABLE_BYTES", 0)
    monkeypatch.setattr(tree_shapley, "MAX_INTERVALS", 1)
    assert np.array_equal(tree_shapley.leaf_contributions(leaves, x), got)
    assert np.array_equal(tree_shapley.leaf_contributions(leaves, x[:1]), got[:1])


@pytest.mark.parametrize("estimator", ["forest", "boosted"])
def test_tree_values_add_up_to_the_prediction(spark, rows, forest, tmp_path, estimator):
    model = forest if estimator == "forest" else regression.fit_pipeline(
        rows, FEATURES, regression.gradient_boosted_trees(maxIter=5, maxDepth=4))
    path = sinks.save_model(model, str(tmp_path / estimator))
    named = rows.withColumnRenamed("id", "expected_id").limit(300)
    parts = tree_shapley.tree_shapley_values(sinks.load_model(spark, path), path, named, FEATURES, ["expected_id"])
    assert parts.columns == ["expected_id", "expected", *FEATURES] and parts.count() == 300
    scored = {r["expected_id"]: r["prediction"] for r in model.transform(named).collect()}
    for r in parts.collect():
        assert r["expected"] + sum(r[f] for f in FEATURES) == pytest.approx(scored[r["expected_id"]], abs=1e-6)
    ranking_ = tree_shapley.mean_absolute_values(parts, FEATURES).collect()
    assert [r["feature_name"] for r in ranking_] == ["trip_distance", "trip_duration_min", "passenger_count"]
    assert ranking_[-1]["mean_abs_contribution"] < ranking_[0]["mean_abs_contribution"] / 4
    assert tree_shapley.tree_shapley_values(model, path, named.limit(0), FEATURES, ["expected_id"]).count() == 0
    with pytest.raises(ValueError):
        tree_shapley.tree_shapley_values(model, path, named, FEATURES, ["expected_id"], max_nodes=3)


# ---- stochastic gradient

def test_stochastic_fit_is_near_least_squares_for_any_partitioning(spark, rows):
    noisy = rows.withColumn("fare_amount", F.col("fare_amount") + (F.col("id") * 13 % 17 - 8))
    exact = regression.coefficients(regression.fit_pipeline(noisy, FEATURES, regression.ordinary_least_squares()), FEATURES)
    fit = stochastic.fit_stochastic(noisy, FEATURES, "fare_amount", ["id"], tolerance=1e-4)
    assert fit.intercept == pytest.approx(exact["intercept"], abs=0.3)
    for f in FEATURES:
        assert fit.slopes[f] == pytest.approx(exact[f], abs=0.02), f
    assert fit.losses[-1] < fit.losses[0] and len(fit.losses) < 60
    again = stochastic.fit_stochastic(noisy.repartition(3), FEATURES, "fare_amount", ["id"], tolerance=1e-4)
    assert again == fit
    assert stochastic.fit_stochastic(noisy, FEATURES, "fare_amount", ["id"], epochs=3, seed=7).losses != fit.losses[:3]
    scored = fit.transform(noisy).agg(F.avg(F.abs(F.col("prediction") - F.col("fare_amount")))).first()[0]
    assert scored < 5


def test_stochastic_fit_of_odd_rows(spark):
    odd = spark.createDataFrame([(i, float(i % 5), 1.0, None if i == 3 else 2.0 * (i % 5)) for i in range(200)],
                                "id long, a double, flat double, y double")
    fit = stochastic.fit_stochastic(odd, ["a", "flat"], "y", ["id"], tolerance=1e-6)
    assert fit.slopes["a"] == pytest.approx(2.0, abs=0.02) and abs(fit.slopes["flat"]) < 1e-6
    with pytest.raises(ValueError):
        stochastic.fit_stochastic(odd.limit(0), ["a"], "y", ["id"])
