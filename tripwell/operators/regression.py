"""Fare models: training, tuning, comparison and scoring."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwell.operators.boosting import BoostedTrees, fit_depths
from tripwell.operators.bounded import cached, in_parallel, side_by_side
from tripwell.operators.forests import PackedForest
from tripwell.operators.regression_quality import metric_columns
from tripwell.operators.sampling import kfold_assign

LABEL = "fare_amount"


def preparation(features: Sequence[str]) -> list:
    """Assemble (rows with a missing feature are skipped) and standardise."""
    return [
        VectorAssembler(inputCols=list(features), outputCol="features_raw", handleInvalid="skip"),
        StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=True),
    ]


def ordinary_least_squares(label: str = LABEL) -> LinearRegression:
    return LinearRegression(labelCol=label, featuresCol="features")


def elastic_net(label: str = LABEL) -> LinearRegression:
    return LinearRegression(labelCol=label, featuresCol="features", maxIter=10, regParam=0.3,
                            elasticNetParam=0.8)


def iterative_least_squares(label: str = LABEL) -> LinearRegression:
    """Gradient-based linear fit: at most 1000 steps, tolerance 1e-3."""
    return LinearRegression(labelCol=label, featuresCol="features", solver="l-bfgs",
                            maxIter=1000, tol=1e-3)


def random_forest(label: str = LABEL, trees: int = 20, depth: int = 10, seed: int = 42,
                  **more) -> RandomForestRegressor:
    """A forest that fits large tables on packed rows, small ones as MLlib does.

    MLlib's fit keeps the node of every row and tree instead of descending again per level, which
    gives the same trees. What is kept is recomputed if it is lost, not checkpointed.
    """
    return PackedForest(labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth,
                                 seed=seed, **{"cacheNodeIds": True, "checkpointInterval": -1, **more})


def gradient_boosted_trees(label: str = LABEL, seed: int = 42, **more) -> GBTRegressor:
    return BoostedTrees(labelCol=label, featuresCol="features", seed=seed, **more)


def fit_pipeline(train: DataFrame, features: Sequence[str], estimator: Estimator) -> PipelineModel:
    return Pipeline(stages=[*preparation(features), estimator]).fit(train)


def score_batch(model: Transformer, df: DataFrame) -> DataFrame:
    return model.transform(df)


def model_metrics(model: Transformer, df: DataFrame, label: str = LABEL,
                  metrics: Sequence[str] = ("rmse", "r2", "mae")) -> dict[str, float]:
    """All metrics of a model on a table, from one scoring pass."""
    table = metric_columns(F.col(label), F.col("prediction"))
    return model.transform(df).agg(*[table[m].alias(m) for m in metrics]).first().asDict()


def coefficients(model: PipelineModel, features: Sequence[str]) -> dict[str, float]:
    """Intercept and coefficients of a fitted linear pipeline in original units."""
    scaler, linear = model.stages[-2], model.stages[-1]
    out, intercept = {}, linear.intercept
    for name, beta, mean, std in zip(features, linear.coefficients, scaler.mean, scaler.std):
        slope = float(beta) / float(std) if std else 0.0
        out[name] = slope
        intercept -= slope * float(mean)
    return {"intercept": float(intercept), **out}


@dataclass
class BakeoffEntry:
    model: str
    position: int
    rmse: float
    r2: float
    mae: float
    fitted: PipelineModel


def model_bakeoff(train: DataFrame, validation: DataFrame, features: Sequence[str],
                  algorithms: Mapping[str, Estimator], label: str = LABEL) -> list[BakeoffEntry]:
    """Fit every algorithm on train and score validation.

    The feature preparation is fitted and applied once; the prepared training
    vectors are cached for all fits, and one pass over validation scores all
    models together.
    """
    prepared = Pipeline(stages=preparation(features)).fit(train)
    fit_input = cached(prepared.transform(train).select("features", label))
    try:
        names = list(algorithms)
        models = in_parallel([lambda e=algorithms[n]: e.fit(fit_input) for n in names], 3)
    finally:
        fit_input.unpersist()
    scored = prepared.transform(validation).select("features", label)
    for i, model in enumerate(models):
        scored = model.copy({model.predictionCol: f"_p{i}"}).transform(scored)
    cells = {}
    for i in range(len(models)):
        table = metric_columns(F.col(label), F.col(f"_p{i}"))
        cells.update({f"{m}_{i}": table[m] for m in ("rmse", "r2", "mae")})
    row = scored.agg(*[c.alias(n) for n, c in cells.items()]).first()
    return [BakeoffEntry(n, i, row[f"rmse_{i}"], row[f"r2_{i}"], row[f"mae_{i}"],
                         PipelineModel([*prepared.stages, models[i]]))
            for i, n in enumerate(names)]


def best_entry(entries: Sequence[BakeoffEntry]) -> BakeoffEntry:
    """Lowest validation RMSE; the earlier algorithm wins a tie."""
    return min(entries, key=lambda e: (e.rmse, e.position))


@dataclass
class GridPoint:
    depth: int
    iterations: int
    rmse: float
    deviation: float


def best_grid_point(points: Sequence[GridPoint]) -> GridPoint:
    """Lowest mean RMSE; the earlier grid point wins a tie."""
    return min(points, key=lambda p: p.rmse)


def cv_grid_search(train: DataFrame, features: Sequence[str], keys: Sequence[str],
                   depths: Sequence[int] = (5, 10), iterations: Sequence[int] = (20, 50),
                   folds: int = 3, label: str = LABEL, seed: int = 42,
                   parallelism: int = 6) -> list[GridPoint]:
    """Cross-validated grid over depth and boosting rounds of boosted trees.

    Boosting adds trees one after the other, so the model with the most rounds
    contains all shorter ones: each depth and fold is fitted once and its
    hold-out error is read off after every number of rounds. The scaler is
    fitted once inside each fold, which keeps hold-out rows out of its statistics.
    """
    folded = cached(kfold_assign(train, keys, folds, seed, "_fold").select(*features, label, "_fold"))

    def part(fold: int, held_out: bool) -> DataFrame:
        return folded.filter(F.col("_fold") == fold if held_out else F.col("_fold") != fold)

    def errors(model: Transformer, held_out: DataFrame) -> list[float]:
        squared = model.evaluateEachIteration(held_out, "squared")
        return [math.sqrt(squared[n - 1]) for n in iterations]

    try:
        prepared = in_parallel([lambda f=f: Pipeline(stages=preparation(features)).fit(part(f, False))
                                for f in range(folds)], parallelism)
        booster = gradient_boosted_trees(label, seed, maxIter=max(iterations))
        models = fit_depths(booster, depths, [p.transform(part(f, False)) for f, p in enumerate(prepared)], parallelism)
        held_out = [p.transform(part(f, True)) for f, p in enumerate(prepared)]
        found = dict(zip(models, in_parallel([lambda f=f, m=m: errors(m, held_out[f])
                                              for (_, f), m in models.items()], parallelism)))
    finally:
        folded.unpersist()
    points = []
    for d in depths:
        for i, n in enumerate(iterations):
            scores = [{"rmse": found[d, f][i]} for f in range(folds)]
            points.append(GridPoint(d, n, *mean_and_deviation(scores, "rmse")))
    return points


def tuned_booster(point: GridPoint, label: str = LABEL, seed: int = 42) -> GBTRegressor:
    """Estimator with the parameters of a grid point, for the final fit."""
    return gradient_boosted_trees(label, seed, maxDepth=point.depth, maxIter=point.iterations)


@dataclass
class SearchTrial:
    trial: int
    trees: int
    depth: int
    min_rows: int
    rmse: float


def param_random_search(train: DataFrame, validation: DataFrame, features: Sequence[str],
                        trials: int = 4, trees: tuple[int, int] = (20, 120),
                        depth: tuple[int, int] = (4, 13), min_rows: tuple[int, int] = (1, 10),
                        label: str = LABEL, seed: int = 42) -> list[SearchTrial]:
    """Random forest parameters drawn at random, each scored on validation."""
    prepared = Pipeline(stages=preparation(features)).fit(train)
    fit_input = cached(prepared.transform(train).select("features", label))
    check = cached(prepared.transform(validation).select("features", label))
    draw = random.Random(seed)
    plans = [(i, draw.randint(*trees), draw.randint(*depth), draw.randint(*min_rows))
             for i in range(trials)]

    def run(plan) -> SearchTrial:
        i, n, d, m = plan
        model = random_forest(label, n, d, seed, minInstancesPerNode=m).fit(fit_input)
        return SearchTrial(i, n, d, m, model_metrics(model, check, label, ["rmse"])["rmse"])

    try:
        return in_parallel([lambda p=p: run(p) for p in plans], side_by_side(fit_input.count(), 4))
    finally:
        fit_input.unpersist()
        check.unpersist()


def cross_validate_metrics(df: DataFrame, features: Sequence[str], keys: Sequence[str],
                           estimator: Estimator, folds: int = 5, label: str = LABEL,
                           seed: int = 42) -> list[dict]:
    """Hold-out metrics of each fold."""
    folded = cached(kfold_assign(df, keys, folds, seed, "_fold").select(*features, label, "_fold"))

    def run(fold: int) -> dict:
        model = fit_pipeline(folded.filter(F.col("_fold") != fold), features, estimator)
        held_out = folded.filter(F.col("_fold") == fold)
        names = ("rmse", "mae", "r2", "mape", "explained_variance")
        return {"fold": fold, **model_metrics(model, held_out, label, names)}

    try:
        return in_parallel([lambda f=f: run(f) for f in range(folds)], side_by_side(folded.count(), 3))
    finally:
        folded.unpersist()


def feature_importance(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    scores = model.stages[-1].featureImportances.toArray()
    return [(name, float(score)) for name, score in zip(features, scores)]


def mean_profile(df: DataFrame, features: Sequence[str]) -> Column:
    """Average of every feature as a one-row struct."""
    return df.agg(F.struct(*[F.avg(f).alias(f) for f in features]).alias("profile")).scalar()


def predict_what_if(model: Transformer, profiles: DataFrame, distance: float = 20.0,
                    minutes: float = 10.0, passengers: float = 2.0) -> DataFrame:
    """Score a scenario on top of each profile row.

    A profile carries every feature; the three scenario columns replace its own.
    """
    scenario = profiles.withColumns({"trip_distance": F.lit(float(distance)),
                                     "trip_duration_min": F.lit(float(minutes)),
                                     "passenger_count": F.lit(float(passengers))})
    return model.transform(scenario)


def mean_and_deviation(rows: Sequence[dict], name: str) -> tuple[float, float]:
    values = [r[name] for r in rows]
    mean = sum(values) / len(values)
    return mean, math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))
