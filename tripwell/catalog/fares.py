"""Fare regression, tuning, scoring and explanation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwell.catalog.registry import query
from tripwell.catalog.trips import KEYS, SILVER_SQL, once, silver, sql_unit
from tripwell.operators import explain, parameter_search, ranking, regression, sampling, stochastic, tree_shapley
from tripwell.operators.bootstrap import rmse_bootstrap_ci
from tripwell.operators.projection import FEATURE_LABELS, MODEL_FEATURES, map_values
from tripwell.operators.quantiles import exact_quantiles
from tripwell.operators.regression import LABEL
from tripwell.operators.regression_quality import actual_vs_predicted
from tripwell.plans.training import standard_algorithms, train_fare_model
from tripwell.sources import sinks
from tripwell.sources.storage import new_path, store

FEATURES = list(MODEL_FEATURES)
_KEYS = ", ".join(KEYS)


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).select(*KEYS, *FEATURES, LABEL)


def splits(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Stored split tables, partitioned so that a reader opens only its share."""
    labelled = once(spark, sf_dir, "splits", lambda: store(
        sampling.assign_split(model_rows(spark, sf_dir), KEYS), "splits", ["split"]))
    return {n: labelled.filter(F.col("split") == n).drop("split") for n in sampling.DEFAULT_SPLIT}


def stored_forest_path(spark: SparkSession, sf_dir: str) -> str:
    def build():
        # The split is stored already; keeping it once more would fill the disk.
        model = regression.fit_pipeline(splits(spark, sf_dir)["train"], FEATURES, regression.random_forest())
        return sinks.save_model(model, new_path(spark, "forest"))

    return once(spark, sf_dir, "forest", build)


def stored_forest(spark: SparkSession, sf_dir: str):
    """The saved forest pipeline that scoring and explanation load."""
    return sinks.load_model(spark, stored_forest_path(spark, sf_dir))


def _metrics_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "model string, rmse double, r2 double, mae double")


def _fit_and_score(spark: SparkSession, sf_dir: str, name: str, estimator, train: DataFrame | None = None) -> DataFrame:
    parts = splits(spark, sf_dir)
    model = regression.fit_pipeline(parts["train"] if train is None else train, FEATURES, estimator)
    m = regression.model_metrics(model, parts["validation"])
    return _metrics_frame(spark, [(name, m["rmse"], m["r2"], m["mae"])])


_NORMAL_SQL = f"""with {SILVER_SQL}, s as (
  select avg(trip_distance) as ma, avg(trip_duration_min) as mb, avg(fare_amount) as my,
    var_pop(trip_distance) as saa, var_pop(trip_duration_min) as sbb,
    covar_pop(trip_distance, trip_duration_min) as sab, covar_pop(trip_distance, fare_amount) as say,
    covar_pop(trip_duration_min, fare_amount) as sby from silver),
b as (select *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) as ba,
  (sby * saa - say * sab) / (saa * sbb - sab * sab) as bb from s)"""
_TWO = ["trip_distance", "trip_duration_min"]


@query("linear_regression_ols", f"""{_NORMAL_SQL}
select 'intercept' as term, round(my - ba * ma - bb * mb, 6) as coefficient from b
union all select 'trip_distance', round(ba, 6) from b
union all select 'trip_duration_min', round(bb, 6) from b""")
def linear_regression_ols(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = regression.fit_pipeline(silver(spark, sf_dir).select(*_TWO, LABEL), _TWO,
                                    regression.ordinary_least_squares())
    return spark.createDataFrame([(n, round(b, 6)) for n, b in regression.coefficients(model, _TWO).items()],
                                 "term string, coefficient double")


@query("linear_regression_elastic")
def linear_regression_elastic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_and_score(spark, sf_dir, "LinearRegression", regression.elastic_net())


@query("linear_regression_sgd")
def linear_regression_sgd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averaged stochastic gradient on a tenth of the training split, the feature being the tenth."""
    parts = splits(spark, sf_dir)
    tenth = sampling.sample_fraction(parts["train"], KEYS, 0.1)
    m = regression.model_metrics(stochastic.fit_stochastic(tenth, FEATURES, LABEL, KEYS), parts["validation"])
    return _metrics_frame(spark, [("StochasticLinear", m["rmse"], m["r2"], m["mae"])])


@query("linear_regression_sgd_coefficients")
def linear_regression_sgd_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of distance and duration over all trips, beside those of least squares."""
    rows = silver(spark, sf_dir).select(*KEYS, *_TWO, LABEL)
    found = stochastic.fit_stochastic(rows, _TWO, LABEL, KEYS, tolerance=1e-4)
    exact = regression.coefficients(regression.fit_pipeline(rows, _TWO, regression.ordinary_least_squares()), _TWO)
    got = {"intercept": found.intercept, **found.slopes}
    return spark.createDataFrame([(n, float(got[n]), float(b), len(found.losses)) for n, b in exact.items()],
                                 "term string, coefficient double, least_squares double, epochs int")


@query("random_forest")
def random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = regression.model_metrics(stored_forest(spark, sf_dir), splits(spark, sf_dir)["validation"])
    return _metrics_frame(spark, [("RandomForest", m["rmse"], m["r2"], m["mae"])])


@query("gbt_regressor")
def gbt_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_and_score(spark, sf_dir, "GBT", regression.gradient_boosted_trees())


def grid_points(spark: SparkSession, sf_dir: str) -> list[regression.GridPoint]:
    """The booster's grid, searched once for everything that needs its best point."""
    return once(spark, sf_dir, "grid", lambda: regression.cv_grid_search(
        splits(spark, sf_dir)["train"], FEATURES, KEYS))


@query("cv_grid_search")
def cv_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = grid_points(spark, sf_dir)
    best = regression.best_grid_point(points)
    return spark.createDataFrame(
        [(p.depth, p.iterations, p.rmse, p.deviation, p is best) for p in points],
        "max_depth int, max_iter int, rmse double, rmse_std double, chosen boolean")


@query("param_random_search")
def param_random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = splits(spark, sf_dir)
    trials = regression.param_random_search(parts["train"], parts["validation"], FEATURES)
    best = min(trials, key=lambda t: (t.rmse, t.trial))
    return spark.createDataFrame(
        [(t.trial, t.trees, t.depth, t.min_rows, t.rmse, t.trial == best.trial) for t in trials],
        "trial int, trees int, depth int, min_rows int, rmse double, chosen boolean")


@query("param_parzen_search")
def param_parzen_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search log of forest parameters: proposals fitted on a tenth of the rows, the best of each round on all."""
    parts = splits(spark, sf_dir)
    log = parameter_search.forest_search(parts["train"], parts["validation"], FEATURES, KEYS)
    best = parameter_search.best_evaluation(log)
    return spark.createDataFrame(
        [(e.trial, e.round, e.share, e.setting["trees"], e.setting["depth"], e.setting["min_rows"], e.loss, e is best)
         for e in log],
        "trial int, round int, share double, trees int, depth int, min_rows int, rmse double, chosen boolean")


@query("cross_validate_metrics")
def cross_validate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.cross_validate_metrics(splits(spark, sf_dir)["train"], FEATURES, KEYS,
                                             regression.random_forest())
    names = ("rmse", "mae", "r2", "mape", "explained_variance")
    return spark.createDataFrame([(n, *regression.mean_and_deviation(rows, n)) for n in names],
                                 "metric string, mean double, deviation double")


@query("model_bakeoff")
def model_bakeoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = regression.best_grid_point(grid_points(spark, sf_dir))
    result = train_fare_model(model_rows(spark, sf_dir), KEYS, standard_algorithms(tuned=best),
                              model_path=new_path(spark, "best-model"))
    return spark.createDataFrame(
        [(e.model, e.rmse, e.r2, e.mae, e.model == result.winner.model,
          result.test["rmse"] if e.model == result.winner.model else None) for e in result.entries],
        "model string, rmse double, r2 double, mae double, winner boolean, test_rmse double")


@query("score_batch")
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = regression.score_batch(stored_forest(spark, sf_dir), splits(spark, sf_dir)["test"])
    return scored.select(*KEYS, LABEL, "prediction")


def _linear(spark: SparkSession, sf_dir: str):
    """Ordinary least squares of the fare on distance and duration over all trips."""
    return regression.fit_pipeline(silver(spark, sf_dir).select(*_TWO, LABEL), _TWO, regression.ordinary_least_squares())


_LINEAR = "round(my + ba * ({a} - ma) + bb * ({b} - mb), 6) + 0.0"


@query("score_batch_linear", f"""{_NORMAL_SQL} select {_KEYS}, fare_amount,
  {_LINEAR.format(a='trip_distance', b='trip_duration_min')} as prediction from silver, b""")
def score_batch_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = regression.score_batch(_linear(spark, sf_dir), silver(spark, sf_dir).select(*KEYS, *_TWO, LABEL))
    return scored.select(*KEYS, LABEL, (F.round("prediction", 6) + 0.0).alias("prediction"))


@query("predict_what_if_linear", f"""{_NORMAL_SQL} select hour, trip_distance, trip_duration_min,
  {_LINEAR.format(a='trip_distance', b='trip_duration_min')} as prediction from (
  select pickup_hour as hour, 20.0::double as trip_distance, 10.0::double as trip_duration_min
  from silver group by 1), b""")
def predict_what_if_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = regression.predict_what_if(_linear(spark, sf_dir), hourly_profiles(spark, sf_dir))
    return found.select("hour", "trip_distance", "trip_duration_min", (F.round("prediction", 6) + 0.0).alias("prediction"))


@query("forest_predictions_extract")
def forest_predictions_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual and predicted fares of the test split under the stored forest."""
    scored = regression.score_batch(stored_forest(spark, sf_dir), splits(spark, sf_dir)["test"])
    return actual_vs_predicted(scored, LABEL, "prediction", KEYS)


@query("forest_bootstrap_ci")
def forest_bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bootstrap interval of the stored forest's error on the test split."""
    scored = regression.score_batch(stored_forest(spark, sf_dir), splits(spark, sf_dir)["test"])
    return rmse_bootstrap_ci(scored, KEYS, LABEL, "prediction")


@query("forest_importance_extract")
def forest_importance_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored forest's ten most important features under their display names."""
    scores = regression.feature_importance(stored_forest(spark, sf_dir), FEATURES)
    table = spark.createDataFrame(scores, "feature_name string, importance_score double")
    top = ranking.topk(table, "importance_score", 10, ["feature_name"])
    return top.withColumn("display_name", map_values(F.col("feature_name"), FEATURE_LABELS))


def hourly_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One average trip per pickup hour."""
    return (silver(spark, sf_dir).groupBy(F.col("pickup_hour").alias("hour"))
            .agg(*[F.avg(f).alias(f) for f in FEATURES]))


@query("predict_what_if")
def predict_what_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The long way home: 20 miles with two passengers, for 10 minutes and for the median duration.
    model, profiles = stored_forest(spark, sf_dir), hourly_profiles(spark, sf_dir)
    median = exact_quantiles(silver(spark, sf_dir), ["trip_duration_min"], [0.5])["trip_duration_min"][0]
    short = regression.predict_what_if(model, profiles).withColumn("scenario", F.lit("default"))
    usual = regression.predict_what_if(model, profiles, minutes=median).withColumn(
        "scenario", F.lit("median_duration"))
    return short.unionByName(usual).select("scenario", "hour", "trip_distance", "trip_duration_min",
                                           "passenger_count", "prediction")


@query("feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = regression.feature_importance(stored_forest(spark, sf_dir), FEATURES)
    return spark.createDataFrame(scores, "feature_name string, importance_score double").orderBy(
        F.col("importance_score").desc(), "feature_name")


def _tree_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored_forest_path(spark, sf_dir)
    return tree_shapley.tree_shapley_values(stored_forest(spark, sf_dir), path, splits(spark, sf_dir)["test"], FEATURES, KEYS)


@query("shapley_values")
def shapley_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the stored forest by their mean absolute Shapley value over the whole test split."""
    return tree_shapley.mean_absolute_values(_tree_values(spark, sf_dir), FEATURES)


@query("shapley_values_by_trip")
def shapley_values_by_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact contributions of every feature to the forest's prediction of every test trip."""
    return _tree_values(spark, sf_dir)


@query("shapley_values_linear", f"""{_NORMAL_SQL}, picked as (select * from silver
  order by {sql_unit(KEYS)}, {_KEYS} limit 500)
select {_KEYS}, 'trip_distance' as feature_name, round(ba * (trip_distance - ma), 6) + 0.0 as contribution
from picked, b union all
select {_KEYS}, 'trip_duration_min', round(bb * (trip_duration_min - mb), 6) + 0.0 from picked, b""")
def shapley_values_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver(spark, sf_dir).select(*KEYS, *_TWO, LABEL)
    model = regression.fit_pipeline(rows, _TWO, regression.ordinary_least_squares())
    slopes = regression.coefficients(model, _TWO)
    slopes.pop("intercept")
    picked = sampling.sample_exact(rows, KEYS, 500)
    parts = explain.shapley_linear(picked, rows, slopes, KEYS)
    return parts.withColumn("contribution", F.round("contribution", 6) + 0.0)


@query("local_surrogate")
def local_surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = model_rows(spark, sf_dir)
    chosen = ranking.argmax_row(rows, LABEL, KEYS)
    weights = explain.local_surrogate(stored_forest(spark, sf_dir), chosen, rows, FEATURES, KEYS)
    return spark.createDataFrame([(i + 1, n, c, w) for i, (n, c, w) in enumerate(weights)],
                                 "rank int, feature_name string, condition string, weight double")
