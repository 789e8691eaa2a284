"""Splits, samples, folds, bootstraps and regression metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwell.catalog.ingest import SUMMARY_SQL, bootstrap_sql, rounded
from tripwell.catalog.registry import query
from tripwell.catalog.trips import KEYS, PREDICTED_SQL, SILVER_SQL, predicted, silver, sql_unit
from tripwell.operators import bootstrap, resampling, sampling
from tripwell.operators.regression_quality import actual_vs_predicted, regression_metrics
from tripwell.sources.sinks import sink_parquet_overwrite
from tripwell.sources.storage import new_path

_KEYS = ", ".join(KEYS)
_U = sql_unit(KEYS)
_SPLIT_U, _FOLD_U = sql_unit(KEYS, lane=0), sql_unit(KEYS, lane=2)
_SPLIT_CASE = (f"case when {_SPLIT_U} < 0.7::double then 'train' "
               f"when {_SPLIT_U} < 0.85::double then 'validation' else 'test' end")
_NARROW = [*KEYS, "trip_distance", "fare_amount", "trip_duration_min"]
_NARROW_SQL = ", ".join(_NARROW)


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).select(*_NARROW)


@query("random_split", f"with {SILVER_SQL} select {_NARROW_SQL}, {_SPLIT_CASE} as split from silver")
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.assign_split(_rows(spark, sf_dir), KEYS)


@query("split_export", f"""with {SILVER_SQL}
select {_SPLIT_CASE} as split, count(*) as row_count, round(sum(fare_amount), 6) as fare_sum
from silver group by 1""")
def split_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = sampling.assign_split(silver(spark, sf_dir), KEYS)
    path = sink_parquet_overwrite(labelled, new_path(spark, "splits"), ["split"])
    counts = spark.read.parquet(path).groupBy("split").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("fare_amount").alias("fare_sum"))
    return rounded(counts, "fare_sum")


@query("sample_fraction", f"with {SILVER_SQL} select {_NARROW_SQL} from silver where {_U} < 0.1::double")
def sample_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_fraction(_rows(spark, sf_dir), KEYS, 0.1)


@query("sample_capped", f"""with {SILVER_SQL} select {_NARROW_SQL} from silver
order by {_U}, {_NARROW_SQL} limit 50000""")
def sample_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_capped(_rows(spark, sf_dir), KEYS, 50_000)


@query("sample_without_replacement_n", f"""with {SILVER_SQL} select {_NARROW_SQL} from silver
order by {sql_unit(KEYS, 7)}, {_NARROW_SQL} limit 10000""")
def sample_without_replacement_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_exact(_rows(spark, sf_dir), KEYS, 10_000, seed=7)


_WEIGHT_CUTS = ("0.367879441171", "0.735758882343", "0.919698602929", "0.981011843124",
                "0.996340153173", "0.999405815182", "0.999916758851", "0.999989750803",
                "0.999998874797")
_WEIGHT_SQL = f"""with {SILVER_SQL}, digests as (
  select {_KEYS}, b, md5(concat_ws(':', '42', {_KEYS}, b)) as h from silver, range(3) r(b)),
draws as (""" + " union all ".join(
    f"select {_KEYS}, cast(b * 4 + {i + 1} as integer) as replicate, "
    f"('0x' || substr(h, {1 + 8 * i}, 8))::bigint / 4294967296::double as u from digests"
    for i in range(4)) + f""")
select {_KEYS}, replicate, cast(case {' '.join(f'when u < {c}::double then {i}'
for i, c in enumerate(_WEIGHT_CUTS))} else 9 end as integer) as weight from draws where replicate <= 10"""


@query("bootstrap_weights", _WEIGHT_SQL)
def bootstrap_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bootstrap.bootstrap_weights(silver(spark, sf_dir), KEYS, 10)


@query("kfold_assign", f"""with {SILVER_SQL} select {_NARROW_SQL},
  cast(floor({_FOLD_U} * 5) as integer) as fold5, cast(floor({_FOLD_U} * 3) as integer) as fold3 from silver""")
def kfold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    five = sampling.kfold_assign(_rows(spark, sf_dir), KEYS, 5, column="fold5")
    return sampling.kfold_assign(five, KEYS, 3, column="fold3")


@query("bootstrap_summary", bootstrap_sql(10, SUMMARY_SQL))
def bootstrap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = bootstrap.bootstrap_rmse(predicted(spark, sf_dir), KEYS, "fare_amount", "prediction", 10)
    return rounded(bootstrap.bootstrap_summary(values, "rmse"), "mean", "std", "ci_lower", "ci_upper")


@query("rmse_bootstrap_ci", bootstrap_sql(100, SUMMARY_SQL))
def rmse_bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(bootstrap.rmse_bootstrap_ci(predicted(spark, sf_dir), KEYS, "fare_amount", "prediction"),
                   "mean", "std", "ci_lower", "ci_upper")


@query("bootstrap_multinomial_weights")
def bootstrap_multinomial_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each of ten replicates of exactly n draws takes every trip."""
    return resampling.multinomial_weights(silver(spark, sf_dir), KEYS, 10)


@query("rmse_bootstrap_multinomial_ci")
def rmse_bootstrap_multinomial_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval of the error over a hundred replicates of exactly n draws."""
    return resampling.multinomial_rmse_ci(predicted(spark, sf_dir), KEYS, "fare_amount", "prediction")


_ERROR = "(fare_amount - prediction)"
_METRIC_SQL = {
    "rmse": f"sqrt(avg({_ERROR} * {_ERROR}))",
    "mae": f"avg(abs({_ERROR}))",
    "r2": f"1 - sum({_ERROR} * {_ERROR}) / (sum(fare_amount * fare_amount) - count(*) * avg(fare_amount) ** 2)",
    "mape": f"avg(abs({_ERROR}) / abs(fare_amount))",
    "explained_variance": f"1 - var_pop({_ERROR}) / var_pop(fare_amount)",
}


def _register_metric(name: str, sql: str) -> None:
    @query(name, f"with {SILVER_SQL}, {PREDICTED_SQL} select round({sql}, 6) as {name} from predicted")
    def metric(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(regression_metrics(predicted(spark, sf_dir), "fare_amount", "prediction",
                                          metrics=[name]), name)


for _name, _sql in _METRIC_SQL.items():
    _register_metric(_name, _sql)


@query("actual_vs_predicted", f"""with {SILVER_SQL}, {PREDICTED_SQL}
select {_KEYS}, fare_amount as actual_fare, prediction as predicted_fare,
  fare_amount - prediction as residual from predicted""")
def actual_vs_predicted_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip; for a plot, pass the table through ``sample_exact``."""
    return actual_vs_predicted(predicted(spark, sf_dir), "fare_amount", "prediction", KEYS)
