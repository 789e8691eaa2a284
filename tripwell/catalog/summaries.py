"""The zone join, aggregates, rankings and dashboard extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwell.catalog.ingest import HOURLY_SQL, rounded
from tripwell.catalog.registry import query
from tripwell.catalog.trips import (
    ANCHORS, CLUSTER_COLUMNS, KEYS, PREDICTED_SQL, SILVER_SQL, TRIPS_SQL, ZONES_SQL, bronze,
    labelled, label_sql, predicted, silver, sql_unit, trips, zones)
from tripwell.operators import aggregates, cluster_quality, ranking
from tripwell.operators.bounded import in_parallel, pin_small
from tripwell.operators.cleaning import cast_double_columns
from tripwell.operators.joins import broadcast_zone_join
from tripwell.operators.projection import MODEL_FEATURES
from tripwell.operators.regression_quality import metric_columns
from tripwell.operators.sampling import sample_exact

_KEYS = ", ".join(KEYS)


@query("broadcast_zone_join", f"""with {TRIPS_SQL}, {ZONES_SQL}
select t.*, "Borough" as pickup_borough, "Zone" as pickup_zone
from trips t left join zones z on t."PULocationID" = z."LocationID" """)
def zone_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broadcast_zone_join(trips(spark, sf_dir), zones(spark, sf_dir))


@query("count_rows", f"with {TRIPS_SQL} select count(*) as row_count from trips")
def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.count_rows(trips(spark, sf_dir))


@query("hourly_stats", f"with {SILVER_SQL} {HOURLY_SQL}")
def hourly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregates.hourly_stats(silver(spark, sf_dir)), "avg_fare", "avg_dist", "avg_duration")


@query("cluster_size_share", f"""with {SILVER_SQL}, {label_sql()}
select cluster, count(*) as size,
  round(count(*) / (select count(*)::double from labelled), 6) as share
from labelled group by cluster""")
def cluster_size_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cluster_quality.cluster_size_share(labelled(spark, sf_dir), "cluster"), "share")


@query("cluster_count_distinct", f"""with {SILVER_SQL}, {label_sql()}
select count(distinct cluster) as n_clusters, count(distinct cluster) >= 2 as can_evaluate from labelled""")
def cluster_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_quality.cluster_count_distinct(labelled(spark, sf_dir), "cluster")


_CENTERS = ", ".join(f"round(avg({c}), 6) as center_{c}" for c in CLUSTER_COLUMNS)


@query("cluster_profile", f"""with {SILVER_SQL}, {label_sql()}
select cluster, count(*) as size, round(avg(fare_amount), 6) as avg_fare, {_CENTERS}
from labelled group by cluster order by avg_fare, cluster""")
def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = cluster_quality.cluster_profile(labelled(spark, sf_dir), "cluster", CLUSTER_COLUMNS,
                                              "fare_amount")
    return rounded(profile, "avg_fare", *[f"center_{c}" for c in CLUSTER_COLUMNS])


def _pearson_sql() -> str:
    names = aggregates.CORRELATION_COLUMNS
    cells = " union all ".join(
        f"select {i} as row_no, {j} as col_no, '{a}' as row_name, '{b}' as col_name,"
        f" round(corr({a}, {b}), 6) as r from silver"
        for i, a in enumerate(names) for j, b in enumerate(names))
    return f"with {SILVER_SQL}, matrix as ({cells})"


@query("pearson_matrix", f"{_pearson_sql()} select * from matrix")
def pearson_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregates.pearson_matrix(silver(spark, sf_dir)), "r")


@query("lower_triangle", f"{_pearson_sql()} select * from matrix where col_no <= row_no")
def lower_triangle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregates.lower_triangle(aggregates.pearson_matrix(silver(spark, sf_dir))), "r")


@query("residual_histogram", f"""with {SILVER_SQL}, {PREDICTED_SQL}, r as (
  select fare_amount - prediction as v from predicted),
b as (select min(v) as lo, max(v) as hi from r),
c as (select least(cast(floor((v - lo) / (hi - lo) * 80) as integer), 79) as bin, count(*) as n
  from r, b group by 1)
select cast(i as integer) as bin, round(lo + i * ((hi - lo) / 80), 6) as lower_edge,
  round(lo + (i + 1) * ((hi - lo) / 80), 6) as upper_edge, coalesce(n, 0) as frequency
from range(80) g(i) cross join b left join c on c.bin = i""")
def residual_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    residual = F.col("fare_amount") - F.col("prediction")
    return rounded(aggregates.histogram(predicted(spark, sf_dir), residual, 80), "lower_edge", "upper_edge")


@query("residual_summary", f"""with {SILVER_SQL}, {PREDICTED_SQL}
select round(avg(fare_amount - prediction), 6) as mean_residual, count(*) as n from predicted""")
def residual_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregates.residual_summary(predicted(spark, sf_dir), "fare_amount", "prediction"),
                   "mean_residual")


@query("min_max_limits", f"""with {SILVER_SQL}, {PREDICTED_SQL}
select least(min(fare_amount), min(prediction)) as lower_limit,
  greatest(max(fare_amount), max(prediction)) as upper_limit from predicted""")
def min_max_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.min_max_limits(predicted(spark, sf_dir), ["fare_amount", "prediction"])


_PROFILED = ["VendorID", "passenger_count", "trip_distance", "RatecodeID", "payment_type", "fare_amount", "extra",
             "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge",
             "airport_fee"]


def _quality_sql(tier: str, source: str, column: str) -> str:
    low, high = (f"(select quantile_cont({column}::double, {p}) from {source})" for p in (0.01, 0.99))
    return f"""select '{tier}' as tier, '{column}' as column_name, count(*) as row_count,
  count(*) filter ({column} is null) as null_count, round({low}, 6) as clip_lower,
  round({high}, 6) as clip_upper,
  count(*) filter ({column} < {low} or {column} > {high}) as out_of_bounds from {source}"""


@query("null_outlier_quality", f"with {SILVER_SQL} " + " union all ".join(
    _quality_sql(tier, source, c) for tier, source in (("raw", "trips"), ("silver", "silver"))
    for c in _PROFILED))
def null_outlier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = cast_double_columns(bronze(spark, sf_dir).select(*_PROFILED), _PROFILED)
    refined_rows = silver(spark, sf_dir)
    raw, refined = in_parallel([lambda: aggregates.quality_profile(typed, _PROFILED, "raw"),
                                lambda: aggregates.quality_profile(refined_rows, _PROFILED, "silver")])
    return rounded(raw.unionByName(refined), "clip_lower", "clip_upper")


def with_personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled trips with the persona of their cluster."""
    rows = labelled(spark, sf_dir)
    profile = rows.groupBy("cluster").agg(F.avg("fare_amount").alias("avg_fare"))
    names = pin_small(ranking.persona_rank(profile).select("cluster", "persona"))
    return rows.join(names, "cluster")


_PERSONA_CASE = " ".join(f"when {i + 1} then '{p}'" for i, p in enumerate(ranking.PERSONAS))
_PERSONA_SQL = f"""with {SILVER_SQL}, {label_sql()}, profile as (
  select cluster, round(avg(fare_amount), 6) as avg_fare,
    cast(row_number() over (order by avg(fare_amount), cluster) as integer) as persona_rank
  from labelled group by cluster),
named as (select *, case persona_rank {_PERSONA_CASE} end as persona from profile)"""


@query("fare_by_time_persona", f"""{_PERSONA_SQL}
select pickup_hour, persona, round(sum(fare_amount), 6) as revenue,
  round(avg(fare_amount), 6) as avg_fare, count(*) as trips
from labelled join named using (cluster) group by pickup_hour, persona""")
def fare_by_time_persona(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregates.fare_by_time_persona(with_personas(spark, sf_dir)), "revenue", "avg_fare")


@query("persona_rank", f"{_PERSONA_SQL} select * from named")
def persona_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = labelled(spark, sf_dir).groupBy("cluster").agg(F.avg("fare_amount").alias("avg_fare"))
    return rounded(ranking.persona_rank(profile), "avg_fare")


@query("distance_distribution", f"""with {SILVER_SQL}
select cast(floor(trip_distance / 5) as integer) as bucket,
  floor(trip_distance / 5) * 5.0::double as distance_from,
  (floor(trip_distance / 5) + 1) * 5.0::double as distance_to, count(*) as trips
from silver group by 1, 2, 3""")
def distance_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.distance_distribution(silver(spark, sf_dir))


# ---- order, limits and winners ---------------------------------------------

@query("order_by", f"""with {SILVER_SQL}
select pickup_borough, count(*) as trips, round(sum(fare_amount), 6) as revenue
from silver group by pickup_borough order by revenue desc""")
def order_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = silver(spark, sf_dir).groupBy("pickup_borough").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").alias("revenue"))
    return rounded(revenue.orderBy(F.col("revenue").desc()), "revenue")


@query("limit_rows", f"""with {SILVER_SQL} select {_KEYS}, trip_distance, fare_amount, trip_duration_min
from silver order by {sql_unit(KEYS)}, {_KEYS}, trip_distance, fare_amount, trip_duration_min
limit 50000""")
def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_exact(silver(spark, sf_dir).select(*KEYS, *CLUSTER_COLUMNS), KEYS, 50_000)


@query("single_baseline_row", f"""with {SILVER_SQL} select {_KEYS}, trip_distance, fare_amount
from silver order by {_KEYS}, trip_distance, fare_amount limit 1""")
def single_baseline_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver(spark, sf_dir).select(*KEYS, "trip_distance", "fare_amount")
    return ranking.single_baseline_row(rows, rows.columns)


_SCORED = [f for f in MODEL_FEATURES]


def feature_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute correlation of every model feature with the fare."""
    sums = silver(spark, sf_dir).agg(*[F.corr(f, "fare_amount").alias(f) for f in _SCORED])
    cells = [F.struct(F.lit(f).alias("feature_name"),
                      F.round(F.abs(F.nanvl(F.coalesce(F.col(f), F.lit(0.0)), F.lit(0.0))), 6)
                      .alias("importance_score")) for f in _SCORED]
    return sums.select(F.inline(F.array(*cells)))


_SCORES_SQL = f"with {SILVER_SQL}, scores as (" + " union all ".join(
    f"select '{f}' as feature_name, case when stddev_pop({f}) = 0 then 0.0::double"
    f" else round(abs(corr({f}, fare_amount)), 6) end as importance_score from silver"
    for f in _SCORED) + ")"


@query("topk_importance", f"""{_SCORES_SQL} select * from scores
order by importance_score desc, feature_name limit 10""")
def topk_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.topk(feature_scores(spark, sf_dir), "importance_score", 10, ["feature_name"])


@query("bottom_sorted_tail", f"""{_SCORES_SQL} select * from (select * from scores
order by importance_score desc, feature_name limit 12) order by importance_score, feature_name desc""")
def bottom_sorted_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.sorted_tail(feature_scores(spark, sf_dir), "importance_score", 12, ["feature_name"])


@query("argmax_row", f"""with {SILVER_SQL} select {_KEYS}, trip_distance, fare_amount
from silver order by fare_amount desc, {_KEYS} limit 1""")
def argmax_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.argmax_row(silver(spark, sf_dir).select(*KEYS, "trip_distance", "fare_amount"),
                              "fare_amount", KEYS)


# Three fixed predictors stand in for fitted models: (name, Spark, SQL).
PREDICTORS = (
    ("flat", lambda: F.lit(75.0) + 0.0 * F.col("trip_distance"), "75.0::double + 0.0::double * trip_distance"),
    ("distance_only", lambda: 20.0 + 2.5 * F.col("trip_distance"), "20.0::double + 2.5::double * trip_distance"),
    ("distance_and_time", lambda: 4.0 + 2.75 * F.col("trip_distance") + 0.25 * F.col("trip_duration_min"),
     "4.0::double + 2.75::double * trip_distance + 0.25::double * trip_duration_min"),
)


def model_metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, position, rmse, r2, mae) of the fixed predictors, from one pass."""
    label = F.col("fare_amount")
    sums: list[Column] = []
    for i, (_, predict, _) in enumerate(PREDICTORS):
        metrics = metric_columns(label, predict())
        sums += [metrics[m].alias(f"{m}{i}") for m in ("rmse", "r2", "mae")]
    cells = [F.struct(F.lit(name).alias("model"), F.lit(i).alias("position"),
                      *[F.col(f"{m}{i}").alias(m) for m in ("rmse", "r2", "mae")])
             for i, (name, _, _) in enumerate(PREDICTORS)]
    return silver(spark, sf_dir).agg(*sums).select(F.inline(F.array(*cells)))


METRICS_SQL = f"with {SILVER_SQL}, metrics as (" + " union all ".join(
    f"""select '{name}' as model, {i} as position,
  sqrt(avg((fare_amount - p) * (fare_amount - p))) as rmse,
  1 - avg((fare_amount - p) * (fare_amount - p)) / var_pop(fare_amount) as r2,
  avg(abs(fare_amount - p)) as mae from (select fare_amount, {sql} as p from silver)"""
    for i, (name, _, sql) in enumerate(PREDICTORS)) + ")"


@query("best_model_select", f"""{METRICS_SQL} select model, round(rmse, 6) as rmse from metrics
order by metrics.rmse, position limit 1""")
def best_model_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranking.best_model_select(model_metrics_table(spark, sf_dir)), "rmse")


@query("model_performance_extract", f"""{METRICS_SQL} select model, round(rmse, 6) as rmse,
  round(r2, 6) as r2, round(mae, 6) as mae from metrics""")
def model_performance_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(model_metrics_table(spark, sf_dir).drop("position"), "rmse", "r2", "mae")


@query("improvement_vs_baseline", f"""{METRICS_SQL}, base as (select rmse from metrics where model = 'flat')
select model, round(m.rmse, 6) as rmse, round(base.rmse - m.rmse, 6) as improvement,
  round((base.rmse - m.rmse) / base.rmse * 100, 6) as improvement_pct, seconds,
  round((base.rmse - m.rmse) / seconds, 6) as gain_per_second
from (select *, (position + 1) * 2.0::double as seconds from metrics) m, base""")
def improvement_vs_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A fixed cost per model keeps the result comparable between runs.
    timed = model_metrics_table(spark, sf_dir).withColumn("seconds", (F.col("position") + 1) * 2.0)
    gains = ranking.improvement_vs_baseline(timed, "flat", seconds="seconds")
    return rounded(gains, "rmse", "improvement", "improvement_pct", "gain_per_second")


@query("speedup_ratio", f"""with {SILVER_SQL}, runs as (
  select "RatecodeID" as environment, sum(trip_duration_min) * 60 as seconds from silver group by 1)
select environment, seconds,
  round(seconds / (select seconds from runs where environment = 1), 6) as ratio from runs""")
def speedup_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = silver(spark, sf_dir).groupBy(F.col("RatecodeID").alias("environment")).agg(
        (F.sum("trip_duration_min") * 60).alias("seconds"))
    return rounded(ranking.speedup_ratio(runs, 1.0), "ratio")


def centers_sql(source: str, name: str, columns: list[str], label: str = "cluster") -> str:
    means = ", ".join(f"avg({c}) as m_{c}" for c in columns)
    spread = " + ".join(f"var_pop({c})" for c in columns)
    return f"""{name} as (select {label} as label, count(*) as n, {means}, {spread} as v
  from {source} group by {label})"""


def silhouette_sql(source: str, centers: str, columns: list[str], name: str,
                   label: str = "cluster") -> str:
    """Mean squared-distance silhouette from centers: one row named ``silhouette``."""
    gap = " + ".join(f"(p.{c} - c.m_{c}) * (p.{c} - c.m_{c})" for c in columns)
    return f"""{name}_pairs as (
  select p.id, p.{label} = c.label as own, c.n,
    ({gap} + c.v) * case when p.{label} = c.label then c.n / nullif(c.n - 1, 0)::double else 1 end as d
  from (select *, row_number() over () as id from {source}) p, {centers} c),
{name}_rows as (
  select id, max(case when own then d end) as a, min(case when not own then d end) as b
  from {name}_pairs group by id),
{name} as (select avg(case when a is null or greatest(a, b) = 0 then 0
  else (b - a) / greatest(a, b) end) as silhouette from {name}_rows)"""


def calinski_sql(centers: str, columns: list[str], name: str) -> str:
    between = " + ".join(
        f"n * (m_{c} - (select sum(n * m_{c}) / sum(n) from {centers})) ** 2" for c in columns)
    return f"""{name} as (select (sum({between}) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*)))
  as calinski_harabasz from {centers})"""


def davies_sql(source: str, centers: str, columns: list[str], name: str, label: str = "cluster") -> str:
    own = " + ".join(f"(p.{c} - c.m_{c}) ** 2" for c in columns)
    gap = " + ".join(f"(a.m_{c} - b.m_{c}) ** 2" for c in columns)
    kept = ", ".join(f"c.m_{c}" for c in columns)
    return f"""{name}_s as (select c.label, {kept}, avg(sqrt({own})) as s
  from {source} p join {centers} c on p.{label} = c.label group by c.label, {kept}),
{name} as (select avg(worst) as davies_bouldin from (
  select a.label, max((a.s + b.s) / sqrt({gap})) as worst
  from {name}_s a join {name}_s b on a.label <> b.label group by a.label))"""


_BEST_K_SQL = f"with {SILVER_SQL}, " + ", ".join(
    ", ".join((label_sql(k, f"l{k}"), centers_sql(f"l{k}", f"c{k}", CLUSTER_COLUMNS),
               silhouette_sql(f"l{k}", f"c{k}", CLUSTER_COLUMNS, f"s{k}")))
    for k in sorted(ANCHORS))


@query("best_k_select", f"""{_BEST_K_SQL} select k, round(silhouette, 6) as silhouette from (
{' union all '.join(f'select {k} as k, silhouette from s{k}' for k in sorted(ANCHORS))})
order by silhouette desc, k limit 1""")
def best_k_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    ks = sorted(ANCHORS)
    scores = in_parallel([lambda k=k: cluster_quality.silhouette_sq(
        labelled(spark, sf_dir, k), CLUSTER_COLUMNS, "cluster").first()[0] for k in ks])
    table = spark.createDataFrame(list(zip(ks, scores)), "k int, silhouette double")
    return rounded(ranking.best_k_select(table), "silhouette")


_PER_METRIC_SQL = _BEST_K_SQL + ", " + ", ".join(
    ", ".join((calinski_sql(f"c{k}", CLUSTER_COLUMNS, f"h{k}"),
               davies_sql(f"l{k}", f"c{k}", CLUSTER_COLUMNS, f"b{k}")))
    for k in sorted(ANCHORS)) + ", scores as (" + " union all ".join(
    f"""select 'k={k}' as model, {i} as position, silhouette, calinski_harabasz, davies_bouldin
  from s{k}, h{k}, b{k}""" for i, k in enumerate(sorted(ANCHORS))) + ")"


def clustering_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality metrics of the fixed clusterings, evaluated side by side."""
    ks = sorted(ANCHORS)
    rows = in_parallel([lambda k=k: cluster_quality.quality_row(
        labelled(spark, sf_dir, k), CLUSTER_COLUMNS, "cluster") for k in ks])
    names = ["silhouette", "calinski_harabasz", "davies_bouldin"]
    return spark.createDataFrame(
        [(f"k={k}", i, *[r[n] for n in names]) for i, (k, r) in enumerate(zip(ks, rows))],
        "model string, position int, " + ", ".join(f"{n} double" for n in names))


@query("best_per_metric", _PER_METRIC_SQL + " " + " union all ".join(
    f"""select metric, model, round(score, 6) as score from (select '{m}' as metric, model, {m} as score,
  row_number() over (order by {m} {'desc' if up else 'asc'}, position) as rn from scores) where rn = 1"""
    for m, up in (("silhouette", True), ("calinski_harabasz", True), ("davies_bouldin", False))))
def best_per_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = ranking.best_per_metric(
        clustering_scores(spark, sf_dir),
        {"silhouette": True, "calinski_harabasz": True, "davies_bouldin": False})
    return rounded(best, "score")
