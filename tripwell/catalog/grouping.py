"""Clustering and its quality."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwell.catalog.ingest import rounded
from tripwell.catalog.registry import query
from tripwell.catalog.summaries import calinski_sql, centers_sql, davies_sql, silhouette_sql
from tripwell.catalog.trips import (
    ANCHORS, CLUSTER_COLUMNS, KEYS, SILVER_SQL, labelled, label_sql, once, silver, sql_unit)
from tripwell.operators import cluster_quality, clustering, scaling
from tripwell.operators.bounded import cached, cached_if_few
from tripwell.operators.packed_means import FEW_ROWS
from tripwell.plans.personas import personas_pipeline
from tripwell.sources.storage import store

_KEYS = ", ".join(KEYS)
SCALED = [f"{c}_scaled" for c in CLUSTER_COLUMNS]


def cluster_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).select(*KEYS, *CLUSTER_COLUMNS)


def scaled_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance, fare and duration standardised with the population deviation."""
    scaled = scaling.standard_scale(cluster_input(spark, sf_dir), CLUSTER_COLUMNS, population=True)
    return scaled.select(*KEYS, *SCALED)


@query("kmeans_search")
def kmeans_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cached_if_few(clustering.scaled_vectors(cluster_input(spark, sf_dir)).select("features"), FEW_ROWS)
    try:
        trials = clustering.kmeans_search(vectors)
    finally:
        vectors.unpersist()
    best = clustering.best_trial(trials)
    return spark.createDataFrame(
        [(t.k, float(t.silhouette), float(t.cost), t.k == best.k) for t in trials],
        "k int, silhouette double, training_cost double, chosen boolean")


def _assignment_summary(model, vectors: DataFrame, centers: list) -> DataFrame:
    """Centers, sizes and mean features per cluster of a fitted model."""
    sizes = model.transform(vectors).groupBy("prediction").agg(
        F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(f"avg_{c}") for c in CLUSTER_COLUMNS])
    table = clustering.centers_frame(vectors.sparkSession, np.array(centers), SCALED)
    return (F.broadcast(table).join(sizes, F.col("cluster") == F.col("prediction"), "left")
            .drop("prediction").na.fill(0, ["size"]))


@query("bisecting_kmeans")
def bisecting_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cluster_input(spark, sf_dir)
    vectors = clustering.scaled_vectors(rows, centered=False)
    model = clustering.fit_bisecting(vectors.select("features"))
    offset = rows.agg(*[F.avg(c) / F.stddev_samp(c) for c in CLUSTER_COLUMNS]).first()
    return _assignment_summary(model, vectors, [c - np.array(offset) for c in model.clusterCenters()])


@query("gaussian_mixture")
def gaussian_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = clustering.scaled_vectors(cluster_input(spark, sf_dir))
    fit_input = cached(vectors.select("features"))
    try:
        model = clustering.fit_gaussian_mixture(fit_input)
    finally:
        fit_input.unpersist()
    means = [list(g.mean) for g in model.gaussians]
    extra = spark.createDataFrame(
        [(i, float(w), [float(x) for x in g.cov.toArray().ravel()])
         for i, (w, g) in enumerate(zip(model.weights, model.gaussians))],
        "cluster int, weight double, covariance array<double>")
    return _assignment_summary(model, vectors, means).join(F.broadcast(extra), "cluster")


# Rounds spelled out in SQL: enough to stand still on the samples that are compared.
_LLOYD_ROUNDS = 40


def _lloyd_sql() -> str:
    scaled = ", ".join(f"({c} - (select avg({c}) from silver)) / (select stddev_pop({c}) from silver)"
                       f" as {c}_scaled" for c in CLUSTER_COLUMNS)
    xs = ", ".join(SCALED)
    steps = [f"with {SILVER_SQL}, points as materialized (select {_KEYS}, {scaled} from silver)",
             f"""c0 as materialized (select row_number() over (order by u) - 1 as cluster, {xs} from (
  select {xs}, min({sql_unit(KEYS)}) as u from points group by {xs} order by u limit 5))"""]
    gap = " + ".join(f"(p.{x} - c.{x}) * (p.{x} - c.{x})" for x in SCALED)
    for i in range(_LLOYD_ROUNDS):
        means = ", ".join(f"coalesce(m.{x}, c.{x}) as {x}" for x in SCALED)
        steps.append(f"""a{i} as materialized (select {xs}, cluster, d from (
  select p.*, c.cluster, {gap} as d,
    row_number() over (partition by p.id order by {gap}, c.cluster) as rn
  from (select *, row_number() over () as id from points) p, c{i} c) where rn = 1)""")
        steps.append(f"""m{i} as materialized (select cluster, count(*) as n, {', '.join(f'avg({x}) as {x}' for x in SCALED)}
  from a{i} group by cluster)""")
        steps.append(f"""c{i + 1} as materialized (select c.cluster, {means} from c{i} c left join m{i} m using (cluster))""")
    last = _LLOYD_ROUNDS - 1
    return ", ".join(steps) + f""" select cast(cluster as integer) as cluster,
  {', '.join(f'round({x}, 6) as {x}' for x in SCALED)},
  (select round(sum(d), 3) from a{last}) as cost from c{_LLOYD_ROUNDS}"""


@query("lloyd_kmeans", _lloyd_sql())
def lloyd_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = clustering.lloyd_kmeans(scaled_input(spark, sf_dir), SCALED, KEYS, k=5,
                                  max_iter=1000, tol=1e-9)
    centers = clustering.centers_frame(spark, run.centers, SCALED)
    return rounded(centers, *SCALED).withColumn("cost", F.round(F.lit(run.cost), 3))


@query("kmeans_assign", f"""with {SILVER_SQL}, {label_sql()}
select {_KEYS}, cluster, round(distance_sq, 6) as distance_sq from labelled""")
def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(labelled(spark, sf_dir).select(*KEYS, "cluster", "distance_sq"), "distance_sq")


@query("kmeans_restarts")
def kmeans_restarts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cached_if_few(clustering.scaled_vectors(cluster_input(spark, sf_dir)).select("features"), FEW_ROWS)
    try:
        trials = clustering.kmeans_restarts(vectors)
    finally:
        vectors.unpersist()
    best = min(range(len(trials)), key=lambda i: trials[i].cost)
    return spark.createDataFrame([(i, float(t.cost), i == best) for i, t in enumerate(trials)],
                                 "restart int, training_cost double, chosen boolean")


@query("cluster_stability")
def cluster_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifts = clustering.cluster_stability(scaled_input(spark, sf_dir), SCALED, KEYS)
    summary = clustering.stability_summary(shifts)
    nearest = clustering.stability_summary(shifts, "shift_nearest")
    return summary.select(F.lit("sorted").alias("alignment"), "*").unionByName(
        nearest.select(F.lit("nearest").alias("alignment"), "*"))


def _hour_centers(spark: SparkSession, sf_dir: str, weekend: float) -> DataFrame:
    return (silver(spark, sf_dir).filter(F.col("is_weekend") == weekend)
            .groupBy(F.col("payment_type").alias("cluster"))
            .agg(*[F.avg(c).alias(c) for c in CLUSTER_COLUMNS]))


_RANKED = "{name} as (" + " union all ".join(
    f"select '{c}' as f, row_number() over (order by x) as i, x from (select avg({c}) as x from silver"
    " where is_weekend = {w} group by payment_type)" for c in CLUSTER_COLUMNS) + ")"
_NEAREST = " + ".join(f"(a.{c} - b.{c}) ** 2" for c in CLUSTER_COLUMNS)
_CENTERS = "select payment_type as cluster, " + ", ".join(
    f"avg({c}) as {c}" for c in CLUSTER_COLUMNS) + " from silver where is_weekend = {w} group by 1"


@query("center_shift", f"""with {SILVER_SQL}, {_RANKED.format(name='ra', w=0)}, {_RANKED.format(name='rb', w=1)},
ca as ({_CENTERS.format(w=0)}), cb as ({_CENTERS.format(w=1)}),
s as (select avg(d) as shift_sorted from (
  select sqrt(sum((ra.x - rb.x) ** 2)) as d from ra join rb using (f, i) group by i)),
n as (select avg(d) as shift_nearest from (
  select a.cluster, min(sqrt({_NEAREST})) as d from ca a, cb b group by a.cluster))
select round(shift_sorted, 6) as shift_sorted, round(shift_nearest, 6) as shift_nearest from s, n""")
def center_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift = clustering.center_shift(_hour_centers(spark, sf_dir, 0.0), _hour_centers(spark, sf_dir, 1.0),
                                    CLUSTER_COLUMNS)
    return rounded(shift, "shift_sorted", "shift_nearest")


@query("personas_pipeline")
def personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personas_pipeline(silver(spark, sf_dir).select(*CLUSTER_COLUMNS))


# ---- quality ---------------------------------------------------------------

_CENTER_SQL = f"with {SILVER_SQL}, {label_sql()}, {centers_sql('labelled', 'centers', CLUSTER_COLUMNS)}"


def _scaled_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = scaling.standard_scale(labelled(spark, sf_dir), CLUSTER_COLUMNS)
    return scaled.select(*KEYS, *SCALED, "cluster")


_SCALED_SQL = ", ".join(f"({c} - (select avg({c}) from silver)) / (select stddev_samp({c}) from silver)"
                        f" as {c}_scaled" for c in CLUSTER_COLUMNS)


@query("silhouette_sq", f"""with {SILVER_SQL}, {label_sql()},
scaled as (select cluster, {_SCALED_SQL} from labelled), {centers_sql('scaled', 'centers', SCALED)},
{silhouette_sql('scaled', 'centers', SCALED, 'score')} select round(silhouette, 6) as silhouette from score""")
def silhouette_sq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cluster_quality.silhouette_sq(_scaled_labels(spark, sf_dir), SCALED, "cluster"),
                   "silhouette")


def euclid_sql(source: str, name: str, columns: list[str], points: int = cluster_quality.SILHOUETTE_POINTS) -> str:
    """Euclidean silhouette among all rows or a sample that is stratified by cluster, first in hash order."""
    gap = " + ".join(f"(p.{c} - q.{c}) * (p.{c} - q.{c})" for c in columns)
    part = "n / (select sum(n) from {0}_sizes)".format(name)
    return f"""{name}_sizes as (select cluster, count(*) as n from {source} group by cluster),
{name}_points as (select *, row_number() over () as id from (
  select * from {source} join {name}_sizes using (cluster)
  qualify (select sum(n) from {name}_sizes) <= {points}
    or row_number() over (partition by cluster order by {sql_unit(KEYS)}, {_KEYS})
      <= greatest(ceil({points} * n / (select sum(n) from {name}_sizes)), least(n, {cluster_quality.LEAST_POINTS}, {points} // (select count(*) from {name}_sizes))))),
{name}_sums as (select p.id, p.cluster as own, q.cluster, sum(sqrt({gap})) as total, count(*) as m
  from {name}_points p, {name}_points q group by all),
{name}_gaps as (select id, own, max(case when own = cluster and m > 1 then total / (m - 1) end) as a,
  min(case when own <> cluster then total / m end) as b from {name}_sums group by id, own),
{name}_scores as (select own as cluster, avg(s) as mean, coalesce(var_samp(s), 0) as var, count(*) as m from (
  select own, case when a is null or greatest(a, b) = 0 then 0 else (b - a) / greatest(a, b) end as s from {name}_gaps) group by own),
{name} as (select sum({part} * mean) as silhouette, sum(m)::bigint as points,
  sqrt(sum({part} * {part} * var / m * (1 - m / n))) as standard_error from {name}_scores join {name}_sizes using (cluster))"""


@query("silhouette_euclid", f"""with {SILVER_SQL}, {label_sql()}, {euclid_sql('labelled', 'score', CLUSTER_COLUMNS)}
select round(silhouette, 6) as silhouette, points, round(standard_error, 6) as standard_error from score""")
def silhouette_euclid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cluster_quality.silhouette_euclid(labelled(spark, sf_dir), CLUSTER_COLUMNS, "cluster", KEYS),
                   "silhouette", "standard_error")


def _table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_quality.cluster_table(labelled(spark, sf_dir), CLUSTER_COLUMNS, "cluster")


@query("calinski_harabasz", f"""{_CENTER_SQL}, {calinski_sql('centers', CLUSTER_COLUMNS, 'score')}
select round(calinski_harabasz, 6) as calinski_harabasz from score""")
def calinski_harabasz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cluster_quality.calinski_harabasz(_table(spark, sf_dir), CLUSTER_COLUMNS),
                   "calinski_harabasz")


@query("davies_bouldin", f"""{_CENTER_SQL}, {davies_sql('labelled', 'centers', CLUSTER_COLUMNS, 'score')}
select round(davies_bouldin, 6) as davies_bouldin from score""")
def davies_bouldin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cluster_quality.davies_bouldin(labelled(spark, sf_dir), CLUSTER_COLUMNS, "cluster"),
                   "davies_bouldin")


@query("wssse", f"{_CENTER_SQL} select round(sum(n * v), 3) as wssse from centers")
def wssse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cluster_quality.wssse(_table(spark, sf_dir)), "wssse", digits=3)


@query("cluster_entropy", f"""{_CENTER_SQL}
select round(-sum(n / (select sum(n) from centers)::double * ln(n / (select sum(n) from centers)::double)), 6)
  as entropy from centers""")
def cluster_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cluster_quality.cluster_entropy(_table(spark, sf_dir)), "entropy")


_REPORT_METRICS = ("silhouette", "standard_error", "calinski_harabasz", "davies_bouldin", "wssse", "entropy")


def _report_sql() -> str:
    parts, rows = [f"with {SILVER_SQL}"], []
    for i, k in enumerate(sorted(ANCHORS)):
        parts += [label_sql(k, f"l{k}"), centers_sql(f"l{k}", f"c{k}", CLUSTER_COLUMNS),
                  euclid_sql(f"l{k}", f"e{k}", CLUSTER_COLUMNS), calinski_sql(f"c{k}", CLUSTER_COLUMNS, f"h{k}"),
                  davies_sql(f"l{k}", f"c{k}", CLUSTER_COLUMNS, f"b{k}"),
                  f"""t{k} as (select sum(n) as total, count(*) as k, sum(n * v) as wssse,
  -sum(n / (select sum(n) from c{k})::double * ln(n / (select sum(n) from c{k})::double)) as entropy,
  string_agg(label || ':' || n, ',' order by label) as sizes from c{k})"""]
        rows.append(f"""select {i}::integer as position, 'k={k}' as model, k::bigint as k, total::bigint as n_rows,
  points as silhouette_points, {', '.join(f'round({m}, {3 if m == "wssse" else 6}) as {m}' for m in _REPORT_METRICS)},
  sizes from e{k}, h{k}, b{k}, t{k}""")
    return ", ".join(parts) + " " + " union all ".join(rows)


@query("cluster_report", _report_sql())
def cluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of clusterings by fixed centers, which SQL can repeat; see also ``fitted_cluster_report``."""
    models = {f"k={k}": labelled(spark, sf_dir, k) for k in sorted(ANCHORS)}
    report = cluster_quality.cluster_report(models, CLUSTER_COLUMNS, "cluster", KEYS)
    sizes = F.array_join(F.transform("sizes", lambda s: F.concat(s["cluster"], F.lit(":"), s["size"])), ",")
    return rounded(rounded(report.withColumn("sizes", sizes), *(m for m in _REPORT_METRICS if m != "wssse")),
                   "wssse", digits=3)


# ---- fitted models ---------------------------------------------------------

def fitted_labels(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Stored trips labelled by the best K-Means, the bisecting or the mixture model."""
    def build() -> DataFrame:
        rows = cluster_input(spark, sf_dir)
        vectors = clustering.scaled_vectors(rows, centered=kind != "bisecting")
        # The mixture reads its vectors many times over, the others pack those of large tables.
        fit_input = cached(vectors.select("features")) if kind == "mixture" else cached_if_few(vectors.select("features"), FEW_ROWS)
        try:
            if kind == "kmeans":
                model = clustering.best_trial(clustering.kmeans_search(fit_input)).model
            elif kind == "bisecting":
                model = clustering.fit_bisecting(fit_input)
            else:
                model = clustering.fit_gaussian_mixture(fit_input)
            labels = model.transform(vectors).select(*KEYS, *CLUSTER_COLUMNS, F.col("prediction").alias("cluster"))
            return store(labels, f"labels-{kind}")
        finally:
            fit_input.unpersist()

    return once(spark, sf_dir, f"labels-{kind}", build)


FITTED = ("kmeans", "bisecting", "mixture")


def _register_labels(kind: str) -> None:
    @query(f"clustered_trips_{kind}")
    def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fitted_labels(spark, sf_dir, kind)


for _kind in FITTED:
    _register_labels(_kind)


@query("fitted_cluster_report")
def fitted_cluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted models side by side: clusters, sizes, shares and quality over all rows."""
    models = {kind: fitted_labels(spark, sf_dir, kind) for kind in FITTED}
    return cluster_quality.cluster_report(models, CLUSTER_COLUMNS, "cluster", KEYS)
