"""The physical plans say what the design promises."""

from __future__ import annotations

from tripwell import catalog
from tripwell.catalog.trips import bronze, silver, zones
from tripwell.operators.joins import broadcast_zone_join
from tripwell.plans.refine import silver_pipeline


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_zone_join_broadcasts_a_measured_side(spark, small):
    assert "BroadcastHashJoin" in plan(broadcast_zone_join(bronze(spark, small), zones(spark, small)))


def test_an_oversized_dimension_is_not_hinted(spark, small):
    df = broadcast_zone_join(bronze(spark, small), zones(spark, small), max_broadcast_rows=1)
    assert "hint" not in plan(df).lower()


def test_an_oversized_dimension_reads_the_trips_once(spark, small, monkeypatch):
    from tripwell.operators import joins

    monkeypatch.setattr(joins, "broadcast_if_small", lambda df, n: df)
    text = plan(silver_pipeline(bronze(spark, small), zones(spark, small))).split("== Physical Plan ==")[1]
    assert text.count("bronze-") == 1 and "Python" not in text


def test_silver_has_one_fact_shuffle_and_no_python(spark, small):
    text = plan(silver_pipeline(bronze(spark, small), zones(spark, small))).split("== Physical Plan ==")[1]
    assert "Python" not in text and "Pandas" not in text
    assert text.count("hashpartitioning(") == 2  # the distinct trips and the distinct zones
    assert "BroadcastHashJoin" in text


def test_row_rules_run_below_the_deduplication(spark, small):
    text = plan(silver_pipeline(bronze(spark, small), zones(spark, small))).split("== Physical Plan ==")[1]
    assert text.rindex("Exchange hashpartitioning(") < text.rindex("Filter")


def test_refinement_parses_each_timestamp_once(spark, small):
    text = plan(silver_pipeline(bronze(spark, small), zones(spark, small))).split("== Physical Plan ==")[1]
    assert text.count("gettimestamp(") == 2
    assert text.count("try_cast(fare_amount") == 1


def test_hourly_profile_reads_four_columns(spark, small):
    silver(spark, small)
    text = plan(catalog.queries()["hourly_stats"](spark, small))
    schema = text.split("ReadSchema: struct<")[-1].split(">")[0]
    assert sorted(c.split(":")[0] for c in schema.split(",")) == [
        "fare_amount", "pickup_hour", "trip_distance", "trip_duration_min"]


def test_quantile_band_reaches_the_scan(spark, small):
    text = plan(catalog.queries()["filter_quantile_band"](spark, small))
    assert "GreaterThanOrEqual(fare_amount" in text and "LessThanOrEqual(fare_amount" in text


def test_ingest_stays_in_the_jvm(spark, small):
    for name in ("rows_to_table", "drop_malformed_rows", "cleaning_pipeline"):
        text = plan(catalog.queries()[name](spark, small))
        assert "Python" not in text


def test_shared_tables_are_built_once_by_threads(spark, small):
    from concurrent.futures import ThreadPoolExecutor

    from tripwell.catalog import trips

    built = []
    with ThreadPoolExecutor(4) as pool:
        results = list(pool.map(lambda _: trips.once(spark, small, "threads", lambda: built.append(1) or len(built)), range(8)))
    assert built == [1] and results == [1] * 8


def test_fitted_labels_are_the_nearest_centers(spark, small):
    from pyspark.sql import functions as F

    from tripwell.catalog import grouping
    from tripwell.catalog.trips import CLUSTER_COLUMNS, silver

    rows = grouping.fitted_labels(spark, small, "kmeans")
    assert rows.count() == silver(spark, small).count() and rows.where("cluster is null").count() == 0
    spread = rows.agg(*[F.stddev_samp(c).alias(c) for c in CLUSTER_COLUMNS]).first()
    means = {r["cluster"]: [r[c] for c in CLUSTER_COLUMNS] for r in
             rows.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in CLUSTER_COLUMNS]).collect()}
    near = 0
    points = rows.collect()
    for r in points:
        gaps = {k: sum(((r[c] - x) / spread[c]) ** 2 for c, x in zip(CLUSTER_COLUMNS, m)) for k, m in means.items()}
        near += min(gaps, key=gaps.get) == r["cluster"]
    assert near > 0.99 * len(points)  # the last move of the centers may leave a few rows on a border
