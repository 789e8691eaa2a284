"""Casts, filters, projections, feature columns and the refinement chains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwell.catalog.ingest import trip_csv
from tripwell.catalog.registry import query
from tripwell.catalog.trips import (
    CLUSTER_COLUMNS, INDICATOR_SQL, KEYS, SILVER_SQL, TIME_SQL, TRIP_COLUMNS, TRIPS_SQL, ZONES_SQL,
    bronze, labelled, label_sql, silver, text_columns_sql, trips, zones)
from tripwell.functions.indicators import indicators
from tripwell.functions.timeparts import duration_minutes, is_weekend, pickup_hour, weekday
from tripwell.operators import cleaning, encoding, projection, scaling
from tripwell.operators.quantiles import filter_quantile_band
from tripwell.plans.refine import add_time_features, cleaning_pipeline, silver_pipeline
from tripwell.sources.readers import scan_csv_header

TEXTS_SQL = f"{TRIPS_SQL}, texts as ({text_columns_sql('trips')})"
_KEYS = ", ".join(KEYS)


def _typed_sql(columns, target: str) -> str:
    return ", ".join(f"try_cast({c} as {target}) as {c}" for c in columns)


def _round6(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# ---- casts -----------------------------------------------------------------

@query("cast_double_columns",
       f"with {TEXTS_SQL} select {_KEYS}, {_typed_sql(cleaning.DOUBLE_COLUMNS, 'double')} from texts")
def cast_double_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cast_double_columns(bronze(spark, sf_dir)).select(*KEYS, *cleaning.DOUBLE_COLUMNS)


_NARROW_SQL = (", ".join(f"try_cast(try_cast({c} as double) as integer) as {c}"
                         for c in cleaning.INT_COLUMNS)
               + ", " + ", ".join(f"round(try_cast({c} as float)::double, 2) as {c}"
                                  for c in cleaning.FLOAT_COLUMNS) + ", store_and_fwd_flag")


@query("cast_int_float_string", f"with {TEXTS_SQL} select {_KEYS}, {_NARROW_SQL} from texts")
def cast_int_float_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = cleaning.cast_int_float_string(bronze(spark, sf_dir))
    # Single precision shows as cents so that both engines print the same value.
    return narrow.select(*KEYS, *cleaning.INT_COLUMNS, *cleaning.STRING_COLUMNS, *[
        F.round(F.col(c).cast("double"), 2).alias(c) for c in cleaning.FLOAT_COLUMNS])


@query("cast_all_features_double", "select " + ", ".join(
    f"cast({c} as double) as {c}" for c in ("l_linenumber", "l_quantity", "l_extendedprice",
                                           "l_discount", "l_tax", "l_partkey", "l_suppkey",
                                           "l_orderkey")) + " from lineitem")
def cast_all_features_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    names = projection.numeric_columns(df, excluded=())
    return cleaning.cast_double_columns(df, names).select(*names)


@query("parse_timestamp_ampm", f"""with {TEXTS_SQL} select {_KEYS},
  try_strptime(tpep_pickup_datetime, '%m/%d/%Y %I:%M:%S %p') as tpep_pickup_datetime,
  try_strptime(tpep_dropoff_datetime, '%m/%d/%Y %I:%M:%S %p') as tpep_dropoff_datetime,
  try_strptime(trip_distance, '%m/%d/%Y %I:%M:%S %p') is null as other_text_is_null from texts""")
def parse_timestamp_ampm(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bronze(spark, sf_dir)
    return (cleaning.parse_timestamps(raw, [*cleaning.TIMESTAMP_COLUMNS, "trip_distance"])
            .select(*KEYS, *cleaning.TIMESTAMP_COLUMNS,
                    F.col("trip_distance").isNull().alias("other_text_is_null")))


# ---- filters ---------------------------------------------------------------

def _nan_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed trips whose fare is NaN where the distance is zero."""
    return trips(spark, sf_dir).withColumn(
        "fare_amount", F.when(F.col("trip_distance") == 0, F.lit(float("nan")))
        .otherwise(F.col("fare_amount")))


@query("drop_nulls_critical", f"""with {TRIPS_SQL} select * from trips
where passenger_count is not null and trip_distance <> 0""")
def drop_nulls_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_nulls(_nan_trips(spark, sf_dir), cleaning.CRITICAL_COLUMNS)


@query("drop_nulls_subset_b", f"""with {TRIPS_SQL} select * from trips
where passenger_count is not null and store_and_fwd_flag is not null""")
def drop_nulls_subset_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_nulls(trips(spark, sf_dir), cleaning.REQUIRED_COLUMNS)


@query("drop_nulls_any", f"with {SILVER_SQL} select * from silver where pickup_zone is not null")
def drop_nulls_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_nulls(silver(spark, sf_dir), None)


@query("filter_logical", f"""with {TRIPS_SQL}, timed as (select *, {TIME_SQL} from trips)
select * from timed where trip_duration_min > 0 and trip_distance > 0 and fare_amount > 0""")
def filter_logical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.filter_logical(add_time_features(trips(spark, sf_dir)))


@query("filter_plot_bounds", f"""with {SILVER_SQL}
select trip_distance, fare_amount, trip_duration_min from silver
where trip_distance < 50 and fare_amount < 150""")
def filter_plot_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.filter_below(silver(spark, sf_dir).select(*CLUSTER_COLUMNS),
                                 {"trip_distance": 50.0, "fare_amount": 150.0})


@query("filter_quantile_band", f"""with {SILVER_SQL}, bounds as (
  select quantile_cont(fare_amount, 0.01) as low, quantile_cont(fare_amount, 0.99) as high from silver)
select {_KEYS}, fare_amount from silver
where fare_amount >= (select low from bounds) and fare_amount <= (select high from bounds)""")
def quantile_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_quantile_band(silver(spark, sf_dir).select(*KEYS, "fare_amount"), "fare_amount")


# ---- projections -----------------------------------------------------------

@query("rename_drop", f"""with {ZONES_SQL}
select "Borough" as pickup_borough, "Zone" as pickup_zone from zones""")
def rename_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.rename_drop(zones(spark, sf_dir), ["LocationID", "service_zone"],
                                  {"Borough": "pickup_borough", "Zone": "pickup_zone"})


_SAFE = [c for c in TRIP_COLUMNS if c not in projection.LEAKAGE_COLUMNS]


@query("project_exclude_leakage",
       f"with {TRIPS_SQL} select {_KEYS}, {', '.join(_SAFE)} from trips")
def project_exclude_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.project_exclude(trips(spark, sf_dir))


@query("project_numeric_by_type", f"""with {TRIPS_SQL}
select {_KEYS}, "VendorID", passenger_count, trip_distance, "RatecodeID", payment_type from trips""")
def project_numeric_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trips(spark, sf_dir)
    return df.select(*projection.numeric_columns(df, projection.LEAKAGE_COLUMNS))


@query("project_available", f"""with {TRIPS_SQL} select trip_distance, passenger_count from trips""")
def project_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trips(spark, sf_dir)
    return df.select(*projection.available_columns(df))


_REST = ", ".join(c for c in projection.MODEL_FEATURES
                  if c not in ("trip_duration_min", "passenger_count", "trip_distance"))


@query("override_literals", f"""with {SILVER_SQL} select {_KEYS}, {_REST},
  10.0::double as trip_duration_min, 2.0::double as passenger_count, 20.0::double as trip_distance
from silver""")
def override_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver(spark, sf_dir).select(*KEYS, *projection.MODEL_FEATURES)
    return projection.override_literals(
        rows, {"trip_duration_min": 10.0, "passenger_count": 2.0, "trip_distance": 20.0})


@query("add_constant_column", f"""with {SILVER_SQL}
select {_KEYS}, trip_distance, 0.0::double as fare_amount from silver""")
def add_constant_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.override_literals(silver(spark, sf_dir).select(*KEYS, "trip_distance"),
                                        {"fare_amount": 0.0})


_NAMED = ("VendorID_1", "payment_type_2", "store_and_fwd_flag_N")


@query("map_values_lookup", f"""with {SILVER_SQL}, long as (
  select 'VendorID_1' as feature_name, "VendorID_1" as v from silver
  union all select 'payment_type_2', payment_type_2 from silver
  union all select 'store_and_fwd_flag_N', "store_and_fwd_flag_N" from silver)
select case feature_name when 'VendorID_1' then 'Vendor 1' when 'payment_type_2' then 'Payment: Cash'
  else feature_name end as display_name, count(*) as trips from long where v = 1 group by 1""")
def map_values_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = F.array(*[F.when(F.col(c) == 1, F.lit(c)) for c in _NAMED])
    long = silver(spark, sf_dir).select(F.explode(F.array_compact(cells)).alias("feature_name"))
    named = long.withColumn("display_name", projection.map_values(
        F.col("feature_name"), projection.FEATURE_LABELS))
    return named.groupBy("display_name").agg(F.count(F.lit(1)).alias("trips"))


# ---- scalar features -------------------------------------------------------

@query("time_features", f"""with {TRIPS_SQL} select {_KEYS},
  cast(hour(tpep_pickup_datetime) as integer) as pickup_hour,
  cast(dayofweek(tpep_pickup_datetime) + 1 as integer) as day_of_week,
  cast(hour(tpep_pickup_datetime) as double) as pickup_hour_double,
  cast(dayofweek(tpep_pickup_datetime) + 1 as double) as day_of_week_double from trips""")
def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = pickup_hour(F.col("tpep_pickup_datetime"))
    day = weekday(F.col("tpep_pickup_datetime"))
    return trips(spark, sf_dir).select(
        *KEYS, hour.alias("pickup_hour"), day.alias("day_of_week"),
        hour.cast("double").alias("pickup_hour_double"), day.cast("double").alias("day_of_week_double"))


def _weekend(spark: SparkSession, sf_dir: str, rule: str) -> DataFrame:
    day = weekday(F.col("tpep_pickup_datetime"))
    return trips(spark, sf_dir).select(*KEYS, is_weekend(day, rule).alias("is_weekend"))


@query("is_weekend_ge6", f"""with {TRIPS_SQL} select {_KEYS},
  case when dayofweek(tpep_pickup_datetime) in (5, 6) then 1.0::double else 0.0::double end as is_weekend
from trips""")
def is_weekend_ge6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekend(spark, sf_dir, "ge6")


@query("is_weekend_1_7", f"""with {TRIPS_SQL} select {_KEYS},
  case when dayofweek(tpep_pickup_datetime) in (0, 6) then 1.0::double else 0.0::double end as is_weekend
from trips""")
def is_weekend_1_7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekend(spark, sf_dir, "calendar")


@query("duration_minutes", f"""with {TRIPS_SQL} select {_KEYS},
  (epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60.0::double as trip_duration_min
from trips""")
def duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).select(*KEYS, duration_minutes(
        F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")).alias("trip_duration_min"))


@query("manual_one_hot", f"with {TRIPS_SQL} select {_KEYS}, {INDICATOR_SQL} from trips")
def manual_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = indicators()
    return trips(spark, sf_dir).select(*KEYS, *[c.alias(n) for n, c in made.items()])


_ASSEMBLED = ("trip_distance", "passenger_count", "fare_amount")


@query("vector_assemble", f"""with {TRIPS_SQL} select {_KEYS}, trip_distance as x0,
  cast(passenger_count as double) as x1, fare_amount as x2 from trips
where passenger_count is not null and trip_distance <> 0""")
def vector_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = encoding.vector_assemble(_nan_trips(spark, sf_dir), _ASSEMBLED)
    return encoding.vector_columns(vectors.select(*KEYS, "features"), "features", ["x0", "x1", "x2"])


_SCALED = ("trip_distance", "fare_amount", "trip_duration_min", "improvement_surcharge")


def _scale_sql(function: str) -> str:
    parts = []
    for c in _SCALED:
        spread = f"(select {function}({c}) from silver)"
        parts.append(f"round(case when {spread} = 0 then 0.0::double else "
                     f"({c} - (select avg({c}) from silver)) / {spread} end, 6) + 0.0 as {c}_scaled")
    return f"with {SILVER_SQL} select {_KEYS}, {', '.join(parts)} from silver"


@query("standard_scale", _scale_sql("stddev_samp"))
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver(spark, sf_dir).select(*KEYS, *_SCALED)
    names = [f"{c}_scaled" for c in _SCALED]
    scaled = encoding.vector_columns(encoding.vector_scale(rows, _SCALED), "features", names)
    return scaled.select(*KEYS, *[(F.round(n, 6) + 0.0).alias(n) for n in names])


@query("standard_scale_pop", _scale_sql("stddev_pop"))
def standard_scale_pop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver(spark, sf_dir).select(*KEYS, *_SCALED)
    scaled = scaling.standard_scale(rows, _SCALED, population=True)
    return scaled.select(*KEYS, *[(F.round(f"{c}_scaled", 6) + 0.0).alias(f"{c}_scaled") for c in _SCALED])


_INVERSE = ", ".join(
    f"round(avg(({c} - (select avg({c}) from silver)) / (select stddev_pop({c}) from silver))"
    f" * (select stddev_pop({c}) from silver) + (select avg({c}) from silver), 6) as {c}"
    for c in CLUSTER_COLUMNS)


@query("inverse_scale", f"""with {SILVER_SQL}, {label_sql()}
select cluster, {_INVERSE} from labelled group by cluster""")
def inverse_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled(spark, sf_dir)
    scaled = scaling.standard_scale(rows, CLUSTER_COLUMNS, population=True)
    centers = scaled.groupBy("cluster").agg(
        *[F.avg(f"{c}_scaled").alias(f"{c}_scaled") for c in CLUSTER_COLUMNS])
    back = scaling.inverse_scale(centers, silver(spark, sf_dir), CLUSTER_COLUMNS)
    return _round6(back.select("cluster", *CLUSTER_COLUMNS), CLUSTER_COLUMNS)


_INDEX_SQL = """{c}_rank as (select cast({c} as varchar) as {c}_value,
  cast(row_number() over (order by count(*) desc, cast({c} as varchar)) - 1 as double) as {c}_idx
  from trips where {c} is not null group by cast({c} as varchar))"""
_INDEX_CTES = ", ".join(_INDEX_SQL.format(c=c) for c in encoding.CATEGORY_COLUMNS)
_INDEX_JOINS = " ".join(f"left join {c}_rank on cast(t.{c} as varchar) = {c}_value"
                        for c in encoding.CATEGORY_COLUMNS)
_INDEX_COLS = ", ".join(f"coalesce({c}_idx, (select count(*)::double from {c}_rank)) as {c}_idx"
                        for c in encoding.CATEGORY_COLUMNS)


@query("string_index", f"""with {TRIPS_SQL}, {_INDEX_CTES}
select {_KEYS}, {_INDEX_COLS} from trips t {_INDEX_JOINS}""")
def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trips(spark, sf_dir).select(*KEYS, *encoding.CATEGORY_COLUMNS)
    return encoding.string_index(rows, encoding.CATEGORY_COLUMNS).drop(*encoding.CATEGORY_COLUMNS)


_OHE_COLS = ", ".join(
    f"case when coalesce(payment_type_idx, (select count(*)::double from payment_type_rank)) = {i}"
    f" then 1.0::double else 0.0::double end as payment_type_ohe_{i}" for i in range(6)) + ", " + ", ".join(
    f"case when coalesce(store_and_fwd_flag_idx, (select count(*)::double from store_and_fwd_flag_rank)) = {i}"
    f" then 1.0::double else 0.0::double end as store_and_fwd_flag_ohe_{i}" for i in range(3))


@query("one_hot_encode", f"""with {TRIPS_SQL}, {_INDEX_CTES}
select {_KEYS}, {_OHE_COLS} from trips t {_INDEX_JOINS}""")
def one_hot_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["payment_type", "store_and_fwd_flag"]
    out = encoding.one_hot_encode(trips(spark, sf_dir).select(*KEYS, *columns), columns)
    out = encoding.vector_columns(out, "payment_type_ohe", [f"payment_type_ohe_{i}" for i in range(6)])
    out = encoding.vector_columns(out, "store_and_fwd_flag_ohe",
                                  [f"store_and_fwd_flag_ohe_{i}" for i in range(3)])
    return out.drop(*columns, *[f"{c}_idx" for c in columns])


@query("feature_pipeline")
def feature_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = cleaning_pipeline(trips(spark, sf_dir))
    timed = cleaned.withColumns({
        "pickup_hour": pickup_hour(F.col("tpep_pickup_datetime")),
        "day_of_week": weekday(F.col("tpep_pickup_datetime")),
        "trip_duration_min": duration_minutes(F.col("tpep_pickup_datetime"),
                                              F.col("tpep_dropoff_datetime"))})
    timed = timed.withColumn("is_weekend", is_weekend(F.col("day_of_week")).cast("int"))
    _, out = encoding.feature_pipeline(timed)
    vectors = [f.name for f in out.schema.fields if f.dataType.typeName() == "udt"
               or not isinstance(f.dataType, T.AtomicType)]
    return out.withColumns({v: encoding.vector_to_array(v) for v in vectors})


# ---- whole chains ----------------------------------------------------------

@query("drop_duplicates", f"with {TRIPS_SQL} select distinct * from trips")
def drop_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_duplicates(trips(spark, sf_dir))


@query("volume_reduction", f"""with {TRIPS_SQL}, kept as (select * from trips
  where passenger_count is not null and store_and_fwd_flag is not null)
select (select count(*) from trips) as rows_read,
  (select count(*) from trips) - (select count(*) from kept) as dropped_nulls,
  (select count(*) from kept) - (select count(*) from (select distinct * from kept)) as dropped_duplicates,
  (select count(*) from (select distinct * from kept)) as rows_kept""")
def volume_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.volume_reduction(trips(spark, sf_dir))


@query("silver_pipeline", f"with {SILVER_SQL} select * from silver")
def silver_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_pipeline(bronze(spark, sf_dir), zones(spark, sf_dir))


_CLEANED = ", ".join(
    [f'cast("{c}" as integer) as "{c}"' for c in cleaning.INT_COLUMNS]
    + [f"round(cast(cast({c} as decimal(14,2)) as float)::double, 2) as {c}" for c in cleaning.FLOAT_COLUMNS])


@query("cleaning_pipeline", f"""with {TRIPS_SQL} select distinct {_KEYS},
  tpep_pickup_datetime, tpep_dropoff_datetime, store_and_fwd_flag, {_CLEANED} from trips
where passenger_count is not null and store_and_fwd_flag is not null""")
def cleaning_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every column is cast explicitly, so reading text spares the inference pass.
    raw = scan_csv_header(spark, trip_csv(spark, sf_dir))
    raw = raw.withColumns({k: F.col(k).cast("bigint") for k in KEYS}).withColumn(
        "l_linenumber", F.col("l_linenumber").cast("int"))
    out = cleaning_pipeline(raw)
    return out.withColumns({c: F.round(F.col(c).cast("double"), 2) for c in cleaning.FLOAT_COLUMNS})
