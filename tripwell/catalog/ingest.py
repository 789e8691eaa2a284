"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwell.catalog.registry import query
from tripwell.catalog.trips import (
    ANCHORS, INTEGERS, KEYS, PREDICTED_SQL, SILVER_SQL, TRIP_COLUMNS, TRIPS_SQL, ZONES_SQL, bronze, labelled,
    label_sql, once, predicted, silver, spread, sql_unit, text_columns, text_columns_sql, trips, zones)
from tripwell.operators.aggregates import hourly_stats
from tripwell.operators.bootstrap import rmse_bootstrap_ci
from tripwell.operators.cluster_quality import cluster_size_share
from tripwell.operators.joins import broadcast_zone_join
from tripwell.operators.regression import fit_pipeline, ordinary_least_squares
from tripwell.operators.sampling import sample_exact
from tripwell.sources import readers, sinks
from tripwell.sources.storage import new_path

FIELDS = [*KEYS, *TRIP_COLUMNS]
HEADER = ",".join(FIELDS)


# Planted faults: which trip distance marks which kind of malformed line.
_FAULTS = {"header": "49.00", "surplus": "48.00", "short": "47.00", "quoted": "46.00"}


def _line() -> Column:
    """One trip as a delimited line, some of them malformed on purpose."""
    clean = F.concat_ws(",", *FIELDS)
    mark = F.col("trip_distance")
    return (F.when(mark == _FAULTS["header"], F.lit(HEADER))
            .when(mark == _FAULTS["surplus"], F.concat(clean, F.lit(",surplus")))
            .when(mark == _FAULTS["short"], F.concat_ws(",", *FIELDS[:-1]))
            .when(mark == _FAULTS["quoted"], F.concat(clean, F.lit('"a,b"')))
            .otherwise(clean))


def raw_trip_file(spark: SparkSession, sf_dir: str) -> str:
    """Delimited text of all trips; every part file starts with the header line."""
    def build() -> str:
        path = new_path(spark, "raw-trips")
        lines = text_columns(spread(trips(spark, sf_dir))).select(_line().alias(HEADER))
        # A single column named like the header, unquoted, writes plain lines.
        (lines.write.option("header", "true").option("sep", "\u0001").option("quote", "")
         .option("emptyValue", "").csv(path))
        return path

    return once(spark, sf_dir, "raw-trips", build)


def trip_csv(spark: SparkSession, sf_dir: str) -> str:
    """Well-formed CSV of all trips."""
    def build() -> str:
        path = new_path(spark, "trips-csv")
        bronze(spark, sf_dir).write.option("header", "true").option("emptyValue", "").csv(path)
        return path

    return once(spark, sf_dir, "trips-csv", build)


def zone_csv(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        path = new_path(spark, "zones-csv")
        zones(spark, sf_dir).write.option("header", "true").csv(path)
        return path

    return once(spark, sf_dir, "zones-csv", build)


_CLEAN_SQL = "concat_ws(',', " + ", ".join(FIELDS) + ")"
_RAW_SQL = f"""with {TRIPS_SQL}, texts as ({text_columns_sql('trips')}), raw as (
  select *, case trip_distance when '{_FAULTS['header']}' then '{HEADER}'
     when '{_FAULTS['surplus']}' then {_CLEAN_SQL} || ',surplus'
     when '{_FAULTS['short']}' then concat_ws(',', {', '.join(FIELDS[:-1])})
     when '{_FAULTS['quoted']}' then {_CLEAN_SQL} || '"a,b"'
     else {_CLEAN_SQL} end as line from texts)"""
# A line survives when it is not the header and has as many fields as the header.
_KEPT = f"line <> '{HEADER}' and len(string_split(line, ',')) = {len(FIELDS)}"
_TEXT_FIELDS = ", ".join(f"cast({c} as varchar) as {c}" for c in FIELDS)


@query("scan_text_lines", f"""{_RAW_SQL}
select line as "value" from raw where line <> '{HEADER}'""")
def scan_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Header lines are left out: how many there are depends on the number of part files.
    lines = readers.scan_text_lines(spark, raw_trip_file(spark, sf_dir))
    return lines.filter(F.col("value") != HEADER)


@query("header_schema", f"""select cast(i - 1 as integer) as position, string_split('{HEADER}', ',')[i] as column_name,
  'string' as data_type, true as nullable from range(1, {len(HEADER.split(','))} + 1) t(i)""")
def header_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = readers.scan_text_lines(spark, raw_trip_file(spark, sf_dir))
    schema = readers.header_schema(readers.header_line(lines))
    return spark.createDataFrame([(i, f.name, f.dataType.simpleString(), f.nullable)
                                  for i, f in enumerate(schema.fields)],
                                 "position int, column_name string, data_type string, nullable boolean")


@query("drop_malformed_rows", f"""{_RAW_SQL}
select line as "value", cast(len(string_split(line, ',')) as integer) as field_count
from raw where {_KEPT}""")
def drop_malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.drop_malformed(readers.scan_text_lines(spark, raw_trip_file(spark, sf_dir)), HEADER)
    return rows.select(F.array_join("fields", ",").alias("value"),
                       F.size("fields").alias("field_count"))


@query("rows_to_table", f"{_RAW_SQL} select {_TEXT_FIELDS} from raw where {_KEPT}")
def rows_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.ingest_delimited(spark, raw_trip_file(spark, sf_dir))


@query("scan_csv_header", f"with {ZONES_SQL} select * from zones")
def scan_csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.scan_csv_header(spark, zone_csv(spark, sf_dir))


# What the inference finds in the trip file: whole numbers, decimals, and text (12-hour stamps stay text).
_WHOLE = {*KEYS, *INTEGERS, "PULocationID", "DOLocationID"}
_KEPT_TEXT = {"tpep_pickup_datetime", "tpep_dropoff_datetime", "store_and_fwd_flag"}
_INFERRED = ", ".join(
    f"cast(nullif(cast({c} as varchar), '') as {'integer' if c in _WHOLE else 'varchar' if c in _KEPT_TEXT else 'double'}) as {c}"
    for c in FIELDS)


@query("scan_csv_infer", f"with {TRIPS_SQL}, texts as ({text_columns_sql('trips')}) select {_INFERRED} from texts")
def scan_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.scan_csv_infer(spark, trip_csv(spark, sf_dir))


@query("scan_parquet", "select * from orders")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.scan_parquet(spark, f"{sf_dir}/orders.parquet")


@query("scan_parquet_pruned", "select l_quantity, l_extendedprice, l_discount from lineitem")
def scan_parquet_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.scan_parquet(spark, f"{sf_dir}/lineitem.parquet",
                                ["l_quantity", "l_extendedprice", "l_discount"])


@query("scan_parquet_imposed_schema", """
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, l_linestatus, epoch_us(l_shipdate) as l_shipdate from lineitem""")
def scan_parquet_imposed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.scan_parquet_imposed_schema(spark, f"{sf_dir}/lineitem.parquet")


@query("scan_csv_first_n", f"""with {TRIPS_SQL}, texts as ({text_columns_sql('trips')})
select * from (select {_TEXT_FIELDS} from texts order by {sql_unit(KEYS)}, {', '.join(KEYS)},
 {', '.join(TRIP_COLUMNS)} limit 50000)""")
def scan_csv_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.scan_csv_header(spark, trip_csv(spark, sf_dir)).na.fill("")
    return sample_exact(rows, KEYS, 50_000)


@query("sink_parquet_overwrite", f"with {SILVER_SQL} select * from silver")
def sink_parquet_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "sink-parquet")
    sinks.sink_parquet_overwrite(silver(spark, sf_dir), path)
    return readers.scan_parquet(spark, path)


@query("sink_partition_rerun", f"""with {SILVER_SQL} select {', '.join(KEYS)}, pickup_hour,
  case when pickup_hour = 3 then fare_amount + 1 else fare_amount end as fare_amount from silver""")
def sink_partition_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver by pickup hour, of which one hour is computed anew and replaced."""
    rows = silver(spark, sf_dir).select(*KEYS, "pickup_hour", "fare_amount")
    path = sinks.sink_parquet_overwrite(rows.hint("rebalance", "pickup_hour"), new_path(spark, "hours"), ["pickup_hour"])
    again = rows.where(F.col("pickup_hour") == 3).withColumn("fare_amount", F.col("fare_amount") + 1)
    sinks.overwrite_partitions(again, path, ["pickup_hour"])
    return spark.read.schema(rows.schema).parquet(path)


@query("bucketed_split_means", f"""with {SILVER_SQL} select cast(l_linenumber as integer) as line,
  count(*) as trips, round(avg(s.fare_amount - o.fare), 6) as mean_gap from silver s
  join (select {', '.join(KEYS)}, max(fare_amount) as fare from silver group by all) o using ({', '.join(KEYS)})
  group by 1""")
def bucketed_split_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate by trip joined back to its rows: neither shuffles on the bucketed layout."""
    path, fares = new_path(spark, "bucketed"), silver(spark, sf_dir).select(*KEYS, "fare_amount")
    rows = sinks.store_bucketed(fares, path, "silver_" + path.rsplit("-", 1)[1], KEYS, sinks.bucket_count(fares))
    own = rows.groupBy(*KEYS).agg(F.max("fare_amount").alias("fare")).hint("merge")
    return rounded(rows.join(own, KEYS).groupBy(F.col("l_linenumber").cast("int").alias("line")).agg(
        F.count(F.lit(1)).alias("trips"), F.avg(F.col("fare_amount") - F.col("fare")).alias("mean_gap")), "mean_gap")


HOURLY_SQL = """select pickup_hour, round(avg(fare_amount), 6) as avg_fare,
  round(avg(trip_distance), 6) as avg_dist, round(avg(trip_duration_min), 6) as avg_duration,
  count(*) as trip_count from silver group by pickup_hour order by pickup_hour"""


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("sink_csv_extract", f"with {SILVER_SQL} {HOURLY_SQL}")
def sink_csv_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = rounded(hourly_stats(silver(spark, sf_dir)), "avg_fare", "avg_dist", "avg_duration")
    path = sinks.sink_csv_extract(stats, new_path(spark, "sink-csv"), ["pickup_hour"])
    return spark.read.schema(stats.schema).option("header", "true").csv(path)


def bootstrap_sql(replicates: int, select: str) -> str:
    """Poisson bootstrap of the stored predictions' squared error in SQL."""
    cuts = ("0.367879441171", "0.735758882343", "0.919698602929", "0.981011843124",
            "0.996340153173", "0.999405815182", "0.999916758851", "0.999989750803",
            "0.999998874797")
    lanes = " union all ".join(
        f"select b * 4 + {lane + 1} as replicate, e2, "
        f"('0x' || substr(h, {1 + 8 * lane}, 8))::bigint / 4294967296::double as u from digests"
        for lane in range(4))
    weight = "case " + " ".join(f"when u < {c}::double then {i}" for i, c in enumerate(cuts)) + " else 9 end"
    return f"""with {SILVER_SQL}, {PREDICTED_SQL}, digests as (
  select b, (prediction - fare_amount) * (prediction - fare_amount) as e2,
    md5(concat_ws(':', '42', {', '.join(KEYS)}, b)) as h
  from predicted, range({-(-replicates // 4)}) r(b)),
weighted as (select replicate, e2, {weight} as w from ({lanes}) where replicate <= {replicates}),
replicates as (
  select cast(replicate as integer) as replicate, cast(sum(w) as bigint) as n,
    sqrt(sum(w * e2) / sum(w)) as rmse from weighted group by replicate)
{select}"""


SUMMARY_SQL = """select round(avg(rmse), 6) as mean, round(stddev_pop(rmse), 6) as std,
  round(quantile_cont(rmse, 0.025), 6) as ci_lower, round(quantile_cont(rmse, 0.975), 6) as ci_upper,
  count(*) as n_bootstraps from replicates"""


@query("sink_json_stats", bootstrap_sql(100, SUMMARY_SQL))
def sink_json_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = rounded(rmse_bootstrap_ci(predicted(spark, sf_dir), KEYS, "fare_amount", "prediction"),
                    "mean", "std", "ci_lower", "ci_upper")
    path = sinks.sink_json_stats(stats, new_path(spark, "sink-json"))
    return spark.read.schema(stats.schema).json(path)


@query("sink_metrics_append", f"with {SILVER_SQL}, " + ", ".join(
    f"{label_sql(k, f'labelled_{k}')}" for k in sorted(ANCHORS)) + " " + " union all ".join(
    f"""select 'k={k}' as model, cluster, count(*) as size,
  round(count(*) / (select count(*)::double from labelled_{k}), 6) as share
  from labelled_{k} group by cluster""" for k in sorted(ANCHORS)))
def sink_metrics_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = [rounded(cluster_size_share(labelled(spark, sf_dir, k), "cluster"), "share")
              .select(F.lit(f"k={k}").alias("model"), "*") for k in sorted(ANCHORS)]
    path = sinks.append_metrics_run(blocks, new_path(spark, "sink-metrics"), "1")
    return sinks.read_metrics_runs(spark, path, "1").drop("run", "block")


@query("model_save_load")
def model_save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = ["trip_distance", "trip_duration_min"]
    rows = silver(spark, sf_dir)
    fitted = fit_pipeline(rows, features, ordinary_least_squares())
    loaded = sinks.load_model(spark, sinks.save_model(fitted, new_path(spark, "model")))
    before = fitted.transform(rows).agg(F.avg("prediction")).first()[0]
    after = loaded.transform(rows).agg(F.avg("prediction").alias("p"), F.count("prediction").alias("n"))
    return after.select(F.lit(len(loaded.stages)).alias("stages"), F.col("n").alias("rows_scored"),
                        (F.col("p") == F.lit(before)).alias("same_mean_prediction"))


@query("optional_dimension", f"with {TRIPS_SQL} select * from trips")
def optional_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broadcast_zone_join(trips(spark, sf_dir), None)
