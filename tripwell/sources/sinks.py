"""Writing tables, extracts, records and fitted pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwell.operators.bounded import is_small

BUCKET_ROWS = 500_000


def sink_parquet_overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> str:
    """Replace the partitions that ``df`` has rows for; all others stay as they are.

    Rows of a partition gather in few files. The rebalance splits a large partition over
    several tasks, which hashing by the partition columns would not.
    """
    if not partition_by:
        raise ValueError("name the partition columns")
    (df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    return path


def bucket_count(df: DataFrame, each: int = BUCKET_ROWS, least: int = 8) -> int:
    """Buckets of about ``each`` rows, since a task sorts or joins a whole bucket."""
    return max(least, -(-df.count() // each))


def bucket_skew(df: DataFrame, keys: list[str], buckets: int) -> float:
    """Rows of the largest bucket as a multiple of the mean bucket; 0 for an empty table."""
    counts = df.groupBy(F.pmod(F.hash(*keys), F.lit(buckets)).alias("bucket")).count()
    largest, total = counts.agg(F.max("count"), F.sum("count")).first()
    return largest * buckets / total if total else 0.0


def store_bucketed(df: DataFrame, path: str, table: str, keys: list[str], buckets: int,
                   max_skew: float = 4.0) -> DataFrame:
    """Write a table in sorted buckets of its keys and return it.

    Joins, aggregates and splits on the keys then read it without a shuffle, and each bucket
    is one file. Where a few keys would fill a bucket beyond ``max_skew`` times the mean, the
    table is stored without buckets: its joins shuffle, and adaptive execution splits hot keys.
    """
    spark = df.sparkSession
    if bucket_skew(df, keys, buckets) > max_skew:
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    (df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return spark.table(table)


def sink_csv_extract(df: DataFrame, path: str, order_by: list[str]) -> str:
    """Extract as ordered CSV with a header: one file if it is small, else files in order.

    ``repartition(1)`` moves only the result; the tasks before it stay parallel.
    """
    ordered = df.repartition(1).sortWithinPartitions(*order_by) if is_small(df) else df.orderBy(*order_by)
    ordered.write.mode("overwrite").option("header", "true").csv(path)
    return path


def _few_files(df: DataFrame) -> DataFrame:
    return df.repartition(1) if is_small(df) else df


def sink_json_stats(df: DataFrame, path: str) -> str:
    """Statistics record(s) as JSON lines."""
    _few_files(df).write.mode("overwrite").json(path)
    return path


def sink_metrics_append(blocks: list[DataFrame], path: str) -> str:
    """One evaluation block per model: the first replaces, the rest append."""
    for i, block in enumerate(blocks):
        _few_files(block).write.mode("append" if i else "overwrite").parquet(path)
    return path


def append_metrics_run(blocks: list[DataFrame], path: str, run: str) -> str:
    """The blocks of one evaluation run, which readers see once all of them are written.

    Each block has a folder of its own, which a repeated call replaces, and the run's
    marker comes last. So neither a repeated run nor one that was cut off and started
    again doubles or loses a block, and other runs stay as they are.
    """
    if not blocks:
        raise ValueError("a run needs at least one block")
    for i, block in enumerate(blocks):
        _few_files(block).write.mode("overwrite").parquet(f"{path}/blocks/run=r-{run}/block={i}")
    marker = blocks[0].sparkSession.createDataFrame([(f"r-{run}", len(blocks))], "run string, blocks int")
    marker.coalesce(1).write.mode("overwrite").json(f"{path}/commits/run-{run}")
    return path


def read_metrics_runs(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """Rows of all finished runs, or of one, with the columns ``run`` and ``block``."""
    commits = spark.read.schema("run string, blocks int").json(f"{path}/commits/*")
    rows = spark.read.option("mergeSchema", "true").parquet(f"{path}/blocks").alias("rows")
    found = rows.join(commits.alias("commits"), F.expr("rows.run = commits.run and rows.block < commits.blocks"), "left_semi")
    found = found.withColumn("run", F.substring("run", 3, 1 << 20))
    return found if run is None else found.where(F.col("run") == run)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)
