"""The shared folder for tables and models that jobs hand to each other.

The location always comes from the session's ``spark.checkpoint.dir``, which a
cluster points at storage that every executor can reach. A machine-local
folder is only used when the setting is absent and the session is local.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tripwell-")
    return _local_root


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a folder that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/tripwell/{app}/{label}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table once and return it as a scan, cutting the lineage.

    The written files outlive any executor, so losing one costs a re-read and
    not a recomputation of everything upstream.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(spark.read.parquet(path).schema).parquet(path)
