"""One place that builds a session with the settings the jobs expect."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


SHUFFLE_TARGET_BYTES = 256 * 1024 ** 2


def initial_shuffle_partitions(input_bytes: int, target_bytes: int = SHUFFLE_TARGET_BYTES) -> int:
    """Partitions that keep a shuffle of the whole input near the target size each.

    Adaptive execution merges small partitions but never splits the initial
    number up, so it has to suit the largest shuffle.
    """
    return max(200, -(-input_bytes // target_bytes))


def build_session(app_name: str = "tripwell", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  input_bytes: int | None = None) -> SparkSession:
    """Session with adaptive execution, UTC and ANSI semantics.

    On a cluster leave ``master`` unset (spark-submit supplies it) and pass the
    size of the input, from which the initial number of shuffle partitions
    follows.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master).config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
    if shuffle_partitions is None and input_bytes is not None:
        shuffle_partitions = initial_shuffle_partitions(input_bytes)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
