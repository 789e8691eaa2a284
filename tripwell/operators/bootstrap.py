"""Poisson bootstrap: every row gets its own count per replicate from a hash.

One digest per row and block supplies four replicates, and a block's sums are
plain aggregate columns. The exploded rows never leave their task: they meet in
a map-side aggregate with one group per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwell.functions.hashing import LANES, lane_poisson_weight


def _blocks(replicates: int) -> int:
    return -(-replicates // LANES)


def with_block_weights(df: DataFrame, keys: Sequence[str], replicates: int, seed: int) -> DataFrame:
    """One row per input row and block, with the weights ``w0``..``w3`` of its replicates."""
    # The text of the keys is put together once per row, not once per block.
    texts = df.withColumn("_text", F.concat_ws(":", F.lit(str(seed)), *keys))
    exploded = texts.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(_blocks(replicates) - 1))))
    return (exploded.withColumn("_digest", F.md5(F.concat_ws(":", "_text", "_block")))
            .withColumns({f"w{i}": lane_poisson_weight(F.col("_digest"), i) for i in range(LANES)})
            .drop("_digest", "_text"))


def bootstrap_weights(df: DataFrame, keys: Sequence[str], replicates: int, seed: int = 42) -> DataFrame:
    """Long form: (keys, replicate, weight), zero weights included."""
    blocks = with_block_weights(df.select(*keys), keys, replicates, seed)
    cells = F.array(*[F.struct((F.col("_block") * LANES + i + 1).alias("replicate"),
                               F.col(f"w{i}").alias("weight")) for i in range(LANES)])
    long = blocks.select(*keys, F.inline(cells))
    return long.filter(F.col("replicate") <= replicates)


def bootstrap_weighted_means(df: DataFrame, keys: Sequence[str], value: Column, replicates: int,
                             seed: int = 42) -> DataFrame:
    """Mean of ``value`` in each replicate: (replicate, n, mean)."""
    valued = df.select(*keys, value.alias("_v"))
    sums = (with_block_weights(valued, keys, replicates, seed)
            .groupBy("_block")
            .agg(*[a for i in range(LANES) for a in (
                F.sum(f"w{i}").alias(f"n{i}"),
                F.sum(F.col(f"w{i}") * F.col("_v")).alias(f"t{i}"))]))
    cells = F.array(*[F.struct((F.col("_block") * LANES + i + 1).alias("replicate"),
                               F.col(f"n{i}").alias("n"), F.col(f"t{i}").alias("t"))
                      for i in range(LANES)])
    return (sums.select(F.inline(cells)).filter(F.col("replicate") <= replicates)
            .select("replicate", "n", (F.col("t") / F.nullif(F.col("n"), F.lit(0))).alias("mean")))


def bootstrap_rmse(df: DataFrame, keys: Sequence[str], label: str, prediction: str,
                   replicates: int = 100, seed: int = 42) -> DataFrame:
    """Root mean squared error of each replicate: (replicate, n, rmse)."""
    squared = (F.col(prediction) - F.col(label)) * (F.col(prediction) - F.col(label))
    means = bootstrap_weighted_means(df, keys, squared, replicates, seed)
    return means.select("replicate", "n", F.sqrt("mean").alias("rmse"))


def bootstrap_summary(replicates: DataFrame, value: str) -> DataFrame:
    """Mean, population deviation and 95 % interval over the replicate values."""
    bounds = F.percentile(value, F.array(F.lit(0.025), F.lit(0.975)))
    return (replicates.agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
                           bounds.alias("_b"), F.count(value).alias("n_bootstraps"))
            .select("mean", "std", F.col("_b")[0].alias("ci_lower"),
                    F.col("_b")[1].alias("ci_upper"), "n_bootstraps"))


def rmse_bootstrap_ci(df: DataFrame, keys: Sequence[str], label: str, prediction: str,
                      replicates: int = 100, seed: int = 42) -> DataFrame:
    return bootstrap_summary(bootstrap_rmse(df, keys, label, prediction, replicates, seed), "rmse")
