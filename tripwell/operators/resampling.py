"""Bootstrap with exactly n draws: multinomial counts split binomially by hash ranges.

The rows are divided into ranges of their key's hash and counted. The n draws of every
replicate are split over the ranges down a binary tree: a node's draws go to its left
half by a binomial count, in proportion to the rows there. Inside a range the rows
pass in order of the hash, a block at a time: a block takes its binomial share of the
draws left, and each of them falls on one of the block's rows. So the weights of each
replicate are a multinomial draw whose sum is n, and no weight is capped.

Every random number is seeded by the replicate's seed and the place in the tree. The
counts are the same for any partitioning and when a lost task runs again. A task holds
one block; the driver holds the counts of at most ``MAX_RANGES`` ranges.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwell.functions.hashing import key_digest
from tripwell.operators.bootstrap import bootstrap_summary

MAX_RANGES, RANGE_ROWS, BLOCK_ROWS = 4096, 20_000, 4096


def split_draws(counts: np.ndarray, replicates: int, seed: int) -> np.ndarray:
    """Draws of every range (rows) in every replicate (columns); each column sums to ``counts.sum()``."""
    draws = np.zeros((len(counts), replicates), np.int64)
    ends = np.concatenate([[0], np.cumsum(counts)])

    def down(first: int, last: int, here: np.ndarray, node: int) -> None:
        if last - first == 1:
            draws[first] = here
            return
        middle = (first + last) // 2
        rows, left = ends[last] - ends[first], ends[middle] - ends[first]
        part = np.random.default_rng([seed, 0, node]).binomial(here, left / rows if rows else 0.0)
        down(first, middle, part, 2 * node)
        down(middle, last, here - part, 2 * node + 1)

    down(0, len(counts), np.full(replicates, ends[-1]), 1)
    return draws


class RangeDraws:
    """Hands out the draws of one range to its blocks of rows."""

    def __init__(self, number: int, rows: int, draws: np.ndarray, seed: int):
        self.number, self.rows, self.left, self.seed, self.block = number, rows, draws.copy(), seed, 0

    def weights(self, size: int) -> np.ndarray:
        """Weights of the next ``size`` rows (rows) in every replicate (columns)."""
        rng = np.random.default_rng([self.seed, 1, self.number, self.block])
        here = rng.binomial(self.left, size / self.rows)
        self.left, self.rows, self.block = self.left - here, self.rows - size, self.block + 1
        found = np.empty((size, len(here)), np.int64)
        for r, n in enumerate(here.tolist()):
            found[:, r] = np.bincount(rng.integers(0, size, n), minlength=size)
        return found


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one range at a time, ``BLOCK_ROWS`` of them or the rest of the range, whatever the batches."""
    held: list[pd.DataFrame] = []
    size, number = 0, None
    for batch in batches:
        cuts = np.flatnonzero(np.diff(batch["_range"].to_numpy())) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
            if a == b:
                continue
            now = batch["_range"].iat[a]
            if size and now != number:
                yield pd.concat(held)
                held, size = [], 0
            number = now
            while a < b:
                step = min(b - a, BLOCK_ROWS - size)
                held.append(batch.iloc[a:a + step])
                a, size = a + step, size + step
                if size == BLOCK_ROWS:
                    yield pd.concat(held)
                    held, size = [], 0
    if size:
        yield pd.concat(held)


def _dealt(df: DataFrame, keys: Sequence[str], seed: int) -> tuple[DataFrame, np.ndarray]:
    """Rows sorted by hash within their ranges, and the rows of every range."""
    total = df.count()
    ranges = 1
    while ranges < MAX_RANGES and ranges * RANGE_ROWS < total:
        ranges *= 2
    marked = df.withColumn("_digest", key_digest(keys, seed))
    head = F.conv(F.substring("_digest", 1, 3), 16, 10).cast("int")  # 4096 heads
    marked = marked.withColumn("_range", F.floor(head / F.lit(MAX_RANGES // ranges)).cast("int"))
    counts = np.zeros(ranges, np.int64)
    for r in marked.groupBy("_range").count().collect():
        counts[r["_range"]] = r["count"]
    return marked.repartition(ranges, "_range").sortWithinPartitions("_range", "_digest", *keys), counts


def _weighted(df: DataFrame, keys: Sequence[str], replicates: int, seed: int, schema: str, made) -> DataFrame:
    """``made(rows of a block, weights)`` over all blocks."""
    dealt, counts = _dealt(df, keys, seed)
    shared = df.sparkSession.sparkContext.broadcast(split_draws(counts, replicates, seed))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current = None
        for block in _blocks(batches):
            number = int(block["_range"].iat[0])
            if current is None or current.number != number:
                current = RangeDraws(number, int(counts[number]), shared.value[number], seed)
            yield made(block, current.weights(len(block)))

    return dealt.mapInPandas(run, schema)


def multinomial_weights(df: DataFrame, keys: Sequence[str], replicates: int, seed: int = 42) -> DataFrame:
    """(keys, weights): how often each replicate draws the row; weights of a replicate sum to the number of rows.

    Rows that share a key are rows of their own, in no fixed order among themselves.
    """
    picked = df.select(*keys)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema)

    def made(block: pd.DataFrame, weights: np.ndarray) -> pd.DataFrame:
        return block[list(keys)].reset_index(drop=True).assign(weights=list(weights))

    return _weighted(picked, keys, replicates, seed, f"{kinds}, weights array<long>", made)


def multinomial_means(df: DataFrame, keys: Sequence[str], value: Column, replicates: int, seed: int = 42) -> DataFrame:
    """(replicate, n, mean) of ``value`` in each replicate; rows without a value are not drawn."""
    valued = df.select(*keys, value.alias("_v")).where(F.col("_v").isNotNull())

    def made(block: pd.DataFrame, weights: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"replicate": np.arange(1, replicates + 1, dtype="int32"), "n": weights.sum(axis=0),
                             "total": block["_v"].to_numpy("float64") @ weights})

    sums = _weighted(valued, keys, replicates, seed, "replicate int, n long, total double", made)
    return sums.groupBy("replicate").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).select(
        "replicate", "n", (F.col("total") / F.nullif(F.col("n"), F.lit(0))).alias("mean"))


def multinomial_rmse_ci(df: DataFrame, keys: Sequence[str], label: str, prediction: str, replicates: int = 100,
                        seed: int = 42) -> DataFrame:
    """Mean, deviation and 95 % interval of the error over replicates of exactly n draws."""
    squared = (F.col(prediction) - F.col(label)) * (F.col(prediction) - F.col(label))
    means = multinomial_means(df, keys, squared.cast("double"), replicates, seed)
    return bootstrap_summary(means.select("replicate", F.sqrt("mean").alias("rmse")), "rmse")
