"""Splits, samples and folds that repeat exactly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwell.functions.hashing import FOLD_LANE, SPLIT_LANE, unit_hash

DEFAULT_SPLIT = {"train": 0.70, "validation": 0.15, "test": 0.15}


def assign_split(df: DataFrame, keys: Sequence[str], shares: Mapping[str, float] = DEFAULT_SPLIT,
                 seed: int = 42, column: str = "split") -> DataFrame:
    """Label each row with its split. The shares are normalised to sum to one."""
    total = sum(shares.values())
    names = list(shares)
    label, edge = None, 0.0
    u = F.col("_u")
    for name in names[:-1]:
        edge += shares[name] / total
        hit = u < F.lit(round(edge, 12))
        label = F.when(hit, F.lit(name)) if label is None else label.when(hit, F.lit(name))
    label = F.lit(names[-1]) if label is None else label.otherwise(F.lit(names[-1]))
    return (df.withColumn("_u", unit_hash(keys, seed, SPLIT_LANE))
            .withColumn(column, label).drop("_u"))


def random_split(df: DataFrame, keys: Sequence[str], shares: Mapping[str, float] = DEFAULT_SPLIT,
                 seed: int = 42) -> dict[str, DataFrame]:
    labelled = assign_split(df, keys, shares, seed, column="_split")
    return {name: labelled.filter(F.col("_split") == name).drop("_split") for name in shares}


def sample_fraction(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Each row is kept with the given probability.

    A sample of a sample needs another seed than the first one.
    """
    return df.filter(unit_hash(keys, seed) < F.lit(fraction))


def sample_exact(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: those with the smallest hash.

    Ties in the hash fall back to the keys and then to the other columns. A
    plain ordered limit would send n rows of every task to the final merge. One
    aggregation counts the rows per hash magnitude first, which shows the
    smallest threshold that lets n rows through; about a fifth more than n reach
    the ordered limit.
    """
    hashed = df.withColumn("_u", unit_hash(keys, seed))
    # Quarter octaves of the hash; a hash of zero is in the smallest one.
    magnitude = F.coalesce(F.floor(-4 * F.log2(F.nullif(F.col("_u"), F.lit(0.0)))), F.lit(200))
    counts = {r["m"]: r["n"] for r in hashed.groupBy(magnitude.alias("m"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(counts.values()) <= n:
        return df
    kept, limit = 0, 200
    for limit in sorted(counts, reverse=True):
        kept += counts[limit]
        if kept >= n:
            break
    rest = [c for c in df.columns if c not in keys]
    return (hashed.filter(magnitude >= F.lit(limit))
            .orderBy("_u", *keys, *rest).limit(n).drop("_u"))


def limit_rows(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Row cap that keeps the same rows on every run."""
    return sample_exact(df, keys, n)


def sample_capped(df: DataFrame, keys: Sequence[str], cap: int, seed: int = 42) -> DataFrame:
    """The whole table up to ``cap`` rows, otherwise a sample of exactly ``cap``."""
    return sample_exact(df, keys, cap, seed)


def kfold_assign(df: DataFrame, keys: Sequence[str], folds: int = 5, seed: int = 42,
                 column: str = "fold") -> DataFrame:
    return df.withColumn(column, F.floor(unit_hash(keys, seed, FOLD_LANE) * folds).cast("int"))


