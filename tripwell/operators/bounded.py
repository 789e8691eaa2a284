"""Broadcasting what is measured to be small, caching, and running fits side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

BROADCAST_ROW_LIMIT = 100_000
BROADCAST_BYTE_LIMIT = 64 * 1024 ** 2


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT, max_bytes: int = BROADCAST_BYTE_LIMIT) -> bool:
    """Whether a table has at most ``max_rows`` rows and ``max_bytes`` bytes of text form.

    Reads at most ``max_rows + 1`` rows.
    """
    size = F.coalesce(F.octet_length(F.to_json(F.struct("*"))), F.lit(0))
    n, total = df.limit(max_rows + 1).select(size.alias("size")).agg(F.count("size"), F.sum("size")).first()
    return n <= max_rows and (total or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Hint a broadcast when a bounded check proves the side small.

    A larger side is returned without a hint: it is then joined by shuffling on
    the key, where adaptive execution splits the partitions of hot keys.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def bounded_rows(df: DataFrame, what: str, max_rows: int = BROADCAST_ROW_LIMIT) -> list:
    """Rows of a summary that the driver works on; refuses more than the bound instead of dropping any."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} {what}")
    return rows


def pin_small(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Evaluate a summary table once and hint its broadcast, when it is small.

    For per-cluster, per-bin or per-model tables that several later passes look
    up. A summary that turns out larger is returned as it is, unevaluated.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def cached(df: DataFrame) -> DataFrame:
    """Keep an iterated input; blocks lost with an executor are recomputed."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def cached_if_few(df: DataFrame, rows: int) -> DataFrame:
    """Keep an input of up to ``rows`` rows; of more rows operators keep a form of their own."""
    return cached(df) if df.count() <= rows else df


def in_parallel(tasks: Sequence[Callable], width: int = 4) -> list:
    """Run independent fits side by side so that their stages share the cluster."""
    with ThreadPoolExecutor(max_workers=width) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


ROWS_AT_ONCE = 5_000_000


def side_by_side(rows: int, most: int) -> int:
    """How many of ``most`` fits on so many rows run together.

    Every fit keeps its own form of its rows, hundreds of bytes each, and a fit on many
    rows fills all cores alone.
    """
    return max(1, min(most, ROWS_AT_ONCE // max(rows, 1)))


def spread_rows(df: DataFrame) -> DataFrame:
    """Share a small sample out to all cores before it is worked on or multiplied.

    A sample taken by order arrives in a single partition.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 1))
