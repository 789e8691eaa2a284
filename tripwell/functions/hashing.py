"""Repeatable pseudo-randomness derived from row keys.

A draw depends only on the seed and the key columns, never on partitioning or
task order, so a recomputed task draws the same numbers and any SQL engine with
``md5`` can reproduce them. One digest carries four independent 32-bit lanes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

LANES = 4
# Splits, samples and folds each read their own lane, so that a sample or a fold
# of a split does not depend on how the split was drawn.
SPLIT_LANE, SAMPLE_LANE, FOLD_LANE = 0, 1, 2
TWO_POW_32 = 4294967296.0

# Cumulative probabilities of a Poisson(1) count of 0, 1, 2, ...
POISSON_CUTS = (
    0.367879441171, 0.735758882343, 0.919698602929, 0.981011843124,
    0.996340153173, 0.999405815182, 0.999916758851, 0.999989750803,
    0.999998874797,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_digest(keys: Sequence[str | Column], seed: int | Column = 42) -> Column:
    """Hex digest of ``seed:key1:key2:...``. Use integer or string keys only."""
    head = F.lit(str(seed)) if isinstance(seed, int) else seed.cast("string")
    return F.md5(F.concat_ws(":", head, *[_col(k).cast("string") for k in keys]))


def lane_unit(digest: Column, lane: int = 0) -> Column:
    """Uniform number in [0, 1) from one 32-bit lane of a digest."""
    piece = F.substring(digest, 1 + 8 * lane, 8)
    return F.conv(piece, 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def unit_hash(keys: Sequence[str | Column], seed: int | Column = 42, lane: int = SAMPLE_LANE) -> Column:
    return lane_unit(key_digest(keys, seed), lane)


def poisson_weight(u: Column) -> Column:
    """Poisson(1) count for a uniform draw, by inverting its distribution."""
    return _count_below(u, [F.lit(cut) for cut in POISSON_CUTS])


def lane_poisson_weight(digest: Column, lane: int) -> Column:
    """``poisson_weight`` of a lane, read straight from its hex digits.

    Eight lower-case hex digits sort like the number they stand for, so the
    draw need not be parsed: ``u < cut`` holds when the digits sort before
    those of ``cut * 2**32`` rounded up.
    """
    piece = F.substring(digest, 1 + 8 * lane, 8)
    return _count_below(piece, [F.lit(f"{math.ceil(cut * TWO_POW_32):08x}") for cut in POISSON_CUTS])


def _count_below(draw: Column, cuts: Sequence[Column]) -> Column:
    weight = None
    for count, cut in enumerate(cuts):
        weight = (F.when(draw < cut, F.lit(count)) if weight is None
                  else weight.when(draw < cut, F.lit(count)))
    return weight.otherwise(F.lit(len(cuts)))


def row_fingerprint(columns: Sequence[str]) -> Column:
    """A 64-bit key for tables that carry no row key of their own."""
    return F.xxhash64(*[F.col(c) for c in columns])
