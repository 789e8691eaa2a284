"""Fixed-domain indicator columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The domains of the four categorical trip columns.
TRIP_DOMAINS: dict[str, tuple] = {
    "VendorID": (1, 2),
    "payment_type": (1, 2, 3, 4, 5),
    "store_and_fwd_flag": ("Y", "N"),
    "RatecodeID": (1, 2, 3, 4, 5, 6, 99),
}


def indicator(name: str, value) -> Column:
    """1.0 where the column equals ``value``; null and unseen values give 0.0."""
    return F.when(F.col(name) == F.lit(value), F.lit(1.0)).otherwise(F.lit(0.0))


def indicators(domains: Mapping[str, Sequence] = TRIP_DOMAINS) -> dict[str, Column]:
    """One ``<column>_<value>`` indicator per domain value, in domain order."""
    return {f"{name}_{value}": indicator(name, value)
            for name, values in domains.items() for value in values}
