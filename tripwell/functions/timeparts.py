"""Calendar features of a trip."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pickup_hour(ts: Column) -> Column:
    return F.hour(ts)


def weekday(ts: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(ts)


def is_weekend(day: Column, weekend: str = "calendar") -> Column:
    """1.0 on a weekend day.

    ``calendar`` counts Sunday (1) and Saturday (7); ``ge6`` is the looser
    threshold form ``day >= 6``, which counts Friday and Saturday.
    """
    if weekend == "calendar":
        hit = day.isin(1, 7)
    elif weekend == "ge6":
        hit = day >= 6
    else:
        raise ValueError(f"unknown weekend rule: {weekend!r}")
    return F.when(hit, F.lit(1.0)).otherwise(F.lit(0.0))


def duration_minutes(start: Column, end: Column) -> Column:
    """Whole seconds between the two timestamps, divided by 60."""
    return F.timestamp_diff("SECOND", start, end) / F.lit(60.0)
