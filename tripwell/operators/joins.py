"""Enriching facts from a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwell.operators.bounded import BROADCAST_ROW_LIMIT, broadcast_if_small


def zone_names(zones: DataFrame) -> DataFrame:
    """Dimension reduced to what the join adds."""
    return zones.select("LocationID", F.col("Borough").alias("pickup_borough"),
                        F.col("Zone").alias("pickup_zone"))


def broadcast_zone_join(trips: DataFrame, zones: DataFrame | None,
                        max_broadcast_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Left join of the pickup zone on its string key.

    Unmatched trips keep null names, and a key that occurs more than once in the
    dimension fans out. Without a dimension the trips pass through and no column
    is added. The dimension is broadcast when a bounded check proves it small in rows
    and bytes. Otherwise this is one shuffled join: the trips are read once, and
    adaptive execution splits the partitions of hot keys, with no key among them,
    by their size, each part meeting the same few dimension rows.
    """
    if zones is None:
        return trips
    dim = broadcast_if_small(zone_names(zones), max_broadcast_rows)
    return trips.join(dim, F.col("PULocationID") == F.col("LocationID"), "left").drop("LocationID")
