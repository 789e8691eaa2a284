"""Standardisation on plain columns; the statistics are one-row subqueries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moments(df: DataFrame, columns: Sequence[str], population: bool) -> Column:
    """Mean ``m_<c>`` and deviation ``s_<c>`` of each column as one struct.

    The sample form keeps a zero deviation, the population form turns it into 1.
    """
    fields = []
    for c in columns:
        if population:
            spread = F.stddev_pop(c)
            spread = F.when(spread == 0, F.lit(1.0)).otherwise(spread)
        else:
            spread = F.stddev_samp(c)
        fields += [F.avg(c).alias(f"m_{c}"), spread.alias(f"s_{c}")]
    return df.agg(F.struct(*fields).alias("moments")).scalar()


def standard_scale(df: DataFrame, columns: Sequence[str], population: bool = False,
                   suffix: str = "_scaled") -> DataFrame:
    """Add ``<column><suffix>`` = (x - mean) / deviation.

    With the sample deviation a constant column scales to 0; with the population
    deviation it is centred and divided by 1, which is 0 as well.
    """
    stats = moments(df, columns, population)
    scaled = {}
    for c in columns:
        value = (F.col(c) - stats[f"m_{c}"]) / F.nullif(stats[f"s_{c}"], F.lit(0.0))
        if not population:
            value = F.when(F.col(c).isNotNull() & (stats[f"s_{c}"] == 0), F.lit(0.0)).otherwise(value)
        scaled[f"{c}{suffix}"] = value
    return df.withColumns(scaled)


def inverse_scale(centers: DataFrame, reference: DataFrame, columns: Sequence[str],
                  population: bool = True, suffix: str = "_scaled") -> DataFrame:
    """Bring scaled center columns back to the units of the reference table."""
    stats = moments(reference, columns, population)
    return centers.withColumns({
        c: F.col(f"{c}{suffix}") * stats[f"s_{c}"] + stats[f"m_{c}"] for c in columns})
