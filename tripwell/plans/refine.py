"""Raw to typed, cleaned and enriched trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwell.functions.indicators import indicators
from tripwell.functions.timeparts import duration_minutes, is_weekend, pickup_hour, weekday
from tripwell.operators.cleaning import (
    CRITICAL_COLUMNS, REQUIRED_COLUMNS, cast_double_columns, cast_int_float_string,
    drop_duplicates, drop_nulls, evaluated_once, filter_logical, parse_timestamps)
from tripwell.operators.joins import broadcast_zone_join, zone_names


def add_time_features(df: DataFrame, weekend: str = "ge6") -> DataFrame:
    """Hour, weekday, weekend flag and duration, all as doubles."""
    day = weekday(F.col("tpep_pickup_datetime"))
    return df.withColumns({
        "pickup_hour": pickup_hour(F.col("tpep_pickup_datetime")).cast("double"),
        "day_of_week": day.cast("double"),
        "is_weekend": is_weekend(day, weekend),
        "trip_duration_min": duration_minutes(F.col("tpep_pickup_datetime"),
                                              F.col("tpep_dropoff_datetime")),
    })


def silver_pipeline(trips: DataFrame, zones: DataFrame | None, weekend: str = "ge6") -> DataFrame:
    """All-string or typed trips to the feature table.

    The row rules come before the deduplication and the zone names after it.
    Both orders give the same rows as joining first: the rules look at one row
    at a time, and distinct trips joined with distinct zones stay distinct. The
    one shuffle then carries neither rows that are dropped anyway nor the names.
    What the rules read is parsed once per row, not once per rule.
    """
    typed = evaluated_once(cast_double_columns(parse_timestamps(trips)), CRITICAL_COLUMNS)
    timed = add_time_features(drop_nulls(typed, CRITICAL_COLUMNS), weekend)
    valid = filter_logical(timed)
    derived = ["pickup_hour", "day_of_week", "is_weekend", "trip_duration_min"]
    # The derived columns follow from the others, so they are not grouping keys.
    distinct = add_time_features(drop_duplicates(valid.drop(*derived)), weekend)
    names = None if zones is None else zone_names(zones).dropDuplicates().select(
        "LocationID", F.col("pickup_borough").alias("Borough"), F.col("pickup_zone").alias("Zone"))
    return broadcast_zone_join(distinct, names).withColumns(indicators())


def cleaning_pipeline(trips: DataFrame) -> DataFrame:
    """The narrower typing with its own null rule and deduplication."""
    typed = cast_int_float_string(parse_timestamps(trips))
    return drop_duplicates(drop_nulls(typed, REQUIRED_COLUMNS))
