"""Choosing, renaming and overriding columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that give the fare away, and columns never used as features.
LEAKAGE_COLUMNS = (
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "fare_amount", "total_amount",
    "tip_amount", "tolls_amount", "mta_tax", "extra", "improvement_surcharge",
    "congestion_surcharge", "airport_fee", "PULocationID", "DOLocationID",
)

# Model features in the order the model expects them.
MODEL_FEATURES = (
    "trip_distance", "pickup_hour", "day_of_week", "is_weekend", "passenger_count",
    "trip_duration_min", "VendorID_1", "VendorID_2", "payment_type_1", "payment_type_2",
    "payment_type_3", "payment_type_4", "payment_type_5", "store_and_fwd_flag_N",
    "store_and_fwd_flag_Y", "RatecodeID_1", "RatecodeID_2", "RatecodeID_3",
    "RatecodeID_4", "RatecodeID_5", "RatecodeID_6", "RatecodeID_99",
)

# Display names of features.
FEATURE_LABELS = {
    "trip_distance": "Trip Distance",
    "trip_duration_min": "Trip Duration (min)",
    "RatecodeID_1": "Rate Code 1 (Standard)",
    "RatecodeID_2": "Rate Code 2 (JFK)",
    "RatecodeID_3": "Rate Code 3 (Newark)",
    "payment_type_4": "Payment: No Charge",
    "RatecodeID_5": "Rate Code 5 (Negotiated)",
    "RatecodeID_4": "Rate Code 4 (Nassau)",
    "payment_type_3": "Payment: Complimentary",
    "VendorID_1": "Vendor 1",
    "VendorID_2": "Vendor 2",
    "RatecodeID_99": "Rate Code 99 (Unknown)",
    "pickup_hour": "Pickup Hour",
    "passenger_count": "Passenger Count",
    "payment_type_1": "Payment: Credit Card",
    "payment_type_2": "Payment: Cash",
    "day_of_week": "Day of Week",
}


def rename_drop(df: DataFrame, drop: Sequence[str], rename: Mapping[str, str]) -> DataFrame:
    return df.drop(*drop).withColumnsRenamed(dict(rename))


def project_exclude(df: DataFrame, excluded: Sequence[str] = LEAKAGE_COLUMNS) -> DataFrame:
    return df.drop(*excluded)


def numeric_columns(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    """Numeric columns outside the excluded set and without ``datetime`` in the name."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType)
            and f.name not in excluded and "datetime" not in f.name]


def available_columns(df: DataFrame, wanted: Sequence[str] = MODEL_FEATURES) -> list[str]:
    """The wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return [c for c in wanted if c in present]


def override_literals(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """What-if: replace columns by literals on every row."""
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def map_values(col: Column, mapping: Mapping[str, str]) -> Column:
    """Look values up in a dictionary; unmapped values stay."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(table, col), col)
