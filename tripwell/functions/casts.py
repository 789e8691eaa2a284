"""Tolerant casts: text that does not parse becomes null instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMPM_FORMAT = "MM/dd/yyyy hh:mm:ss a"


def to_double(col: Column) -> Column:
    return col.try_cast("double")


def to_float(col: Column) -> Column:
    return col.try_cast("float")


def to_int(col: Column) -> Column:
    """Whole number, going through double so that text like ``1.0`` counts."""
    return col.try_cast("double").try_cast("int")


def to_timestamp_ampm(col: Column) -> Column:
    """Wall-clock timestamp from twelve-hour text; null where it does not parse."""
    return F.try_to_timestamp(col, F.lit(AMPM_FORMAT)).cast("timestamp_ntz")
