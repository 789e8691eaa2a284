"""Casts, null rules, logical filters and whole-row deduplication."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwell.functions.casts import to_double, to_float, to_int, to_timestamp_ampm

# Column roles of the trip data model.
TIMESTAMP_COLUMNS = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
DOUBLE_COLUMNS = (
    "passenger_count", "trip_distance", "fare_amount", "total_amount", "VendorID",
    "RatecodeID", "payment_type", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "congestion_surcharge", "airport_fee",
)
INT_COLUMNS = ("passenger_count", "RatecodeID", "VendorID", "payment_type",
               "PULocationID", "DOLocationID")
FLOAT_COLUMNS = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                 "improvement_surcharge", "total_amount", "congestion_surcharge",
                 "airport_fee", "trip_distance")
STRING_COLUMNS = ("store_and_fwd_flag",)
CRITICAL_COLUMNS = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
                    "trip_distance", "fare_amount")
DEAL = 8  # partitions that a deduplication makes of each one it reads
FEW_ROWS = 100_000  # up to here rows need not be dealt
REQUIRED_COLUMNS = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
                    "RatecodeID", "store_and_fwd_flag")


def _cast_all(df: DataFrame, columns: Sequence[str], cast: Callable[[Column], Column]) -> DataFrame:
    present = set(df.columns)
    return df.withColumns({c: cast(F.col(c)) for c in columns if c in present})


def cast_double_columns(df: DataFrame, columns: Sequence[str] = DOUBLE_COLUMNS) -> DataFrame:
    return _cast_all(df, columns, to_double)


def cast_int_float_string(df: DataFrame) -> DataFrame:
    """The narrower typing: whole numbers as int, money as float, flag as string."""
    df = _cast_all(df, INT_COLUMNS, to_int)
    df = _cast_all(df, FLOAT_COLUMNS, to_float)
    return _cast_all(df, STRING_COLUMNS, lambda c: c.cast("string"))


def parse_timestamps(df: DataFrame, columns: Sequence[str] = TIMESTAMP_COLUMNS) -> DataFrame:
    """Parse twelve-hour text; columns that are timestamps already stay as they are."""
    textual = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return _cast_all(df, [c for c in columns if c in textual], to_timestamp_ampm)


def evaluated_once(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows, with the expressions of the columns worked out once per row.

    Filters are otherwise moved below a projection, where every condition repeats the
    expressions it reads. They are not moved below a generator, here one of a single row.
    """
    wanted = {c.lower() for c in columns}
    settled = [c for c in df.columns if c.lower() in wanted]
    rest = [c for c in df.columns if c.lower() not in wanted]
    return df.select(*rest, F.inline(F.array(F.struct(*settled)))).select(*df.columns)


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = CRITICAL_COLUMNS) -> DataFrame:
    """Drop rows with a null or NaN in any of the columns (``None``: any column)."""
    return df.na.drop("any", subset=None if columns is None else list(columns))


def null_or_nan(df: DataFrame, column: str) -> Column:
    """True where the column holds no usable value."""
    missing = F.col(column).isNull()
    if df.schema[column].dataType.typeName() in ("double", "float"):
        missing = missing | F.isnan(F.col(column))
    return missing


def any_missing(df: DataFrame, columns: Sequence[str]) -> Column:
    missing = F.lit(False)
    for c in columns:
        missing = missing | null_or_nan(df, c)
    return missing


def filter_logical(df: DataFrame, columns: Sequence[str] = ("trip_duration_min", "trip_distance",
                                                            "fare_amount")) -> DataFrame:
    """Keep rows whose measures are all above zero."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & (F.col(c) > 0)
    return df.filter(keep)


def filter_below(df: DataFrame, bounds: dict[str, float]) -> DataFrame:
    """Keep rows strictly below each upper bound."""
    keep = F.lit(True)
    for c, bound in bounds.items():
        keep = keep & (F.col(c) < F.lit(bound))
    return df.filter(keep)


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row distinct.

    Nearly all rows are distinct, so collapsing them before the shuffle would hold a whole
    input split in memory and spill it for little. Rows are dealt by a hash of all columns
    first, into partitions that are ``DEAL`` times smaller than those read, and each
    partition drops its copies. A row that occurs very often streams through one task,
    which holds it once. Few rows are not dealt.
    """
    if df.limit(FEW_ROWS + 1).count() <= FEW_ROWS:
        return df.dropDuplicates()
    digest = "_" * max(map(len, df.columns), default=0) + "dealt"
    width = DEAL * max(df.rdd.getNumPartitions(), 1)
    dealt = df.withColumn(digest, F.xxhash64(*df.columns)).repartition(width, digest)
    return dealt.dropDuplicates().drop(digest)


def volume_reduction(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS,
                     nulls_first: bool = True) -> DataFrame:
    """Rows read, dropped for nulls, dropped as duplicates and kept.

    Both rules are counted from one pass: equal rows are grouped with their
    number of copies, and equal rows are either all complete or all incomplete.
    With ``nulls_first`` the incomplete rows count as null drops in full;
    otherwise their surplus copies count as duplicates.
    """
    complete = ~any_missing(df, required)
    groups = (df.withColumn("_complete", complete)
              .groupBy(*df.columns, "_complete").agg(F.count(F.lit(1)).alias("_copies")))
    ok = F.col("_complete")
    rows_read = F.coalesce(F.sum("_copies"), F.lit(0))
    kept = F.coalesce(F.sum(F.when(ok, 1).otherwise(0)), F.lit(0))
    if nulls_first:
        nulls = F.sum(F.when(ok, 0).otherwise(F.col("_copies")))
    else:
        nulls = F.sum(F.when(ok, 0).otherwise(1))
    nulls = F.coalesce(nulls, F.lit(0))
    return groups.agg(rows_read.alias("rows_read"), nulls.alias("dropped_nulls"),
                      (rows_read - nulls - kept).alias("dropped_duplicates"),
                      kept.alias("rows_kept"))
