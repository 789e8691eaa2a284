"""Summaries for reports and dashboards."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwell.operators.cleaning import null_or_nan
from tripwell.operators.quantiles import exact_quantiles

CORRELATION_COLUMNS = ("trip_distance", "fare_amount", "trip_duration_min", "pickup_hour",
                       "passenger_count", "day_of_week", "is_weekend")


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def hourly_stats(silver: DataFrame) -> DataFrame:
    """Average fare, distance and duration plus trip count per pickup hour."""
    return (silver.groupBy("pickup_hour")
            .agg(F.avg("fare_amount").alias("avg_fare"),
                 F.avg("trip_distance").alias("avg_dist"),
                 F.avg("trip_duration_min").alias("avg_duration"),
                 F.count(F.lit(1)).alias("trip_count"))
            .orderBy("pickup_hour"))


def pearson_matrix(df: DataFrame, columns: Sequence[str] = CORRELATION_COLUMNS) -> DataFrame:
    """Correlation of every ordered pair of columns, in long form.

    All pairs come from one aggregation; each unordered pair is computed once
    and mirrored.
    """
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    sums = df.agg(*[F.corr(columns[i], columns[j]).alias(f"r{i}_{j}") for i, j in pairs])
    cells = []
    for i, j in pairs:
        for a, b in {(i, j), (j, i)}:
            cells.append(F.struct(F.lit(a).alias("row_no"), F.lit(b).alias("col_no"),
                                  F.lit(columns[a]).alias("row_name"),
                                  F.lit(columns[b]).alias("col_name"),
                                  F.col(f"r{i}_{j}").alias("r")))
    return sums.select(F.inline(F.array(*cells)))


def lower_triangle(matrix: DataFrame) -> DataFrame:
    """Pairs on or below the diagonal."""
    return matrix.filter(F.col("col_no") <= F.col("row_no"))


def histogram(df: DataFrame, value: Column, bins: int = 80) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed.

    Returns one row per bin, empty bins included. A single-valued column falls
    into one range half a unit to each side of the value.
    """
    values = df.select(value.cast("double").alias("v")).filter(~F.isnan("v") & F.col("v").isNotNull())
    raw = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    bounds = raw.select(F.struct(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi")).alias("b")).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    bin_no = F.least(F.floor((F.col("v") - lo) / (hi - lo) * bins).cast("int"), F.lit(bins - 1))
    counted = values.groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / bins
    return (frame.join(counted, "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("lower_edge"),
                    (lo + (F.col("bin") + 1) * width).alias("upper_edge"),
                    F.coalesce("n", F.lit(0)).alias("frequency")))


def residual_summary(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    residual = F.col(actual) - F.col(predicted)
    return df.agg(F.avg(residual).alias("mean_residual"), F.count(residual).alias("n"))


def min_max_limits(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Joint limits over several columns."""
    return df.agg(F.least(*[F.min(c) for c in columns]).alias("lower_limit"),
                  F.greatest(*[F.max(c) for c in columns]).alias("upper_limit"))


def quality_profile(df: DataFrame, columns: Sequence[str], tier: str,
                    lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Per column: rows, missing values, clip bounds and values outside them."""
    bounds = exact_quantiles(df, columns, [lower, upper])
    counts = []
    for i, c in enumerate(columns):
        low, high = bounds[c]
        outside = F.lit(False) if low is None else (F.col(c) < F.lit(low)) | (F.col(c) > F.lit(high))
        missing = null_or_nan(df, c)
        counts += [F.count(F.when(missing, 1)).alias(f"m{i}"),
                   F.count(F.when(~missing & outside, 1)).alias(f"o{i}")]
    summary = df.agg(F.count(F.lit(1)).alias("rows"), *counts)
    cells = [F.struct(F.lit(tier).alias("tier"), F.lit(c).alias("column_name"),
                      F.col("rows").alias("row_count"), F.col(f"m{i}").alias("null_count"),
                      F.lit(bounds[c][0]).cast("double").alias("clip_lower"),
                      F.lit(bounds[c][1]).cast("double").alias("clip_upper"),
                      F.col(f"o{i}").alias("out_of_bounds"))
             for i, c in enumerate(columns)]
    return summary.select(F.inline(F.array(*cells)))


def fare_by_time_persona(df: DataFrame, hour: str = "pickup_hour", persona: str = "persona",
                         fare: str = "fare_amount") -> DataFrame:
    return (df.groupBy(hour, persona)
            .agg(F.sum(fare).alias("revenue"), F.avg(fare).alias("avg_fare"),
                 F.count(F.lit(1)).alias("trips")))


def distance_distribution(df: DataFrame, width: float = 5.0,
                          distance: str = "trip_distance") -> DataFrame:
    bucket = F.floor(F.col(distance) / width).cast("int")
    return (df.groupBy(bucket.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("trips"))
            .select("bucket", (F.col("bucket") * F.lit(width)).alias("distance_from"),
                    ((F.col("bucket") + 1) * F.lit(width)).alias("distance_to"), "trips"))
