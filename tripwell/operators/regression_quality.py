"""Regression metrics from one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metric_columns(label: Column, prediction: Column) -> dict[str, Column]:
    """Aggregates for rmse, mae, r2, mape (a ratio) and explained variance.

    Labels of zero are left out of mape. r2 and explained variance are null for
    a constant label.
    """
    error = label - prediction
    spread = F.nullif(F.var_pop(label), F.lit(0.0))
    return {
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "r2": F.lit(1.0) - F.avg(error * error) / spread,
        "mape": F.avg(F.abs(error) / F.nullif(F.abs(label), F.lit(0.0))),
        "explained_variance": F.lit(1.0) - F.var_pop(error) / spread,
    }


def regression_metrics(df: DataFrame, label: str, prediction: str,
                       by: Sequence[str] = (),
                       metrics: Sequence[str] = ("rmse", "r2", "mae")) -> DataFrame:
    table = metric_columns(F.col(label), F.col(prediction))
    return df.groupBy(*by).agg(*[table[m].alias(m) for m in metrics])


def actual_vs_predicted(df: DataFrame, label: str, prediction: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, F.col(label).alias("actual_fare"), F.col(prediction).alias("predicted_fare"),
                     (F.col(label) - F.col(prediction)).alias("residual"))
