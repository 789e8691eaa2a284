"""Order, limits, winners and ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Persona names in ascending order of mean fare.
PERSONAS = (
    "Cluster 0: Short Inner-City Commute",
    "Cluster 1: Standard Borough Journey",
    "Cluster 2: Extended City Transit",
    "Cluster 3: Long Airport / Outer-Borough Run",
)


def persona_rank(profile: DataFrame, fare: str = "avg_fare", cluster: str = "cluster",
                 names: Sequence[str] = PERSONAS) -> DataFrame:
    """Name clusters by their rank in mean fare; ``profile`` has one row per cluster.

    Ranks beyond the list of names get a null name.
    """
    rank = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(fare, cluster))
    lookup = F.array(*[F.lit(n) for n in names])
    return (profile.withColumn("persona_rank", rank)
            .withColumn("persona", F.try_element_at(lookup, F.col("persona_rank"))))


def single_baseline_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.orderBy(*keys).limit(1)


def topk(df: DataFrame, score: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The k highest scores; only k rows per task meet in the final merge."""
    return df.orderBy(F.col(score).desc(), *ties).limit(k)


def sorted_tail(df: DataFrame, score: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The last k rows of the ascending order, still ascending."""
    return topk(df, score, k, ties).orderBy(score, *[F.col(t).desc() for t in ties])


def argmax_row(df: DataFrame, score: str, keys: Sequence[str]) -> DataFrame:
    """Row with the largest score; the smallest key wins a tie.

    Missing scores never win.
    """
    return (df.filter(F.col(score).isNotNull() & ~F.isnan(score))
            .orderBy(F.col(score).desc(), *keys).limit(1))


def best_model_select(metrics: DataFrame, score: str = "rmse", name: str = "model",
                      position: str = "position") -> DataFrame:
    """Lowest score wins; equal scores go to the earlier position."""
    key = F.struct(F.col(score), F.col(position))
    usable = metrics.filter(F.col(score).isNotNull() & ~F.isnan(score))
    return usable.agg(F.min_by(name, key).alias(name), F.min(score).alias(score))


def best_k_select(metrics: DataFrame, score: str = "silhouette", k: str = "k") -> DataFrame:
    """Highest score wins; equal scores go to the smaller k."""
    usable = metrics.filter(F.col(score).isNotNull() & ~F.isnan(score))
    return usable.agg(F.max_by(k, F.struct(F.col(score), -F.col(k))).alias(k),
                      F.max(score).alias(score))


def best_per_metric(metrics: DataFrame, higher_is_better: Mapping[str, bool],
                    name: str = "model", position: str = "position") -> DataFrame:
    """The winning model of every metric, one row per metric."""
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("score"),
                      (F.col(m) if up else -F.col(m)).alias("signed"))
             for m, up in higher_is_better.items()]
    long = metrics.select(name, position, F.inline(F.array(*cells)))
    order = F.struct(F.col("signed"), -F.col(position))
    usable = long.filter(F.col("signed").isNotNull() & ~F.isnan("signed"))
    return usable.groupBy("metric").agg(F.max_by(name, order).alias(name),
                                        F.max_by("score", order).alias("score"))


def improvement_vs_baseline(metrics: DataFrame, baseline: str, name: str = "model",
                            score: str = "rmse", seconds: str | None = None) -> DataFrame:
    """Absolute and relative gain over the baseline model, per second if timed."""
    base = (metrics.filter(F.col(name) == baseline)
            .agg(F.min(score).alias("base")).scalar())
    gain = base - F.col(score)
    out = metrics.select(name, score, gain.alias("improvement"),
                         (gain / base * 100.0).alias("improvement_pct"),
                         *([F.col(seconds)] if seconds else []))
    if seconds:
        out = out.withColumn("gain_per_second", F.col("improvement") / F.col(seconds))
    return out


def speedup_ratio(runs: DataFrame, baseline: str, name: str = "environment",
                  seconds: str = "seconds") -> DataFrame:
    """Run time of each environment relative to the baseline environment."""
    base = runs.filter(F.col(name) == baseline).agg(F.min(seconds).alias("base")).scalar()
    return runs.select(name, seconds, (F.col(seconds) / base).alias("ratio"))
