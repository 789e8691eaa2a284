"""Why a model predicts what it predicts, as Spark jobs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwell.functions.hashing import key_digest, lane_unit
from tripwell.operators.bounded import spread_rows
from tripwell.operators.quantiles import exact_quantiles
from tripwell.operators.regression import mean_profile


def shapley_values(model: Transformer, rows: DataFrame, background: DataFrame,
                   features: Sequence[str], keys: Sequence[str], permutations: int = 8,
                   seed: int = 42) -> DataFrame:
    """Permutation-sampled Shapley values: (keys, feature_name, contribution).

    Every row walks from the average profile to its own values, one feature at a
    time, in several hashed orders. All walk positions of all rows are scored by
    one ``transform``. A feature gains the prediction after its step and loses
    the one before it, so per row the contributions add up to its prediction
    minus that of the profile.
    """
    profile = mean_profile(background, features)
    count = len(features)
    walks = (spread_rows(rows.select(*keys, *features))
             .withColumn("_walk", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
             .withColumn("_order", F.array_sort(F.array(*[
                 F.struct(key_digest([*keys, F.col("_walk"), F.lit(j)], seed).alias("h"),
                          F.lit(j).alias("j")) for j in range(count)])))
             .withColumn("_order", F.transform("_order", lambda s: s["j"])))
    positions = walks.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(count))))
    moved = positions.withColumns({
        f: F.when(F.array_position("_order", F.lit(j)) <= F.col("_step"), F.col(f))
        .otherwise(profile[f]) for j, f in enumerate(features)})
    scored = model.transform(moved).select(*keys, "_order", "_step", "prediction")
    after = F.when(F.col("_step") > 0, F.struct(
        F.get("_order", F.col("_step") - 1).alias("j"), F.col("prediction").alias("delta")))
    before = F.when(F.col("_step") < count, F.struct(
        F.get("_order", F.col("_step")).alias("j"), (-F.col("prediction")).alias("delta")))
    names = F.array(*[F.lit(f) for f in features])
    return (scored.select(*keys, F.inline(F.array_compact(F.array(after, before))))
            .groupBy(*keys, "j").agg((F.sum("delta") / permutations).alias("contribution"))
            .select(*keys, F.get(names, F.col("j")).alias("feature_name"), "contribution"))


def shapley_linear(rows: DataFrame, background: DataFrame, coefficients: dict[str, float],
                   keys: Sequence[str]) -> DataFrame:
    """Exact Shapley values of a linear model: coefficient times distance from the mean."""
    profile = mean_profile(background, list(coefficients))
    cells = [F.struct(F.lit(f).alias("feature_name"),
                      (F.lit(b) * (F.col(f) - profile[f])).alias("contribution"))
             for f, b in coefficients.items()]
    return rows.select(*keys, F.inline(F.array(*cells)))


def mean_absolute_contribution(contributions: DataFrame) -> DataFrame:
    """Features ranked by their mean absolute contribution."""
    return (contributions.groupBy("feature_name")
            .agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
            .orderBy(F.col("mean_abs_contribution").desc(), "feature_name"))


@dataclass
class Bins:
    """Quartile bins of a feature in the background, with what its values do inside."""
    edges: list[float]
    shares: list[float]
    means: list[float]
    spreads: list[float]
    lows: list[float]
    highs: list[float]

    def of(self, value: Column) -> Column:
        """Number of a value's bin; a value on an edge belongs to the bin below."""
        return sum((F.when(value > F.lit(e), 1).otherwise(0) for e in self.edges), F.lit(0))

    def named(self, feature: str, number: int) -> str:
        if not self.edges:
            return feature
        if number == 0:
            return f"{feature} <= {self.edges[0]:.2f}"
        if number == len(self.edges):
            return f"{feature} > {self.edges[-1]:.2f}"
        return f"{self.edges[number - 1]:.2f} < {feature} <= {self.edges[number]:.2f}"


def quartile_bins(background: DataFrame, features: Sequence[str]) -> dict[str, Bins]:
    """Bins of every feature: exact quartiles, then one aggregation by feature and bin.

    Nulls and NaNs of the background do not count; a feature without any raises.
    """
    cuts = exact_quantiles(background, features, [0.25, 0.5, 0.75])
    if missing := [f for f in features if cuts[f][0] is None]:
        raise ValueError(f"no background values of {missing}")
    bins = {f: Bins(sorted(set(cuts[f])), [], [], [], [], []) for f in features}
    value = {f: F.nanvl(F.col(f).cast("double"), F.lit(None)) for f in features}
    cells = F.array(*[F.struct(F.lit(j).alias("j"), bins[f].of(value[f]).alias("b"), value[f].alias("v"))
                      for j, f in enumerate(features)])
    found = {(r["j"], r["b"]): r for r in (
        background.select(F.inline(cells)).filter("v is not null").groupBy("j", "b")
        .agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("spread"),
             F.min("v").alias("low"), F.max("v").alias("high")).collect())}
    for j, f in enumerate(features):
        at = bins[f]
        rows = [found.get((j, b)) for b in range(len(at.edges) + 1)]
        total = sum(r["n"] for r in rows if r)
        for r in rows:  # an empty bin (equal quartiles at the top) is never drawn
            at.shares.append(r["n"] / total if r else 0.0)
            for kept, name in ((at.means, "mean"), (at.spreads, "spread"), (at.lows, "low"), (at.highs, "high")):
                kept.append(r[name] if r else 0.0)
    return bins


@F.pandas_udf(T.DoubleType())
def _normal_quantile(share: pd.Series) -> pd.Series:
    inverse = NormalDist().inv_cdf
    return share.clip(1e-15, 1 - 1e-15).map(inverse).astype("float64")


def _drawing(feature: str, number: int, bins: Bins) -> Column:
    """What a draw of one feature needs: own value and bin, and per bin the reach of its share and a normal cut to it."""
    last = max(b for b, share in enumerate(bins.shares) if share)
    reach = [sum(bins.shares[:b + 1]) if b < last else 2.0 for b in range(len(bins.shares))]
    units = [NormalDist(m, s) if s else None for m, s in zip(bins.means, bins.spreads)]
    ends = [[u.cdf(x) if u else 0.5 for u, x in zip(units, side)] for side in (bins.lows, bins.highs)]
    lists = {"reach": reach, "first": ends[0], "last": ends[1], "mean": bins.means, "spread": bins.spreads,
             "low": bins.lows, "high": bins.highs}
    return F.struct(F.lit(number).alias("j"), F.col(feature).cast("double").alias("own"), bins.of(F.col(feature)).alias("home"),
                    *[F.array(*[F.lit(float(x)) for x in v]).alias(n) for n, v in lists.items()])


def perturbations(row: DataFrame, bins: dict[str, Bins], keys: Sequence[str], samples: int, seed: int) -> DataFrame:
    """The row itself (sample 0) and variations of it drawn bin by bin from the background.

    ``z_<f>`` is 1 where a sample is in the row's bin of the feature and 0 elsewhere; the
    weight falls with the number of zeros. Draws are hashes of keys, sample and feature,
    one row per sample and feature, which meet again by sample.
    """
    features = list(bins)
    draws = spread_rows(row.withColumn("_sample", F.explode(F.sequence(F.lit(0), F.lit(samples - 1)))))
    cells = draws.select(*keys, "_sample", F.inline(F.array(*[_drawing(f, j, bins[f]) for j, f in enumerate(features)])))
    cells = cells.withColumn("h", key_digest([*keys, "_sample", "j"], seed))
    cells = cells.withColumn("u", lane_unit(F.col("h"), 0)).withColumn("t", lane_unit(F.col("h"), 1))
    cells = cells.withColumn("b", F.size(F.filter("reach", lambda r: r <= F.col("u"))))
    at = {n: F.get(F.col(n), F.col("b")) for n in ("first", "last", "mean", "spread", "low", "high")}
    cells = cells.withColumn("n", _normal_quantile(at["first"] + F.col("t") * (at["last"] - at["first"])))
    itself = F.col("_sample") == 0
    value = F.greatest(at["low"], F.least(at["high"], at["mean"] + at["spread"] * F.col("n")))
    cells = cells.select(*keys, "_sample", "j", F.when(itself, F.col("own")).otherwise(value).alias("v"),
                         F.when(itself | (F.col("b") == F.col("home")), 1.0).otherwise(0.0).alias("z"))
    wide = cells.groupBy(*keys, "_sample").agg(
        F.array_sort(F.collect_list(F.struct("j", "v", "z"))).alias("c"), F.sum(1.0 - F.col("z")).alias("zeros"))
    return wide.select(*keys, "_sample", *[F.get("c", F.lit(j))["v"].alias(f) for j, f in enumerate(features)],
                       *[F.get("c", F.lit(j))["z"].alias(f"z_{f}") for j, f in enumerate(features)],
                       F.sqrt(F.exp(-F.col("zeros") / F.lit(0.75 ** 2 * len(features)))).alias("_weight"))


def _centered_moments(rows: DataFrame, width: int) -> np.ndarray:
    """Weighted second moments about the weighted mean, from rows of ``x`` (array) and ``w``.

    A batch becomes one small matrix; matrices are added up cell by cell.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            if len(batch):
                x = np.column_stack([np.ones(len(batch)), np.vstack(batch["x"])])
                total += (x * batch["w"].to_numpy()[:, None]).T @ x
        yield pd.DataFrame({"m": [total.ravel()]})

    cells = (rows.mapInPandas(partial, "m array<double>").select(F.posexplode("m"))
             .groupBy("pos").agg(F.sum("col").alias("s")).collect())
    sums = np.zeros((width + 1) ** 2)
    for r in cells:
        sums[r["pos"]] = r["s"]
    sums = sums.reshape(width + 1, width + 1)
    return sums[1:, 1:] - np.outer(sums[0, 1:], sums[0, 1:]) / sums[0, 0]


def _ridge(moments: np.ndarray, chosen: Sequence[int], penalty: float) -> np.ndarray:
    """Slopes of a weighted ridge fit with a free intercept, from centered second moments (the target last)."""
    own = moments[np.ix_(chosen, chosen)] + penalty * np.eye(len(chosen))
    return np.linalg.lstsq(own, moments[chosen, -1], rcond=None)[0]


def choose_features(moments: np.ndarray, here: np.ndarray, top: int) -> list[int]:
    """The features of the explanation: forward selection of up to six, beyond that the largest effects.

    Forward selection adds the feature that explains most of the target; ``here`` is the explained
    row, whose effects are compared.
    """
    count = len(moments) - 1
    if top > 6:
        effects = np.abs(_ridge(moments, range(count), 0.01) * here)
        return sorted(range(count), key=lambda j: (-effects[j], j))[:top]
    chosen: list[int] = []
    while len(chosen) < min(top, count):
        explained = {j: moments[[*chosen, j], -1] @ _ridge(moments, [*chosen, j], 0.0) for j in range(count) if j not in chosen}
        chosen.append(max(explained, key=lambda j: (explained[j], -j)))
    return chosen


def local_surrogate(model: Transformer, row: DataFrame, background: DataFrame,
                    features: Sequence[str], keys: Sequence[str], samples: int = 5000,
                    top: int = 10, seed: int = 42, ridge: float = 1.0) -> list[tuple[str, str, float]]:
    """(feature, condition, weight) of a local linear model around one row, largest magnitude first.

    ``row`` has a single row, without nulls. Features become the statement that a value lies in the
    row's quartile bin. The samples are scored by one ``transform`` and reduced to their weighted
    moments batch by batch; selection and fit need only those.
    """
    bins = quartile_bins(background, features)
    scored = model.transform(perturbations(row, bins, keys, samples, seed))
    moments = _centered_moments(scored.select(F.array(*[F.col(f"z_{f}") for f in features], F.col("prediction")).alias("x"),
                                              F.col("_weight").alias("w")), len(features) + 1)
    chosen = choose_features(moments, np.ones(len(features)), top)
    here = row.select(*[bins[f].of(F.col(f)).alias(f) for f in features]).first()
    weights = [(features[j], bins[features[j]].named(features[j], here[features[j]]), float(x))
               for j, x in zip(chosen, _ridge(moments, chosen, ridge))]
    return sorted(weights, key=lambda x: (-abs(x[2]), x[0]))
