"""Linear regression by averaged stochastic gradient descent.

Rows are dealt by key hash into shards of a bounded number of rows and packed once.
In every epoch each shard starts from the common parameters and takes mini-batch steps
through its rows, in an order seeded by epoch and shard; the step falls with the
number of steps taken and never exceeds what the mini-batch's curvature allows. A small
shard passes its rows several times. Its parameters, averaged over the steps of the epoch, and its
loss are averaged over the shards, by their rows, in one aggregate. The sums are
decimal, so their order does not matter: a seed gives the same result for any
partitioning. Training stops when the loss has not improved by the tolerance for some
epochs in a row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwell.functions.hashing import key_digest
from tripwell.operators.bounded import cached

SHARD_ROWS, MIN_SHARDS, LEAST_STEPS = 50_000, 4, 200
_EXACT = "decimal(38, 12)"


@dataclass
class StochasticFit:
    """Parameters in the units of the features, with the loss of every epoch."""

    features: list[str]
    intercept: float
    slopes: dict[str, float]
    losses: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", sum((F.lit(b) * F.col(f) for f, b in self.slopes.items()), F.lit(self.intercept)))


def descend(x: np.ndarray, y: np.ndarray, start: np.ndarray, epoch: int, rng: np.random.Generator, batch: int,
            step: float, power: float, penalty: float) -> tuple[np.ndarray, float]:
    """An epoch's mini-batch steps; the mean of the parameters after each step, and of the losses before it."""
    w, mean, loss, steps, width = start.copy(), np.zeros(len(start)), 0.0, 0, len(start)
    passes = max(1, -(-LEAST_STEPS // -(-len(x) // batch)))
    taken = epoch * passes * -(-len(x) // batch)
    for _ in range(passes):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            some, wanted = x[order[at:at + batch]], y[order[at:at + batch]]
            gap = some @ w[1:] + w[0] - wanted
            loss += float(gap @ gap) / 2
            curvature = 1 + np.einsum("ij,ij->", some, some) / len(some)  # the largest eigenvalue is no larger
            rate = min(step, 1 / width) / (taken + steps + 1) ** power / max(1.0, curvature / width)
            w -= rate * np.append(gap.mean(), some.T @ gap / len(some) + penalty * w[1:])
            mean += w
            steps += 1
    return mean / max(1, steps), loss / passes


def _packed(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], shards: int, seed: int) -> DataFrame:
    """(shard, n, x, y): the rows of a shard in order of their hash, as bytes."""
    digest = key_digest(keys, seed)
    rows = df.select(*[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)],
                     F.col(label).cast("double").alias("_y"), digest.alias("_digest"),
                     F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int").alias("_shard"))
    columns = [f"_x{i}" for i in range(len(features))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, held = None, []

        def made() -> pd.DataFrame:
            whole = pd.concat(held)
            return pd.DataFrame({"shard": [shard], "n": [len(whole)], "y": [whole["_y"].to_numpy("float64").tobytes()],
                                 "x": [whole[columns].to_numpy("float64").tobytes()]})

        for batch in batches:
            for number, part in batch.groupby("_shard", sort=False):
                if held and number != shard:
                    yield made()
                    held = []
                shard = number
                held.append(part)
        if held:
            yield made()

    dealt = rows.repartition(shards, "_shard").sortWithinPartitions("_shard", "_digest", *columns, "_y")
    return dealt.mapInPandas(run, "shard int, n long, y binary, x binary")


def fit_stochastic(train: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], epochs: int = 1000,
                   tolerance: float = 1e-3, patience: int = 5, batch: int = 32, step: float = 0.1, power: float = 0.1,
                   penalty: float = 1e-4, seed: int = 42) -> StochasticFit:
    """Least squares with a small quadratic penalty, on standardised features. Rows with a null are skipped."""
    names = list(features)
    whole = train.dropna(subset=[*names, label])
    # Moments as decimals: the same for any partitioning.
    count = whole.count()
    if not count:
        raise ValueError("no rows to learn from")
    exact = {n: F.col(n).cast("double").cast(_EXACT) for n in names}
    means = [float(m) for m in whole.agg(*[(F.sum(exact[n]) / count).cast("double").alias(n) for n in names]).first()]
    gaps = [(F.col(n).cast("double") - F.lit(m)) for n, m in zip(names, means)]
    spread = [float(v) ** 0.5 or 1.0 for v in whole.agg(
        *[(F.sum((g * g).cast(_EXACT)) / count).cast("double").alias(n) for n, g in zip(names, gaps)]).first()]
    scaled = whole.withColumns({n: g / F.lit(s) for n, g, s in zip(names, gaps, spread)})
    shards = max(MIN_SHARDS, -(-count // SHARD_ROWS))
    packed = cached(_packed(scaled, names, label, keys, shards, seed))
    width = len(names) + 1
    columns = [f"w{i}" for i in range(width)]

    def epoch(number: int, start: np.ndarray) -> tuple[np.ndarray, float]:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for some in batches:
                for shard, n, y, x in zip(some["shard"], some["n"], some["y"], some["x"]):
                    w, loss = descend(np.frombuffer(x).reshape(n, width - 1), np.frombuffer(y), start, number,
                                      np.random.default_rng([seed, number, shard]), batch, step, power, penalty)
                    yield pd.DataFrame([[n, loss, *(w * n)]], columns=["n", "loss", *columns])

        made = packed.mapInPandas(run, "n long, loss double, " + ", ".join(f"{c} double" for c in columns))
        got = made.agg((F.sum(F.col("loss").cast(_EXACT)) / count).cast("double").alias("loss"),
                       *[(F.sum(F.col(c).cast(_EXACT)) / count).cast("double").alias(c) for c in columns]).first()
        return np.array([got[c] for c in columns]), got["loss"]

    try:
        w, losses, best, waited = np.zeros(width), [], np.inf, 0
        for number in range(epochs):
            w, loss = epoch(number, w)
            losses.append(loss)
            waited = 0 if loss < best - tolerance else waited + 1
            best = min(best, loss)
            if waited >= patience:
                break
    finally:
        packed.unpersist()
    slopes = {n: float(b / s) for n, b, s in zip(names, w[1:], spread)}
    return StochasticFit(names, float(w[0] - sum(slopes[n] * m for n, m in zip(names, means))), slopes, losses)
