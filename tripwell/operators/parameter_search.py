"""Model parameters by a tree-structured Parzen sampler with successive halving.

Every round proposes a few settings and fits them on a small share of the training rows;
the better ones go on to larger shares. The shares are nested, since a row's share comes
from the hash of its key: what a larger share adds is new rows, and a rerun sees the same.
The sampler learns from the largest share that has enough results. Only settings and their
errors reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwell.functions.hashing import unit_hash
from tripwell.operators.bounded import cached, in_parallel, side_by_side
from tripwell.operators.regression import LABEL, model_metrics, preparation, random_forest

Setting = dict[str, int]
FOREST_SPACE = {"trees": (20, 60), "depth": (4, 10), "min_rows": (1, 10)}


@dataclass
class Evaluation:
    """One fit: which setting on which share of the rows, and its validation error."""

    trial: int
    round: int
    share: float
    setting: Setting
    loss: float


class ParzenSampler:
    """Proposes settings where good results are dense and poor ones are not.

    Every parameter is an integer range. Its density is a mixture of normal curves, one per
    observed value and one as wide as the range, cut to the range and normalised over its
    integers. A curve reaches as far as the larger gap to the neighbouring observed values.
    """

    def __init__(self, space: Mapping[str, tuple[int, int]], seed: int = 42, good: float = 0.25,
                 candidates: int = 24) -> None:
        for name, (low, high) in space.items():
            if low > high:
                raise ValueError(f"empty range of {name}")
        self.space, self.good, self.candidates = dict(space), good, candidates
        self.draw = np.random.default_rng(seed)

    def random(self) -> Setting:
        return {n: int(self.draw.integers(low, high + 1)) for n, (low, high) in self.space.items()}

    @staticmethod
    def density(values: Sequence[int], low: int, high: int) -> np.ndarray:
        """Probability of every integer from low to high."""
        grid = np.arange(low, high + 1, dtype="float64")
        span = max(high - low, 1)
        at = np.sort(np.asarray([*values, (low + high) / 2], dtype="float64"))
        edges = np.concatenate([[low], at, [high]])
        reach = np.maximum(np.diff(edges)[:-1], np.diff(edges)[1:])
        width = np.clip(reach, max(span / min(100, len(at) + 1), 0.5), span)
        centres, width = np.append(at, (low + high) / 2), np.append(width, span)
        curves = np.exp(-0.5 * ((grid[None, :] - centres[:, None]) / width[:, None]) ** 2)
        return (curves / curves.sum(axis=1, keepdims=True)).mean(axis=0)

    def propose(self, seen: Sequence[tuple[Setting, float]], tried: set[tuple]) -> Setting:
        """The candidate with the largest ratio of both densities that was not tried before.

        Without results the setting is random, and so it is if all candidates were tried.
        """
        fresh = [s for s in (self.random() for _ in range(self.candidates)) if tuple(s.values()) not in tried]
        if len(seen) < 2 * len(self.space):
            return fresh[0] if fresh else self.random()
        ranked = sorted(seen, key=lambda r: (math.isnan(r[1]), r[1]))
        cut = max(2, math.ceil(self.good * len(ranked)))
        columns, score = {}, np.zeros(self.candidates)
        for name, (low, high) in self.space.items():
            better = self.density([s[name] for s, _ in ranked[:cut]], low, high)
            worse = self.density([s[name] for s, _ in ranked[cut:]], low, high)
            picks = self.draw.choice(len(better), self.candidates, p=better)
            columns[name] = picks + low
            score += np.log(better[picks]) - np.log(worse[picks])
        for i in np.argsort(-score, kind="stable"):
            found = {n: int(c[i]) for n, c in columns.items()}
            if tuple(found.values()) not in tried:
                return found
        return fresh[0] if fresh else self.random()


def halving_search(evaluate: Callable[[Setting, float], float], space: Mapping[str, tuple[int, int]],
                   rounds: int = 3, width: int = 3, shares: Sequence[float] = (0.1, 1.0), keep: float = 1 / 3,
                   parallelism: int = 4, seed: int = 42, good: float = 0.25) -> list[Evaluation]:
    """All evaluations in order. ``evaluate(setting, share)`` returns a loss; less is better.

    A round proposes ``width`` settings and passes the best ``keep`` of them, at least one,
    from each share to the next. A loss that is not a number ranks last. Settings of a round
    are evaluated side by side, so they learn from the rounds before only.
    """
    if not shares or list(shares) != sorted(set(shares)) or shares[0] <= 0 or shares[-1] > 1:
        raise ValueError("shares must rise within (0, 1]")
    sampler, log, tried, trial = ParzenSampler(space, seed, good), [], set(), 0
    for turn in range(rounds):
        batch, known = [], _most_telling(log, shares, 2 * len(space))
        for _ in range(width):
            setting = sampler.propose(known, tried)
            tried.add(tuple(setting.values()))
            batch.append((trial, setting))
            trial += 1
        for share in shares:
            losses = in_parallel([lambda s=s: float(evaluate(s, share)) for _, s in batch], parallelism)
            log.extend(Evaluation(t, turn, share, s, loss) for (t, s), loss in zip(batch, losses))
            order = sorted(range(len(batch)), key=lambda i: (math.isnan(losses[i]), losses[i], batch[i][0]))
            batch = [batch[i] for i in sorted(order[:max(1, math.ceil(keep * len(batch)))])]
    return log


def _most_telling(log: Sequence[Evaluation], shares: Sequence[float], enough: int) -> list[tuple[Setting, float]]:
    """Results on the largest share that has ``enough`` of them, else on the smallest share."""
    for share in reversed(shares):
        found = [(e.setting, e.loss) for e in log if e.share == share]
        if len(found) >= enough or share == shares[0]:
            return found
    return []


def best_evaluation(log: Sequence[Evaluation]) -> Evaluation:
    """Least loss on the largest share; the earlier trial wins a tie."""
    full = max(e.share for e in log)
    return min((e for e in log if e.share == full), key=lambda e: (math.isnan(e.loss), e.loss, e.trial))


def forest_search(train: DataFrame, validation: DataFrame, features: Sequence[str], keys: Sequence[str],
                  space: Mapping[str, tuple[int, int]] | None = None, label: str = LABEL, seed: int = 42,
                  **search) -> list[Evaluation]:
    """Search the number of trees, depth and smallest leaf of a forest by validation error.

    Features are prepared once, on all training rows. Every fit reads the rows below its
    share's hash threshold from the cached table, and is scored on all validation rows.
    """
    prepared = Pipeline(stages=preparation(features)).fit(train)
    rows = train.withColumn("_u", unit_hash(keys, seed))
    fit_input = cached(prepared.transform(rows).select("features", label, "_u"))
    check = cached(prepared.transform(validation).select("features", label))

    def evaluate(setting: Setting, share: float) -> float:
        part = fit_input if share >= 1 else fit_input.where(F.col("_u") < F.lit(float(share)))
        forest = random_forest(label, setting["trees"], setting["depth"], seed, minInstancesPerNode=setting["min_rows"])
        return model_metrics(forest.fit(part), check, label, ["rmse"])["rmse"]

    try:
        search.setdefault("parallelism", side_by_side(fit_input.count(), 4))
        return halving_search(evaluate, space or FOREST_SPACE, seed=seed, **search)
    finally:
        fit_input.unpersist()
        check.unpersist()
