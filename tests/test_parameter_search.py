"""The Parzen sampler, successive halving and the forest search."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwell.operators import parameter_search as search
from tripwell.operators import regression

SPACE = {"a": (1, 100), "b": (1, 100)}


def planted(setting, share=1.0):
    return ((setting["a"] - 73) / 100) ** 2 + ((setting["b"] - 21) / 100) ** 2


def _trials_until(log, bound):
    return next((i + 1 for i, e in enumerate(log) if e.loss <= bound), len(log) + 1)


def test_planted_optimum_in_fewer_trials_than_random():
    guided, blind = [], []
    for seed in range(20):
        log = search.halving_search(planted, SPACE, rounds=60, width=2, shares=(1.0,), parallelism=1, seed=seed)
        guided.append(_trials_until(log, 0.002))
        draw = search.ParzenSampler(SPACE, seed + 1000)
        blind.append(_trials_until([search.Evaluation(i, 0, 1.0, s, planted(s)) for i in range(120)
                                    for s in [draw.random()]], 0.002))
    assert np.mean(guided) < 0.6 * np.mean(blind)


def test_density_is_a_distribution_that_peaks_at_what_was_seen():
    found = search.ParzenSampler.density([70, 72, 74], 1, 100)
    assert found.shape == (100,) and math.isclose(found.sum(), 1.0) and (found > 0).all()
    assert 65 <= found.argmax() + 1 <= 79
    assert search.ParzenSampler.density([5, 5], 5, 5).tolist() == [1.0]


def test_halving_passes_the_better_half_and_repeats():
    calls = []

    def evaluate(setting, share):
        calls.append(share)
        return planted(setting)

    log = search.halving_search(evaluate, SPACE, rounds=2, width=4, shares=(0.1, 0.5, 1.0), keep=0.5, parallelism=1)
    assert calls == 2 * ([0.1] * 4 + [0.5] * 2 + [1.0])
    for turn in range(2):
        first = sorted((e.loss, e.trial) for e in log if e.round == turn and e.share == 0.1)
        assert {e.trial for e in log if e.round == turn and e.share == 0.5} == {t for _, t in first[:2]}
    again = search.halving_search(evaluate, SPACE, rounds=2, width=4, shares=(0.1, 0.5, 1.0), keep=0.5, parallelism=4)
    assert again == log
    assert search.best_evaluation(log).loss == min(e.loss for e in log if e.share == 1.0)


def test_small_spaces_and_losses_that_are_not_numbers():
    log = search.halving_search(lambda s, share: float("nan") if s["a"] == 1 else s["a"], {"a": (1, 3)},
                                rounds=4, width=2, shares=(1.0,), parallelism=1)
    assert len(log) == 8 and {e.setting["a"] for e in log} == {1, 2, 3}
    assert search.best_evaluation(log).setting == {"a": 2}
    with pytest.raises(ValueError):
        search.halving_search(planted, SPACE, shares=(1.0, 0.5))
    with pytest.raises(ValueError):
        search.ParzenSampler({"a": (3, 1)})


def test_forest_search_logs_what_a_refit_gives(spark):
    rows = spark.range(2000).select("id", (F.col("id") % 20).cast("double").alias("x"),
                                    (F.col("id") % 7).cast("double").alias("y"))
    rows = rows.withColumn("fare_amount", F.col("x") * F.col("x") + F.col("y"))
    train, check = rows.where("id % 5 > 0"), rows.where("id % 5 = 0")
    log = search.forest_search(train, check, ["x", "y"], ["id"],
                               {"trees": (3, 5), "depth": (1, 7), "min_rows": (1, 3)}, rounds=2, width=3)
    assert {e.share for e in log} == {0.1, 1.0} and all(math.isfinite(e.loss) for e in log)
    best = search.best_evaluation(log)
    assert best.loss == min(e.loss for e in log if e.share == 1.0)
    forest = regression.random_forest(trees=best.setting["trees"], depth=best.setting["depth"],
                                      minInstancesPerNode=best.setting["min_rows"])
    model = regression.fit_pipeline(train, ["x", "y"], forest)
    assert regression.model_metrics(model, check)["rmse"] == pytest.approx(best.loss, rel=0.2)
