"""Splits, samples, folds and bootstraps."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwell.functions.hashing import POISSON_CUTS, poisson_weight, row_fingerprint, unit_hash
from tripwell.operators import bootstrap, resampling, sampling
from tripwell.session import initial_shuffle_partitions


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(20_000).withColumn("x", (F.col("id") % 97).cast("double")).persist()


def test_splits_partition_the_rows(rows):
    parts = sampling.random_split(rows, ["id"])
    counts = {n: d.count() for n, d in parts.items()}
    assert sum(counts.values()) == 20_000
    assert abs(counts["train"] / 20_000 - 0.70) < 0.02
    assert abs(counts["test"] / 20_000 - 0.15) < 0.02


def test_split_does_not_depend_on_partitioning(rows):
    a = sampling.assign_split(rows, ["id"])
    b = sampling.assign_split(rows.repartition(7), ["id"])
    assert a.exceptAll(b).count() == 0


def test_samples_and_folds_of_a_split_are_fair(rows):
    train = sampling.random_split(rows, ["id"])["train"]
    n = train.count()
    assert abs(sampling.sample_fraction(train, ["id"], 0.1).count() / n - 0.1) < 0.01
    folds = [r["count"] for r in sampling.kfold_assign(train, ["id"], 5).groupBy("fold").count().collect()]
    assert len(folds) == 5 and max(folds) - min(folds) < 0.1 * n / 5


@pytest.mark.parametrize("n", [1, 10, 500, 19_999, 20_000, 30_000])
def test_exact_sample_equals_the_ordered_limit(rows, n):
    got = {r["id"] for r in sampling.sample_exact(rows, ["id"], n).collect()}
    want = {r["id"] for r in rows.withColumn("u", unit_hash(["id"])).orderBy("u", "id").limit(n).collect()}
    assert len(got) == min(n, 20_000) and got == want


def test_shuffle_partitions_follow_the_input():
    assert initial_shuffle_partitions(10) == 200
    assert initial_shuffle_partitions(1024 ** 4) == 4096
    assert initial_shuffle_partitions(100 * 1024 ** 4) == 409_600
    assert initial_shuffle_partitions(100 * 1024 ** 4, 1024 ** 3) == 102_400


def test_exact_sample_of_copies(spark):
    df = spark.createDataFrame([(1,)] * 1000, "id int")
    assert sampling.sample_exact(df, ["id"], 10).count() == 10


def test_fingerprint_serves_as_key(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "s string, n int")
    keyed = df.withColumn("k", row_fingerprint(["s", "n"]))
    assert sampling.assign_split(keyed, ["k"]).count() == 2


def test_poisson_weight_inverts_the_cuts(spark):
    draws = [0.0, *[c for c in POISSON_CUTS], 0.9999999999]
    df = spark.createDataFrame([(u,) for u in draws], "u double")
    assert [r[0] for r in df.select(poisson_weight(F.col("u"))).collect()] == [*range(10), 9]


def test_bootstrap_weights_average_one(rows):
    stats = (bootstrap.bootstrap_weights(rows, ["id"], 6).groupBy("replicate")
             .agg(F.avg("weight").alias("m"), F.var_pop("weight").alias("v"), F.count("*").alias("n")).collect())
    assert sorted(r["replicate"] for r in stats) == [1, 2, 3, 4, 5, 6]
    for r in stats:
        assert r["n"] == 20_000 and abs(r["m"] - 1) < 0.03 and abs(r["v"] - 1) < 0.06


def test_bootstrap_matches_the_long_form(rows):
    df = rows.withColumn("p", F.col("x") + (F.col("id") % 5))
    fast = {r["replicate"]: r["rmse"] for r in bootstrap.bootstrap_rmse(df, ["id"], "x", "p", 5).collect()}
    long = (bootstrap.bootstrap_weights(df, ["id"], 5).join(df, "id").groupBy("replicate")
            .agg(F.sqrt(F.sum(F.col("weight") * (F.col("p") - F.col("x")) ** 2) / F.sum("weight")).alias("r")))
    for r in long.collect():
        assert fast[r["replicate"]] == pytest.approx(r["r"], rel=1e-12)


def test_bootstrap_mean_is_near_the_plain_metric(rows):
    df = rows.withColumn("p", F.col("x") + (F.col("id") % 5))
    plain = np.sqrt(np.mean([(i % 5) ** 2 for i in range(20_000)]))
    s = bootstrap.rmse_bootstrap_ci(df, ["id"], "x", "p", 40).first()
    assert abs(s["mean"] - plain) < 3 * s["std"]
    assert s["ci_lower"] <= s["mean"] <= s["ci_upper"] and s["n_bootstraps"] == 40


# ---- exactly n draws

def twin_weights(ids, replicates, seed, ranges):
    """The same draws in plain numpy, for keys that are single integers."""
    import hashlib

    digests = {i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest() for i in ids}
    range_of = {i: int(digests[i][:3], 16) // (resampling.MAX_RANGES // ranges) for i in ids}
    counts = np.bincount([range_of[i] for i in ids], minlength=ranges)
    draws = resampling.split_draws(counts, replicates, seed)
    found = {}
    for number in range(ranges):
        mine = sorted((i for i in ids if range_of[i] == number), key=lambda i: (digests[i], i))
        left, rows = draws[number].copy(), len(mine)
        for block, at in enumerate(range(0, len(mine), resampling.BLOCK_ROWS)):
            some = mine[at:at + resampling.BLOCK_ROWS]
            rng = np.random.default_rng([seed, 1, number, block])
            here = rng.binomial(left, len(some) / rows)
            left, rows = left - here, rows - len(some)
            columns = [np.bincount(rng.integers(0, len(some), n), minlength=len(some)) for n in here]
            found |= {i: [int(c[k]) for c in columns] for k, i in enumerate(some)}
    return found


@pytest.mark.parametrize("block,range_rows", [(4096, 20_000), (37, 100)])
def test_multinomial_weights_equal_their_twin(spark, monkeypatch, block, range_rows):
    monkeypatch.setattr(resampling, "BLOCK_ROWS", block)
    monkeypatch.setattr(resampling, "RANGE_ROWS", range_rows)
    ids = list(range(0, 3000, 2))
    ranges = 1 if range_rows == 20_000 else 16
    want = twin_weights(ids, 12, 5, ranges)
    sums = []
    for parts in (1, 7):
        df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(parts)
        # Blocks are cut in the workers, so only what the driver does follows a changed block.
        got = {r["id"]: r["weights"] for r in resampling.multinomial_weights(df, ["id"], 12, 5).collect()}
        sums.append(np.sum(list(got.values()), axis=0).tolist())
        if block == 4096:
            assert got == want
    assert sums == [[1500] * 12] * 2
    assert np.sum(list(want.values()), axis=0).tolist() == [1500] * 12


def test_multinomial_draws_are_not_capped_and_even():
    counts = np.array([1, 0, 3, 996])
    draws = resampling.split_draws(counts, 4000, 1)
    assert (draws.sum(axis=0) == 1000).all() and (draws[1] == 0).all()
    assert draws.mean(axis=1) == pytest.approx([1, 0, 3, 996], abs=0.15) and draws[0].var() == pytest.approx(1, abs=0.1)
    lone = resampling.RangeDraws(0, 1, np.array([50]), 1).weights(1)
    assert lone.tolist() == [[50]]


def test_multinomial_interval_and_empty_tables(spark):
    df = spark.range(2000).select("id", (F.col("id") % 10).cast("double").alias("x"), F.lit(4.0).alias("p"))
    plain = df.agg(F.sqrt(F.avg((F.col("x") - F.col("p")) ** 2))).first()[0]
    s = resampling.multinomial_rmse_ci(df, ["id"], "x", "p", 60).first()
    assert s["ci_lower"] <= plain <= s["ci_upper"] and s["n_bootstraps"] == 60
    means = resampling.multinomial_means(df, ["id"], F.col("x"), 5).collect()
    assert [r["n"] for r in means] == [2000] * 5
    weights = {r["id"]: r["weights"] for r in resampling.multinomial_weights(df, ["id"], 5).collect()}
    for r in means:
        assert r["mean"] == pytest.approx(sum(w[r["replicate"] - 1] * (i % 10) for i, w in weights.items()) / 2000)
    assert resampling.multinomial_weights(df.limit(0), ["id"], 3).count() == 0
    copies = spark.createDataFrame([(1,)] * 30, "id long")
    assert np.sum([r["weights"] for r in resampling.multinomial_weights(copies, ["id"], 3).collect()], axis=0).tolist() == [30] * 3
