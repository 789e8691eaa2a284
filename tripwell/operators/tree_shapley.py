"""Exact Shapley values of tree ensembles, path-dependent.

The value of a set of features is what a tree predicts when only these are known: at
a split on an unknown feature both sides count, by their shares of the training rows.
A leaf of value v, whose path splits on the features F, adds to feature i

    v * (o_i - z_i) * sum over S in F without i of |S|! (|F| - |S| - 1)! / |F|!
                      * product of o_j for j in S * product of z_j for the others

where o_j says whether the row passes all splits of the path on j, and z_j is the
product of the shares of these splits. Splits on one feature merge into an interval,
so a row is described by one bit per feature, and the sum is worked out once for each
pattern of bits, not for each row.

A row's values add up to its prediction minus the expected one. Rows are not
multiplied: each becomes one row of contributions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwell.operators.bounded import spread_rows

MAX_NODES = 500_000
BATCH_ROWS = 8192
MAX_INTERVALS = 2048  # comparisons of a batch that are kept
TABLE_BYTES = 256 * 1024 ** 2  # tables of patterns that a task keeps


@dataclass
class Leaf:
    """A leaf with one interval (low, high] and one share for each feature of its path."""

    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    shares: np.ndarray


def ensemble_nodes(spark: SparkSession, path: str) -> DataFrame:
    """(tree, id, prediction, cover, left, right, feature, threshold, categories) of a stored pipeline's last stage."""
    stages = spark.read.json(f"{path}/metadata").select(F.explode("paramMap.stageUids").alias("uid")).collect()
    number = len(stages) - 1
    digits = len(str(len(stages)))
    data = spark.read.parquet(f"{path}/stages/{number:0{digits}d}_{stages[-1].uid}/data")
    node = "nodeData" if "nodeData" in data.columns else None
    tree = "treeID" if "treeID" in data.columns else None
    one = data.select((F.col(tree) if tree else F.lit(0)).alias("tree"), *([F.col(f"{node}.*")] if node else ["*"]))
    return one.select("tree", "id", "prediction", F.get("impurityStats", F.lit(0)).alias("cover"), F.col("leftChild").alias("left"),
                      F.col("rightChild").alias("right"), F.col("split.featureIndex").alias("feature"),
                      F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
                      F.col("split.numCategories").alias("categories"))


def tree_leaves(nodes: dict[int, tuple], scale: float = 1.0) -> list[Leaf]:
    """Leaves of one tree; ``nodes`` maps an id to (prediction, cover, left, right, feature, threshold)."""
    leaves = []
    waiting = [(0, {})]
    while waiting:
        at, path = waiting.pop()
        prediction, cover, left, right, feature, threshold = nodes[at]
        if left < 0:
            names = sorted(path)
            low, high, share = (np.array([path[f][i] for f in names]) for i in range(3))
            leaves.append(Leaf(prediction * scale, np.array(names, int), low, high, share))
            continue
        low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
        part = nodes[left][1] / cover if cover else 0.5
        waiting.append((left, {**path, feature: (low, min(high, threshold), share * part)}))
        waiting.append((right, {**path, feature: (max(low, threshold), high, share * (1 - part))}))
    return leaves


def pattern_values(shares: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """For each pattern of bits (rows) the weights by which a leaf's value goes to its features."""
    m = len(shares)
    weights = np.array([math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)])
    passed = ((patterns[:, None] >> np.arange(m)) & 1).astype(float)
    whole = np.zeros((len(patterns), m + 1))  # sums of products over all features, by how many are known
    whole[:, 0] = 1.0
    for j in range(m):
        grown = whole[:, :-1] * passed[:, j, None]
        whole *= shares[j]
        whole[:, 1:] += grown
    # Without feature i: its factor is divided out, from the top where shares of at most one keep it stable.
    least = np.maximum(shares, 1e-300)
    total, above = np.zeros((len(patterns), m)), np.zeros((len(patterns), m))
    for s in range(m - 1, -1, -1):
        above = np.where(passed > 0, whole[:, s + 1, None] - shares * above, whole[:, s, None] / least)
        total += weights[s] * above
    return (passed - shares) * total


def leaf_contributions(leaves: Sequence[Leaf], x: np.ndarray, tables: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """Contributions of every feature (columns) for every row of ``x``.

    Leaves share most of their intervals, so a row is compared with each interval once. A batch
    with more rows than a leaf has patterns looks its values up in a table of all patterns;
    ``tables`` keeps these from batch to batch, up to ``TABLE_BYTES``.
    """
    total = np.zeros(x.shape[::-1])
    columns = np.ascontiguousarray(x.T)
    tables = {} if tables is None else tables
    kept = sum(t.nbytes for t in tables.values())
    inside: dict[tuple, np.ndarray] = {}
    kind = np.int32 if max((len(leaf.features) for leaf in leaves), default=0) < 31 else np.int64
    code, bit_of, found = np.empty(len(x), kind), np.empty(len(x), kind), np.empty(len(x))
    for number, leaf in enumerate(leaves):
        bits = len(leaf.features)
        if not bits:
            continue
        code[:] = 0
        for bit, (f, low, high) in enumerate(zip(leaf.features.tolist(), leaf.low.tolist(), leaf.high.tolist())):
            passed = inside.get((f, low, high))
            if passed is None:
                if len(inside) >= MAX_INTERVALS:
                    inside.clear()
                passed = inside[f, low, high] = ((columns[f] > low) & (columns[f] <= high)).astype(kind)
            np.bitwise_or(code, np.left_shift(passed, bit, out=bit_of), out=code)
        if 1 << bits <= max(len(x), 1):
            values, at = tables.get(number), code.astype(np.intp)
            if values is None:
                values = np.ascontiguousarray((leaf.value * pattern_values(leaf.shares, np.arange(1 << bits))).T)
                if kept + values.nbytes <= TABLE_BYTES:
                    tables[number] = values
                    kept += values.nbytes
        else:
            patterns, at = np.unique(code, return_inverse=True)
            values = np.ascontiguousarray((leaf.value * pattern_values(leaf.shares, patterns)).T)
        for f, column in zip(leaf.features, values):
            total[f] += np.take(column, at, out=found, mode="clip")
    return total.T


def tree_shapley_values(model: PipelineModel, path: str, rows: DataFrame, features: Sequence[str],
                        keys: Sequence[str], max_nodes: int = MAX_NODES) -> DataFrame:
    """Per row: the keys, ``expected`` and one contribution under each feature's name.

    ``path`` is where ``model`` is stored; its last stage is an ensemble of trees with
    numeric splits. The ensemble is broadcast; one of more than ``max_nodes`` nodes is
    refused.
    """
    spark = rows.sparkSession
    stored = ensemble_nodes(spark, path)
    count = stored.count()
    if count > max_nodes:
        raise ValueError(f"the ensemble has {count} nodes, more than the {max_nodes} that tasks may hold")
    trees: dict[int, dict[int, tuple]] = {}
    for r in stored.collect():
        if r.left >= 0 and r.categories >= 0:
            raise ValueError("splits on categories are not supported")
        trees.setdefault(r.tree, {})[r.id] = (r.prediction, r.cover, r.left, r.right, r.feature, r.threshold)
    last = model.stages[-1]
    weights = [float(w) for w in last.treeWeights] if hasattr(last, "treeWeights") else [1.0]
    scale = 1.0 / len(trees) if "RandomForest" in type(last).__name__ else 1.0
    leaves = [leaf for t in sorted(trees) for leaf in tree_leaves(trees[t], weights[t] * scale)]
    expected = float(sum(leaf.value * leaf.shares.prod() for leaf in leaves))
    shared = spark.sparkContext.broadcast(leaves)
    # An added column carries the features as the trees see them, after the pipeline's scaling.
    vector = "_" * max(map(len, rows.columns)) + "seen"
    seen = rows
    for stage in model.stages[:-1]:
        seen = stage.transform(seen)
    seen = seen.select(*keys, vector_to_array(last.getFeaturesCol()).alias(vector))
    if seen.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        seen = spread_rows(seen)  # a row costs as many steps as the ensemble has leaves
    names = list(features)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, len(batch), BATCH_ROWS):
                part = batch.iloc[at:at + BATCH_ROWS]
                found = leaf_contributions(shared.value, np.array(part[vector].tolist(), "float64").reshape(len(part), len(names)), tables)
                yield pd.concat([part[list(keys)].reset_index(drop=True),
                                 pd.DataFrame({"expected": np.full(len(part), expected),
                                               **{n: found[:, j] for j, n in enumerate(names)}})], axis=1)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in seen.schema if f.name != vector]
                       + ["expected double"] + [f"`{n}` double" for n in names])
    return seen.mapInPandas(run, schema)


def mean_absolute_values(contributions: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature_name, mean_abs_contribution), largest first."""
    means = contributions.agg(*[F.avg(F.abs(f)).alias(f) for f in features])
    cells = F.array(*[F.struct(F.lit(f).alias("feature_name"), F.col(f).alias("mean_abs_contribution")) for f in features])
    return means.select(F.inline(cells)).orderBy(F.desc("mean_abs_contribution"), "feature_name")
