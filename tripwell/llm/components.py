"""Connected components of a graph held as a table of edges.

Every round gives each node the smallest of itself and its neighbours as parent,
follows parents to their roots, and keeps only edges between different roots. At
least half of the nodes that still have an edge disappear in a round, so the number
of rounds is at most the logarithm of the largest component. All steps are minima
and joins: no list of neighbours is ever built, nothing is collected, and every
round is stored in the shared folder, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwell.sources.storage import store


def _roots(parents: DataFrame) -> DataFrame:
    """Follow ``parent`` until every node points at a node that is its own parent."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        parents = store(parents.join(up, "parent").select("node", "parent", "grand"), "jump")
        moved = parents.where("grand <> parent").limit(1).count()
        parents = parents.select("node", F.col("grand").alias("parent"))
        if not moved:
            return parents


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge between different nodes; root is the component's smallest node.

    Edges may repeat and point either way; those with a null end or equal ends are ignored.
    """
    left = store(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "edges")
    labels = None
    while left.limit(1).count():
        both = left.union(left.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("parent"))
        parents = _roots(store(parents, "parents"))
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("root"))
        else:
            step = parents.select(F.col("node").alias("root"), F.col("parent").alias("next"))
            labels = store(labels.join(step, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")), "labels")
        ends = [parents.select(F.col("node").alias(x), F.col("parent").alias(f"root_{x}")) for x in "ab"]
        moved = left.join(ends[0], "a").join(ends[1], "b").where("root_a <> root_b")
        left = store(moved.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(), "edges")
    return labels if labels is not None else left.select(F.col("a").alias("node"), F.col("b").alias("root"))
