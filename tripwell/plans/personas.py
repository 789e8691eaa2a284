"""From refined trips to named trip personas."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwell.operators.bounded import cached, cached_if_few, pin_small
from tripwell.operators.cleaning import drop_nulls, filter_below, filter_logical
from tripwell.operators.clustering import (
    CLUSTER_FEATURES, assign_nearest, centers_frame, kmeans_restarts)
from tripwell.operators.encoding import vector_assemble
from tripwell.operators.packed_means import FEW_ROWS
from tripwell.operators.ranking import persona_rank
from tripwell.operators.scaling import inverse_scale, standard_scale

PLOT_BOUNDS = {"trip_distance": 50.0, "fare_amount": 150.0}


def personas_pipeline(trips: DataFrame, k: int = 4, restarts: int = 10, max_iter: int = 300, seed: int = 42) -> DataFrame:
    """One row per persona: name, size, mean fare and center in original units.

    Rows outside the plotting bounds are left out, all others are standardised and
    clustered with several restarts, and clusters are named by rank of their mean fare.
    """
    features = list(CLUSTER_FEATURES)
    scaled_names = [f"{f}_scaled" for f in features]
    kept = filter_below(filter_logical(drop_nulls(trips, features)), PLOT_BOUNDS)
    sample = cached(kept.select(*features))
    try:
        scaled = standard_scale(sample, features, population=True)
        vectors = cached_if_few(vector_assemble(scaled, scaled_names).select("features"), FEW_ROWS)
        try:
            trials = kmeans_restarts(vectors, k, restarts, seed, max_iter)
        finally:
            vectors.unpersist()
        centers = np.array(min(trials, key=lambda t: t.cost).model.clusterCenters())
        labelled = assign_nearest(scaled, scaled_names, centers.tolist())
        profile = labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"),
                                                  F.avg("fare_amount").alias("avg_fare"))
        named = pin_small(persona_rank(profile))
        original = pin_small(inverse_scale(
            centers_frame(trips.sparkSession, centers, scaled_names), sample, features))
        return named.join(original, "cluster").orderBy("persona_rank")
    finally:
        sample.unpersist()
