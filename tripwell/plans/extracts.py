"""Scaling measurements for the dashboards."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tripwell.operators.sampling import sample_fraction


def scaling_extract(df: DataFrame, keys: Sequence[str], job: Callable[[DataFrame], DataFrame],
                    partitions: Sequence[int] = (50, 100, 200),
                    fractions: Sequence[float] = (0.2, 0.4, 0.6, 0.8, 1.0)) -> DataFrame:
    """Seconds of the same job by shuffle partitions and by share of the rows.

    Returns (kind, level, seconds): kind ``strong`` varies the partitions on all
    rows, kind ``weak`` varies the fraction of the rows.
    """
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = []

    def timed(kind: str, level: float, source: DataFrame) -> None:
        start = time.perf_counter()
        job(source).write.format("noop").mode("overwrite").save()
        rows.append((kind, float(level), time.perf_counter() - start))

    try:
        for n in partitions:
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            timed("strong", n, df)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for share in fractions:
        timed("weak", share, sample_fraction(df, keys, share))
    return spark.createDataFrame(rows, "kind string, level double, seconds double")
