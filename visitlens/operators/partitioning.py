"""Partition-count helpers."""

from __future__ import annotations

from pyspark.errors import PySparkNotImplementedError
from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over at least ``min_partitions`` (default: the
    cluster's parallelism) partitions, but only when it has fewer.

    Used before CPU-heavy per-row work that precedes the first shuffle
    (tokenising whole texts). A large input already arrives in thousands of
    file splits, so there this is a no-op and adds no shuffle; a small input
    packed in one row group would otherwise be processed by a single task.
    Call it on a scan-level DataFrame (scan, filters, projections): counting
    the partitions of such a plan lists files but runs no job. Under AQE,
    counting the partitions of a plan that already contains a shuffle would
    execute that shuffle's stages first.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except PySparkNotImplementedError:  # a Spark Connect session has no RDD view: leave as is
        return df
    return df if current >= target else df.repartition(target)
