"""Reusing an intermediate result without recomputing it.

A result that several outputs read is written once to a fresh folder under
the shared checkpoint folder (``spark.checkpoint.dir``) and read back: the
lineage is cut, and a lost executor no longer forces recomputation from the
raw input. (Never ``localCheckpoint``: its blocks die with the executor.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import fresh_path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and return the table read back."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)
