"""Storage layout for repeated analyses.

Tables written bucketed (and sorted) on the same key with the same bucket
count are read back already hash-partitioned on that key: an aggregation
grouped by the key plus finer columns, and a join on the key, then need no
shuffle at all. For the session pipeline: actions and users both bucketed by
``user_id``, sessions grouped by ``(user_id, session_id)``.

Tables written by day let a join on the day prune whole folders at run time (``operators.task_days``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import fresh_path


def save_bucketed(df: DataFrame, table: str, key: str, num_buckets: int, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as a catalog table bucketed and sorted by ``key`` (under
    ``spark.sql.warehouse.dir``, a shared location on a cluster) and return it."""
    df.write.mode(mode).bucketBy(num_buckets, key).sortBy(key).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def save_by_day(df: DataFrame, path: str | None = None, day: str = "date", within: str = "action_time", mode: str = "errorifexists") -> DataFrame:
    """Write ``df`` as a folder for each ``day`` (a fresh one under the shared folder unless a path is given) and return it read back.
    Rows are dealt by ranges of ``(day, within)``: few files a day, and a day that holds much of the rows is written by many tasks."""
    spark = df.sparkSession
    path = path or fresh_path(spark, "by-day")
    df.repartitionByRange(day, within).write.mode(mode).partitionBy(day).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)  # the day keeps its type
