"""Batch sinks: results leave the engine as tables, never through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                fmt: str = "parquet") -> None:
    """Write a result as files (parquet by default), optionally partitioned.

    A partitioned overwrite replaces only the partitions present in ``df``
    (dynamic partition overwrite): re-persisting one task's statistics with
    ``partition_by=["task_id"]`` leaves the other tasks' rows in place, so
    the write is idempotent per task.
    """
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def write_jdbc(df: DataFrame, url: str, table: str, *, user: str | None = None,
               password: str | None = None, driver: str | None = None, mode: str = "append",
               batch_size: int = 10_000, num_partitions: int | None = None) -> None:
    """Insert a result into a database table (credentials from the caller).

    ``num_partitions`` caps the number of concurrent connections; each task
    inserts its own rows in batches.
    """
    writer = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table) \
        .option("batchsize", str(batch_size))
    if user is not None:
        writer = writer.option("user", user)
    if password is not None:
        writer = writer.option("password", password)
    if driver is not None:
        writer = writer.option("driver", driver)
    if num_partitions is not None:
        writer = writer.option("numPartitions", str(num_partitions))
    writer.save()
