"""Streaming sources. Each returns an unbounded DataFrame; the jobs in
``visitlens.streaming`` accept any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import is_folder, table_path


def parquet_stream(spark: SparkSession, path: str, schema=None, glob: str | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """New parquet files under ``path`` as a stream (a table folder of part files).

    A stream cannot infer its schema: pass it, or it is read once from the
    files already there. By default a micro-batch takes every new file;
    ``max_files_per_trigger`` caps it (size it so one batch is a few GB per
    executor, not one file).
    """
    if schema is None:
        schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def parquet_table_stream(spark: SparkSession, base_dir: str, name: str,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``<base_dir>/<name>.parquet`` table as a stream: a folder of part files, or
    a single file. A missing table raises."""
    path = table_path(base_dir, name)
    schema = spark.read.parquet(path).schema
    if is_folder(spark, path):
        return parquet_stream(spark, path, schema, max_files_per_trigger=max_files_per_trigger)
    # a stream watches a folder; the glob picks the table's one file in it
    return parquet_stream(spark, base_dir, schema, glob=f"{name}.parquet",
                          max_files_per_trigger=max_files_per_trigger)


def text_dir_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, line_sep: str | None = None,
                    arrival: bool = False) -> DataFrame:
    """New text files in a folder, one row per line (``value``). With ``arrival`` also the time its file came as ``ts``
    (the file's modification time: it stays the same when a batch is run again, as a clock read by the job would not)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    lines = reader.load(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("ts")) if arrival else lines


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP text server, with their arrival time as ``ts``.

    For development only (no fault tolerance, as in Spark's docs).
    """
    return (spark.readStream.format("socket").option("host", host).option("port", str(port))
            .option("includeTimestamp", "true").load().withColumnRenamed("timestamp", "ts"))


def topic_stream(spark: SparkSession, bootstrap_servers: str, topics: str,
                 group_id: str | None = None, min_partitions: int | None = None,
                 starting_offsets: str = "latest") -> DataFrame:
    """Messages of one or more Kafka topics as ``key, value`` strings plus the
    broker timestamp as ``ts``. Needs the spark-sql-kafka package on the classpath.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topics).option("startingOffsets", starting_offsets))
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load().select(F.col("key").cast("string").alias("key"),
                                F.col("value").cast("string").alias("value"),
                                F.col("timestamp").alias("ts"))
