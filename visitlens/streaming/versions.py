"""Rankings of windows that are still open: every micro-batch writes a new version, later versions replace earlier ones.

Counts run in update mode, so a batch brings the changed keys only. Counts never fall, so a key that did not change and was not
among a window's first ``n`` cannot be now: the new ranking follows from the changed keys and the last version's ``n`` rows. Each
batch's folder carries all windows that are not final, so a batch reads its predecessor's folder and nothing older.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ..operators.windows import flatten_window, rank_hot_goods, rank_hot_searches
from ..sources.files import path_exists
from .jobs import windowed_counts
from .runner import StreamTable, read_table, run_available, start_to_table


def _versions(spark: SparkSession, events: DataFrame, table: StreamTable, keys: list[str], out: str, rank, length: str, slide: str,
              delay: str, n: int, trigger: dict | None, report: dict | None):
    counts = windowed_counts(events, keys, out, length, slide, delay)
    found = flatten_window(rank(spark.createDataFrame([], counts.schema), n))
    schema = StructType(found.schema.fields).add("is_final", "boolean")

    def per_batch(batch: DataFrame, batch_id: int) -> DataFrame:
        folder = os.path.join(table.output, f"batch_id={batch_id - 1}")
        last = (spark.read.schema(schema).parquet(folder) if batch_id and path_exists(spark, folder) else spark.createDataFrame([], schema))
        known = last.where(~F.col("is_final")).select(F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("window"),
                                                      *keys, out)
        best = batch.select("window", *keys, out).unionByName(known).groupBy("window", *keys).agg(F.max(out).alias(out))
        # A window has begun, so an event of its start or later was seen before this batch. What ends by then, less the
        # delay, takes no more rows.
        seen = last.agg(F.max("window_start").alias("seen")).scalar()
        return flatten_window(rank(best, n)).withColumn(
            "is_final", F.coalesce(F.col("window_end") <= seen - F.expr(f"interval {delay}"), F.lit(False)))

    if trigger is not None:
        return start_to_table(counts, table, per_batch, "update", trigger)
    run_available(counts, table, per_batch, "update", report)
    return newest_version(read_table(spark, table, schema))


def newest_version(versions: DataFrame) -> DataFrame:
    """Of each window the rows of its newest version (``batch_id``). A version holds a few rows a window."""
    newest = F.max("batch_id").over(Window.partitionBy("window_start", "window_end"))
    return versions.withColumn("newest", newest).where(F.col("batch_id") == F.col("newest")).drop("newest")


def hot_search_versions(spark: SparkSession, searches: DataFrame, table: StreamTable, length: str, slide: str, delay: str, n: int = 3,
                        trigger: dict | None = None, report: dict | None = None):
    """Top-``n`` keywords of every window after each batch, ``(window_start, window_end, keyword, search_count, rank, is_final, batch_id)``.

    A bounded run (``trigger=None``) returns the newest version of each window; read a long-running job's with
    :func:`visitlens.streaming.runner.read_table` and :func:`newest_version`. ``is_final`` rows change no more."""
    return _versions(spark, searches, table, ["keyword"], "search_count", rank_hot_searches, length, slide, delay, n, trigger, report)


def hot_goods_versions(spark: SparkSession, goods: DataFrame, table: StreamTable, length: str, slide: str, delay: str, n: int = 3,
                       trigger: dict | None = None, report: dict | None = None):
    """Top-``n`` products per category of every window after each batch; see :func:`hot_search_versions`."""
    return _versions(spark, goods, table, ["category", "product"], "click_count", rank_hot_goods, length, slide, delay, n, trigger, report)
