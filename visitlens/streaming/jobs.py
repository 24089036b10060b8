"""Structured Streaming jobs. Each takes an unbounded DataFrame from any
source in ``visitlens.sources.streams`` (file folder, socket, Kafka topic)
and a :class:`StreamTable`. With ``trigger=None`` it processes what is
available and returns the result table as a batch DataFrame; with a trigger
it starts a long-running query and returns its handle.

Event time comes from a ``ts`` column; the window jobs need it as
``timestamp`` (not ``timestamp_ntz``) for ``withWatermark``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import java_split, text_lines
from ..operators.partitioning import spread
from ..operators.windows import (DEFAULT_LENGTH, DEFAULT_SLIDE, flatten_window, rank_hot_goods,
                                 rank_hot_searches)
from .runner import StreamTable, compact_totals, latest_totals, run_or_start

# Micro-batch intervals of the reference's jobs (pass them as
# ``trigger={"processingTime": ...}`` for a long-running query).
WORD_COUNT_INTERVAL = "5 seconds"
WINDOW_INTERVAL = "2 seconds"


def _tokens(stream: DataFrame, value_col: str, multiline: bool = False) -> DataFrame:
    """Tokens of every value; with ``multiline`` a value is a whole text whose
    lines are tokenised separately (as lines of a file would be)."""
    if multiline:
        stream = stream.select(F.explode(text_lines(F.col(value_col))).alias(value_col))
    return stream.select(F.explode(java_split(F.col(value_col))).alias("word"))


def _count_words(batch: DataFrame, value_col: str, multiline: bool = False) -> DataFrame:
    # a micro-batch of one split would be tokenised by one task
    return (_tokens(spread(batch), value_col, multiline)
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def batch_word_count(spark: SparkSession, lines: DataFrame, table: StreamTable,
                     value_col: str = "value", multiline: bool = False, trigger: dict | None = None):
    """Word counts of each micro-batch on its own (no state carried between
    batches): ``(word, count, batch_id)``."""
    def per_batch(batch: DataFrame, batch_id: int) -> DataFrame:
        return _count_words(batch, value_col, multiline)

    return run_or_start(spark, lines, table, per_batch, "append", trigger)


def arrival_counts(lines: DataFrame, interval: str = WORD_COUNT_INTERVAL) -> DataFrame:
    """``(interval_start, word, count)`` of ``(value, ts)`` lines by the interval in which they came."""
    words = lines.select(F.window("ts", interval)["start"].alias("interval_start"), F.explode(java_split(F.col("value"))).alias("word"))
    return words.groupBy("interval_start", "word").agg(F.count(F.lit(1)).alias("count"))


def arrival_word_count(spark: SparkSession, lines: DataFrame, table: StreamTable, interval: str = WORD_COUNT_INTERVAL,
                       trigger: dict | None = None):
    """Word counts of each ``interval`` of arrival time, from ``(value, ts)`` lines: ``(interval_start, word, count)``.

    Every batch writes its part of an interval, and reading adds the parts: intervals do not depend on how files
    fall into batches, files that come late are counted where they belong, and no state is kept."""
    started = run_or_start(spark, lines, table, lambda batch, _id: arrival_counts(batch, interval), "append", trigger)
    if trigger is not None:
        return started
    return started.groupBy("interval_start", "word").agg(F.sum("count").alias("count"))


def topic_word_count(spark: SparkSession, messages: DataFrame, table: StreamTable,
                     trigger: dict | None = None):
    """Per-batch word counts over the ``value`` of ``key, value`` messages
    (a Kafka topic, or any stream with those columns)."""
    return batch_word_count(spark, messages.select("value"), table, "value", trigger=trigger)


def running_word_count(spark: SparkSession, lines: DataFrame, table: StreamTable,
                       value_col: str = "value", output_mode: str = "update",
                       multiline: bool = False, trigger: dict | None = None):
    """Total per word since the first batch, kept in the state store and
    restored from the checkpoint on restart. Keys never expire.

    ``update`` mode writes only the words a batch changed (what scales to a
    large vocabulary); ``complete`` rewrites every word each batch. Either
    way the current total of a word is its value in the latest batch that
    wrote it: ``(word, count)``.
    """
    counts = _tokens(lines, value_col, multiline).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    started = run_or_start(spark, counts, table, lambda batch, _id: batch, output_mode, trigger)
    return started if trigger is not None else current_totals(spark, table, counts.schema)


def current_totals(spark: SparkSession, table: StreamTable, schema) -> DataFrame:
    """Current total per word: the newest snapshot and the updates after it. A long-running count calls
    :func:`compact_running_count` from time to time, so reading does not grow with its uptime."""
    return latest_totals(spark, table, schema, "word", "count")


def compact_running_count(spark: SparkSession, table: StreamTable) -> int:
    """Fold the updates so far into a snapshot; returns the last batch in it."""
    return compact_totals(spark, table, spark.createDataFrame([], "word string, count long").schema, "word", "count")


def windowed_counts(events: DataFrame, keys: list[str], out: str, length: str, slide: str,
                    delay: str) -> DataFrame:
    """Streaming counts per ``(window, *keys)``; rows older than the watermark
    (max event time seen minus ``delay``) are dropped and counted in the
    query progress as ``numRowsDroppedByWatermark``."""
    return (events.withWatermark("ts", delay)
            .groupBy(F.window("ts", length, slide).alias("window"), *keys)
            .agg(F.count(F.lit(1)).alias(out)))


def open_windows(spark: SparkSession, table: StreamTable, keys: list[str], out: str) -> DataFrame:
    """Counts so far of the windows that the watermark has not passed, from the stopped job's state."""
    state = spark.read.format("statestore").option("path", table.checkpoint).load()
    return state.select("key.*", F.col("value.count").alias(out)).toDF("window", *keys, out)


def _windowed_top(spark: SparkSession, events: DataFrame, table: StreamTable, keys: list[str],
                  out: str, rank, length: str, slide: str, delay: str, n: int, trigger: dict | None,
                  report: dict | None):
    counts = windowed_counts(events, keys, out, length, slide, delay)

    def per_batch(batch: DataFrame, batch_id: int) -> DataFrame:
        # Append mode emits a window once, complete, when the watermark passes
        # its end: ranking inside the batch is therefore final.
        return flatten_window(rank(batch, n))

    closed = run_or_start(spark, counts, table, per_batch, "append", trigger, report)
    if trigger is not None:
        return closed
    # A bounded run also returns the windows still open at its end, as far as they are filled.
    still_open = flatten_window(rank(open_windows(spark, table, keys, out), n))
    return (closed.drop("batch_id").withColumn("is_open", F.lit(False))
            .unionByName(still_open.withColumn("is_open", F.lit(True))))


def hot_search_stream(spark: SparkSession, searches: DataFrame, table: StreamTable,
                      length: str = DEFAULT_LENGTH, slide: str = DEFAULT_SLIDE,
                      delay: str = "10 seconds", n: int = 3, trigger: dict | None = None,
                      report: dict | None = None):
    """Top-``n`` keywords of every sliding window, from ``(ts, keyword)``.

    ``delay`` is how late a row may come after the newest one seen; later rows whose window has closed are dropped
    and counted in ``report["late_rows"]``. A bounded run (``trigger=None``) returns every window, those not yet closed
    with ``is_open``; a long-running one writes each window when it closes."""
    return _windowed_top(spark, searches, table, ["keyword"], "search_count", rank_hot_searches,
                         length, slide, delay, n, trigger, report)


def hot_goods_stream(spark: SparkSession, goods: DataFrame, table: StreamTable,
                     length: str = DEFAULT_LENGTH, slide: str = DEFAULT_SLIDE,
                     delay: str = "10 seconds", n: int = 3, trigger: dict | None = None,
                     report: dict | None = None):
    """Top-``n`` products per category of every sliding window, from
    ``(ts, category, product)``; see :func:`hot_search_stream`."""
    return _windowed_top(spark, goods, table, ["category", "product"], "click_count", rank_hot_goods,
                         length, slide, delay, n, trigger, report)
