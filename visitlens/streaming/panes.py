"""Sliding windows from slide-sized panes, as two chained stateful aggregations.

A row updates one pane instead of ``length / slide`` windows. When the watermark passes a pane it is emitted once, as one row a
key, and only then spread over the windows that hold it. State and its updates per row shrink by ``length / slide``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import _seconds, flatten_window, rank_hot_goods, rank_hot_searches
from .runner import StreamTable, run_or_start


def pane_window_counts(events: DataFrame, keys: list[str], out: str, length: str, slide: str, delay: str) -> DataFrame:
    """Streaming counts per ``(window, *keys)``: pane counts first, then windows over the panes' event time."""
    if _seconds(length) % _seconds(slide):
        raise ValueError("the window length must be a multiple of the slide")
    panes = (events.withWatermark("ts", delay).groupBy(F.window("ts", slide).alias("pane"), *keys)
             .agg(F.count(F.lit(1)).alias("pane_rows")))
    return (panes.groupBy(F.window(F.window_time("pane"), length, slide).alias("window"), *keys)
            .agg(F.sum("pane_rows").alias(out)))


def open_pane_windows(spark: SparkSession, table: StreamTable, keys: list[str], out: str, length: str, slide: str) -> DataFrame:
    """Counts so far of the windows that the watermark has not passed: the windows' state and that of the panes not yet in it."""
    operators = spark.read.format("state-metadata").load(table.checkpoint).select("operatorId").distinct().collect()
    parts = []
    for (operator,) in operators:  # two
        state = spark.read.format("statestore").option("operatorId", operator).load(table.checkpoint)
        rows = state.select("key.*", "value.*")
        parts.append(rows.toDF("window", *keys, out).withColumn("operator", F.lit(operator)))
    width = F.unix_seconds("window.end") - F.unix_seconds("window.start")
    state = reduce(DataFrame.unionByName, parts)
    windows = state.where(width == _seconds(length)) if length != slide else state.where(F.col("operator") == min(o for (o,) in operators))
    panes = state.where(width == _seconds(slide)) if length != slide else state.where(F.col("operator") != min(o for (o,) in operators))
    spread = panes.select(F.window(F.col("window.start"), length, slide).alias("window"), *keys, out)
    return windows.select("window", *keys, out).unionByName(spread).groupBy("window", *keys).agg(F.sum(out).alias(out))


def _pane_top(spark: SparkSession, events: DataFrame, table: StreamTable, keys: list[str], out: str, rank, length: str, slide: str,
              delay: str, n: int, trigger: dict | None, report: dict | None):
    counts = pane_window_counts(events, keys, out, length, slide, delay)
    closed = run_or_start(spark, counts, table, lambda batch, _id: flatten_window(rank(batch, n)), "append", trigger, report)
    if trigger is not None:
        return closed
    still_open = flatten_window(rank(open_pane_windows(spark, table, keys, out, length, slide), n))
    return (closed.drop("batch_id").withColumn("is_open", F.lit(False))
            .unionByName(still_open.withColumn("is_open", F.lit(True))))


def hot_search_panes(spark: SparkSession, searches: DataFrame, table: StreamTable, length: str, slide: str, delay: str, n: int = 3,
                     trigger: dict | None = None, report: dict | None = None):
    """:func:`visitlens.streaming.jobs.hot_search_stream` by panes; same result."""
    return _pane_top(spark, searches, table, ["keyword"], "search_count", rank_hot_searches, length, slide, delay, n, trigger, report)


def hot_goods_panes(spark: SparkSession, goods: DataFrame, table: StreamTable, length: str, slide: str, delay: str, n: int = 3,
                    trigger: dict | None = None, report: dict | None = None):
    """:func:`visitlens.streaming.jobs.hot_goods_stream` by panes; same result."""
    return _pane_top(spark, goods, table, ["category", "product"], "click_count", rank_hot_goods, length, slide, delay, n, trigger, report)
