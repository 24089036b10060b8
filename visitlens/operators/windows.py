"""Sliding event-time window counts with top-N, over bounded input.

These are the batch twins of the streaming jobs in ``visitlens.streaming``:
same counting and ranking, applied to a whole table at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import java_split
from .relational import group_top_n

# The reference's window length and slide.
DEFAULT_LENGTH = "60 seconds"
DEFAULT_SLIDE = "10 seconds"


def searches_from_events(events: DataFrame) -> DataFrame:
    """``(ts, keyword)`` of every search: ``view`` events, keyword ``kw<k mod 10>``."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return (events.where(F.col("event_type") == "view")
            .select(F.col("ts"), F.concat(F.lit("kw"), (k % 10).cast("string")).alias("keyword")))


def goods_from_events(events: DataFrame) -> DataFrame:
    """``(ts, category, product)`` of every event: category = event type, product = ``k``."""
    return events.select(F.col("ts"), F.col("event_type").alias("category"),
                         F.get_json_object("props", "$.k").alias("product"))


def searches_from_lines(lines: DataFrame, value_col: str = "value", ts_col: str = "ts") -> DataFrame:
    """Parse ``user keyword`` lines; lines without a second field are skipped."""
    keyword = F.get(java_split(F.col(value_col)), 1)  # trailing spaces make no field
    return lines.select(F.col(ts_col).alias("ts"), keyword.alias("keyword")).where(F.col("keyword").isNotNull())


def goods_from_lines(lines: DataFrame, value_col: str = "value", ts_col: str = "ts") -> DataFrame:
    """Parse ``user product category`` lines into two columns (no joined
    ``category_product`` key, so ``_`` inside a name is harmless); short lines
    are skipped."""
    parts = java_split(F.col(value_col))
    return (lines.select(F.col(ts_col).alias("ts"), F.get(parts, 2).alias("category"),
                         F.get(parts, 1).alias("product"))
            .where(F.col("category").isNotNull() & F.col("product").isNotNull()))


def _seconds(duration: str) -> int:
    """Seconds of a duration such as ``"60 seconds"`` or ``"6 hours"``."""
    amount, unit = duration.split()
    return int(amount) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def sliding_counts(df: DataFrame, keys: list[str], length: str, slide: str, out: str,
                   ts_col: str = "ts") -> DataFrame:
    """Rows per ``(window, *keys)`` over windows ``[start, start+length)``
    every ``slide``, aligned to the epoch (``length`` is a multiple of ``slide``).

    Rows are first counted per slide-sized pane, combined map-side; only a pane's
    count then goes to the ``length/slide`` windows that hold the pane, so the fan-out grows
    with panes and keys, not with rows."""
    if _seconds(length) % _seconds(slide):
        raise ValueError("the window length must be a multiple of the slide")
    panes = df.groupBy(F.window(ts_col, slide).alias("pane"), *keys).agg(F.count(F.lit(1)).alias("pane_rows"))
    return (panes.select(F.window(F.col("pane.start"), length, slide).alias("window"), *keys, "pane_rows")
            .groupBy("window", *keys).agg(F.sum("pane_rows").alias(out)))


def flatten_window(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def rank_hot_searches(counts: DataFrame, n: int = 3) -> DataFrame:
    """Global top-``n`` keywords of each window (ties by keyword)."""
    return group_top_n(counts, ["window"], [F.col("search_count").desc(), F.col("keyword")], n)


def rank_hot_goods(counts: DataFrame, n: int = 3) -> DataFrame:
    """Top-``n`` products of each category in each window (ties by product)."""
    return group_top_n(counts, ["window", "category"], [F.col("click_count").desc(), F.col("product")], n)


def hot_search(searches: DataFrame, length: str = DEFAULT_LENGTH, slide: str = DEFAULT_SLIDE,
               n: int = 3) -> DataFrame:
    counts = sliding_counts(searches, ["keyword"], length, slide, "search_count")
    return flatten_window(rank_hot_searches(counts, n))


def hot_goods(goods: DataFrame, length: str = DEFAULT_LENGTH, slide: str = DEFAULT_SLIDE,
              n: int = 3) -> DataFrame:
    counts = sliding_counts(goods, ["category", "product"], length, slide, "click_count")
    return flatten_window(rank_hot_goods(counts, n))
