"""Batch text analytics over a ``value: string`` lines DataFrame (from
``read_lines`` or ``document_lines``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import java_split


def word_count(lines: DataFrame, value_col: str = "value", sep: str = " ") -> DataFrame:
    """``(word, count)`` of every token, most frequent first, ties by word.

    Tokens follow Java ``split(" ")``: empty tokens from leading or doubled
    spaces count as the word ``""``. ``groupBy().count()`` combines map-side,
    so a word that is a third of the text still reaches the shuffle as one
    partial count per task.
    """
    words = lines.select(F.explode(java_split(F.col(value_col), sep)).alias("word"))
    return (words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("word")))


def line_count_containing(lines: DataFrame, needle: str = "g", value_col: str = "value") -> DataFrame:
    """Identical lines that contain ``needle`` (case sensitive) with their
    number of occurrences, most frequent first, ties by line."""
    return (lines.where(F.col(value_col).contains(needle))
            .groupBy(F.col(value_col).alias("line")).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("line")))
