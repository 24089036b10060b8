"""Tokenising with Java ``String.split`` semantics, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_lines(text: Column) -> Column:
    """Array of the lines of a text, like reading the text as a file."""
    return F.split(text, "\n")


def java_split(value: Column, sep: str = " ") -> Column:
    """``value.split(sep)`` as Java computes it for a one-character separator.

    Java drops *trailing* empty strings but keeps leading and inner ones, so a
    value made only of separators yields an empty array and ``""`` yields
    ``[""]``. Spark's ``split`` keeps the trailing empties, hence the strip.
    """
    if len(sep) != 1:
        raise ValueError("only one-character separators are supported")
    empty = F.array().cast("array<string>")
    if sep == " ":
        # rtrim strips exactly the trailing spaces: no regex pass per line.
        trimmed = F.rtrim(value)
        return F.when((trimmed == "") & (value != ""), empty).otherwise(F.split(trimmed, " "))
    esc = "\\" + sep if not sep.isalnum() else sep
    only_sep = value.rlike(rf"^{esc}+\z")  # not ``$``, which also matches before a final line break
    return F.when(only_sep, empty).otherwise(F.split(F.regexp_replace(value, rf"{esc}+\z", ""), esc))


def explode_tokens(df: DataFrame, value_col: str, sep: str = " ", out: str = "word") -> DataFrame:
    """One row per token of ``value_col`` (other columns kept)."""
    keep = [c for c in df.columns if c != value_col]
    return df.select(*keep, F.explode(java_split(F.col(value_col), sep)).alias(out))


def document_lines(docs: DataFrame, text_col: str = "text", out: str = "value") -> DataFrame:
    """One row per line of every document: the table-backed twin of ``read.text``."""
    return docs.select(F.explode(text_lines(F.col(text_col))).alias(out))
