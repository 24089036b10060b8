"""Line de-duplication by overlapping three-line windows.

1. Every run of three consecutive lines of a text is hashed to 128 bits; only
   (hash, document, place) rows move.
2. Windows with a repeated hash are found by a grouped minimum, combined before the shuffle: the
   first occurrence is the one of the smallest (id, text hash, place).
3. Every later occurrence covers its three places; overlapping ones merge, and the covered lines are removed.

The first occurrence of a window is earlier than all it removes, so every removed line still stands in an earlier place.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import materialize, may_hold, text_or_empty

WINDOW_LINES = 3


def _key(text: Column, id_col: Column) -> Column:
    """The order of documents, and their identity: rows with the same id and text are one document."""
    return F.struct(id_col.cast("long").alias("id"), F.xxhash64(text).alias("text"))


def line_windows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc struct, at int, h1 long, h2 long)``: one row per window of three lines with a line that is not blank."""
    text = text_or_empty(text_col)
    n = WINDOW_LINES
    lines = df.select(_key(text, F.col(id_col)).alias("doc"), F.split(text, "\n").alias("lines")).where(F.size("lines") >= n)
    windows = F.expr(f"transform(slice(lines, 1, size(lines) - {n - 1}), "
                     f"(x, i) -> struct(i as at, slice(lines, i + 1, {n}) as w))")
    w = F.col("win.w")
    return (lines.select("doc", F.explode(windows).alias("win"))
            .where(F.trim(F.concat_ws("", w)) != "")
            .select("doc", F.col("win.at").alias("at"), F.xxhash64(w).alias("h1"), F.xxhash64(F.lit(1), w).alias("h2")))


def later_windows(windows: DataFrame) -> DataFrame:
    """``(doc, ats array<int>)``: where later occurrences of repeated windows begin.
    A document's array is bounded by its own lines."""
    occurrence = F.struct("doc", "at")
    first = (windows.groupBy("h1", "h2").agg(F.min(occurrence).alias("first"), F.max(occurrence).alias("last"))
             .where(F.col("first") != F.col("last")).select("h1", "h2", "first"))
    return (windows.join(first, ["h1", "h2"]).where(occurrence != F.col("first"))
            .groupBy("doc").agg(F.collect_set("at").alias("ats")))


@F.arrow_udf(StructType([StructField("text", StringType()), StructField("removed", LongType())]))
def _cut(text: pa.Array, ats: pa.Array) -> pa.Array:
    texts, removed = [], []
    for value, starts in zip(text.to_pylist(), ats.to_pylist(), strict=True):
        if value is None or not starts:
            texts.append(value)
            removed.append(0)
            continue
        covered = {at + k for at in starts for k in range(WINDOW_LINES)}
        lines = value.split("\n")
        texts.append("\n".join(line for i, line in enumerate(lines) if i not in covered))
        removed.append(len(covered))
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(removed, pa.int64())], ["text", "removed"])


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with later occurrences of repeated three-line windows cut from its texts, and with ``n_lines``
    (before) and ``n_removed``, which replace columns of those names.

    Lines are separated by line feeds and compared unchanged. Documents are ordered by id (null first), then by a
    hash of the text. Texts of fewer than three lines and windows of blank lines are left alone. A null text stays
    null and has no lines. Rows repeated with the same id and text are one document and get the same text.
    A text whose lines are all removed becomes empty. An empty table gives an empty result.
    """
    windows = materialize(line_windows(df, id_col, text_col), "line-windows")
    later = materialize(later_windows(windows).withColumn("key", F.xxhash64("doc")), "later-windows")
    text = text_or_empty(text_col)
    doc = _key(text, F.col(id_col))
    touched = may_hold(later, "key")(F.xxhash64(doc))
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(text, "\n"))).cast("long")
    others = [c for c in df.columns if c not in ("n_lines", "n_removed")]
    # the row travels as one struct, so that its columns may have any names
    counted = df.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("value"),
                        n_lines.alias("n_lines"), touched.alias("touched"))

    # only texts to be cut are shuffled and travel to Python
    found = later.select(F.col("doc.id").alias("found_id"), F.col("doc.text").alias("hash"), "ats").hint("merge")
    joined = counted.where("touched").join(found, F.col("id").eqNullSafe(F.col("found_id")) & (F.xxhash64(text_or_empty("value")) == F.col("hash")), "left")
    cut = (joined.withColumn("cut", _cut(F.col("value"), F.col("ats")))
           .select(*[F.col("cut.text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in others],
                   "n_lines", F.col("cut.removed").alias("n_removed")))
    return counted.where("not touched").select("row.*", "n_lines", F.lit(0).cast("long").alias("n_removed")).unionByName(cut)
