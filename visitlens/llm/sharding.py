"""Shards cut from a Hilbert curve over quantised metadata.

1. Every dimension is quantised into ``2**bits`` steps of about equally many rows
   (boundaries from a quantile sketch; those of text dimensions from the exact counts of their sorted distinct values).
2. The Hilbert index of the step vector orders the rows: neighbours on the curve are
   neighbours in every dimension, so each shard spans a small box and min / max
   statistics prune files by any of the dimensions.
3. A range partitioning on (index, id) and the rows' counts per range give each row its exact global rank without
   a sort in one task; runs of equal length are cut from the ranks (law ``rows``).

Only narrow rows move; texts are read once, and again by :func:`write_shards`.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from .common import materialize, shuffle_partitions

BITS = 5
#: Added to each text's bytes for a row's size.
ROW_OVERHEAD = 16
ACCURACY = 2000
#: monotonically_increasing_id holds the row's place in its partition in the low bits.
PLACE_BITS = 33


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of ``coords`` (n x d, whole numbers below ``2**bits``).

    Skilling's method (2004): undo the excess reflections from the top bit down, Gray-decode, interleave.
    """
    axes = [np.asarray(c, np.int64).copy() for c in coords.T]
    n = len(axes)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            high = (axes[i] >> level) & 1 == 1
            swap = np.where(high, 0, (axes[0] ^ axes[i]) & low)
            axes[0] ^= np.where(high, low, swap)
            axes[i] ^= swap
    for i in range(1, n):
        axes[i] ^= axes[i - 1]
    flip = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((axes[n - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    index = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            index = (index << 1) | (((axis ^ flip) >> level) & 1)
    return index


def _text_bounds(base: DataFrame, dim: str, steps: int) -> list[tuple]:
    """The values, as :func:`_order` keys, where a text dimension's cumulative row counts pass each ``1 / steps`` of the rows.

    Distinct values are counted and ranged in Spark; at most ``steps`` of them reach the driver. A null comes before every value.
    """
    counts = base.groupBy(F.col(f"`{dim}`").cast("binary").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranged = materialize(counts.repartitionByRange(shuffle_partitions(base.sparkSession), "value").sortWithinPartitions("value")
                         .withColumn("range", F.shiftright(F.monotonically_increasing_id(), PLACE_BITS)), "shard-values")
    before = Window.orderBy("range")  # a row per range: shuffle partitions bound it
    offsets = ranged.groupBy("range").agg(F.sum("n").alias("rows")).select(
        "range", (F.sum("rows").over(before) - F.col("rows")).alias("first"),
        F.sum("rows").over(before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    upto = F.col("first") + F.sum("n").over(Window.partitionBy("range").orderBy("value"))
    rows = (ranged.join(F.broadcast(offsets), "range").withColumn("upto", upto)
            .select("value", F.expr(f"((upto - n) * {steps}) div total").alias("low"), F.expr(f"(upto * {steps}) div total").alias("high"))
            .where("high > low").collect())
    keys = {k: _order(r["value"]) for r in rows for k in range(r["low"] + 1, r["high"] + 1)}
    return [keys[k] for k in range(1, steps)] if keys else []


def _order(value) -> tuple:
    """Sorts as Spark does: a null first, then by bytes."""
    return (b"",) if value is None else (b"v", bytes(value))


def hilbert_shards(df: DataFrame, dims: list[str], shards: int, id_col: str = "doc_id", bits: int = BITS) -> DataFrame:
    """``df`` (narrow: id, dimensions, whatever else is to be carried) with ``curve long, shard int, slot long``.

    Row counts of two shards differ by at most one. Ties on the curve are ordered by id, then by input
    order, so repeated rows get slots of their own; null ids come first, null dimensions count as lowest.
    An empty table gives an empty result. ``df`` is written to the shared folder once.
    """
    spark = df.sparkSession
    base = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "shard-rows")
    steps = 1 << bits
    cuts = [k / steps for k in range(1, steps)]
    texts = {i: _text_bounds(base, c, steps) for i, c in enumerate(dims) if isinstance(base.schema[c].dataType, StringType)}
    codes = [F.col(f"`{c}`").cast("binary") if i in texts else F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("-inf")))
             for i, c in enumerate(dims)]
    numbers = [F.percentile_approx(c, cuts, ACCURACY).alias(f"b{i}") for i, c in enumerate(codes) if i not in texts]
    bounds = base.agg(*numbers).first().asDict() if numbers else {}

    @F.pandas_udf("long")
    def curve(*columns: pd.Series) -> pd.Series:
        # rows up to a boundary's value lie below it
        places = []
        for i, v in enumerate(columns):
            if i in texts:
                which, values = pd.factorize(v, use_na_sentinel=False)
                steps_of = [bisect_left(texts[i], _order(x if isinstance(x, (bytes, bytearray)) else None)) for x in values]
                places.append(np.asarray(steps_of, np.int64)[which])
            else:
                places.append(np.searchsorted(np.asarray(bounds[f"b{i}"] or [], float), v.to_numpy(float), side="left"))
        return pd.Series(hilbert_index(np.stack(places, axis=1), bits))

    placed = (base.withColumn("curve", curve(*codes))
              .repartitionByRange(shuffle_partitions(spark), "curve", id_col, "__row")
              .sortWithinPartitions("curve", id_col, "__row")
              .withColumn("__place", F.monotonically_increasing_id()))
    ranked = materialize(placed.withColumn("__range", F.shiftright("__place", PLACE_BITS)), "shard-ranks")
    counts = ranked.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("__range")  # a row per range: shuffle partitions bound it
    offsets = counts.select("__range", (F.sum("n").over(before) - F.col("n")).alias("__first"),
                            F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__total"))
    rank = F.col("__first") + F.col("__place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    shard = F.expr(f"(__rank * {shards}) div __total")
    # the first rank of a shard is the smallest that its formula sends there
    first = F.expr(f"(shard * __total + {shards - 1}) div {shards}")
    return (ranked.join(F.broadcast(offsets), "__range")
            .withColumn("__rank", rank).withColumn("shard", shard)
            .withColumn("slot", F.col("__rank") - first)
            .withColumn("shard", F.col("shard").cast("int"))
            .drop("__rank", "__first", "__total", "__place", "__range", "__row"))


#: Rows that one task writes of a shard.
FILE_ROWS = 100_000


def document_shards(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                    meta: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Shard report of a document table over its metadata, text size and id: ``doc_id, size,
    text_crc32, law, shard, slot, grown_shard`` and the curve index. A null text has 0 bytes and no characters."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(f"dim_{c}") for c in meta],
                       (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    placed = hilbert_shards(narrow, [*[f"dim_{c}" for c in meta], "size", "doc_id"], shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), F.col("curve").alias("hilbert_index"))


def write_shards(df: DataFrame, assigned: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write ``df`` as one folder per shard in slot order (``id_col`` must be unique): a file for each ``FILE_ROWS`` slots, which a task
    of its own may write, whatever the size of the shard."""
    where = assigned.select(F.col("doc_id").alias("__id"), "shard", "slot")
    (df.join(where, F.col(id_col) == F.col("__id")).drop("__id")
     .repartition(shuffle_partitions(df.sparkSession), "shard", F.floor(F.col("slot") / FILE_ROWS)).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
