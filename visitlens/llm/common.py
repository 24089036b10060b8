"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.materialize import materialize

__all__ = ["document_batches", "give_back", "id_table", "may_hold", "materialize", "shuffle_partitions", "text_or_empty", "tidy", "utf8_blocks",
           "with_may_hold"]

BATCH_ROWS, DOCUMENT_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
#: Size of a key bitmap at least (4 kB) and at most (16 MB), bits for each key, and the pieces that Spark's bitmap aggregate builds.
LEAST_BITS, MOST_BITS, KEY_BITS, PIECE_BITS = 1 << 15, 1 << 27, 10, 1 << 15


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def document_batches(spark: SparkSession) -> None:
    """Arrow batches sized for rows that hold whole texts: ``DOCUMENT_ROWS`` instead of Spark's default of 10,000,
    which is tens of MB a batch in the JVM and again in each Python worker. It holds for the session from then on. A session that has
    set any number itself keeps it, 10,000 too; the registered queries and the pipeline's stages call this, the operators do not."""
    if BATCH_ROWS not in spark.conf.getAll and spark.sparkContext.getConf().get(BATCH_ROWS) is None:
        spark.conf.set(BATCH_ROWS, str(DOCUMENT_ROWS))


def give_back() -> None:
    """Return a Python worker's freed memory to the system. Idle workers of earlier stages otherwise keep what
    their largest batch took, beside the running ones."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim is not None:
        trim(0)


def tidy(compute: Callable, forget: Callable[[], None] | None = None) -> Callable:
    """A function for ``mapInArrow`` that gives its memory back when its task ends; ``forget`` empties what it has cached."""
    def run(batches):
        try:
            yield from compute(batches)
        finally:
            if forget is not None:
                forget()
            give_back()

    return run


def id_table(df: DataFrame, id_col: str, text_col: str, label: str = "text") -> DataFrame:
    """``(doc_id, text)`` of any table, whatever else its columns are called."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias(label))


def _key_bits(keys: DataFrame, key: str) -> tuple[int, DataFrame]:
    """The size of the bitmap of ``keys`` and its pieces ``(piece, bits)``: ``MOST_BITS / PIECE_BITS`` rows at most."""
    bits = LEAST_BITS
    wanted = keys.count() * KEY_BITS
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    return bits, (keys.select(place.alias("place")).groupBy(F.floor(F.col("place") / PIECE_BITS).alias("piece"))
                  .agg(F.bitmap_construct_agg(F.col("place") % PIECE_BITS).alias("bits")))


def with_may_hold(rows: DataFrame, keys: DataFrame, key: str, column: Column, name: str) -> DataFrame:
    """``rows`` with the test of :func:`may_hold` as the boolean ``name``, in DataFrame operations only: the bitmap's pieces are broadcast."""
    bits, pieces = _key_bits(keys, key)
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    met = rows.withColumn("__place", place).join(
        F.broadcast(pieces.withColumnsRenamed({"piece": "__piece", "bits": "__bits"})), F.expr(f"__place div {PIECE_BITS} = __piece"), "left")
    byte = F.conv(F.hex(F.expr(f"substring(__bits, cast((__place % {PIECE_BITS}) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("cast(__place % 8 as int)")
    return (met.withColumn(name, F.coalesce(F.call_function("shiftright", byte, bit).bitwiseAND(F.lit(1)) == 1, F.lit(False)))
            .drop("__place", "__piece", "__bits"))


def may_hold(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test whether a long key may be in ``keys``: never false for a key that is, seldom true for
    one that is not.

    It lets the rows that no key touches stay where they are, so that only the others (and few more) are shuffled to an
    exact join. ``keys`` should be a written table. They are hashed into a bitmap aggregated in Spark, of ``KEY_BITS`` bits a key: one
    row in ten that no key touches passes at most, up to 13 million keys. Its size, and that of what reaches the driver
    and the executors, is bounded by ``MOST_BITS``; with more keys more rows pass to the exact join.
    """
    bits, found = _key_bits(keys, key)
    pieces = found.toArrow()
    bitmap = np.zeros(bits // 8, np.uint8)
    size = PIECE_BITS // 8
    for piece, raw in zip(pieces.column(0).to_pylist(), pieces.column(1), strict=True):  # MOST_BITS / PIECE_BITS rows at most
        bitmap[piece * size:(piece + 1) * size] = np.frombuffer(raw.as_buffer(), np.uint8)
    shared = keys.sparkSession.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def held(places: pa.Array) -> pa.Array:
        at = places.to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.array((shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)

    return lambda column: held(F.pmod(F.xxhash64(column), F.lit(bits)))


def utf8_blocks(column: pa.Array, max_bytes: int = 1 << 21):
    """Consecutive runs of texts as ``(first_row, bytes as uint8, offsets)``,
    each run of about ``max_bytes`` (a longer single text is a run of its own).
    Works on Arrow's own buffers, so no Python string is made; nulls count as
    empty texts.
    """
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offsets_buf, data_buf = column.buffers()
    offsets = np.frombuffer(offsets_buf, dtype=np.int64, count=column.offset + n + 1)[column.offset:]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
        end = min(n, max(end, start + 1))
        yield start, data[offsets[start]:offsets[end]], offsets[start:end + 1] - offsets[start]
        start = end
