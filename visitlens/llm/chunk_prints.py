"""Document fingerprints from content-defined chunks.

A gear hash over the last 16 bytes marks possible cuts; normalised chunking picks them
with a strict mask before the normal size and a loose one after it, between a least and a
largest size. Cuts depend on nearby bytes only, so an insertion or a replaced
part changes the chunks around it and no others. A fingerprint is the set of
chunk digests with their lengths; shared lengths over the smaller set's length
measure containment.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_table, shuffle_partitions, tidy

WINDOW = 16
MIN_SIZE, NORMAL_BITS, MAX_SIZE = 16, 6, 256
NORMAL_SIZE = 1 << NORMAL_BITS
#: The masks lie 2 bits above and below the normal size, on bits that the whole window reaches.
STRICT_SHIFT, LOOSE_SHIFT = 32 - (NORMAL_BITS + 2), 32 - (NORMAL_BITS - 2)
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], np.uint32)
SEGMENT = 1 << 20
#: Ranges of documents per shuffle partition, and how exactly their boundaries are placed.
RANGES_PER_PARTITION, ACCURACY = 4, 10_000
BLOCK_BYTES = 1 << 20


def _cut_marks(data: np.ndarray) -> tuple[list[int], list[int]]:
    """Ends of possible chunks (a byte's index plus one) under the strict and the loose mask."""
    strict, loose = [], []
    for lo in range(0, len(data), SEGMENT):
        first = max(0, lo - WINDOW + 1)
        h = GEAR[data[first:lo + SEGMENT]]
        for s in (1, 2, 4, 8):
            shifted = h[:-s] << np.uint32(s)
            h[s:] = h[s:] + shifted
        h = h[lo - first:]
        at = np.flatnonzero(h >> np.uint32(LOOSE_SHIFT) == 0)
        loose.append(at + (lo + 1))
        strict.append(at[h[at] >> np.uint32(STRICT_SHIFT) == 0] + (lo + 1))
    return (np.concatenate(strict).tolist(), np.concatenate(loose).tolist()) if strict else ([], [])


def _next_cut(start: int, end: int, strict: list[int], loose: list[int]) -> int:
    if end - start <= MIN_SIZE:
        return end
    for marks, lo, hi in ((strict, start + MIN_SIZE, start + NORMAL_SIZE), (loose, start + NORMAL_SIZE, start + MAX_SIZE)):
        k = bisect_left(marks, lo)
        if k < len(marks) and marks[k] < min(hi, end):
            return marks[k]
    return min(start + MAX_SIZE, end)


def chunk_sets(texts: list[bytes]) -> list[dict[int, int]]:
    """For each text, its chunks' 64-bit digests and lengths. An empty text has no chunk.

    The texts are hashed as one run; a cut lies at least a window's length after its
    chunk's start, so nothing before a text takes part in its cuts.
    """
    joined = b"".join(texts)
    strict, loose = _cut_marks(np.frombuffer(joined, np.uint8))
    digest, out, start = xxhash.xxh64_intdigest, [], 0
    for text in texts:
        chunks, end = {}, start + len(text)
        while start < end:
            cut = _next_cut(start, end, strict, loose)
            chunks[digest(joined[start:cut])] = cut - start
            start = cut
        out.append(chunks)
    return out


def fingerprint(chunks: dict[int, int]) -> str:
    return " ".join(f"{d:016x}:{n:x}" for d, n in sorted(chunks.items()))


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Length of the shared chunks over that of the smaller set; two empty sets are alike."""
    if not a or not b:
        return float(not a and not b)
    small, large = (a, b) if len(a) < len(b) else (b, a)
    return sum(n for d, n in small.items() if d in large) / min(sum(a.values()), sum(b.values()))


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)``; a null text counts as empty and has the empty fingerprint."""

    def compute(batches):
        for batch in batches:
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            for lo, hi in _runs(texts):
                prints = [fingerprint(c) for c in chunk_sets(texts[lo:hi])]
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(prints, pa.string())],
                                      names=["doc_id", "fingerprint"])

    return id_table(df, id_col, text_col).mapInArrow(tidy(compute), "doc_id long, fingerprint string")


def _runs(texts: list[bytes]):
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK_BYTES:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def with_successors(rows: DataFrame, order_col: str = "doc_id", tie_col: str = "text") -> DataFrame:
    """``rows`` in ranges of ``order_col`` so that each range, sorted by ``place, guest, order_col, tie_col``,
    holds its rows and then, as ``guest``, the row that follows its last one (after the last row: the first).

    Only the boundary rows travel twice. The boundaries are values of ``order_col`` from a quantile sketch;
    nulls come first. Rows that tie on ``order_col`` stay in one range.
    """
    order = F.coalesce(F.col(order_col), F.lit(-(1 << 63)))
    n = RANGES_PER_PARTITION * shuffle_partitions(rows.sparkSession)
    found = rows.agg(F.min(order), F.percentile_approx(order, [k / n for k in range(1, n)], ACCURACY)).first()
    if found[0] is None:
        return rows.withColumns({"place": F.lit(0), "guest": F.lit(False)})
    bounds = np.array(sorted({found[0], *found[1]}), np.int64)

    @F.pandas_udf("int")
    def place(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, values.to_numpy(np.int64), side="right").astype(np.int32) - 1)

    @F.pandas_udf("boolean")
    def opens(values: pd.Series) -> pd.Series:
        return pd.Series(np.isin(values.to_numpy(np.int64), bounds))

    last = len(bounds) - 1
    own = F.struct(F.col("__place").alias("place"), F.lit(False).alias("guest"))
    before = F.when(F.col("__place") == 0, F.lit(last)).otherwise(F.col("__place") - 1)
    visits = F.when(F.col("__opens"), F.array(own, F.struct(before.alias("place"), F.lit(True).alias("guest")))).otherwise(F.array(own))
    return (rows.withColumn("__place", place(order)).withColumn("__opens", opens(order))
            .select(*rows.columns, F.explode(visits).alias("visit")).select(*rows.columns, "visit.place", "visit.guest")
            .repartition("place").sortWithinPartitions("place", "guest", order_col, tie_col))


EDIT_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double, n_chunks int")


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: fingerprints of its text and of its edited text, whose last half comes from the
    next document in id order (of the last: the first), and how alike they are.

    Null texts count as empty; null ids come first; rows that share an id follow each other in text order, so
    a repeated row's next document may be its copy. A single row is its own next document. An
    empty table gives an empty result; other columns are ignored. Each text is shuffled once.
    """
    rows = with_successors(id_table(df, id_col, text_col))

    def report(pending):
        texts = [r[1] for r in pending]
        own = chunk_sets([t.encode() for t in texts])
        edited = [a[:len(a) - len(a) // 2] + b[:len(a) // 2] for a, b in zip(texts, texts[1:], strict=False)]
        raw = [t.encode() for t in edited]
        changed = chunk_sets(raw)
        out = [(pending[i][0], len(texts[i]), hashlib.sha256(raw[i]).hexdigest(), fingerprint(own[i]), fingerprint(changed[i]),
                containment(own[i], changed[i]), containment(own[i], own[i + 1]), len(own[i]))
               for i in range(len(raw)) if not pending[i][3] and pending[i][2] == pending[i + 1][2]]
        return pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=schema).to_batches()

    names = [x.split()[0] for x in EDIT_SCHEMA.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}
    schema = pa.schema([(n, kinds[x.split()[1]]) for n, x in zip(names, EDIT_SCHEMA.split(", "), strict=True)])

    def compute(batches):
        pending, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                pending.append(row)
                size += len(row[1])
                if size >= BLOCK_BYTES and len(pending) > 1:
                    yield from report(pending)
                    pending, size = pending[-1:], len(row[1])  # the last row still waits for its successor
        if len(pending) > 1:
            yield from report(pending)

    return rows.select("doc_id", "text", "place", "guest").mapInArrow(tidy(compute), EDIT_SCHEMA)
