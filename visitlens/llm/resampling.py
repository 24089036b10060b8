"""Target-distribution importance resampling over hashed word runs, with a head-tail vocabulary.

1. Words of both tables are counted exactly. A word is *frequent* if it is at least one in ``HEAD`` of all words, so at most ``HEAD``
   words are. Their CRC-32 states are broadcast; a state is both the word's own checksum and the start of every longer run that begins
   with it. For runs of two words and more, pairs of neighbouring words are counted and chosen alike, and the
   frequent ones' buckets are broadcast.
2. Features of the tail, words or pairs not broadcast, take their CRC directly. Both ways give the same checksum, so bucket
   totals are exact over all documents, whatever the head holds.
3. Each text is reduced once to its features' buckets, 2 bytes each, in a table. Bucket totals of both tables give each bucket's gain;
   a document's weight is the floored mean of its features' gains.
4. Gumbel noise keyed by the document's id makes the highest scores a draw without replacement in proportion to the
   weights. Ranks come from a range partitioning: a task ranks its own range, and only the ranges' counts are summed.

The driver sees bucket totals, the head and counts of ranges, all of fixed size.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import id_table, materialize, shuffle_partitions, tidy

BUCKETS, PERCENT, MIN_WORDS, SEED = 10_000, 10, 20, 2024
#: At most so many words, and so many pairs, are frequent.
HEAD = 1 << 15
#: Words or pairs that a task counts before it hands them on.
COUNTED = 1 << 18
PLACE_BITS = 33
#: Bytes of words as they are, A-Z in lower case, all others a space.
_WORD_BYTES = bytes(c if c >= 0x80 or 48 <= c < 58 or 97 <= c < 123 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, letters and all beyond ASCII, with A-Z in lower case; a null text has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class States(dict):
    """CRC-32 states of the frequent words; another word's is computed and not kept."""

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)


def feature_buckets(words: list[bytes], longest: int, states: States, pairs: dict[tuple[bytes, bytes], int], buckets: int) -> np.ndarray:
    """The bucket of every run of 1 to ``longest`` consecutive words, repeats included."""
    state = list(map(states.__getitem__, words))
    found = [np.array(state, np.uint64) % np.uint64(buckets)]
    for n in range(2, min(longest, len(words)) + 1):
        if n == 2:
            two = zip(words, words[1:], strict=False)
            bucket = [pairs.get(pair, -1) for pair in two]
            if longest == 2:  # no longer run needs the state of a frequent pair
                found.append(np.array([b if b >= 0 else zlib.crc32(b" " + words[i + 1], state[i]) % buckets for i, b in enumerate(bucket)], np.uint64))
                continue
        state = [zlib.crc32(b" " + words[i + n - 1], state[i]) for i in range(len(words) - n + 1)]
        found.append(np.array(state, np.uint64) % np.uint64(buckets))
    return np.concatenate(found)


def _counted(texts: DataFrame, units, kind: str) -> DataFrame:
    """``(unit, n)`` over all texts of ``(doc_id, text)``; ``units`` lists a text's units."""

    def compute(batches):
        counts: Counter = Counter()

        def rows():
            return pa.record_batch([pa.array([list(u) if isinstance(u, tuple) else u for u in counts]), pa.array(list(counts.values()), pa.int64())],
                                   names=["unit", "n"])

        for batch in batches:
            for text in batch.column(1):
                counts.update(units(text.as_py()))
                if len(counts) > COUNTED:
                    yield rows()
                    counts.clear()
        if counts:
            yield rows()

    return (texts.mapInArrow(tidy(compute), f"unit {kind}, n long").groupBy("unit").agg(F.sum("n").alias("n")))


def _frequent(counts: DataFrame, head: int) -> list:
    """Units that are at least one in ``head`` of all: ``head`` of them at most."""
    counts = materialize(counts, "resample-counts")
    total = counts.agg(F.sum("n").alias("total"))
    return [r.unit for r in counts.join(F.broadcast(total), F.col("n") * F.lit(head) >= F.col("total")).select("unit").collect()]


def frequent_words(texts: DataFrame, head: int = HEAD) -> States:
    return States((bytes(w), zlib.crc32(w)) for w in _frequent(_counted(texts, words_of, "binary"), head))


def frequent_pairs(texts: DataFrame, states: States, buckets: int, head: int = HEAD) -> dict[tuple[bytes, bytes], int]:
    known = frozenset(states)

    def pairs_of(text: str | None) -> Iterable[tuple[bytes, bytes]]:
        """Pairs of frequent words; a pair with another word is not frequent."""
        words = words_of(text)
        return [p for p in zip(words, words[1:], strict=False) if p[0] in known and p[1] in known]

    found = _frequent(_counted(texts, pairs_of, "array<binary>"), head)
    return {(bytes(a), bytes(b)): zlib.crc32(bytes(a) + b" " + bytes(b)) % buckets for a, b in found}


def bucketed(texts: DataFrame, longest: int, states: States, pairs: dict, buckets: int) -> DataFrame:
    """``(doc_id, n_words, n_features, buckets)``: the features' buckets as little-endian 16-bit (or 32-bit) numbers."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    shared = texts.sparkSession.sparkContext.broadcast((dict(states), pairs))  # 2 * HEAD entries at most

    def compute(batches):
        states, pairs = States(shared.value[0]), shared.value[1]
        for batch in batches:
            rows = []
            for text in batch.column(1):
                words = words_of(text.as_py())
                found = feature_buckets(words, longest, states, pairs, buckets)
                rows.append((len(words), len(found), found.astype(kind).tobytes()))
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True))],
                                  names=["doc_id", "n_words", "n_features", "buckets"])

    return texts.mapInArrow(tidy(compute), "doc_id long, n_words long, n_features long, buckets binary")


def bucket_totals(features: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket over the whole table."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def compute(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                total += np.bincount(np.frombuffer(raw.as_buffer(), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in (features.select("buckets").mapInArrow(tidy(compute), "bucket int, n long")
                      .groupBy("bucket").agg(F.sum("n")).collect()):  # ``buckets`` rows at most
        out[bucket] = n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` for each of B buckets."""
    size = len(raw)
    all_raw, all_target = float(raw.sum() + size), float(target.sum() + size)
    return np.array([math.floor(1000 * math.log((t + 1) * all_raw / ((s + 1) * all_target)))
                     for s, t in zip(raw.astype(float).tolist(), target.astype(float).tolist(), strict=True)], np.int64)


def weighed(features: DataFrame, gains: np.ndarray) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)``: the floored mean of the gains, 0 without features."""
    kind = "<u2" if len(gains) <= 1 << 16 else "<u4"

    @F.arrow_udf("long")
    def total(buckets: pa.Array) -> pa.Array:
        return pa.array([int(gains[np.frombuffer(raw.as_buffer(), kind)].sum()) for raw in buckets], pa.int64())

    mean = F.expr("total div n_features - cast(pmod(total, n_features) != 0 and total < 0 as int)")
    return (features.withColumn("total", total("buckets"))
            .select("doc_id", "n_words", "n_features", F.when(F.col("n_features") > 0, mean).otherwise(0).cast("long").alias("weight")))


def ranked(scored: DataFrame, keys: list, share: int) -> DataFrame:
    """``scored`` with ``rank`` from 1 for the first ``share`` percent in the order of ``keys``, null for the others."""
    spark = scored.sparkSession
    place = materialize(scored.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
                        .withColumn("place", F.monotonically_increasing_id()), "resample-ranges")
    ranges = place.withColumn("range", F.shiftright("place", PLACE_BITS))
    before = Window.orderBy("range")  # a row a range: shuffle partitions bound it
    offsets = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select(
        "range", (F.sum("n").over(before) - F.col("n")).alias("first"),
        F.expr(f"{share} * sum(n) over () div 100").alias("drawn"))
    rank = F.col("first") + F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + 1
    return (ranges.join(F.broadcast(offsets), "range").withColumn("rank", F.when(rank <= F.col("drawn"), rank))
            .drop("place", "range", "first", "drawn"))


def resample(raw: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", longest: int = 1,
             buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, head: int = HEAD) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)``: one row per row of ``raw``; ``rank`` counts the drawn ones from 1.

    A null or empty text has no features and weight 0; texts of fewer than ``min_words`` words are not drawn. Repeated rows
    are documents of their own and take neighbouring ranks; a null id is hashed as an empty one and comes last in a tie. An
    empty ``target`` counts as no features at all; an empty ``raw`` gives an empty result. Other columns are ignored.
    """
    docs = id_table(raw, id_col, text_col)
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), F.coalesce(F.col(target_text), F.lit("")).alias("text"))
    both = docs.union(wanted)
    states = frequent_words(both, head)
    pairs = frequent_pairs(both, states, buckets, head) if longest > 1 else {}
    features = materialize(bucketed(docs, longest, states, pairs, buckets), "resample-features")
    gains = bucket_gains(bucket_totals(features, buckets), bucket_totals(bucketed(wanted, longest, states, pairs, buckets), buckets))
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.ln(-F.ln((noise + 0.5) / F.lit(4294967296.0))))
    scored = weighed(features, gains).withColumn("score", F.col("weight") + gumbel)
    drawn = ranked(scored.where(F.col("n_words") >= min_words), [F.desc("score"), F.asc_nulls_last("doc_id")], percent)
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
