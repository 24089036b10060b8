"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors of its hashed features: words, neighbouring word
pairs, and character 3- and 4-grams within a word and its borders. A softmax over the mean gives
the class. Vectors and output layer are trained together by stochastic gradient descent in numpy on a
bounded sample of labelled rows.

Since the output layer is linear, its product with the vectors is folded into one number per
bucket after training; scoring is then the mean of looked-up numbers, exactly the
trained model's, in one pass over the bytes of each text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import give_back, id_table, materialize, text_or_empty, tidy, utf8_blocks

BUCKET_BITS = 17
DIM = 8
#: Labelled rows the model is fitted on at most, and how many features they may have on the average: all features of a
#: row are learned from, and fewer rows are taken where they have more.
TRAIN_ROWS, TRAIN_FEATURES = 8_000, 3_000
EPOCHS, RATE = 8, 0.6
#: Texts whose feature columns are built at a time.
FEATURE_ROWS = 100
THRESHOLD = 0.7
#: A longer text is read in segments, cut at white space where there is any.
SEGMENT = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: The feature that every document has, also an empty one.
ALWAYS = 0
POWERS = np.cumprod(np.full(64, 0x01000193, np.uint32), dtype=np.uint32)


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    """Mixes 32-bit hashes of one kind of feature into buckets."""
    h = h ^ np.uint32(0x9E3779B1 * kind & 0xFFFFFFFF)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h >> np.uint32(32 - BUCKET_BITS)


def _features(data: np.ndarray, ends: np.ndarray):
    """Yields ``(position, bucket)`` arrays of a run of texts; each text begins and ends with a space byte
    and ``ends`` holds the position after each text's last byte."""
    space = SPACE[data]
    letters = np.flatnonzero(~space)
    if not len(letters):
        return
    first = letters[np.flatnonzero(np.diff(letters, prepend=-2) > 1)]  # where each word begins
    sizes = np.diff(np.searchsorted(letters, first), append=len(letters))
    place = np.arange(len(letters)) - np.repeat(np.searchsorted(letters, first), sizes)
    values = (data[letters].astype(np.uint32) + np.uint32(1)) * POWERS[place & 63]
    words = np.add.reduceat(values, np.searchsorted(letters, first), dtype=np.uint32)
    yield first, _bucket(words, 1)
    if len(first) > 1:
        text = np.searchsorted(ends, first, side="right")
        inside = np.flatnonzero(text[1:] == text[:-1])
        # the same word twice running always has the same hash: repetition is a feature
        yield first[inside], _bucket(words[inside] ^ words[inside + 1], 2)
    wide = data.astype(np.uint32)
    wide[space] = 32
    rolled = wide[:-1] * np.uint32(0x01000193) + wide[1:]
    gap = space[1:-1]
    for n in (3, 4):
        rolled = rolled[:-1] * np.uint32(0x01000193) + wide[n - 1:]
        ok = ~gap if n == 3 else ~(gap[:-1] | gap[1:])
        at = np.flatnonzero(ok)
        yield at, _bucket(rolled[at], n)


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The run with a space before each text and one at the end, and each text's end."""
    n = len(offsets) - 1
    out = np.full(len(data) + n + 1, 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = data
    return out, offsets[1:] + np.arange(1, n + 1)


def _segments(data: np.ndarray):
    """A long text in pieces of at most ``SEGMENT`` bytes, cut after white space if the piece has any."""
    lo = 0
    while len(data) - lo > SEGMENT:
        spaces = np.flatnonzero(SPACE[data[lo:lo + SEGMENT]])
        hi = lo + (int(spaces[-1]) + 1 if len(spaces) else SEGMENT)
        yield data[lo:hi]
        lo = hi
    yield data[lo:]


def _runs(column: pa.Array):
    """Runs of texts as ``(first row, spaced bytes, ends)``; the pieces of a long text share its row."""
    for start, data, offsets in utf8_blocks(column, SEGMENT):
        if len(offsets) == 2 and len(data) > SEGMENT:
            for piece in _segments(data):
                yield start, *_spaced(piece, np.array([0, len(piece)]))
        else:
            yield start, *_spaced(data, offsets)


@dataclass(frozen=True)
class Model:
    """``logits[bucket]`` is the bucket vector's share in the log odds of label 1."""
    logits: np.ndarray

    def score(self, column: pa.Array) -> np.ndarray:
        total = np.full(len(column), self.logits[ALWAYS], np.float64)
        count = np.ones(len(column), np.int64)
        for start, data, ends in _runs(column):
            n = len(ends)
            for at, bucket in _features(data, ends):
                row = start + np.searchsorted(ends, at, side="right")
                row = np.minimum(row, start + n - 1)
                total += np.bincount(row, weights=self.logits[bucket], minlength=len(total))
                count += np.bincount(row, minlength=len(count))
        return 1.0 / (1.0 + np.exp(-total / count))


def _feature_columns(column: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each text's distinct buckets and their share of its features, as two list columns over flat numpy buffers."""
    buckets, rows = [np.full(len(column), ALWAYS, np.uint32)], [np.arange(len(column), dtype=np.int32)]
    for start, data, ends in _runs(column):
        for at, bucket in _features(data, ends):
            rows.append((start + np.minimum(np.searchsorted(ends, at, side="right"), len(ends) - 1)).astype(np.int32))
            buckets.append(bucket)
    key = np.concatenate(rows).astype(np.int64) << BUCKET_BITS | np.concatenate(buckets)
    del rows, buckets
    key, n = np.unique(key, return_counts=True)
    row = key >> BUCKET_BITS
    ends = np.searchsorted(row, np.arange(len(column) + 1)).astype(np.int32)
    totals = np.bincount(row, weights=n, minlength=len(column))
    shares = (n / totals[row]).astype(np.float32)
    ids = (key & ((1 << BUCKET_BITS) - 1)).astype(np.int32)
    return tuple(pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (ids, shares))


def _feature_lists(column: pa.Array) -> tuple[list, list]:
    """The same as Python lists."""
    ids, shares = _feature_columns(column)
    return ids.to_pylist(), shares.to_pylist()


def train(ids: list[np.ndarray], shares: list[np.ndarray], labels: np.ndarray, seed: int = 11) -> Model:
    """Stochastic gradient descent on the softmax loss, one document at a time, rate falling to zero."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BUCKET_BITS, DIM)).astype(np.float32)
    output = np.zeros((2, DIM), np.float32)
    steps, done = max(1, EPOCHS * len(labels)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(labels)):
            rate = RATE * (1 - done / steps)
            done += 1
            mean = shares[i] @ vectors[ids[i]]
            z = output @ mean
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = p @ output
            output -= rate * np.outer(p, mean)
            # as in the published method each feature's vector takes the mean's whole gradient, weighted by its count
            vectors[ids[i]] -= rate * np.outer(shares[i] * min(len(ids[i]), 50), back)
    return Model((vectors @ (output[1] - output[0])).astype(np.float64))


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(id_col.cast("string")) % 4 == 2


def fit(documents: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents, drawn by a hash of their id among those not held out.
    Their features, not their texts, reach the driver: whole rows in the draw's order, ``rows * TRAIN_FEATURES`` numbers at
    most (the first row is always taken).
    Rows without id or label are left out; with no labelled row every score is 0.5."""
    chosen = (labels.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("label"))
              .where(F.col("__id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("__id")))
              .orderBy(F.xxhash64("__id"), "__id", "label").limit(rows))
    drawn = id_table(documents, id_col, text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))

    def compute(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, FEATURE_ROWS):  # the features of a few texts take many times their bytes
                some = batch.slice(lo, FEATURE_ROWS)
                yield pa.record_batch([some.column(0), some.column(1), *_feature_columns(some.column(2))], names=["doc_id", "label", "ids", "shares"])

    lists = materialize(drawn.select("doc_id", "label", "text")
                        .mapInArrow(tidy(compute), "doc_id long, label int, ids array<int>, shares array<float>"), "features")
    sizes = lists.groupBy("doc_id", "label").agg(F.sum(F.size("ids")).alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id", "label"))  # one narrow row for each of at most `rows` labels
    taken = sizes.withColumn("upto", upto).where((F.col("upto") <= rows * TRAIN_FEATURES) | (F.col("upto") == F.col("n"))).select("doc_id", "label")
    table = lists.join(F.broadcast(taken), ["doc_id", "label"], "left_semi").select("doc_id", "label", "ids", "shares").toArrow()
    place = np.lexsort((table.column("label").to_numpy(), table.column("doc_id").to_numpy()))
    ids, shares = ([np.asarray(x.values) for x in table.column(c)] for c in ("ids", "shares"))  # views of the one copy
    model = train([ids[i] for i in place], [shares[i] for i in place], table.column("label").to_numpy()[place])
    del table, ids, shares
    give_back()
    return model


def scorer(model: Model):
    """The model as a column function from text to score."""

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        scores = pa.array(model.score(text), pa.float64())
        give_back()
        return scores

    return score


def score_documents(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)``: one row per input row, whole texts.

    A null text scores as an empty one. A null id is not held out. Repeated rows are scored each; an empty table gives an
    empty result; other columns, labels among them, are never read.
    """
    scored = id_table(df, id_col, text_col).withColumn("score", scorer(model)("text"))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` without the rows the model rejects; all columns kept."""
    return df.where(scorer(model)(text_or_empty(text_col)) >= THRESHOLD)


__all__ = ["Model", "fit", "held_out", "keep_good", "score_documents", "scorer", "train"]
