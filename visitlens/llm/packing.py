"""Best-two-fit packing of tokenised documents into fixed-length sequences.

1. Texts are tokenised in parallel; longer documents are cut into whole sequences and a rest.
2. Only the number of pieces of each length is gathered: at most ``capacity`` counts, whatever the corpus.
3. The counts are packed (:func:`best_two_fit`): fill a bin greedily with the longest piece that
   fits, then swap its shortest piece for the two unpacked pieces that fill the widened gap most
   tightly. As many equal bins as the counts allow are filled at once, which is what the
   one-by-one procedure would do, so the cost does not grow with the number of documents.
4. Every piece finds its bin from its rank among the pieces of its length. Ranks are a
   per-task counter plus the task's offset, so no length's pieces meet in one task.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import id_table, materialize, tidy

CAPACITY = 2048
#: Words and parts of words that a task remembers (in each of two generations), and the longest remembered.
CACHE_WORDS, CACHE_PARTS, CACHE_CHARS = 300_000, 200_000, 48
#: Characters that Unicode normalisation leaves alone and that Python lower-cases, one to one, as the tokenizer does.
PLAIN = "".join(c for c in map(chr, [*range(0x21, 0x7F), *range(0xA1, 0x130), *range(0x131, 0x250)]) if len(c.lower()) == 1 and c.lower() < "\u0250")
PLAIN_PART = re.compile(f"[{re.escape(PLAIN)}]+")
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Byte-level alphabet of the tokenizer's model: visible Latin-1 characters are themselves, the other bytes follow from 256 on.
BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
#: White space of the tokenizer's patterns (Unicode White_Space).
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: What a character is to the tokenizer's pattern ``'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+``; words with another one are left to it.
SPACE, LETTER, NUMBER, SIGN, OTHER = range(5)
KINDS, LOWER = np.full(0x110000, OTHER, np.uint8), np.arange(0x110000, dtype="<u4")
for _c in PLAIN:
    KINDS[ord(_c)] = {"L": LETTER, "N": NUMBER}.get(unicodedata.category(_c)[0], SIGN)
    LOWER[ord(_c)] = ord(_c.lower())
KINDS[[c for c in range(0x3001) if re.fullmatch(f"[{SPACES}]", chr(c))]] = SPACE


class TwoGenerations(dict):
    """A dictionary that computes what it lacks. When it holds ``entries`` it becomes the old generation, from which used keys move over."""

    def __init__(self, compute: Callable[[str], bytes], entries: int):
        super().__init__()
        self.compute, self.entries, self.old = compute, entries, {}

    def __missing__(self, key: str) -> bytes:
        if len(key) > CACHE_CHARS:
            return self.compute(key)
        found = self.old.get(key)
        if found is None:
            found = self.compute(key)
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


def _cut(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The lower-cased parts that the tokenizer's pattern finds in the texts, a word with an ``OTHER`` character being one part as
    it is; and for each text (and the end) the number of parts before it."""
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    chars = np.frombuffer(("\n".join(texts) + "\n   ").encode("utf-32-le"), "<u4")
    kinds, lower = KINDS[chars], LOWER[chars]
    before = np.concatenate([[np.uint8(SPACE)], kinds[:-1]])
    starts = (kinds != before) | (kinds == NUMBER)
    # 's and the like, where a run of signs begins with the apostrophe
    at = np.flatnonzero((chars == ord("'")) & starts)
    one, two = lower[at + 1], lower[at + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    for ends, width in ((short, 2), (long, 3)):
        starts[at[ends] + 1] = False
        starts[at[ends] + width] |= kinds[at[ends] + width] == LETTER
    kept = kinds != SPACE
    other = np.flatnonzero(kinds == OTHER)
    if len(other):
        opens = kept & (before == SPACE)
        word = np.cumsum(opens)
        whole = np.zeros(int(word[-1]) + 1, bool)
        whole[word[other]] = True
        whole = whole[word]
        starts = np.where(whole, opens, starts)
        lower = np.where(whole, chars, lower)
    starts &= kept
    held = lower[kept]
    data = held.tobytes().decode("utf-32-le").encode()
    first = np.flatnonzero(starts[kept])
    if len(data) > len(held):
        widths = 1 + (held >= 0x80).astype(np.int64) + (held >= 0x800) + (held >= 0x10000)
        first = (np.cumsum(widths) - widths)[first]
    offsets = np.append(first, len(data)).astype(np.int64)
    parts = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data))
    return parts, np.searchsorted(np.flatnonzero(starts), bounds)


class WordCache:
    """Token ids of texts as little-endian 32-bit bytes.

    The tokenizer never merges over white space, so a text's ids are its words' ids in a row. Words of plain Latin letters are split as
    its pattern does, a block of texts at a time, and each distinct part is merged by its model once, whatever stands around it. Other words,
    and whole texts that hold the beginning of a special token's string, go through the tokenizer itself.
    """

    def __init__(self, path: str, words: int = CACHE_WORDS, parts: int = CACHE_PARTS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: What all special tokens' strings begin with; no text without it holds one.
        self.opening = os.path.commonprefix(specials)
        self.special = bool(specials)
        self.words = TwoGenerations(self._word, words + parts)

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _word(self, word: str) -> bytes:
        if not PLAIN_PART.fullmatch(word):
            return self._ids(word)
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTE_LEVEL)
        return array("I", [token.id for token in self.model.tokenize(word)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = {i: self._ids(text) for i, text in enumerate(texts) if self.special and self.opening in text}
        parts, bounds = _cut(["" if i in whole else text for i, text in enumerate(texts)] if whole else texts)
        coded = parts.dictionary_encode()
        ids = pa.array(map(self.words.__getitem__, coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
        data = ids.buffers()[2]
        if data is None:
            return [whole.get(i, b"") for i in range(len(texts))]
        data = memoryview(data)
        cuts = np.frombuffer(ids.buffers()[1], np.int64)[bounds].tolist()
        return [whole[i] if i in whole else bytes(data[a:b]) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]


@lru_cache(maxsize=1)
def word_cache(path: str) -> WordCache:
    return WordCache(path)


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, place long"
#: Characters of text tokenised at a time.
BLOCK_CHARS = 1 << 21


def tokenised(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids binary)``: each whole text's ids and a closing 0, as little-endian 32-bit numbers."""

    def compute(batches):
        for batch in batches:
            for lo, hi, ids in _encoded(batch.column(1).to_pylist(), tokenizer_path):
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return id_table(df, id_col, text_col).mapInArrow(tidy(compute, word_cache.cache_clear), "doc_id long, ids binary")


def _encoded(texts: list[str], path: str):
    cache, end = word_cache(path), np.zeros(1, "<u4").tobytes()
    lo = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= BLOCK_CHARS or i == len(texts) - 1:
            yield lo, i + 1, [ids + end for ids in cache.encode(texts[lo:i + 1])]
            lo, size = i + 1, 0


def token_pieces(df: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per piece, with its task (``part``) and its place among the task's pieces of its length."""

    def compute(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            for lo, _, encoded in _encoded(batch.column(1).to_pylist(), tokenizer_path):
                rows = []
                for doc_id, raw in zip(ids_of[lo:], encoded, strict=False):
                    for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                        piece = raw[at:at + 4 * capacity]
                        n = len(piece) // 4
                        rows.append((doc_id, k, at // 4, n, zlib.crc32(piece), part, int(seen[n])))
                        seen[n] += 1
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    names = [x.split()[0] for x in PIECES.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
    return id_table(df, id_col, text_col).mapInArrow(tidy(compute, word_cache.cache_clear), PIECES)


def best_two_fit(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Bins ``(piece lengths, how many such bins)`` for ``counts[length]`` pieces of each length up to ``capacity``."""
    left = np.asarray(counts, np.int64).copy()
    sizes = np.arange(capacity + 1)
    bins = []
    while left.any():
        filled, gap = [], capacity
        while gap and (fits := np.flatnonzero(left[:gap + 1])).size:
            size = int(fits[-1])
            filled.append(size)
            left[size] -= 1
            gap -= size
        if gap and len(filled) > 1:
            least, wide = filled[-1], gap + filled[-1]
            # for each longer piece of a pair, the longest unpacked piece that still fits beside it
            below = np.maximum.accumulate(np.where(left > 0, sizes, 0))
            longer = np.flatnonzero(left[:wide])
            beside = below[np.minimum(wide - longer, longer)]
            alone = (beside == longer) & (left[longer] < 2)
            beside = np.where(alone, below[np.maximum(longer - 1, 0)], beside)
            both = np.where(beside > 0, longer + beside, 0)
            if both.size and both.max() > least:
                k = int(both.argmax())
                pair = [int(longer[k]), int(beside[k])]
                filled[-1:] = pair
                left[least] += 1
                for size in pair:
                    left[size] -= 1
        used = np.bincount(filled, minlength=capacity + 1)
        again = int((left[used > 0] // used[used > 0]).min())
        left -= again * used
        bins.append((filled, 1 + again))
    return bins


class Plan:
    """For each length, runs of ranks with the bins they go to."""

    def __init__(self, bins: list[tuple[list[int], int]]):
        self.runs: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        taken: dict[int, int] = {}
        sequence = 0
        for filled, times in bins:
            offsets: dict[int, list[int]] = {}
            at = 0
            for size in filled:
                offsets.setdefault(size, []).append(at)
                at += size
            for size, places in offsets.items():
                first = taken.get(size, 0)
                self.runs.setdefault(size, []).append((first, sequence, np.array(places)))
                taken[size] = first + times * len(places)
            sequence += times
        self.first = {s: np.array([r[0] for r in runs]) for s, runs in self.runs.items()}

    def assign(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(sequence id, offset)`` of the pieces with these lengths and ranks among their length."""
        sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        order = np.lexsort((ranks, lengths))
        cuts = np.flatnonzero(np.diff(lengths[order], prepend=-1))
        for rows in np.split(order, cuts[1:]) if len(order) else ():
            size = int(lengths[rows[0]])
            run = np.searchsorted(self.first[size], ranks[rows], side="right") - 1
            for k in np.unique(run):
                own = rows[run == k]
                first, base, places = self.runs[size][k]
                local = ranks[own] - first
                sequence[own] = base + local // len(places)
                offset[own] = places[local % len(places)]
        return sequence, offset


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (written to a table: ``length, part, place`` and others) with ``sequence_id`` and ``offset``."""
    per_task = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    totals = np.zeros(capacity + 1, np.int64)
    for length, n in per_task.groupBy("length").agg(F.sum("n")).collect():  # ``capacity`` rows at most
        totals[length] = n
    plan = Plan(best_two_fit(totals, capacity))
    offsets = per_task.select(F.col("length").alias("__length"), F.col("part").alias("__part"),
                              (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("__before"))
    ranked = (pieces.join(offsets, (F.col("length") == F.col("__length")) & (F.col("part") == F.col("__part")))
              .withColumn("rank", F.col("place") + F.col("__before")))

    @F.arrow_udf("sequence_id long, offset long")
    def assign(length: pa.Array, rank: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(x) for x in plan.assign(length.to_numpy(), rank.to_numpy())],
                                          ["sequence_id", "offset"])

    return (ranked.withColumn("at", assign("length", "rank"))
            .select(*[c for c in pieces.columns if c not in ("part", "place")], "at.sequence_id", "at.offset"))


def pack_documents(df: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``: one row per piece of every document.

    Null and empty texts are one piece with the closing 0. Repeated rows and null ids are packed like any
    other. An empty table gives an empty result; other columns are ignored. Sequence ids count from 0 without gaps.
    """
    pieces = materialize(token_pieces(df, tokenizer_path, capacity, id_col, text_col), "pieces")
    packed = pack_pieces(pieces, capacity)
    return packed.withColumn("length", F.col("length").cast("long"))


def sequences(packed: DataFrame, tokens: DataFrame) -> DataFrame:
    """The filled sequences ``(sequence_id, ids binary, n_pieces)`` from :func:`pack_documents` and
    :func:`tokenised` (unique ids): a group holds at most ``capacity`` tokens."""
    parts = (packed.join(tokens, "doc_id")
             .select("sequence_id", "offset", F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))").alias("ids")))
    return (parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
            .select("sequence_id", F.expr("aggregate(p.ids, cast('' as binary), (a, x) -> concat(a, x))").alias("ids"),
                    F.size("p").alias("n_pieces")))
