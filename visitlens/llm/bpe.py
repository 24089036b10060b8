"""Byte-level BPE with a hierarchical-bitmap rank queue.

A pre-token is a linked list of tokens. Each mergeable neighbour pair waits in the bucket of its
merge rank; a two-level bitmap over the ranks finds the lowest waiting rank by
find-first-set. A bucket's positions are merged from left to right, entries whose
pair has changed meanwhile are skipped. No step scans the list, so the cost of a very long
pre-token grows with its length only.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_table, tidy

#: Encoded pre-tokens a Python worker remembers (in each of two generations), and the longest remembered.
CACHE_ENTRIES, CACHE_CHARS = 200_000, 48


class ByteBPE:
    """Encoder and decoder for a table of ranks (token bytes -> rank, all single bytes present)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        # Two levels of equal width: a word of the lower one has a bit for each of 2**shift ranks, the upper one a bit for each
        # word that is not empty. Words are whole numbers of any length, so 2**16 ranks have 256 bits, 2**18 ranks 512.
        self.shift = -(-max(self.tokens).bit_length() // 2)
        self.bit = [1 << k for k in range(1 << self.shift)]
        self.words = [0] * ((max(self.tokens) >> self.shift) + 1)  # empty between two pre-tokens
        self.pairs: dict[int, int] = {}  # (left id << 32) + right id -> rank
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    self.pairs[(left << 32) + right] = rank

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token, merged lowest rank first and leftmost first within a rank."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        ids = [self.single[b] for b in piece]
        n = len(ids)
        if n < 2:
            return ids
        rank_of, words, top, shift, bit, mask = self.pairs.get, self.words, 0, self.shift, self.bit, len(self.bit) - 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [-1] * n  # rank of the pair that begins here
        buckets: dict[int, list[int]] = {}
        left = ids[0]
        for i in range(1, n):
            right = ids[i]
            rank = rank_of((left << 32) + right)
            left = right
            if rank is not None:
                waiting[i - 1] = rank
                if rank in buckets:
                    buckets[rank].append(i - 1)
                else:
                    buckets[rank] = [i - 1]
                    words[rank >> shift] |= bit[rank & mask]
                    top |= bit[rank >> shift]
        while top:
            # find first set on both levels: the lowest rank that waits; then clear its bits
            w = (top & -top).bit_length() - 1
            bits = words[w]
            rank = (w << shift) + (bits & -bits).bit_length() - 1
            words[w] = bits = bits & (bits - 1)
            if not bits:
                top &= top - 1
            places = buckets.pop(rank)
            if len(places) > 1:
                places.sort()
            for k, i in enumerate(places):
                if waiting[i] != rank:
                    continue  # stale
                j = after[i]
                ids[i], ids[j], waiting[i], waiting[j] = rank, -1, -1, -1
                after[i] = nxt = after[j]
                fresh = []
                if nxt < n:
                    before[nxt] = i
                    fresh.append((i, rank_of((rank << 32) + ids[nxt])))
                h = before[i]
                if h >= 0:
                    waiting[h] = -1
                    fresh.append((h, rank_of((ids[h] << 32) + rank)))
                lower = False
                for at, new in fresh:
                    if new is not None:
                        waiting[at] = new
                        lower |= new < rank
                        if new in buckets:
                            buckets[new].append(at)
                        else:
                            buckets[new] = [at]
                            words[new >> shift] |= bit[new & mask]
                            top |= bit[new >> shift]
                if lower and k + 1 < len(places):  # a lower rank goes first; the others wait again
                    buckets[rank] = places[k + 1:]
                    words[w] |= bit[rank & mask]
                    top |= bit[w]
                    break
        return [t for t in ids if t >= 0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PieceCache(dict):
    """Pre-token -> ids as little-endian 32-bit bytes, in two generations of bounded size."""

    def __init__(self, encode, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.encode, self.entries, self.old = encode, entries, {}

    def __missing__(self, piece: str) -> bytes:
        if len(piece) > CACHE_CHARS:
            return self.encode(piece)
        found = self.old.get(piece)
        if found is None:
            found = self.encode(piece)
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[piece] = found
        return found


#: The pre-token memories of this worker, emptied when a task ends.
CACHES: list[PieceCache] = []


@lru_cache(maxsize=2)
def load(path: str, pattern: str):
    """``(ByteBPE, PieceCache, compiled pattern)`` of a rank file, once per Python worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    bpe = ByteBPE(ranks)
    cache = PieceCache(lambda piece: np.array(bpe.merge(piece.encode()), "<u4").tobytes())
    CACHES.append(cache)
    return bpe, cache, regex.compile(pattern)


def forget() -> None:
    """Empty the pre-token memories of this worker; the tables stay."""
    for cache in CACHES:
        cache.clear()
        cache.old = {}


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>)`` of every whole text; a null text counts as empty and has no ids.
    ``ranks_path`` is read on the executors, where the tokenizer package is installed."""

    def compute(batches):
        bpe, cache, words = load(ranks_path, pattern)
        for batch in batches:
            ids = [np.frombuffer(b"".join(map(cache.__getitem__, words.findall(t))), "<u4").astype(np.int32)
                   for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return id_table(df, id_col, text_col).mapInArrow(tidy(compute, forget), "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``(doc_id, decoded binary)`` from :func:`encode_documents`."""

    def compute(batches):
        bpe, _, _ = load(ranks_path, pattern)
        for batch in batches:
            texts = [bpe.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(tidy(compute), "doc_id long, decoded binary")


def round_trip(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digest report of encoding every whole text and decoding its ids: one row per input row.

    Null and empty texts have no ids. Repeated rows are reported each, null ids stay null, an empty table
    gives an empty result, other columns are ignored.
    """

    def compute(batches):
        bpe, cache, words = load(ranks_path, pattern)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                raw = b"".join(map(cache.__getitem__, words.findall(text)))
                ids = np.frombuffer(raw, "<u4")
                rows.append((len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(bpe.decode(ids.tolist())).hexdigest()))
            n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                  names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_table(df, id_col, text_col).mapInArrow(tidy(compute, forget), SCHEMA)
