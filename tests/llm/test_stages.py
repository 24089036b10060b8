"""Stages keep rows whatever the caller's columns are called, and lose no row but duplicates."""

import base64
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitlens.llm import bpe, exact_dedup, line_dedup, quality, simhash

NAMES = ["__lost", "lost_id", "lost_print", "row", "id", "print", "digest", "key", "kept", "place", "first", "d", "i", "one_stays", "__id", "__hash", "__ats", "__cut",
         "cut", "ats", "hash", "found_id", "touched", "value", "__score", "score", "fp", "a.b"]


def clashing(df):
    return df.withColumns({c: F.lit("kept") for c in NAMES})


def same_rows(got, plain, names=NAMES):
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in plain)
    assert all({r[c] for c in names} == {"kept"} for r in got)


def test_near_copies_with_clashing_columns(small):
    same_rows(simhash.drop_near_dups(clashing(small)).collect(), simhash.drop_near_dups(small).collect())


def test_exact_copies_with_clashing_columns(small):
    same_rows(exact_dedup.drop_exact_duplicates(clashing(small)).collect(), exact_dedup.drop_exact_duplicates(small).collect())


def test_lines_with_clashing_columns(small):
    same_rows(line_dedup.dedup_lines(clashing(small)).collect(), line_dedup.dedup_lines(small).collect())


def test_quality_with_clashing_columns(small, labels):
    model = quality.fit(small, labels)
    same_rows(quality.keep_good(clashing(small), model).collect(), quality.keep_good(small, model).collect())


def test_exact_copies_keep_one_row_of_each_text(spark):
    rows = [(1, "a"), (5, "a"), (5, "a"), (5, "b"), (None, "b"), (None, "c"), (None, "c"), (7, None), (8, ""), (9, "d"), (9, "e"), (9, "d")]
    got = exact_dedup.drop_exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert Counter(map(tuple, got)) == Counter([(5, "a"), (5, "b"), (None, "c"), (8, ""), (9, "d"), (9, "e")])


def test_near_copies_spare_other_texts_of_a_loser_id(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (2, text), (2, "something else that stands alone here"), (None, text)]
    got = simhash.drop_near_dups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text[:9]) for r in got) == Counter([(1, text[:9]), (2, "something"), (None, text[:9])])


# -- 6: features and training, written out byte by byte ------------------------------------------------


def slow_bucket(h, kind):
    h ^= 0x9E3779B1 * kind & 0xFFFFFFFF
    h = (h ^ h >> 15) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h >> 32 - quality.BUCKET_BITS


def slow_buckets(text):
    """The always-feature, words, pairs of neighbouring words, and 3- and 4-grams that hold no inner space."""
    prime, data = 0x01000193, b" " + (text or "").encode() + b" "
    data = bytes(32 if c in b"\t\n\x0b\x0c\r " else c for c in data)
    out, words = Counter([0]), []
    for word in data.split(b" "):
        if word:
            power, h = 1, 0
            powers = []
            for _ in range(64):
                power = power * prime & 0xFFFFFFFF
                powers.append(power)
            for i, c in enumerate(word):
                h += (c + 1) * powers[i & 63]
            words.append(h & 0xFFFFFFFF)
    out.update(slow_bucket(w, 1) for w in words)
    out.update(slow_bucket(a ^ b, 2) for a, b in zip(words, words[1:], strict=False))
    for n in (3, 4):
        for i in range(len(data) - n + 1):
            gram = data[i:i + n]
            if 32 not in gram[1:-1]:
                h = 0
                for c in gram:
                    h = (h * prime + c) & 0xFFFFFFFF
                out[slow_bucket(h, n)] += 1
    return out


TEXTS = ["a few plain words, and a few more words words", "", None, "x", "  lead and trail \n\n", "Ünïcode 漢字 🙂 mixed\ttabs", "y" * 130 + " z", "one two"]


def test_feature_lists_match_brute_force():
    import pyarrow as pa
    ids, shares = quality._feature_columns(pa.array([t or "" for t in TEXTS]))
    for text, found, share in zip(TEXTS, ids.to_pylist(), shares.to_pylist(), strict=True):
        want = slow_buckets(text)
        assert found == sorted(want)
        assert share == pytest.approx([want[b] / want.total() for b in found], rel=1e-6)


def test_training_matches_plain_python(monkeypatch):
    monkeypatch.setattr(quality, "EPOCHS", 2)
    lists = [slow_buckets(t) for t in TEXTS[:4]]
    labels = np.array([1, 0, 0, 1])
    ids = [np.array(sorted(c)) for c in lists]
    shares = [np.array([c[b] / c.total() for b in sorted(c)], np.float32) for c in lists]
    model = quality.train(ids, shares, labels)
    rng = np.random.default_rng(11)
    start = rng.uniform(-1 / quality.DIM, 1 / quality.DIM, (1 << quality.BUCKET_BITS, quality.DIM))
    vectors, output, done = {}, [[0.0] * quality.DIM for _ in range(2)], 0
    for _ in range(2):
        for i in rng.permutation(4):
            rate = quality.RATE * (1 - done / 8)
            done += 1
            rows = [vectors.setdefault(int(b), start[b].tolist()) for b in ids[i]]
            mean = [sum(float(s) * row[k] for s, row in zip(shares[i], rows, strict=True)) for k in range(quality.DIM)]
            z = [sum(o * m for o, m in zip(out, mean, strict=True)) for out in output]
            top = [np.exp(v - max(z)) for v in z]
            p = [t / sum(top) - (c == labels[i]) for c, t in enumerate(top)]
            back = [sum(p[c] * output[c][k] for c in range(2)) for k in range(quality.DIM)]
            for c in range(2):
                output[c] = [o - rate * p[c] * m for o, m in zip(output[c], mean, strict=True)]
            for s, row in zip(shares[i], rows, strict=True):
                for k in range(quality.DIM):
                    row[k] -= rate * float(s) * min(len(rows), 50) * back[k]
    for b, row in vectors.items():
        want = sum(v * (output[1][k] - output[0][k]) for k, v in enumerate(row))
        assert model.logits[b] == pytest.approx(want, abs=2e-4)


# -- 8: large tables of ranks -----------------------------------------------------------------------------


def test_more_than_65536_ranks(byte_bpe):
    import tiktoken
    path, pattern = byte_bpe
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    rng, tokens = random.Random(4), list(ranks)
    while len(ranks) < 100_000:  # each new token merges two earlier ones
        token = rng.choice(tokens) + rng.choice(tokens)
        if token not in ranks:
            ranks[token] = len(ranks)
            tokens.append(token)
    known = tiktoken.Encoding("large", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    made = bpe.ByteBPE(ranks)
    assert max(ranks.values()) > 1 << 16 and len(made.bit) == 512
    for _ in range(400):
        piece = b"".join(rng.choice(tokens) for _ in range(rng.randrange(1, 12)))
        assert made.merge(piece) == known._encode_single_piece(piece)
        assert made.decode(made.merge(piece)) == piece
