"""Operator 12 against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from visitlens.llm import resampling

from .conftest import EDGE


def slow_features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def slow_resample(docs, target, longest=1, buckets=10_000, percent=10):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, slow_features(text, longest)[1]))
    for text in target:
        t.update(map(bucket, slow_features(text, longest)[1]))
    all_s, all_t = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in {*s}}
    rows, fit = [], []
    for doc_id, text in docs:
        words, features = slow_features(text, longest)
        weight = sum(gain[bucket(f)] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        row = [doc_id, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        rows.append(row)
        if len(words) >= 20:
            fit.append(row)
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, row in enumerate(fit[:percent * len(fit) // 100], 1):
        row[4] = rank
    return Counter(map(tuple, rows))


@pytest.mark.parametrize("longest,head", [(1, resampling.HEAD), (1, 1), (2, 200), (3, 50)])
def test_resampling_matches_brute_force(spark, small, longest, head):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = slow_resample([(r.doc_id, r.text) for r in small.collect()], [r.text for r in target.collect()], longest)
    got = resampling.resample(small, target, longest=longest, head=head)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert Counter(map(tuple, got.collect())) == want


def test_head_holds_the_frequent_words_and_pairs(spark):
    docs = spark.createDataFrame([(i, f"red fox number{i} red fox") for i in range(50)], "doc_id long, text string")
    states = resampling.frequent_words(docs, head=10)
    assert dict(states) == {w: zlib.crc32(w) for w in (b"red", b"fox")}  # each at least one in ten of 250 words
    assert states[b"number7"] == zlib.crc32(b"number7") and b"number7" not in states
    assert resampling.frequent_pairs(docs, states, 100, head=10) == {(b"red", b"fox"): zlib.crc32(b"red fox") % 100}


def test_edges(spark, edge, nothing):
    target = spark.createDataFrame([("alpha beta",), (None,), ("",)], "text string")
    docs = edge.withColumn("rank", F.lit("x")).withColumn("buckets", F.lit(1))
    got = Counter(map(tuple, resampling.resample(docs, target, percent=100).collect()))
    assert got == slow_resample([e[:2] for e in EDGE], ["alpha beta", None, ""], percent=100)
    assert resampling.resample(nothing, target).collect() == []
    empty = resampling.resample(docs, target.where("false"))
    assert Counter(map(tuple, empty.collect())) == slow_resample([e[:2] for e in EDGE], [])


def test_ties_and_repeated_rows_get_ranks_without_gaps(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(7, text)] * 30 + [(i, text) for i in range(100, 170)], "doc_id long, text string").repartition(9)
    rows = resampling.resample(docs, docs.limit(1), percent=50).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 51))
    order = sorted(rows, key=lambda r: (-r.score, r.doc_id))
    assert {(r.doc_id, r.score) for r in order[:50]} == {(r.doc_id, r.score) for r in rows if r["rank"]}
