"""Operators 1, 3 and 10 against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from visitlens.llm import common, exact_dedup, line_dedup, simhash
from visitlens.llm.graph import connected_components

from .conftest import EDGE, explain_text


def classes(keys, linked):
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(keys)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def slow_simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)] * bool(words)
    ones = Counter(j for s in shingles for j in range(64) if xxhash.xxh64_intdigest(s, 42) >> j & 1)
    return sum(1 << j for j in range(64) if 2 * ones[j] > len(shingles))


def test_simhash_matches_brute_force(small):
    docs = {r.doc_id: slow_simhash(r.text) for r in small.collect()}
    want = classes(docs, lambda a, b: (docs[a] ^ docs[b]).bit_count() <= 2)
    got = {r.doc_id: r for r in simhash.simhash_near_dups(small).collect()}
    assert {k: int(r.fingerprint, 16) for k, r in got.items()} == docs
    assert {k: r.component_id for k, r in got.items()} == want


def test_grid_finds_every_close_pair_in_a_dense_cluster(spark):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(200)}
    for seed in list(prints)[:6]:
        for _ in range(60):  # chains and clouds of near copies
            prints.add(seed)
            seed ^= 1 << rng.randrange(64) ^ (1 << rng.randrange(64) if rng.random() < .7 else 0)
            seed &= (1 << 64) - 1
    prints |= {0, 1, 3, (1 << 64) - 1, (1 << 64) - 2, 1 << 63, (1 << 63) - 1}
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    want = classes(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    links = simhash.near_links(spark.createDataFrame([(s,) for s in signed.values()], "fp long"))
    assert links.where(F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) > 2).isEmpty()
    got = {r.node & (1 << 64) - 1: r.component for r in connected_components(links).collect()}
    groups = defaultdict(set)
    for p, c in want.items():
        groups[c].add(p)
    found = defaultdict(set)
    for p in prints:
        found[got.get(p, p)].add(p)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, groups.values()))
    # a pattern is named by few fingerprints: links stay linear in the fingerprints
    assert links.count() <= 65 * len(prints)


def test_segment_distance_is_a_lower_bound(spark):
    rng = random.Random(1)
    pairs = [(rng.getrandbits(64), rng.getrandbits(64)) for _ in range(50)]
    as_long = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(as_long(a), as_long(b)) for a, b in pairs], "a long, b long")
    for r, (a, b) in zip(df.select(simhash.segment_counts(F.col("a")), simhash.segment_counts(F.col("b"))).collect(), pairs, strict=True):
        lanes = [[(r[k] >> s & 15) for s in range(0, 64, 4)] for k in (0, 1)]
        assert lanes == [[(x >> s & 15).bit_count() for s in range(0, 64, 4)] for x in (a, b)]
        assert sum(abs(x - y) for x, y in zip(*lanes, strict=True)) <= (a ^ b).bit_count()


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1005), (1005, 1010), (2000, 2000)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 1000: 1000, 1005: 1000, 1010: 1000}


def test_simhash_edges(edge, nothing):
    rows = simhash.simhash_near_dups(edge).collect()
    assert len(rows) == len(EDGE)
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {3}  # null, empty and blank texts
    assert {r.component_id for r in rows if r.doc_id in (1, 2)} == {1}
    assert simhash.simhash_near_dups(nothing).collect() == []
    kept = simhash.drop_near_dups(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 3, 6, 7, 8, 9]


def test_exact_matches_brute_force(small):
    groups = defaultdict(list)
    for r in small.collect():
        groups[r.text].append(r.doc_id)
    got = exact_dedup.exact_duplicates(small).collect()
    assert len(got) == small.count()
    for r in got:
        g = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert (r.keep_id, r.group_size, r.kept) == (max(g), len(g), r.doc_id == max(g))


@pytest.mark.parametrize("hot", [0, 4000])
def test_exact_hot_group(spark, hot):
    docs = spark.range(6000).selectExpr("id as doc_id", f"if(id % 6000 < {hot}, 'same', cast(id % 1000 as string)) as text")
    rows = exact_dedup.digests(docs).cache()
    heavy = exact_dedup.heavy_digests(rows).collect()
    assert [(r.top_id, r["size"]) for r in heavy if r["size"] > 6] == ([(hot - 1, hot)] if hot else [])
    got = {r.doc_id: r for r in exact_dedup.exact_duplicates(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    top, n = {}, Counter(texts.values())
    for i, t in texts.items():
        top[t] = max(top.get(t, i), i)
    assert all((got[i].keep_id, got[i].group_size, got[i].kept) == (top[t], n[t], i == top[t]) for i, t in texts.items())
    assert sorted(r.doc_id for r in exact_dedup.drop_exact_duplicates(docs).collect()) == sorted(top.values())


def test_exact_plan_is_native(small):
    for df in (exact_dedup.exact_duplicates(small), exact_dedup.drop_exact_duplicates(small)):
        assert not re.search("Python|Arrow|Pandas", explain_text(df))


def test_exact_losers_are_found_without_python(spark):
    """Losers in every piece of a bitmap of several pieces; rows that repeat an id and a text, null ids and texts."""
    n = 10_000  # of equal texts six in seven go: 10 bits for each of them
    docs = spark.range(n).selectExpr("if(id % 97 = 0, null, id div 2) as doc_id", "if(id % 7 = 3, null, cast(id % 1400 as string)) as text").repartition(3)
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert not re.search("Python|Arrow|Pandas", explain_text(kept))
    best = {}
    for r in docs.collect():
        best.setdefault(r.text or "", []).append(-1 if r.doc_id is None else r.doc_id)
    got = [(r.text or "", -1 if r.doc_id is None else r.doc_id) for r in kept.collect()]
    assert sorted(got) == sorted((t, max(ids)) for t, ids in best.items())


def test_both_key_tests_agree(spark, tmp_path):
    spark.range(20_000).selectExpr("id * 3 as key").write.parquet(str(tmp_path / "keys"))
    keys = spark.read.parquet(str(tmp_path / "keys"))
    rows = common.with_may_hold(spark.range(60_000), keys, "key", F.col("id"), "native")
    got = rows.withColumn("python", common.may_hold(keys, "key")(F.col("id"))).collect()
    assert all(r.native == r.python for r in got) and all(r.native for r in got if r.id % 3 == 0)
    assert sum(r.native for r in got) < 30_000


def test_exact_edges(edge, nothing):
    rows = exact_dedup.exact_duplicates(edge).collect()
    assert len(rows) == len(EDGE)
    same = [r for r in rows if r.text_sha256 == hashlib.sha256(EDGE[0][1].encode()).hexdigest()]
    assert {r.keep_id for r in same} == {2} and {r.group_size for r in same} == {4} and sum(r.kept for r in same) == 1
    empty = [r for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert {r.keep_id for r in empty} == {4} and sum(r.kept for r in empty) == 1
    assert exact_dedup.exact_duplicates(nothing).collect() == []
    clash = edge.withColumns({"digest": F.lit(1), "kept": F.lit(2), "row": F.lit(3), "keep_id": F.lit(4)})
    kept = exact_dedup.drop_exact_duplicates(clash)
    assert kept.columns == clash.columns
    assert kept.count() == len({r[1] or "" for r in EDGE})
    assert exact_dedup.exact_duplicates(clash).count() == len(EDGE)


def slow_lines(docs):
    """docs: {id: text}. Later occurrences of three-line windows go."""
    seen, out = set(), {}
    for i in sorted(docs):
        lines = docs[i].split("\n")
        gone = set()
        for at in range(len(lines) - 2):
            window = tuple(lines[at:at + 3])
            if "".join(window).strip(" "):
                if window in seen:
                    gone |= {at, at + 1, at + 2}
                seen.add(window)
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone))
    return out


def test_lines_match_brute_force(small):
    want = slow_lines({r.doc_id: r.text for r in small.collect()})
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(small).collect()}
    assert got == want


def test_lines_with_overlaps_and_hot_windows(spark):
    rng = random.Random(3)
    docs = {i: "\n".join(rng.choice("abc") for _ in range(rng.randrange(12))) for i in range(300)}
    docs |= {1000 + i: f"head {i}\nsame one\nsame two\nsame three\ntail {i}" for i in range(200)}
    docs[2000] = "\n\n\n\nx"
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed)
           for r in line_dedup.dedup_lines(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert got == slow_lines(docs)
    # every line that went still stands somewhere
    assert {x for t in docs.values() for x in t.split("\n")} == {x for t, _, _ in got.values() for x in t.split("\n")} | ({""} & {x for t in docs.values() for x in t.split("\n")})


def test_lines_edges(edge, nothing):
    clash = edge.withColumns({"n_lines": F.lit(1), "covered": F.lit(2), "lines": F.lit(3)})
    rows = line_dedup.dedup_lines(clash).collect()
    assert len(rows) == len(EDGE) and set(rows[0].asDict()) == {*edge.columns, "covered", "lines", "n_lines", "n_removed"}
    assert {(r.text, r.n_lines, r.n_removed) for r in rows if r.doc_id == 3} == {(None, 0, 0)}
    assert {(r.text, r.n_lines, r.n_removed) for r in rows if r.doc_id == 4} == {("", 1, 0)}
    assert sum(r.n_removed for r in rows) == 0
    assert line_dedup.dedup_lines(nothing).collect() == []


def test_key_bitmap_never_misses(spark):
    from visitlens.llm.common import may_hold
    keys = spark.range(0, 3000, 7).withColumnRenamed("id", "k")
    test = may_hold(keys, "k")
    found = {r.id for r in spark.range(3000).where(test(F.col("id"))).collect()}
    assert {r.k for r in keys.collect()} <= found and len(found) < 600
    assert spark.range(100).where(may_hold(keys.limit(0), "k")(F.col("id"))).count() == 0
