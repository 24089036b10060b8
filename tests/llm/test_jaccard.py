"""Operator 11 against brute force: the first regions, the pivots' cells, the blocks, and the edge cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitlens.llm import jaccard_join as jj

from .conftest import EDGE

LONG_TYPE = "region string, node long, n long, closed boolean, shingles array<long>"


def slow_set(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def slow_classes(sets, percent=80):
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_join_matches_brute_force(small):
    rows = jj.jaccard_join(small).collect()
    sets = {r.doc_id: slow_set(r.text) for r in small.collect()}
    assert {r.doc_id: r.n_shingles for r in rows} == {k: len(s) for k, s in sets.items()}
    assert {r.doc_id: r.component_id for r in rows} == slow_classes(sets)


def clusters(seed, core=60):
    """Sets in a dense cloud, in chains of near copies, just beyond the radius of others, and alone."""
    rng = random.Random(seed)
    sets = []
    for _ in range(4):
        base = [rng.getrandbits(62) for _ in range(core)]
        for _ in range(45):
            kept = base[:]
            for _ in range(rng.randrange(10)):
                kept[rng.randrange(core)] = rng.getrandbits(62)
            sets.append(kept)
        for _ in range(20):  # each step moves on from the last
            base = base[rng.randrange(1, 9):] + [rng.getrandbits(62) for _ in range(rng.randrange(9))]
            sets.append(base)
    sets += [[rng.getrandbits(62) for _ in range(rng.randrange(1, 80))] for _ in range(20)]
    return {i: frozenset(s) for i, s in enumerate(sets)}


@pytest.mark.parametrize("seed,leaf,block,copies", [(1, 12, 16, 2.0), (3, 12, 7, 8.0)])
def test_cells_and_blocks_lose_no_link(spark, monkeypatch, seed, leaf, block, copies):
    monkeypatch.setattr(jj, "LEAF_NODES", leaf)
    monkeypatch.setattr(jj, "BLOCK_SHINGLES", 60 * block)
    monkeypatch.setattr(jj, "COPIES", copies)
    monkeypatch.setattr(jj, "SALT_NODES", 50)
    sets = clusters(seed)
    rows = [("all", k, len(s), False, sorted(s)) for k, s in sets.items()]
    links = [tuple(r) for r in jj.region_join(spark.createDataFrame(rows, LONG_TYPE).repartition(5)).collect()]
    for a, b in links:  # nothing but true links
        both = len(sets[a] & sets[b])
        assert 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)
    assert len(links) < 12 * len(sets)  # not the pairs of a dense cloud
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert {k: find(k) for k in sets} == slow_classes(sets)


def test_border_of_the_threshold(spark):
    words = [f"w{i}" for i in range(13)]  # 9 shingles; nine of ten, and eight of ten
    rows = [(1, " ".join(words)), (2, " ".join([*words, "x"])), (3, " ".join(words[:-1])), (4, " ".join(words[:12]).upper()),
            (5, " ".join(f"v{i}" for i in range(8))), (6, " ".join(f"v{i}" for i in range(9)))]  # 4 and 5 shingles: exactly 80 %
    got = {r.doc_id: r.component_id for r in jj.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5}


def test_edges(edge, nothing):
    got = jj.jaccard_join(edge.withColumn("node", F.lit(1)).withColumn("digest", F.lit("x")).withColumn("component_id", F.lit(2)))
    rows = got.collect()
    assert Counter(r.doc_id for r in rows) == Counter(e[0] for e in EDGE)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[1].component_id == by_id[2].component_id == 1 and by_id[1].n_shingles == 1
    assert sorted((r.component_id, r.n_shingles) for r in rows if r.doc_id is None and r.component_id is not None) == [(1, 1)]
    # nulls, empty texts and blanks are not even linked with each other
    assert [(by_id[k].component_id, by_id[k].n_shingles, by_id[k].n_links) for k in (3, 4, 5)] == [(3, 0, 0), (4, 0, 0), (5, 0, 0)]
    assert by_id[8].n_shingles == 1 and by_id[6].n_shingles == 2
    assert jj.jaccard_join(nothing).collect() == []


def test_counts_of_common_shingles(spark):
    texts = [(i, f"the very common line of words here {i} and {i + 1} then {i * 7} comes") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    ranks = jj.shingle_ranks(docs, 5)
    common = jj.shingle_set("the very common line of words here", jj.WordHashes())
    assert (ranks[jj._counter(common)] >= 8 * 8).all() and ranks.max() < 255


def slow_links(sets, percent=80):
    n = Counter()
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                n[a] += 1
                n[b] += 1
    return {k: n[k] for k in keys}


@pytest.mark.parametrize("leaf,block,copies,share", [(1000, 1000, 2.0, 0.75), (12, 16, 2.0, 0.75), (12, 40, 8.0, 1.0)])
def test_every_link_is_counted_once(spark, monkeypatch, leaf, block, copies, share):
    for name, value in (("LEAF_NODES", leaf), ("BLOCK_SHINGLES", 60 * block), ("COPIES", copies), ("PART_OF_PAIRS", share), ("SALT_NODES", 50)):
        monkeypatch.setattr(jj, name, value)
    sets = clusters(5)
    rows = [("all", k, len(s), k, True, 1, sorted(s)) for k, s in sets.items()]
    df = spark.createDataFrame(rows, "region string, node long, n long, known long, home boolean, copies long, shingles array<long>").repartition(5)
    got = Counter()
    for r in jj.region_rows(df, 80).where("n_links is not null").collect():
        got[r.src] += r.n_links
    assert {k: got[k] for k in sets} == slow_links(sets)


def test_links_of_near_copies_and_copies(spark):
    """A cloud of near copies, all linked with each other, has its pairs counted, and so have rows with equal sets."""
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join([*words, f"end{i}"]) for i in range(30)] + [" ".join([*words, "end0"]).upper()] * 3 + ["another text of some six words", "", "   "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.component_id, r.n_links) for r in jj.jaccard_join(docs).collect()}
    assert got == {**{i: (0, 32) for i in range(33)}, **{i: (i, 0) for i in (33, 34, 35)}}


@pytest.mark.parametrize("leaf", [1024, 12])
def test_small_regions_write_no_sets(spark, monkeypatch, leaf):
    """The sets of regions that one task joins are never written, only their texts are shuffled; larger regions' sets are made from the
    texts too. Among the rows are repeated ones, ids that repeat with other texts, null ids, and copies written differently."""
    rng, written = random.Random(11), []

    def note(df, label):
        written.append((label, df.columns))
        return materialize(df, label)

    materialize = jj.materialize
    monkeypatch.setattr(jj, "materialize", note)
    monkeypatch.setattr(jj, "LEAF_NODES", leaf)
    texts = []
    for c in range(3):
        words = [f"c{c}w{i}" for i in range(70)]
        for _ in range(25):
            at = rng.randrange(70)
            texts.append(" ".join([*words[:at], f"x{rng.randrange(1000)}", *words[at + 1:]]))
        texts += [" ".join(words), " ".join(words).upper(), "\t".join(words)]
    texts += ["alone in the table with words of its own", "", "few words"]
    ids = [*range(len(texts))]
    rows = [*zip(ids, texts, strict=True), (5, texts[5]), (5, texts[5]), (7, texts[40]), (None, texts[3]), (None, texts[30]), (None, texts[30]), (None, texts[-1])]
    got = jj.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    sets = {i: slow_set(t) for i, (_, t) in enumerate(rows)}
    by_class, n_links = slow_classes(sets), slow_links(sets)
    smallest: dict[int, int] = {}
    for i, c in by_class.items():
        if rows[i][0] is not None:
            smallest[c] = min(rows[i][0], smallest.get(c, rows[i][0]))
    wanted = [(rows[i][0], len(sets[i]), smallest[c], n_links[i]) for i, c in by_class.items()]
    assert Counter(tuple(r) for r in got) == Counter(wanted)
    held = [label for label, columns in written if "shingles" in columns]
    assert bool(held) == (leaf == 12), written


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_heads_of_linked_sets_share_enough(percent):
    """In any order of the shingles, the heads of two linked sets share what either must share, also where the sets' sizes differ the most."""
    for small in range(1, 130):
        for large in range(small, 100 * small // percent + 1):
            both = -(-percent * (small + large) // (100 + percent))  # of two sets that just link
            assert both <= small
            behind = [n - (n - jj.least_shared(n, percent) + jj.head_shared(n, percent)) for n in (small, large)]
            assert 0 <= behind[0] <= behind[1]
            # whichever head ends first, all that the sets share beyond it is behind it
            assert both - behind[1] >= jj.head_shared(large, percent) and both - behind[0] >= jj.head_shared(large, percent)


def test_shared_passage_makes_no_region(spark):
    """Heads in no useful order, as in a corpus that is large for the counts: a passage in many unrelated texts, among them some with near copies,
    makes them no region. Every near copy is found."""
    rng, texts, group = random.Random(3), {}, {}
    passage = [f"p{i}" for i in range(24)]
    for c in range(40):
        words = [f"c{c}w{i}" for i in range(rng.randrange(150, 260))]
        at = rng.randrange(len(words))
        words[at:at] = passage
        copies = [words]
        if c < 12:
            spot = rng.randrange(len(words))
            copies += [[*words[:spot], "changed", *words[spot + 1:]], words[:len(words) * 85 // 100], ["other", "opening", *words], [*words, "and", "end"]]
        for words in copies:
            group[len(texts)] = c
            texts[len(texts)] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    heads = jj.shingle_heads(docs, np.zeros(jj.COUNTERS, np.uint8), 5, 80).withColumn("row", F.col("doc_id"))
    heads = jj.materialize(heads, "test-heads")
    nodes = jj.materialize(heads.select(F.col("row").alias("node"), "n", "last_rank", "last"), "test-nodes")
    pairs = [tuple(r) for r in jj.near_nodes(heads, nodes, 80).collect()]
    assert all(group[a] == group[b] for a, b in pairs)
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    linked = slow_classes({k: slow_set(t) for k, t in texts.items()})
    assert all(find(k) == find(c) for k, c in linked.items())
    assert len(set(linked.values())) == 40  # all copies are linked
