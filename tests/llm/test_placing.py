"""Operators 2 and 7 and the pipeline against brute force, and their edge cases."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from visitlens.llm import exact_dedup, packing, pii, quality, sharding, simhash

from .conftest import EDGE, LONG

# -- 2: Hilbert shards --------------------------------------------------------------------------


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_hilbert_curve_steps_to_neighbours(dims, bits):
    side = 1 << bits
    grid = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    index = sharding.hilbert_index(grid, bits)
    assert sorted(index) == list(range(side ** dims))
    path = grid[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check_shards(rows, docs, shards):
    """docs: (doc_id, text) of every row."""
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in rows), key=key) == \
        sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs), key=key)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append((r.slot, r.hilbert_index))
    counts = [len(slots[k]) for k in range(shards)]
    assert set(slots) <= set(range(shards)) and max(counts) - min(counts) <= 1
    along = []
    for k in range(shards):
        assert [s for s, _ in sorted(slots[k])] == list(range(counts[k]))
        along += [h for _, h in sorted(slots[k])]
    assert along == sorted(along)  # shards are runs of the curve
    assert {r.law for r in rows} <= {"rows"} and {r.grown_shard for r in rows} <= {None}


@pytest.mark.parametrize("shards", [1, 7, 40, 500])
def test_shards_are_equal_runs_of_the_curve(small, shards):
    rows = sharding.document_shards(small.repartition(4), shards).collect()
    check_shards(rows, [(r.doc_id, r.text) for r in small.collect()], shards)


def test_shards_prune_by_every_dimension(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    placed = sharding.document_shards(docs, 16).join(docs.select("doc_id", "lang", "source", "n_chars"), "doc_id")
    spans = placed.groupBy("shard").agg(F.countDistinct("lang").alias("l"), F.countDistinct("source").alias("s"),
                                        (F.max("doc_id") - F.min("doc_id")).alias("d")).agg(F.avg("l"), F.avg("s"), F.avg("d")).first()
    assert spans[0] < 3 and spans[1] < 15 and spans[2] < 900  # 4 languages, 20 sources, 1000 ids in all


def test_text_steps_follow_the_rows(spark):
    rng = random.Random(5)
    values = [None, "", "arxiv", "https://a", "https://ab", "https://b.org", "https://é", "x" * 3000] + [f"https://site{i}.org" for i in range(60)]
    rows = sorted((rng.choice(values) for _ in range(900)), key=lambda v: (v is not None, (v or "").encode()))
    want = [next((r for r in rows if sum(1 for x in rows if (x is not None, x or "") <= (r is not None, r or "")) * 32 >= k * len(rows))) for k in range(1, 32)]
    df = spark.createDataFrame([(v,) for v in rows], "a_b string").repartition(5)
    assert sharding._text_bounds(df, "a_b", 32) == [sharding._order(None if w is None else w.encode()) for w in want]


def test_shards_prune_by_sources_with_a_long_prefix(spark):
    docs = [(i, "arxiv" if i % 8 == 0 else f"https://site{i % 8}.org/data") for i in range(4000)]
    rows = sharding.hilbert_shards(spark.createDataFrame(docs, "doc_id long, source string"), ["source"], 8).collect()
    shards = defaultdict(set)
    for r in rows:
        shards[r.shard].add(r.source)
    assert [len(shards[s]) for s in range(8)] == [1] * 8


def test_hot_cell_is_cut_evenly(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"),
                                    F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("source"))
    check_shards(sharding.document_shards(docs, 40).collect(), [(r.doc_id, r.text) for r in docs.collect()], 40)


def test_shard_edges(edge, nothing):
    clash = edge.withColumns({"shard": F.lit(1), "slot": F.lit(2), "size": F.lit(3), "curve": F.lit(4)})
    check_shards(sharding.document_shards(clash, 5).collect(), [r[:2] for r in EDGE], 5)
    assert sharding.document_shards(nothing, 5).collect() == []


def test_shards_are_written_in_slot_order(spark, small, tmp_path):
    assigned = sharding.document_shards(small, 4)
    sharding.write_shards(small, assigned, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == small.count() and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
    for k in range(4):
        slots = [r.slot for r in spark.read.parquet(str(tmp_path / "shards" / f"shard={k}")).collect()]
        assert slots == list(range(len(slots)))


# -- 7: packing ---------------------------------------------------------------------------------


def one_by_one(counts, capacity):
    """The procedure as it is worded, a bin and a piece at a time."""
    left, bins = dict(enumerate(counts)), []
    while any(left.values()):
        filled, gap = [], capacity
        while (fits := [s for s, n in left.items() if n and 0 < s <= gap]):
            filled.append(max(fits))
            left[filled[-1]] -= 1
            gap -= filled[-1]
        if gap and len(filled) > 1:
            least = filled[-1]
            wide = gap + least
            pairs = [(a + b, a, b) for a, n in left.items() for b, m in left.items()
                     if n and m and 0 < b <= a and a + b <= wide and (a != b or n > 1)]
            if pairs and max(pairs)[0] > least:
                total = max(pairs)[0]
                _, a, b = min(p for p in pairs if p[0] == total)
                filled[-1:] = [a, b]
                left[a] -= 1
                left[b] -= 1
                left[least] += 1
        bins.append(filled)
    return bins


@pytest.mark.parametrize("seed", range(8))
def test_packing_by_counts_equals_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 24, 40])
    counts = [0] + [rng.choice([0, 0, 1, 2, 5, 30]) for _ in range(capacity)]
    got = [sorted(b) for b, times in packing.best_two_fit(np.array(counts), capacity) for _ in range(times)]
    want = [sorted(b) for b in one_by_one(counts, capacity)]
    assert all(sum(b) <= capacity for b in got)
    assert [sum(b) for b in got] == [sum(b) for b in want]
    assert np.bincount([s for b in got for s in b], minlength=capacity + 1).tolist() == counts


def check_packing(rows, docs, word_bpe, capacity=2048):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(word_bpe)
    want, total = [], 0
    for i, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        want += [(i, k // capacity, k, len(ids[k:k + capacity]), zlib.crc32(np.array(ids[k:k + capacity], "<u4").tobytes()))
                 for k in range(0, len(ids), capacity)]
    assert sorted((tuple(r[:5]) for r in rows), key=repr) == sorted(want, key=repr)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    return len(sequences), -(-total // capacity)


def test_packing_matches_the_tokenizer_and_fills(spark, word_bpe):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    n, least = check_packing(packing.pack_documents(docs.repartition(5), word_bpe).collect(),
                             [(r.doc_id, r.text) for r in docs.collect()], word_bpe)
    assert n <= 1.01 * least + 1


def test_hot_length(spark, word_bpe):
    docs = [(i, "the same words again") for i in range(900)] + [(1000 + i, "word " * (i % 50)) for i in range(300)]
    n, least = check_packing(packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(6), word_bpe, 64).collect(),
                             docs, word_bpe, 64)
    assert n <= 1.02 * least + 1


def test_words_are_encoded_as_the_tokenizer_does(word_bpe):
    rng = random.Random(1)
    cache = packing.WordCache(word_bpe, words=300, parts=200)  # generations change often
    pool = "abcdefXYZ012 '.,!?\t\né́ÉßİıŉǅɐΣσςéÅÅ中٣🙂\x00\x1c\x1f\x85\xa0­​ 　'sItsI'LL"
    for _ in range(20):
        texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(80))) for _ in range(100)] + ["<|endoftext|> x", "", "a" * 300]
        for t, raw in zip(texts, cache.encode(texts), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == cache.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_a_part_is_merged_once_whatever_stands_around_it(word_bpe):
    cache = packing.WordCache(word_bpe)
    texts = ["dog dog, (Dog) dog's DOG.", "", "dog12 ''dog'll", " \t "]
    assert [np.frombuffer(raw, "<u4").tolist() for raw in cache.encode(texts)] == [cache.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert set(cache.words) == {"dog", ",", "(", ")", "'s", ".", "1", "2", "''", "'ll"}
    assert cache.encode([]) == [] and cache.encode(["", " \n"]) == [b"", b""]


def test_blocks_are_cut_as_the_tokenizer_cuts(word_bpe, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_CHARS", 100)
    rng = random.Random(7)
    pieces = ["'", "'s", "'re", "'ve", "'ll", "'d", "l", "r", "e", "s", "T", "é", "Ñ", "Ⱥ", "ŉ", "ß", "½", "7", "--", "$", "\xad", "’", "漢", "e\u0301", " ", " ", "\n", "\x85", "\x1d", "\u2009"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(3000)]
    tokenizer = packing.word_cache(word_bpe).tokenizer
    got, at = [], 0
    for lo, hi, ids in packing._encoded(texts, word_bpe):
        assert lo == at and len(ids) == hi - lo
        got, at = got + ids, hi
    want = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert all(np.frombuffer(raw, "<u4").tolist() == [*w.ids, 0] for raw, w in zip(got, want, strict=True))
    packing.word_cache.cache_clear()


def test_special_tokens_keep_the_tokenizers_ids(spark, word_bpe):
    from tokenizers import Tokenizer
    untouched = Tokenizer.from_file(word_bpe)
    texts = ["a <|endoftext|> x", "<|startoftext|>abc<|endoftext|>", "<|endoftext|", "x<|ENDOFTEXT|>y", "<|", "many words <|endoftext|><|endoftext|> more", "plain"]
    want = [untouched.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [320, 49407, 343]
    assert [np.frombuffer(raw, "<u4").tolist() for raw in packing.WordCache(word_bpe).encode(texts)] == want
    docs = list(enumerate(texts))
    check_packing(packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string"), word_bpe, 8).collect(), docs, word_bpe, 8)


def test_word_memory_ends_with_the_task(word_bpe):
    list(packing._encoded(["some words"], word_bpe))
    assert packing.word_cache(word_bpe).words
    packing.word_cache.cache_clear()
    assert not packing.word_cache(word_bpe).words


def test_packing_edges(edge, nothing, word_bpe):
    rows = packing.pack_documents(edge.withColumns({"part": F.lit(1), "place": F.lit(2), "length": F.lit(3)}), word_bpe).collect()
    check_packing(rows, [r[:2] for r in EDGE], word_bpe)
    assert packing.pack_documents(nothing, word_bpe).collect() == []
    assert len([r for r in rows if r.doc_id == 6]) > 25 and len(LONG) > 400_000


def test_sequences_hold_the_tokens(small, word_bpe):
    packed = packing.pack_documents(small, word_bpe)
    tokens = packing.tokenised(small, word_bpe)
    lengths = {r.sequence_id: r.n for r in packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()}
    made = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed, tokens).collect()}
    assert {k: len(v) // 4 for k, v in made.items()} == lengths
    ids = {r.doc_id: bytes(r.ids) for r in tokens.collect()}
    for r in packed.collect():
        assert made[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == ids[r.doc_id][4 * r.start:4 * (r.start + r.length)]


# -- the pipeline ----------------------------------------------------------------------------------


def test_pipeline_matches_brute_force(spark, small, labels, word_bpe):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in small.collect()}
    model = quality.fit(small, labels)
    scores = {r.doc_id: r.score for r in quality.score_documents(small, model).collect()}
    good = {i: t for i, t in docs.items() if scores[i] >= 0.7}
    last = {t: i for i, t in sorted(good.items())}
    single = {i: t for t, i in last.items()}
    prints = {i: simhash.simhash(t) for i, t in single.items()}
    kept = {}
    for i in sorted(single):  # smallest id of each class; classes by closure
        near = [j for j in sorted(single) if (prints[i] ^ prints[j]).bit_count() <= 2]
        kept.setdefault(min(near), single[min(near)])
    private = {i: pii.replace_entities(t, pii.DEFAULT_KEY, {})[0] for i, t in kept.items()}
    rows = corpus_pipeline.run(spark, sf).collect()
    n, least = check_packing(rows, list(private.items()), word_bpe)
    assert n <= 1.05 * least + 1
    assert 0 < len(docs) - len(kept)


def test_stages_take_their_predecessors_rows_and_keep_columns(spark, edge, nothing):
    sf = "/root/testdata/sf0.001"
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "simhash", "pii", "packing"]
    for docs in (edge, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf).columns == docs.columns
            docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= docs.count()


def test_stages_filter_as_their_operators_say(spark, small):
    kept = exact_dedup.drop_exact_duplicates(small)
    assert kept.count() == small.select("text").distinct().count()
    near = simhash.drop_near_dups(kept)
    assert near.count() == simhash.simhash_near_dups(kept).select("component_id").distinct().count()
