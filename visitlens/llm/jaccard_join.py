"""N-gram Jaccard join: a metric-space join with pivots, Voronoi regions and triangle-inequality windows.

The Jaccard distance ``d = 1 - |A & B| / |A | B|`` is a metric, and two documents link at ``d <= r`` (``r`` = 0.2).

1. Equal shingle sets become one node. A fixed-size count of all shingles orders them from seldom to common; only
   the order depends on it, never a result.
2. First regions: the *head* of a set are its ``|A| - ceil(0.8 |A|) + k`` seldomest shingles, ``k`` about a fifteenth of them all. Two sets
   of which one's head ends before the other's have no more in common than their heads have, plus what lies behind the first head. So the heads
   of linked sets share ``k`` shingles at least, and nodes whose heads share too little are more than ``r`` apart (:func:`near_nodes`). A
   few shingles that unrelated texts share seldom join them. The components of what is left are regions that no link leaves.
3. A region of bounded size is joined exactly in one task. A larger one draws ``PIVOTS`` pivots among its nodes, leaves out those
   within ``r`` of an earlier one and measures each node's distance to the others. A node in a pivot's ball (``d <= r``) is linked to the pivot.
   Each node's home is the Voronoi cell of its nearest pivot. It is copied to every other cell whose pivot is at most
   ``2r`` farther than its own: by the triangle inequality, two linked nodes then meet in the home of each.
   The cells are regions of their own and are joined the same way.
4. Every link is counted, a node's links in its home, where all the nodes it links with are. Links themselves are only kept
   where they join what is not yet ``known`` to be connected, so a dense group of near copies gives its counts and a tree, not its pairs.
5. A region that its pivots do not divide (all its nodes are about equally far from each other) is joined in blocks: its nodes
   are dealt to bounded groups, and a task joins two of them. That is exact too.

Texts travel only for nodes of regions with two or more members. A text takes about half the disk of its set's digests, so a small
region's sets are made from the texts in the task that joins them; only those of large regions are written. Nothing but a count for each
large region's level and the fixed-size shingle counts reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType
from pyspark.sql.window import Window

from .common import id_table, materialize, may_hold, shuffle_partitions, tidy
from .graph import connected_components

SHINGLE_WORDS, PERCENT = 5, 80
#: Nodes and shingles of a region that one task joins, pivots of a larger one, and shingles of a block.
LEAF_NODES, LEAF_SHINGLES, PIVOTS, BLOCK_SHINGLES = 1024, 1 << 20, 8, 1 << 20
#: Levels of division, and how many copies of a node they may make on the average; then blocks.
LEVELS, COPIES = 6, 2.0
#: Share of its pairs that a divided region's cells may have.
PART_OF_PAIRS = 0.75
#: Counters of the shingle counts (4 MB a task) and counters a row.
COUNTERS, ROW_COUNTERS = 1 << 20, 1 << 14
#: Linked sets have one of so many shared shingles in both heads. Rounds that drop nodes whose heads share fewer; a round is the last if it leaves more
#: than this part of the rows.
HEAD_PART, PRUNINGS, PRUNED = 12, 4, 0.9
#: Nodes that share a shingle of their heads and are looked at in pairs; more of them are held together by one.
FEW = 3
#: Nodes of a region that meet one copy of its pivots in a task.
SALT_NODES = 2048
CACHE_WORDS = 100_000
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class WordHashes(dict):
    """XXH3 of words, remembered up to ``CACHE_WORDS``."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, words: WordHashes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted 64-bit digests of the distinct word shingles, signed. Fewer words than ``width`` are one shingle; none, none.

    A-Z are lower-cased; words are runs of anything but ASCII white space (what ``bytes.split`` does)."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.int64)
    if len(words) > CACHE_WORDS:
        words.clear()
    if len(found) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), len(found))], np.uint64).view(np.int64)
    hashes = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = len(found) - width + 1
    mixed = np.full(n, width, np.uint64)
    for i in range(width):
        part = hashes[i:i + n] * _FACTORS[i % 5]
        mixed = mixed * np.uint64(0x100000001B3) + (part ^ (part >> np.uint64(31)))
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed.view(np.int64))


def least_shared(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` has in common with any set it links with, at least."""
    return -(-percent * n // 100)


def head_shared(n: int, percent: int) -> int:
    """Shingles that the head of a set of ``n`` has in common with the head of any set it links with, at least.

    With ``t`` of :func:`least_shared`, a head leaves ``t - head_shared`` shingles behind it. That never falls with ``n``, as ``head_shared`` grows
    with ``t`` only and more slowly. Two linked sets share ``t`` of the larger one at least, so their heads share what either set must share."""
    return 1 + least_shared(n, percent) // HEAD_PART


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles.view(np.uint64) >> np.uint64(44)).astype(np.int64)


def shingle_ranks(docs: DataFrame, width: int) -> np.ndarray:
    """For each of ``COUNTERS`` hash classes of shingles, how common it is (0 to 255), from counts over all documents."""

    def count(batches):
        words, counts = WordHashes(), np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for text in batch.column(1):
                np.add.at(counts, _counter(shingle_set(text.as_py(), words, width)), 1)
        rows = counts.reshape(-1, ROW_COUNTERS)
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array([rows[i].tobytes() for i in used], pa.binary())], names=["piece", "counts"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ROW_COUNTERS, np.uint64)
        for batch in batches:
            for raw in batch.column("counts"):
                total += np.frombuffer(raw.as_buffer(), np.uint32)
        level = np.minimum(255, np.floor(8 * np.log2(1 + total.astype(float)))).astype(np.uint8)
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([level.tobytes()], pa.binary())], names=["piece", "levels"])

    pieces = (docs.mapInArrow(tidy(count), "piece int, counts binary").groupBy("piece").applyInArrow(add, "piece int, levels binary").collect())
    ranks = np.zeros(COUNTERS, np.uint8)
    for piece, raw in pieces:  # COUNTERS / ROW_COUNTERS rows at most
        ranks[piece * ROW_COUNTERS:(piece + 1) * ROW_COUNTERS] = np.frombuffer(raw, np.uint8)
    return ranks


def text_sha() -> Column:
    return F.unhex(F.sha2("text", 256))


def shingle_heads(docs: DataFrame, ranks: np.ndarray, width: int, percent: int) -> DataFrame:
    """``(doc_id, text_sha, n, digest, head, last_rank, last)``: a row's set size, the 128-bit digest of its set (null for the empty set), its
    seldomest shingles and the place of the last of them in the order of all shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # COUNTERS bytes

    def compute(batches):
        words, level = WordHashes(), shared.value
        for batch in batches:
            sizes, digests, heads, last = [], [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), words, width)
                n = len(shingles)
                ranks = level[_counter(shingles)]
                order = np.argsort(ranks, kind="stable")  # ties stay in the order of the digests
                end = n - least_shared(n, percent) + head_shared(n, percent)
                sizes.append(n)
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()) if n else None)
                heads.append(shingles[order[:end]] if n else shingles)
                last.append((ranks[order[end - 1]], shingles[order[end - 1]]) if n else (None, None))
            last_rank, last_shingle = zip(*last, strict=True) if last else ((), ())
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                                   pa.array(heads, pa.list_(pa.int64())), pa.array(last_rank, pa.int32()), pa.array(last_shingle, pa.int64())],
                                  names=["doc_id", "text_sha", "n", "digest", "head", "last_rank", "last"])

    return docs.select("doc_id", "text", text_sha().alias("text_sha")).mapInArrow(
        tidy(compute), "doc_id long, text_sha binary, n long, digest binary, head array<long>, last_rank int, last long")


def shared_heads(seldom: DataFrame) -> DataFrame:
    """The rows of ``seldom (node, class, least, shingle)`` whose shingle other nodes have too, of nodes with ``least`` of them: no other node
    links. What they alone shared goes with them, so that is repeated until little more goes; both nodes of a link and all they share stay."""
    rows, left, known = seldom, None, False
    for _ in range(PRUNINGS):
        common = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
        if not known:  # most shingles are in one head only: these stay where they are
            common = materialize(common, "jaccard-common")
            rows = rows.where(may_hold(common, "shingle")(F.col("shingle")))
        held = F.count(F.lit(1)).over(Window.partitionBy("node"))
        rows = materialize(rows.join(common, "shingle").withColumn("held", held).where("held >= least").drop("held"), "jaccard-shared")
        before, left, known = left, rows.count(), True
        if before is not None and left > PRUNED * before:
            break
    return rows


def near_nodes(heads: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(src, dst)`` whose components hold every link between the ``nodes``.

    Linked sets differ in size by the factor ``100 / percent`` at most, so a head's shingle is shared only within two neighbouring size
    classes. Nodes that share too little with all others go (:func:`shared_heads`). ``FEW`` nodes that share a shingle are counted in pairs;
    a pair stays if the shingles it shares, and those that more than ``FEW`` share, could be enough. Where more share a shingle, each stays with
    the first of them, but not for the commonest: as linked nodes share ``least`` shingles, they share one that is not among the ``least - 1``
    commonest of either.
    """
    size_class = F.floor(F.ln("n") / F.lit(np.log(100 / percent) + 1e-9)).cast("int")
    shared_least = f"({percent} * {{n}} + 99) div 100"
    least = F.expr(f"cast(1 + {shared_least.format(n='n')} div {HEAD_PART} as int)")  # head_shared
    # a row that only seems to be a node repeats a node's head: it adds no pair of nodes, and the node comes first
    seldom = (heads.where("n > 0").where(may_hold(nodes, "node")(F.col("row")))
              .select(F.col("row").alias("node"), size_class.alias("class"), least.alias("least"), F.explode("head").alias("shingle")))
    shared = shared_heads(seldom).withColumn("cell", F.explode(F.array("class", F.col("class") + 1)))
    member = F.struct("node", "class")
    cells = materialize(shared.groupBy("shingle", "cell").agg(
        F.count(F.lit(1)).alias("c"), F.min(member).alias("a"), F.max(member).alias("z"), F.sum("node").alias("nodes"), F.sum("class").alias("classes"))
        .where("c > 1"), "jaccard-cells")
    large = cells.where(F.col("c") > FEW).select("shingle", "cell", "c", F.col("a.node").alias("hub"))
    place = F.row_number().over(Window.partitionBy("node", "cell").orderBy(F.desc("c"), F.desc("shingle")))
    crowd = materialize(shared.where(may_hold(large, "shingle")(F.col("shingle"))).join(large, ["shingle", "cell"])
                        .select("node", "hub", "shingle", (place >= F.col("least")).alias("joins")), "jaccard-crowds")
    # of three nodes the sums give the one in the middle
    middle = F.expr("named_struct('node', nodes - a.node - z.node, 'class', cast(classes - a.class - z.class as int))")
    few = cells.where(F.col("c") <= FEW).select("cell", "a", "z", F.when(F.col("c") == 3, middle).alias("m"))
    pairs = (few.select("cell", F.explode(F.expr("array(struct(a, z as b), struct(a, m as b), struct(m as a, z as b))")).alias("p"))
             .where(F.greatest("p.a.class", "p.b.class") == F.col("cell"))  # in one of the two cells where both are
             .where(F.col("p.a").isNotNull() & F.col("p.b").isNotNull())
             .groupBy(F.col("p.a.node").alias("src"), F.col("p.b.node").alias("dst")).agg(F.count(F.lit(1)).alias("shared")))
    crowded = crowd.groupBy("node").agg(F.countDistinct("shingle").alias("crowded"))
    known = (nodes.join(crowded, "node", "left")
             .select("node", F.struct("n", F.struct("last_rank", "last").alias("end"), F.coalesce("crowded", F.lit(0)).alias("crowded")).alias("x")))
    met = (pairs.join(known.withColumnsRenamed({"node": "src", "x": "a"}), "src").join(known.withColumnsRenamed({"node": "dst", "x": "b"}), "dst"))
    met = met.withColumn("first", F.expr(shared_least.format(n="if(a.end <= b.end, a.n, b.n)")))
    behind = F.expr(f"first - 1 - first div {HEAD_PART}")  # shingles of a set behind its head
    wanted = F.expr(f"({percent} * (a.n + b.n) + {99 + percent}) div {100 + percent}")
    kept = met.where(F.expr(f"100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)")
                     & (F.col("shared") + F.least("a.crowded", "b.crowded") + behind >= wanted))
    return kept.select("src", "dst").union(crowd.where("joins and node != hub").select("node", "hub")).distinct()


def node_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``nodes (text_sha, rep_id, …)`` with their ``text``; texts that are no node's never leave their task."""
    wanted = may_hold(nodes.select(F.xxhash64("text_sha", "rep_id").alias("key")), "key")
    held = docs.withColumn("text_sha", text_sha()).where(wanted(F.xxhash64("text_sha", "doc_id")))
    return held.select("text_sha", "text").dropDuplicates(["text_sha"]).join(nodes.drop("rep_id"), "text_sha").drop("text_sha")


def _with_sets(rows: pa.Table, words: WordHashes, width: int) -> pa.Table:
    """``rows`` with ``shingles`` in place of the last column ``text``."""
    sets = pa.array([shingle_set(t.as_py(), words, width) for t in rows.column("text")], pa.list_(pa.int64()))
    return rows.set_column(rows.num_columns - 1, "shingles", sets)


def node_sets(texts: DataFrame, width: int) -> DataFrame:
    """``texts (…, text)`` with ``shingles`` in place of ``text``."""
    others = [c for c in texts.columns if c != "text"]

    def compute(batches):
        words = WordHashes()
        for batch in batches:
            yield from _with_sets(pa.Table.from_batches([batch]), words, width).to_batches()

    schema = texts.select(*others).schema.add("shingles", ArrayType(LongType()))
    return texts.select(*others, "text").mapInArrow(tidy(compute), schema)


def _find(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def region_links(nodes: np.ndarray, known: np.ndarray, home: np.ndarray, copies: np.ndarray, side: np.ndarray, sets: list[np.ndarray],
                 percent: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links within one region that join all its clusters, and for each ``home`` node the ``copies`` of all nodes it links with.

    All pairs are looked at, or those of two sides if there are two. A node is connected with the one it is ``known`` by."""
    n = np.array([len(s) for s in sets])
    counts = np.zeros(len(nodes), np.int64)
    _, codes, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    starts = np.concatenate([[0], np.cumsum(n)])
    common = uses[codes] > 1
    # a node links with nothing if too few of its shingles are in any other set; from small sets to large
    rows = np.flatnonzero(100 * np.add.reduceat(common, starts[:-1], dtype=np.int64) >= percent * n)
    rows = rows[np.argsort(n[rows], kind="stable")]
    if len(rows) < 2:
        return [], counts
    n, side = n[rows], side[rows]
    parts = [codes[starts[i]:starts[i + 1]][common[starts[i]:starts[i + 1]]] for i in rows]
    codes, starts = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    last = np.searchsorted(percent * n, 100 * n, side="right")  # larger sets of a size to link with
    first: dict[int, int] = {}
    parent = list(range(len(rows)))
    for i, at in enumerate(rows.tolist()):
        for name in (int(nodes[at]), int(known[at])):
            parent[_find(parent, i)] = _find(parent, first.setdefault(name, i))
    links = []
    own = np.zeros(len(uses), np.uint8)
    two_sided = (side != side[0]).any()
    for i in range(len(rows) - 1):
        end = int(last[i])
        if end <= i + 1:
            continue
        own[parts[i]] = 1
        both = np.add.reduceat(own[codes[starts[i + 1]:starts[end]]], starts[i + 1:end] - starts[i + 1], dtype=np.int64)
        own[parts[i]] = 0
        linked = 100 * both >= percent * (n[i] + n[i + 1:end] - both)
        if two_sided:
            linked &= side[i + 1:end] != side[i]
        met = np.flatnonzero(linked) + i + 1
        counts[rows[i]] += copies[rows[met]].sum()
        counts[rows[met]] += copies[rows[i]]
        for j in met.tolist():
            a, b = _find(parent, i), _find(parent, j)
            if a != b:
                parent[a] = b
                links.append((int(nodes[rows[i]]), int(nodes[rows[j]])))
    return links, np.where(home, counts, 0)


def join_regions(regions: DataFrame, percent: int, width: int = SHINGLE_WORDS) -> DataFrame:
    """Bounded regions ``(region, node, known, home, copies, side, shingles)``, each joined within one task: rows ``(src, dst, null)`` are
    links, ``(src, null, n_links)`` a node's number of links. With ``text`` instead of ``shingles`` the task makes the sets."""
    last_column = "text" if "text" in regions.columns else "shingles"

    def compute(batches):
        words = WordHashes()

        def joined(rows: pa.Table):
            ids, place = np.unique(rows.column("region").to_numpy(zero_copy_only=False), return_inverse=True)
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(len(ids) + 1))
            shingles = rows.column("shingles").combine_chunks()
            at, values = shingles.offsets.to_numpy(), shingles.values.to_numpy()
            columns = [rows.column(c).to_numpy(zero_copy_only=False) for c in ("node", "known", "home", "copies", "side")]
            found: list[tuple[int, int | None, int | None]] = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = order[a:b]
                if b - a > 1:
                    links, counts = region_links(*(c[own] for c in columns), [values[at[i]:at[i + 1]] for i in own], percent)
                    found += [(src, dst, None) for src, dst in links]
                    found += [(int(columns[0][own[i]]), None, int(counts[i])) for i in np.flatnonzero(counts)]
            src, dst, n_links = zip(*found, strict=True) if found else ((), (), ())
            return pa.record_batch([pa.array(src, pa.int64()), pa.array(dst, pa.int64()), pa.array(n_links, pa.int64())],
                                   names=["src", "dst", "n_links"])

        kept = None  # the last region of a batch may go on in the next
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = _with_sets(rows, words, width) if last_column == "text" else rows
            rows = rows if kept is None else pa.concat_tables([kept, rows])
            last = rows.column("region").to_numpy(zero_copy_only=False)
            cut = int(np.flatnonzero(last != last[-1])[-1]) + 1 if len(last) and (last != last[-1]).any() else 0
            if cut:
                yield joined(rows.slice(0, cut).combine_chunks())
            kept = rows.slice(cut).combine_chunks() if len(last) else None
        if kept is not None and kept.num_rows:
            yield joined(kept)

    spark = regions.sparkSession
    return (regions.select("region", "node", "known", "home", "copies", "side", last_column)
            .repartition(shuffle_partitions(spark), "region").sortWithinPartitions("region")
            .mapInArrow(tidy(compute), "src long, dst long, n_links long"))


def _sized(regions: DataFrame) -> DataFrame:
    """``regions (region, node, n, home, …)`` with ``size``, ``n_home`` and ``small``; regions that are no node's home are finished."""
    sizes = (regions.groupBy("region")
             .agg(F.count(F.lit(1)).alias("size"), F.sum(F.col("home").cast("long")).alias("n_home"), F.sum("n").alias("weight"))
             .where((F.col("n_home") > 0) & (F.col("size") > 1))
             .withColumn("small", (F.col("size") <= LEAF_NODES) & ((F.col("weight") <= LEAF_SHINGLES) | (F.col("size") == 2))))
    return regions.join(sizes.drop("weight"), "region")


def to_pivots(large: DataFrame, level: int, percent: int) -> DataFrame:
    """Each node of the large regions with its region's ``pivots`` (their nodes), its distances to them (``far``), and
    the first one in whose ball it is (``ball``, or null)."""
    draw = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(1 << 30))
    drawn = large.where(F.col("home") & (draw * F.col("n_home") < F.lit(4 * PIVOTS << 30)))
    rank = F.row_number().over(Window.partitionBy("region").orderBy(draw, "node"))
    copies = F.ceil(F.col("size") / SALT_NODES).cast("int")
    apart = f"""filter(pivots, (p, i) -> not exists(slice(pivots, 1, i), q ->
        {100 + percent} * size(array_intersect(p.shingles, q.shingles)) >= {percent} * (p.n + q.n)))"""
    pivots = (drawn.withColumn("k", rank).where(F.col("k") <= PIVOTS).groupBy("region", "size")
              .agg(F.array_sort(F.collect_list(F.struct("k", "node", "n", "shingles"))).alias("pivots"))
              .select("region", F.expr(apart).alias("pivots"), F.explode(F.sequence(F.lit(0), copies - 1)).alias("salt")))
    salted = large.withColumn("salt", F.pmod(F.xxhash64("node", F.lit(-1)), copies).cast("int"))
    met = (salted.join(pivots, ["region", "salt"])
           .withColumn("both", F.expr("transform(pivots, p -> size(array_intersect(shingles, p.shingles)))")))
    union = "(n + pivots[i].n - c)"
    return (met.withColumn("far", F.expr(f"transform(both, (c, i) -> 1 - c / {union})"))
            .withColumn("near", F.expr(f"transform(both, (c, i) -> 100 * c >= {percent} * {union})"))
            .withColumn("pivots", F.expr("transform(pivots, p -> p.node)"))
            .withColumn("ball", F.expr("get(pivots, cast(array_position(near, true) as int) - 1)")).drop("both", "near", "salt"))


def region_rows(regions: DataFrame, percent: int) -> DataFrame:
    """The rows of :func:`join_regions` for ``regions (region string, node, n, known, home, copies, shingles)`` of any size: links whose
    closure is that of all pairs at the given likeness, and parts of the nodes' numbers of links."""
    return _sized_rows(materialize(_sized(regions), "jaccard-regions"), percent)


def text_region_rows(docs: DataFrame, regions: DataFrame, width: int, percent: int) -> DataFrame:
    """:func:`region_rows` for ``regions (region string, node, n, known, home, copies, text_sha, rep_id)`` without their sets."""
    sized = materialize(_sized(regions), "jaccard-sized")
    found = materialize(join_regions(node_texts(docs, sized.where("small")).withColumn("side", F.lit(0)), percent, width), "jaccard-links")
    large = sized.where(~F.col("small"))
    if large.isEmpty():
        return found
    return found.unionByName(_sized_rows(materialize(node_sets(node_texts(docs, large), width), "jaccard-regions"), percent))


def _sized_rows(todo: DataFrame, percent: int) -> DataFrame:
    radius = 1 - percent / 100
    found = []
    columns = ["region", "node", "n", "known", "home", "copies", "shingles"]

    def leaves(df: DataFrame) -> None:
        found.append(materialize(join_regions(df.withColumn("side", F.lit(0)), percent), "jaccard-links"))

    def blocks(df: DataFrame) -> None:
        own = F.pmod(F.xxhash64("node", F.lit("a")), F.col("groups")).cast("int")
        met = (df.withColumn("groups", F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("int")).withColumn("side", own)
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))))
        block = F.concat_ws("/", "region", F.least("side", "other"), F.greatest("side", "other"))
        found.append(materialize(join_regions(met.withColumn("region", block), percent), "jaccard-links"))

    leaves(todo.where("small"))
    for level in range(LEVELS):
        large = todo.where(~F.col("small"))
        if large.isEmpty():
            break
        met = materialize(to_pivots(large, level, percent), "jaccard-pivots")
        found.append(met.where("ball != node").select(F.col("node").alias("src"), F.col("ball").alias("dst"), F.lit(None).cast("long").alias("n_links")))
        cells = (met.withColumn("known", F.coalesce("ball", "known")).withColumn("near", F.array_min("far"))
                 .withColumn("own", F.expr("cast(array_position(far, near) as int) - 1"))
                 .withColumn("cells", F.expr(f"filter(sequence(0, size(far) - 1), i -> far[i] <= near + {2 * radius + 1e-9})"))
                 .drop("size", "n_home", "small"))
        # a region divides if its nodes are seldom copied and its cells have much fewer pairs than it has
        spread = (cells.select("region", "n", "home", "own", F.size("cells").alias("copied"), F.explode("cells").alias("cell"))
                  .groupBy("region", "cell").agg(F.count(F.lit(1)).alias("size"), F.sum((F.col("own") == F.col("cell")).cast("long")).alias("owned"),
                                                 F.sum(F.when(F.col("own") == F.col("cell"), F.col("n"))).alias("weight"))
                  .groupBy("region").agg(F.sum("size").alias("all"), F.sum("owned").alias("nodes"), F.sum("weight").alias("weight"),
                                         F.sum(F.col("size").cast("double") * F.col("owned")).alias("work"))
                  .withColumn("divides", (F.col("all") <= F.col("nodes") * F.lit(COPIES if level < LEVELS - 1 else 0))
                              & (F.col("work") <= PART_OF_PAIRS * F.col("nodes").cast("double") * F.col("nodes"))))
        known = cells.join(spread.select("region", "weight", "divides"), "region")
        blocks(known.where(~F.col("divides")))
        divided = (known.where("divides").withColumn("cell", F.explode("cells")).withColumn("home", F.col("home") & (F.col("own") == F.col("cell")))
                   .withColumn("region", F.concat_ws("/", "region", "cell")))
        todo = materialize(_sized(divided.select(*columns)), "jaccard-regions")
        leaves(todo.where("small"))
    return reduce(DataFrame.unionByName, found)


def region_join(regions: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links ``(src, dst)`` within ``regions (region string, node, n, shingles)`` whose closure is that of all pairs
    at the given likeness."""
    rows = regions.select("region", "node", "n", F.col("node").alias("known"), F.lit(True).alias("home"), F.lit(1).cast("long").alias("copies"), "shingles")
    return region_rows(rows, percent).where("dst is not null").select("src", "dst").distinct()


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_links)``: one row per input row.

    ``component_id`` is the smallest id reachable over links (``100 * |A & B| >= percent * |A | B|``), the row's own included;
    ``n_links`` counts the other rows that the row links with, copies of its own set among them. Null and empty texts have
    the empty set and link with nothing, not even with each other. A row with a null id gets a class like the others (null only if
    the whole class has no id). Repeated rows come out as often as they came in. An empty table gives an empty
    result; other columns are ignored.
    """
    docs = id_table(df, id_col, text_col)
    heads = materialize(shingle_heads(docs, shingle_ranks(docs, width), width, percent).withColumn("row", F.monotonically_increasing_id()), "jaccard-heads")
    nodes = materialize(heads.where("n > 0").groupBy("digest", "n")
                        .agg(F.min("row").alias("node"), F.min_by("doc_id", "row").alias("rep_id"), F.min_by("text_sha", "row").alias("text_sha"),
                             F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("last_rank").alias("last_rank"), F.first("last").alias("last")), "jaccard-nodes")
    regions = (connected_components(materialize(near_nodes(heads, nodes, percent), "jaccard-near"))
               .select("node", F.col("component").cast("string").alias("region")))
    placed = nodes.join(regions, "node").select("region", "node", "n", F.col("node").alias("known"), F.lit(True).alias("home"), "copies", "text_sha", "rep_id")
    found = materialize(text_region_rows(docs, materialize(placed, "jaccard-placed"), width, percent), "jaccard-found")
    linked = connected_components(found.where("dst is not null").select("src", "dst")).join(nodes, "node")
    smallest = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    met = found.where("n_links is not null").groupBy(F.col("src").alias("node")).agg(F.sum("n_links").alias("met"))
    known = (nodes.join(linked.join(smallest, "component").select("node", "component_id"), "node", "left").join(met, "node", "left")
             .select(F.col("digest").alias("found"), F.coalesce("component_id", "first_id").alias("component_id"),
                     (F.col("copies") - 1 + F.coalesce("met", F.lit(0))).alias("n_links")))
    rows = heads.select("doc_id", F.col("n").alias("n_shingles"), "digest")
    full = rows.where("digest is not null").join(known, F.col("digest") == F.col("found")).drop("digest", "found")
    empty = rows.where("digest is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return full.unionByName(empty)
