"""SimHash near-duplicates by a segment-popcount embedding and a grid range join.

1. A text's fingerprint is the 64-bit SimHash of its word shingles
   (:func:`fingerprints`), computed once per row and written to the shared folder.
2. Distinct fingerprints are embedded as vectors of bit counts, one per
   4-bit segment. A flipped bit changes one count by one, so the Manhattan distance of
   two vectors is a lower bound of the Hamming distance of their fingerprints.
3. Grid range join: every fingerprint is sent to its own grid cell and to the
   cells one step away. Two vectors at Manhattan distance <= 2 always have a
   cell in common (a point half way), so rows alone in a cell are finished.
4. Exact check: in each shared cell a fingerprint names the bit patterns in
   that cell that differ from it by at most one bit. Two fingerprints differ
   by at most 2 bits exactly when some such pattern is named by both. Each pattern links
   its fingerprints to the smallest of them, and the link is checked with a bit count.
5. The links' connected components give each document its class.

Work is linear in the number of distinct fingerprints (at most 33 grid rows and
65 patterns each), also inside a dense group of near copies: a pattern
is named by at most 65 fingerprints, and pairs are never enumerated. Equal texts, and a
fingerprint that holds a third of all rows, are reduced to one row before the grid.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import id_table, materialize, may_hold, text_or_empty, tidy
from .graph import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
#: The step between grid cells is one count, which covers a Hamming distance of 2.
SEGMENT_BITS = 4
BLOCK = 1 << 15


def simhash(text: str, shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text's word shingles, as an unsigned number.

    A-Z are lower-cased; words are runs of anything but space, tab, line feed,
    vertical tab, form feed and carriage return (what ``bytes.split`` does).
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    ends = ends[shingle - 1:] or ends[-1:]
    ones, n = np.zeros(64, np.int64), len(ends)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n, BLOCK):
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[lo:lo + BLOCK], ends[lo:lo + BLOCK], strict=False)),
                             np.uint64, count=min(BLOCK, n - lo))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp long)``: one row per input row; a null text counts as empty (fingerprint 0)."""

    def compute(batches):
        for batch in batches:
            found = [simhash(t, shingle) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))],
                                  names=["doc_id", "fp"])

    return id_table(df, id_col, text_col).mapInArrow(tidy(compute), "doc_id long, fp long")


def segment_counts(fp: Column) -> Column:
    """Bit counts of the sixteen 4-bit segments, packed in the 4-bit lanes of a long."""
    ones = F.lit(0x1111111111111111)
    return reduce(add, [fp.bitwiseAND(ones)] + [F.shiftrightunsigned(fp, k).bitwiseAND(ones) for k in (1, 2, 3)])


def near_links(prints: DataFrame) -> DataFrame:
    """Links ``(src, dst)`` between distinct fingerprints (column ``fp``, one row each)
    whose closure equals that of all pairs at 2 or fewer differing bits."""
    lanes = range(0, 64, SEGMENT_BITS)
    at = F.col("counts")
    moves = [at]
    for s in lanes:
        lane = F.shiftrightunsigned(at, s).bitwiseAND(F.lit(15))
        moves += [F.when(lane < SEGMENT_BITS, at + F.lit(1 << s)),
                  F.when(lane > 0, at - F.lit(1 << s))]
    grid = (prints.select("fp", segment_counts(F.col("fp")).alias("counts"))
            .select("fp", F.explode(F.array(*moves)).alias("cell")).where(F.col("cell").isNotNull()))
    # Only the two neighbours in the sorted cell are looked at, so a cell of any size streams through.
    here = Window.partitionBy("cell").orderBy("fp")
    shared = (grid.withColumn("other", F.coalesce(F.lag("fp").over(here), F.lead("fp").over(here)))
              .where(F.col("other").isNotNull()).select("cell", "fp"))
    # ``step`` is 0, or plus or minus 1 in one lane that begins at bit ``place``.
    placed = (shared.withColumn("step", F.col("cell") - segment_counts(F.col("fp")))
              .withColumn("place", F.expr("cast(bit_count(abs(step) - 1) as int)")))
    named = [F.when(F.col("step") == 0, F.col("fp"))]
    for j in range(SEGMENT_BITS):
        bit = F.expr(f"shiftleft(1L, place + {j})")
        is_set = F.col("fp").bitwiseAND(bit) != 0
        named.append(F.when((F.col("step") != 0) & (is_set == (F.col("step") < 0)), F.col("fp").bitwiseXOR(bit)))
    patterns = (placed.select("fp", F.explode(F.array(*named)).alias("pattern"))
                .where(F.col("pattern").isNotNull()))
    hub = F.min("fp").over(Window.partitionBy("pattern"))  # 65 rows at most
    return (patterns.withColumn("hub", hub)
            .where((F.col("hub") != F.col("fp")) & (F.bit_count(F.col("hub").bitwiseXOR(F.col("fp"))) <= MAX_BITS))
            .select(F.col("fp").alias("src"), F.col("hub").alias("dst")).distinct())


def simhash_near_dups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fingerprint, component_id, n_links)``: one row per input row.

    ``component_id`` is the smallest id reachable over links of 2 or fewer
    differing bits; ``n_links`` counts links recorded for the row's fingerprint.
    Null and empty texts have fingerprint zero and link like any other. Rows
    with a null id get a class like the others (null only if the whole class has no id).
    Repeated rows come out as often as they came in. An empty table gives an
    empty result; other columns are ignored.
    """
    prints = materialize(fingerprints(df, id_col, text_col, shingle), "simhash")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    links = materialize(near_links(nodes.select("fp")), "simhash-links")
    labels = connected_components(links).withColumnsRenamed({"node": "fp"})
    linked = labels.join(nodes, "fp")
    smallest = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = linked.join(smallest, "component").select("fp", "component_id")
    degree = (links.select(F.explode(F.array("src", "dst")).alias("fp")).groupBy("fp")
              .agg(F.count(F.lit(1)).alias("n_links")))
    known = (nodes.join(classes, "fp", "left").join(degree, "fp", "left")
             .select("fp", F.coalesce("component_id", "first_id").alias("component_id"),
                     F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return prints.join(known, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_links")


def drop_near_dups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` without the rows whose class has a smaller id (all columns kept, whatever their names).
    Rows with a null id stay. Only rows whose id may be a loser's are shuffled; of rows that share an id, those go whose
    fingerprint is the loser's."""
    marked = simhash_near_dups(df, id_col, text_col, shingle)
    lost = materialize(marked.where(F.col("doc_id") != F.col("component_id"))
                       .select(F.col("doc_id").alias("lost_id"), F.col("fingerprint").alias("lost_print")).distinct(), "near-dups")
    suspect = may_hold(lost, "lost_id")(F.col(id_col).cast("long"))

    @F.arrow_udf("string")
    def fingerprint(text: pa.Array) -> pa.Array:
        return pa.array([f"{simhash(t, shingle):016x}" for t in text.to_pylist()], pa.string())

    rows = df.where(suspect).select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).cast("long").alias("id"),
                                    fingerprint(text_or_empty(text_col)).alias("print"))
    kept = rows.join(lost.hint("merge"), (F.col("id") == F.col("lost_id")) & (F.col("print") == F.col("lost_print")), "left_anti")
    return df.where(F.coalesce(~suspect, F.lit(True))).unionByName(kept.select("row.*"))
