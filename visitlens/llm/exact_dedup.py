"""Exact duplicates by a heavy-hitter split, in DataFrame operations only.

1. Misra-Gries sketches (``approx_top_k``), one for each of ``SKETCHES`` groups of input partitions, name the
   digests that may be frequent; each holds ``TRACKED`` digests at once and cannot lose one that has more
   than 1 / (0.75 * TRACKED) of its rows. Their counts are summed and the first ``TOP_K`` are taken.
2. The named digests are counted exactly. Those with at least ``MIN_SHARE`` of the rows win; a winner's
   largest id and its count are broadcast (``TOP_K`` rows at most).
3. Map side: rows of a winning digest with a smaller id are finished on the spot and are never shuffled.
4. What remains (a row for each winner, and every other digest) is ordinarily shuffled by digest.

A digest that the sketch misses only takes the ordinary way, so the result never depends on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, text_or_empty, with_may_hold

TOP_K = 256
TRACKED = 8192
MIN_SHARE = 1 / 4096
#: Sketches whose first ``TOP_K`` digests meet, whatever the number of input partitions.
SKETCHES = 64


def heavy_digests(rows: DataFrame) -> DataFrame:
    """``(digest, top_id, size)`` of the frequent digests of ``rows(doc_id, digest)``: ``TOP_K`` rows at most."""
    parts = (rows.groupBy((F.spark_partition_id() % SKETCHES).alias("part"))
             .agg(F.expr(f"approx_top_k(digest, {TOP_K}, {TRACKED})").alias("top")))
    named = (parts.select(F.explode("top").alias("t")).groupBy(F.col("t.item").alias("digest")).agg(F.sum("t.count").alias("n"))
             .where(F.col("digest").isNotNull()).orderBy(F.desc("n"), "digest").limit(TOP_K).select("digest"))
    counted = (rows.join(F.broadcast(named), "digest", "left_semi").groupBy("digest")
               .agg(F.max("doc_id").alias("top_id"), F.count(F.lit(1)).alias("size")))
    least = rows.agg((F.count(F.lit(1)) * MIN_SHARE).alias("least")).scalar()
    return counted.where((F.col("size") >= least) & F.col("top_id").isNotNull() & (F.col("size") > 1))


def mark_duplicates(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """``rows`` (``doc_id, digest`` and any others) with ``keep_id, group_size, kept``."""
    winners = F.broadcast(heavy.select(F.col("digest").alias("__digest"), F.col("top_id").alias("__top"),
                                       F.col("size").alias("__size")))
    met = rows.join(winners, F.col("digest") == F.col("__digest"), "left").drop("__digest")
    beaten = F.col("__top").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("__top"))
    finished = met.where(beaten).select(*rows.columns, F.col("__top").alias("keep_id"),
                                        F.col("__size").alias("group_size"), F.lit(False).alias("kept"))
    # Largest id first; repeated rows tie and exactly one of them is kept.
    group = Window.partitionBy("digest").orderBy(F.col("doc_id").desc_nulls_last())
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = (met.where(~beaten)
            .withColumn("keep_id", F.coalesce("__top", F.max("doc_id").over(whole)))
            .withColumn("group_size", F.coalesce("__size", F.count(F.lit(1)).over(whole)))
            .withColumn("kept", F.row_number().over(group) == 1)
            .select(*rows.columns, "keep_id", "group_size", "kept"))
    return finished.unionByName(rest)


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.sha2(text_or_empty(text_col), 256).alias("digest"))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``: one row per input row.

    A null text counts as empty. Of equal texts the row with the largest id is kept; null ids come last,
    and of rows repeated with the same id one is kept. ``keep_id`` is null only where no copy has an id. An empty
    table gives an empty result; other columns are ignored. Texts are read once.
    """
    rows = materialize(digests(df, id_col, text_col), "digests")
    heavy = materialize(heavy_digests(rows), "heavy-digests")
    return mark_duplicates(rows, heavy).select("doc_id", "keep_id", "group_size", "kept",
                                               F.col("digest").alias("text_sha256"))


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one row per distinct text, all columns kept. The duplicates are marked on narrow rows of (digest, id). Whole rows
    are shuffled to the losers' list only if they may be losers (and few more). Of rows that repeat the kept row's id and text one is kept."""
    rows = materialize(digests(df, id_col, text_col), "digests")
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                      F.sha2(text_or_empty(text_col), 256).alias("digest"))
    heavy = materialize(heavy_digests(rows), "heavy-digests")
    marked = mark_duplicates(rows, heavy)
    # losers by (digest, id); ``one_stays`` where the kept row has that id too
    lost = materialize(marked.groupBy("digest", "doc_id").agg(F.sum((~F.col("kept")).cast("long")).alias("losers"), F.max("kept").alias("one_stays"))
                       .where("losers > 0").select(F.xxhash64("digest", "doc_id").alias("key"), F.col("digest").alias("d"), F.col("doc_id").alias("i"), "one_stays"),
                       "exact-losers")
    keyed = with_may_hold(keyed, lost, "key", F.xxhash64("digest", "doc_id"), "suspect")
    same = (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("i"))
    met = keyed.where("suspect").join(lost.drop("key").hint("merge"), same, "left")
    first = F.row_number().over(Window.partitionBy("digest", "doc_id").orderBy("digest"))
    repeated = met.where("one_stays").withColumn("place", first).where("place = 1")  # rows equal in id and text
    return (keyed.where("not suspect").select("row.*")
            .union(met.where("d is null").select("row.*")).union(repeated.select("row.*")))
