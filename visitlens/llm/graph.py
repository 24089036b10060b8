"""Connected components of a link table, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _star(pairs: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Each node's neighbours, linked to the smallest node of its neighbourhood."""
    smallest = neighbours.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.join(smallest, "u")


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``links(src, dst long)``; a
    component's name is its smallest node.

    Alternating large-star and small-star rounds: the number of rounds grows with the
    logarithm of the longest path, and the links are rewritten, never multiplied. Each round is written to the
    shared folder, which cuts the lineage. Only a round's checksum reaches the driver. A hub's
    minimum is combined before the shuffle and its links are split by the skew join.
    """
    def summary(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    edges = materialize(links.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
                        .where(F.col("u") != F.col("v")).distinct(), "components")
    before = summary(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_star(both, both).where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct())
        # every link now points from a node to a smaller one
        joined = _star(large, large)
        small = (joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                 F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct())
        edges = materialize(small, "components")
        after = summary(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
