"""Connected components of an edge table by alternating large-star and small-star steps.

Both steps use grouped minima and equi-joins only, so a hub with a third of all edges
is aggregated before it is shuffled and its join can be split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _stars(e: DataFrame) -> bool:
    """Whether every node is a centre or hangs on one centre only."""
    ends = e.select(F.col("a").alias("u"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(e.select(F.col("b").alias("u"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    return ends.groupBy("u").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs > 1 or (hangs > 0 and holds > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` in any direction -> ``(node, label)``, label the smallest node reachable.

    Only nodes that have an edge to another node are returned. Null ends and loops are ignored.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _stars(e):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, both["a"] == least["u"]).where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(low, large["a"] == low["u"]).select("a", "b", "m")
        e = cut(small.select("a", F.col("m").alias("b")).union(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).union(e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
