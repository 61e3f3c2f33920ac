"""Set-similarity joins by prefix filtering.

Each set's members are ordered by how rare they are over both sides. Two sets of a Jaccard similarity of ``t`` or
more share a member among the first ``n - ceil(t * n) + 1`` of either, so that only these prefixes are joined. A
common member is in a prefix only where a set has nothing rarer, and never pairs everything with everything. A pair
is taken at its first common prefix member, checked on the whole sets, and needs no deduplication.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import jaccard


def prefix_length(size: Column, threshold: float) -> Column:
    return (size - F.ceil(size * threshold - 1e-9) + 1).cast("int")


def rarest_first(sets: DataFrame, counts: DataFrame) -> DataFrame:
    """``sets(id, g)`` with members in order of ``counts(gram, k)``, those that aren't there first."""
    rows = sets.select("id", F.explode("g").alias("gram")).join(counts, "gram", "left")
    ranked = F.sort_array(F.collect_list(F.struct(F.coalesce("k", F.lit(0)).alias("k"), "gram")))
    return rows.groupBy("id").agg(F.transform(ranked, lambda x: x["gram"]).alias("g"))


def similarity_join(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """``left(id, g)`` x ``right(id, g)`` of distinct members -> ``(a, b, sim)`` with a similarity of ``threshold`` or more.

    Empty sets link with nothing.
    """
    counts = left.select(F.explode("g").alias("gram")).union(right.select(F.explode("g").alias("gram"))).groupBy("gram").agg(F.count("*").alias("k"))

    def side(sets: DataFrame, name: str) -> DataFrame:
        s = rarest_first(sets, counts).withColumn("p", F.slice("g", F.lit(1), prefix_length(F.size("g"), threshold)))
        return s.select(F.col("id").alias(name), F.col("g").alias(f"g{name}"), F.col("p").alias(f"p{name}"), F.explode("p").alias("gram"))

    n, m = F.size("ga"), F.size("gb")
    j = side(left, "a").join(side(right, "b"), "gram").where((n >= m * threshold - 1e-9) & (m >= n * threshold - 1e-9))
    j = j.where(F.get(F.array_intersect("pa", "pb"), F.lit(0)) == F.col("gram"))
    return j.select("a", "b", jaccard(F.col("ga"), F.col("gb")).alias("sim")).where(F.col("sim") >= threshold)
