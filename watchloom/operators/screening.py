"""Tiered name screening, single or in bulk, as one distributed plan.

Tier 1 is equality without case, tier 2 contains (queries of three characters or more), tier 3 word-trigram
similarity. Names that can match a query share one of a few of its keys with it: the whole name for equality, the rarest of its
trigrams for contains, as many of the rarest as the threshold asks for for similarity. So all tiers are equi-joins on
(key, id), whatever the number of queries, and names are fetched for candidates only. Up to ``MAX_QUERIES`` queries are broadcast, and then names' keys aren't
shuffled before they match. ``gram_index`` keeps the keys on disk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import inner_trigrams, jaccard, word_trigrams
from ..shared import cut
from .rules import level, overall
from .similarity_join import prefix_length, similarity_join

MAX_QUERIES = 1000


def name_keys(name: Column) -> Column:
    """What a name can be found by: its word trigrams (w), inner trigrams (i) and all of it (e), in lower case."""
    low = F.lower(name)
    tagged = lambda kind, grams: F.transform(grams, lambda g: F.concat(F.lit(kind), g))
    return F.concat(tagged("w", word_trigrams(name)), tagged("i", inner_trigrams(low)), F.array(F.concat(F.lit("e"), low)))


def asked(queries: DataFrame) -> DataFrame:
    """``(q_id, ql, qg, gram)``: the keys of queries of two characters or more."""
    q = queries.select("q_id", F.trim("query").alias("query")).where(F.length("query") >= 2)
    return q.select("q_id", F.lower("query").alias("ql"), word_trigrams(F.col("query")).alias("qg"), F.explode(name_keys(F.col("query"))).alias("gram"))


def most_keys(threshold: float) -> Column:
    """How many of the rarest keys of its kind suffice to find all matches."""
    return F.when(F.col("gram").startswith("w"), prefix_length(F.size("qg"), threshold)).otherwise(1)


def rarest(keys: DataFrame, counts: DataFrame, threshold: float) -> DataFrame:
    """The keys that suffice: ``keys`` of :func:`asked`, ``counts(gram, k)`` where a key occurs at all."""
    kind = F.substring("gram", 1, 1)
    place = F.row_number().over(Window.partitionBy("q_id", kind).orderBy(F.coalesce("k", F.lit(0)), "gram"))
    return keys.join(counts, "gram", "left").withColumn("place", place).where(F.col("place") <= most_keys(threshold)).select("q_id", "ql", "qg", "gram")


def dealt(pairs: DataFrame) -> DataFrame:
    """Candidates are few bytes and much work: dealt over all tasks, which adaptive execution then leaves so."""
    return pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")


def ranked(pairs: DataFrame, threshold: float, limit: int) -> DataFrame:
    """The matches among candidates ``(q_id, ql, qg, id, name, source_id)``, the best ``limit`` of each query."""
    low = F.lower("name")
    sim = F.when(low == F.col("ql"), 1.0).otherwise(jaccard(F.col("qg"), word_trigrams(F.col("name"))))
    tier = F.when(low == F.col("ql"), 1).when((F.length("ql") >= 3) & low.contains(F.col("ql")), 2).when(F.col("sim") >= threshold, 3)
    found = pairs.withColumn("sim", sim).withColumn("tier", tier).where("tier is not null").drop("qg")
    order = Window.partitionBy("q_id").orderBy("tier", F.desc(F.round("sim", 6)), F.length("name"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit).select("q_id", "id", "name", "source_id", "tier", "sim", "rank")


def screen(queries: DataFrame, names: DataFrame, threshold: float = 0.3, limit: int = 10) -> DataFrame:
    """``queries(q_id, query)`` x ``names(id, name, source_id)`` -> the best ``limit`` matches of each query.

    A match has the tier that finds it first. Within a tier: similarity, then shorter names, then id.
    """
    small = len(queries.select("q_id").take(MAX_QUERIES + 1)) <= MAX_QUERIES

    def few(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    wanted = asked(queries)
    n = names.where(F.col("name").isNotNull())
    posted = n.select("id", F.explode(F.array_distinct(name_keys(F.col("name")))).alias("gram"))
    hits = cut(posted.join(few(wanted.select("gram").distinct()), "gram", "left_semi"))
    keys = rarest(wanted, hits.groupBy("gram").agg(F.count("*").alias("k")), threshold)
    pairs = hits.join(few(keys), "gram").groupBy("q_id", "id").agg(F.first("ql").alias("ql"), F.first("qg").alias("qg"))
    return ranked(dealt(pairs).join(n.select("id", "name", "source_id"), "id"), threshold, limit)


def containing(queries: DataFrame, names: DataFrame) -> DataFrame:
    """``(q_id, name)``: the different names that hold a query, without case, by the rarest inner trigram of each query.

    Queries of under three characters have none and are compared with every name.
    """
    n = names.where("name is not null").select("name", F.lower("name").alias("nl")).distinct()
    q = queries.select("q_id", F.lower("query").alias("ql"))
    keys = q.select("q_id", "ql", F.explode(inner_trigrams(F.col("ql"))).alias("gram"))
    hits = n.select("name", "nl", F.explode(inner_trigrams(F.col("nl"))).alias("gram")).join(keys.select("gram").distinct(), "gram", "left_semi")
    counts = hits.groupBy("gram").agg(F.count("*").alias("k"))
    one = keys.join(counts, "gram", "left").groupBy("q_id", "ql").agg(F.min_by("gram", F.struct(F.coalesce("k", F.lit(0)), "gram")).alias("gram"))
    found = hits.join(one, "gram").where(F.col("nl").contains(F.col("ql"))).select("q_id", "name")
    short = q.where(F.length("ql") < 3)
    if short.isEmpty():
        return found
    return found.unionByName(n.join(F.broadcast(short) if short.count() <= MAX_QUERIES else short, F.col("nl").contains(F.col("ql"))).select("q_id", "name"))


def similar(queries: DataFrame, names: DataFrame, threshold: float) -> DataFrame:
    """``(q_id, id, name, source_id, tier, sim)``: word-trigram similarity over different texts, joined back to the names."""
    left = queries.select(F.col("q_id").alias("id"), word_trigrams(F.col("query")).alias("g"))
    right = names.select(F.lower("name").alias("id")).distinct().select("id", word_trigrams(F.col("id")).alias("g"))
    hits = similarity_join(left, right, threshold)
    return names.join(hits, F.lower("name") == F.col("b")).select(F.col("a").alias("q_id"), "id", "name", "source_id", F.lit(3).alias("tier"), "sim")


def report(queries: DataFrame, matches: DataFrame, other: DataFrame) -> DataFrame:
    """Each query's overall level; ``other(q_id, hits)`` counts hits outside the lists."""
    m = matches.groupBy("q_id").agg(F.count("*").alias("matches"), F.collect_set(level(F.col("source_id"))).alias("levels"))
    j = queries.join(m, "q_id", "left").join(other, "q_id", "left")
    got = overall(F.coalesce("levels", F.array().cast("array<string>")), F.coalesce("matches", F.lit(0)) > 0, F.coalesce("hits", F.lit(0)) > 0)
    return j.select("q_id", "query", F.coalesce("matches", F.lit(0)).alias("matches"), F.coalesce("hits", F.lit(0)).alias("hits"), got.alias("level"))
