"""Entity groups, links between sources, and fuzzy clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import jaccard, sequence_ratio, subset, text_trigrams, word_trigrams
from ..functions.text import entity_key, group_key, token_bag
from ..functions.values import stable_id
from ..shared import numbered, shared_dir
from .rules import interesting_name
from .similarity_join import rarest_first, similarity_join


def groups(names: DataFrame, least_sources: int = 2) -> DataFrame:
    """Names that occur in several sources: one aggregation on the key, no join."""
    n = names.where(interesting_name(F.col("name"))).withColumn("key", group_key(F.col("name")))
    g = n.groupBy("key").agg(F.min_by("name", "id").alias("canonical_name"), F.count("*").alias("num_records"), F.countDistinct("source_id").alias("num_sources"), F.array_sort(F.collect_set("source_id")).alias("sources"))
    return g.where(F.col("num_sources") >= least_sources).withColumn("group_id", stable_id(F.col("key")))


def anchors(names: DataFrame) -> DataFrame:
    """The first record of each key and source, and the first of each key."""
    n = names.where(interesting_name(F.col("name"))).withColumn("key", group_key(F.col("name")))
    return n.groupBy("key", "source_id").agg(F.min_by(F.struct("id", "name"), "id").alias("r")).select("key", "source_id", "r.id", "r.name")


def links(names: DataFrame) -> DataFrame:
    """A star of links for each group: its first record to the first of every other source."""
    rep = anchors(names)
    first = rep.groupBy("key").agg(F.min_by(F.struct("id", "name", "source_id"), "id").alias("a"), F.count("*").alias("sources")).where("sources > 1")
    j = rep.join(first, "key").where(F.col("source_id") != F.col("a.source_id"))
    return j.select("key", F.col("a.id").alias("id_a"), F.col("id").alias("id_b"), F.col("a.source_id").alias("source_a"), F.col("source_id").alias("source_b"))


def fuzzy_links(group: DataFrame, names: DataFrame, threshold: float, per_group: int | None = None) -> DataFrame:
    """Records of sources that a group hasn't got whose names are similar to its own: the best a group and source."""
    left = group.select(F.col("key").alias("id"), word_trigrams(F.col("key")).alias("g"))
    texts = names.where(F.length(F.trim("name")) > 4).select(group_key(F.col("name")).alias("id")).distinct().select("id", word_trigrams(F.col("id")).alias("g"))
    hits = similarity_join(left, texts, threshold).where((F.col("sim") > threshold) & (F.col("a") != F.col("b"))).select(F.col("a").alias("key"), F.col("b").alias("t"), "sim")
    j = names.withColumn("t", group_key(F.col("name"))).join(hits, "t").join(group.select("key", "sources"), "key").where(~F.array_contains("sources", F.col("source_id")))
    if per_group is not None:
        top = Window.partitionBy("key").orderBy(F.desc(F.round("sim", 9)), "id")
        j = j.withColumn("place", F.row_number().over(top)).where(F.col("place") <= per_group)
    best = Window.partitionBy("key", "source_id").orderBy(F.desc(F.round("sim", 9)), "id")
    return j.withColumn("r", F.row_number().over(best)).where("r = 1").select("key", "id", "source_id", "sim")


def blocked_pairs(names: DataFrame, prefix: int = 3, block_cap: int | None = None) -> DataFrame:
    """Pairs of records that share a block, the first characters of a token. ``names(id, key, bag)``.

    A cap keeps the rows of smallest id of each block, as a parameter; the default keeps all.
    """
    rows = names.select("id", F.explode(_blocks(F.col("bag"), prefix)).alias("block"))
    if block_cap is not None:
        rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("block").orderBy("id"))).where(F.col("r") <= block_cap).drop("r")
    a, b = rows.withColumnRenamed("id", "a"), rows.withColumnRenamed("id", "b")
    return a.join(b, "block").where("a < b").select("a", "b").distinct()


def matches(names: DataFrame, threshold: float = 0.55) -> DataFrame:
    """Edges between distinct keys that share a block, by the strongest of: same tokens, token subset, trigram similarity.

    Candidates come from what either rule needs, not from blocks, so that a common block pairs nothing by itself.
    """
    n = names.select("id", entity_key(F.col("name")).alias("key")).where("key <> ''")
    keys = n.groupBy("key").agg(F.min("id").alias("id")).withColumn("bag", token_bag(F.col("key")))
    same = keys.where(F.size("bag") > 0).groupBy("bag").agg(F.min("id").alias("a"), F.collect_list("id").alias("ids")).select("a", F.explode("ids").alias("b")).where("a <> b").select("a", "b", F.lit("token").alias("kind"), F.lit(1.0).alias("score"))
    near = similarity_join(*[keys.select("id", text_trigrams(F.col("key")).alias("g"))] * 2, threshold).where("a < b").select("a", "b")
    pairs = near.union(_subsets(keys)).distinct()
    x = keys.select(F.col("id").alias("a"), F.col("key").alias("ka"), F.col("bag").alias("ba"))
    y = keys.select(F.col("id").alias("b"), F.col("key").alias("kb"), F.col("bag").alias("bb"))
    p = pairs.join(x, "a").join(y, "b").where((F.col("ba") != F.col("bb")) & F.arrays_overlap(_blocks(F.col("ba")), _blocks(F.col("bb"))))
    contained = subset(F.col("ba"), F.col("bb")) & (F.least(F.size("ba"), F.size("bb")) >= 2)
    sim = jaccard(text_trigrams(F.col("ka")), text_trigrams(F.col("kb")))
    p = p.withColumn("contained", contained).withColumn("sim", sim).where(F.col("contained") | (F.col("sim") >= threshold))
    return same.unionByName(p.select("a", "b", F.when(F.col("contained"), "subset").otherwise("trigram").alias("kind"), F.round(F.when(F.col("contained"), 0.9).otherwise(F.col("sim")), 3).alias("score")))


def _blocks(bag: Column, prefix: int = 3) -> Column:
    return F.array_distinct(F.transform(F.filter(bag, lambda t: F.length(t) >= prefix), lambda t: F.substring(t, 1, prefix)))


def _subsets(keys: DataFrame) -> DataFrame:
    """Pairs of keys of which one has all tokens of the other, two at least: the smaller one's rarest token finds the larger."""
    bags = keys.where(F.size("bag") >= 2).select("id", F.array_distinct("bag").alias("g"))
    counts = bags.select(F.explode("g").alias("gram")).groupBy("gram").agg(F.count("*").alias("k"))
    inner = rarest_first(bags, counts).select(F.col("id").alias("x"), F.col("g").alias("gx"), F.get("g", F.lit(0)).alias("gram"))
    outer = bags.select(F.col("id").alias("y"), F.col("g").alias("gy"), F.explode("g").alias("gram"))
    j = inner.join(outer, "gram").where((F.col("x") != F.col("y")) & (F.size(F.array_except("gx", "gy")) == 0))
    return j.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def closure(edges: DataFrame) -> DataFrame:
    """``(node, label)``: connected components by least label, joined and grouped until nothing changes.

    Each round also jumps to the label's label, so long chains take few rounds.
    """
    shared_dir(edges.sparkSession)
    both = edges.select("a", "b").where("a <> b")
    both = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    at = both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")).checkpoint()
    while True:
        near = both.join(at, both["b"] == at["node"]).groupBy("a").agg(F.min("label").alias("m"))
        moved = at.join(near, at["node"] == near["a"]).select("node", F.least("label", "m").alias("label"), F.col("label").alias("was"))
        jump = moved.select(F.col("node").alias("x"), F.col("label").alias("y"))
        now = moved.join(jump, moved["label"] == jump["x"]).select("node", F.least("label", "y").alias("label"), "was").checkpoint()
        changed = not now.where("label <> was").isEmpty()
        at = now.select("node", "label")
        if not changed:
            return at


LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "


def letter_counts(key: Column) -> Column:
    """How often a key has each of ``LETTERS``, and all else in one number."""
    n = F.array(*[F.length(key) - F.length(F.replace(key, F.lit(c), F.lit(""))) for c in LETTERS])
    return F.concat(n, F.array(F.length(key) - F.aggregate(n, F.lit(0), lambda a, x: a + x)))


def neighbour_matches(records: DataFrame, threshold: float = 0.85, reach: int = 49, most: int | None = None) -> DataFrame:
    """Near keys of ``records(key, id, name, source)``: ``(ka, kb, name_a, name_b, ratio, sources)``, in order of the keys' first ids.

    A pair counts where both keys together come from two sources or more; ``sources`` has them, sorted. What two keys share of letters bounds their
    ratio from above, so that built-ins leave few pairs to Python. ``most`` keeps the first so many pairs by position.
    """
    own = records.where(F.col("key") != "").groupBy("key").agg(F.min("id").alias("first"), F.min_by("name", "id").alias("name"), F.collect_set("source").alias("sources"))
    own = own.withColumn("letters", letter_counts(F.col("key")))
    pairs = positional_pairs(own, reach, ("name", "sources", "letters"))
    pairs = pairs.withColumn("both", F.array_sort(F.array_union("sources_a", "sources_b"))).where(F.size("both") >= 2)
    shared = F.aggregate(F.zip_with("letters_a", "letters_b", lambda x, y: F.least(x, y)), F.lit(0), lambda a, x: a + x)
    near = pairs.where(2 * shared >= (threshold - 1e-9) * (F.length("ka") + F.length("kb"))).withColumn("ratio", sequence_ratio(F.col("ka"), F.col("kb"))).where(F.col("ratio") >= threshold)
    found = near.select("pa", "pb", "ka", "kb", "name_a", "name_b", "ratio", F.col("both").alias("sources"))
    return (found.orderBy("pa", "pb").limit(most) if most is not None else found).drop("pa", "pb")


def positional_pairs(keys: DataFrame, reach: int = 49, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each key with the next ``reach`` keys in order of first appearance. ``keys(key, first, ...)``; ``carry`` names columns that come along.

    Positions come from a range-partitioned sort with counted offsets; the range join is an equi-join on blocks of positions.
    """
    pos = numbered(keys, F.col("first"), F.col("key"), name="pos")
    step = reach + 1
    left = pos.select(F.col("key").alias("ka"), F.col("pos").alias("pa"), *[F.col(c).alias(f"{c}_a") for c in carry], F.explode(F.array(F.floor(F.col("pos") / step), F.floor(F.col("pos") / step) + 1)).alias("blk"))
    right = pos.select(F.col("key").alias("kb"), F.col("pos").alias("pb"), *[F.col(c).alias(f"{c}_b") for c in carry], F.floor(F.col("pos") / step).alias("blk"))
    return left.join(right, "blk").where((F.col("pb") > F.col("pa")) & (F.col("pb") <= F.col("pa") + reach)).drop("blk")
