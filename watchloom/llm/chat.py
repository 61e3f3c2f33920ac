"""Chat formatting: collapse of cumulative snapshots, then rendering. DataFrame functions only.

A logged conversation that is a prefix of a longer one, or equal to one with a smaller id, is
a snapshot and is dropped. Each turn gets a rolling hash of all turns up to it: the running sums of
``h`` and of ``position * h`` over two independent 64-bit hashes of (role, text), held as
decimals. Both sums are additive, so conversations are cut into blocks of ``block`` turns that
are summed on their own and shifted by the totals of the blocks before; a conversation with a third
of all turns doesn't land in one task before it is rendered.

A conversation's last hash that is also some other conversation's inner hash, of the same length,
names a proper prefix; a left anti join on (length, hash) drops those. Equal conversations meet
in one row of a grouped minimum, so copies are never paired.

Order of turns: ``turn`` (nulls last); rows of one turn by their hashes where prefixes are compared,
by role and text where they are rendered. Null roles render as ``unknown``,
null texts as empty. Rows without conv_id make one conversation, whose id is null. Repeated rows
are turns of their own. Other columns are ignored; empty tables give empty results. Very long texts are kept whole. A
rendered conversation is one row: that row, and nothing else, holds all its turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 512
WIDE = "decimal(38,0)"


def turn_hashes(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(conv, k, a, b, c, last)``: each turn's position from 1, rolling hash and whether it is the last."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("unknown")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    t = turns.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.xxhash64(role, F.lit(0), text).alias("h"), F.xxhash64(F.lit("g"), text, F.lit(1), role).alias("g"))
    t = t.withColumn("blk", F.coalesce(F.floor(F.col("turn") / block), F.lit((1 << 62)).cast("long")))
    own = Window.partitionBy("conv", "blk").orderBy(F.col("turn").asc_nulls_last(), "h", "g")
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumn("rn", F.row_number().over(own))
    h, g, rn = F.col("h").cast("decimal(20,0)"), F.col("g").cast("decimal(20,0)"), F.col("rn").cast("decimal(12,0)")
    t = t.select("conv", "blk", "rn", F.sum(h).over(upto).cast(WIDE).alias("sh"), F.sum(rn * h).over(upto).cast(WIDE).alias("sr"), F.sum(g).over(upto).cast(WIDE).alias("sg"))
    total = t.groupBy("conv", "blk").agg(F.max("rn").alias("n"), F.max_by("sh", "rn").alias("sh"), F.max_by("sr", "rn").alias("sr"), F.max_by("sg", "rn").alias("sg"))
    before = Window.partitionBy("conv").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0).cast(WIDE)
    total = total.withColumn("n0", F.coalesce(F.sum("n").over(before), F.lit(0)))
    total = total.withColumn("moved", (F.col("sr") + F.col("sh") * F.col("n0").cast("decimal(12,0)")).cast(WIDE))
    start = total.select(F.col("conv").alias("c"), F.col("blk").alias("d"), "n0", F.coalesce(F.sum("sh").over(before), nothing).alias("sh0"), F.coalesce(F.sum("moved").over(before), nothing).alias("sr0"), F.coalesce(F.sum("sg").over(before), nothing).alias("sg0"), (F.sum("n").over(Window.partitionBy("conv"))).alias("turns"))
    t = t.join(start, t["conv"].eqNullSafe(start["c"]) & (t["blk"] == start["d"]))
    k = (F.col("n0") + F.col("rn")).cast("long")
    return t.select("conv", k.alias("k"), (F.col("sh0") + F.col("sh")).cast(WIDE).alias("a"), (F.col("sr0") + F.col("sr") + F.col("sh") * F.col("n0").cast("decimal(12,0)")).cast(WIDE).alias("b"), (F.col("sg0") + F.col("sg")).cast(WIDE).alias("c"), (k == F.col("turns")).alias("last"))


def maximal(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(conv, logged)``: the conversations to keep and how many equal ones each stands for."""
    h = turn_hashes(turns, block)
    key = ["k", "a", "b", "c"]
    ends = h.where("last").groupBy(*key).agg(F.min("conv").alias("conv"), F.count("*").alias("logged"))
    inner = h.where("not last").select(*key).distinct()
    return ends.join(inner, key, "left_anti").select("conv", F.col("k").alias("n_turns"), "logged")


def rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("\n<|end|>\n"))


def chat_documents(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(conv_id, n_turns, logged, text)``: a document for each maximal conversation."""
    keep = maximal(turns, block)
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").isNull().alias("none"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    t = t.join(keep, t["conv_id"].eqNullSafe(keep["conv"])).groupBy("conv_id").agg(F.first("n_turns").alias("n_turns"), F.first("logged").alias("logged"), F.sort_array(F.collect_list("t")).alias("ts"))
    return t.select("conv_id", "n_turns", "logged", F.array_join(F.transform("ts", rendered), "").alias("text"))


def report(turns: DataFrame) -> DataFrame:
    return chat_documents(turns).select("conv_id", "n_turns", "logged", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))
