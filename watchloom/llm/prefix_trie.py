"""The trie of all conversation prefixes: members, children, leaves and saved tokens of each node.

Each turn is reduced to a SHA-256 of role and text before anything is shuffled. A conversation's prefix digests are
chained: within a block of ``BLOCK`` turns each digest hashes the one before and the turn, and the ends of blocks are
chained in the same way, so that a conversation with a third of all turns is hashed by many tasks. Every
prefix becomes a row; a node is a group of (depth, digest).

Sums over subtrees explode nodes to their ancestors. A run of nodes that have one child each and one smallest
member stands for its nodes there: what a node of it sums is what the run sums, less the nodes of the run above. So the exploded rows grow with how often
paths branch, not with the square of their length, and copies of a conversation, which are no node's smallest member, add none.

Turns are ordered by ``turn`` (nulls first), then by the hashes of their role and text. Null roles and texts are empty.
Rows without conv_id are left out, rows that repeat are turns of their own. Conversations that end up with no turns end at the root. Very
long texts are taken whole. An empty table has no root. Other columns are ignored. ``ends_sha256`` needs the ids of a node in one sequence: they are joined
into strings a block of ids at a time, and one task streams a node's strings through the hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import numbered
from .common import cut

BLOCK = 1024
IDS = 4096
LENT, EVERY = 6, 100
NOTHING = hashlib.sha256(b"").hexdigest()
ROOT = bytes(32)


def running(df: DataFrame, key: str, at: str, block: int, **sums: Column) -> DataFrame:
    """``df`` with running aggregates of ``sums`` (sum or max of a column) along ``at`` (whole numbers from 0) for each ``key``.

    Blocks of ``at`` are summed on their own and carried over to the next, so that a key's rows need not meet.
    """
    df = df.withColumn("__blk", F.floor(F.col(at) / block))
    total = df.groupBy(F.col(key).alias("__key"), F.col("__blk").alias("__b")).agg(*[how(c).alias(name) for name, (how, c) in sums.items()])
    before = Window.partitionBy("__key").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    total = total.select("__key", "__b", *[how(name).over(before).alias(f"__{name}") for name, (how, _) in sums.items()])
    own = Window.partitionBy(key, "__blk").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumns({name: how(c).over(own) for name, (how, c) in sums.items()})
    both = df.join(total, (F.col(key) == F.col("__key")) & (F.col("__blk") == F.col("__b")))
    put = {name: F.coalesce(F.col(name) + F.col(f"__{name}"), F.col(name), F.col(f"__{name}")) if how is F.sum else F.greatest(name, f"__{name}") for name, (how, _) in sums.items()}
    return both.withColumns(put).drop("__blk", "__key", "__b", *[f"__{name}" for name in sums])


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``(conv, pos, turn_hash, chars)``: positions from 1 in each conversation."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    t = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.unhex(F.sha2(F.concat(F.sha2(role, 256), F.sha2(text, 256)), 256)).alias("turn_hash"), F.length(text).cast("long").alias("chars"))
    return numbered(t, F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("turn_hash").asc()).drop("turn")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv, p, turn_hash, chars, length)`` of the rebuilt conversations and ``(conv, length)`` of all of them."""
    n = cut(numbered_turns(turns))
    convs = n.groupBy("conv").agg((F.min("n") - 1).alias("start"), F.count("*").alias("own"))
    convs = convs.withColumns({"h": F.crc32(F.col("conv").cast("string")) % LENT, "lender": F.col("conv") - F.col("conv") % EVERY})
    lenders = convs.select(F.col("conv").alias("lender"), F.col("own").alias("lends"))
    convs = convs.join(lenders, "lender", "left").withColumn("lent", F.least("h", F.coalesce("lends", F.lit(0))))
    convs = cut(convs.withColumn("length", F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).select("conv", "start", "h", "lender", "lent", "length"))
    t = n.join(convs, "conv").withColumn("pos", F.col("n") - F.col("start"))
    own = t.where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("lent")).alias("p"), "turn_hash", "chars", "length")
    first = t.where((F.col("pos") < LENT) & (F.col("conv") % EVERY == 0)).select(F.col("conv").alias("lender"), "pos", "turn_hash", "chars")
    lent = convs.where("lent > 0").select("conv", "lender", "lent", "length").join(first, "lender").where("pos <= lent")
    return own.unionByName(lent.select("conv", F.col("pos").alias("p"), "turn_hash", "chars", "length")), convs.select("conv", "length")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests within each block of a conversation, chained from 32 zero bytes."""
    for batch in batches:
        convs, blks, ends = [], [], []
        ps, digests, chars = [], [], []
        for conv, blk, turns in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            d = ROOT
            for t in turns:
                d = hashlib.sha256(d + t["turn_hash"]).digest()
                convs.append(conv)
                blks.append(blk)
                ps.append(t["p"])
                digests.append(d)
                chars.append(t["chars"])
                ends.append(False)
            ends[-1] = True
        yield pa.RecordBatch.from_arrays([pa.array(convs, pa.int64()), pa.array(blks, pa.int64()), pa.array(ps, pa.int64()), pa.array(digests, pa.binary()), pa.array(chars, pa.int64()), pa.array(ends, pa.bool_())], names=["conv", "blk", "depth", "own", "chars", "end"])


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block but the first the chain over the ends of the blocks before."""
    for batch in batches:
        out = []
        for conv, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            d = ROOT
            for e in ends:
                d = hashlib.sha256(d + e["own"]).digest()
                out.append((conv, e["blk"] + 1, d))
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], names=["conv", "blk", "seed"])


def prefixes(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(conv, depth, digest, parent, chars)``: every prefix of ``turns(conv, p, turn_hash, chars)`` with the digest of the one before."""
    blocks = turns.groupBy("conv", F.floor((F.col("p") - 1) / block).alias("blk")).agg(F.sort_array(F.collect_list(F.struct("p", "turn_hash", "chars"))).alias("turns"))
    own = cut(blocks.select("conv", "blk", "turns").mapInArrow(_chain, "conv long, blk long, depth long, own binary, chars long, end boolean"))
    ends = own.where("end").select("conv", "blk", "own").withColumn("last", F.max("blk").over(Window.partitionBy("conv"))).where("last > 0 and blk < last")
    seeds = ends.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("blk", "own"))).alias("ends")).mapInArrow(_seeds, "conv long, blk long, seed binary")
    first = own.where("blk = 0").withColumn("seed", F.lit(ROOT)).drop("end")
    later = own.where("blk > 0").drop("end").join(seeds, ["conv", "blk"])
    chained = lambda x: F.unhex(F.sha2(F.concat(F.col("seed"), x), 256))
    p = first.unionByName(later).select("conv", "depth", "blk", chained(F.col("own")).alias("digest"), "chars")
    within = Window.partitionBy("conv", "blk").orderBy("depth")
    p = p.withColumn("parent", F.lag("digest").over(within))
    over = p.groupBy("conv", (F.col("blk") + 1).alias("blk")).agg(F.max_by("digest", "depth").alias("before"))
    p = p.where("blk = 0").withColumn("before", F.lit(ROOT)).unionByName(p.where("blk > 0").join(over, ["conv", "blk"]))
    return p.select("conv", "depth", "digest", F.coalesce("parent", "before").alias("parent"), "chars")


def _hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, state = None, None
    for batch in batches:
        out = []
        for digest, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if digest != at:
                if at is not None:
                    out.append((at, state.hexdigest()))
                at, state = digest, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _pairs(out)
    if at is not None:
        yield _pairs([(at, state.hexdigest())])


def _pairs(out: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.string())], names=["digest", "ends_sha256"])


def hashed_ends(ends: DataFrame) -> DataFrame:
    """``(digest, ends_sha256)`` of ``ends(digest, conv)``: the ids of each digest, ascending and comma-joined, hashed."""
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",")
    parts = ends.groupBy("digest", F.floor(F.col("conv") / IDS).alias("blk")).agg(ids.alias("ids"))
    return parts.repartition("digest").sortWithinPartitions("digest", "blk").select("digest", "ids").mapInArrow(_hashed_ends, "digest binary, ends_sha256 string")


def tree(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each node: see ``report``; also ``digest``, null at the root."""
    rows, convs = rebuilt(turns)
    paths = cut(prefixes(rows, block))
    nodes = paths.groupBy("depth", "digest").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.first("parent").alias("parent"), F.first("chars").alias("chars"))
    children = nodes.groupBy(F.col("parent").alias("of")).agg(F.count("*").alias("n_children"))
    nodes = cut(nodes.join(children, F.col("digest") == F.col("of"), "left").drop("of").withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "saved": (F.col("n_convs") - 1) * F.col("chars")}))
    above = nodes.select(F.col("digest").alias("of"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings"))
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).first()
    first = nodes.where("depth = 1").withColumns({"parent_conv_id": F.lit(root["conv_id"]).cast("long"), "siblings": F.lit(2).cast("long")})
    known = first.unionByName(nodes.where("depth > 1").join(above, F.col("parent") == F.col("of")).drop("of"))
    # a run begins where the parent branches or has another smallest member; the nodes of one smallest member are consecutive
    known = known.withColumn("begins", (F.col("siblings") != 1) | (F.col("conv_id") != F.col("parent_conv_id")) | (F.col("depth") == 1))
    known = running(known, "conv_id", "depth", IDS, begin=(F.max, F.when(F.col("begins"), F.col("depth"))), upto=(F.sum, F.col("saved")))
    known = cut(known.withColumn("above", F.col("upto") - F.col("saved")))
    runs = known.groupBy("conv_id", "begin").agg(F.sum("saved").alias("w"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"), F.max(F.when(F.col("begins"), F.struct("digest", "above"))).alias("top"))
    runs = cut(runs.select("conv_id", "begin", "w", "leaf", "top.digest", F.col("top.above").alias("base")))
    # each run to itself and all runs above it on the path of its smallest member
    ancestors = paths.select("conv", "depth", "digest").join(runs.select("digest"), "digest")
    summed = runs.select("conv_id", "begin", "w", "leaf").join(ancestors, (F.col("conv_id") == F.col("conv")) & (F.col("depth") <= F.col("begin"))).groupBy("digest").agg(F.sum("w").alias("w"), F.sum("leaf").alias("n_leaves"))
    runs = runs.select("conv_id", "begin", "digest", "base").join(summed, "digest").drop("digest")
    ends = hashed_ends(paths.join(convs.where("length > 0").withColumnRenamed("conv", "c"), (F.col("conv") == F.col("c")) & (F.col("depth") == F.col("length"))).select("digest", "conv"))
    found = known.join(runs, ["conv_id", "begin"]).withColumn("saved_tokens", F.col("w") - (F.col("above") - F.col("base"))).join(ends, "digest", "left")
    found = found.select("digest", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
    if root["n_convs"] == 0:
        return found
    whole = nodes.agg(F.count_if(F.col("depth") == 1).alias("n_children"), F.count_if(F.col("n_children") == 0).alias("n_leaves"), F.sum("saved").alias("saved_tokens")).first()
    none = hashed_ends(convs.where("length = 0").select(F.lit(ROOT).alias("digest"), "conv")).first()
    row = (None, root["conv_id"], 0, None, root["n_convs"], whole["n_children"], max(1, whole["n_leaves"]), whole["saved_tokens"] or 0, none["ends_sha256"] if none else NOTHING)
    return found.union(found.sparkSession.createDataFrame([row], found.schema))


def report(turns: DataFrame) -> DataFrame:
    """A row for each node: smallest member, depth, the parent's smallest member, members, children, and what its subtree sums."""
    return tree(turns).drop("digest")
