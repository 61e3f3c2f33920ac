"""Mixing sources to target weights by entropy balancing.

Document rates ``w`` minimise ``sum w log w - w`` under one token constraint for each source,
``sum w * size = target``, and ``0 <= w <= cap``. The dual is convex with one variable a source;
its solution is the exponential tilt ``w = min(cap, exp(lam * size / mean size))``. Newton steps
run as grouped aggregations over the counts by (source, size), for all sources at once, inside
a bracket that each step narrows. A rate depends on source and size only, so documents are
pre-aggregated before anything is shuffled, and a source with a third of all rows costs no more
than the number of its different sizes.

Rates become copies in two steps. Per source, from the largest size down, the copies of each
size are rounded while the rounding error is carried on, so a source misses its target by less
than its smaller documents. Within a (source, size) the copies are dealt by the rank of a hash
of id and text, computed in salted parts with offsets, never in one task. Reruns agree.

Sources are numbered by a range-partitioned sort. The level at which sources stop is found by sums over all of
them, a few rounds; no task sees all sources. The sizes of one source that are rounded in one task are as many as it has
different sizes. Rows that agree in id and text share out their copies in the order of their other columns.

Null texts have size 0 and take nothing. A null source is a source of its own, last in order.
Null ids are documents like all others. Very long texts are counted whole. Empty tables give empty results. In
``mixture`` other columns pass through; names that begin with ``__`` are taken.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import numbered
from .common import Words, chunks, cut, texts

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
STEPS = 60
NEAR = 1e-6
PART_ROWS = 20_000


def _size_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = texts(batch.column(2))
        sizes = [np.zeros(0, dtype=np.int64)] + [Words(docs[lo:hi]).counts() for lo, hi in chunks(docs)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(np.concatenate(sizes), pa.int64())], names=["id", "source", "u", "size"])


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(id, source, u, size)``: size in words, u a hash of id and text."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), text.alias("text"), F.xxhash64(F.lit(11), F.col(id_col), text).alias("u")).mapInArrow(_size_rows, "id long, source string, u long, size long")


def targets(by_size: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size, n)``.

    A source's target is ``min(cap * size, weight * level)``. The level rises as sources stop and leave their excess
    to the others; each round sums over all sources, until no more of them stop.
    """
    own = by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    own = numbered(own, F.col("source").isNull(), F.col("source"), name="place")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    own = cut(own.select("source", "source_size", w.alias("w"), (F.col("source_size") * cap).alias("most")))
    sums = own.agg(F.sum("source_size").alias("size"), F.sum("w").alias("w"), F.count("*").alias("k")).first()
    if not sums.k:
        return own.select("source", "source_size", F.lit(0.0).alias("target"))
    total, stopped, level = share * sums.size, 0, share * sums.size / sums.w
    while True:
        stops = F.col("most") <= F.col("w") * F.lit(level)
        now = own.agg(F.count(F.when(stops, 1)).alias("k"), F.coalesce(F.sum(F.when(stops, F.col("most"))), F.lit(0)).alias("most"), F.sum(F.when(~stops, F.col("w"))).alias("w")).first()
        if now.k == stopped or now.w is None:
            break
        stopped, level = now.k, (total - now.most) / now.w
    return own.select("source", "source_size", F.when(stops, F.col("most").cast("double")).otherwise(F.col("w") * F.lit(level)).alias("target"))


def balance(by_size: DataFrame, aims: DataFrame, cap: int = CAP, steps: int = STEPS, near: float = NEAR) -> DataFrame:
    """``(source, lam)``: the solution of the dual, by Newton steps within brackets.

    ``lam`` is null where the target is the cap of everything (or more): the rate is the cap.
    """
    counts = by_size.where("size > 0")
    mean = counts.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    aim = cut(aims.withColumnRenamed("source", "s").join(mean, F.col("s").eqNullSafe(mean["source"])).drop("source"))
    at = cut(aim.where(F.col("target") < F.col("source_size") * cap).select("s", "mean", "target", F.lit(0.0).alias("lam"), F.lit(-1e12).alias("low"), F.lit(1e12).alias("high"), F.lit(False).alias("done")))
    for _ in range(steps):
        x = F.col("size") / F.col("mean")
        tilt = F.exp(F.least(F.col("lam") * x, F.lit(50.0)))
        rate = F.least(F.lit(float(cap)), tilt)
        free = F.when(tilt < cap, F.col("n") * F.col("size") * x * tilt).otherwise(0.0)
        grad = counts.join(at, counts["source"].eqNullSafe(at["s"])).groupBy("s").agg(F.sum(F.col("n") * F.col("size") * rate).alias("have"), F.sum(free).alias("slope"), F.first("mean").alias("mean"), F.first("target").alias("target"), F.first("lam").alias("lam"), F.first("low").alias("low"), F.first("high").alias("high"))
        over = F.col("have") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("lam")), F.when(over, F.col("lam")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("lam") + (F.col("target") - F.col("have")) / F.col("slope"))
        # without a finite bracket yet, a step is at most a doubling; else it halves the bracket where Newton leaves it
        wide = F.greatest(F.lit(1.0), F.abs("lam"))
        newton = F.least(F.greatest(newton, F.col("lam") - wide), F.col("lam") + wide)
        step = F.when((newton > F.col("lo")) & (newton < F.col("hi")), newton).otherwise((F.greatest("lo", F.col("lam") - wide) + F.least("hi", F.col("lam") + wide)) / 2)
        done = F.abs(F.col("have") - F.col("target")) <= near * F.greatest("target", F.lit(1.0))
        at = cut(grad.withColumn("lo", low).withColumn("hi", high).select("s", "mean", "target", F.when(done, F.col("lam")).otherwise(step).alias("lam"), F.col("lo").alias("low"), F.col("hi").alias("high"), done.alias("done")))
        if at.where("not done").isEmpty():
            break
    else:
        warnings.warn(f"{at.where('not done').count()} sources are not within {near} of their targets after {steps} steps", stacklevel=2)
    return aim.select("s", "mean").join(at.select(F.col("s").alias("s2"), "lam"), F.col("s").eqNullSafe(F.col("s2")), "left").drop("s2")


def round_down_sizes(pdf: pd.DataFrame) -> pd.DataFrame:
    """Copies of each size of one source, largest first; what rounding adds or leaves is carried on."""
    pdf = pdf.sort_values("size", ascending=False)
    owed, copies = 0.0, []
    for size, n, rate, cap in zip(pdf["size"], pdf["n"], pdf["rate"], pdf["cap"], strict=True):
        owed += size * n * rate
        k = int(min(n * cap, max(0, np.floor(owed / size + 0.5)))) if size else 0
        owed -= k * size
        copies.append(k)
    return pd.DataFrame({"s": pdf["s"], "size": pdf["size"], "n": pdf["n"], "copies": copies})


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, part_rows: int = PART_ROWS) -> DataFrame:
    """``docs`` of :func:`sized` with ``(source_size, target, rate, copies)``."""
    docs = cut(docs)
    by_size = cut(docs.groupBy("source", "size").agg(F.count("*").alias("n")))
    aims = cut(targets(by_size, weights, share, cap))
    dual = balance(by_size, aims, cap)
    rates = by_size.join(dual, by_size["source"].eqNullSafe(dual["s"]), "left").drop("s")
    rate = F.when(F.col("size") > 0, F.when(F.col("lam").isNull(), F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0)))))).otherwise(0.0)
    rates = rates.select(F.col("source").alias("s"), "size", "n", rate.alias("rate"))
    whole = rates.withColumn("cap", F.lit(cap)).groupBy("s").applyInPandas(round_down_sizes, "s string, size long, n long, copies long")
    whole = cut(whole.withColumn("parts", F.ceil(F.col("n") / F.lit(part_rows)).cast("int")))

    named = docs.join(whole, docs["source"].eqNullSafe(whole["s"]) & (docs["size"] == whole["size"])).drop(whole["size"]).drop("s")
    # rank by u in each (source, size): parts are ranges of u, so a part's first rank is the count of those before it
    part = F.floor((F.col("u") / F.lit(2.0**64) + F.lit(0.5)) * F.col("parts")).cast("int")
    named = named.withColumn("part", F.least(F.greatest(part, F.lit(0)), F.col("parts") - 1))
    held = named.groupBy(F.col("source").alias("s"), F.col("size").alias("z"), F.col("part").alias("p")).agg(F.count("*").alias("k"))
    earlier = held.withColumn("before", F.coalesce(F.sum("k").over(Window.partitionBy("s", "z").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("k")
    ranked = named.withColumn("r", F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("u", "id")))
    ranked = ranked.join(earlier, ranked["source"].eqNullSafe(earlier["s"]) & (ranked["size"] == earlier["z"]) & (ranked["part"] == earlier["p"]))
    base = F.floor(F.col("copies") / F.col("n"))
    extra = F.when(F.col("before") + F.col("r") <= F.col("copies") - base * F.col("n"), 1).otherwise(0)
    got = ranked.select("id", "source", "u", "size", (base + extra).cast("long").alias("copies"))
    aims = aims.withColumnRenamed("source", "s")
    return got.join(aims, got["source"].eqNullSafe(aims["s"])).drop("s")


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row of ``docs`` for each copy that the mix takes, with ``copy`` counting from 1 (``__copy`` where ``docs`` has a column of that name).

    Rows that agree in id and text get the average of their copies, the first of them by their columns more where it isn't whole.
    """
    plan = copies(sized(docs, id_col, text_col, source_col)).groupBy("id", "source", "u").agg(F.sum("copies").alias("all"), F.count("*").alias("rows"))
    plan = cut(plan.where("all > 0").select(F.col("id").alias("__id"), F.col("source").alias("__source"), F.col("u").alias("__u"), F.col("all").alias("__all"), F.col("rows").alias("__rows")))
    keyed = docs.withColumn("__u2", F.xxhash64(F.lit(11), F.col(id_col), F.col(text_col).cast("string")))
    got = keyed.join(plan.hint("shuffle_hash"), (F.col("__u2") == F.col("__u")) & F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & F.col(source_col).cast("string").eqNullSafe(F.col("__source")))
    share = F.col("__all")
    if not plan.where("__rows > 1").isEmpty():
        rank = F.row_number().over(Window.partitionBy("__u", "__id", "__source").orderBy(*[F.col(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() != "map"]))
        share = F.floor(share / F.col("__rows")) + F.when(rank <= F.pmod(share, F.col("__rows")), 1).otherwise(0)
    got = got.withColumn("__copies", share)
    number = "__copy" if "copy" in docs.columns else "copy"
    return got.where("__copies > 0").withColumn(number, F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns], number)


def report(docs: DataFrame) -> DataFrame:
    got = copies(sized(docs))
    return got.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
