"""Snapshot change capture, in batch and as a stream; event-time windows; keyed state across runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import payload_hash


def keyed(snapshot: DataFrame, compare: list[str], order: str | None = None) -> DataFrame:
    """One row for each (lower name, list) with its payload's hash; of repeated keys the last counts."""
    s = snapshot.where(F.coalesce(F.trim("name"), F.lit("")) != "").select(F.lower(F.trim("name")).alias("key"), "source_list", "name", payload_hash(*[F.col(c) for c in compare]).alias("h"), F.col(order).alias("o") if order else F.lit(0).alias("o"))
    return s.groupBy("key", "source_list").agg(F.max(F.struct("o", "h", "name")).alias("last")).select("key", "source_list", "last.name", "last.h")


def changes(before: DataFrame, after: DataFrame, compare: list[str]) -> DataFrame:
    """``(change_type, entity_name, source_list)``: one full outer join on the key."""
    a = keyed(before, compare).select("key", "source_list", F.col("name").alias("was"), F.col("h").alias("h0"))
    b = keyed(after, compare).select("key", "source_list", F.col("name").alias("now"), F.col("h").alias("h1"))
    j = a.join(b, ["key", "source_list"], "full_outer")
    kind = F.when(F.col("h0").isNull(), "added").when(F.col("h1").isNull(), "removed").when(F.col("h0") != F.col("h1"), "modified")
    return j.select(kind.alias("change_type"), F.coalesce("now", "was").alias("entity_name"), "source_list").where("change_type is not null")


def page_changes(pages: DataFrame, state: DataFrame, content: Column, key: str) -> DataFrame:
    """``(key, state)``: first_run, unchanged or changed against stored hashes."""
    now = pages.select(key, F.sha2(content, 256).alias("h"))
    j = now.join(state.select(key, F.col("h").alias("h0")), key, "left")
    return j.select(key, F.when(F.col("h0").isNull(), "first_run").when(F.col("h0") == F.col("h"), "unchanged").otherwise("changed").alias("state"))


def windowed_counts(events: DataFrame, time: str, key: str, size: str = "1 day", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts and sums by tumbling or sliding windows; the watermark bounds the state of a stream."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    events = events.withColumn(time, F.col(time).cast("timestamp"))
    return events.withWatermark(time, late).groupBy(w.alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes") -> DataFrame:
    return events.groupBy(key, F.session_window(time, gap).alias("s")).agg(F.count("*").alias("n")).select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def run_state(old: DataFrame, alerts: DataFrame, now: str) -> DataFrame:
    """Keyed state across runs: last http outcome, last failure and last recovery of each source."""
    a = alerts.select("source_id", F.col("type").alias("t"))
    j = old.join(a, "source_id", "full_outer")
    failed = F.col("t").isin("HTTP_DOWN", "HTTP_BLOCKED", "DATA_ZEROED")
    healed = (F.col("t") == "HTTP_OK") & F.col("last_http").isin("HTTP_DOWN", "HTTP_BLOCKED")
    return j.select("source_id", F.coalesce("t", "last_http").alias("last_http"), F.when(failed, F.lit(now)).otherwise(F.col("last_failed")).alias("last_failed"), F.when(healed, F.lit(now)).otherwise(F.col("last_healed")).alias("last_healed"))
