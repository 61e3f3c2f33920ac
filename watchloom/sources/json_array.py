"""Records of JSON files of any size: one array, one object, or objects one after the other.

A file is read in its byte splits through Spark's own text reader, a piece ending at each ``}``, so that a dump of one array is read by
as many tasks as it has splits, from any store. Whether a split begins inside a string, and how deep, isn't known where it
is read. So one pass sums each split up under both assumptions (in a string or not): the state it ends in, the change of depth,
and the least depth at which an object closed. These rows, one a split, are put together in order, and the next pass cuts the
records, knowing how each split begins. A record that crosses splits comes as fragments, which are joined by the split it began in.

Elements of the array that aren't objects are left out, as are empty files. Records are given as they are written; what isn't JSON between
well-formed braces comes through and parses to null later. Texts are UTF-8, with or without a mark at the beginning.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..shared import cut

_ESCAPED = re.compile(r"\\.", re.S)
_BLANK = " \t\r\n﻿"
MOST_ROUTES = 10_000


def step(piece: str, inside: bool) -> tuple[bool, int, bool]:
    """From a piece that ends before a ``}``: whether that brace is in a string, the change of depth up to it, whether it closes."""
    if "\\" in piece:
        piece = _ESCAPED.sub("", piece)
    if '"' in piece:
        parts = piece.split('"')
        outside = parts[1 if inside else 0 :: 2]
        after = inside ^ (len(parts) % 2 == 0)
        depth = sum(x.count("{") + x.count("[") - x.count("]") for x in outside)
    else:
        after = inside
        depth = 0 if inside else piece.count("{") + piece.count("[") - piece.count("]")
    return after, depth - (not after), not after


@dataclass
class Sum:
    """What a split does from one assumed state."""

    inside: bool
    depth: int = 0
    low: int | None = None  # least depth right after an object closed

    def add(self, piece: str) -> None:
        self.inside, change, closes = step(piece, self.inside)
        self.depth += change
        if closes and (self.low is None or self.depth < self.low):
            self.low = self.depth


def pieces(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """Runs of pieces of one split."""
    own: list[str] = []
    key = None
    for batch in batches:
        for file, at, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, at) != key:
                if key is not None:
                    yield *key, None
                key = (file, at)
            yield file, at, value
    if key is not None:
        yield *key, None


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    both, root = (Sum(False), Sum(True)), ""
    for file, at, value in _splits(batches):
        if value is not None:
            root = root or value.strip(_BLANK)[:1]
            for s in both:
                s.add(value)
            continue
        row = [file, at, root, *(x for s in both for x in (s.inside, s.depth, s.low))]
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.string(), pa.int64(), pa.string(), *(pa.bool_(), pa.int64(), pa.int64()) * 2), strict=True)], names=_SUMS)
        both, root = (Sum(False), Sum(True)), ""


_SUMS = ["file", "at", "root", "inside0", "depth0", "low0", "inside1", "depth1", "low1"]


@dataclass
class Start:
    """How a split begins: in a string, how deep, at which depth records close, and the split in which the open record began."""

    inside: bool
    depth: int
    base: int
    origin: int


def starts(sums: list) -> dict[tuple[str, int], Start]:
    """The states of all splits from their sums; ``sums`` has a row for each split."""
    out: dict[tuple[str, int], Start] = {}
    file, state = None, None
    for r in sorted(sums, key=lambda r: (r["file"], r["at"])):
        if r["file"] != file:
            file, state = r["file"], Start(False, 0, 1 if r["root"] == "[" else 0, r["at"])
        out[file, r["at"]] = state
        k = int(state.inside)
        low = r[f"low{k}"]
        began = low is not None and state.depth + low <= state.base
        state = Start(r[f"inside{k}"], state.depth + r[f"depth{k}"], state.base, r["at"] if began else state.origin)
    return out


def objects(text: str) -> Iterator[str]:
    """The objects in a stretch of the array that ends with one."""
    text = text.lstrip(_BLANK + ",")
    if text.startswith("{"):
        yield text
        return
    decoder, at = json.JSONDecoder(), 0
    while at < len(text):
        try:
            value, end = decoder.raw_decode(text, at)
        except ValueError:
            at += 1  # a blank, a comma, the bracket of the array itself
            continue
        if isinstance(value, dict):
            yield text[at:end]
        at = end


def _cut_records(shared, fragments: bool):
    """Whole records of each split, or the fragments ``(file, origin, at, text)`` of those that cross splits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, out, held = shared.value, [], 0
        names = ["file", "origin", "at", "text"]
        state: Start | None = None
        own: list[str] = []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=names)

        for file, at, value in _splits(batches):
            if state is None:
                s = known[file, at]
                state, inside, depth, origin, own = s, s.inside, s.depth, s.origin, []
                crossing = at != 0  # what is open here began in an earlier split
                first = at == 0
            if value is None:
                if fragments and own:
                    out.append((file, origin if crossing else at, at, "".join(own)))
                state = None
                continue
            inside, change, closes = step(value, inside)
            depth += change
            own += (value, "}")
            if closes and depth == state.base:
                text = "".join(own)
                if first:
                    text = text.lstrip(_BLANK).removeprefix("[") if state.base else text
                if crossing and fragments:
                    out.append((file, origin, at, text))
                elif not crossing and not fragments:
                    out += [(file, at, at, x) for x in objects(text)]
                held += len(text)
                own, crossing, first, origin = [], False, False, at
            if held > 1 << 22:
                yield batch()
                out, held = [], 0
        yield batch()

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [(file, x) for file, text in zip(*(c.to_pylist() for c in batch.columns), strict=True) for x in _whole(text)]
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in out], pa.string()), pa.array([x for _, x in out], pa.string())], names=["file", "record"])


def _whole(text: str) -> Iterator[str]:
    text = text.lstrip(_BLANK + ",")
    if text.endswith("}") and text.startswith("{"):
        yield text
    elif "{" in text:
        yield from objects(text.removeprefix("["))


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """``(file, record)``: the objects of each file, as JSON texts, in no order."""
    parts = pieces(spark, path)
    kinds = "file string, at long, root string, inside0 boolean, depth0 long, low0 long, inside1 boolean, depth1 long, low1 long"
    known = spark.sparkContext.broadcast(starts(parts.mapInArrow(_sum_up, kinds).collect()))  # a row a split
    schema = "file string, origin long, at long, text string"
    whole = parts.mapInArrow(_cut_records(known, False), schema).select("file", F.col("text").alias("record"))
    crossing = parts.mapInArrow(_cut_records(known, True), schema)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "")
    joined = cut(crossing.groupBy("file", "origin").agg(text.alias("text")).select("file", "text").mapInArrow(_joined, "file string, record string"))
    return whole.unionByName(joined)


def written(value: str) -> Column:
    """A key of a record as trimmed text; null and missing are blank."""
    return F.coalesce(F.trim(F.get_json_object("record", f"$['{value}']")), F.lit(""))


def first_written(*keys: str) -> Column:
    return F.coalesce(*[F.nullif(written(k), F.lit("")) for k in keys], F.lit(""))


def route_records(records: DataFrame, routes: DataFrame, skip: tuple[str, ...] = (), label: str = "source", names: tuple[str, ...] = ("name",)) -> tuple[DataFrame, Observation]:
    """Records whose label has a route and that have a name, with the route's columns; what went otherwise is counted in the same pass.

    ``routes(label, ...)`` is checked to be small and broadcast. The observation has ``read``, ``routed``, ``skipped`` (labels in ``skip``),
    ``unrouted`` (other labels) and ``nameless``, once an action over all rows has run.
    """
    if len(routes.take(MOST_ROUTES + 1)) > MOST_ROUTES:
        raise ValueError(f"at most {MOST_ROUTES} routes are taken")
    known = routes.withColumn("__routed", F.lit(True))
    r = records.withColumns({"label": written(label), "name": first_written(*names)}).join(F.broadcast(known), "label", "left")
    skipped = F.col("label").isin(*skip) if skip else F.lit(False)
    routed = F.coalesce("__routed", F.lit(False)) & ~skipped
    seen = Observation()
    counts = {"read": F.lit(True), "routed": routed & (F.col("name") != ""), "skipped": skipped, "unrouted": ~routed & ~skipped, "nameless": routed & (F.col("name") == "")}
    r = r.observe(seen, *[F.count_if(c).alias(k) for k, c in counts.items()])
    return r.where(routed & (F.col("name") != "")).drop("__routed"), seen


def label_outcomes(records: DataFrame, routes: DataFrame, skip: tuple[str, ...] = (), label: str = "source", names: tuple[str, ...] = ("name",)) -> DataFrame:
    """``(label, outcome, n)``: how many records of each label were routed, nameless, skipped or unrouted."""
    known = routes.select("label").distinct().withColumn("__routed", F.lit(True))
    r = records.withColumns({"label": written(label), "name": first_written(*names)}).join(known, "label", "left")
    skipped = F.col("label").isin(*skip) if skip else F.lit(False)
    outcome = F.when(skipped, "skipped").when(F.col("__routed").isNull(), "unrouted").when(F.col("name") == "", "nameless").otherwise("routed")
    return r.groupBy("label", outcome.alias("outcome")).agg(F.count("*").alias("n"))


def write_json_array(df: DataFrame, path: str) -> None:
    """Each partition as a file that is one JSON array of its rows; empty partitions write an empty array."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sep = "[\n"
        for batch in batches:
            rows = batch.column(0).to_pylist()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([sep + ",\n".join(rows)], pa.string())], names=["value"])
                sep = ",\n"
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if sep == "[\n" else "\n]"], pa.string())], names=["value"])

    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).mapInArrow(lines, "value string").write.option("lineSep", "\n").text(path)
