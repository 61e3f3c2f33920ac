"""Benchmark decontamination with one Aho-Corasick automaton.

Words are runs outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` of a text with A-Z lower-cased. A
window is 10 consecutive words of an item; an item of fewer words, but not none, is one
window. All windows go into one automaton over words joined by single spaces, and each
document is scanned once. Match offsets become word positions and these, for documents with hits,
spans of characters in the original text.

The items are a stated, small set: their windows are broadcast while they stay under
``max_chars`` normalised characters. Beyond that the items are dealt into automata of that
size. They are read one after another: each scan is written down before the next automaton is built, so that
the driver and the executors hold one at a time. There is no shuffle, and the results are the same.

Null texts and items have no words. An item without an id hits like the others, but no id is counted for it.
Repeated rows come back as often as they came in; other columns pass through (the names ``__n_words``, ``__spans``,
``__chars`` and ``__items`` are taken). Very long texts are scanned whole. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, texts

WINDOW = 10
MAX_CHARS = 20_000_000
#: Bytes of words stay, A-Z in lower case; all else is a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_built: dict[str, ahocorasick.Automaton] = {}


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


def windows(text: bytes | None, size: int = WINDOW) -> list[bytes]:
    w = words(text)
    return [b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []


def automaton(patterns: list[tuple[bytes, list[str]]]) -> ahocorasick.Automaton:
    """Each value is (number of words, length, items)."""
    a = ahocorasick.Automaton()
    for p, items in patterns:
        key = f" {p.decode('latin-1')} "
        a.add_word(key, (p.count(b" ") + 1, len(key), items))
    if patterns:
        a.make_automaton()
    return a


def scan(text: bytes | None, a: ahocorasick.Automaton) -> tuple[int, list[list[int]], set[str]]:
    """Number of words, merged [first, last] ranges of hit words, and the items found."""
    w = words(text)
    if not w or not len(a):
        return len(w), [], set()
    line = f" {b' '.join(w).decode('latin-1')} "
    spans: list[list[int]] = []
    items: set[str] = set()
    seen_to, last = 0, -1
    ends = []
    for end, (n, _, found) in a.iter(line):
        last += line.count(" ", seen_to, end)  # spaces before the end: the index of the word there
        seen_to = end
        ends.append((last - n + 1, last))
        items.update(found)
    for lo, hi in sorted(ends):
        if spans and lo <= spans[-1][1] + 1:
            spans[-1][1] = max(spans[-1][1], hi)
        else:
            spans.append([lo, hi])
    return len(w), spans, items


def char_spans(text: str, spans: list[list[int]]) -> list[list[int]]:
    """Ranges of characters in the original text for ranges of words."""
    raw = text.encode()
    at = [(m.start(), m.end()) for m in _WORD.finditer(raw)]
    return [[len(raw[: at[lo][0]].decode()), len(raw[: at[hi][1]].decode())] for lo, hi in spans]


def _union(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(a + b):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def _scan_rows(shared, key: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = _built.get(key)
        if a is None:
            _built.clear()
            a = _built[key] = automaton(shared.value)
        for batch in batches:
            names = batch.schema.names
            n, spans, chars, items = [], [], [], []
            for text, old, had in zip(texts(batch.column(names.index(text_col))), batch.column(names.index("__spans")).to_pylist(), batch.column(names.index("__items")).to_pylist(), strict=True):
                k, s, found = scan(text, a)
                n.append(k)
                spans.append(_union(old, s) if old else s)
                chars.append(char_spans(text.decode(), spans[-1]) if spans[-1] else [])
                items.append(sorted(found.union(had)))
            pairs = pa.list_(pa.list_(pa.int64()))
            new = {"__n_words": pa.array(n, pa.int64()), "__spans": pa.array(spans, pairs), "__chars": pa.array(chars, pairs), "__items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new.get(x, batch.column(i)) for i, x in enumerate(names)], names=names)

    return run


def _shards(benchmark: DataFrame, item_col: str, item_text: str, size: int, max_chars: int) -> Iterator[dict[bytes, list[str]]]:
    """Windows and the ids of their items, up to ``max_chars`` (but an item at least) at a time."""
    shard: dict[bytes, list[str]] = {}
    held = 0
    for row in benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(item_text).alias("t")).where("t is not null").distinct().orderBy("i", "t").toLocalIterator():
        own = dict.fromkeys(windows(row["t"].encode(), size))
        if held and held + sum(map(len, own)) > max_chars:
            yield shard
            shard, held = {}, 0
        for p in own:
            held += len(p)
            found = shard.setdefault(p, [])
            if row["i"] is not None and row["i"] not in found:
                found.append(row["i"])
    yield shard


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = WINDOW, max_chars: int = MAX_CHARS) -> DataFrame:
    """``docs`` with ``__n_words``, ``__spans`` (first and last word of each hit range), ``__chars`` (where it begins and ends in the text) and ``__items`` (sorted)."""
    nothing = F.array().cast("array<array<bigint>>")
    out = docs.withColumns({"__n_words": F.lit(0).cast("long"), "__spans": nothing, "__chars": nothing, "__items": F.array().cast("array<string>")})
    schema, last = out.schema, None
    for shard in _shards(benchmark, item_col, item_text, size, max_chars):
        if last is not None:
            out = cut(out)
            last.destroy()
        last = docs.sparkSession.sparkContext.broadcast(list(shard.items()))
        out = out.mapInArrow(_scan_rows(last, uuid.uuid4().hex, text_col), schema)
    return out


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document: what was hit, by which items, and where in the text the hits begin and end."""
    found = contamination(docs.select("doc_id", "text"), benchmark)
    hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0] + 1)
    return found.select("doc_id", F.col("__n_words").alias("n_words"), hit.alias("n_hit"), F.size("__items").cast("long").alias("n_items"), F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"), F.get(F.get("__chars", F.lit(0)), F.lit(0)).alias("first_char"), F.get(F.get("__chars", F.size("__chars") - 1), F.lit(1)).alias("end_char"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit, with their own columns."""
    return contamination(docs, benchmark).where(F.size("__spans") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
