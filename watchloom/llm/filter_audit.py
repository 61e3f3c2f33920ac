"""What each of five quality filters removes, alone and behind the others, in every order of the five.

A document fails A with fewer than 50 words, B where less than 65 % of its words are different, C where more
than 5 % of its code points are ``[A-Z]``, D where it holds one of ``#$%&*|``, and E where a smaller id has
the same text. Words are runs outside ``[\\x20\\x09-\\x0D]``, case kept.

E is a fingerprint-routed RDD. Documents go by the xxhash of their text to a partition, where a chain for each
fingerprint holds the full texts that share it, each with its least id; whoever isn't the least is emitted. Before
anything moves, each task does the same to its own rows, at most ``HELD_BYTES`` of text at a time: its later copies are
settled there and then travel without their text, dealt by their id, and only the least copy of each text is routed. A text that a third of
all rows hold so moves once a task. Partitions are sorted by (fingerprint, id) outside memory, so that a
task holds the chain of one fingerprint only.

The masks of failed filters (32) by the two labels make a vector of 128 counts; ``combineByKey`` merges the vectors
of each part. All orders follow from its vector, in the task that has it.

Null texts are empty; empty texts are copies of each other. Rows without an id are never copies of anything and make
nothing a copy. Rows that repeat id and text are no copies of each other; rows that repeat an id with another text
are documents of their own. A null source is the part ''. Labels that repeat count once, 1 over 0; labels of no document count
nowhere. Very long texts are taken whole. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
HELD_BYTES = 64 << 20
ROUTED_BYTES = 32 << 20
UPPER = bytes(range(65, 91))
MARKS = frozenset(b"#$%&*|")
ROWS = "doc_id long, part string, mask int, n long"
REPORT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failures(text: str) -> int:
    """The filters A to D that a text fails, a bit each."""
    raw = text.encode()
    words = raw.split()  # bytes are split at these six characters only
    upper = len(raw) - len(raw.translate(None, UPPER))
    failed = (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * upper > 5 * len(text), not MARKS.isdisjoint(raw))
    return sum(1 << i for i, x in enumerate(failed) if x)


def fingerprint(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text)


def _route(held_bytes: int):
    """Rows ``(id, text, part)`` -> ``((where, id), (text or None, parts, mask))``; a None text is settled."""

    def settled(doc_id: int | None, parts: dict[str, int], mask: int):
        where = xxhash.xxh3_64_intdigest(str(doc_id).encode() + next(iter(parts)).encode())
        return (where, 0), (None, doc_id, parts, mask)

    def run(rows: Iterator) -> Iterator:
        chains: dict[int, list[list]] = {}
        nameless: Counter = Counter()
        held = 0
        for doc_id, text, part in rows:
            text = text or ""
            mask = failures(text)
            if doc_id is None:
                nameless[part, mask] += 1
                continue
            raw = text.encode()
            chain = chains.setdefault(fingerprint(raw), [])
            own = next((x for x in chain if x[0] == raw), None)
            if own is None:
                chain.append([raw, doc_id, {part: 1}, mask])
                held += len(raw) + 200
            elif doc_id > own[1]:
                yield settled(doc_id, {part: 1}, mask | COPY)
            elif doc_id == own[1]:
                own[2][part] = own[2].get(part, 0) + 1
            else:
                yield settled(own[1], own[2], mask | COPY)
                own[1:3] = doc_id, {part: 1}
            if held > held_bytes:
                yield from (((h, x[1]), tuple(x)) for h, chain in chains.items() for x in chain)
                chains, held = {}, 0
        yield from (((h, x[1]), tuple(x)) for h, chain in chains.items() for x in chain)
        yield from (settled(None, {part: n}, mask) for (part, mask), n in nameless.items())

    return run


def _resolve(rows: Iterator) -> Iterator[tuple[int | None, str, int, int]]:
    """Rows sorted by (fingerprint, id) -> ``(id, part, mask, n)``."""
    at, chain = None, {}
    for (where, _), (text, doc_id, parts, mask) in rows:
        if text is not None:
            if where != at:
                at, chain = where, {}
            if doc_id > chain.setdefault(text, doc_id):
                mask |= COPY
        yield from ((doc_id, part, mask, n) for part, n in parts.items())


def partitions(docs: DataFrame, size: int = ROUTED_BYTES) -> int:
    """How many partitions the texts are routed to, so that each gets about ``size`` bytes of text at most."""
    return 1 + (docs.agg(F.sum(F.octet_length(F.col("text").cast("string")).cast("long"))).first()[0] or 0) // size


def flagged(docs: DataFrame, held_bytes: int = HELD_BYTES) -> DataFrame:
    """``(doc_id, part, mask, n)``: the filters that ``n`` equal rows fail, a bit each."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce(F.col("source").cast("string"), F.lit(""))).rdd
    n = max(partitions(docs), int(spark.conf.get("spark.sql.shuffle.partitions")))
    out = rows.mapPartitions(_route(held_bytes)).repartitionAndSortWithinPartitions(n, lambda key: key[0]).mapPartitions(_resolve)
    return spark.createDataFrame(out, ROWS, verifySchema=False)


def later_copies(docs: DataFrame) -> DataFrame:
    """The ids of documents whose text a smaller id has."""
    return flagged(docs).where(F.col("mask").bitwiseAND(F.lit(COPY)) != 0).select("doc_id")


def count_vectors(flags: DataFrame, labels: DataFrame) -> RDD:
    """``(part, vector)``: counts by mask, label quality = 1 and label toxic = 1, the last fastest."""
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int"))
    y = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(one("quality").alias("q"), one("toxic").alias("t"))
    at = F.col("mask") * 4 + F.coalesce("q", F.lit(0)) * 2 + F.coalesce("t", F.lit(0))
    rows = flags.join(y, flags["doc_id"] == y["id"], "left").select("part", at.alias("at"), "n").rdd

    def add(v: np.ndarray, x: tuple[int, int]) -> np.ndarray:
        v[x[0]] += x[1]
        return v

    return rows.map(lambda r: (r[0], (r[1], r[2]))).combineByKey(lambda x: add(np.zeros(128, dtype=np.int64), x), add, np.add)


def orders(item: tuple[str, np.ndarray]) -> Iterator[tuple]:
    """The rows of one part: each order of the filters, each step."""
    part, counts = item[0], item[1].reshape(32, 2, 2)
    every, good, toxic = counts.sum((1, 2)), counts[:, 1].sum(1), counts[:, :, 1].sum(1)
    mask = np.arange(32)
    out, total = [], Counter()
    for order in permutations(FILTERS):
        before = 0
        for step, f in enumerate(order, 1):
            bit = 1 << FILTERS.index(f)
            fails, gone = mask & bit != 0, mask & before != 0
            lost = fails & ~gone
            out.append((f, (part, "".join(order), step, every[~fails & ~gone].sum(), every[lost].sum(), every[fails & gone].sum(), every[bit], good[lost].sum(), toxic[lost].sum())))
            total[f] += int(every[lost].sum())
            before |= bit
    for f, row in out:
        yield (*row[:3], *map(int, row[3:]), total[f])


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame(count_vectors(flagged(docs), labels).flatMap(orders), REPORT, verifySchema=False)
