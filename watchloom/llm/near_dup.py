"""Near-duplicate detection with SetSketch registers.

A register keeps the exponentially spaced, truncated minimum of one exponential hash over
a document's shingles: ``clip(floor(1 - log_b(min)), 0, 65535)`` with b = 1.001. Registers of
two documents agree nearly as often as their shingle sets overlap, and sketches merge by
maximum. Up to five registers make a band; so many bands are used that a pair at the threshold
shares none of them with a chance of 1e-8.

1. Documents with equal sets form a class; one row of each class goes on.
2. Within each bucket (a band's value) all members are held against the leader, the least one.
   The likelihood estimate drops the hopeless pairs, all others are compared on full sets. With t the
   threshold, a member is linked (similarity t or more), near (2t - 1 or more) or far.
3. Jaccard distance is a metric, so a far member can't link to a linked one, and two linked ones
   are connected by their leader. What is left in a bucket are pairs of members that aren't
   linked, and pairs of a near and a linked one. They are compared in blocks of ``block`` members:
   a task skips pairs that are connected already or whose likelihood estimate is six deviations below
   the threshold, and confirms the rest on full sets. A bucket of any size is dealt over pairs of
   blocks; none is capped.
4. Connected components of all confirmed links.

``near_duplicates`` gives a row for each input row. Null ids: ``component_id`` null, kept, linked with
nothing. Null, empty and wordless texts: 0 shingles, linked with nothing. Rows that repeat an
id are rows of their own, linked by their texts only. Other columns are ignored.

``keep_one`` drops rows: of each component one row stays, the first by id (rows without an id last) and
then by a hash of the text; of rows that repeat its id and text the least one by all columns stays. Rows without
shingles all stay. A row is told from others by id and text, so that an id which repeats with other texts loses
only the rows that copy something. Its other columns pass through and must be ones that can be ordered; the names
``__who``, ``__t`` and ``__row`` are taken. Very long texts are taken whole, a set of hashes each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, cut, fmix, shingle_sets, texts
from .components import components


@dataclass(frozen=True)
class SketchSpec:
    """``words`` a shingle; documents link where intersection / union >= percent / 100."""

    words: int = 5
    percent: int = 80
    most_rows: int = 5
    miss: float = 1e-8
    base: float = 1.001
    block: int = 512
    seed: int = 7

    def _bands(self, rows: int) -> int:
        return max(1, math.ceil(math.log(self.miss) / math.log1p(-min((self.percent / 100) ** rows, 1 - 1e-9))))

    @property
    def band_rows(self) -> int:
        """Registers a band; fewer where the threshold is so low that more than 120 bands would be needed."""
        return next((r for r in range(self.most_rows, 1, -1) if self._bands(r) <= 120), 1)

    @property
    def bands(self) -> int:
        return self._bands(self.band_rows)

    @property
    def registers(self) -> int:
        return self.bands * self.band_rows

    @property
    def near(self) -> float:
        """What is less similar than this to a leader can't link to a document that is linked to it."""
        return 2 * self.percent / 100 - 1

    def surely_below(self, t: float) -> float:
        """An estimate this low, six deviations under t, rules out a similarity of t."""
        return t - 6 * math.sqrt(max(t * (1 - t), 0.05) / self.registers)


def hash_family(spec: SketchSpec) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(spec.seed)
    return rng.integers(0, 1 << 63, spec.registers, dtype=np.uint64) * U64(2) + U64(1), rng.integers(0, 1 << 63, spec.registers, dtype=np.uint64)


def sketch(values: np.ndarray, spec: SketchSpec, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The registers of a set of 64-bit hashes."""
    mul, add = family
    least = np.full(len(mul), np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, len(values), 1024):
        np.minimum(least, (values[lo : lo + 1024, None] * mul + add).min(axis=0), out=least)
    u = (least.astype(np.float64) + 1.0) / 2.0**64
    h = -np.log1p(-np.minimum(u, 1 - 1e-16))
    return np.clip(np.floor(1 - np.log(h) / math.log(spec.base)), 0, 65535).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def joint_jaccard(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, base: float = 1.001) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from which registers are larger, smaller and equal.

    ``a`` and ``b`` have a row of registers for each pair; the set sizes are known. The
    log-likelihood is concave, so its slope is bisected between 0 and the largest possible value.
    """
    up, down = (a > b).sum(axis=1), (a < b).sum(axis=1)
    return jaccard_from_counts(up, down, a.shape[1] - up - down, n_a, n_b, base)


def jaccard_from_counts(up: np.ndarray, down: np.ndarray, same: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, base: float = 1.001) -> np.ndarray:
    """:func:`joint_jaccard` from how many registers of a are larger, smaller and equal."""
    n_a, n_b = np.asarray(n_a, float), np.asarray(n_b, float)
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    c = (base - 1) / base

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 1e-12, 1) * c) / math.log(base)

    def dp(x: np.ndarray) -> np.ndarray:
        return c / (1 - np.clip(x, 1e-12, 1) * c) / math.log(base)

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(20):
        j = (lo + hi) / 2
        x, y = u - v * j, v - u * j
        px, py = p(x), p(y)
        slope = -up * v * dp(x) / px - down * u * dp(y) / py + same * (v * dp(x) + u * dp(y)) / np.maximum(1 - px - py, 1e-12)
        rising = slope > 0
        lo, hi = np.where(rising, j, lo), np.where(rising, hi, j)
    return (lo + hi) / 2


def _sketch_rows(spec: SketchSpec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(spec)
        for batch in batches:
            sig, n, regs = [], [], []
            for s in shingle_sets(texts(batch.column(3)), spec.words):
                n.append(len(s))
                sig.append(_signature(s))
                regs.append(sketch(s, spec, family).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sig, pa.binary()), pa.array(n, pa.int64()), pa.array(regs, pa.binary())], names=["doc_id", "who", "t", "sig", "n", "regs"])

    return run


def _signature(s: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    with np.errstate(over="ignore"):
        return np.array([fmix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + U64(len(s)), fmix(s + U64(0x1234567812345679)).sum(dtype=np.uint64)], dtype=np.uint64).tobytes()


def _set_rows(spec: SketchSpec):
    """Texts of classes -> their sketches and full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(spec)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                sets = list(shingle_sets(texts(batch.column(1).slice(lo, 500)), spec.words))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 500), pa.array([sketch(s, spec, family).tobytes() for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cid", "regs", "set"])

    return run


def _band_rows(spec: SketchSpec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = fmix(np.arange(1, spec.bands + 1, dtype=np.uint64))
        for batch in batches:
            cid, regs = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            if not len(cid):
                continue
            r = np.frombuffer(b"".join(regs), dtype=np.uint16).reshape(len(cid), spec.bands, spec.band_rows).astype(np.uint64)
            key = np.broadcast_to(salt, r.shape[:2])
            for i in range(spec.band_rows):
                key = fmix(key * U64(0x9FB21C651E98DF25) + r[:, :, i])
            yield pa.RecordBatch.from_arrays([pa.array(((key >> U64(8)) | (np.arange(spec.bands, dtype=np.uint64) << U64(BAND_BITS))).view(np.int64).ravel()), pa.array(np.repeat(cid, spec.bands))], names=["bucket", "cid"])

    return run


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    return int((large[np.minimum(at, len(large) - 1)] == small).sum())


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact test on full sets, sorted and distinct."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    n = common(a, b)
    return 100 * n >= percent * (len(a) + len(b) - n)


FAR, NEAR, LINKED = 0, 1, 2
BAND_BITS = 56  # a bucket's number begins with its band


def _leader_rows(spec: SketchSpec):
    """Pairs with sketches and sets -> how near the member is to its leader, and their similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = spec.surely_below(spec.near)
        for batch in batches:
            if not batch.num_rows:
                continue
            regs_a, regs_b, set_a, set_b = (batch.column(i).to_pylist() for i in range(2, 6))
            ra, rb = (np.frombuffer(b"".join(x), dtype=np.uint16).reshape(len(x), -1) for x in (regs_a, regs_b))
            est = joint_jaccard(ra, rb, np.array([len(x) // 8 for x in set_a]), np.array([len(x) // 8 for x in set_b]), spec.base)
            role, sim = np.full(len(est), FAR, dtype=np.int32), np.zeros(len(est))
            for i in np.flatnonzero(est >= floor):
                x, y = np.frombuffer(set_a[i], dtype=np.uint64), np.frombuffer(set_b[i], dtype=np.uint64)
                n = common(x, y)
                sim[i] = n / (len(x) + len(y) - n)
                role[i] = LINKED if 100 * n >= spec.percent * (len(x) + len(y) - n) else NEAR if sim[i] >= spec.near - 1e-9 else FAR
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(role), pa.array(sim)], names=["leader", "cid", "role", "sim"])

    return run


def block_links(ids: list[int], roles: list[int], sims: list[float], regs: list[bytes], sets: list[bytes], side: list[int], spec: SketchSpec, band: int = 0) -> list[tuple[int, int]]:
    """Links among some members of a bucket, enough to connect all that belong together.

    Linked members are connected to each other by their leader. ``side`` is a member's block: where there are
    two, only pairs across them are compared. Pairs that share a band below ``band`` are left to that.
    """
    n = np.array([len(s) // 8 for s in sets])
    r = np.frombuffer(b"".join(regs), dtype=np.uint16).reshape(len(ids), -1)
    role, sim, of = np.array(roles), np.array(sims), np.array(side)
    comp = np.where(role == LINKED, -1, np.arange(len(ids)))
    left, right, same, up = [], [], [], []
    several = (of != of[0]).any()
    gap = 1 - spec.percent / 100
    for i in range(len(ids) - 1):
        js = np.arange(i + 1, len(ids))
        fits = (comp[js] != comp[i]) & (100 * np.minimum(n[js], n[i]) >= spec.percent * np.maximum(n[js], n[i]))
        if several:
            fits &= of[js] != of[i]
        mixed = (role[js] == LINKED) != (role[i] == LINKED)
        fits &= ~mixed | (np.minimum(role[js], role[i]) == NEAR) & (np.abs(sim[js] - sim[i]) <= gap + 1e-9)
        js = js[fits]
        if len(js):
            equal = (r[js] == r[i]).sum(axis=1)
            js, equal = js[keep := equal >= (spec.surely_below(spec.percent / 100) - 0.1) * r.shape[1]], equal[keep]
        if len(js) and band:
            first = (r[js, : band * spec.band_rows] == r[i, : band * spec.band_rows]).reshape(len(js), band, -1).all(axis=2).any(axis=1)
            js, equal = js[~first], equal[~first]
        if len(js):
            left.append(np.full(len(js), i))
            right.append(js)
            same.append(equal)
            up.append((r[i] > r[js]).sum(axis=1))
    if not left:
        return []
    left, right, same, up = (np.concatenate(x) for x in (left, right, same, up))
    est = jaccard_from_counts(up, r.shape[1] - up - same, same, n[left], n[right], spec.base)
    out = []
    for k in np.argsort(-est, kind="stable")[: int((est >= spec.surely_below(spec.percent / 100)).sum())]:
        i, j = left[k], right[k]
        if comp[i] != comp[j] and linked(np.frombuffer(sets[i], dtype=np.uint64), np.frombuffer(sets[j], dtype=np.uint64), spec.percent):
            comp[comp == comp[j]] = comp[i]
            out.append((ids[i], ids[j]))
    return out


def _block_rows(spec: SketchSpec):
    """Rows sorted by (bucket, x, y) -> links; a group of rows may span batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def flush() -> pa.RecordBatch:
            found = block_links(*(list(x) for x in zip(*rows, strict=True)), spec, key[0] >> BAND_BITS)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(9)]
            for row in zip(*cols, strict=True):
                if row[:3] != key:
                    if len(rows) > 1:
                        yield flush()
                    key, rows = row[:3], []
                rows.append(row[3:])
        if len(rows) > 1:
            yield flush()

    return run


LINKED_FROM = 1_000_000_000  # numbers of blocks of linked members begin here


def _keyed(id_col: str, text_col: str) -> list[Column]:
    """The id, and what tells a row from others: ``who`` and ``t``, a hash of the text."""
    doc_id, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    return [doc_id, F.coalesce(doc_id, F.lit(-1)), F.xxhash64(text, doc_id.isNull()), text]


def _find(docs: DataFrame, spec: SketchSpec, id_col: str, text_col: str, null_ids: bool) -> DataFrame:
    """``(doc_id, who, t, n, first)``, a row for each row of ``docs``.

    ``first`` is the component's first row ``(without id, doc_id, t)``; null for rows that take no part.
    """
    rows = docs.select(*[c.alias(n) for c, n in zip(_keyed(id_col, text_col), ("doc_id", "who", "t", "text"), strict=True)])
    sk = cut(rows.mapInArrow(_sketch_rows(spec), "doc_id long, who long, t long, sig binary, n long, regs binary"))
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t"))
    classes = sk.where("n > 0" if null_ids else "n > 0 and doc_id is not null").groupBy("sig").agg(one.alias("rep"), F.first("regs").alias("regs"))
    classes = cut(classes.withColumn("cid", F.monotonically_increasing_id()))

    bands = classes.select("cid", "regs").mapInArrow(_band_rows(spec), "bucket long, cid long")
    shared = bands.groupBy("bucket").agg(F.count("*").alias("k"), F.min("cid").alias("leader")).where("k > 1")
    members = cut(bands.join(shared, "bucket"))
    wanted = classes.join(members.select("cid").distinct(), "cid", "left_semi").select("cid", F.coalesce("rep.doc_id", F.lit(-1)).alias("who"), F.col("rep.t").alias("t"))
    # sorted by the join, so that rows which repeat id and text come down to one without another shuffle
    text = rows.select("who", "t", "text").join(wanted.hint("merge"), ["who", "t"]).groupBy("who", "t").agg(F.first("cid").alias("cid"), F.first("text").alias("text")).select("cid", "text")
    sets = cut(text.mapInArrow(_set_rows(spec), "cid long, regs binary, set binary"))

    pairs = members.where("cid <> leader").select("leader", "cid").distinct()
    left = sets.select(F.col("cid").alias("leader"), F.col("regs").alias("regs_a"), F.col("set").alias("set_a"))
    right = sets.select("cid", F.col("regs").alias("regs_b"), F.col("set").alias("set_b"))
    held = pairs.join(right, "cid").join(left, "leader").select("leader", "cid", "regs_a", "regs_b", "set_a", "set_b")
    held = cut(held.mapInArrow(_leader_rows(spec), "leader long, cid long, role int, sim double"))

    open_ = members.where("k > 2 and cid <> leader").select("bucket", "cid", "leader").join(held, ["leader", "cid"]).select("bucket", "cid", "role", "sim")
    open_ = cut(open_)
    rest, near, done = (F.count(F.when(c, 1)) for c in (F.col("role") != LINKED, F.col("role") == NEAR, F.col("role") == LINKED))
    todo = open_.groupBy("bucket").agg(rest.alias("rest"), near.alias("near"), done.alias("done"), F.sum(F.xxhash64("cid", "role").cast("decimal(38,0)")).alias("who")).where("rest > 1 or (near > 0 and done > 0)")
    todo = todo.groupBy("rest", "near", "done", "who").agg(F.min("bucket").alias("bucket"))  # of buckets with the same members the one of the least band does
    size = F.lit(spec.block)
    todo = todo.select("bucket", F.when((F.col("rest") > 1), F.col("rest")).otherwise(0).alias("rest"), F.ceil(F.col("rest") / size).cast("int").alias("parts"), F.when(F.col("near") > 0, F.ceil(F.col("done") / size)).otherwise(0).cast("int").alias("linked_parts"))
    open_ = open_.join(todo, "bucket").where(f"role <> {LINKED} or linked_parts > 0")
    side = F.when(F.col("role") == LINKED, F.lit(LINKED_FROM) + F.pmod(F.xxhash64("cid"), F.col("linked_parts"))).otherwise(F.pmod(F.xxhash64("cid"), F.col("parts"))).cast("int")

    def upto(n: str, start: int = 0):
        numbers = F.sequence(F.lit(start), F.lit(start) + F.greatest(F.col(n), F.lit(1)) - 1)
        return F.when(F.col(n) > 0, numbers).otherwise(F.array().cast("array<int>"))

    own = F.when(F.col("rest") > 1, upto("parts")).otherwise(F.array().cast("array<int>"))
    others = F.when(F.col("role") == LINKED, upto("parts")).when(F.col("role") == NEAR, F.concat(own, upto("linked_parts", LINKED_FROM))).otherwise(own)
    open_ = open_.withColumn("side", side).withColumn("other", F.explode(others))
    open_ = open_.select("bucket", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "cid", "role", "sim", "side")
    open_ = open_.join(sets, "cid").select("bucket", "x", "y", "cid", "role", "sim", "regs", "set", "side")
    more = open_.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y").mapInArrow(_block_rows(spec), "a long, b long")

    links = held.where(f"role = {LINKED}").select(F.col("leader").alias("a"), F.col("cid").alias("b")).union(more)
    label = components(links)
    final = classes.select("sig", "cid", "rep").join(label.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    least = final.groupBy("label").agg(F.min("rep").alias("first"))
    found = final.join(least, "label").select("sig", "first")
    return sk.select("doc_id", "who", "t", "sig", "n").join(found, "sig", "left").select("doc_id", "who", "t", "n", F.when((F.col("n") > 0) if null_ids else (F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("first")).alias("first"))


def near_duplicates(docs: DataFrame, spec: SketchSpec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, a row for each row of ``docs``."""
    out = _find(docs, spec, id_col, text_col, null_ids=False)
    component = F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, spec: SketchSpec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that copy another one nearly or wholly."""
    marks = _find(docs, spec, id_col, text_col, null_ids=True).where("first is not null")
    stays = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t") == F.col("first")
    gone = marks.groupBy("who", "t").agg(F.max(stays).alias("stays"), F.count("*").alias("k")).where("not stays or k > 1")
    gone = cut(gone.select(F.col("who").alias("__who"), F.col("t").alias("__t"), "stays"))
    _, who, t, _ = _keyed(id_col, text_col)
    same = (who == F.col("__who")) & (t == F.col("__t"))
    out = docs.join(gone.drop("stays"), same, "left_anti")
    again = gone.where("stays").drop("stays")
    if again.isEmpty():
        return out
    row = F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    ones = docs.join(again, same).groupBy("__who", "__t").agg(row.alias("__row"))
    return out.unionByName(ones.select("__row.*"))
