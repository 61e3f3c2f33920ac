"""Exact top-k inner products by norm-bucketed retrieval.

Components become ``floor(256 * x)``. Vectors are sorted by length and cut into buckets of
``bucket`` rows with similar lengths. A query's k-th best product so far, ``theta``, sets a
cosine that a vector of a bucket must reach: ``t = theta / (|q| * longest in bucket)``.

* t > 1: the bucket has nothing for this query.
* t >= ``focus_from``: coordinate pruning. On the query's largest coordinates a normalised
  vector with cosine t must lie within ``t*q_f -+ sqrt((1 - t^2)(1 - q_f^2))``.
* else: length pruning. Only the vectors with ``|v| >= theta / |q|`` are left, a prefix.

Candidates are verified by their integer products. ``theta`` starts from the two longest buckets, which are
broadcast, so that every task prunes from its first bucket on. Queries are packed in blocks of ``block`` rows.
Blocks against buckets are one plan: buckets are dealt into parts, blocks into groups of ``group``, and a tile
takes the blocks of a group, holds them, and lets the buckets of a part pass, longest first. A bucket is shuffled
once a group of blocks, a block once a part; no tile holds more than its group.

Vectors that are null, or hold null or non-finite components, take no part, nor do rows
without an id. As a query, an id that repeats counts once, with its least usable vector. Shorter vectors count as padded with zeros. Products of up to 2^53 in float64
BLAS, larger ones in Python integers; scores are clipped to 64 bits. Ties go to the smaller id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

FOCUS = 6
LEAST = np.iinfo(np.int64).min
FOUND = "query_id long, vec_id long, score long"


def quantise(vectors: list[list[float] | None]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the usable vectors and their integer components, padded with zeros."""
    usable, rows = [], []
    for i, v in enumerate(vectors):
        if v is None or any(x is None for x in v):
            continue
        x = np.array(v, dtype=np.float64)
        if np.isfinite(x).all():
            with np.errstate(over="ignore"):
                x = np.floor(256 * x)
            if np.isfinite(x).all():
                usable.append(i)
                rows.append(x)
    width = max(map(len, rows), default=0)
    out = np.zeros((len(rows), width))
    for i, x in enumerate(rows):
        out[i, : len(x)] = x
    return np.array(usable, dtype=np.int64), out


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of q with all rows of v."""
    w = max(q.shape[1], v.shape[1])
    q, v = (np.pad(x, ((0, 0), (0, w - x.shape[1]))) if x.shape[1] < w else x for x in (q, v))
    top = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(w, 1)
    if top < 2.0**53:
        return (q @ v.T).astype(np.int64)
    whole = np.array([[int(x) for x in row] for row in q], dtype=object).reshape(q.shape) @ np.array([[int(x) for x in row] for row in v], dtype=object).reshape(v.shape).T
    return np.clip(whole, LEAST, np.iinfo(np.int64).max).astype(np.int64)


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.score = np.full((len(ids), k), LEAST, dtype=np.int64)
        self.vec = np.full((len(ids), k), np.iinfo(np.int64).max, dtype=np.int64)
        self.have = np.zeros(len(ids), dtype=np.int64)

    def theta(self) -> np.ndarray:
        return np.where(self.have >= self.k, self.score[:, -1].astype(np.float64), -np.inf)

    def add(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        keep = ids != self.ids[i]
        if self.have[i] >= self.k:
            keep &= scores >= self.score[i, -1]
        ids, scores = ids[keep], scores[keep]
        if not len(ids):
            return
        n = self.have[i]
        all_ids, all_scores = np.concatenate([self.vec[i, :n], ids]), np.concatenate([self.score[i, :n], scores])
        if len(all_ids) > 4 * self.k:
            cut_at = np.partition(all_scores, len(all_scores) - self.k)[len(all_scores) - self.k]
            near = all_scores >= cut_at
            all_ids, all_scores = all_ids[near], all_scores[near]
        order = np.lexsort((all_ids, -all_scores))[: self.k]
        n = len(order)
        self.vec[i, :n], self.score[i, :n], self.have[i] = all_ids[order], all_scores[order], n

    def rows(self) -> list[tuple[int, int, int]]:
        return [(int(self.ids[i]), int(self.vec[i, j]), int(self.score[i, j])) for i in range(len(self.ids)) for j in range(self.have[i])]


def search(best: Best, q: np.ndarray, floor: np.ndarray, ids: np.ndarray, v: np.ndarray, focus_from: float = 0.6) -> None:
    """Take one bucket, longest vectors first, into ``best``. ``floor``: a score known to be reached k times."""
    q_len, v_len = np.sqrt((q**2).sum(axis=1)), np.sqrt((v**2).sum(axis=1))
    order = np.argsort(-v_len, kind="stable")
    ids, v, v_len = ids[order], v[order], v_len[order]
    theta = np.maximum(best.theta(), floor)
    slack = 1e-9
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(q_len * v_len[0] > 0, theta / (q_len * v_len[0]), np.where(theta > 0, np.inf, -np.inf))
    live = np.flatnonzero(local <= 1 + slack)
    by_length = live[(local[live] < focus_from)]
    if len(by_length):
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where((q_len[by_length] > 0) & (theta[by_length] > 0), theta[by_length] / q_len[by_length], 0) * (1 - slack)
        upto = np.searchsorted(-v_len, -need, side="right")
        got = products(q[by_length], v[: upto.max(initial=0)])
        for row, i, n in zip(got, by_length, upto, strict=True):
            if best.have[i] >= best.k or np.isfinite(floor[i]):
                at = np.flatnonzero(row[:n] >= theta[i] - abs(theta[i]) * 1e-12)
                best.add(i, ids[at], row[at])
            else:
                best.add(i, ids[:n], row[:n])
    unit = None
    for i in live[local[live] >= focus_from]:
        if unit is None:
            unit = v / np.maximum(v_len, 1e-300)[:, None]
        t = min(1.0, local[i])
        mine = q[i] / q_len[i]
        near = np.ones(len(ids), dtype=bool)
        for f in np.argsort(-np.abs(mine))[:FOCUS]:
            if f >= unit.shape[1]:
                continue
            half = np.sqrt(max(0.0, (1 - t * t) * (1 - mine[f] ** 2))) + 1e-7
            # cosine t or more: within half of t * q_f on the side that counts, and up to 1 beyond it
            low, high = (t * mine[f] - half, np.inf) if mine[f] >= 0 else (-np.inf, t * mine[f] + half)
            if abs(mine[f]) <= t:
                low, high = t * mine[f] - half, t * mine[f] + half
            near &= (unit[:, f] >= low) & (unit[:, f] <= high)
        at = np.flatnonzero(near)
        if len(at):
            best.add(i, ids[at], products(q[i : i + 1], v[at])[0])


def _pack_rows(bucket: int):
    """Rows sorted by length -> packed buckets of similar length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array(batch.column(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            usable, x = quantise(batch.column(1).to_pylist())
            ids = ids[usable]
            for lo in range(0, len(ids), bucket):
                own = np.ascontiguousarray(x[lo : lo + bucket])
                longest = float(np.sqrt((own**2).sum(axis=1)).max())
                yield pa.RecordBatch.from_arrays([pa.array([longest]), pa.array([own.shape[1]], pa.int32()), pa.array([ids[lo : lo + bucket].tobytes()], pa.binary()), pa.array([own.tobytes()], pa.binary())], names=["longest", "width", "ids", "x"])

    return run


PACKED = "longest double, width int, ids binary, x binary"


def _unpack(width: int, ids: bytes, x: bytes) -> tuple[np.ndarray, np.ndarray]:
    who = np.frombuffer(ids, dtype=np.int64)
    return who, np.frombuffer(x, dtype=np.float64).reshape(len(who), width)


def _floor_rows(shared, k: int):
    """Blocks of queries with the k-th best score of each query among the longest vectors, -inf where it has fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors = []
            for width, ids, x in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                who, q = _unpack(width, ids, x)
                first = Best(who, k)
                for row in shared.value:
                    search(first, q, np.full(len(who), -np.inf), *_unpack(*row))
                floors.append(first.theta().tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floors, pa.binary())], names=["longest", "width", "ids", "x", "floor"])

    return run


def _tile_rows(k: int):
    """Rows sorted by tile, blocks of queries before vectors -> the best of each query in each tile."""

    def found(held: list) -> Iterator[pa.RecordBatch]:
        for best, _, _ in held:
            if rows := best.rows():
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []
        for batch in batches:
            for part, group, vectors, _, width, ids, x, floor in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                if (part, group) != tile:
                    yield from found(held)
                    tile, held = (part, group), []
                who, values = _unpack(width, ids, x)
                if not vectors:
                    held.append((Best(who, k), values, np.frombuffer(floor, dtype=np.float64)))
                else:
                    for best, q, least in held:
                        search(best, q, least, who, values)
        yield from found(held)

    return run


TILED = ("part", "group", "vectors", "longest", "width", "ids", "x", "floor")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", bucket: int = 512, block: int = 1024, group: int = 16) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k best rows of ``vectors`` but its own id."""
    spark = vectors.sparkSession
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * 256 < float("inf")))

    def own(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & usable)

    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    dealt = own(vectors).withColumn("len", length).repartitionByRange(F.desc("len"), F.col("id")).sortWithinPartitions(F.desc("len"), F.col("id"))
    packed = cut(dealt.select("id", "v").mapInArrow(_pack_rows(bucket), PACKED))
    longest = spark.sparkContext.broadcast([(r.width, r.ids, r.x) for r in packed.orderBy(F.desc("longest"), "ids").limit(2).collect()])
    asked = own(queries).groupBy("id").agg(F.min("v").alias("v"))
    blocks = cut(asked.mapInArrow(_pack_rows(block), PACKED).mapInArrow(_floor_rows(longest, k), f"{PACKED}, floor binary"))
    parts = max(1, min(packed.count(), max(2 * spark.sparkContext.defaultParallelism, packed.count() // 64)))
    groups = max(1, -(-blocks.count() // group))
    one, of = F.pmod(F.xxhash64("ids"), F.lit(parts)), F.pmod(F.xxhash64("ids"), F.lit(groups))
    q = blocks.withColumns({"group": of, "vectors": F.lit(False), "part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>"))}).select(*TILED)
    v = packed.withColumns({"part": one, "vectors": F.lit(True), "floor": F.lit(None).cast("binary"), "group": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>"))}).select(*TILED)
    tiles = q.unionByName(v).repartition("part", "group").sortWithinPartitions("part", "group", "vectors", F.desc("longest"))
    found = tiles.mapInArrow(_tile_rows(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def report(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, embeddings.where("vec_id % 50 = 0"))
