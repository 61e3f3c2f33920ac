"""Nearest vectors by cosine: all queries against all vectors, in blocks of matrix products.

Rows are packed in blocks. Blocks of queries are dealt into groups of at most ``HELD`` bytes, blocks of vectors into parts, and a tile takes the
queries of a group, holds them, and lets the vectors of a part pass. So a task holds one group, one block and their products, whatever the number of rows;
vectors are shuffled once a group, queries once a part.

A product of unit vectors says which pairs can be among a query's best; only those get their cosine, summed in the order of the components as ``cosine`` does.
Cosines are compared to ``DIGITS`` digits, ties go to the smaller id. A cosine that is not a number (a vector of zeros) is the greatest,
a missing one (a null, vectors of different length) the least. Rows without an id take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 9
UNIT = 10.0**DIGITS
QUERIES, VECTORS = 1024, 4096  # rows of a block
HELD = 32 << 20
PAIRS = 200_000  # pairs whose cosines are computed at once
PACKED = "width int, least long, ids binary, x binary"
FOUND = "query_id long, vec_id long, mark double, cosine double"


def _pack(rows: int):
    """Rows of id and vector -> blocks of one length; a vector that is null or holds one has the length 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(1)
            width = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).copy()
            flat = vectors.flatten()
            if flat.null_count:
                width[np.unique(pc.list_parent_indices(vectors).to_numpy()[flat.is_null().to_numpy(zero_copy_only=False)])] = 0
            for w in np.unique(width):
                of = np.flatnonzero(width == w)
                for lo in range(0, len(of), rows):
                    at = of[lo : lo + rows]
                    x = vectors.take(pa.array(at)).flatten().to_numpy().tobytes() if w else b""
                    yield pa.RecordBatch.from_arrays([pa.array([w], pa.int32()), pa.array([ids[at].min()]), pa.array([ids[at].tobytes()], pa.binary()), pa.array([x], pa.binary())], names=["width", "least", "ids", "x"])

    return run


class Block:
    def __init__(self, width: int, ids: bytes, x: bytes):
        self.ids = np.frombuffer(ids, dtype=np.int64)
        x = np.frombuffer(x, dtype=np.float64).reshape(len(self.ids), width)
        with np.errstate(all="ignore"):  # a power of two changes no digit of a cosine and keeps squares from overflowing
            x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])
            self.columns = np.ascontiguousarray(x.T)
            self.square = np.zeros(len(x))
            for c in self.columns:
                self.square += c * c
            self.unit = x / np.sqrt(self.square)[:, None]
        self.odd = ~np.isfinite(self.unit).all(axis=1)
        self.unit[self.odd] = 0


class Best:
    """The k best of each query of a block so far: cosines rounded as marks, ids, cosines."""

    def __init__(self, queries: Block, k: int):
        self.q, self.k = queries, k
        n = len(queries.ids)
        self.have, self.mark = np.zeros(n, dtype=np.int64), np.full((n, k), -np.inf)
        self.vec, self.cosine = np.full((n, k), np.iinfo(np.int64).max), np.full((n, k), np.nan)

    def search(self, v: Block) -> None:
        q = self.q
        if len(q.columns) != len(v.columns) or not len(q.columns):
            return self._take(*self._none(v))
        about = q.unit @ v.unit.T
        about[q.odd], about[:, v.odd] = np.inf, np.inf
        own = np.isin(q.ids, v.ids)
        about[own] = np.where(q.ids[own, None] == v.ids, -np.inf, about[own])
        least, worst = self.mark[:, -1].copy(), self.vec[:, -1].copy()
        few = np.flatnonzero(self.have < self.k)
        least[few] = -np.inf
        if len(few) and len(v.ids) > self.k:  # as good as the k-th of this block
            some = np.partition(about[few], len(v.ids) - self.k, axis=1)[:, len(v.ids) - self.k]
            least[few], worst[few] = some * UNIT - 1, np.iinfo(np.int64).max
        # half a digit below the k-th mark is below it, half a digit above it is beyond it: between them the id decides
        low, high = (least - 0.5) / UNIT - 1e-12, (least + 0.5) / UNIT - 1e-12
        i, j = np.nonzero(about >= low[:, None])
        keep = (about[i, j] > -np.inf) & ((about[i, j] >= high[i]) | (v.ids[j] < worst[i]))
        i, j = i[keep], j[keep]
        for lo in range(0, len(i), PAIRS):
            a, b = i[lo : lo + PAIRS], j[lo : lo + PAIRS]
            dot = np.zeros(len(a))
            with np.errstate(all="ignore"):
                for x, y in zip(q.columns, v.columns, strict=True):
                    dot += x[a] * y[b]
                cosine = dot / np.sqrt(q.square[a] * v.square[b])
                scaled = cosine * UNIT
                whole = np.trunc(scaled)
                mark = np.where(np.isnan(cosine), np.inf, whole + np.where(np.abs(scaled - whole) >= 0.5, np.sign(scaled), 0))
            self._take(a, v.ids[b], mark, cosine)

    def _none(self, v: Block) -> tuple[np.ndarray, ...]:
        """Pairs that have no cosine, as far as they can count: the smallest ids."""
        ids = np.sort(v.ids)
        each = [ids[ids != own][: self.k] for own in self.q.ids]
        at = np.repeat(np.arange(len(each)), [len(x) for x in each])
        return at, np.concatenate(each), np.full(len(at), -np.inf), np.full(len(at), np.nan)

    def _take(self, at: np.ndarray, vec: np.ndarray, mark: np.ndarray, cosine: np.ndarray) -> None:
        if not len(at):
            return
        mine = np.unique(at)
        held = np.arange(self.k) < self.have[mine, None]
        at = np.concatenate([at, np.repeat(mine, self.have[mine])])
        vec, mark, cosine = (np.concatenate([new, old[mine][held]]) for new, old in ((vec, self.vec), (mark, self.mark), (cosine, self.cosine)))
        order = np.lexsort((vec, -mark, at))
        at = at[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        top = rank < self.k
        at, rank, order = at[top], rank[top], order[top]
        self.vec[at, rank], self.mark[at, rank], self.cosine[at, rank] = vec[order], mark[order], cosine[order]
        self.have[mine] = np.bincount(at, minlength=len(self.have))[mine]

    def rows(self) -> pa.RecordBatch:
        i, j = np.nonzero(np.arange(self.k) < self.have[:, None])
        mark = self.mark[i, j]
        return pa.RecordBatch.from_arrays([pa.array(self.q.ids[i]), pa.array(self.vec[i, j]), pa.array(mark), pa.array(self.cosine[i, j], mask=mark == -np.inf)], names=["query_id", "vec_id", "mark", "cosine"])


def _tiles(k: int):
    """Rows sorted by tile, blocks of queries before vectors -> the best of each query in each tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                part, group, vectors, _, width, ids, x = (c[row].as_py() for c in batch.columns)
                if (part, group) != tile:
                    yield from (b.rows() for b in held)
                    tile, held = (part, group), []
                block = Block(width, ids, x)
                if not vectors:
                    held.append(Best(block, k))
                else:
                    for b in held:
                        b.search(block)
        yield from (b.rows() for b in held)

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, cosine)``: each query's k nearest rows of ``vectors`` but its own id."""

    def packed(df: DataFrame, rows: int) -> DataFrame:
        own = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
        return own.mapInArrow(_pack(rows), PACKED)

    asked, width = queries.agg(F.count("*"), F.coalesce(F.max(F.size(vec_col)), F.lit(1))).first()
    parts = max(1, min(-(-vectors.count() // VECTORS), 4 * vectors.sparkSession.sparkContext.defaultParallelism))
    groups = max(1, -(-asked * 8 * max(width, 1) // HELD))
    one, of = F.pmod(F.xxhash64("ids"), F.lit(parts)), F.pmod(F.xxhash64("ids"), F.lit(groups))

    def each(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))

    columns = ("part", "group", "vectors", "least", "width", "ids", "x")
    q = packed(queries, QUERIES).withColumns({"group": of, "vectors": F.lit(False), "part": each(parts)}).select(*columns)
    v = packed(vectors, VECTORS).withColumns({"part": one, "vectors": F.lit(True), "group": each(groups)}).select(*columns)
    tiles = q.unionByName(v).repartition(parts * groups, "part", "group").sortWithinPartitions("part", "group", "vectors", "least")
    order = Window.partitionBy("query_id").orderBy(F.desc("mark"), "vec_id")
    found = tiles.mapInArrow(_tiles(k), FOUND).withColumn("rank", F.row_number().over(order))
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "cosine")
