"""Pieces that the operators of this subpackage share.

Words are runs of bytes outside ``[\\x20\\x09-\\x0D]`` after A-Z were lower-cased. All
hashing works on UTF-8 bytes, a megabyte of documents at a time, in numpy; a longer
document makes a chunk of its own, so that no text is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import cut, shared_dir

__all__ = ["Words", "chunks", "cut", "fmix", "held_out", "read", "shared_dir", "shingle_sets", "shingles", "texts"]

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
CHUNK_BYTES = 1 << 20
U64 = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACE)] = True

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_P = U64(0x9E3779B97F4A7C15)
_P_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id: str | Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the fold; false where there is no id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds == fold, F.lit(False))


def fmix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES * 2)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= CHUNK_BYTES * 4:
            _powers[name] = have
    return have[:n]


def texts(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def chunks(items: list[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of up to ``limit`` bytes together; a longer document comes alone."""
    lo, size = 0, 0
    for i, t in enumerate(items):
        n = len(t or b"") + 1
        if size and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(items):
        yield lo, len(items)


class Words:
    """The words of some documents: 64-bit hashes in order and each document's range of them."""

    def __init__(self, docs: list[bytes | None]):
        raw = np.frombuffer(b"\n" + b"\n".join(d or b"" for d in docs) + b"\n", dtype=np.uint8)
        self.data = LOWER[raw]
        space = IS_SPACE[self.data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        self.start, self.end = edge[0::2], edge[1::2]
        starts = np.cumsum([1] + [len(d or b"") + 1 for d in docs])
        self.bounds = np.searchsorted(self.start, starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        n = len(self.data)
        run = np.empty(n + 1, dtype=np.uint64)
        run[0] = 0
        np.cumsum(_BYTE[self.data] * _power("p", _P, n), out=run[1:])
        h = (run[self.end] - run[self.start]) * _power("q", _P_INV, n)[self.start]
        return fmix(h + (self.end - self.start).astype(np.uint64) * U64(0xD6E8FEB86659FD93))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words; those that cross documents are for the caller to leave out."""
    if len(h) < k:
        return h[:0]
    out = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for i in range(k):
        out = out * U64(0x9FB21C651E98DF25) + (h[i : len(h) - k + 1 + i] ^ U64(i + 1))
    return fmix(out)


def shingle_sets(docs: list[bytes | None], k: int) -> Iterator[np.ndarray]:
    """Each document's sorted distinct shingle hashes. Fewer words than k make one shingle; no words, none."""
    for lo, hi in chunks(docs):
        w = Words(docs[lo:hi])
        h = w.hashes()
        s = shingles(h, k)
        for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True):
            if b - a >= k:
                yield np.unique(s[a : b - k + 1])
            elif b > a:
                short = U64(b - a)
                for x in h[a:b]:
                    short = U64((int(short) * 0x9FB21C651E98DF25 + int(x)) & 0xFFFFFFFFFFFFFFFF)
                yield fmix(np.array([short], dtype=np.uint64))
            else:
                yield s[:0]
