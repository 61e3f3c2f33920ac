"""Token counts kept as delta-maintained rollups.

A batch is a table of signed document changes: ``op`` is ``insert``, ``delete`` or ``revise``, with
the text it adds (``text``) and, for deletes and revisions, the text it takes back (``old_text``).
Each change becomes at most two additive rows by (source, lang, tokenizer), +1 and -1 document with
their tokens. A batch is committed as one folder named after its id; Spark's committer renames
it into place and ``_SUCCESS`` marks it whole, so a retry of a committed batch does nothing and a
batch that failed half-way is written anew. Totals are sums over all committed folders.
``compact`` folds committed batches into one and records their ids. One writer at a time commits to a folder;
readers need no lock.

Tokenizer versions: ``words`` counts ``[^\\x20\\x09-\\x0D]+``; ``bytes`` counts UTF-8 bytes;
``bpe:<file>`` counts tokens of a public byte-level BPE whose ranks lie in the file. Ranks are
read on the driver (at most ``MAX_RANK_BYTES``) and broadcast.

Null texts count as empty, null sources and languages are groups of their own, other columns
are ignored. Repeated rows are changes of their own. An unknown op adds nothing. Very long texts are counted whole.
"""

from __future__ import annotations

import base64
import uuid
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, chunks, shared_dir, texts

BPE_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_RANK_BYTES = 64 << 20
#: The public split pattern of this byte-level BPE (fixed value).
BPE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
_encodings: dict[str, object] = {}


def rank_bytes(path: str) -> bytes:
    if Path(path).stat().st_size > MAX_RANK_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RANK_BYTES} bytes")
    return Path(path).read_bytes()


def encoding(name: str, ranks: bytes):
    import tiktoken

    if name not in _encodings:
        _encodings[name] = tiktoken.Encoding(name, pat_str=BPE_PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}, special_tokens={})
    return _encodings[name]


def count_tokens(docs: list[bytes | None], tokenizer: str, ranks: bytes | None = None) -> np.ndarray:
    if tokenizer == "bytes":
        return np.array([len(d or b"") for d in docs], dtype=np.int64)
    if tokenizer == "words":
        return np.concatenate([np.zeros(0, dtype=np.int64)] + [Words(docs[lo:hi]).counts() for lo, hi in chunks(docs)])
    enc = encoding(tokenizer, ranks or b"")
    out = np.zeros(len(docs), dtype=np.int64)
    for i, d in enumerate(docs):
        out[i] = len(enc.encode_ordinary(d.decode())) if d else 0
    return out


def _delta_rows(tokenizers: tuple[str, ...], shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list[int]] = defaultdict(lambda: [0, 0])
        for batch in batches:
            source, lang, op = (batch.column(i).to_pylist() for i in range(3))
            for column, sign, ops in ((3, 1, ("insert", "revise")), (4, -1, ("delete", "revise"))):
                at = [i for i, x in enumerate(op) if x in ops]
                if not at:
                    continue
                docs = texts(batch.column(column).take(pa.array(at, pa.int64())))
                for name in tokenizers:
                    for i, n in zip(at, count_tokens(docs, name, shared.value.get(name)).tolist(), strict=True):
                        s = sums[source[i], lang[i], name]
                        s[0] += sign
                        s[1] += sign * n
        if sums:
            keys = list(sums)
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], pa.string()) for i in range(3)] + [pa.array([sums[k][i] for k in keys], pa.int64()) for i in range(2)], names=["source", "lang", "tokenizer", "n_docs", "n_tokens"])

    return run


class TokenRollup:
    def __init__(self, spark: SparkSession, path: str | None = None, tokenizers: tuple[str, ...] = ("words", "bytes", f"bpe:{BPE_FILE}")):
        self.spark, self.tokenizers = spark, tokenizers
        self.path = path or f"{shared_dir(spark)}/token-rollup-{uuid.uuid4().hex}"
        self._ranks = spark.sparkContext.broadcast({t: rank_bytes(t[4:]) for t in tokenizers if t.startswith("bpe:")})

    def _fs(self):
        sc = self.spark.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(sc._jsc.hadoopConfiguration()), sc._jvm.org.apache.hadoop.fs.Path

    def deltas(self, changes: DataFrame) -> DataFrame:
        """Additive rows of a batch of ``(source, lang, op, text, old_text)``, one for each group."""
        rows = changes.select(*[F.col(c).cast("string").alias(c) for c in ("source", "lang", "op", "text", "old_text")])
        return rows.mapInArrow(_delta_rows(self.tokenizers, self._ranks), TOTALS).groupBy("source", "lang", "tokenizer").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def _folders(self) -> list[str]:
        fs, path = self._fs()
        names = [s.getPath().getName() for s in fs.listStatus(path(self.path))] if fs.exists(path(self.path)) else []
        return [n for n in names if fs.exists(path(f"{self.path}/{n}/_SUCCESS"))]

    def _merged(self) -> set[str]:
        """The ids of all batches that were folded into others."""
        return {r[0] for n in self._folders() if n.startswith("compacted-") for r in self.spark.read.text(f"{self.path}/{n}/_batches").toLocalIterator()}

    def _state(self) -> tuple[list[str], set[str]]:
        """The folders that count, and the ids of all batches in them."""
        done, merged = self._folders(), self._merged()
        return sorted(set(done) - merged), set(done) | merged

    def committed(self) -> set[str]:
        return self._state()[1]

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch; false if it is there already."""
        fs, path = self._fs()
        if fs.exists(path(f"{self.path}/{batch_id}/_SUCCESS")) or batch_id in self._merged():
            return False
        self.deltas(changes).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{batch_id}")
        return True

    def totals(self) -> DataFrame:
        names, _ = self._state()
        if not names:
            return self.spark.createDataFrame([], TOTALS)
        rows = self.spark.read.schema(TOTALS).parquet(*[f"{self.path}/{n}" for n in names])
        return rows.groupBy("source", "lang", "tokenizer").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> None:
        """Fold all batches into one folder that names them. Once it is in place they count no more; then they are deleted."""
        fs, path = self._fs()
        old, ids = self._state()
        if len(old) < 2:
            return
        name = f"compacted-{uuid.uuid4().hex}"
        at = f"{self.path}-{name}"
        self.totals().coalesce(1).write.parquet(at)
        self.spark.createDataFrame([(i,) for i in sorted(ids)], "id string").coalesce(1).write.text(f"{at}/_batches")
        if not fs.rename(path(at), path(f"{self.path}/{name}")):
            raise OSError(f"could not move {at} into place")
        for n in old:
            fs.delete(path(f"{self.path}/{n}"), True)


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))


def report(docs: DataFrame, batches: int = 3, tokenizers: tuple[str, ...] = ("words", "bytes", f"bpe:{BPE_FILE}")) -> DataFrame:
    """Totals of ``docs`` without blanks at either end and without documents that have no word.

    All documents come in as ``batches`` inserts; one batch revises texts with blanks at their ends, one deletes those
    that are empty then. A batch is committed a second time, and all are compacted, to no effect on the totals.
    """
    rollup = TokenRollup(docs.sparkSession, tokenizers=tokenizers)
    rows = docs.select("source", "lang", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("was"), F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("batch"))
    rows, none = rows.withColumn("now", trimmed(F.col("was"))), F.lit(None).cast("string")

    def change(where: str | Column, op: str, text: Column, old: Column) -> DataFrame:
        return rows.where(where).select("source", "lang", F.lit(op).alias("op"), text.alias("text"), old.alias("old_text"))

    for b in range(batches):
        rollup.commit(f"load-{b}", change(F.col("batch") == b, "insert", F.col("was"), none))
    rollup.commit("trim", change("now <> was", "revise", F.col("now"), F.col("was")))
    rollup.commit("trim", change("now <> was", "revise", F.col("now"), F.col("was")))
    rollup.commit("drop", change("now = ''", "delete", none, F.col("now")))
    rollup.compact()
    return rollup.totals()
