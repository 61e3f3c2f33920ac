"""Line deduplication over levelled sorted runs of line hashes.

A run holds line hashes (128 bits of xxh3) that no earlier run has: the hash, in how many documents of its
batches the line was found first, and the largest id of those. Runs are bucketed by the hash and sorted, so that
merging needs no shuffle of theirs. ``LineRuns.add`` takes a batch: its lines are merge-anti-joined with each
run; those that no run has become a run of level 0, those that some run has are written down as sightings with
their counts. Where a level has ``fanout`` runs they are merged into one of the next level.

Runs and sightings lie in a shared folder. A run's name tells its level and which batches it holds, and Spark's
``_SUCCESS`` marks it whole. The state is read from these names alone: a new session goes on where the last one
stopped, a batch that failed half-way is written anew, a batch that is there already adds nothing, and a run
whose batches a higher level holds doesn't count.

``fold`` feeds documents to the runs in batches and reads the result back: keys of at least
``min_chars`` code points found in at least ``min_docs`` documents lose all their lines except
in the largest id that holds them. Only documents that may lose a line are shuffled: a bit map of fixed size over
hashed ids, broadcast, lets the others pass.

Null and empty texts have one empty line. Rows that repeat an id are one document for the counts, and each of them
loses or keeps lines like the others. Rows without an id are one document too, that comes before all others.
Very long texts are taken whole, line by line. Empty tables give empty results. Other columns pass through; the
names ``__text``, ``__drop``, ``__n_lines``, ``__n_dropped``, ``__id``, ``__word`` and ``__bit`` are taken.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, cut, shared_dir, texts

MIN_CHARS, MIN_DOCS = 20, 3
FANOUT = 3
PIECE_ROWS = 512
SALTS = 16
BUCKET_ROWS = 1_000_000  # rows of lines for a bucket of the runs
BITS = 1 << 24  # of the map of documents that may lose lines, at most 2^18 rows
RUN = "key binary, n_docs long, max_id long"
LINES = "doc_id long, key binary"
_CONT = bytes(range(128, 192))


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()  # bytes.lower() changes A-Z only


def code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.translate(None, _CONT))


def digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``PIECE_ROWS`` rows at most, so that a worker holds the lines of few documents."""
    for batch in batches:
        for lo in range(0, batch.num_rows, PIECE_ROWS):
            yield batch.slice(lo, PIECE_ROWS)


def _line_rows(min_chars: int):
    """Each document's distinct line hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                own = {digest(k) for k in map(line_key, (text or b"").split(b"\n")) if len(k) >= min_chars and code_points(k) >= min_chars}
                ids += [doc_id] * len(own)
                keys += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], names=["doc_id", "key"])

    return run


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_line_rows(min_chars), LINES)


class LineRuns:
    """Runs of ``(key, n_docs, max_id)`` by level and sightings of their keys, kept under ``path``."""

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = FANOUT, buckets: int = 8):
        self.spark, self.fanout = spark, fanout
        self.path = path or f"{shared_dir(spark)}/line-runs-{uuid.uuid4().hex}"
        there = [n for n in self._list("") if n.startswith("runs-")]
        self.buckets = int(there[0][5:]) if there else buckets  # a store keeps the buckets it began with
        self.at = f"{self.path}/runs-{self.buckets}"
        self._tables: dict[str, str] = {}

    def _fs(self):
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        return jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(conf), jvm.org.apache.hadoop.fs.Path

    def _list(self, sub: str, whole: bool = False) -> list[str]:
        fs, path = self._fs()
        at = path(f"{self.path}/{sub}" if sub else self.path)
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(n for n in names if not whole or fs.exists(path(f"{self.path}/{sub}/{n}/_SUCCESS")))

    def runs(self) -> list[tuple[int, int, int]]:
        """(level, first batch, last batch) of the runs that count."""
        every = [tuple(map(int, n.split("-"))) for n in self._list(f"runs-{self.buckets}", whole=True)]
        return sorted((r for r in every if not any(o[0] > r[0] and o[1] <= r[1] and r[2] <= o[2] for o in every)), key=lambda r: r[1])

    def next_batch(self) -> int:
        return max((last + 1 for _, _, last in self.runs()), default=0)

    def _table(self, name: str) -> str:
        if name not in self._tables:
            table = f"watchloom_run_{uuid.uuid4().hex}"
            self.spark.sql(f"create table {table} (key binary, n_docs bigint, max_id bigint) using parquet clustered by (key) sorted by (key) into {self.buckets} buckets location '{self.at}/{name}'")
            self._tables[name] = table
        return self._tables[name]

    def _run(self, run: tuple[int, int, int]) -> DataFrame:
        return self.spark.table(self._table("-".join(map(str, run))))

    def _write(self, rows: DataFrame, run: tuple[int, int, int]) -> None:
        name = "-".join(map(str, run))
        table = f"watchloom_run_{uuid.uuid4().hex}"
        by_bucket = rows.repartitionById(self.buckets, F.pmod(F.hash("key"), F.lit(self.buckets)))  # one file a bucket, however rows were dealt before
        by_bucket.write.mode("overwrite").format("parquet").option("path", f"{self.at}/{name}").bucketBy(self.buckets, "key").sortBy("key").saveAsTable(table)
        self._tables[name] = table

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The batch's rows whose ``key`` no run has yet."""
        for run in self.runs():
            batch = batch.join(self._run(run).select("key"), "key", "left_anti")
        return batch

    def seen(self, batch: DataFrame) -> DataFrame:
        """The batch's rows whose ``key`` a run has; no two runs have the same."""
        found = batch.limit(0)
        for run in self.runs():
            found = found.union(batch.join(self._run(run).select("key"), "key", "left_semi"))
        return found

    def add(self, batch: DataFrame, number: int | None = None) -> bool:
        """Add batch ``number`` (the next one) of different ``(doc_id, key)`` rows; false if it is there already.

        No document may be in two batches. The sightings are written first, the run commits the batch.
        """
        number = self.next_batch() if number is None else number
        if number < self.next_batch():
            return False
        own = cut(batch.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_id")).repartition(self.buckets, "key"))
        self.seen(own).write.mode("overwrite").parquet(f"{self.path}/sightings/{number}")
        self._write(self.unseen(own), (0, number, number))
        self.compact()
        return True

    def compact(self) -> None:
        level = 0
        while level <= max((r[0] for r in self.runs()), default=-1):
            old = [r for r in self.runs() if r[0] == level]
            if len(old) >= self.fanout:
                rows = self._run(old[0])
                for r in old[1:]:
                    rows = rows.union(self._run(r))
                self._write(rows, (level + 1, old[0][1], old[-1][2]))
                for r in old:
                    self._drop("-".join(map(str, r)))
            level += 1

    def _drop(self, name: str) -> None:
        if table := self._tables.pop(name, None):
            self.spark.sql(f"drop table if exists {table}")
        fs, path = self._fs()
        fs.delete(path(f"{self.at}/{name}"), True)

    def entries(self) -> DataFrame:
        """``(key, n_docs, max_id)`` over all batches."""
        runs, n = self.runs(), self.next_batch()
        if not runs:
            return self.spark.createDataFrame([], RUN)
        rows = self._run(runs[0])
        for r in runs[1:]:
            rows = rows.union(self._run(r))
        later = self.spark.read.schema(RUN).parquet(*[f"{self.path}/sightings/{k}" for k in range(n)])
        later = later.groupBy("key").agg(F.sum("n_docs").alias("more"), F.max("max_id").alias("later"))
        return rows.join(later, "key", "left").select("key", (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs"), F.greatest("max_id", "later").alias("max_id"))

    def forget(self) -> None:
        """Delete the folder and its tables."""
        for table in self._tables.values():
            self.spark.sql(f"drop table if exists {table}")
        self._tables = {}
        fs, path = self._fs()
        fs.delete(path(self.path), True)


def buckets_for(spark: SparkSession, rows: int) -> int:
    """A bucket for each ``BUCKET_ROWS``, as far as Spark's catalogue takes them; beyond that buckets grow, and the sorts that merge them spill."""
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(8, -(-rows // BUCKET_ROWS)))


def dropped_keys(found: DataFrame, runs: LineRuns, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(doc_id, __drop)``: the line hashes that a document loses, as one array of 16-byte values.

    A line that a third of all documents share is dealt over ``SALTS`` tasks; the lines to drop are repeated as often.
    """
    common = runs.entries().where(F.col("n_docs") >= min_docs).select("key", "max_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    own = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    lost = own.join(common, ["key", "salt"]).where(~F.col("doc_id").eqNullSafe(F.col("max_id")))
    return lost.groupBy("doc_id").agg(F.collect_set("key").alias("__drop"))


def bit_map(ids: DataFrame, bits: int = BITS) -> DataFrame:
    """``(__word, __bits)``: which hashes of ``ids(doc_id)`` occur, 64 to a row; at most ``bits / 64`` rows."""
    at = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    return ids.select(F.shiftright(at, 6).alias("__word"), (at % 64).cast("int").alias("i")).groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("__bits"))


def _rewrite_rows(at_text: int, at_drop: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out, n_lines, n_dropped = [], [], []
            for text, drop in zip(texts(batch.column(at_text)), batch.column(at_drop).to_pylist(), strict=True):
                own = (text or b"").split(b"\n")
                n_lines.append(len(own))
                if drop:
                    lost = set(drop)
                    kept = [x for x in own if len(k := line_key(x)) < min_chars or digest(k) not in lost]
                    n_dropped.append(len(own) - len(kept))
                    out.append(b"\n".join(kept))
                else:
                    n_dropped.append(0)
                    out.append(text or b"")
            cols = [batch.column(i) for i in range(batch.num_columns) if i not in (at_text, at_drop)]
            names = [x for i, x in enumerate(batch.schema.names) if i not in (at_text, at_drop)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(out, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*names, "__text", "__n_lines", "__n_dropped"])

    return run


def fold(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 4, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, fanout: int = FANOUT, bits: int = BITS) -> DataFrame:
    """``docs`` with its text in ``__text`` after lines were dropped, ``__n_lines`` before and ``__n_dropped``."""
    spark = docs.sparkSession
    at = f"{shared_dir(spark)}/lines-{uuid.uuid4().hex}"
    lines(docs, id_col, text_col, min_chars).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches))).write.partitionBy("batch").parquet(f"{at}/found")
    found = spark.read.schema("doc_id long, key binary, batch int").parquet(f"{at}/found")
    runs = LineRuns(spark, f"{at}/runs", fanout, buckets=buckets_for(spark, found.count()))
    for b in range(batches):
        runs.add(found.where(F.col("batch") == b).select("doc_id", "key").distinct(), b)
    lost = cut(dropped_keys(found.select("doc_id", "key").distinct(), runs, min_docs).withColumnRenamed("doc_id", "__id"))
    runs.forget()
    _forget(spark, at)
    named = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != text_col], F.col(f"`{text_col}`").cast("string").alias("__text"))
    key = F.col(f"`{id_col}`").cast("long")
    hashed = F.pmod(F.xxhash64(key), F.lit(bits))
    may = F.broadcast(bit_map(lost.select(F.col("__id").alias("doc_id")), bits))
    marked = named.join(may, F.shiftright(hashed, 6) == F.col("__word"), "left").withColumn("__bit", F.coalesce(F.col("__bits").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (hashed % 64).cast("int"))) != 0, F.lit(False))).drop("__word", "__bits")
    clean = marked.where("not __bit").drop("__bit").withColumn("__drop", F.lit(None).cast("array<binary>"))
    joined = clean.unionByName(marked.where("__bit").drop("__bit").join(lost, key.eqNullSafe(F.col("__id")), "left").drop("__id"))
    names = joined.columns
    rest = [f for f in joined.schema if f.name not in ("__text", "__drop")]
    schema = T.StructType([*rest, T.StructField("__text", T.StringType()), T.StructField("__n_lines", T.LongType()), T.StructField("__n_dropped", T.LongType())])
    return joined.mapInArrow(_rewrite_rows(names.index("__text"), names.index("__drop"), min_chars), schema)


def _forget(spark: SparkSession, at: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def report(docs: DataFrame) -> DataFrame:
    found = fold(docs.select("doc_id", "text"))
    return found.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2("__text", 256).alias("kept_sha256"))
