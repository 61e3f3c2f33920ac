"""Incremental change capture: the state of a list in hash buckets, with a log of changes.

The state is a table of (key, list) with name and payload hash, in buckets of the key's hash. A new snapshot is compared with the state bucket by
bucket: both sides' buckets have digests (counts and sums of row hashes), and only buckets whose digests differ are read, joined and
written. Their changes go to the log, and their rows after the change to files of this version; a bucket's newest version is its state, so reading
merges by picking files, and files of untouched buckets aren't rewritten or even opened.

A version is a folder; its commit file, written last, names the buckets that it holds. What was interrupted is written anew under the same number, and a version that is
there already adds nothing. ``compact`` copies the newest files of all buckets into one version and leaves the log as it is.

Names that are null or blank are left out; of repeated keys the last by ``order`` counts, ties by hash and name. An empty snapshot removes everything.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .changes import keyed

STATE = "key string, source_list string, name string, h string"
LOG = "change_type string, entity_name string, source_list string, version long"


class ListState:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path
        commits = self._commits()
        self.buckets = commits[min(commits)]["of"] if commits else buckets  # a state keeps the buckets it began with

    def _fs(self):
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        return jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(conf), jvm.org.apache.hadoop.fs.Path

    def _commits(self) -> dict[int, dict]:
        fs, path = self._fs()
        at = path(f"{self.path}/commits")
        if not fs.exists(at):
            return {}
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        rows = self.spark.read.option("wholetext", True).text(f"{self.path}/commits").collect() if names else []  # a row a version
        return {c["version"]: c for c in (json.loads(r["value"]) for r in rows)}

    def _commit(self, version: int, buckets: list[int], kind: str) -> None:
        fs, path = self._fs()
        out = fs.create(path(f"{self.path}/commits/{version}-{kind}.json"), True)
        out.write(bytearray(json.dumps({"version": version, "of": self.buckets, "buckets": buckets, "kind": kind}).encode()))
        out.close()

    def newest(self) -> dict[int, int]:
        """The version that holds each bucket."""
        out: dict[int, int] = {}
        for v, c in sorted(self._commits().items()):
            out |= dict.fromkeys(c["buckets"], v)
        return out

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("key", "source_list"), F.lit(self.buckets)).cast("int")

    def rows(self, few: list[int] | None = None) -> DataFrame:
        """The state, with ``b``; with ``few`` only these buckets' files."""
        fs, path = self._fs()
        out = self.spark.createDataFrame([], f"{STATE}, b int")
        by_version: dict[int, list[int]] = {}
        for b, v in self.newest().items():
            if few is None or b in few:
                by_version.setdefault(v, []).append(b)
        for v, own in sorted(by_version.items()):
            base = f"{self.path}/state/{v}"
            paths = [p for b in sorted(own) if fs.exists(path(p := f"{base}/b={b}"))]  # an emptied bucket has no files
            if paths:
                out = out.unionByName(self.spark.read.schema(f"{STATE}, b int").option("basePath", base).parquet(*paths))
        return out

    def digests(self, rows: DataFrame) -> DataFrame:
        """``(b, n, s, x)`` for each bucket of rows with ``b``."""
        h = F.xxhash64("key", "source_list", "name", "h")
        return rows.groupBy("b").agg(F.count("*").alias("n"), F.sum(h.cast("decimal(20,0)")).cast("string").alias("s"), F.bit_xor(F.xxhash64(h, F.lit(1))).alias("x"))

    def _known(self) -> dict[int, tuple]:
        """The digests of the buckets as they were written."""
        got: dict[int, tuple] = {}
        newest = self.newest()
        fs, path = self._fs()
        for v in sorted(set(newest.values())):
            p = f"{self.path}/digests/{v}"
            if fs.exists(path(p)):
                got |= {r["b"]: (r["n"], r["s"], r["x"]) for r in self.spark.read.schema("b int, n long, s string, x long").parquet(p).collect() if newest.get(r["b"]) == v}  # a row a bucket
        return got

    def take(self, snapshot: DataFrame, compare: list[str], version: int | None = None, order: str | None = None) -> int:
        """Bring the state to a snapshot and log what changed; gives the version."""
        commits = self._commits()
        version = max(commits, default=-1) + 1 if version is None else version
        if version in commits:
            return version
        at = f"{self.path}/incoming/{version}"
        own = keyed(snapshot, compare, order).withColumn("b", self.bucket())
        own.repartition(self.buckets, "b").write.mode("overwrite").partitionBy("b").parquet(at)
        new = self.spark.read.schema(f"{STATE}, b int").option("basePath", at).parquet(at)
        now = {r["b"]: (r["n"], r["s"], r["x"]) for r in self.digests(new).collect()}  # a row a bucket
        was = self._known()
        touched = sorted(b for b in now.keys() | was.keys() if now.get(b) != was.get(b))
        a = self.rows(touched).select("b", "key", "source_list", F.col("name").alias("was"), F.col("h").alias("h0"))
        rows = new.where(F.col("b").isin(touched))
        c = rows.select("b", "key", "source_list", F.col("name").alias("now"), F.col("h").alias("h1"))
        j = a.join(c, ["b", "key", "source_list"], "full_outer")
        kind = F.when(F.col("h0").isNull(), "added").when(F.col("h1").isNull(), "removed").when(F.col("h0") != F.col("h1"), "modified")
        found = j.select(kind.alias("change_type"), F.coalesce("now", "was").alias("entity_name"), "source_list").where("change_type is not null")
        found.write.mode("overwrite").parquet(f"{self.path}/log/version={version}")
        self._put(rows, version, touched)
        self._commit(version, touched, "change")
        fs, path = self._fs()
        fs.delete(path(at), True)
        return version

    def _put(self, rows: DataFrame, version: int, buckets: list[int]) -> None:
        rows.repartition(max(1, len(buckets)), "b").sortWithinPartitions("b", "key", "source_list").write.mode("overwrite").partitionBy("b").parquet(f"{self.path}/state/{version}")
        self.digests(rows).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/digests/{version}")  # a row a bucket

    def changes(self, version: int | None = None) -> DataFrame:
        """The log, or the changes of one version."""
        committed = [v for v, c in self._commits().items() if c["kind"] == "change" and (version is None or v == version)]
        if not committed:
            return self.spark.createDataFrame([], LOG)
        at = f"{self.path}/log"
        return self.spark.read.schema(LOG).option("basePath", at).parquet(*[f"{at}/version={v}" for v in sorted(committed)])

    def compact(self) -> None:
        """All buckets in one version; their older files go."""
        old = sorted(set(self.newest().values()))
        if len(old) < 2:
            return
        version = max(self._commits()) + 1
        self._put(self.rows(), version, list(range(self.buckets)))
        self._commit(version, list(range(self.buckets)), "compact")
        fs, path = self._fs()
        for v in old:
            fs.delete(path(f"{self.path}/state/{v}"), True)


def stream_lists(spark: SparkSession, incoming: str, schema, state: str, checkpoint: str, compare: list[str], buckets: int = 64) -> StreamingQuery:
    """Each file of ``incoming`` is a snapshot; the stream's batch number is its version, so a replayed batch adds nothing."""

    def take(batch: DataFrame, number: int) -> None:
        ListState(batch.sparkSession, state, buckets).take(batch, compare, number)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(incoming)
    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
