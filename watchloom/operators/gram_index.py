"""A stored index of names by trigrams, for screening without a scan of the names.

Postings ``(gram, id)`` lie in buckets of grams, names in buckets of ids, both as partitions of Parquet tables; within a bucket postings are
sorted by gram, so that a reader skips row groups. Beside them lie the lengths of the posting lists. A query looks up the lengths of its keys, takes
the rarest that suffice, reads the buckets of these keys only, and of the names only the buckets of the candidates.

Each change is a version of its own: additions with their postings, removals as ids that make rows of earlier versions void, and lengths with a sign. Rows
count unless a later version removed their id, so one change may replace a name. A version counts once its commit file is there; a change that
failed half-way is written anew under the same number. ``compact`` folds all versions into a new base. Readers take the latest base and
what follows it.

Names that are null are not indexed. An id names one row; adding an id that is there replaces it. Removing an unknown id changes nothing.
"""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import cut, shared_dir
from .screening import MAX_QUERIES, asked, dealt, most_keys, name_keys, ranked

POSTINGS = "gram string, id long, v long, gb int"
NAMES = "id long, name string, source_id string, v long, nb int"
LENGTHS = "gram string, n long, gb int"
REMOVED = "id long, v long"


class GramIndex:
    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64):
        self.spark = spark
        self.path = path or f"{shared_dir(spark)}/gram-index-{uuid.uuid4().hex}"
        known = [n for n in self._list("") if n.startswith("buckets-")]
        self.buckets = int(known[0][8:]) if known else buckets  # an index keeps the buckets it began with
        if not known:
            fs, path_ = self._fs()
            fs.mkdirs(path_(f"{self.path}/buckets-{buckets}"))

    def _fs(self):
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        return jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(conf), jvm.org.apache.hadoop.fs.Path

    def _list(self, sub: str) -> list[str]:
        fs, path = self._fs()
        at = path(f"{self.path}/{sub}" if sub else self.path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def versions(self) -> list[int]:
        """The versions that count: the latest base and those after it."""
        commits = [n.split("-") for n in self._list("commits")]
        bases = [int(v) for v, kind in commits if kind == "base"]
        return sorted(int(v) for v, _ in commits if not bases or int(v) >= max(bases))

    def _bucket(self, c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(self.buckets)).cast("int")

    def _read(self, table: str, schema: str, versions: list[int], by: str | None = None, few: list[int] | None = None) -> DataFrame:
        """A table of some versions; with ``few`` only these buckets' folders, the others aren't even listed."""
        fs, path = self._fs()
        out = self.spark.createDataFrame([], schema)
        for v in versions:
            base = f"{self.path}/{v}/{table}"
            if not fs.exists(path(base)):
                continue
            paths = [base] if few is None else [f"{base}/{n}" for n in sorted({f"{by}={b}" for b in few} & set(self._list(f"{v}/{table}")))]
            if paths:
                rows = self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
                out = rows if v == versions[0] else out.unionByName(rows)
        return out

    def _valid(self, rows: DataFrame, versions: list[int]) -> DataFrame:
        """Rows whose id no later version removed. The base has no removals."""
        if len(versions) < 2:
            return rows
        gone = self._read("removed", REMOVED, versions).groupBy("id").agg(F.max("v").alias("gone"))
        return rows.join(gone, "id", "left").where("gone is null or gone <= v").drop("gone")

    def names(self, ids: DataFrame | None = None) -> DataFrame:
        """``(id, name, source_id, v)``; with ``ids(id)`` only theirs, and only their buckets are read."""
        if ids is None:
            rows = self._read("names", NAMES, self.versions())
        else:
            few = [r["nb"] for r in ids.select(self._bucket(F.col("id")).alias("nb")).distinct().collect()]  # at most one a bucket
            rows = self._read("names", NAMES, self.versions(), "nb", few).join(ids.select("id").distinct(), "id", "left_semi")
        return self._valid(rows, self.versions()).select("id", "name", "source_id", "v")

    def _write(self, at: str, names: DataFrame, v: int, removed: DataFrame | None, lost: DataFrame | None) -> None:
        put = lambda df, table, by: df.write.mode("overwrite").partitionBy(*by).parquet(f"{at}/{table}")
        names = names.where("name is not null").select(F.col("id").cast("long").alias("id"), "name", "source_id").withColumn("v", F.lit(v).cast("long"))
        put(names.withColumn("nb", self._bucket(F.col("id"))).repartition(self.buckets, "nb").sortWithinPartitions("nb", "id"), "names", ["nb"])
        stored = self.spark.read.schema(NAMES).parquet(f"{at}/names")
        posted = stored.select(F.explode(F.array_distinct(name_keys(F.col("name")))).alias("gram"), "id", "v").withColumn("gb", self._bucket(F.col("gram")))
        put(posted.repartition(self.buckets, "gb").sortWithinPartitions("gb", "gram", "id"), "postings", ["gb"])
        lengths = self.spark.read.schema(POSTINGS).parquet(f"{at}/postings").select("gram", F.lit(1).cast("long").alias("n"), "gb")
        if lost is not None:
            gone = lost.select(F.explode(F.array_distinct(name_keys(F.col("name")))).alias("gram"), F.lit(-1).cast("long").alias("n"))
            lengths = lengths.unionByName(gone.withColumn("gb", self._bucket(F.col("gram"))))
        put(lengths.groupBy("gb", "gram").agg(F.sum("n").alias("n")).where("n <> 0").repartition(self.buckets, "gb").sortWithinPartitions("gb", "gram"), "lengths", ["gb"])
        if removed is not None:
            removed.select("id", F.lit(v).cast("long").alias("v")).write.mode("overwrite").parquet(f"{at}/removed")

    def _commit(self, v: int, kind: str) -> None:
        fs, path = self._fs()
        fs.create(path(f"{self.path}/commits/{v}-{kind}"), True).close()

    def change(self, added: DataFrame | None = None, removed: DataFrame | None = None, version: int | None = None) -> int:
        """Add ``added(id, name, source_id)`` and remove the ids in ``removed(id)``; gives the version.

        With the number of a version that is there, nothing is done: a change may be sent again.
        """
        commits = [int(n.split("-")[0]) for n in self._list("commits")]
        v = max(commits, default=-1) + 1 if version is None else version
        if v in commits:
            return v
        added = self.spark.createDataFrame([], "id long, name string, source_id string") if added is None else added
        ids = added.select(F.col("id").cast("long").alias("id"))
        ids = ids.unionByName(removed.select(F.col("id").cast("long").alias("id"))) if removed is not None else ids
        if not self.versions():
            self._write(f"{self.path}/{v}", added, v, None, None)
            self._commit(v, "base")
            return v
        lost = cut(self.names(ids.distinct()))
        self._write(f"{self.path}/{v}", added, v, lost.select("id"), lost)
        self._commit(v, "delta")
        return v

    def compact(self) -> None:
        v = max((int(n.split("-")[0]) for n in self._list("commits")), default=-1) + 1
        self._write(f"{self.path}/{v}", self.names(), v, None, None)
        self._commit(v, "base")

    def lengths(self, grams: list[str] | None = None, buckets: list[int] | None = None) -> DataFrame:
        """``(gram, k)``: lengths of the posting lists, of some grams in some buckets or of all."""
        rows = self._read("lengths", LENGTHS, self.versions(), "gb", buckets)
        if grams is not None:
            rows = rows.where(F.col("gram").isin(grams))
        return rows.groupBy("gram").agg(F.sum("n").alias("k")).where("k > 0")

    def postings(self, grams: list[str], buckets: list[int]) -> DataFrame:
        """``(gram, id)`` of the grams; folders of other buckets aren't listed, row groups of other grams aren't read."""
        rows = self._read("postings", POSTINGS, self.versions(), "gb", buckets).where(F.col("gram").isin(grams))
        return self._valid(rows, self.versions()).select("gram", "id")

    def screen(self, queries: DataFrame, threshold: float = 0.3, limit: int = 10) -> DataFrame:
        """As ``screening.screen`` for up to ``MAX_QUERIES`` queries, from the index."""
        if len(queries.select("q_id").take(MAX_QUERIES + 1)) > MAX_QUERIES:
            raise ValueError(f"at most {MAX_QUERIES} queries are taken at once")
        own = asked(queries).withColumns({"gb": self._bucket(F.col("gram")), "most": most_keys(threshold)}).collect()  # the keys of the queries
        counts = {r["gram"]: r["k"] for r in self.lengths(sorted({r["gram"] for r in own}), sorted({r["gb"] for r in own})).collect()}
        chosen, place = [], Counter()
        for r in sorted(own, key=lambda r: (counts.get(r["gram"], 0), r["gram"])):
            kind = r["q_id"], r["gram"][0]
            place[kind] += 1
            if place[kind] <= r["most"] and r["gram"] in counts:
                chosen.append(r)
        keys = self.spark.createDataFrame([(r["q_id"], r["ql"], r["qg"], r["gram"]) for r in chosen], "q_id int, ql string, qg array<string>, gram string")
        hits = self.postings(sorted({r["gram"] for r in chosen}), sorted({r["gb"] for r in chosen}))
        pairs = cut(hits.join(F.broadcast(keys), "gram").groupBy("q_id", "id").agg(F.first("ql").alias("ql"), F.first("qg").alias("qg")))
        return ranked(dealt(pairs).join(self.names(pairs.select("id")), "id"), threshold, limit)
