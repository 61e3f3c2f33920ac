"""Results of calls, kept for some minutes and until the data they come from has a newer version.

An entry is a folder in the shared folder, named by a hash of the call and its arguments, then by the data's version and the moment it was
written; it counts once Spark's ``_SUCCESS`` is there. Whoever asks again in time, in any session, reads the folder; a newer version or the end of the time makes it
void. Entries that no longer count are deleted when their call is computed anew. Two sessions that compute at once write two entries, and the later one counts.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..shared import shared_dir

MINUTES = 5


class ResultCache:
    def __init__(self, spark: SparkSession, path: str | None = None, minutes: float = MINUTES, clock: Callable[[], float] = time.time):
        self.spark, self.minutes, self.clock = spark, minutes, clock
        self.path = path or f"{shared_dir(spark)}/results-{uuid.uuid4().hex}"

    def _fs(self):
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        return jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(conf), jvm.org.apache.hadoop.fs.Path

    @staticmethod
    def key(call: str, arguments: dict) -> str:
        return hashlib.sha256(json.dumps([call, arguments], sort_keys=True, default=str).encode()).hexdigest()

    def _entries(self, key: str) -> list[tuple[int, float, str]]:
        """(version, written at, folder) of whole entries."""
        fs, path = self._fs()
        at = path(f"{self.path}/{key}")
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        whole = [n for n in names if fs.exists(path(f"{self.path}/{key}/{n}/_SUCCESS"))]
        return sorted((int(v), int(ms) / 1000, f"{self.path}/{key}/{n}") for n in whole for v, ms, _ in (n.split("-"),))

    def get(self, call: str, arguments: dict, version: int, compute: Callable[[], DataFrame]) -> DataFrame:
        """The rows of a call on the data's ``version``, from the cache where it has them."""
        key, now = self.key(call, arguments), self.clock()
        entries = self._entries(key)
        for v, written, folder in reversed(entries):
            if v == version and 0 <= now - written <= self.minutes * 60:
                return self.spark.read.parquet(folder)
        folder = f"{self.path}/{key}/{version}-{int(now * 1000)}-{uuid.uuid4().hex}"
        compute().write.parquet(folder)
        fs, path = self._fs()
        for v, written, old in entries:
            if v < version or now - written > self.minutes * 60:
                fs.delete(path(old), True)
        return self.spark.read.parquet(folder)
