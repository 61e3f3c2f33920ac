"""Freshness alarms as a stream with keyed state and event-time timers.

Sources are dealt over ``buckets`` by a hash, and a bucket is the key of the state, since what a key costs a batch is paid in calls, whatever its size. Before they are dealt, the rows of a task are packed, those of a bucket into one.
A bucket has for each of its sources the last time, the alarm level and the times that aren't final yet. A time is final once the watermark has passed it:
then nothing older can come, and it is compared with the one before. A bucket has one timer, at the first moment when one of its sources has a time that
may be final or reaches an age; when it rings, all that has become final is taken at once.
What is emitted doesn't depend on how the input was cut into batches, nor on the order in which rows came, up to ``late``.

Alarms are ``STALE`` and ``VERY_STALE``, at the moment when the age was reached, and ``RECOVERED``, at the time that ended it. Ages count from the last
time of a source; sources of bulk lists get ``factor`` times as long. A source that stays silent for ``forget`` loses its state. Rows without source or time are left out.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

ALARMS = "source_id string, alarm string, at timestamp, last_seen timestamp"
STALE_DAYS, VERY_STALE_DAYS, BULK_FACTOR = 7, 30, 3
PACK = 500_000  # rows that a task packs at once
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def millis(days: float) -> int:
    return int(days * 86_400_000)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of bucket, source, ms and factor -> for each bucket its sources, with the times of all of them in their order."""

    def rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        each = pa.Table.from_batches(held).group_by(["bucket", "source_id"]).aggregate([("ms", "list"), ("factor", "max")]).sort_by("bucket")
        buckets, at = np.unique(each["bucket"].to_numpy(), return_index=True)
        ms, sizes, factors = each["ms_list"].combine_chunks(), pc.list_value_length(each["ms_list"]).to_numpy().astype(np.int64), each["factor_max"].to_numpy().astype(np.int64)
        out = []
        for bucket, a, b in zip(buckets, at, [*at[1:], each.num_rows], strict=True):
            times = ms[a:b].flatten().to_numpy()
            out.append({"bucket": bucket, "latest": times.max(), "sources": each["source_id"][a:b].to_pylist(), "sizes": sizes[a:b].tobytes(), "factors": factors[a:b].tobytes(), "times": times.tobytes()})
        return pa.RecordBatch.from_pylist(out, pa.schema([("bucket", pa.int32()), ("latest", pa.int64()), ("sources", pa.list_(pa.string())), ("sizes", pa.binary()), ("factors", pa.binary()), ("times", pa.binary())]))

    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held, n = [*held, batch], n + batch.num_rows
        if n >= PACK:
            yield rows(held)
            held, n = [], 0
    if held:
        yield rows(held)


def _at(ms: int) -> datetime:
    return datetime.fromtimestamp(ms / 1000, timezone.utc).replace(tzinfo=None)


@dataclass(slots=True)
class Seen:
    """What is known of one source; ``pending`` is sorted."""

    last: int | None = None
    level: int = 0
    factor: int = 1
    pending: array = field(default_factory=lambda: array("q"))

    def add(self, times: set[int], factor: int) -> None:
        self.factor = max(self.factor, factor)
        if new := times.difference(self.pending) if self.last is None else {t for t in times if t > self.last}.difference(self.pending):
            self.pending = array("q", sorted(new.union(self.pending)))

    def due(self, levels: tuple[tuple[str, int], ...], forget: int) -> int:
        """The first moment at which something may happen."""
        moments = [self.pending[0]] if self.pending else [self.last + forget * self.factor]
        if self.last is not None:
            moments += [self.last + age * self.factor for _, age in levels[self.level :]]
        return min(moments)

    def reached(self, until: int, levels: tuple[tuple[str, int], ...]) -> Iterator[tuple[str, int, int]]:
        for k, (name, age) in enumerate(levels, 1):
            if self.level < k and until >= self.last + age * self.factor:
                self.level = k
                yield name, self.last + age * self.factor, self.last

    def take(self, now: int, levels: tuple[tuple[str, int], ...]) -> Iterator[tuple[str, int, int]]:
        """Alarm, moment and last time of all that happened up to ``now``."""
        final = bisect_right(self.pending, now)
        for t in self.pending[:final]:
            if self.last is not None:
                yield from self.reached(t, levels)
                if self.level:
                    yield "RECOVERED", t, self.last
            self.last, self.level = t, 0
        self.pending = self.pending[final:]
        if self.last is not None:
            yield from self.reached(now, levels)


class Freshness(StatefulProcessor):
    def __init__(self, warn: int, alarm: int, forget: int):
        self.levels = (("STALE", warn), ("VERY_STALE", alarm))
        self.forget = forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "timer long, source array<string>, last array<long>, level array<int>, factor array<int>, pending array<binary>")

    def _read(self) -> tuple[int | None, dict[str, Seen]]:
        timer, *columns = self.seen.get() or (None, (), (), (), (), ())
        return timer, {source: Seen(last, level, factor, array("q", bytes(packed))) for source, last, level, factor, packed in zip(*columns, strict=True)}

    def _keep(self, timer: int | None, sources: dict[str, Seen]) -> None:
        """Write the state and leave the one timer that it needs; ``timer`` is the one it has."""
        first = min((x.due(self.levels, self.forget) for x in sources.values()), default=None)
        if timer not in (None, first):
            self.handle.deleteTimer(timer)
        if first is None:
            self.seen.clear()
            return
        if first != timer:
            self.handle.registerTimer(first)
        each = sources.values()
        self.seen.update((first, list(sources), [x.last for x in each], [x.level for x in each], [x.factor for x in each], [x.pending.tobytes() for x in each]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        timer, sources = self._read()
        for r in rows:
            times, at = array("q", bytes(r["times"])), 0
            for source, size, factor in zip(r["sources"], array("q", bytes(r["sizes"])), array("q", bytes(r["factors"])), strict=True):
                own, at = {t for t in times[at : at + size] if t > now}, at + size  # what is older is late, in whatever company it comes
                if own or source in sources:
                    sources.setdefault(source, Seen()).add(own, factor)
        self._keep(timer, sources)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()  # all up to here is final
        timer, sources = self._read()
        if timer is None:
            return
        if timer == expiredTimerInfo.getExpiryTimeInMs():
            timer = None  # it is gone once this call ends
        for source, x in list(sources.items()):
            if x.due(self.levels, self.forget) <= now:
                for alarm, at, last in x.take(now, self.levels):
                    yield Row(source_id=source, alarm=alarm, at=_at(at), last_seen=_at(last))
                if not x.pending and now >= x.last + self.forget * x.factor:
                    del sources[source]
        self._keep(timer, sources)

    def close(self) -> None:
        pass


def alarms(events: DataFrame, source: str, time: str, bulk: Column | None = None, warn_days: float = STALE_DAYS, alarm_days: float = VERY_STALE_DAYS, forget_days: float = 3650, late: str = "1 hour", buckets: int = 1024) -> DataFrame:
    """``(source_id, alarm, at, last_seen)`` of a stream of events. ``buckets`` stay as they are as long as a checkpoint is used."""
    own = events.where(F.col(source).isNotNull() & F.col(time).isNotNull())
    own = own.select(F.col(source).cast("string").alias("source_id"), F.unix_millis(F.col(time).cast("timestamp")).alias("ms"), F.when(bulk if bulk is not None else F.lit(False), BULK_FACTOR).otherwise(1).alias("factor"))
    packed = own.select(F.pmod(F.xxhash64("source_id"), F.lit(buckets)).cast("int").alias("bucket"), "source_id", "ms", "factor").mapInArrow(_packed, "bucket int, latest long, sources array<string>, sizes binary, factors binary, times binary")
    packed = packed.withColumn("latest", F.timestamp_millis("latest")).withWatermark("latest", late)
    return packed.groupBy("bucket").transformWithState(Freshness(millis(warn_days), millis(alarm_days), millis(forget_days)), ALARMS, "Append", "EventTime")


def with_timers(writer: DataStreamWriter):
    """Start a stream whose state needs the store that keeps timers; other streams of the session keep theirs."""
    conf = writer._spark.conf
    key = "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key, None)
    conf.set(key, ROCKS)
    try:
        return writer.start()
    finally:
        conf.set(key, before) if before is not None else conf.unset(key)
