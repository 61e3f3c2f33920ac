"""What a stream of freshness alarms costs doesn't grow with a source's events; late rows don't pass in company of others."""

import datetime
from collections import Counter

from pyspark.sql import functions as F
from test_incremental import plain_alarms

from watchloom.streaming import freshness

DAY, HOUR = 86_400_000, 3_600_000


def at(ms):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(milliseconds=ms)


def test_timers_follow_sources_and_late_rows_stay_out(spark, tmp_path):
    times = {f"s{k}": [k * 1000 + x * 7 * HOUR // 5 for x in range(400) if x % 100 < 60 + k] for k in range(12)}
    end, cut = 25 * DAY, 12 * DAY
    rows = [(s, t) for s, ts in times.items() for t in ts] + [("clock", end)]
    first, then = [r for r in rows if r[1] <= cut] + [("clock", cut)], [r for r in rows if r[1] > cut]
    then += [(f"s{k}", 3 * DAY + 12345 + k) for k in range(12)]  # late, not seen before
    schema, timers, updated = "source string, t timestamp_ntz", 0, 0
    for own in (first, then):
        spark.createDataFrame([(s, at(t)) for s, t in own], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = freshness.alarms(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "source", "t", F.lit(False), 0.5, 2)
        query = freshness.with_timers(stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True))
        query.awaitTermination()
        for p in query.recentProgress:
            for x in p["stateOperators"]:
                timers += x["customMetrics"]["numRegisteredTimers"]
                updated += x["numRowsUpdated"]
    times["clock"] = [cut, end]
    want = Counter((s, a, at(x), at(y)) for s, ts in times.items() for a, x, y in plain_alarms(ts, end - HOUR, DAY // 2, 2 * DAY))
    got = Counter((r.source_id, r.alarm, r.at, r.last_seen) for r in spark.read.schema(freshness.ALARMS).parquet(str(tmp_path / "out")).collect())
    assert got == want and len(want) > 50
    assert 0 < timers <= 8 * 13 and updated <= 8 * 13  # of 13 sources with more than 3,000 events
