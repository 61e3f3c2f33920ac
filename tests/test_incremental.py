"""State that is kept and changed: the trigram index against a fresh screen."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from watchloom.operators import screening
from watchloom.operators.gram_index import GramIndex

WORDS = ["private", "limited", "ram", "lal", "kumar", "trading", "co", "steel", "gold", "x1", "é", "--"]


def some_names(n, seed):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(WORDS, k=rng.randint(1, 4))), f"s{i % 3}") for i in range(n)]


def rows(df):
    return Counter((r.q_id, r.id, r.name, r.source_id, r.tier, round(r.sim, 9), r["rank"]) for r in df.collect())


@pytest.mark.parametrize("threshold", [0.3, 0.8])
def test_an_index_screens_like_a_scan_after_every_change(spark, tmp_path, threshold):
    schema = "id long, name string, source_id string"
    now = {i: (i, n, s) for i, n, s in some_names(150, 1)} | {900: (900, None, "s")}
    queries = spark.createDataFrame([(1, "Ram Lal"), (2, "steel gold trading"), (3, "--"), (4, "é x1"), (5, "zzz"), (6, "al k"), (7, "x")], "q_id int, query string")
    index = GramIndex(spark, str(tmp_path / "index"), buckets=8)
    frame = lambda xs: spark.createDataFrame(list(xs), schema)
    index.change(frame(now.values()))
    steps = [(some_names(20, 2), [5, 6, 7]), ([(3, "ram lal", "s9"), (3000, "new steel gold", "s9")], [3, 8888]), ([], list(range(40, 80))), ([(41, "back again ram", "s1")], [])]
    for k, (added, removed) in enumerate(steps):
        v = index.change(frame(added), spark.createDataFrame([(i,) for i in removed], "id long"))
        assert index.change(frame([(1, "never", "s")]), None, version=v) == v  # a change sent again does nothing
        for i in removed:
            now.pop(i, None)
        now |= {i: (i, n, s) for i, n, s in added}
        if k == 2:
            index.compact()
            assert len(index.versions()) == 1
        want = rows(screening.screen(queries, frame(now.values()), threshold, 12))
        assert rows(index.screen(queries, threshold, 12)) == want and len(want) > 10
        assert rows(GramIndex(spark, index.path).screen(queries, threshold, 12)) == want  # another session
    fresh = GramIndex(spark, str(tmp_path / "fresh"))
    fresh.change(frame(now.values()))
    assert {tuple(r) for r in index.lengths().collect()} == {tuple(r) for r in fresh.lengths().collect()}


def test_a_change_that_stops_half_way_does_not_count(spark, tmp_path):
    index = GramIndex(spark, str(tmp_path / "index"), buckets=4)
    names = spark.createDataFrame(some_names(40, 3), "id long, name string, source_id string")
    index.change(names)
    before = sorted(map(tuple, index.names().collect()))
    index._write(f"{index.path}/1", names.limit(3), 1, names.select("id"), None)  # no commit follows
    assert sorted(map(tuple, index.names().collect())) == before
    assert index.change(None, names.where("id < 10").select("id")) == 1
    assert {r.id for r in index.names().collect()} == set(range(10, 40))


def test_a_query_reads_few_buckets(spark, tmp_path):
    index = GramIndex(spark, str(tmp_path / "index"), buckets=32)
    rng = random.Random(5)
    names = [(i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(2)), "s") for i in range(2000)]
    index.change(spark.createDataFrame(names, "id long, name string, source_id string"))
    got = index.screen(spark.createDataFrame([(1, names[7][1])], "q_id int, query string"), 0.8)
    assert [r.id for r in got.collect()] == [7]
    folders = {f.split("/")[-2] for f in index.names(spark.createDataFrame([(7,)], "id long")).inputFiles()}
    assert len(folders) == 1 and folders.pop().startswith("nb=")  # one folder of 32
    assert len({f.split("/")[-2] for f in got.inputFiles()}) <= 1  # the final plan reads the candidates' names only
    some = index.postings(["wabc"], [3])
    assert {f.split("/")[-2] for f in some.inputFiles()} == {"gb=3"} and "EqualTo(gram,wabc)" in some._jdf.queryExecution().executedPlan().toString()


# --- lists in buckets ------------------------------------------------------------------------------
LIST = "name string, source_list string, details string, at long"


def snapshots():
    rng = random.Random(8)
    first = {(f"Name {i}", f"l{i % 3}"): f"d{i}" for i in range(300)}
    second = {k: (v + " new" if rng.random() < 0.02 else v) for k, v in first.items() if rng.random() > 0.02} | {("Added 1", "l0"): "x", ("Added 2", "l1"): "y"}
    third = {k: v for k, v in second.items() if k[1] != "l2" or rng.random() > 0.01} | {("name 7", "l1"): "d7"}  # the key of "Name 7"
    return [first, second, third, {}]


def frame(spark, snap):
    rows = [(n, lst, d, 1) for (n, lst), d in snap.items()] + ([(None, "l0", "x", 1), ("  ", "l0", "x", 1)] if snap else [])
    return spark.createDataFrame(rows, LIST).repartition(3)


def plain_changes(old, new):
    key = lambda s: {(n.lower().strip(), lst): (n, d) for (n, lst), d in sorted(s.items(), reverse=True)}
    a, b = key(old), key(new)
    kind = lambda k: "added" if k not in a else "removed" if k not in b else "modified" if a[k] != b[k] else None
    return Counter((kind(k), (b.get(k) or a[k])[0], k[1]) for k in a.keys() | b.keys() if kind(k))


def test_snapshots_touch_only_the_buckets_that_change(spark, tmp_path):
    from watchloom.streaming import changes as C
    from watchloom.streaming.snapshots import ListState

    state = ListState(spark, str(tmp_path / "state"), buckets=32)
    before = {}
    for v, snap in enumerate(snapshots()):
        files = {p: p.stat().st_mtime_ns for p in (tmp_path / "state").rglob("state/*/b=*/*.parquet")}
        assert state.take(frame(spark, snap), ["name", "details"]) == v
        got = Counter((r.change_type, r.entity_name, r.source_list) for r in state.changes(v).collect())
        whole = C.changes(frame(spark, before), frame(spark, snap), ["name", "details"])
        assert got == Counter(map(tuple, whole.select("change_type", "entity_name", "source_list").collect()))
        if v in (0, 1, 3):
            assert got == plain_changes(before, snap)
        assert all(p.stat().st_mtime_ns == t for p, t in files.items())
        if v == 1:
            assert 0 < len({p.parent.name for p in (tmp_path / "state/state/1").rglob("*.parquet")}) < 20  # some 14 changes in 32 buckets
        assert state.take(frame(spark, {}), ["name", "details"], version=v) == v  # a replay adds nothing
        assert state.changes(v).count() == got.total()
        before = snap
        if v == 2:
            n = state.rows().count()
            state.compact()
            again = ListState(spark, state.path, buckets=5)
            assert again.buckets == 32 and again.rows().count() == n and set(again.newest().values()) == {3}
            break
    after = state.take(frame(spark, {}), ["name", "details"])
    assert after == 4 and state.rows().count() == 0 and {r.change_type for r in state.changes(4).collect()} == {"removed"}
    assert ListState(spark, str(tmp_path / "none")).rows().count() == 0 and ListState(spark, str(tmp_path / "none")).changes().count() == 0


def test_a_version_that_stops_half_way_is_written_anew(spark, tmp_path):
    from watchloom.streaming.snapshots import ListState

    first, second, *_ = snapshots()
    state = ListState(spark, str(tmp_path / "state"), buckets=8)
    state.take(frame(spark, first), ["name", "details"])
    state._put(state.rows().limit(5), 1, [1, 2])  # no commit follows
    assert state.rows().count() == len(first)
    assert state.take(frame(spark, second), ["name", "details"]) == 1
    assert Counter((r.change_type, r.entity_name, r.source_list) for r in state.changes(1).collect()) == plain_changes(first, second)
    assert state.rows().count() == len(second)


# --- freshness -------------------------------------------------------------------------------------
def plain_alarms(times, watermark, warn, alarm):
    out = []
    final = sorted(t for t in set(times) if t <= watermark)
    for t, nxt in zip(final, [*final[1:], None], strict=True):
        for name, age in (("STALE", warn), ("VERY_STALE", alarm)):
            if t + age <= watermark and (nxt is None or nxt >= t + age):
                out.append((name, t + age, t))
        if nxt is not None and nxt >= t + warn:
            out.append(("RECOVERED", nxt, t))
    return out


def test_alarms_do_not_depend_on_batches_and_survive_restarts(spark, tmp_path):
    import datetime

    from watchloom.streaming import freshness

    day, hour = 86_400_000, 3_600_000
    rng = random.Random(4)
    times = {f"s{k}": sorted(rng.randrange(0, 90 * day) for _ in range(n)) for k, n in enumerate((3, 8, 20, 60, 1))}
    times["bulk_1"] = [day, 40 * day, 85 * day]
    rows = [(k, t) for k, ts in times.items() for t in ts]
    rows.sort(key=lambda r: r[1] + rng.randrange(0, 5 * hour))  # out of order, but within the watermark
    rows += [("clock", 90 * day)]
    at = lambda ms: datetime.datetime(2024, 1, 1) + datetime.timedelta(milliseconds=ms)
    want = Counter()
    for k, ts in times.items():
        f = 3 if k.startswith("bulk") else 1
        want.update((k, a, at(x), at(y)) for a, x, y in plain_alarms(ts, 90 * day - 6 * hour, 7 * day * f, 30 * day * f))
    schema = "source string, t timestamp_ntz"
    for cuts in ((0, len(rows)), (0, 13, 40, 41, len(rows))):
        home = tmp_path / str(len(cuts))
        for a, b in zip(cuts, cuts[1:]):
            own = [(k, at(t)) for k, t in rows[a:b]] + [(None, at(0)), ("s0", None)]
            own += [(k, at(t)) for k, t in rows[: a // 2] if t < 60 * day]  # again, much too late
            spark.createDataFrame(own, schema).coalesce(1).write.mode("append").parquet(str(home / "in"))
            stream = freshness.alarms(spark.readStream.schema(schema).parquet(str(home / "in")), "source", "t", F.col("source").startswith("bulk"), late="6 hours")
            freshness.with_timers(stream.writeStream.format("parquet").option("path", str(home / "out")).option("checkpointLocation", str(home / "ck")).trigger(availableNow=True)).awaitTermination()
        got = Counter((r.source_id, r.alarm, r.at, r.last_seen) for r in spark.read.schema(freshness.ALARMS).parquet(str(home / "out")).collect())
        assert got == want and {a for _, a, _, _ in got} == {"STALE", "VERY_STALE", "RECOVERED"}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != freshness.ROCKS


# --- results that are kept -------------------------------------------------------------------------
def test_results_expire_and_follow_versions(spark, tmp_path):
    from watchloom.operators.result_cache import ResultCache

    now, computed = [1000.0], []

    def ask(cache, call, version, **arguments):
        def compute():
            computed.append((call, version))
            return spark.createDataFrame([(call, version, len(computed))], "call string, version int, k int")

        return tuple(cache.get(call, arguments, version, compute).first())

    cache = ResultCache(spark, str(tmp_path / "results"), clock=lambda: now[0])
    assert ask(cache, "a", 1, x=1, y=2) == ask(cache, "a", 1, y=2, x=1) == ("a", 1, 1)  # a hit
    assert ask(ResultCache(spark, cache.path, clock=lambda: now[0] + 299), "a", 1, x=1, y=2) == ("a", 1, 1)  # in another session, in time
    assert ask(cache, "a", 1, x=2) == ("a", 1, 2) and ask(cache, "b", 1, x=1, y=2) == ("b", 1, 3)  # other arguments, another call
    assert ask(cache, "a", 2, x=1, y=2) == ("a", 2, 4)  # a newer version
    assert len(cache._entries(cache.key("a", {"x": 1, "y": 2}))) == 1
    now[0] += 301
    assert ask(cache, "a", 2, x=1, y=2) == ("a", 2, 5)  # too old
    spark.range(3).write.parquet(f"{cache.path}/{cache.key('c', {})}/1-{int(now[0] * 1000)}-x")
    (tmp_path / "results" / cache.key("c", {})).joinpath(f"1-{int(now[0] * 1000)}-x", "_SUCCESS").unlink()
    assert ask(cache, "c", 1) == ("c", 1, 6)  # what stopped half-way doesn't count
