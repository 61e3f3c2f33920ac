"""What used to be bounded by a constant gives the same answers beyond it."""

import random
from collections import Counter

import numpy as np

from watchloom.llm import line_dedup, lm, toxicity

SCHEMA = "doc_id long, text string"


def test_line_runs_beyond_the_limit_of_buckets(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, "\n".join(rng.choice(["a line that many documents share", "another line of many documents", f"a line of its own, number {i}"]) for _ in range(6))) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = Counter(map(tuple, line_dedup.report(docs).collect()))
    monkeypatch.setattr(line_dedup, "BUCKET_ROWS", 2)
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "9")
    try:
        assert line_dedup.buckets_for(spark, 10**12) == 9
        assert Counter(map(tuple, line_dedup.report(docs).collect())) == want
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")


def test_samples_too_few_to_train_on_are_all_kept():
    samples = [b" sample %d with some words " % i for i in range(5)] + [b" sample 1 with some words "]
    content, trained = toxicity.dictionary(samples, 40)
    assert not trained and content == b"".join(dict.fromkeys(samples)) and len(content) > 40


def test_copies_beyond_the_tasks_are_trained_one_after_the_other(spark, monkeypatch):
    rng = random.Random(2)
    words = ["one", "two", "three", "four", "five", "six"]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=20))) for i in range(80)], SCHEMA)
    vocab = lm.vocabulary(lm.token_counts(docs.select("text")), docs.count())
    whole = lm.train(docs, vocab, rounds=2, copy_tokens=60)
    monkeypatch.setattr(lm, "MOST_TASKS", 3)
    monkeypatch.setattr(lm, "FAN", 2)
    few = lm.train(docs, vocab, rounds=2, copy_tokens=60)
    assert vocab.total // 60 > 20 and all(np.allclose(whole[k], few[k], atol=1e-5) for k in whole)


def test_a_run_has_one_file_a_bucket_however_keys_are_dealt(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    deal = DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda self, n, *by: deal(self, max(n, 21) if by else n, *by))
    runs = line_dedup.LineRuns(spark, str(tmp_path / "runs"), fanout=2, buckets=4)
    batches = [[(b * 1000 + i, f"{i % 200 if i % 3 else b * 1000 + i}".encode()) for i in range(300)] for b in range(3)]
    for rows in batches:
        assert runs.add(spark.createDataFrame(rows, "doc_id long, key binary"))
    assert all(len(list((tmp_path / "runs" / "runs-4" / "-".join(map(str, r))).glob("*.parquet"))) <= 4 for r in runs.runs())
    want = {}
    for doc_id, key in (x for rows in batches for x in rows):
        n, last = want.get(key, (0, 0))
        want[key] = (n + 1, max(last, doc_id))
    assert {bytes(r.key): (r.n_docs, r.max_id) for r in runs.entries().collect()} == want
    runs.forget()


def test_scoring_steps_once_for_each_token(monkeypatch):
    """Short documents beside a long one aren't padded; scores are those of each document alone."""
    rng, n = np.random.default_rng(3), np.array([70, 1, 5, 33, 2])
    c = 4
    v = lm.Vocabulary(10, 3, 2, np.full(65536, 1, dtype=np.uint8), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint8), np.full(c, 9.0), np.full(c, 6.0), np.zeros(0, dtype=np.uint64), np.zeros(0))
    v.slots = np.array([[2.0, -1, -1], [3.0, 2, 1], [4.0, 1, -1], [1.0, 1, 1]])
    p = lm.start(v, hidden=4)
    ids = rng.integers(1, c, n.sum()).astype(np.uint8)
    ids[np.cumsum(n) - 1] = lm.END
    slots = np.where(ids == 1, rng.integers(0, 3, len(ids)), 0).astype(np.uint8)
    real, taken = lm.step, []
    monkeypatch.setattr(lm, "step", lambda p, x, h: taken.append(len(x)) or real(p, x, h))
    got = lm.class_scores(p, ids, n, slots=slots)
    assert sum(taken) == n.sum()
    ends = np.cumsum(n)
    alone = [lm.class_scores(p, ids[b - k : b], np.array([k]), slots=slots[b - k : b])[0] for k, b in zip(n, ends, strict=True)]
    assert np.allclose(got, alone, atol=1e-4)
