"""The pipeline against a brute-force version of its stages."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from watchloom.llm import toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, f in corpus_pipeline.STAGES:
        out.append(f(spark, out[-1], SF).cache())
    return out


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t))


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stage_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "decontamination", "mixing"]
    for df in stages[1:5]:
        assert df.columns == stages[0].columns
    assert stages[5].columns == [*stages[0].columns, "copy"]


def test_toxic_documents_go(spark, stages):
    model = toxicity.train(toxicity.labelled(stages[0], spark.read.parquet(f"{SF}/labels.parquet"), "toxic"))
    gains = toxicity.Gains(model)
    x = np.array([toxicity.features(r.text.encode(), gains) for r in stages[0].collect()])
    keep = {r.doc_id for r, p in zip(stages[0].collect(), toxicity.logistic.predict(model.weights, x), strict=True) if p < 0.5}
    assert set(rows(stages[1])) == keep and len(keep) > 0.8 * stages[0].count()


def test_repeated_lines_go(stages):
    before, after = rows(stages[1]), rows(stages[2])
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for d, r in before.items():
        for x in r.text.split("\n"):
            if len(key(x)) >= 20:
                holders[key(x)].add(d)
    for d, r in before.items():
        kept = "\n".join(x for x in r.text.split("\n") if len(holders.get(key(x), ())) < 3 or d == max(holders[key(x)]))
        assert after[d].text == kept and (after[d].n_chars == len(kept) or kept == r.text)


def test_one_of_near_duplicates_stays(stages):
    before = rows(stages[2])
    sets = {}
    for d, r in before.items():
        w = words(r.text)
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    ids = sorted(sets)
    label = {d: d for d in ids}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    assert set(rows(stages[3])) == {d for d in ids if find(d) == d}


def test_contaminated_documents_go(spark, stages):
    hit_words = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(x))
    wins = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = hit_words(r.text)
        wins |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(x) for x in wins}
    clean = {d for d, r in rows(stages[3]).items() if not any(tuple(w[i : i + k]) in wins for w in [hit_words(r.text)] for k in sizes for i in range(len(w) - k + 1))}
    assert set(rows(stages[4])) == clean and len(clean) < len(rows(stages[3]))


def test_mixture_meets_targets(stages):
    size, source = {}, {}
    for d, r in rows(stages[4]).items():
        size[d], source[d] = len(words(r.text)), r.source
    copies = Counter(r.doc_id for r in stages[5].collect())
    assert set(copies) <= set(size) and max(copies.values()) <= 2
    total = sum(size.values())
    assert abs(sum(copies[d] * size[d] for d in copies) - 1.5 * total) < 0.02 * total


def test_stages_take_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated ids and rows, clashing columns, an empty table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    a, b = docs.select("text").limit(2).toPandas()["text"]
    rows = [(None, None, None, None, None), (None, a, "en", "s", 1), (1, "", "en", None, 0), (2, " \n ", None, "s", None), (3, "one", "en", "s", 3), (4, "word " * 200_000, "en", "s", 1), (10**6, a, "en", "s", 1), (10**6, b, "en", "s", 1), (10**6 + 1, b + " x", "en", "s", 1), (10**6 + 1, b + " x", "en", "s", 1)]
    odd = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    for c in ("key", "n", "sig", "who", "t", "score", "size", "copies", "u", "copy", "part", "batch", "source_size", "first", "cid", "h", "x"):
        odd = odd.withColumn(c, odd["n_chars"])
    for name, f in corpus_pipeline.STAGES:
        for df in (odd, odd.limit(0)):
            got = f(spark, df, SF)
            assert got.columns[: len(df.columns)] == df.columns and (name == "mixing" or got.columns == df.columns)
            n = got.count()
            assert n <= 2 * df.count()
            if name == "near dedup" and n:
                left = Counter((r.doc_id, r.text) for r in got.collect())
                assert left[None, None] == left[1, ""] == left[2, " \n "] == 1 and not left[None, a] and not left[10**6, a] and not left[10**6 + 1, b + " x"] and max(left.values()) == 1
                assert any(k[1] == a for k in left) and any(k[1] == b for k in left)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100
