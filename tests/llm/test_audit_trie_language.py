"""The filter audit, the prefix trie and language identification against brute-force versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from watchloom.llm import filter_audit, language_id, prefix_trie, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def clash(df):
    return df.withColumns({"part": F.lit("p"), "mask": F.lit(1), "n": F.lit(1), "id": F.lit("x"), "q": F.lit(1), "conv": F.lit("c"), "digest": F.lit("d"), "depth": F.lit(9), "score": F.lit("s"), "calibrates": F.lit(True), "same": F.lit("y"), "h": F.lit(0), "lang_pred": F.lit("zz")})


# --- filter audit ----------------------------------------------------------------------------------
def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def brute_audit(docs, labels):
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1 and i is not None} for k in (0, 1))
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    fails = []
    for i, t, s in docs:
        t = t or ""
        w = words(t)
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and least[t] < i}
        fails.append((i, s or "", {k for k, v in f.items() if v}))
    rows, total = {}, Counter()
    for part in {p for _, p, _ in fails}:
        for order in map("".join, permutations("ABCDE")):
            left = [(i, f) for i, p, f in fails if p == part]
            every = list(left)
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                before = sum(1 for _, f in every if x in f) - len(gone)
                rows[part, order, step] = (len(left), len(gone), before, sum(1 for _, f in every if f == {x}), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
                total[part, x] += len(gone)
    return Counter((p, o, s, *v, total[p, o[s - 1]]) for (p, o, s), v in rows.items())


@pytest.fixture(scope="module")
def audit_docs(spark):
    rng = np.random.default_rng(4)
    texts = []
    for k in range(60):
        w = [f"{'WORD' if k % 3 == 0 and i % 9 == 0 else 'word'}{rng.integers(0, 200 if k % 4 else 12)}" for i in range(30 + 2 * k)]
        texts.append(" ".join(w) + (" 5 % | é" if k % 5 == 0 else ""))
    texts += [None, "", " \t\v", "x y z", "ÀÉ " * 60, "long word " * 200_000 + "#"]
    rows = [(i * 7 % 211, t, "en", ["a", "b", "", None][i % 4], 1) for i, t in enumerate(texts)]
    rows += [(300 + i, texts[i % 7], "en", "a" if i % 3 else "c", 1) for i in range(80)]
    rows += [rows[5], rows[5], (None, texts[1], "en", "b", 1), (None, texts[1], "en", "b", 1), (None, None, None, None, None), (5, "another text", "en", "d", 1), (301, texts[3], None, "e", None), (-4, texts[9], None, "a", 3)]
    return clash(spark.createDataFrame(rows, DOCS)).repartition(5).cache()


@pytest.fixture(scope="module")
def audit_labels(spark):
    rows = [(i, i % 2, None if i % 7 == 0 else int(i % 5 == 0)) for i in range(0, 400, 3)] + [(6, 1, 0), (6, 0, 1), (None, 1, 1), (9999, 1, 1)]
    return clash(spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))


@pytest.mark.parametrize("held_bytes", [filter_audit.HELD_BYTES, 2000])
def test_filter_audit(spark, audit_docs, audit_labels, held_bytes, monkeypatch):
    docs = [(r.doc_id, r.text, r.source) for r in audit_docs.collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in audit_labels.collect()]
    want = brute_audit(docs, labels)
    monkeypatch.setattr(filter_audit.flagged, "__defaults__", (held_bytes,))
    got = Counter(map(tuple, filter_audit.report(audit_docs, audit_labels).collect()))
    assert got == want and len(got) == 600 * len({s or "" for _, _, s in docs})
    later = filter_audit.later_copies(audit_docs)
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    assert Counter(r.doc_id for r in later.collect()) == Counter(i for i, t, _ in docs if i is not None and least[t or ""] < i)


def test_filter_audit_sql_and_empty_tables(spark, audit_docs, audit_labels):
    documents = pd.DataFrame([(r.doc_id, r.text, r.source) for r in audit_docs.collect()], columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})  # noqa: F841
    labels = pd.DataFrame([(r.doc_id, r.quality, r.toxic) for r in audit_labels.collect()], columns=["doc_id", "quality", "toxic"]).astype("Int64")  # noqa: F841
    assert Counter(duckdb.sql(queries.OP11).fetchall()) == Counter(map(tuple, filter_audit.report(audit_docs, audit_labels).collect()))
    none = filter_audit.report(audit_docs, audit_labels.limit(0))
    assert none.agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0
    assert filter_audit.report(audit_docs.limit(0), audit_labels).count() == 0


def test_one_text_in_a_third_of_all_rows_moves_once_a_task(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("the same text")).otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"), F.lit("s").alias("source")).repartition(6)
    assert filter_audit.later_copies(docs).count() == 9_999
    n = docs.rdd.mapPartitions(filter_audit._route(filter_audit.HELD_BYTES)).filter(lambda x: x[1][0] == b"the same text").count()
    assert n <= docs.rdd.getNumPartitions()


def test_equal_fingerprints_are_told_apart_by_text(monkeypatch):
    monkeypatch.setattr(filter_audit, "fingerprint", lambda text: 7)
    rows = [(3, "a", "p"), (1, "b", "p"), (2, "a", "q"), (4, "b", "p"), (2, "a", "p"), (None, "a", "p")]
    sent = list(filter_audit._route(1 << 20)(iter(rows)))
    sent += list(filter_audit._route(1 << 20)(iter([(0, "b", "r"), (9, "c", "r")])))
    got = Counter()
    for i, p, m, n in filter_audit._resolve(iter(sorted(sent, key=lambda x: x[0]))):
        got[i, p, bool(m & filter_audit.COPY)] += n
    assert got == Counter({(3, "p", True): 1, (1, "p", True): 1, (2, "q", False): 1, (2, "p", False): 1, (4, "p", True): 1, (None, "p", False): 1, (0, "r", False): 1, (9, "r", False): 1})


# --- prefix trie -----------------------------------------------------------------------------------
TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            pair = (role or "", text or "")
            h = hashlib.sha256("".join(hashlib.sha256(x.encode()).hexdigest() for x in pair).encode()).digest()
            own[c].append(((turn is not None, turn or 0, h), pair))
    own = {c: [pair for _, pair in sorted(v)] for c, v in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + ts[h:])
    members, children = defaultdict(list), defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    for n in members:
        if n:
            children[n[:-1]].append(n)
    leaves, saved, out = {}, {}, []
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[x] for x in children[n]) or 1
        saved[n] = (len(members[n]) - 1) * (len(n[-1][1]) if n else 0) + sum(saved[x] for x in children[n])
        ends = sorted(c for c in members[n] if len(built[c]) == len(n))
        out.append((min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return Counter(out)


def conversations(long):
    rng = np.random.default_rng(6)
    rows = []
    for c in [*range(0, 130), 1000, 1001, 1150, -3, -100, -205]:
        for t in range(int(rng.integers(1, 9))):
            rows.append((c, t, "user" if t % 2 == 0 else None, [None, "", "hi", "héllo \U0001f600", f"text {c % 3}"][(t + c % 2) % 5]))
    rows += [(2000 + k, t, "user", f"turn {t}") for k in range(3) for t in range(long)]  # copies of a long one
    rows += [(3000, t, "user", f"turn {t}" if t < long // 2 else "other") for t in range(long)]
    rows += [(7, None, "system", "first"), (7, None, "a", "first"), (8, 2, "user", "tie"), (8, 2, "user", "tie"), (None, 1, "user", "nobody"), (9, 1, "user", "x" * 300_000)]
    return rows


@pytest.mark.parametrize("block", [4, prefix_trie.BLOCK])
def test_prefix_trie(spark, block):
    rows = conversations(60)
    turns = clash(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).repartition(4)
    got = prefix_trie.tree(turns, block).select(*TRIE)
    assert Counter(map(tuple, got.collect())) == brute_trie(rows)
    assert prefix_trie.report(turns.limit(0)).count() == 0


def test_prefix_trie_of_turnless_conversations_and_sql(spark):
    rows = [(c, 0, "user", "a") for c in range(1, 40)]  # many lend from conversation 0, which isn't there
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = brute_trie(rows)
    assert Counter(map(tuple, prefix_trie.report(turns).select(*TRIE).collect())) == want
    rows = [r for r in conversations(12) if r[0] != 8 and r[1] is not None]
    conversations_ = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    sql = queries.OP12.replace("from conversations", "from conversations_")
    assert Counter(duckdb.sql(f"select {', '.join(TRIE)} from ({sql})").fetchall()) == brute_trie(rows)


def test_copies_of_a_long_conversation_explode_no_rows(spark):
    rows = [(1000 + k, t, "user", f"turn {t}") for k in range(50) for t in range(40)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = prefix_trie.tree(turns)
    assert Counter(map(tuple, got.select(*TRIE).collect())) == brute_trie(rows)
    every = prefix_trie.cut(prefix_trie.prefixes(prefix_trie.rebuilt(turns)[0], 8))
    assert every.groupBy("conv").agg(F.count("*").alias("n"), F.max("depth").alias("d")).where("n <> d").count() == 0
    assert every.select("digest").distinct().count() == got.count() - 1


# --- language identification -----------------------------------------------------------------------
def normal(text):
    read = language_id.letters()
    x = [int(read[ord(c)]) for c in text + " "]
    out = [32] * 3
    for c in x:
        if c != 32 or out[-1] != 32:
            out.append(c)
    return out


def brute_kneser_ney(texts_by_lang):
    """log p(gram) in each language, by dictionaries and the recursive definition."""
    top = {}
    for lang, texts in texts_by_lang.items():
        top[lang] = Counter(tuple(x[i - 3 : i + 1]) for t in texts for x in [normal(t)] for i in range(3, len(x)))
    vocab = {g[-1] for c in top.values() for g in c}

    def model(counts):
        by = {4: counts}
        for k in (3, 2, 1):
            by[k] = Counter(g[1:] for g in by[k + 1])
        cut = {}
        for k, c in by.items():
            one, two = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
            cut[k] = min(0.95, max(0.1, one / (one + 2 * two))) if one else 0.1

        def p(g):
            k = len(g)
            if not k:
                return 1 / (1 + len(vocab))
            own = {x: n for x, n in by[k].items() if x[:-1] == g[:-1]}
            if not own:
                return p(g[1:])
            total = sum(own.values())
            return max(own.get(g, 0) - cut[k], 0) / total + cut[k] * len(own) / total * p(g[1:])

        return p

    return {lang: model(c) for lang, c in top.items()}


def test_models_equal_the_definition():
    corpora = {"aa": ["abab abba", "Ab ba bab", "x"], "bb": ["bcbc ccb bcb", "écbé É"], "cc": ["zz 一二 三"]}
    counts = {}
    for lang, own in corpora.items():
        every = np.concatenate([c for t in own for c in language_id.codes(t.encode())])
        counts[lang] = np.unique(every, return_counts=True)
    model = language_id.kneser_ney(counts)
    p = brute_kneser_ney(corpora)
    for text in ("abba cab", "éb z", "qqq 一x", "", "一二三四 b"):
        got = np.concatenate([model.logs(c) for c in language_id.codes(text.encode())])
        x = normal(text)
        assert len(got) == len(x) - 3
        for i in range(3, len(x)):
            want = [math.log(p[lang](tuple(x[i - 3 : i + 1]))) for lang in model.langs]
            assert np.allclose(got[i - 3], want, atol=1e-5), (text, i)
    # each context's probabilities sum to 1 over the alphabet and one unknown character
    alphabet = sorted({g[-1] for t in corpora.values() for x in t for g in zip(normal(x)[3:])} | {0x3042})
    code = np.array([(ord("a") << 32) + (ord("b") << 16) + c for c in alphabet], dtype=np.uint64)
    assert np.allclose(np.exp(model.logs(code)).sum(axis=0), 1, atol=1e-5)


def test_pieces_do_not_change_codes(monkeypatch):
    text = ("Straße  — naïve\n\t42 " * 50 + "日本 \U00010400").encode()
    whole = np.concatenate(list(language_id.codes(text)))
    monkeypatch.setattr(language_id, "PIECE", 7)
    assert np.array_equal(whole, np.concatenate(list(language_id.codes(text))))
    assert whole.tolist() == [sum(c << 16 * (3 - j) for j, c in enumerate(normal(text.decode())[i - 3 : i + 1])) for i in range(3, len(normal(text.decode())))]


def invented(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    rng = np.random.default_rng(2)
    tongues = {"xx": ["ka", "to", "mi", "ren"], "yy": ["sch", "un", "ber", "ich"], "zz": ["ção", "mi", "ou", "lha"]}
    rows = []
    for i in range(900):
        lang = list(tongues)[i % 3]
        rows.append((i, invented(rng, tongues[lang], int(rng.integers(4, 60))), lang if i % 10 else None, "s", 1))
    rows += [(5000, None, "xx", "s", 1), (5001, "", "yy", "s", 1), (5002, "12 34 !?", "zz", "s", 1), (None, rows[1][1], "yy", "s", 1), (None, None, None, None, None), rows[4], rows[4]]
    rows += [(6000 + i, rows[2][1], "xx", "s", 1) for i in range(500)]  # one text under a wrong label, many times
    rows += [(7000, invented(rng, tongues["yy"], 60_000), "yy", "s", 1), (7001, "щяю жыб эъё " * 30, None, "s", 1)]
    return rows, clash(spark.createDataFrame(rows, DOCS)).repartition(5).cache()


def test_languages(spark, spoken):
    rows, docs = spoken
    got = language_id.report(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    lang = {i: ["xx", "yy", "zz"][i % 3] for i in range(900)}
    held = [r for r in got if r.doc_id in lang and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(r.held_out for r in held) and len(held) > 150
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.99
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        assert 0 <= r.score <= 1
    for i in (5000, 5001, 5002):
        assert (by[i][0].lang_pred, by[i][0].score, by[i][0].accepted) == ("und", 0.0, False)
    assert sorted(r.lang_pred for r in by[None]) == ["und", "yy"]
    assert by[7000][0].lang_pred == "yy" and {r.lang_pred for r in by[6000]} == {"zz"}
    assert by[7001][0].lang_pred in ("xx", "yy", "zz") and by[7001][0].accepted  # too few calibration rows to show one in a hundred
    some = {r.doc_id: r["__accepted"] for r in language_id.identify(docs, language_id.train(docs, reject=0.05)).collect()}
    assert not some[7001]  # unlike any language
    assert np.mean([some[r.doc_id] for r in held]) > 0.85
    # neither labels of held-out rows nor any other column enters
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit("ww")).otherwise(F.col("lang"))).withColumn("source", F.lit("t")).repartition(3)
    assert Counter(map(tuple, language_id.report(other).collect())) == Counter(map(tuple, got))


def test_languages_without_anything_to_learn(spark, spoken):
    _, docs = spoken
    bare = docs.withColumn("lang", F.lit(None).cast("string")).limit(20)
    assert {(r.lang_pred, r.score, r.accepted) for r in language_id.report(bare).collect()} == {("und", 0.0, False)}
    assert language_id.report(docs.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "only one text", "xx", "s", 1), (3, "other", None, "s", 1)], DOCS)
    assert {r.lang_pred for r in language_id.report(one).collect()} == {"xx"}
    many = spark.range(language_id.MOST_LANGS + 1).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"), F.col("id").cast("string").alias("lang")).where(~language_id.held_out("doc_id", 4, 9))
    with pytest.raises(ValueError, match="languages are labelled"):
        language_id.drawn(many, 1000, 4, 9)


def test_share_of_each_language_is_bounded(spark):
    rng = np.random.default_rng(3)
    rows = [(i, invented(rng, ["ka", "to"], 40), "xx" if i % 10 else "yy", "s", 1) for i in range(4000)]
    docs = spark.createDataFrame(rows, DOCS)
    some = language_id.drawn(docs, 60_000, 4, 2).groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()
    size = {r.lang: r.n for r in some}
    assert 20_000 < size["xx"] < 40_000 and 20_000 < size["yy"] < 40_000
