"""Each operator against a brute-force version on a small fixture with nulls, ties, repeats, long texts and clashing columns."""

import hashlib
import json
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from watchloom.llm import chat, components, decontaminate, line_dedup, lm, mixing, near_dup, quality, token_counts, topk, toxicity
from watchloom.llm.common import Words, shingle_sets

def clash(df):
    return df.withColumns({"key": F.lit("k"), "n": F.lit(1), "sig": F.lit("s"), "score": F.lit("x"), "size": F.lit(None).cast("string"), "copies": F.lit(7), "u": F.lit(1), "row": F.lit(1), "host": F.lit("h"), "batch": F.lit(3), "kept": F.lit(True), "copy": F.lit(0)})


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LINE = "A line that is long enough to be counted"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t))


def make_texts():
    rng = np.random.default_rng(1)
    vocab = [f"w{i}é" if i % 7 == 0 else f"Word{i}" for i in range(400)]
    base = [[vocab[i] for i in rng.integers(0, 400, 120)] for _ in range(12)]
    out = []
    for b in base:
        for edits in (0, 0, 1, 2, 4, 8):
            w = list(b)
            for i in rng.integers(0, len(w), edits):
                w[i] = "edit%d" % rng.integers(0, 999)
            out.append(" ".join(w))
    out += [None, "", " \t\n", "one", "One  TWO", "one two", "one two three", " x y z", "z" * 300_000, " ".join(base[0]) + "\n" + " ".join(vocab[i] for i in rng.integers(0, 400, 30_000))]
    out += [f"intro {i} \n  {LINE.upper() if i % 2 else LINE} \n{LINE}\nshort\nout {i} of the ordinary" for i in range(5)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    t = make_texts()
    rows = [(i * 3 % 997, x, "en" if i % 3 else None, ["a", "b", "", None][i % 4], None) for i, x in enumerate(t)]
    rows += [rows[0], rows[0], (None, t[0], "en", "a", 1), (None, None, None, None, None)]
    return clash(spark.createDataFrame(rows, SCHEMA)).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def brute_components(rows, k, percent):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    at = [i for i, (d, _) in enumerate(rows) if d is not None and sets[i]]
    label = {i: i for i in at}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for x in at:
        for y in at:
            if x < y and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                label[find(y)] = find(x)
    least = {}
    for i in at:
        least[find(i)] = min(least.get(find(i), 1 << 60), rows[i][0])
    return Counter((d, len(s), least[find(i)] if i in label else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize("k, percent, block", [(3, 85, 512), (5, 80, 2), (3, 60, 3)])
def test_near_duplicates(docs, empty, k, percent, block):
    spec = near_dup.SketchSpec(words=k, percent=percent, block=block)
    got = near_dup.near_duplicates(docs, spec).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(collected(docs), k, percent)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    assert near_dup.near_duplicates(empty, spec).count() == 0


def test_sketches_merge_and_estimate():
    spec = near_dup.SketchSpec()
    family = near_dup.hash_family(spec)
    rng = np.random.default_rng(2)
    x = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    a, b = x[:2400], x[600:]
    sa, sb = near_dup.sketch(a, spec, family), near_dup.sketch(b, spec, family)
    assert (near_dup.merge(sa, sb) == near_dup.sketch(x, spec, family)).all()
    true = len(np.intersect1d(a, b)) / len(x)
    assert abs(near_dup.joint_jaccard(sa[None], sb[None], np.array([len(a)]), np.array([len(b)]))[0] - true) < 0.15
    assert near_dup.joint_jaccard(sa[None], sa[None], np.array([len(a)]), np.array([len(a)]))[0] > 0.99


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def test_word_hashes_see_the_same_words():
    t = make_texts()
    w = Words([x.encode() if x is not None else None for x in t])
    assert w.counts().tolist() == [len(words(x)) for x in t]
    h, seen = w.hashes(), {}
    for x, lo, hi in zip(t, w.bounds[:-1], w.bounds[1:], strict=True):
        for a, b in zip(words(x), h[lo:hi].tolist(), strict=True):
            assert seen.setdefault(a, b) == b
    assert len(set(seen.values())) == len(seen)
    assert [len(s) for s in shingle_sets([b"a b", b"", None, b"a b c d"], 3)] == [1, 0, 0, 2]


def test_language_model(docs, empty):
    got = lm.score_texts(docs).collect()
    rows = collected(docs)
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c = Counter(x for d, t in rows if not out(d) for x in [*words(t), None])
    n, v = sum(c.values()), len(c)

    def base(t):
        return sum(math.log10((c[x] + 1) / (n + v + 1)) for x in [*words(t), None])

    want = Counter((d, out(d), len(words(t)) + 1, sum(c[x] > 0 for x in [*words(t), None]), n, round(base(t), 3)) for d, t in rows)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm.score_texts(empty).count() == 0


def test_score_is_a_plain_forward_pass_on_any_layout(spark):
    rng = np.random.default_rng(6)
    vocab = [f"w{i}{'abc'[i % 3]}" for i in range(90)]
    rows = [(i, " ".join(vocab[int(j)] for j in rng.zipf(1.3, int(rng.integers(0, 80))) % 90)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    training = df.where(~lm.held_out("doc_id", 7, 2))
    v = lm.vocabulary(lm.token_counts(training.select("text")), training.count())
    p = lm.train(training, v)
    assert (v.slots >= 0).sum() > len(v.slots) + 20
    c = Counter(x for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2 for x in t.split())
    hashes = dict(zip(vocab, Words([x.encode() for x in vocab]).hashes(), strict=True))

    def distribution(h):
        """The probability of each token after the state h."""
        top = lm.log_softmax(h @ p["v"] + p["b"])
        out = {None: top[lm.END]}
        for x in vocab:
            w = Words([x.encode()])
            k, s = lm.classes_of(w, w.hashes(), v)[0], lm.slots_of(w.hashes(), v)[0]
            inner = lm.log_softmax(p["sv"][k] @ h + p["sb"][k])
            out[x] = top[k] + inner[s] + (0 if s else math.log((c[x] + 1) / v.mass[k]))
            out[k, "unknown"] = top[k] + inner[0] + math.log(1 / v.mass[k])
        return out, hashes

    def score(text):
        h, x, total = np.zeros((1, lm.HIDDEN), dtype=np.float32), lm.END, 0.0
        for token in [*text.split(), None]:
            h = lm.step(p, np.array([x]), h)[0]
            total += distribution(h[0])[0][token] / math.log(10)
            w = Words([(token or "").encode()])
            x = lm.classes_of(w, w.hashes(), v)[0] if token else lm.END
        return total

    for parts in (3, 11):
        got = {r.doc_id: r.score for r in lm.score_texts(df.repartition(parts)).collect()}
        for d, t in rows[:25]:
            assert abs(got[d] - score(t)) < 1e-3 * max(1, abs(got[d]))
    one = distribution(np.zeros(lm.HIDDEN, dtype=np.float32))[0]
    known = {lm.classes_of(Words([x.encode()]), Words([x.encode()]).hashes(), v)[0] for x in c if x is not None and Words([x.encode()]).hashes()[0] not in set(v.top.tolist())}
    assert abs(sum(math.exp(x) for k, x in one.items() if k is None or isinstance(k, str) and c[k] or isinstance(k, tuple) and k[0] in known) - 1) < 0.05


def test_every_training_document_moves_the_network(spark):
    for i in range(5):
        training = spark.createDataFrame([(1, f"word{i} and some more words of text {i}")], "doc_id long, text string")
        vocab = lm.vocabulary(lm.token_counts(training.select("text")), 1)
        p = lm.train(training, vocab)
        assert not np.allclose(p["u"], lm.start(vocab)["u"])


def test_gradient_and_carried_state():
    v = lm.Vocabulary(10, 3, 2, np.full(65536, 1, dtype=np.uint8), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint8), np.array([3.0, 8.0, 4.0]), np.array([2.0, 6.0, 2.0]), np.zeros(0, dtype=np.uint64), np.zeros(0))
    p = {k: w.astype(np.float64) for k, w in lm.start(v, hidden=4).items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 3, (6, 2)), rng.integers(0, 3, (6, 2))
    h = rng.normal(size=(2, 4))
    _, g, _ = lm.window_gradient(p, x, y, h)
    for k in p:
        i = tuple(rng.integers(0, s) for s in p[k].shape)
        for sign in (1, -1):
            q = {a: b.copy() for a, b in p.items()}
            q[k][i] += sign * 1e-5
            loss = lm.window_gradient(q, x, y, h)[0]
            up = loss if sign == 1 else up - loss
        assert abs(up / 2e-5 - g[k][i]) < 1e-4
    v.slots = np.array([[2.0, -1, -1], [3, 2, 1], [1, 1, -1]])
    p = {k: w.astype(np.float64) for k, w in lm.start(v, hidden=4).items()}
    slot, counts = np.where(y == 0, 0, rng.integers(0, 2, (6, 2))), rng.integers(0, 3, (6, 2)) > 0
    _, g, _ = lm.window_gradient(p, x, y, h, slot, counts)
    for k, i in (("sv", (1, 1, 2)), ("sb", (2, 0)), ("v", (3, 1)), ("u", (0, 5))):
        losses = []
        for sign in (1, -1):
            q = {a: b.copy() for a, b in p.items()}
            q[k][i] += sign * 1e-5
            losses.append(lm.window_gradient(q, x, y, h, slot, counts)[0])
        assert abs((losses[0] - losses[1]) / 2e-5 - g[k][i]) < 1e-4
    v.slots = None
    tail = np.array([1] * 67 + [0], dtype=np.uint8)  # no token is left over: the loss counts them all
    assert abs(lm.train_on(lm.start(v), tail, rate=0.0)[1] - lm.train_on(lm.start(v), tail, rate=0.0, streams=1)[1]) < 0.5
    ids = np.array([1, 2, 1, 1, 2, 0, 2, 0, 0], dtype=np.uint8)
    n = np.array([6, 2, 1])
    p = lm.start(v, hidden=4)
    assert np.allclose(lm.class_scores(p, ids, n, window=2), lm.class_scores(p, ids, n, window=50), atol=1e-4)
    nothing = lm.class_scores(p, np.array([0], dtype=np.uint8), np.array([1]))[0]
    by_hand = lm.step(p, np.array([0]), np.zeros((1, 4), dtype=np.float32))[0] @ p["v"] + p["b"]
    assert abs(nothing - (by_hand[0, 0] - np.log(np.exp(by_hand).sum()))) < 1e-4


def test_toxicity(spark, empty):
    rng = np.random.default_rng(4)
    vocab = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        w = [vocab[j] for j in rng.integers(0, 300, 80)]
        bad = i % 4 == 0
        if bad:
            for j in range(0, 80, 20):
                w[j] = ["vileword", "scoundrel", "wretched"][j // 20 % 3]
        rows.append((i, " ".join(w), "en", "s", 1))
        if i < 400:
            labels.append((i, None if i % 50 == 49 else 1, int(bad)))
    rows += [(9000, None, None, None, None), (9001, "", None, None, None), (None, "x", None, None, None), rows[0]]
    docs = clash(spark.createDataFrame(rows, SCHEMA))
    got = toxicity.report(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    new = [r for r in got if r.doc_id is not None and 400 <= r.doc_id < 600]
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in new]) > 0.97
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.report(docs, none).collect()} == {0.0}
    assert toxicity.report(empty, none).count() == 0


def test_toxic_stems_pairs_and_sample(spark):
    rng = np.random.default_rng(8)
    vocab = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(300)]

    def text(marks):
        w = [vocab[j] for j in rng.integers(0, 298, 60)]
        return " ".join(w[:20] + marks + w[20:]).encode()

    short, pair = ["scum", "oaf"], [vocab[298], vocab[299]]
    rows = [(text([short[i % 2]]), 1, 1.0) for i in range(60)] + [(text(pair), 1, 1.0) for _ in range(60)] + [(text([pair[1], vocab[i], pair[0]]), 0, 1.0) for i in range(290)]
    model = toxicity.train(rows)
    gains = toxicity.Gains(model)
    assert gains.gain(b" scum ") > 0 and gains.gain(b" oaf ") > 0
    new = [text([x]) for x in short] + [text(pair), text([]), text(pair[:1]), text(pair[::-1])]
    p = toxicity.logistic.predict(model.weights, np.array([toxicity.features(t, gains) for t in new]))
    assert list(p >= 0.5) == [True, True, True, False, False, False]
    # all windows by brute force, in pieces of any size
    run = lambda x: {x[i : i + toxicity.RUN] for i in range(len(x) - toxicity.RUN + 1)}
    own_runs = run(model.toxic)
    for t in [t for t, *_ in rows[:80]] + [b"", b"scum", b"an oaf", b"x scum y", "é scum ü oaf".encode()]:
        w = t.lower().split()
        lines = [b" " + b" ".join(w[i : i + toxicity.WINDOW]) + b" " for i in range(max(1, len(w) - toxicity.WINDOW + 1))] if w else []
        want = [g for x in lines if run(x) & own_runs and (g := gains.gain(x))]
        old = toxicity.PIECE
        for toxicity.PIECE in (old, 3):
            assert gains.of_words(toxicity.words(t)) == want
        toxicity.PIECE = old
    length = lambda x, content: len(toxicity.compressor(content).compress(x + toxicity.CARRIER))
    x = b" w scum v "
    assert gains.gain(x) == max(0, length(x, model.ordinary) - length(x, model.ordinary + model.toxic))
    one, two = text([]), text([])
    assert toxicity.different([one, one, two, None, b"", b"a", b"a"]) == [one, two, b"a"]
    # the rare label has its half of the sample; a text over the limit of bytes doesn't end it
    docs = spark.createDataFrame([(i, "x" * (5000 if i == 7 else 10), "en", "s", 1) for i in range(1000)], SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 50 == 7)) for i in range(1000)], "doc_id long, quality int, toxic int")
    rows = toxicity.labelled(docs, labels, "toxic", max_rows=40, max_bytes=1000, folds=1, fold=1)
    assert Counter(y for _, y, _ in rows) in ({0: 20, 1: 20}, {0: 20, 1: 19}) and all(len(t) == 10 for t, _, _ in rows)
    assert sum(u for _, y, u in rows if y) / sum(u for *_, u in rows) == pytest.approx(0.02)


def test_decontamination(spark, docs, empty):
    t = make_texts()
    items = [(1, t[0]), (2, " ".join(t[6].split()[:14]).upper()), (10, "one two"), (11, "!!!"), (12, None), (13, "z" * 300_000), (14, "one two"), (None, " ".join(t[12].split()[:11]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    hit_words = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(x))
    wins = defaultdict(set)
    for i, x in items:
        w = hit_words(x)
        for a in range(max(1, len(w) - 9)) if w else ():
            wins[tuple(w[a : a + 10])].update([str(i)] if i is not None else [])
    sizes = {len(k) for k in wins}
    want = Counter()
    for d, x in collected(docs):
        w, hit, found = hit_words(x), set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                if (got := wins.get(tuple(w[a : a + k]))) is not None:
                    hit.update(range(a, a + k))
                    found |= got
        at = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(x))]
        ends = (at[min(hit)][0], at[max(hit)][1]) if hit else (None, None)
        want[d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit), *ends] += 1
    assert any(k[5] and not k[3] for k in want)  # hit by the item without an id only
    for limit in (10**7, 100):  # one automaton, and several one after another
        old, decontaminate.MAX_CHARS = decontaminate.MAX_CHARS, limit
        got = decontaminate.contamination(docs.select("doc_id", "text"), bench, max_chars=limit)
        hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0] + 1)
        assert Counter((r[0], r[1], r[2], r[3]) for r in got.select("doc_id", "__n_words", hit, F.size("__items")).collect()) == Counter({k: v for k, v in _cut(want, 4).items()})
        decontaminate.MAX_CHARS = old
    assert Counter(tuple(r) for r in decontaminate.report(docs, bench).collect()) == want
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(v for k, v in want.items() if not k[5])
    assert decontaminate.clean(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.report(empty, bench).count() == 0
    assert [("Ä-b c!"[a:b]) for a, b in decontaminate.char_spans("Ä-b c!", [[0, 1]])] == ["Ä-b"]


def _cut(counter, n):
    out = Counter()
    for k, v in counter.items():
        out[k[:n]] += v
    return out


def test_chat(spark):
    def conv(i, *turns):
        return [(i, k, r, t) for k, (r, t) in enumerate(turns)]

    a, b, c = ("user", "hi"), ("assistant", "hello"), ("user", None)
    rows = conv(1, a) + conv(2, a, b) + conv(3, a, b, c) + conv(4, a, b, c) + conv(5, b, a) + conv(6, ("user", "hi "), b) + conv(7, (None, "x")) + [(None, 0, "user", "lost"), (8, None, "user", "late"), (8, 0, "user", "first"), (9, 0, "user", "t"), (9, 0, "user", "t")]
    rows += [(20, k, "user", f"long {k}") for k in range(40)] + [(21, k, "user", f"long {k}") for k in range(25)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"k": F.lit(1), "conv": F.lit(2), "ts": F.lit(3)})
    for block in (4, 512):
        got = {r.conv_id: (r.n_turns, r.logged, r.text) for r in chat.chat_documents(turns, block).collect()}
        assert set(got) == {3, 5, 6, 7, None, 8, 9, 20} and got[3][:2] == (3, 2) and got[20][0] == 40
        assert got[3][2] == "<|user|>\nhi\n<|end|>\n<|assistant|>\nhello\n<|end|>\n<|user|>\n\n<|end|>\n"
        assert got[8][2].index("first") < got[8][2].index("late") and got[7][2].startswith("<|unknown|>") and got[9][0] == 2
    assert chat.report(turns.limit(0)).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(700, 16)) * rng.gamma(2, 1, (700, 1))
    v[50:90] = v[50]
    rows = [(i, [float(x) for x in v[i]]) for i in range(700)] + [(700, None), (750, [1.0, None]), (800, [float("nan")] * 16), (850, [float("inf")] + [0.0] * 15), (900, [3.0] * 4), (950, []), (None, [1.0] * 16), (51, [float(x) for x in v[51]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"rank": F.lit(1), "score": F.lit(2), "id": F.lit(3)})
    usable = [(i, np.pad(np.floor(256 * np.array(x)), (0, 16 - len(x))).astype(int)) for i, x in rows if i is not None and x is not None and all(y is not None and math.isfinite(y) for y in x)]
    want = set()
    for q, x in {i: x for i, x in usable if i % 50 == 0}.items():
        best = sorted(((-int(x @ y), i) for i, y in usable if i != q))[:5]
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    for bucket, block, group in ((512, 4096, 16), (16, 3, 1), (16, 3, 2)):
        got = topk.top_k(df, df.where("vec_id % 50 = 0"), bucket=bucket, block=block, group=group)
        assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == want
    assert topk.report(df.limit(0)).count() == 0 and topk.report(df.where("vec_id = 0")).count() == 0
    twin = spark.createDataFrame([(50, [1.0, None]), (50, [1.0, 2.0]), (50, None), (50, [float("nan"), 0.0]), (51, [3.0, 0.0]), (52, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.rank, r.vec_id) for r in topk.report(twin).orderBy("rank").collect()] == [(1, 51), (2, 52)]
    big = np.array([[2.0**40, -3.0]])
    assert topk.products(big, big).tolist() == [[np.iinfo(np.int64).max]]


def test_token_counts(spark, docs, tmp_path):
    r = token_counts.TokenRollup(spark, f"{tmp_path}/r", tokenizers=("words", "bytes"))
    ins = docs.select("source", "lang", F.lit("insert").alias("op"), "text", F.lit(None).cast("string").alias("old_text"))
    assert r.commit("b1", ins) and not r.commit("b1", ins)
    gone = ins.select("source", "lang", F.lit("delete").alias("op"), F.lit(None).cast("string").alias("text"), F.col("text").alias("old_text")).where("source = 'a'")
    other = spark.createDataFrame([("b", None, "revise", "one two three", "one two"), ("b", None, "noop", "x", "y")], "source string, lang string, op string, text string, old_text string")
    assert r.commit("b2", gone) and r.commit("b3", other)
    want = defaultdict(lambda: [0, 0])
    for x in docs.select("source", "lang", "text").collect():
        if x.source != "a":
            for name, n in (("words", len(words(x.text))), ("bytes", len((x.text or "").encode()))):
                want[x.source, x.lang, name][0] += 1
                want[x.source, x.lang, name][1] += n
    want["b", None, "words"][1] += 1
    want["b", None, "bytes"][1] += 6
    read = lambda: {(x.source, x.lang, x.tokenizer): [x.n_docs, x.n_tokens] for x in r.totals().collect()}
    assert read() == want
    r.compact()
    assert read() == want and not r.commit("b2", gone) and r.committed() >= {"b1", "b2", "b3"}
    import tiktoken

    ranks = token_counts.rank_bytes(token_counts.BPE_FILE)
    t = [x.encode() if x else None for x in make_texts()[:90] if x is None or len(x) < 9999]
    enc = token_counts.encoding("t", ranks)
    assert isinstance(enc, tiktoken.Encoding)
    got = token_counts.count_tokens(t, "t", ranks)
    assert got.tolist() == [len(enc.encode_ordinary(x.decode())) if x else 0 for x in t] and enc.decode(enc.encode_ordinary("Héllo")) == "Héllo"


def test_token_report_is_the_sum_of_its_deltas(spark, docs, empty):
    import duckdb
    import pandas as pd

    got = token_counts.report(docs, tokenizers=("words", "bytes", f"bpe:{token_counts.BPE_FILE}")).collect()
    documents = pd.DataFrame([(r.source, r.lang, r.text) for r in docs.select("source", "lang", "text").collect()], columns=["source", "lang", "text"]).astype("string")  # noqa: F841
    sql = """with t as (select source, lang, trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as text from documents),
    n as (select source, lang, 'words' as tokenizer, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as n from t where text <> '' union all select source, lang, 'bytes', strlen(text) from t where text <> '')
    select source, lang, tokenizer, count(*), sum(n)::bigint from n group by all"""
    assert {tuple(r) for r in got if not r.tokenizer.startswith("bpe")} == set(duckdb.sql(sql).fetchall())
    enc = token_counts.encoding("t", token_counts.rank_bytes(token_counts.BPE_FILE))
    want = defaultdict(lambda: [0, 0])
    for source, lang, text in documents.itertuples(index=False):
        text = ("" if pd.isna(text) else text).strip(" \t\n\x0b\x0c\r")
        if text:
            want[None if pd.isna(source) else source, None if pd.isna(lang) else lang][0] += 1
            want[None if pd.isna(source) else source, None if pd.isna(lang) else lang][1] += len(enc.encode_ordinary(text))
    assert {(r.source, r.lang): [r.n_docs, r.n_tokens] for r in got if r.tokenizer.startswith("bpe")} == want
    assert token_counts.report(empty, tokenizers=("words",)).count() == 0


def brute_lines(rows, least=3):
    holders = defaultdict(set)
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    for d, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 20:
                holders[k].add(d)
    out = Counter()
    for d, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if not (len(holders[key(x)]) >= least and d != max(holders[key(x)], key=lambda i: (i is not None, i or 0)))]
        out[d, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    return out


def test_line_dedup(spark, docs, empty):
    twice = [(1, LINE + " a"), (1, LINE + " a\n" + LINE + " b"), (2, LINE + " a\n" + LINE + " b"), (3, LINE + " b"), (4, LINE + " b\nx"), (4, LINE + " b"), (None, LINE + " b")]
    every = docs.unionByName(clash(spark.createDataFrame([(i, t, None, None, None) for i, t in twice], SCHEMA)))
    want = brute_lines(collected(every))
    assert sum(v for k, v in want.items() if k[2]) > 3
    for bits in (line_dedup.BITS, 64):
        got = line_dedup.fold(every.select("doc_id", "text", "key", "batch"), bits=bits)
        assert {"key", "batch"} <= set(got.columns)
        assert Counter((r[0], r[1], r[2], r[3]) for r in got.select("doc_id", "__n_lines", "__n_dropped", F.sha2("__text", 256)).collect()) == want
    assert Counter(tuple(r) for r in line_dedup.report(every).collect()) == want
    assert line_dedup.report(empty).count() == 0
    # the SQL has the same rule for repeated and missing ids
    import duckdb
    import pandas as pd

    from watchloom.llm import queries

    documents = pd.DataFrame(collected(every), columns=["doc_id", "text"]).astype({"doc_id": "Int64", "text": "string"})  # noqa: F841
    sql = queries.OP8.replace("from documents", "from (select doc_id::bigint as doc_id, text from documents)")
    assert Counter(duckdb.sql(sql).fetchall()) == want


def test_line_runs_compact_and_know_what_is_new(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for b in range(5):
        batch = spark.createDataFrame([(b, bytes([b])), (b, b"x")], "doc_id long, key binary")
        new = {bytes(r.key) for r in runs.unseen(batch).collect()}
        assert new == ({bytes([b]), b"x"} if b == 0 else {bytes([b])})
        assert runs.add(batch)
    assert runs.runs() == [(2, 0, 3), (0, 4, 4)]
    want = {b"x": (5, 4), **{bytes([b]): (1, b) for b in range(5)}}
    read = lambda runs: {bytes(r.key): (r.n_docs, r.max_id) for r in runs.entries().collect()}
    assert read(runs) == want
    # merging needs no shuffle of the runs
    plan = runs.unseen(spark.createDataFrame([(9, b"y")], "doc_id long, key binary").repartition(runs.buckets, "key"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1


def test_line_runs_survive_a_kill_between_and_within_batches(spark):
    batches = [spark.createDataFrame([(b, bytes([b])), (b, b"x"), (b, bytes([b - 1]) if b else b"z")], "doc_id long, key binary") for b in range(4)]
    whole, broken = line_dedup.LineRuns(spark, fanout=2), line_dedup.LineRuns(spark, fanout=2)
    for b in batches:
        whole.add(b)
    for b in batches[:2]:
        broken.add(b)
    # batch 2 dies after its sightings and half a run; the next session reads the folder
    batches[2].groupBy("key").agg(F.lit(9).cast("long").alias("n_docs"), F.max("doc_id").alias("max_id")).write.parquet(f"{broken.path}/sightings/2")
    batches[2].select("key").write.parquet(f"{broken.at}/0-2-2")
    fs, path = broken._fs()
    fs.delete(path(f"{broken.at}/0-2-2/_SUCCESS"), False)
    again = line_dedup.LineRuns(spark, broken.path, fanout=2, buckets=99)
    assert again.buckets == broken.buckets and again.next_batch() == 2
    assert not again.add(batches[1], 1) and again.add(batches[2], 2) and again.add(batches[3], 3)
    read = lambda runs: sorted((bytes(r.key), r.n_docs, r.max_id) for r in runs.entries().collect())
    assert read(again) == read(whole) and again.runs() == whole.runs()
    again.forget()
    assert not fs.exists(path(broken.path))


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left, rest = total - sum(2 * sizes[s] for s in full), sum(w[s] for s in sizes if s not in full)
        t = {s: 2 * sizes[s] if s in full else w[s] * left / rest for s in sizes}
        over = {s for s in sizes if s not in full and t[s] >= 2 * sizes[s]}
        if not over:
            return t
        full |= over


def test_mixing(spark, docs, empty):
    got = mixing.report(docs).collect()
    src = docs.select("doc_id", "source", "text").collect()
    sizes = defaultdict(int)
    for r in src:
        sizes[r.source] += len(words(r.text))
    aims = brute_targets(sizes)
    by = defaultdict(int)
    assert len(got) == len(src)
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 3)) for r in got) == Counter((r.doc_id, len(words(r.text)), sizes[r.source], round(float(aims[r.source]), 3)) for r in src)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        by[round(r.target, 3)] += r.taken
    for s, t in aims.items():
        assert abs(by[round(float(t), 3)] - t) <= 0.02 * t + 10 or s is None or sizes[s] > 25_000  # one text of 30,000 words can't be cut
    again = mixing.report(docs.repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    rows = mixing.mixture(docs)
    assert rows.columns == [*docs.columns, "__copy"]
    assert rows.count() == sum(r.copies for r in got)
    assert mixing.report(empty).count() == 0 and mixing.mixture(empty).count() == 0
    # rates are the exponential tilt that meets the target, by bisection here
    by_source = defaultdict(Counter)
    for r in src:
        if n := len(words(r.text)):
            by_source[r.source][n] += 1
    sizes_of = spark.createDataFrame([(s, z, n) for s, c in by_source.items() for z, n in c.items()], "source string, size long, n long")
    for r in mixing.balance(sizes_of, spark.createDataFrame([(s, sizes[s], float(aims[s])) for s in by_source], "source string, source_size long, target double")).collect():
        c = next(c for s, c in by_source.items() if abs(sum(z * n for z, n in c.items()) / c.total() - r.mean) < 1e-9)
        t = float(aims[next(s for s in by_source if by_source[s] is c)])
        have = lambda lam: sum(n * z * min(2.0, math.exp(min(50, lam * z / r.mean))) for z, n in c.items())
        if r.lam is None:
            assert t >= 2 * sum(z * n for z, n in c.items()) - 1e-6
            continue
        low, high = -1e4, 1e4
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if have(mid) < t else (low, mid)
        assert abs(have(r.lam) - t) < 1e-5 * t and abs(r.lam - mid) < 1e-3 * max(1, abs(mid))
    twins = spark.createDataFrame([(1, "a b c", "en", "s", n % 7) for n in range(20)] + [(2, "x y z w " * 9, "en", "t", 0)], SCHEMA)
    first, second = (Counter(tuple(r) for r in mixing.mixture(twins.repartition(k)).collect()) for k in (2, 5))
    assert first == second and len(first) > 3
    parts = mixing.copies(mixing.sized(docs), part_rows=1)
    assert Counter((r.id, r.copies * r.size) for r in parts.collect()).total() == len(got)


def test_quality(spark, empty):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(500):
        good = i % 3 != 0
        w = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(60)]
        rows.append((i, " ".join(w if good else [x + "%%%" for x in w]), "en", "rare" if i < 3 else f"s{i % 4}", 1))
        if i < 300:
            labels.append((i, int(good), None))
    rows += [(9000, None, None, None, None), (None, "", None, None, None), rows[0]]
    docs = clash(spark.createDataFrame(rows, SCHEMA))
    y = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.report(docs, y).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    new = [r for r in got if r.doc_id is not None and 300 <= r.doc_id < 500]
    assert np.mean([r.kept == (r.doc_id % 3 != 0) for r in new]) > 0.97
    assert quality.report(docs, y.limit(0)).count() == len(rows) and quality.report(empty, y).count() == 0


def test_sparse_sites_shrink(spark):
    paths = spark.createDataFrame([("a", "a/x", 1000, 900.0), ("b", "b/x", 1000, 100.0), ("c", "c/x", 1, 1.0), (None, None, 2, 1.0)], "host string, path string, n long, s double")
    got = {r.host: r for r in quality.posteriors(paths).collect()}
    assert got["a"].host_mean > 0.88 and got["b"].host_mean < 0.12 and 0.5 < got["c"].host_mean < 0.95 and abs(got["c"].prior - 1002 / 2003) < 1e-9


def test_names_are_registered():
    import __spark_entry__ as e

    names = set(e.queries())
    assert {int(re.match(r"op(\d+)_", x)[1]) for x in names if x.startswith("op")} == set(range(1, 14)) and "pipeline" in names
    assert json.dumps(sorted(e.oracle_sql()))


def test_keep_one_of_repeated_ids_and_rows(spark, empty):
    rng = np.random.default_rng(3)
    text = lambda: " ".join(f"w{i}" for i in rng.integers(0, 10**6, 60))
    a, b, c = text(), text(), text()
    b2 = b.replace(b.split()[0], "other")
    rows = [(1, a), (5, a), (5, b), (7, b2), (9, c), (9, c), (None, c), (None, a + " more"), (None, text()), (3, None), (3, ""), (4, " ")]
    docs = clash(spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(rows)], SCHEMA)).repartition(4)
    spec = near_dup.SketchSpec()
    got = near_dup.keep_one(docs, spec)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(1, a), (5, b), (9, c), (None, rows[8][1]), (3, None), (3, ""), (4, " ")])
    assert near_dup.keep_one(empty, spec).count() == 0
    # two linked documents, each many times: rows stay in proportion to the input
    many = spark.range(10_000).selectExpr("id % 2 as i").select("i", F.when(F.col("i") == 0, b).otherwise(b2).alias("text")).select(F.col("i").alias("doc_id"), "text")
    assert [(r.doc_id, r.text) for r in near_dup.keep_one(many, spec).collect()] == [(0, b)]
    assert near_dup.near_duplicates(many, spec).where("component_id = 0 and kept = (doc_id = 0)").count() == 10_000
