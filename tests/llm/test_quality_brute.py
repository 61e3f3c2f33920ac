"""Quality: features, shrinkage, posteriors and scores computed again in plain Python, with hosts and paths of URLs."""

import math
import re
import statistics
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from watchloom.llm import quality

SPACES = " \t\n\v\f\r"


def plain_features(text):
    """Each share by its own loop over the bytes."""
    b = (text or "").encode()
    own = [w for w in re.split(rb"[ \t\n\v\f\r]+", b) if w]
    n, w = max(1, len(b)), max(1, len(own))
    share = lambda f: sum(1 for x in b if f(x))
    upper, lower, digit, high = share(lambda x: 65 <= x <= 90), share(lambda x: 97 <= x <= 122), share(lambda x: 48 <= x <= 57), share(lambda x: x >= 128)
    space = share(lambda x: chr(x) in SPACES)
    plain = share(lambda x: chr(x) in "!',-.:;?")
    other = len(b) - upper - lower - digit - high - space
    lens = [len(x) for x in own] or [0]
    lines = b.split(b"\n")
    return [
        math.log1p(len(own)), (upper + lower) / n, digit / n, upper / n, space / n, (other - plain) / n, plain / n, min(1.0, 20 * (other - plain) / n),
        statistics.fmean(lens) / 10, statistics.pstdev(lens) / 10, len(set(own)) / w, len(set(own)) / math.sqrt(w) / 10, len(set(lines)) / len(lines), math.log1p(n / len(lines)), min(1.0, b.count(b".") / w * 5), float(not b),
        sum(x <= 1 for x in lens) / len(lens), sum(b.count(x) for x in (b"{", b"}", b"<", b">", b";")) / n, b.count(b"/") / n, b.count(b"@") / n,
    ]


def plain_strength(groups):
    """k of groups (n, sum, mean above): variance of one document over the spread between groups beyond chance."""
    v = [max(m * (1 - m), 1e-6) for _, _, m in groups]
    between = sum(n * (s / n - m) ** 2 for n, s, m in groups) - sum(v) + statistics.fmean(v)
    total = sum(n for n, _, _ in groups)
    size = total - sum(n * n for n, _, _ in groups) / total
    tau = between / size if size > 0 else 0
    return min(statistics.fmean(v) / tau, quality.MAX_STRENGTH) if tau > 0 else quality.MAX_STRENGTH


@pytest.fixture(scope="module")
def pages(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(420):
        host = f"h{min(i % 40, 5)}.example"  # one host has most pages
        good = rng.random() < (0.9 if host in ("h0.example", "h5.example") else 0.3)
        words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(int(rng.integers(5, 50)))]
        rows.append((i, " ".join(w if good else w + "%%" for w in words) + ("." if good else "\n{;}<>"), f"http://{host}/{'ab'[i % 2]}/{i}", int(good)))
    rows += [(1000 + k, "Only page of a site. " * 3, f"http://lone{k}.example/x/1", 1) for k in range(12)]
    rows += [(2000, None, None, 0), (2001, "", "http://h0.example/a/z", 0), (2002, "long words, " * 300_000 + "@/", "http://h1.example/a/long", 1), rows[3], (None, rows[4][1], rows[4][2], 0)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, url string, good int").repartition(5).cache()


def test_features_by_hand():
    for t in (None, "", "One two, two.\n\nX/y@z {a};<b>", "é 12 - 'q'!\n\n\n", "a " * 500):
        assert np.allclose(quality.features(None if t is None else t.encode()), plain_features(t)), t


def test_scores_by_hand(spark, pages):
    rows, df = pages
    sample = [(t.encode() if t is not None else None, g) for i, t, _, g in rows if i is not None and i < 300]
    model = quality.train(sample)
    url = F.col("url")
    host, path = F.parse_url(url, F.lit("HOST")), F.concat_ws("/", F.parse_url(url, F.lit("HOST")), F.element_at(F.split(F.parse_url(url, F.lit("PATH")), "/"), 2))
    got = quality.quality(df, model, host, path).collect()

    x = np.array([plain_features(t.decode() if t is not None else None) for t, _ in sample])
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    clipped = lambda t: np.clip((np.array(plain_features(t)) - mean) / spread, -8, 8)
    own = []
    for _, t, u, _ in rows:
        z = model.weights[0] + clipped(t) @ model.weights[1:]
        p = min(max(1 / (1 + math.exp(-min(40, max(-40, z)))), 1e-6), 1 - 1e-6)
        h = u.split("/")[2] if u else None
        own.append((p, h, f"{h}/{u.split('/')[3]}" if u else ""))
    prior = statistics.fmean(p for p, _, _ in own)
    hosts, paths = defaultdict(list), defaultdict(list)
    for p, h, q in own:
        hosts[h].append(p)
        paths[h, q].append(p)
    k1 = plain_strength([(len(v), sum(v), prior) for v in hosts.values()])
    host_mean = {h: (sum(v) + k1 * prior) / (len(v) + k1) for h, v in hosts.items()}
    k2 = plain_strength([(len(v), sum(v), host_mean[h]) for (h, _), v in paths.items()])
    path_mean = {k: (sum(v) + k2 * host_mean[k[0]]) / (len(v) + k2) for k, v in paths.items()}
    logit = lambda v: math.log(v / (1 - v))
    want = Counter()
    for (i, *_), (p, h, q) in zip(rows, own, strict=True):
        score = 1 / (1 + math.exp(-(logit(p) + logit(path_mean[h, q]) - logit(prior))))
        want[i, round(p, 6), round(host_mean[h], 6), round(path_mean[h, q], 6), round(score, 5)] += 1
    assert Counter((r.doc_id, round(r.own, 6), round(r.host_mean, 6), round(r.path_mean, 6), round(r.score, 5)) for r in got) == want
    # one page doesn't make a site: its mean stays nearer to the global one than the page is
    lone = next(r for r in got if r.doc_id == 1000)
    assert abs(lone.host_mean - prior) < abs(lone.own - prior) and 0 < k1 < quality.MAX_STRENGTH
