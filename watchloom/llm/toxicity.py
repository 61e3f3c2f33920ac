"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on toxic text. A text is cut into
windows of ``WINDOW`` words, one beginning at each word; a window is compressed with the ordinary
dictionary alone and with the toxic one behind it, and the bytes that the second length saves over the first are its gain.
As both sides hold the ordinary dictionary, what all texts share cancels out. The numbers of windows whose gain
reaches 1, 2, ... ``LEVELS`` bytes are what a logistic calibration, fitted on the labelled rows, weighs.

Toxic texts are ordinary but for a few words. A dictionary trained on all their words learns the others,
so that the toxic one is trained on those words of toxic texts that begin like words typical of them
(beginnings of 4 to 12 bytes), and on typical pairs of words of which neither is marked alone. Typical means a
likelihood ratio of document frequencies that chance passes with ``CHANCE`` among all beginnings or pairs tried;
documents that copy one another count once.

Both sides end with ``CARRIER``, and so does each window that is compressed: zstandard never looks for
matches in the last 8 bytes of its input and stores what saves less than 2 bytes. Only windows with a run of
``RUN`` bytes that the toxic dictionary holds are compressed, all others gain nothing.

Labels are learned from at most ``max_rows`` labelled rows and ``max_bytes`` of text, never from fold 0 of 5 by
crc32 of the id. Either label has half of the rows or all that it has (the rows with the least hash of
their id); the calibration weighs them back to their shares among all labels. A text that would pass
``max_bytes`` is left out of the sample. The ordinary dictionary is trained on all ordinary texts of the
sample. Every text is scored whole, a very long one in
pieces that overlap. No other column enters a score.

Null and empty texts get the calibration's score of zero windows. Without labels of both kinds the
score is the share of toxic labels, 0 where there is none. Rows that repeat come back as often;
labels that repeat or contradict each count. Null labels are left out. Other columns pass through; ``docs`` must
have none named ``__score``.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import logistic
from .common import Words, chunks, held_out, shingles, texts

FOLDS, FOLD = 5, 0
MAX_ROWS, MAX_BYTES = 8000, 96 << 20
WINDOW = 3
LEVELS = 8
RUN = 5
CHANCE = 0.05
SIZE = 1 << 16
CARRIER = bytes(range(128, 160))
PIECE = 1 << 17  # windows looked at at once
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_LOWER).split()


@dataclass
class Model:
    prior: float
    toxic: bytes = b""
    ordinary: bytes = b""
    trained: tuple[bool, bool] = (False, False)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """All of ``content`` is indexed and can be pointed at."""
    log = max(13, (len(content) + len(CARRIER)).bit_length() + 1)
    p = zstandard.ZstdCompressionParameters(window_log=log, hash_log=log, chain_log=log, search_log=6, min_match=3, target_length=16, strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False)
    d = zstandard.ZstdCompressionDict(content + CARRIER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=p)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=p)


def runs(text: np.ndarray) -> np.ndarray:
    """The codes of all runs of ``RUN`` bytes."""
    n = max(0, len(text) - RUN + 1)
    code = np.zeros(n, dtype=np.uint64)
    for i in range(RUN):
        code = (code << np.uint64(8)) | text[i : i + n].astype(np.uint64)
    return code


def folded(codes: np.ndarray) -> np.ndarray:
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)


class Gains:
    """Bytes that windows save by the toxic dictionary."""

    def __init__(self, model: Model):
        self.ordinary, self.toxic = compressor(model.ordinary), compressor(model.ordinary + model.toxic)
        self.own = np.unique(runs(np.frombuffer(model.toxic, dtype=np.uint8)))
        self.may = np.zeros(1 << 18, dtype=bool)
        self.may[folded(self.own)] = True

    def marked(self, text: np.ndarray) -> np.ndarray:
        """Where a run begins that the toxic dictionary holds."""
        codes = runs(text)
        at = np.flatnonzero(self.may[folded(codes)])
        if not len(at):
            return at
        near = np.minimum(np.searchsorted(self.own, codes[at]), len(self.own) - 1)
        return at[self.own[near] == codes[at]]

    def gain(self, window: bytes) -> int:
        window += CARRIER
        return max(0, min(LEVELS, len(self.ordinary.compress(window)) - len(self.toxic.compress(window))))

    def of_words(self, own: list[bytes]) -> list[int]:
        """The gains of all windows that gain anything."""
        found = []
        for lo in range(0, max(1, len(own) - WINDOW + 1) if own else 0, PIECE):
            part = own[lo : lo + PIECE + WINDOW - 1]
            line = b" " + b" ".join(part) + b" "
            text = np.frombuffer(line, dtype=np.uint8)
            blank = np.flatnonzero(text == 32)
            k = min(WINDOW, len(part))
            first, last = blank[:-k], blank[k:]
            marked = self.marked(text)
            some = np.searchsorted(marked, last - RUN + 2) > np.searchsorted(marked, first)  # a run that lies within
            found += [g for i in np.flatnonzero(some) if (g := self.gain(line[first[i] : last[i] + 1]))]
        return found


def features(text: bytes | None, gains: Gains) -> list[float]:
    own = words(text)
    n = max(1, len(own))
    counts = np.bincount(gains.of_words(own), minlength=LEVELS + 1)
    reach = counts[::-1].cumsum()[::-1][1:]
    return [math.log((x + 0.5) / (n + 50)) for x in reach] + [math.log(n + 1)] + [float(min(x, 3)) for x in reach]


def beginnings(own: set[bytes], among: dict) -> set[bytes]:
    return {x[:n] for w in own for x in (b" " + w + b" ",) for n in range(4, min(len(x), 12) + 1) if x[:n] in among}


def ratios(a: dict[bytes, int], b: dict[bytes, int], n1: int, n0: int) -> dict[bytes, float]:
    """Likelihood ratios of the document frequencies that are higher in toxic texts and that chance doesn't explain."""

    def part(k: int, n: int, p: float) -> float:
        return (k * math.log(k / n / p) if k else 0) + ((n - k) * math.log((1 - k / n) / (1 - p)) if k < n else 0)

    least, found = 2 * math.log(max(1, len(a)) / CHANCE), {}
    for x, k in a.items():
        p = (k + b[x]) / (n1 + n0)
        if k / n1 > b[x] / n0 and (r := 2 * (part(k, n1, p) + part(b[x], n0, p))) >= least:
            found[x] = r
    return found


def typical(toxic: list[bytes | None], ordinary: list[bytes | None], least_docs: int = 3) -> list[bytes]:
    """Beginnings of windows that mark toxic texts, none beginning another."""
    sets = [set(words(t)) for t in toxic]
    a: dict[bytes, int] = {}
    for n in range(4, 13):  # longer ones only where the shorter are frequent
        a |= {x: k for x, k in Counter(x for own in sets for x in {x[:n] for w in own for x in (b" " + w + b" ",) if len(x) >= n and (n == 4 or x[: n - 1] in a)}).items() if k >= least_docs}
    b = Counter(x for t in ordinary for x in beginnings(set(words(t)), a))
    ratio = ratios(a, b, len(toxic), len(ordinary))
    chosen: list[bytes] = []
    for x in sorted(ratio, key=lambda x: (-ratio[x], -len(x), x)):
        if not any(x.startswith(c) or c.startswith(x) for c in chosen):
            chosen.append(x)
    return chosen


def typical_pairs(toxic: list[bytes | None], ordinary: list[bytes | None], starts: tuple[bytes, ...], least_docs: int = 3) -> set[bytes]:
    """Pairs of words that mark toxic texts, neither word marked alone."""
    docs = Counter(w for t in toxic for w in set(words(t)))
    usual = {w for w, k in docs.items() if k >= least_docs and not (starts and (b" " + w + b" ").startswith(starts))}

    def pairs(t: bytes | None) -> set[bytes]:
        own = words(t)
        return {x + b" " + y for x, y in zip(own, own[1:]) if x in usual and y in usual}

    a = {x: k for x, k in Counter(x for t in toxic for x in pairs(t)).items() if k >= least_docs}
    b = Counter(x for t in ordinary for x in pairs(t) if x in a)
    return set(ratios(a, b, len(toxic), len(ordinary)))


def dictionary(samples: list[bytes], size: int) -> tuple[bytes, bool]:
    """A trained dictionary of up to ``size`` bytes; all different samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=50, d=6).as_bytes(), True
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples)) or b" " * 8, False


def different(docs: list[bytes | None]) -> list[bytes]:
    """One text of all that agree in the least hash of their runs of three words, copies mostly, so that copies don't count as evidence."""
    found: dict[int, bytes] = {}
    for lo, hi in chunks(docs):
        w = Words(docs[lo:hi])
        h = shingles(w.hashes(), 3)
        for t, a, b in zip(docs[lo:hi], w.bounds[:-1], w.bounds[1:], strict=True):
            if t and b > a:
                found.setdefault(int(h[a : b - 2].min()) if b - a > 2 else zlib.crc32(t), t)
    return list(found.values())


def marked_windows(toxic: list[bytes | None], ordinary: list[bytes | None]) -> list[bytes]:
    """What the toxic dictionary is trained on: words and pairs of words typical of toxic texts, as often as they occur."""
    toxic, ordinary = different(toxic), different(ordinary)
    starts = tuple(typical(toxic, ordinary))
    pairs = typical_pairs(toxic, ordinary, starts)
    out = []
    for own in map(words, toxic):
        if starts:
            out += [x for w in own if (x := b" " + w + b" ").startswith(starts)]
        if pairs:
            out += [b" " + x + b" " for x in map(b" ".join, zip(own, own[1:])) if x in pairs]
    return out


def train(rows: list[tuple[bytes | None, int, float]], size: int = SIZE) -> Model:
    """From texts, labels and weights. ``size`` is the most that either trained dictionary may take."""
    toxic, ordinary = ([t for t, y, _ in rows if y == k] for k in (1, 0))
    if not toxic or not ordinary:
        return Model(prior=len(toxic) / len(rows) if rows else 0.0)
    lines = [b" " + b" ".join(own) + b" " for own in map(words, ordinary) if own]
    d0, t0 = dictionary(lines, size)
    d1, t1 = dictionary(marked_windows(toxic, ordinary), size)
    weights = np.array([u for _, _, u in rows])
    y = np.array([y for _, y, _ in rows], dtype=float)
    model = Model(float((weights * y).sum() / weights.sum()), d1, d0, (t1, t0))
    gains = Gains(model)
    model.weights = logistic.fit(np.array([features(t, gains) for t, _, _ in rows]), y, weights=weights)
    return model


def sample(docs: DataFrame, y: DataFrame, max_bytes: int, max_rows: int) -> list[tuple[bytes | None, int]]:
    """The texts of the labels ``y(doc_id, y, u)`` in order; texts that would pass ``max_bytes`` are left out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(y), "doc_id")
    out: list[tuple[bytes | None, int]] = []
    held = 0
    for r in rows.orderBy("u", "doc_id", "y", F.xxhash64("text")).select("text", "y").toLocalIterator():
        text = r["text"].encode() if r["text"] is not None else None
        if len(out) >= max_rows:
            break
        if held + len(text or b"") <= max_bytes:
            held += len(text or b"")
            out.append((text, r["y"]))
    return out


def label_rows(labels: DataFrame, column: str, folds: int, fold: int) -> DataFrame:
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", folds, fold))
    return y.withColumn("u", F.xxhash64(F.lit(5), "doc_id"))


def first(y: DataFrame, n: int) -> DataFrame:
    return y.orderBy("u", "doc_id", "y").limit(n)


def drawn(docs: DataFrame, labels: DataFrame, column: str, max_rows: int, max_bytes: int, folds: int = FOLDS, fold: int = FOLD) -> list[tuple[bytes | None, int]]:
    """A bounded sample of labelled training rows for the driver, the same at each run.

    The sample is drawn among the labels, which are small; ``max_rows`` of them are broadcast to the scan of the
    texts, so only sampled texts move.
    """
    return sample(docs, first(label_rows(labels, column, folds, fold), max_rows), max_bytes, max_rows)


def labelled(docs: DataFrame, labels: DataFrame, column: str, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, folds: int = FOLDS, fold: int = FOLD) -> list[tuple[bytes | None, int, float]]:
    """As ``drawn``, half of the rows for either label where it has so many; each with the weight that gives its label its share again."""
    y = label_rows(labels, column, folds, fold)
    there = {0: 0, 1: 0} | {r["y"]: r["count"] for r in y.groupBy("y").count().collect()}
    ones = min(there[1], max(max_rows // 2, max_rows - there[0]))
    rows = sample(docs, first(y.where("y = 1"), ones).unionByName(first(y.where("y = 0"), max_rows - ones)), max_bytes, max_rows)
    got = Counter(k for _, k in rows)
    return [(t, k, there[k] / sum(there.values()) / (got[k] / len(rows))) for t, k in rows]


def _score_rows(shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        gains = Gains(model) if len(model.weights) else None
        for batch in batches:
            docs = texts(batch.column(at))
            if gains is None:
                score = np.full(len(docs), model.prior)
            else:
                score = logistic.predict(model.weights, np.array([features(t, gains) for t in docs]).reshape(len(docs), -1)) if docs else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "__score"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__score``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.withColumn("__score", F.lit(0.0)).schema
    return docs.mapInArrow(_score_rows(shared, docs.columns.index(text_col)), schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(labelled(docs, labels, "toxic"))
    got = score(docs.select("doc_id", F.col("text").cast("string").alias("text")), model)
    return got.select("doc_id", held_out("doc_id", FOLDS, FOLD).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))
