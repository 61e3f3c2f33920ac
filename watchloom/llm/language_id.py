"""Language identification by interpolated Kneser-Ney models of characters, one for each language.

A text becomes runs of lower-cased letters and marks with one blank between them; everything else is blank. A model
predicts each character from the three before it. The counts of 4-grams give all lower orders: a lower order counts in how many
different contexts a gram is seen. Each order has its own absolute discount and interpolates the order below it, the lowest
one the uniform distribution over the characters of all languages.

Four characters of 16 bits are a 64-bit code; letters beyond the basic plane are folded into the 6,400 private-use values, which are no letters. Codes go through
a bijective mix, so that they are hashes without collisions, and lie in sorted arrays with one row of
log probabilities for all languages (at most ``MOST_LANGS``); a table over the hashes' first bits finds them.

A text's cross-entropy in a language is the mean over its characters, and the least one names the language. Calibration
rows, which the counts never see, give the score: a logistic curve over the text's lead in nats, the probability that the name is
right. They also give what is rejected: a text whose cross-entropy lies above what its language has,
in deviations for its length, by more than all but ``REJECT`` of that language's calibration rows do (``accepted`` is then false).

Labels are learned from rows whose id isn't in the held-out fold: about ``max_chars`` characters in all, an equal share for
each language or all that it has, rows drawn by a hash of id and text, equal texts of a language counted once. So the number of grams, and
with it what is collected and broadcast, is bounded by ``max_chars`` whatever the input; a language adds a column. Every text is scored
whole, a long one in pieces.

Texts that are null or have no letter get ``und``, a score of 0 and no acceptance, as does every text where nothing can be learned.
Ties go to the language that sorts first. Rows without an id are training rows; null languages are not learned, texts without letters neither. Repeated rows come back as often;
empty tables give no rows. Other columns pass through; ``docs`` must have none named ``__lang``, ``__score`` or ``__accepted``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import logistic
from .common import cut, fmix, held_out, texts

FOLDS, FOLD = 4, 2
ORDER = 4
MAX_CHARS = 32_000_000
MOST_LANGS = 4096  # more than that are no languages, and are refused
CALIBRATION = 5  # one training row in so many calibrates
REJECT = 0.01
UNKNOWN = "und"
BLANK = 32
PIECE = 1 << 20  # characters looked at at once
U64 = np.uint64
BINS = 64
_table: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point what it is read as, in 16 bits: a lower-cased letter, a mark, or the blank."""
    if not _table:
        out = np.full(0x110000, BLANK, dtype=np.uint64)
        for c in range(0x110000):
            if (kind := unicodedata.category(chr(c))[0]) in "LM":
                low = chr(c).lower()
                x = ord(low) if len(low) == 1 else c
                out[c] = x if x < 0x10000 else 0xE000 + x % 0x1900
        _table.append(out)
    return _table[0]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def codes(text: bytes) -> Iterator[np.ndarray]:
    """The 4-gram code that ends at each character after the padding, in order, a piece at a time."""
    tail = np.full(ORDER - 1, BLANK, dtype=np.uint64)
    whole = text.decode("utf-8", "replace") + " "
    for lo in range(0, len(whole), PIECE):
        x = letters()[np.frombuffer(whole[lo : lo + PIECE].encode("utf-32-le", "replace"), dtype=np.uint32)]
        x = x[(x != BLANK) | (np.concatenate((tail[-1:], x[:-1])) != BLANK)]  # blanks that follow blanks go
        x = np.concatenate((tail, x))
        tail = x[len(x) - ORDER + 1 :]
        out = np.zeros(len(x) - ORDER + 1, dtype=np.uint64)
        for i in range(ORDER):
            out = (out << U64(16)) | x[i : i + len(out)]
        yield out


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of ``(lang, gram)``, summed over some characters at a time."""
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def sums() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            gram, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
            for part in codes(text or b""):
                held.setdefault(lang, []).append(part)
                size += len(part)
                if size > 4 * PIECE:
                    yield from sums()
                    held, size = {}, 0
    yield from sums()


class Hashes:
    """Sorted hashes of codes, found through a table over their first bits."""

    def __init__(self, code: np.ndarray):
        h = fmix(code)
        self.order = np.argsort(h)
        self.own = h[self.order]
        self.bits = max(1, len(h).bit_length())
        first = (self.own >> U64(64 - self.bits)).astype(np.int64)
        self.start = np.searchsorted(first, np.arange((1 << self.bits) + 1)).astype(np.int32)
        self.most = int(np.diff(self.start).max()) if len(h) else 0

    def find(self, code: np.ndarray) -> np.ndarray:
        """Where each code is, -1 where it isn't."""
        h = fmix(code)
        first = (h >> U64(64 - self.bits)).astype(np.int64)
        at, end = self.start[first], self.start[first + 1]
        out = np.full(len(h), -1, dtype=np.int64)
        left = np.flatnonzero(at < end)
        for _ in range(self.most):
            if not len(left):
                break
            hit = self.own[at[left]] == h[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out


@dataclass
class Level:
    """All grams of one length: their log probabilities, and as contexts the log weight of the order below."""

    hashes: Hashes
    prob: np.ndarray
    weight: np.ndarray


@dataclass
class Model:
    langs: list[str]
    levels: list[Level] = field(default_factory=list)  # of 1 to ORDER characters
    floor: float = 0.0
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    deviation: np.ndarray = field(default_factory=lambda: np.ones(0))
    limit: np.ndarray = field(default_factory=lambda: np.full(0, np.inf))
    curve: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))

    def logs(self, code: np.ndarray, k: int = ORDER) -> np.ndarray:
        """Log probabilities of the last of ``k`` characters after the others, a column a language."""
        if not k:
            return np.full((len(code), len(self.langs)), self.floor, dtype=np.float32)
        level = self.levels[k - 1]
        at = level.hashes.find(code)
        out = level.prob[at]
        if len(gone := np.flatnonzero(at < 0)):
            rest, below = code[gone], np.zeros(1, dtype=np.float32)
            if k > 1:
                ctx = self.levels[k - 2].hashes.find(rest >> U64(16))
                below = np.where(ctx[:, None] < 0, np.float32(0), self.levels[k - 2].weight[ctx])
            else:
                below = self.bare
            out[gone] = below + self.logs(rest & U64((1 << 16 * (k - 1)) - 1), k - 1)
        return out

    bare: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.float32))

    def entropy(self, text: bytes) -> tuple[np.ndarray, int]:
        """Cross-entropy in nats a character in each language, and the number of characters."""
        total, n = np.zeros(len(self.langs)), 0
        for part in codes(text):
            total -= self.logs(part).sum(axis=0, dtype=np.float64)
            n += len(part)
        return total / max(1, n), n

    def pick(self, text: bytes) -> tuple[int, float, float, int]:
        """Best language, its cross-entropy, its lead over the next in nats a character, characters."""
        h, n = self.entropy(text)
        best = int(h.argmin())
        lead = float(np.partition(h, 1)[1] - h[best]) if len(h) > 1 else 1.0
        return best, float(h[best]), lead, n


def discount(counts: np.ndarray) -> float:
    one, two = int((counts == 1).sum()), int((counts == 2).sum())
    return min(0.95, max(0.1, one / (one + 2 * two))) if one else 0.1


def kneser_ney(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The models of ``{language: (sorted 4-gram codes, counts)}``."""
    langs = sorted(counts)
    model = Model(langs)
    own: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ORDER)]  # grams and their counts, by length
    for lang in langs:
        gram, n = counts[lang]
        for k in range(ORDER, 0, -1):
            own[k - 1].append((gram, n))
            gram, n = np.unique(gram & U64((1 << 16 * (k - 1)) - 1), return_counts=True)
    model.floor = -float(np.log(1 + len(np.unique(np.concatenate([g for g, _ in own[0]])))))
    every: list[np.ndarray] = []
    for k in range(1, ORDER + 1):
        grams = [g for g, _ in own[k - 1]] + ([g >> U64(16) for g, _ in own[k]] if k < ORDER else [])
        every.append(np.unique(np.concatenate(grams)))
    below = np.full((1, len(langs)), np.exp(model.floor))
    weights = np.ones((1, len(langs)))
    for k in range(1, ORDER + 1):
        code = every[k - 1]
        context = code >> U64(16) if k > 1 else np.zeros(len(code), dtype=np.uint64)
        suffix = code & U64((1 << 16 * (k - 1)) - 1)
        parents = every[k - 2] if k > 1 else np.zeros(1, dtype=np.uint64)
        prob = np.zeros((len(code), len(langs)))
        weights = np.ones((len(parents), len(langs)))
        up = np.minimum(np.searchsorted(parents, suffix), len(parents) - 1)
        # a suffix that no language has as a gram has the probability of its own suffix: every one of these is a gram here
        for j, (gram, n) in enumerate(own[k - 1]):
            d = discount(n)
            at = np.searchsorted(parents, gram >> U64(16) if k > 1 else np.zeros(len(gram), dtype=np.uint64))
            total = np.bincount(at, weights=n, minlength=len(parents))
            kinds = np.bincount(at, minlength=len(parents))
            seen = total > 0
            weights[seen, j] = d * kinds[seen] / total[seen]
            c = np.zeros(len(code))
            c[np.searchsorted(code, gram)] = n - d
            ctx = np.searchsorted(parents, context)
            prob[:, j] = np.where(seen[ctx], c / np.maximum(total[ctx], 1), 0) + weights[ctx, j] * below[up, j]
        if k > 1:
            last = model.levels[-1]
            last.weight = np.log(weights).astype(np.float32)[last.hashes.order]
        else:
            model.bare = np.log(weights[0]).astype(np.float32)
        hashes = Hashes(code)
        model.levels.append(Level(hashes, np.log(prob).astype(np.float32)[hashes.order], np.zeros((0, len(langs)), dtype=np.float32)))
        below = prob
    model.mean, model.deviation, model.limit = np.zeros(len(langs)), np.ones(len(langs)), np.full(len(langs), np.inf)
    return model


def drawn(docs: DataFrame, max_chars: int, folds: int, fold: int) -> DataFrame:
    """``(lang, text, calibrates)``: the rows that are learned from."""
    u = F.xxhash64(F.lit(13), "doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null").where(~held_out("doc_id", folds, fold))
    sizes = rows.groupBy("lang").agg(F.sum(F.length("text").cast("long")).alias("chars"))
    n_langs = sizes.count()
    if n_langs > MOST_LANGS:
        raise ValueError(f"{n_langs} languages are labelled, a model takes {MOST_LANGS}")
    share = max_chars / max(1, n_langs)
    sizes = sizes.select("lang", (F.lit(share) / F.greatest("chars", F.lit(1))).alias("part"))
    some = rows.join(F.broadcast(sizes), "lang").where(F.pmod(u, F.lit(1 << 30)) < F.col("part") * (1 << 30))
    some = some.select("lang", "text", F.xxhash64(F.lit(14), "text").alias("h"), F.sha2("text", 256).alias("same")).dropDuplicates(["lang", "same"])
    return some.select("lang", "text", (F.pmod("h", F.lit(CALIBRATION)) == 0).alias("calibrates"))


def _picked(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [shared.value.pick(t) for t in texts(batch.column(1))]
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.float64(), pa.float64(), pa.int64()), strict=True))], names=["lang", "best", "h", "lead", "n"])

    return run


def train(docs: DataFrame, max_chars: int = MAX_CHARS, folds: int = FOLDS, fold: int = FOLD, reject: float = REJECT) -> Model:
    rows = cut(drawn(docs, max_chars, folds, fold).where(F.col("text").rlike(r"\p{L}")))
    counts: dict[str, list[tuple[int, int]]] = {}
    whole = rows.groupBy("lang").agg(F.max(~F.col("calibrates")).alias("learns"))  # where all rows would calibrate, all are learned from
    learn = rows.join(F.broadcast(whole), "lang").where("not calibrates or not learns")
    found = learn.select("lang", "text").mapInArrow(_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    lang, gram, n = found.column(0).to_pylist(), found.column(1).to_numpy().view(np.uint64), found.column(2).to_numpy()
    if not len(gram):
        return Model([])
    order = np.lexsort((gram, np.unique(np.array(lang, dtype=object).astype(str), return_inverse=True)[1]))
    lang, gram, n = np.array(lang, dtype=object)[order], gram[order], n[order]
    edges = [0, *(np.flatnonzero(lang[1:] != lang[:-1]) + 1), len(lang)]
    model = kneser_ney({str(lang[a]): (gram[a:b], n[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)})
    return calibrate(model, rows.where("calibrates"), reject)


def calibrate(model: Model, rows: DataFrame, reject: float) -> Model:
    """Score curve and limits of rejection from ``rows(lang, text)`` that the counts haven't seen; grouped in Spark."""
    spark = rows.sparkSession
    names = F.array(*[F.lit(x) for x in model.langs])
    got = cut(rows.select("lang", "text").mapInArrow(_picked(spark.sparkContext.broadcast(model)), "lang string, best int, h double, lead double, n long"))
    got = got.withColumn("right", F.get(names, "best") == F.col("lang"))
    x = F.least(F.lit(BINS - 1), F.floor(F.log1p(F.col("lead") * F.col("n")) * 8))
    bins = got.groupBy(x.alias("x"), F.col("right").cast("int").alias("y")).count().collect()  # at most 2 * BINS rows
    # without a lead either name is as good: one row each way, so that the curve has a slope where nothing errs
    seen = [(0.0, 0.0, 1.0), (0.0, 1.0, 1.0), *(((r["x"] + 0.5) / 8, float(r["y"]), float(r["count"])) for r in bins)]
    x, y, n = np.array(seen).T
    model.curve = logistic.fit(x[:, None], y, weights=n)
    if model.curve[1] <= 0:  # errors that don't follow the lead: a curve that only grows
        model.curve = np.array([0.0, 1.0])
    own = got.where("right")
    means = {r["best"]: r for r in own.groupBy("best").agg((F.sum(F.col("h") * F.col("n")) / F.sum("n")).alias("m")).collect()}
    for j, r in means.items():
        model.mean[j] = r["m"]
    z = lambda: (F.col("h") - F.get(F.array(*[F.lit(float(v)) for v in model.mean]), F.col("best"))) * F.sqrt("n")
    for r in own.groupBy("best").agg(F.stddev_pop(z()).alias("s"), F.percentile_approx(z(), F.lit(1 - reject), F.lit(10_000)).alias("q"), F.count("*").alias("k")).collect():
        if r["k"] * reject >= 1:  # fewer rows can't show so small a share
            model.deviation[r["best"]] = r["s"] or 1.0
            model.limit[r["best"]] = r["q"] / (r["s"] or 1.0)
    return model


def _named(shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            lang, score, fits = [], [], []
            for t in texts(batch.column(at)):
                if t is None or not model.langs or not has_letter(t.decode("utf-8", "replace")):
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    fits.append(False)
                    continue
                best, h, lead, n = model.pick(t)
                lang.append(model.langs[best])
                score.append(float(logistic.predict(model.curve, np.array([[np.log1p(lead * n)]]))[0]))
                fits.append(bool((h - model.mean[best]) * n**0.5 / model.deviation[best] <= model.limit[best]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(fits, pa.bool_())], names=[*batch.schema.names, "__lang", "__score", "__accepted"])

    return run


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__lang``, ``__score`` and ``__accepted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.withColumns({"__lang": F.lit(""), "__score": F.lit(0.0), "__accepted": F.lit(True)}).schema
    return docs.mapInArrow(_named(shared, docs.columns.index(text_col)), schema)


def report(docs: DataFrame) -> DataFrame:
    got = identify(docs.select("doc_id", F.col("text").cast("string").alias("text")), train(docs))
    return got.select("doc_id", held_out("doc_id", FOLDS, FOLD).alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"), F.col("__accepted").alias("accepted"))
