"""Language-model scoring with a gated recurrent network in numpy.

Tokens are words and one end a document. The model factors the output: a recurrent network (GRU)
predicts the class of the next token, and a second softmax, of the hidden state too, the slot within the class.
Classes are the end, the most frequent words (one each), the most frequent last two bytes of a word, and the
rest. Slots of a class are its most frequent words (one each, ``SLOTS - 1`` at most) and slot 0 for all its other
words, where a word has the probability ``(c + 1) / sum(c + 1)``, ``c`` its count in all training documents;
slot 0 holds one unknown token of count 0, so the probabilities of all tokens sum to 1.

* Counts cover every training document: they are summed in numpy for a task and then shuffled.
* The network is trained by truncated backpropagation (windows of ``WINDOW`` tokens, state carried
  on, reset after each end). Training documents are dealt by a hash of id and text into ``ROUNDS`` rounds
  and as many copies of the network as the number of tokens asks for (one for each ``COPY_TOKENS``), in the
  order of that hash. A round trains each copy on all its documents of the round and averages the copies by
  their tokens, so that each training document is learned from once. What a copy learns from and in which order
  doesn't depend on files, partitions or batches: scores agree on any layout but for the rounding of sums.
* Scoring runs all documents of a batch in step, longest first, only as far as each goes; the hidden state goes
  from token to token, so each text is scored whole.

The counts of frequent tokens (at most ``FREQUENT``) are broadcast; all others are looked up by
a shuffled join. A document is training unless crc32 of its id as text mod 7 is 2; a row without
an id is training. Null texts are empty: one end. Repeated rows come back as often as they came. Very long texts
are scored in windows like all others. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, chunks, cut, held_out, texts

FOLDS, FOLD = 7, 2
HIDDEN, WINDOW, STREAMS = 16, 32, 256
TOP_WORDS, TOP_ENDINGS, SLOTS = 24, 38, 16
ROUNDS, COPY_TOKENS = 8, 1 << 20
MOST_TASKS = 1 << 16  # beyond it a task trains several copies, one after the other
FAN = 64  # rows of weights that are summed by one task, or by the driver
PIECE = 1 << 17  # tokens that a copy is trained on at once
FREQUENT = 1 << 17
BLOCK = 1 << 13  # tokens whose classes are scored at once
RATE = 0.03
END, REST = 0, 1


@dataclass
class Vocabulary:
    """What the driver knows: class of each ending and top word, class sizes, frequent counts."""

    total: int  # N, ends included
    kinds: int  # V, the end included
    ends: int
    by_ending: np.ndarray  # class of 65,536 endings
    top: np.ndarray  # sorted hashes of the words with a class of their own
    top_class: np.ndarray
    mass: np.ndarray  # sum of c + 1 by class
    tokens: np.ndarray  # sum of c by class
    frequent: np.ndarray  # sorted hashes
    frequent_log: np.ndarray  # log10(c + 1)
    own: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))  # sorted hashes of the words with a slot of their own
    own_slot: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint8))
    slots: np.ndarray | None = None  # sum of c by class and slot; -1 where a class has no such slot

    @property
    def classes(self) -> int:
        return len(self.mass)


def endings(w: Words) -> np.ndarray:
    """The last two bytes of each word; a word of one byte has a blank before it."""
    last = w.data[w.end - 1].astype(np.int64)
    before = np.where(w.end - w.start > 1, w.data[w.end - 2], 32).astype(np.int64)
    return before * 256 + last


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = texts(batch.column(0))
        hashes, codes = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
        for lo, hi in chunks(docs):
            w = Words(docs[lo:hi])
            hashes.append(w.hashes())
            codes.append(endings(w))
        h, code = np.concatenate(hashes), np.concatenate(codes)
        kinds, first, n = np.unique(h, return_index=True, return_counts=True)
        for lo in range(0, len(kinds), 100_000):
            at = slice(lo, lo + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(kinds[at].view(np.int64)), pa.array(code[first[at]].astype(np.int32)), pa.array(n[at].astype(np.int64))], names=["h", "ending", "c"])


def token_counts(training: DataFrame) -> DataFrame:
    """``(h, ending, c)`` of all words of ``training(text)``."""
    return training.mapInArrow(_count_rows, "h long, ending int, c long").groupBy("h", "ending").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, ends: int, frequent: int = FREQUENT) -> Vocabulary:
    by_ending = counts.groupBy("ending").agg(F.sum("c").alias("c"), F.count("*").alias("n")).orderBy(F.desc("c"), "ending").collect()  # 65,536 rows at most
    words, kinds = sum(r["c"] for r in by_ending), sum(r["n"] for r in by_ending)
    top = counts.orderBy(F.desc("c"), "h").limit(TOP_WORDS).collect()
    classes = 2 + min(TOP_ENDINGS, len(by_ending)) + len(top)
    lut = np.full(65536, REST, dtype=np.uint8)
    mass, tokens = np.ones(classes), np.zeros(classes)  # each class has an unknown token
    for i, r in enumerate(by_ending):
        k = 2 + i if i < TOP_ENDINGS else REST
        lut[r["ending"]] = k
        mass[k] += r["c"] + r["n"]
        tokens[k] += r["c"]
    first = 2 + min(TOP_ENDINGS, len(by_ending))
    for i, r in enumerate(top):
        k = lut[r["ending"]]
        mass[k] -= r["c"] + 1
        tokens[k] -= r["c"]
        mass[first + i] = r["c"] + 1  # known words only: an unknown word is never a top word
        tokens[first + i] = r["c"]
    mass[END], tokens[END] = ends + 1, ends
    order = np.argsort(np.array([r["h"] for r in top], dtype=np.int64).view(np.uint64)) if top else np.zeros(0, dtype=np.int64)
    hashes = np.array([r["h"] for r in top], dtype=np.int64).view(np.uint64)[order] if top else np.zeros(0, dtype=np.uint64)
    # the least count so that no more than `frequent` words have it or more, on a logarithmic scale
    step = F.floor(F.log(F.col("c").cast("double")) * 16).cast("int")
    held, least = 0, None
    for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("n")).orderBy(F.desc("s")).collect():
        held += r["n"]
        if held > frequent:
            break
        least = r["s"]
    if least is None:
        fh, fc, fe = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    else:
        got = counts.where(step >= least).select("h", "c", "ending").toArrow()
        fh, fc, fe = got.column("h").to_numpy().view(np.uint64), got.column("c").to_numpy(), got.column("ending").to_numpy()
        o = np.argsort(fh)
        fh, fc, fe = fh[o], fc[o], fe[o]
    slots = np.full((classes, SLOTS), -1.0)
    slots[:, 0] = tokens
    own: list[tuple[int, int]] = []
    is_top = np.isin(fh, hashes)
    for i in np.lexsort((fh, -fc)):
        k = lut[fe[i]]
        free = np.flatnonzero(slots[k] < 0)
        if is_top[i] or not len(free):
            continue
        slots[k, free[0]] = fc[i]
        slots[k, 0] -= fc[i]
        mass[k] -= fc[i] + 1
        own.append((int(fh[i]), int(free[0])))
        if len(own) == (SLOTS - 1) * (classes - len(top) - 1):
            break
    own.sort()
    return Vocabulary(int(words + ends), int(kinds + (ends > 0)), ends, lut, hashes, (first + order).astype(np.uint8), mass, tokens, fh, np.log10(fc + 1.0), np.array([h for h, _ in own], dtype=np.uint64), np.array([k for _, k in own], dtype=np.uint8), slots)


def find(sorted_values: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of x are there, and where."""
    if not len(sorted_values):
        return np.zeros(len(x), dtype=bool), np.zeros(len(x), dtype=np.int64)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x, at


def classes_of(w: Words, h: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    out = vocab.by_ending[endings(w)]
    is_top, at = find(vocab.top, h)
    out[is_top] = vocab.top_class[at[is_top]]
    return out


def slots_of(h: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    is_own, at = find(vocab.own, h)
    out = np.zeros(len(h), dtype=np.uint8)
    out[is_own] = vocab.own_slot[at[is_own]]
    return out


# --- the network -------------------------------------------------------------------------------


ABSENT = -1e4  # the bias of a slot that a class hasn't


def start(vocab: Vocabulary, hidden: int = HIDDEN, seed: int = 5) -> dict[str, np.ndarray]:
    """Random weights; the output's biases are the log shares of the classes."""
    rng, c = np.random.default_rng(seed), vocab.classes
    share = (vocab.tokens + 1) / (vocab.tokens + 1).sum()
    p = {"x": rng.normal(0, 0.3, (c, 3 * hidden)), "u": rng.normal(0, 1 / math.sqrt(hidden), (hidden, 3 * hidden)), "n": np.zeros(hidden), "v": rng.normal(0, 0.1, (hidden, c)), "b": np.log(share)}
    p["x"][:, :hidden] += 1.0  # keep much of the state at first
    if vocab.slots is not None:
        there = vocab.slots >= 0
        p["sv"] = np.where(there[..., None], rng.normal(0, 0.02, (*there.shape, hidden)), 0)
        p["sb"] = np.where(there, np.log(np.maximum(vocab.slots, 0) + 1), ABSENT)
    return {k: v.astype(np.float32) for k, v in p.items()}


def step(p: dict[str, np.ndarray], x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One token of each stream. Gates: z keeps the state, r lets it into the candidate n."""
    k = h.shape[1]
    a, g = np.take(p["x"], x, axis=0), h @ p["u"]
    zr = a[:, : 2 * k] + g[:, : 2 * k]
    np.negative(zr, out=zr)
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    z, r = zr[:, :k], zr[:, k:]
    s = g[:, 2 * k :] + p["n"]
    n = r * s
    n += a[:, 2 * k :]
    np.tanh(n, out=n)
    after = h - n
    after *= z
    after += n
    return after, z, r, s, n


def by_class(p: dict[str, np.ndarray], y: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """Where ``y`` has classes with more than one slot, class after class, and each class's part of that."""
    several = p["sb"][:, 1] > ABSENT / 2
    rows = np.flatnonzero(several[y])
    rows = rows[np.argsort(y[rows], kind="stable")]
    bounds = np.searchsorted(y[rows], np.arange(len(several) + 1))
    return rows, [(int(k), slice(bounds[k], bounds[k + 1])) for k in np.flatnonzero(bounds[1:] > bounds[:-1])]


def slot_logs(p: dict[str, np.ndarray], own: np.ndarray, parts: list[tuple[int, slice]]) -> np.ndarray:
    """Log probabilities ``(slot, row)`` of the slots within the classes of rows of states, as ``by_class`` orders them."""
    out = np.empty((p["sb"].shape[1], len(own)), dtype=own.dtype)
    for c, at in parts:
        out[:, at] = p["sv"][c] @ own[at].T + p["sb"][c][:, None]
    out -= out.max(axis=0)
    out -= np.log(np.exp(out).sum(axis=0))
    return out


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def window_gradient(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, h: np.ndarray, slot: np.ndarray | None = None, counts: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
    """Loss and gradient of a window ``(steps, streams)``, and the state after it; an END input resets the state.

    ``slot``: the slots of y; ``counts``: which of y count, all if not given.
    """
    k, steps = h.shape[1], len(x)
    goes_on = (x != END)[..., None].astype(h.dtype)
    kept = []
    for t in range(steps):
        h0 = h * goes_on[t]
        h, z, r, s, n = step(p, x[t], h0)
        kept.append((h0, h, z, r, s, n))
    hs = np.stack([q[1] for q in kept])
    own, n, right = hs.reshape(-1, k), hs.shape[0] * hs.shape[1], y.ravel()
    prob = p["v"].T @ own.T  # (class, token): sums over classes run along rows
    prob += p["b"][:, None]
    prob -= prob.max(axis=0)
    np.exp(prob, out=prob)
    prob /= prob.sum(axis=0)
    used = np.ones(n, dtype=bool) if counts is None else counts.ravel()
    at = np.arange(n)
    loss = float(-np.log(prob[right, at] + 1e-30)[used].sum())
    d = prob
    d[right, at] -= 1
    if not used.all():
        d[:, ~used] = 0
    g = {name: np.zeros_like(w) for name, w in p.items()}
    g["v"], g["b"] = (d @ own).T, d.sum(axis=1)
    dhs = d.T @ p["v"].T
    if slot is not None:
        rows, parts = by_class(p, right)
        states, of = own[rows], slot.ravel()[rows]
        lp = slot_logs(p, states, parts)
        hit, there = (of, np.arange(len(rows))), used[rows]
        loss -= float(lp[hit][there].sum())
        ds = np.exp(lp, out=lp)
        ds[hit] -= 1
        if not there.all():
            ds[:, ~there] = 0
        more = np.empty_like(states)
        for c, part in parts:
            g["sv"][c], g["sb"][c] = ds[:, part] @ states[part], ds[:, part].sum(axis=1)
            more[part] = ds[:, part].T @ p["sv"][c]
        dhs[rows] += more
    dhs = dhs.reshape(hs.shape)
    dh = np.zeros_like(h)
    das = []
    for t in range(steps - 1, -1, -1):
        h0, _, z, r, s, n = kept[t]
        dh = dh + dhs[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h0 - n) * z * (1 - z)
        dr = dn * s * r * (1 - r)
        ds = dn * r
        du = np.concatenate([dz, dr, ds], axis=1)
        g["u"] += h0.T @ du
        g["n"] += ds.sum(axis=0)
        das.append(np.concatenate([dz, dr, dn], axis=1))
        dh = (dh * z + du @ p["u"].T) * goes_on[t]
    da = np.stack(das[::-1]).reshape(-1, 3 * k)
    one_hot = np.zeros((len(da), p["x"].shape[0]), dtype=np.float32)
    one_hot[np.arange(len(da)), x.ravel()] = 1
    g["x"] = one_hot.T @ da
    return loss, g, h


def train_on(p: dict[str, np.ndarray], tokens: np.ndarray, slots: np.ndarray | None = None, rate: float = RATE, streams: int = STREAMS, window: int = WINDOW) -> tuple[dict[str, np.ndarray], float]:
    """One pass of Adam over a run of class ids that ends with END, all of them; weights and mean loss."""
    length = -(-len(tokens) // streams)
    if length < 2:
        streams, length = 1, len(tokens)

    def dealt(x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.zeros(streams * length - len(x), dtype=x.dtype)]).reshape(streams, length).T

    y, counts = dealt(tokens), dealt(np.ones(len(tokens), dtype=bool))
    slot = None if slots is None else dealt(slots)
    x = dealt(np.concatenate([np.full(1, END, dtype=tokens.dtype), tokens[:-1]]))
    p = {k: v.copy() for k, v in p.items()}
    m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    h, loss, i = np.zeros((streams, p["u"].shape[0]), dtype=np.float32), 0.0, 0
    for lo in range(0, length, window):
        at = slice(lo, lo + window)
        part, g, h = window_gradient(p, x[at], y[at], h, None if slot is None else slot[at], counts[at])
        loss += part
        i += 1
        n = int(counts[at].sum())
        if not n:
            break
        norm = math.sqrt(sum(float((w * w).sum()) for w in g.values())) / n
        scale = np.float32(1 / n * min(1.0, 1.0 / max(norm, 1e-12)))
        now = rate * min(1.0, i / 10)
        for k in p:
            w = g[k] * scale
            m[k] = 0.9 * m[k] + 0.1 * w
            v[k] = 0.99 * v[k] + 0.01 * w * w
            p[k] -= (now * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.99**i)) + 1e-6)).astype(np.float32)
    return p, loss / max(1, len(tokens))


def sequence(docs: list[bytes | None], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Class ids and slots of all documents, an END after each; the number of tokens of each; word hashes."""
    ids, slots, n, hashes = [np.zeros(0, dtype=np.uint8)], [np.zeros(0, dtype=np.uint8)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
    for lo, hi in chunks(docs):
        w = Words(docs[lo:hi])
        h = w.hashes()
        ids.append(np.insert(classes_of(w, h, vocab), w.bounds[1:], END))
        slots.append(np.insert(slots_of(h, vocab), w.bounds[1:], 0))
        n.append(w.counts() + 1)
        hashes.append(h)
    return np.concatenate(ids), np.concatenate(slots), np.concatenate(n), np.concatenate(hashes)


def _sequence_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in batches:
            ids, slots, n, _ = sequence(texts(batch.column(3)), vocab)
            cuts = np.cumsum(n)[:-1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array([part.tobytes() for part in np.split(x, cuts)] if len(n) else [], pa.binary()) for x in (ids, slots)]], names=["copy", "round", "x", "ids", "slots"])

    return run


def _train_rows(shared, groups: int):
    """A round's documents in order of copy -> each task's weighted sum of the weights that its copies end with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = shared.value
        total, seen, first = None, 0, 0
        copy, p, held, size, own = None, begin, [], 0, 0

        def learn() -> None:
            nonlocal p, held, size, own
            if size:
                p, _ = train_on(p, np.frombuffer(b"".join(a for a, _ in held), dtype=np.uint8), np.frombuffer(b"".join(b for _, b in held), dtype=np.uint8))
                own += size
            held, size = [], 0

        def end() -> None:
            nonlocal total, seen, p, own
            learn()
            if own:
                flat = np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float64) * own
                total, seen = flat if total is None else total + flat, seen + own
            p, own = begin, 0

        for batch in batches:
            for k, ids, slots in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4)), strict=True):
                if k != copy:
                    end()
                    first = k if total is None else first
                    copy = k
                held.append((ids, slots))
                size += len(ids)
                if size >= PIECE:
                    learn()
        end()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([first % groups], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64())), pa.array([seen], pa.int64())], names=["g", "w", "n"])

    return run


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, seen = None, 0
    for batch in batches:
        for w, n in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
            w = w.values.to_numpy()
            total, seen = w if total is None else total + w, seen + n
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64())), pa.array([seen], pa.int64())], names=["g", "w", "n"])


def train(training: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS, copy_tokens: int = COPY_TOKENS) -> dict[str, np.ndarray]:
    """Averaged local training over all of ``training(doc_id, text)``, in ``rounds`` rounds."""
    spark, p = training.sparkSession, start(vocab)
    copies = max(1, vocab.total // copy_tokens)
    tasks = min(copies, MOST_TASKS)
    groups = max(1, math.isqrt(tasks))
    x = F.xxhash64(F.lit(7), "doc_id", "text")
    dealt = training.select(F.pmod(F.shiftright(x, 8), F.lit(copies)).cast("int").alias("copy"), F.pmod(x, F.lit(rounds)).cast("int").alias("round"), x.alias("x"), "text")
    dealt = dealt.mapInArrow(_sequence_rows(spark.sparkContext.broadcast(vocab)), TRAINING)
    dealt = cut(dealt.repartitionById(tasks, F.col("copy") % tasks).sortWithinPartitions("copy", "round", "x"))
    for k in range(rounds):
        shared = spark.sparkContext.broadcast(p)
        got = dealt.where(F.col("round") == k).mapInArrow(_train_rows(shared, groups), WEIGHTS)
        if groups > 1:
            got = got.repartition(groups, "g").mapInArrow(_sum_rows, WEIGHTS)
        left = groups
        while left > FAN:
            left = -(-left // FAN)
            got = got.withColumn("g", F.spark_partition_id() % left).repartition(left, "g").mapInArrow(_sum_rows, WEIGHTS)
        got = got.collect()  # at most FAN rows
        shared.unpersist()
        if got:
            flat, at = (sum(np.array(r["w"]) for r in got) / sum(r["n"] for r in got)).astype(np.float32), 0
            p = dict(p)
            for name in sorted(p):
                p[name] = flat[at : at + p[name].size].reshape(p[name].shape)
                at += p[name].size
    return p


TRAINING = "copy int, round int, x long, ids binary, slots binary"
WEIGHTS = "g int, w array<double>, n long"


# --- scoring -----------------------------------------------------------------------------------


def class_scores(p: dict[str, np.ndarray], ids: np.ndarray, n: np.ndarray, window: int = WINDOW, slots: np.ndarray | None = None) -> np.ndarray:
    """Each document's sum of log probabilities of its tokens' classes and, if given, slots. ``ids``: the documents' tokens one after another."""
    out = np.zeros(len(n))
    if not len(n):
        return out
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    order = np.argsort(-n, kind="stable")
    n, first = n[order], first[order]
    before = np.concatenate([np.full(1, END, dtype=ids.dtype), ids[:-1]])
    h = np.zeros((len(n), p["u"].shape[0]), dtype=np.float32)
    live = np.searchsorted(-n, -np.arange(int(n[0])))  # documents with more than t tokens
    states, tokens, held = [], [], 0

    def add_up() -> None:
        own, at = np.concatenate(states), np.concatenate(tokens)
        whose = order[np.concatenate([np.arange(len(x)) for x in tokens])]
        for lo in range(0, len(own), BLOCK):
            part, y = own[lo : lo + BLOCK], ids[at[lo : lo + BLOCK]]
            logits = p["v"].T @ part.T
            logits += p["b"][:, None]
            logits -= logits.max(axis=0)
            got = logits[y, np.arange(len(y))]
            np.exp(logits, out=logits)
            got -= np.log(logits.sum(axis=0))
            if slots is not None:
                rows, parts = by_class(p, y)
                got[rows] += slot_logs(p, part[rows], parts)[slots[at[lo : lo + BLOCK]][rows], np.arange(len(rows))]
            out[:] += np.bincount(whose[lo : lo + BLOCK], weights=got, minlength=len(out))

    for t in range(int(n[0])):
        at = first[: live[t]] + t
        h = step(p, before[at], h[: live[t]])[0]
        states.append(h)
        tokens.append(at)
        held += len(h)
        if len(states) >= window and held >= BLOCK or t + 1 == len(live):
            add_up()
            states, tokens, held = [], [], 0
    return out


def _score_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, p = shared.value
        inner = np.log(vocab.mass)
        for batch in batches:
            docs = texts(batch.column(1))
            for lo in range(0, len(docs), 4096):
                ids, slots, n, h = sequence(docs[lo : lo + 4096], vocab)
                of_token = np.repeat(np.arange(len(n)), n)
                of_word = np.repeat(np.arange(len(n)), n - 1)
                frequent, at = find(vocab.frequent, h)
                logs = np.bincount(of_word[frequent], weights=vocab.frequent_log[at[frequent]], minlength=len(n)) + math.log10(vocab.ends + 1)
                known = np.bincount(of_word[frequent], minlength=len(n)) + (vocab.ends > 0)
                score = (class_scores(p, ids, n, slots=slots) - np.bincount(of_token, weights=np.where(slots > 0, 0.0, inner[ids]), minlength=len(n))) / math.log(10)
                has_own = slots_of(h, vocab)[frequent] > 0  # their probability is the slot's
                score -= np.bincount(of_word[frequent][has_own], weights=vocab.frequent_log[at[frequent]][has_own], minlength=len(n))
                rare, whose = h[~frequent].view(np.int64), of_word[~frequent]
                offsets = np.searchsorted(whose, np.arange(len(n) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(n)), pa.array(n), pa.array(logs), pa.array(known.astype(np.int64)), pa.array(score), pa.ListArray.from_arrays(pa.array(offsets), pa.array(rare))], names=["doc_id", "n_tokens", "logs", "known", "score", "rare"])

    return run


def score_texts(docs: DataFrame, folds: int = FOLDS, fold: int = FOLD) -> DataFrame:
    """A row for each row of ``docs``: the model's and the unigram base's log10 probability of its text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    training = rows.where(~held_out("doc_id", folds, fold))
    counts = cut(token_counts(training.select("text")))
    vocab = vocabulary(counts, training.count())
    p = train(training, vocab)
    shared = docs.sparkSession.sparkContext.broadcast((vocab, p))
    scored = cut(rows.mapInArrow(_score_rows(shared), "doc_id long, n_tokens long, logs double, known long, score double, rare array<long>").withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode("rare").alias("h")).join(counts.select("h", "c"), "h").groupBy("row").agg(F.sum(F.log10(F.col("c") + 1.0)).alias("more"), F.count("*").alias("found"))
    got = scored.drop("rare").join(rare, "row", "left")
    logs = F.col("logs") + F.coalesce("more", F.lit(0.0))
    return got.select(
        "doc_id", held_out("doc_id", folds, fold).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(vocab.total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * math.log10(vocab.total + vocab.kinds + 1)).alias("base_score"), (F.col("score") + F.coalesce("more", F.lit(0.0)) + F.col("logs")).alias("score"),
    )
