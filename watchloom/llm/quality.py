"""Quality classification by hierarchical empirical Bayes.

1. A document classifier: logistic regression over the shape of the text (shares of kinds of
   characters, lengths of words and lines, repetition), fitted on a bounded sample of labelled
   rows outside fold 0 of 5. It gives each document a probability.
2. Grouped aggregation over all documents: the sums of these probabilities, and the number of
   documents, by path (a host's section) and by host. A host's posterior mean is its own mean
   shrunk towards the global mean, ``(sum + k * prior) / (n + k)``, a path's is shrunk towards its host's.
   ``k`` is estimated from the spread between groups (method of moments): where groups differ
   no more than chance, ``k`` is large and sparse sites fall back on the level above.
3. A document's score combines its own evidence with its path's posterior as prior:
   ``logit(own) + logit(path) - logit(global)``.

Host and path are columns of the caller: for ``documents`` they are ``source`` and
``source/lang``, for tables with URLs ``parse_url`` gives them. Aggregates by (host, path) are
computed first, so that a host with a third of all rows is summed before it is shuffled.

Null hosts and paths are groups of their own. Null and empty texts have the features of no text.
Without labels of both kinds every document's own probability is the share of good labels, 0.5
where there is none. Very long texts are read whole; one that would pass ``MAX_BYTES`` is left out of the labelled
sample only. Repeated rows come back as often as they came; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import logistic
from .common import cut, held_out, texts
from .toxicity import FOLD, FOLDS, drawn

MAX_STRENGTH = 1e6
MAX_ROWS, MAX_BYTES = 5000, 64 << 20


def features(text: bytes | None) -> list[float]:
    t = text or b""
    own = t.split()
    n, w = max(1, len(t)), max(1, len(own))
    counts = np.bincount(np.frombuffer(t, dtype=np.uint8), minlength=256)
    letters, digits, high = counts[65:91].sum() + counts[97:123].sum(), counts[48:58].sum(), counts[128:].sum()
    space = counts[9:14].sum() + counts[32]
    marks = n - letters - digits - high - space if t else 0
    plain = counts[[33, 39, 44, 45, 46, 58, 59, 63]].sum()
    rows = t.split(b"\n")
    lengths = np.fromiter(map(len, own), dtype=np.int64, count=len(own)) if own else np.zeros(1, dtype=np.int64)
    kinds = len(set(own))
    return [
        math.log1p(len(own)), letters / n, digits / n, counts[65:91].sum() / n, space / n, (marks - plain) / n, plain / n, min(1.0, 20 * (marks - plain) / n),
        float(lengths.mean()) / 10, float(lengths.std()) / 10, kinds / w, kinds / math.sqrt(w) / 10, len(set(rows)) / len(rows), math.log1p(n / len(rows)), min(1.0, counts[46] / w * 5), float(not t),
        float((lengths <= 1).mean()), (counts[123] + counts[125] + counts[60] + counts[62] + counts[59]) / n, counts[47] / n, counts[64] / n,
    ]


@dataclass
class Model:
    prior: float
    weights: np.ndarray | None = None
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None

    def probability(self, docs: list[bytes | None]) -> np.ndarray:
        if self.weights is None or not docs:
            return np.full(len(docs), self.prior)
        x = (np.array([features(t) for t in docs]) - self.mean) / self.spread
        return logistic.predict(self.weights, np.clip(x, -8, 8))


def train(rows: list[tuple[bytes | None, int]]) -> Model:
    y = np.array([v for _, v in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return Model(prior=float(y.mean()) if len(y) else 0.5)
    x = np.array([features(t) for t, _ in rows])
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    return Model(float(y.mean()), logistic.fit(np.clip((x - mean) / spread, -8, 8), y), mean, spread)


def _own_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.clip(shared.value.probability(texts(batch.column(3))), 1e-6, 1 - 1e-6)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(p)], names=["doc_id", "host", "path", "own"])

    return run


def strength(groups: DataFrame, n: Column, total: Column, mean: Column) -> Column:
    """How many documents the level above weighs, one aggregate over ``groups``.

    Group means spread by ``v / n`` from chance (``v`` the variance of one document) and by ``tau``
    for real: k = v / tau.
    """
    v = F.greatest(mean * (1 - mean), F.lit(1e-6))
    between = F.sum(n * F.pow(total / n - mean, 2)) - F.sum(v) + F.avg(v)
    size = F.sum(n) - F.sum(n * n) / F.sum(n)
    tau = between / F.when(size > 0, size)
    return F.coalesce(F.least(F.avg(v) / F.when(tau > 0, tau), F.lit(MAX_STRENGTH)), F.lit(MAX_STRENGTH))


def posteriors(paths: DataFrame) -> DataFrame:
    """``(host, path, n, s)`` -> with ``prior`` (global), ``host_mean`` and ``path_mean``."""
    paths = cut(paths)
    whole = paths.agg((F.sum("s") / F.sum("n")).alias("prior")).first()["prior"]
    if whole is None:
        return paths.withColumns({c: F.lit(0.5) for c in ("prior", "host_mean", "path_mean")})
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    k1 = hosts.agg(strength(hosts, F.col("hn"), F.col("hs"), F.lit(whole))).first()[0]
    hosts = hosts.select(F.col("host").alias("h"), ((F.col("hs") + k1 * whole) / (F.col("hn") + k1)).alias("host_mean"))
    paths = paths.join(hosts, paths["host"].eqNullSafe(hosts["h"])).drop("h")
    k2 = paths.agg(strength(paths, F.col("n"), F.col("s"), F.col("host_mean"))).first()[0]
    return paths.withColumn("prior", F.lit(whole)).withColumn("path_mean", (F.col("s") + k2 * F.col("host_mean")) / (F.col("n") + k2))


def quality(docs: DataFrame, model: Model, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, own, host_mean, path_mean, score)`` for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))
    own = cut(rows.mapInArrow(_own_rows(shared), "doc_id long, host string, path string, own double"))
    site = posteriors(own.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(F.col("own").cast("decimal(20,12)")).cast("double").alias("s")))
    site = site.select(F.col("host").alias("h"), F.col("path").alias("p"), "prior", "host_mean", "path_mean")

    def logit(c: Column) -> Column:
        x = F.greatest(F.least(c, F.lit(1 - 1e-9)), F.lit(1e-9))
        return F.log(x / (1 - x))

    got = own.join(site, own["host"].eqNullSafe(site["h"]) & own["path"].eqNullSafe(site["p"]))
    score = 1 / (1 + F.exp(-(logit(F.col("own")) + logit(F.col("path_mean")) - logit(F.col("prior")))))
    return got.select("doc_id", "own", "host_mean", "path_mean", score.alias("score"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(drawn(docs, labels, "quality", MAX_ROWS, MAX_BYTES))
    got = quality(docs, model, F.col("source"), F.concat_ws("/", "source", "lang"))
    return got.select("doc_id", held_out("doc_id", FOLDS, FOLD).alias("held_out"), "own", "host_mean", "path_mean", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), (F.col("score") >= 0.5).alias("kept"))
