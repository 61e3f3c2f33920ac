"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, mixing.

Each stage takes the documents that the stage before has left and returns documents with the same
columns; the last returns the mixture, a row for each copy that a document gets, with ``copy``
counting from 1. ``run`` writes each stage as Parquet in the shared folder and reads it again, so
a lost executor never costs more than its stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchloom.llm import decontaminate, line_dedup, mixing, near_dup, toxicity
from watchloom.llm.common import read, shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is 0.5 or more go."""
    model = toxicity.train(toxicity.labelled(docs, read(spark, sf_dir, "labels"), "toxic"))
    return toxicity.score(docs, model).where("__score < 0.5").drop("__score")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more share stay in the last of them only; ``n_chars`` follows where it is a column."""
    found = line_dedup.fold(docs)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("__text").alias(c))
        elif c == "n_chars":
            columns.append(F.when(F.col("__n_dropped") > 0, F.length("__text").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return found.select(*columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by five-word shingles at a similarity of 0.8 or more stays: that of the least id.

    Rows are told apart by id and text: of rows that repeat both one stays, and an id that repeats with other
    texts loses only what copies something. Rows without words all stay.
    """
    return near_dup.keep_one(docs, near_dup.SketchSpec(words=5, percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold any window of a benchmark item go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixture(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

#: Compression lengths and trained dictionaries can't be had in SQL; the tests run a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    at = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = f"{at}/{k}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
