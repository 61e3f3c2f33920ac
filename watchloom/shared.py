"""The shared folder, cuts of lineage, and row numbers without a single task."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share.

    Only a session on one machine may go without that setting; it gets a folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        if given is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            given = tempfile.mkdtemp(prefix="watchloom-")
        sc.setCheckpointDir(given)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, keep it in the shared folder and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def numbered(df: DataFrame, *order: Column, name: str = "n") -> DataFrame:
    """``df`` with row numbers from 1 in ``order``, which should be total.

    A range-partitioned sort, positions within partitions, and the partitions' counts as offsets; no task takes all rows.
    """
    within = (1 << 33) - 1  # monotonically_increasing_id() holds the partition above bit 33
    at = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    parts = at.groupBy(F.shiftright("__at", 33).alias("p")).agg(F.count("*").alias("k")).orderBy("p").collect()  # a row a partition
    before, offsets = 0, []
    for r in parts:
        offsets += [F.lit(r["p"]), F.lit(before)]
        before += r["k"]
    start = F.create_map(*offsets)[F.shiftright("__at", 33)] if offsets else F.lit(0)
    return at.withColumn(name, (F.col("__at").bitwiseAND(F.lit(within)) + start + 1).cast("long")).drop("__at")
