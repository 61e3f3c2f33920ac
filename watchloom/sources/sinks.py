"""Writers: canonical files, replacement by key, swaps of whole tables, upserts.

Spark's committer makes a write to a new folder atomic; a swap keeps the old table until the new one is in place.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import canonical


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def write_canonical(df: DataFrame, path: str, kind: str = "csv") -> None:
    out = canonical(df).write.mode("overwrite")
    out.option("header", True).option("escape", '"').option("emptyValue", "").csv(path) if kind == "csv" else out.parquet(path)


def replace_partitions(df: DataFrame, path: str, *keys: str) -> None:
    """Rewrite only the partitions whose keys occur in ``df``; a rerun gives the same table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def changed_keys(new: DataFrame, old: DataFrame, *keys: str) -> DataFrame:
    """Keys whose number of rows differs, or is 0, between a file and the table."""
    a, b = new.groupBy(*keys).agg(F.count("*").alias("n")), old.groupBy(*keys).agg(F.count("*").alias("m"))
    return a.join(b, list(keys), "left").where("m is null or n <> m").select(*keys)


def replace_changed(new: DataFrame, path: str, *keys: str) -> None:
    """Replace the pairs whose counts changed, leave the others as they are."""
    spark = new.sparkSession
    if exists(spark, path):
        new = new.join(changed_keys(new, spark.read.parquet(path), *keys), list(keys), "left_semi")
    replace_partitions(new, path, *keys)


def settle(spark: SparkSession, path: str) -> None:
    """Finish a swap that stopped half-way: where the table is gone its predecessor comes back, else that goes."""
    fs, at = _fs(spark, path)
    old = _fs(spark, f"{path}.old")[1]
    if fs.exists(old) and not fs.exists(at):
        _move(fs, old, at)
    elif fs.exists(old):
        fs.delete(old, True)


def _move(fs, a, b) -> None:
    if not fs.rename(a, b):
        raise OSError(f"could not move {a} to {b}")


def swap(df: DataFrame, path: str) -> None:
    """Replace a table as a whole. The old one stays beside it until the new one is in place; ``settle`` mends a crash in between."""
    spark = df.sparkSession
    settle(spark, path)
    fs, at = _fs(spark, path)
    fresh, old = _fs(spark, f"{path}.new")[1], _fs(spark, f"{path}.old")[1]
    df.write.mode("overwrite").parquet(f"{path}.new")
    if fs.exists(at):
        _move(fs, at, old)
    _move(fs, fresh, at)
    fs.delete(old, True)


def clustered_swap(df: DataFrame, path: str, *keys: str) -> None:
    """A load with its order remade: rows are sorted by range of the keys, so that files and row groups can be skipped."""
    swap(df.repartitionByRange(*keys).sortWithinPartitions(*keys), path)


def replace_source(df: DataFrame, path: str, source_id: str, least: int = 1) -> bool:
    """A one-off load: one source's records replace those that are there, unless they are fewer than ``least``."""
    own = df.where(F.col("source_id") == source_id)
    if len(own.take(least)) < least:
        return False
    replace_partitions(own, path, "source_id")
    return True


def guarded_overwrite(df: DataFrame, path: str, least: float = 0.5) -> bool:
    """Overwrite unless the new table has less than a share of the rows that are there."""
    spark = df.sparkSession
    settle(spark, path)
    if exists(spark, path) and df.count() < least * spark.read.parquet(path).count():
        return False
    swap(df, path)
    return True


def write_json(spark: SparkSession, path: str, value: object) -> None:
    """A small JSON document, written beside its place and moved there in one step."""
    jvm = spark.sparkContext._jvm
    fs, fresh = _fs(spark, f"{path}.tmp")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(json.dumps(value, indent=2, default=str).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri() if fresh.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite = getattr(jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    options[0] = overwrite
    context.rename(fresh, _fs(spark, path)[1], options)


def upserted(old: DataFrame, new: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """``old`` with ``new`` merged in by key; columns in ``keep`` stay where the new value is null."""
    n = new.select(*[F.col(c).alias(f"n_{c}") if c not in keys else F.col(c) for c in new.columns], F.lit(True).alias("n_there"))
    j = old.join(n, keys, "full_outer")
    return j.select(*keys, *[(F.coalesce(f"n_{c}", c) if c in keep else F.when(F.col("n_there"), F.col(f"n_{c}")).otherwise(F.col(c))).alias(c) for c in old.columns if c not in keys])


def write_snapshot(df: DataFrame, root: str, stamp: str) -> str:
    """A run's raw snapshot; the latest and the one before are the greatest stamps."""
    df.write.mode("overwrite").parquet(f"{root}/run={stamp}")
    return f"{root}/run={stamp}"


def snapshot_stamps(spark: SparkSession, root: str) -> list[str]:
    fs, at = _fs(spark, root)
    return sorted((s.getPath().getName()[4:] for s in fs.listStatus(at) if s.getPath().getName().startswith("run=")), reverse=True)


def restore(spark: SparkSession, backup: str, path: str, key: str, value: str) -> bool:
    """Bring back one key's partition from a backup if that has rows."""
    old = spark.read.parquet(backup).where(F.col(key) == value)
    if old.isEmpty():
        return False
    replace_partitions(old, path, key)
    return True


def hits_export(df: DataFrame, path: str) -> None:
    df.withColumn("details", F.substring("details", 1, 500)).write.mode("overwrite").options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def cluster_export(df: DataFrame, path: str) -> None:
    """Clusters in order of score; a report, so one file."""
    flat = df.withColumn("agencies", F.array_join("agencies", "; "))
    flat.orderBy(F.desc("risk_score"), F.desc(F.size(F.split("agencies", "; "))), F.desc("record_count"), "cluster_id").coalesce(1).write.mode("overwrite").option("header", True).csv(path)
