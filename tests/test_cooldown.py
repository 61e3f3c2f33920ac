"""Times within the second of a limit."""

from datetime import datetime

import duckdb
from pyspark.sql import functions as F

from watchloom.functions import values as V
from watchloom.plans import registry

NAME = "D10_cooldown_text"


def test_stamps_keep_fractions(spark):
    cases = {"2024-01-14T00:00:00.000001Z": 1, "2024-01-14 00:00:00.5": 500_000, " 2024-01-14T00:00:00.123456789+05:30": 123_456, "2024-01-14 00:00:00": 0, "2024-01-14": 0, "2024-01-14 00:00:00.": None}
    df = spark.createDataFrame(list(cases.items()), "c string, want int").withColumn("got", V.stamp(F.col("c")))
    assert {r.c: r.got for r in df.collect()} == {c: us if us is None else datetime(2024, 1, 14, 0, 0, 0, us) for c, us in cases.items()}


def test_events_within_the_cutoffs_second(spark, tmp_path):
    times = [None, *[f"2024-01-{t}" for t in ("13 23:59:59.999999", "14 00:00:00", "14 00:00:00.000001", "14 00:00:00.4", "14 00:00:00.999999", "14 00:00:01")]]
    rows = spark.createDataFrame(list(enumerate(times)), "event_id long, t string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    rows.withColumns({"event_type": F.lit("x"), "user_id": F.lit(1), "value": F.lit(0.0), "props": F.lit("{}")}).drop("t").write.parquet(f"{tmp_path}/events.parquet")
    events = duckdb.read_parquet(f"{tmp_path}/events.parquet/*.parquet")  # noqa: F841  read by the SQL
    want = dict(duckdb.sql(registry.oracle_sql()[NAME]).fetchall())
    assert {r.id: r.hot for r in registry.queries()[NAME](spark, str(tmp_path)).collect()} == want == {0: None, 1: False, 2: False, 3: True, 4: True, 5: True, 6: True}
