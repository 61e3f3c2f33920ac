"""Numbers at and beyond each unit's limit."""

import duckdb
from pyspark.sql import functions as F

from watchloom.functions import text as X
from watchloom.plans import registry

NAME = "X29_human_number"


def test_the_query_has_no_unit_beyond_thousands(spark, tmp_path):
    keys = [0, 676, 999, 1000, 1049, 1050, 9949, 9950, 9999, 10_000, 10_499, 10_500, 113_888, 999_499, 999_500, 999_999, 1_000_000, 1_000_499, 1_000_500, 4_843_710, 8_999_999, 123_456_500, 5_000_000_000]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    orders = duckdb.read_parquet(f"{tmp_path}/orders.parquet/*.parquet")  # noqa: F841  read by the SQL
    want = dict(duckdb.sql(registry.oracle_sql()[NAME]).fetchall())
    got = {r.id: r.n for r in registry.queries()[NAME](spark, str(tmp_path)).collect()}
    assert got == want and got[1_000_000] == "1000K" and got[4_843_710] == "4844K"


def test_millions(spark):
    df = spark.createDataFrame([(None,), (676,), (113_888,), (999_999,), (1_000_000,), (4_843_710,)], "n long").select("n", X.human_number(F.col("n")).alias("out"))
    assert {r.n: r.out for r in df.collect()} == {None: "-", 676: "676", 113_888: "114K", 999_999: "1000K", 1_000_000: "1.00M", 4_843_710: "4.84M"}
