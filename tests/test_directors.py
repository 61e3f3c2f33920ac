"""Line numbers with as many digits as a director's number."""

import duckdb
from pyspark.sql import functions as F

from watchloom.plans import registry
from watchloom.sources import grammars

NAME = "E04_directors"
CIN = "U12345MH2001PTC000007"
CASES = (  # line, director's number, name, company
    (f"123456 {CIN} ACME LTD 11223344 RAM LAL RC-DL1 Active", "11223344", "RAM LAL", "ACME LTD"),
    (f"1234567 11223344 Ram Lal ACME TRADING PRIVATE LIMITED {CIN} Violated", "11223344", None, None),
    (f"12345678. 112233 Ram Lal Long Name Works {CIN}", "112233", "Ram Lal", "Long Name Works"),
    (f"7 {CIN} ACME LTD 11223344 RAM LAL", "11223344", "RAM LAL", "ACME LTD"),
    (f"11223344 Ram Lal Long Name Works {CIN}", "11223344", "Ram Lal", "Long Name Works"),  # no line number
    (f"11223344 Ram Lal Road 110001 Name {CIN}", "11223344", "Ram Lal", "Road 110001 Name"),
)


def test_line_numbers_are_no_directors(spark):
    lines = spark.createDataFrame([("f", i, 1, line) for i, (line, *_) in enumerate(CASES)], "file string, page int, line_no int, line string")
    documents = spark.createDataFrame([("f", "t", "o", "d")], "file string, title string, office string, date string")
    got = {r.page: r for r in grammars.parsed("directors", lines, documents).collect()}
    for i, (_, din, name, company) in enumerate(CASES):
        if name:
            assert (got[i].name, got[i].details.split(" | ")[:2]) == (name, [f"DIN: {din}", f"Company: {company}"])
    assert 1 not in got  # a company that takes all words leaves no name, as in the reference


def test_the_query_over_keys_of_six_digits_and_more(spark, tmp_path):
    keys = [*range(3), *range(99_999, 100_002), *range(999_999, 1_000_002), *range(12_345_678, 12_345_681), 123_456_789]
    spark.createDataFrame([(k, f"large {w}", "b", "t", 1, 1.0) for k, w in zip(keys, ["ring", "bolt", "gear"] * 5)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    part = duckdb.read_parquet(f"{tmp_path}/part.parquet/*.parquet")  # noqa: F841  read by the SQL
    want = set(duckdb.sql(f"select line_no, name, details from ({registry.oracle_sql()[NAME]})").fetchall())
    got = registry.queries()[NAME](spark, str(tmp_path)).select(F.col("line_no"), "name", "details").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(keys)
