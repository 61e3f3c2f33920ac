"""Periods by text and file name; the expected months are read off the reference's ``infer_period``."""

from datetime import date

from pyspark.sql import functions as F

from watchloom.functions import values as V
from watchloom.plans import registry

CASES = (
    ("Data for September 2013", "book.xls", "2013-09"), ("", "ODI_feb_2019", "2019-02"), ("", "OFDI010913.xls", "2013-09"), ("", "OFDI14092023", "2023-08"), ("", "OFDI14012023", "2022-12"),
    ("nothing", "", None), (None, None, None),
    ("", "OFDI01092013.xls", "2013-09"),  # four digits of a year before .xls are no release date
    ("", "PR1638OFDI1117_NOV.xls", "2017-11"),  # two digits of a year
    ("feb and jan", "2019", "2019-01"),  # the calendar's first month
    ("march 2015, jan 2016", "", "2016-01"), ("january 2015 jan 2016", "", "2016-01"),
    ("dec 1999", "x", None), ("dec 2004", "x", "2004-12"), ("dec 2031", "x", "2031-12"),  # beside the name 2005 to 2030, anywhere any 20xx
    ("", "OFDI14132023 and 14092023", None),  # the first run of digits only
    ("Sept 2013", "", "2013-09"), ("", "OFDI0913.xls", None),
)


def test_periods_are_the_references(spark):
    df = spark.createDataFrame([(i, t, f) for i, (t, f, _) in enumerate(CASES)], "id int, text string, file string")
    got = {r.id: r.p for r in df.select("id", V.inferred_period(F.col("text"), F.col("file")).alias("p")).collect()}
    assert got == {i: p and date.fromisoformat(f"{p}-01") for i, (*_, p) in enumerate(CASES)}


def test_the_query_has_each_form_of_a_period(spark):
    """A month's name beside a year, digits with two and four digits of a year, a name apart from its year, a release date."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(F.col("o_orderkey").alias("id"), F.add_months("o_orderdate", 240).alias("d"))
    out = registry.queries()["D05_inferred_period"](spark, "/root/testdata/sf0.001").join(orders, "id")
    ahead = {r.n: r["count"] for r in out.groupBy(F.months_between(F.trunc("d", "month"), F.col("out").cast("date")).cast("int").alias("n")).count().collect()}
    n = orders.count()
    assert set(ahead) == {0, 1, None} and sum(ahead.values()) == n and min(ahead[1], ahead[None]) >= n // 8
