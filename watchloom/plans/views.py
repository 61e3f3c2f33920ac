"""The reference-shaped views over the given tables, as DataFrames and as SQL for the oracle.

All DataFrames start from a Parquet scan; a query selects the columns it needs and the scan reads no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("source_id"), F.col("p_type").alias("source_agency"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("amount"))


PARTS = "parts as (select p_partkey as id, p_name as name, p_brand as source_id, p_type as source_agency, p_size as size, p_retailprice as amount from part)"


def parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("address"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("source_id"), F.col("c_nationkey").alias("n_nationkey"))
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 10_000_000).alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("source_id"), F.col("s_nationkey").alias("n_nationkey"))
    return c.unionByName(s).join(n, "n_nationkey").select("id", "name", "source_id", "address")


PARTIES = "parties as (select id, name, source_id, n_name as address from (select c_custkey as id, c_name as name, 'customer' as source_id, c_nationkey as k from customer union all select s_suppkey + 10000000, s_name, 'supplier', s_nationkey from supplier) join nation on n_nationkey = k)"


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a list with a key, a name and one of five regions."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("n_nationkey"), F.col("c_name").alias("n_name"), (F.col("c_nationkey") % 5).alias("n_regionkey"))


LISTED = "(select c_custkey as n_nationkey, c_name as n_name, c_nationkey % 5 as n_regionkey from customer) nation"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"), F.element_at(F.split("text", "\n"), 1).alias("name"), F.col("text").alias("details"), F.col("source").alias("source_id"), F.col("lang").alias("source_agency"))


DOCS = "docs as (select doc_id as id, string_split(text, chr(10))[1] as name, text as details, source as source_id, lang as source_agency from documents)"


def investments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
    return j.select(F.col("o_orderkey").alias("id"), F.col("c_name").alias("indian_party"), F.col("n_name").alias("country"), F.col("c_mktsegment").alias("activity"), F.col("o_orderstatus").alias("jv_or_wos"), F.col("o_totalprice").cast("decimal(18,2)").alias("total"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("period_from"))


ODI = "odi as (select o_orderkey as id, c_name as indian_party, n_name as country, c_mktsegment as activity, o_orderstatus as jv_or_wos, cast(o_totalprice as decimal(18,2)) as total, strftime(o_orderdate, '%d/%m/%Y') as period_from from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"), F.col("event_type").alias("source_id"), F.col("user_id"), F.col("ts").alias("scraped_at"), "value", "props")


LOG = "log as (select event_id as id, event_type as source_id, user_id, ts as scraped_at, value, props from events)"


def snapshot(spark: SparkSession, sf_dir: str, current: bool) -> DataFrame:
    """Two states of the same list: some keys are in one only, some have another payload."""
    o = table(spark, sf_dir, "orders").where("o_orderkey % 11 <> 0" if current else "o_orderkey % 7 <> 0")
    payload = F.when(F.col("o_orderkey") % 5 == 0, F.concat("o_orderpriority", F.lit(" (revised)"))).otherwise(F.col("o_orderpriority")) if current else F.col("o_orderpriority")
    return o.select(F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"), F.col("o_orderstatus").alias("source_list"), payload.alias("details"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("scraped_at"))


SNAPS = """prev as (select 'order ' || o_orderkey as name, o_orderstatus as source_list, o_orderpriority as details from orders where o_orderkey % 7 <> 0),
curr as (select 'order ' || o_orderkey as name, o_orderstatus as source_list, case when o_orderkey % 5 = 0 then o_orderpriority || ' (revised)' else o_orderpriority end as details from orders where o_orderkey % 11 <> 0)"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def joined(array) -> object:
    return F.array_join(array, ",")
