"""The call surface: screening and reports on names, investment search, statistics and exports, sources, status. Each call gives a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.values import day
from . import screening
from .rules import verdict


def header_difference(columns: list[str], wanted: tuple[str, ...]) -> tuple[list[str], list[str]]:
    """Columns that lack and columns that are too many."""
    return [c for c in wanted if c not in columns], [c for c in columns if c not in wanted]


def screen_names(spark: SparkSession, names: list[str], records: DataFrame, threshold: float = 0.3, limit: int = 10) -> DataFrame:
    """One name or many, up to 50 a call."""
    if not 1 <= len(names) <= 50 or not 0.1 <= threshold <= 1 or not 1 <= limit <= 200:
        raise ValueError("1 to 50 names, a threshold of 0.1 to 1 and a limit of 1 to 200 are asked for")
    return screening.screen(spark.createDataFrame(list(enumerate(names, 1)), "q_id int, query string"), records, threshold, limit)


def escalate(matches: DataFrame, enough: int = 5) -> DataFrame:
    """A level's matches count only while the levels before have fewer than ``enough``."""
    per = matches.groupBy("q_id", "tier").agg(F.count("*").alias("n"))
    earlier = per.alias("a").join(per.alias("b"), (F.col("a.q_id") == F.col("b.q_id")) & (F.col("b.tier") < F.col("a.tier")), "left").groupBy("a.q_id", "a.tier").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    return matches.join(earlier.where(F.col("before") < enough).select("q_id", "tier"), ["q_id", "tier"], "left_semi")


def matching_investments(odi: DataFrame, company: str | None = None, country: str | None = None, activity: str | None = None, kind: str | None = None, since: str | None = None, until: str | None = None, least: float | None = None, most: float | None = None, year: int | None = None) -> DataFrame:
    """The conjunction of the filters that are given."""
    at = day(F.col("period_from"))
    wanted: list[Column] = []
    for column, value in (("indian_party", company), ("country", country), ("activity", activity)):
        if value is not None:
            wanted.append(F.col(column).ilike(f"%{value}%"))
    if kind is not None:
        wanted.append(F.upper("jv_or_wos") == kind.upper())
    if since is not None:
        wanted.append(at >= F.lit(since).cast("date"))
    if until is not None:
        wanted.append(at <= F.lit(until).cast("date"))
    if least is not None:
        wanted.append(F.col("total") >= least)
    if most is not None:
        wanted.append(F.col("total") <= most)
    if year is not None:
        wanted.append(F.substring("period_from", 7, 4) == str(year))
    for w in wanted:
        odi = odi.where(w)
    return odi


def investment_search(odi: DataFrame, page: int = 1, per_page: int = 50, **filters) -> DataFrame:
    """One page of what the filters leave, latest and largest first."""
    found = matching_investments(odi, **filters)
    return found.orderBy(day(F.col("period_from")).desc_nulls_last(), F.desc_nulls_last("total"), "id").offset((page - 1) * per_page).limit(per_page)


def name_report(spark: SparkSession, name: str, records: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One name's hits and what follows from them: agencies, lists, verdict. Records need ``source_agency``."""
    hits = screen_names(spark, [name], records, threshold, 100)
    found = hits.join(records.select("id", "source_agency"), "id")
    one = found.agg(F.count("*").alias("hits"), F.array_sort(F.collect_set("source_agency")).alias("agencies"), F.array_sort(F.collect_set("source_id")).alias("lists"), F.min("tier").alias("tier"))
    return one.select(F.lit(name).alias("query"), "hits", "agencies", "lists", "tier", verdict(F.col("agencies"), F.col("lists"), F.col("hits")).alias("verdict"))


def source_list(records: DataFrame, least: int = 1) -> DataFrame:
    """Sources with their number of records and last name in order."""
    own = records.where("source_id is not null and source_id <> ''")
    return own.groupBy("source_id").agg(F.max("name").alias("last_name"), F.count("*").alias("n")).where(F.col("n") >= least)


def health(records: DataFrame, log: DataFrame) -> DataFrame:
    """One row: records, sources, and when the last run was seen."""
    a = records.agg(F.count("*").alias("n"), F.countDistinct("source_id").alias("sources"))
    return a.withColumn("last_seen", F.lit(log.agg(F.max("scraped_at")).first()[0]))


def investment_stats(odi: DataFrame) -> DataFrame:
    at = day(F.col("period_from"))
    return odi.agg(F.count("*").alias("n"), F.coalesce(F.sum("total"), F.lit(0)).cast("double").alias("total"), F.countDistinct("indian_party").alias("companies"), F.countDistinct("country").alias("countries"), F.min(at).alias("first_day"), F.max(at).alias("last_day"))


def company_report(odi: DataFrame, company: str) -> DataFrame:
    """A company's number and sum in all, by year, by country and by kind; the name is matched without case."""
    own = odi.where(F.lower("indian_party") == company.strip().lower()).withColumn("year", F.substring("period_from", 7, 4))
    return own.groupingSets([[], ["year"], ["country"], ["jv_or_wos"]], "year", "country", "jv_or_wos").agg(F.count("*").alias("n"), F.sum("total").cast("double").alias("total"))


def country_list(odi: DataFrame) -> DataFrame:
    return odi.where(F.trim("country") != "").groupBy("country").agg(F.count("*").alias("n"))


def country_report(odi: DataFrame, most: int = 20) -> DataFrame:
    """The companies with the largest sums in each country."""
    c = odi.groupBy("country", "indian_party").agg(F.count("*").alias("n"), F.sum("total").alias("total"))
    place = F.row_number().over(Window.partitionBy("country").orderBy(F.desc("total"), "indian_party"))
    return c.withColumn("place", place).where(F.col("place") <= most).withColumn("total", F.col("total").cast("double"))


def export(odi: DataFrame, path: str, form: str = "csv", **filters) -> DataFrame:
    """All rows that the filters leave, oldest first and then by id, as CSV with headers or as JSON lines; and the rows as read back.

    The sort is a range partitioning by date and id: each file holds a range, and the files' names follow it. Nulls are blank in CSV.
    """
    found = matching_investments(odi, **filters)
    rows = found.orderBy(day(F.col("period_from")).asc_nulls_last(), "id")
    spark = odi.sparkSession
    if form == "json":
        rows.write.mode("overwrite").json(path)
        return spark.read.schema(found.schema).json(path)
    if form != "csv":
        raise ValueError(f"export as {form!r} is not known")
    rows.write.mode("overwrite").option("header", True).option("nullValue", "").option("escape", '"').csv(path)
    return spark.read.schema(found.schema).option("header", True).option("escape", '"').csv(path)
