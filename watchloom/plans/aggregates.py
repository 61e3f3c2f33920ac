"""Aggregations, windows, ordering and set operations (A*, W*, O*, U*) over the bound views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import entities, rules, service
from .views import DOCS, LOG, ODI, PARTIES, PARTS, SNAPS, docs, investments, joined, log, parties, parts, snapshot, table

QUERIES: dict = {}


def q(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = (f, sql)
        return f

    return put


#: Stated here once more, so that a wrong word in the rules shows.
BAD = "'not available', 'n/a', 'na', 'unknown', 'none', 'null', 'test', '-', '--', '---', 'tba', 'tbd', 'to be advised', 'see notes', 'see remarks', 'anonymous', 'no name', 'various', 'see attached', 'the bearer', 'bearer', 'bearer 1', 'person', 'individual', 'company', 'entity', 'limited', 'ltd'"
INTERESTING = f"name is not null and length(trim(name)) > 3 and lower(trim(name)) not in ({BAD}) and not regexp_full_match(trim(name), '[0-9\\s[:punct:]]+')"


@q("A01_headline", f"with {PARTS} select count(*) as n, count(distinct name) as names, count(distinct source_id) as sources from parts")
def a01(s: SparkSession, d: str) -> DataFrame:
    return parts(s, d).agg(F.count("*").alias("n"), F.countDistinct("name").alias("names"), F.countDistinct("source_id").alias("sources"))


@q("A02_filtered_counts", f"with {PARTS} select count(*) as n, count(*) filter (where size > 25) as large, count(*) filter (where name ilike '%red%') as red from parts")
def a02(s, d):
    return parts(s, d).agg(F.count("*").alias("n"), F.count_if(F.col("size") > 25).alias("large"), F.count_if(F.col("name").ilike("%red%")).alias("red"))


@q("A03_completeness", f"with {DOCS} select count(name) as names, count(nullif(trim(name), '')) as filled, count(details) as details, count(source_id) as sources from docs")
def a03(s, d):
    return docs(s, d).agg(F.count("name").alias("names"), F.count(F.nullif(F.trim("name"), F.lit(""))).alias("filled"), F.count("details").alias("details"), F.count("source_id").alias("sources"))


@q("A04_top_groups", f"with {PARTS} select source_id, count(*) as n from parts group by 1 order by n desc, source_id limit 10")
def a04(s, d):
    return parts(s, d).groupBy("source_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source_id").limit(10)


@q("A05_cross_agency", f"with {PARTS} select name, count(*) as n, count(distinct source_agency) as agencies, array_to_string(list_sort(list(distinct source_agency)), ',') as which from parts group by 1 having count(distinct source_agency) > 1")
def a05(s, d):
    g = parts(s, d).groupBy("name").agg(F.count("*").alias("n"), F.countDistinct("source_agency").alias("agencies"), joined(F.array_sort(F.collect_set("source_agency"))).alias("which"))
    return g.where("agencies > 1")


@q("A06_entity_groups", f"with {PARTS} select lower(trim(name)) as key, arg_min(name, id) as canonical_name, count(*) as num_records, count(distinct source_id) as num_sources, array_to_string(list_sort(list(distinct source_id)), ',') as sources, substr(sha256(lower(trim(name))), 1, 32) as group_id from parts where {INTERESTING} group by 1 having count(distinct source_id) >= 2")
def a06(s, d):
    return entities.groups(parts(s, d)).withColumn("sources", joined(F.col("sources")))


@q("A07_agency_arrays", f"with {PARTS} select lower(trim(name)) as key, array_to_string(list_sort(list(distinct source_agency) filter (where source_agency is not null)), ',') as agencies from parts group by 1")
def a07(s, d):
    return parts(s, d).groupBy(F.lower(F.trim("name")).alias("key")).agg(joined(F.array_sort(F.collect_set("source_agency"))).alias("agencies"))


@q("A08_sources_summary", f"with {PARTS} select source_id, max(name) as last_name, count(*) as n from parts where source_id is not null and source_id <> '' group by 1 having count(*) >= 60")
def a08(s, d):
    return service.source_list(parts(s, d), 60)


DAY = "strptime(period_from, '%d/%m/%Y')::date"


@q("A09_investment_stats", f"with {ODI} select count(*) as n, coalesce(sum(total), 0)::double as total, count(distinct indian_party) as companies, count(distinct country) as countries, min({DAY}) as first_day, max({DAY}) as last_day from odi")
def a09(s, d):
    return service.investment_stats(investments(s, d))


@q("A10_top_countries_companies", f"with {ODI}, c as (select 'country' as kind, country as name, count(*) as n, sum(total) as total from odi group by 2 order by n desc, name limit 10), p as (select 'company' as kind, indian_party as name, count(*) as n, sum(total) as total from odi group by 2 order by total desc, name limit 10) select kind, name, n, total::double as total from (from c union all from p)")
def a10(s, d):
    o = investments(s, d)
    c = o.groupBy(F.col("country").alias("name")).agg(F.count("*").alias("n"), F.sum("total").alias("total")).orderBy(F.desc("n"), "name").limit(10).withColumn("kind", F.lit("country"))
    p = o.groupBy(F.col("indian_party").alias("name")).agg(F.count("*").alias("n"), F.sum("total").alias("total")).orderBy(F.desc("total"), "name").limit(10).withColumn("kind", F.lit("company"))
    return c.unionByName(p).select("kind", "name", "n", F.col("total").cast("double").alias("total"))


@q("A11_country_list", f"with {ODI} select country, count(*) as n from odi where trim(country) <> '' group by 1")
def a11(s, d):
    return service.country_list(investments(s, d))


@q("A12_company_detail", f"with {ODI} select indian_party, round(sum(total), 4)::double as total, count(*) as n, array_to_string(list_sort(list(distinct country)), ',') as countries from odi group by 1")
def a12(s, d):
    return investments(s, d).groupBy("indian_party").agg(F.round(F.sum("total"), 4).cast("double").alias("total"), F.count("*").alias("n"), joined(F.array_sort(F.collect_set("country"))).alias("countries"))


SETS = "select {0} as year, country, jv_or_wos, count(*) as n, sum(total)::double as total from odi where {1} group by grouping sets ((), (1), (2), (3))"


@q("A13_company_report", f"with {ODI} " + SETS.format("substr(period_from, 7, 4)", "true"))
def a13(s, d):
    o = investments(s, d).withColumn("year", F.substring("period_from", 7, 4))
    return o.groupingSets([[], ["year"], ["country"], ["jv_or_wos"]], "year", "country", "jv_or_wos").agg(F.count("*").alias("n"), F.sum("total").cast("double").alias("total"))


@q("A14_country_report", f"with {ODI}, c as (select country, indian_party, count(*) as n, sum(total) as total, row_number() over (partition by country order by sum(total) desc, indian_party) as place from odi group by 1, 2) select country, indian_party, n, total::double as total, place::int as place from c where place <= 20")
def a14(s, d):
    return service.country_report(investments(s, d))


@q("A15_year_coverage", f"with {ODI} select substr(period_from, 7, 4) as year, count(distinct substr(period_from, 4, 2)) as months from odi group by 1")
def a15(s, d):
    return investments(s, d).groupBy(F.substring("period_from", 7, 4).alias("year")).agg(F.countDistinct(F.substring("period_from", 4, 2)).alias("months"))


@q("A16_blank_periods", f"with {ODI}, b as (select *, case when id % 13 = 0 then '' else period_from end as period from odi) select country, activity, count(*) as n from b where coalesce(trim(period), '') = '' group by 1, 2")
def a16(s, d):
    b = investments(s, d).withColumn("period", F.when(F.col("id") % 13 == 0, "").otherwise(F.col("period_from")))
    return b.where(F.coalesce(F.trim("period"), F.lit("")) == "").groupBy("country", "activity").agg(F.count("*").alias("n"))


@q("A17_source_state", f"with {LOG} select source_id, count(*) as n, max(strftime(scraped_at, '%Y-%m-%d %H:%M')) as last_text from log group by 1")
def a17(s, d):
    return log(s, d).groupBy("source_id").agg(F.count("*").alias("n"), F.max(F.date_format("scraped_at", "yyyy-MM-dd HH:mm")).alias("last_text"))


@q("A18_health_snapshot", f"with {LOG} select source_id, strftime(scraped_at, '%Y-%m-%d') as snapshot_date, count(*) as row_count, max(scraped_at) as last_scraped from log group by 1, 2")
def a18(s, d):
    return log(s, d).groupBy("source_id", F.date_format("scraped_at", "yyyy-MM-dd").alias("snapshot_date")).agg(F.count("*").alias("row_count"), F.max("scraped_at").alias("last_scraped"))


@q("A19_pre_counts", f"with {LOG} select source_id, count(*) as n from log group by 1")
def a19(s, d):
    return log(s, d).groupBy("source_id").agg(F.count("*").alias("n"))


@q("A20_daily_kpis", f"with {LOG} select count(*) as n, count(distinct source_id) as sources, count(distinct user_id) as users, count(*) filter (where scraped_at > timestamp '2024-01-20' - interval 24 hours and scraped_at <= timestamp '2024-01-20') as last_day, max(scraped_at) as last_seen from log")
def a20(s, d):
    now = F.lit("2024-01-20").cast("timestamp")
    recent = (F.col("scraped_at") > now - F.expr("interval 24 hours")) & (F.col("scraped_at") <= now)
    return log(s, d).agg(F.count("*").alias("n"), F.countDistinct("source_id").alias("sources"), F.countDistinct("user_id").alias("users"), F.count_if(recent).alias("last_day"), F.max("scraped_at").alias("last_seen"))


@q("A21_shell_kpis", f"with {PARTIES} select count(*) as records, count(distinct source_id) as sources, count(distinct address) as places from parties")
def a21(s, d):
    return parties(s, d).agg(F.count("*").alias("records"), F.countDistinct("source_id").alias("sources"), F.countDistinct("address").alias("places"))


@q("A22_group_distribution", f"with {PARTS}, g as (select lower(trim(name)) as key, count(distinct source_id) as k, list_sort(list(distinct source_id)) as src from parts group by 1) select k as num_sources, count(*) as groups, min(array_to_string(src[1:5], ',')) as first_five from g group by 1")
def a22(s, d):
    g = parts(s, d).groupBy(F.lower(F.trim("name")).alias("key")).agg(F.countDistinct("source_id").alias("num_sources"), F.array_sort(F.collect_set("source_id")).alias("src"))
    return g.groupBy("num_sources").agg(F.count("*").alias("groups"), F.min(joined(F.slice("src", 1, 5))).alias("first_five"))


@q("A24_registry_mentions", "with t as (select doc_id, source, unnest(regexp_extract_all(text, '[A-Za-z]{5}[a-z]{3}ing')) as w from documents) select w as mention, count(*) as n, arg_min(source, doc_id) as first_seen from t group by 1")
def a24(s, d):
    t = table(s, d, "documents").select("doc_id", "source", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{5}[a-z]{3}ing"), F.lit(0))).alias("mention"))
    return t.groupBy("mention").agg(F.count("*").alias("n"), F.min_by("source", "doc_id").alias("first_seen"))


@q("A26_cross_source_matches", f"with {PARTS} select lower(name) as norm, count(*) as n_records, count(distinct source_agency || '|' || source_id) as n_sources, substr(array_to_string(list_sort(list(distinct source_agency || ': ' || source_id)), '; '), 1, 300) as sources, arg_max(name, length(name) * 1000000 - id) as longest from parts group by 1 having count(distinct source_agency || '|' || source_id) >= 2")
def a26(s, d):
    g = parts(s, d).groupBy(F.lower("name").alias("norm")).agg(F.count("*").alias("n_records"), F.collect_set(F.concat_ws(": ", "source_agency", "source_id")).alias("set"), F.max_by("name", F.length("name") * 1000000 - F.col("id")).alias("longest"))
    return g.where(F.size("set") >= 2).select("norm", "n_records", F.size("set").cast("long").alias("n_sources"), F.substring(F.array_join(F.array_sort("set"), "; "), 1, 300).alias("sources"), "longest")


@q("A27_duplicate_names", f"with {PARTS} select 'in source' as kind, source_id || '/' || name as what, count(*) as n from parts group by 2 having count(*) > 1 union all select 'in lists', name, count(distinct source_id) from parts group by 2 having count(distinct source_id) >= 5")
def a27(s, d):
    p = parts(s, d)
    a = p.groupBy(F.concat_ws("/", "source_id", "name").alias("what")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("in source").alias("kind"), "what", "n")
    b = p.groupBy(F.col("name").alias("what")).agg(F.countDistinct("source_id").alias("n")).where("n >= 5").select(F.lit("in lists").alias("kind"), "what", "n")
    return a.union(b)


@q("A28_freshness", f"with {LOG} select source_id, max(scraped_at) as last_seen, date_diff('day', max(scraped_at)::date, date '2024-02-10') as age_days, date_diff('day', max(scraped_at)::date, date '2024-02-10') > 7 as stale from log group by 1")
def a28(s, d):
    g = log(s, d).groupBy("source_id").agg(F.max("scraped_at").alias("last_seen"))
    age = V.age_days(F.col("last_seen"), "2024-02-10").cast("long")
    return g.select("source_id", "last_seen", age.alias("age_days"), (age > 7).alias("stale"))


@q("A29_bulk_freshness", f"with {LOG} select user_id, max(scraped_at) as last_change, case when max(scraped_at) < timestamp '2024-01-31' - interval 96 hours then 'CRIT' when max(scraped_at) < timestamp '2024-01-31' - interval 48 hours then 'WARN' else 'OK' end as state from log group by 1")
def a29(s, d):
    now = F.lit("2024-01-31").cast("timestamp")
    g = log(s, d).groupBy("user_id").agg(F.max("scraped_at").alias("last_change"))
    return g.withColumn("state", rules.ladder((F.col("last_change") < now - F.expr("interval 96 hours"), "CRIT"), (F.col("last_change") < now - F.expr("interval 48 hours"), "WARN"), default="OK"))


@q("A30_alert_summary", f"with {LOG} select source_id as type, count(*) as alerts, count(*) filter (where value > 50) as probed from log group by 1")
def a30(s, d):
    return log(s, d).groupBy(F.col("source_id").alias("type")).agg(F.count("*").alias("alerts"), F.count_if(F.col("value") > 50).alias("probed"))


@q("A31_action_report", f"with {LOG} select sum(case when value > 50 then 1 else 0 end)::bigint as done, sum(case when value <= 50 then 1 else 0 end)::bigint as failed, round(sum(value), 2) as total from log")
def a31(s, d):
    return log(s, d).agg(F.sum(F.when(F.col("value") > 50, 1).otherwise(0)).alias("done"), F.sum(F.when(F.col("value") <= 50, 1).otherwise(0)).alias("failed"), F.round(F.sum("value"), 2).alias("total"))


@q("A33_value_counts", f"with {PARTS} select source_agency as value, count(*) as n, count(*) filter (where name is null) as nulls, max(size) as largest from parts group by 1")
def a33(s, d):
    return parts(s, d).groupBy(F.col("source_agency").alias("value")).agg(F.count("*").alias("n"), F.count_if(F.col("name").isNull()).alias("nulls"), F.max("size").alias("largest"))


@q("A34_cleaner_stats", f"with {DOCS} select case when name like '%.' then 'sentence' when name like '%|%' then 'table' else 'other' end as label, count(*) as n, max(length(name)) as longest, max(length(trim(name, ' .'))) as after from docs group by 1")
def a34(s, d):
    label = rules.ladder((F.col("name").endswith("."), "sentence"), (F.col("name").contains("|"), "table"), default="other")
    return docs(s, d).groupBy(label.alias("label")).agg(F.count("*").alias("n"), F.max(F.length("name")).cast("long").alias("longest"), F.max(F.length(F.btrim("name", F.lit(" .")))).cast("long").alias("after"))


@q("A35_distinct_lists", f"with {PARTS} select distinct source_agency, source_id from parts")
def a35(s, d):
    return parts(s, d).select("source_agency", "source_id").distinct()


@q("A36_distinct_on", f"with {PARTS} select lower(trim(name)) as key, source_id, min(id) as id, arg_min(name, id) as name from parts where {INTERESTING} group by 1, 2")
def a36(s, d):
    return entities.anchors(parts(s, d)).select("key", "source_id", "id", "name")


@q("A37_keep_first", "with l as (select *, row_number() over (partition by l_partkey, l_suppkey order by l_orderkey, l_linenumber) as r from lineitem) select l_partkey, l_suppkey, l_orderkey, l_linenumber from l where r = 1")
def a37(s, d):
    w = Window.partitionBy("l_partkey", "l_suppkey").orderBy("l_orderkey", "l_linenumber")
    t = table(s, d, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")
    return t.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


@q("W01_first_per_key", f"with {PARTS} select name, min(id) as id, arg_min(source_id, id) as source_id from parts group by 1")
def w01(s, d):
    w = Window.partitionBy("name").orderBy("id")
    return parts(s, d).select("name", "id", "source_id", F.row_number().over(w).alias("r")).where("r = 1").drop("r")


@q("W04_latest_two_snapshots", f"with {LOG}, s as (select source_id, strftime(scraped_at, '%Y-%m-%d') as day, count(*) as n from log group by 1, 2), r as (select *, dense_rank() over (order by day desc) as k from s) select source_id, day, n, k::int as k from r where k <= 2")
def w04(s, d):
    g = log(s, d).groupBy("source_id", F.date_format("scraped_at", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    days = g.select("day").distinct().orderBy(F.desc("day")).limit(2).withColumn("k", F.row_number().over(Window.orderBy(F.desc("day"))))
    return g.join(F.broadcast(days), "day").select("source_id", "day", "n", "k")


@q("W05_run_over_run", f"with {LOG}, s as (select source_id, strftime(scraped_at, '%Y-%m-%d') as day, count(*) as n from log group by 1, 2) select source_id, day, n, n - lag(n) over (partition by source_id order by day) as delta from s")
def w05(s, d):
    g = log(s, d).groupBy("source_id", F.date_format("scraped_at", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    return g.withColumn("delta", F.col("n") - F.lag("n").over(Window.partitionBy("source_id").orderBy("day")))


@q("W06_equal_runs", "with c as (select conv_id, turn, role, case when lag(role) over w is distinct from role then 1 else 0 end as new from conversations window w as (partition by conv_id order by turn)), r as (select *, sum(new) over (partition by conv_id order by turn) as island from c) select conv_id, island::bigint as island, role, count(*) as turns, min(turn) as first_turn from r group by 1, 2, 3")
def w06(s, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(s, d, "conversations").select("conv_id", "turn", "role")
    c = c.withColumn("new", F.when(F.lag("role").over(w).eqNullSafe(F.col("role")), 0).otherwise(1)).withColumn("island", F.sum("new").over(w))
    return c.groupBy("conv_id", "island", "role").agg(F.count("*").alias("turns"), F.min("turn").alias("first_turn"))


@q("W07_carry_forward", "with c as (select conv_id, turn, case when role = 'user' then length(text) end as mark from conversations) select conv_id, turn, last_value(mark ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and current row) as carried from c")
def w07(s, d):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    c = table(s, d, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.length("text").cast("long")).alias("mark"))
    return c.select("conv_id", "turn", F.last("mark", True).over(w).alias("carried"))


@q("W08_three_in_a_row", f"with {LOG}, e as (select user_id, id, sum(case when value < 20 then 1 else 0 end) over (partition by user_id order by id rows between 2 preceding and current row) as low from log) select user_id, min(id) as stop_at from e where low = 3 group by 1")
def w08(s, d):
    w = Window.partitionBy("user_id").orderBy("id").rowsBetween(-2, 0)
    e = log(s, d).select("user_id", "id", F.sum(F.when(F.col("value") < 20, 1).otherwise(0)).over(w).alias("low"))
    return e.where("low = 3").groupBy("user_id").agg(F.min("id").alias("stop_at"))


@q("W09_later_duplicates", f"with {DOCS}, r as (select id, source_id, row_number() over (partition by name, source_id order by id) as k from docs) select id, source_id from r where k > 1")
def w09(s, d):
    w = Window.partitionBy("name", "source_id").orderBy("id")
    return docs(s, d).select("id", "source_id", F.row_number().over(w).alias("k")).where("k > 1").drop("k")


@q("W10_all_duplicates", f"with {DOCS} select id, count(*) over (partition by md5(details)) > 1 as repeated from docs")
def w10(s, d):
    t = docs(s, d).select("id", F.md5(F.col("details").cast("binary")).alias("h"))
    return t.join(t.groupBy("h").agg(F.count("*").alias("n")), "h").select("id", (F.col("n") > 1).alias("repeated"))


@q("W12_serial_groups", "with c as (select conv_id, turn, sum(case when role = 'user' then 1 else 0 end) over (partition by conv_id order by turn) as g from conversations) select conv_id, g::bigint as g, count(*) as n from c group by 1, 2")
def w12(s, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(s, d, "conversations").select("conv_id", F.sum(F.when(F.col("role") == "user", 1).otherwise(0)).over(w).alias("g"))
    return c.groupBy("conv_id", "g").agg(F.count("*").alias("n"))


@q("O01_paging", f"with {ODI} select id, indian_party, total::double as total from odi order by {DAY} desc nulls last, total desc nulls last, id limit 25 offset 50")
def o01(s, d):
    o = investments(s, d).withColumn("day", V.day(F.col("period_from")))
    return o.orderBy(F.desc_nulls_last("day"), F.desc_nulls_last("total"), "id").offset(50).limit(25).select("id", "indian_party", F.col("total").cast("double").alias("total"))


@q("O05_top_amounts", f"with {ODI} select id, total::double as total from odi order by total desc nulls last, id limit 50")
def o05(s, d):
    return investments(s, d).orderBy(F.desc_nulls_last("total"), "id").limit(50).select("id", F.col("total").cast("double").alias("total"))


@q("O06_group_order", f"with {PARTS}, g as (select name, count(distinct source_id) as k, count(*) as n from parts group by 1) select name, k, n, row_number() over (order by k desc, n desc, name)::int as place from g order by place limit 20")
def o06(s, d):
    g = parts(s, d).groupBy("name").agg(F.countDistinct("source_id").alias("k"), F.count("*").alias("n")).orderBy(F.desc("k"), F.desc("n"), "name").limit(20)
    return g.withColumn("place", F.row_number().over(Window.orderBy(F.desc("k"), F.desc("n"), "name")))


@q("O07_largest_candidates", f"with {PARTS} select name, count(*) as n from parts group by 1 order by n desc, name limit 30")
def o07(s, d):
    return parts(s, d).groupBy("name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(30)


@q("O08_report_slices", f"with {LOG}, r as (select source_id, id, value, row_number() over (partition by source_id order by value desc, id) as k from log) select source_id, id, value, k::int as k from r where k <= 5")
def o08(s, d):
    w = Window.partitionBy("source_id").orderBy(F.desc("value"), "id")
    return log(s, d).select("source_id", "id", "value", F.row_number().over(w).alias("k")).where("k <= 5")


@q("O10_worst_first", f"with {DOCS} select source_id, count(*) as n, round(100.0 * count(*) filter (where length(name) < 40) / count(*), 2) as fail_pct from docs group by 1 order by fail_pct desc, source_id limit 15")
def o10(s, d):
    g = docs(s, d).groupBy("source_id").agg(F.count("*").alias("n"), F.round(F.count_if(F.length("name") < 40) * F.lit(100.0) / F.count("*"), 2).alias("fail_pct"))
    return g.orderBy(F.desc("fail_pct"), "source_id").limit(15)


@q("O11_period_sort", f"with {ODI}, p as (select distinct period_from from odi) select period_from from p order by {DAY} desc limit 40")
def o11(s, d):
    return investments(s, d).select("period_from").distinct().orderBy(V.day(F.col("period_from")).desc()).limit(40)


@q("O12_ordered_limit", f"with {PARTS} select id, name from parts where lower(name) = lower('RED widget') order by id limit 5")
def o12(s, d):
    return parts(s, d).where(F.lower("name") == "red widget").orderBy("id").limit(5).select("id", "name")


@q("U01_union_all", f"with {PARTIES}, {PARTS} select id, name, source_id from parties union all select id, name, source_id from parts")
def u01(s, d):
    return parties(s, d).select("id", "name", "source_id").unionByName(parts(s, d).select("id", "name", "source_id"))


@q("U03_key_sets", f"with {SNAPS}, p as (select distinct name, source_list from prev), c as (select distinct name, source_list from curr) select 'added' as kind, count(*) as n from (from c except from p) union all select 'removed', count(*) from (from p except from c) union all select 'kept', count(*) from (from p intersect from c)")
def u03(s, d):
    p, c = (snapshot(s, d, x).select("name", "source_list").distinct() for x in (False, True))
    count = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
    return count(c.subtract(p), "added").union(count(p.subtract(c), "removed")).union(count(p.intersect(c), "kept"))


@q("U04_membership_diff", f"with {PARTS}, x as (select distinct name from parts where source_id = 'Brand#11'), y as (select distinct name from parts where source_id = 'Brand#12') select 'left' as side, name from (from y except from x) union all select 'joined', name from (from x except from y)")
def u04(s, d):
    p = parts(s, d).select("name", "source_id")
    x, y = p.where("source_id = 'Brand#11'").select("name").distinct(), p.where("source_id = 'Brand#12'").select("name").distinct()
    return y.subtract(x).select(F.lit("left").alias("side"), "name").union(x.subtract(y).select(F.lit("joined").alias("side"), "name"))


@q("U05_array_union", f"with {PARTS}, g as (select name, list(distinct source_id) filter (where size < 25) as a, list(distinct source_id) filter (where size > 40) as b from parts group by 1) select name, array_to_string(list_sort(list_distinct(coalesce(a, []) || coalesce(b, []))), ',') as both, len(list_distinct(coalesce(a, []) || coalesce(b, []))) as n from g")
def u05(s, d):
    g = parts(s, d).groupBy("name").agg(F.collect_set(F.when(F.col("size") < 25, F.col("source_id"))).alias("a"), F.collect_set(F.when(F.col("size") > 40, F.col("source_id"))).alias("b"))
    both = F.array_sort(F.array_union("a", "b"))
    return g.select("name", joined(both).alias("both"), F.size(both).cast("long").alias("n"))
