"""Queries over the call surface, title extraction, tier budgets and the remaining loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.titles import entity_of_title
from ..operators import entities, rules, service
from ..operators.result_cache import ResultCache
from ..sources import config_schema, sinks
from .aggregates import INTERESTING
from .landed import landing
from .relations import SCREEN, _queries
from .views import LISTED, LOG, ODI, PARTIES, PARTS, investments, joined, log, parties, parts, table, listed

QUERIES: dict = {}


def q(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = (f, sql)
        return f

    return put


#: Titles around a name, the name that must come out and the pattern that must find it.
TITLES = (
    ("Adjudication Order in respect of Shri {} in the matter of Beta Industries Ltd", "{}", "in_respect_of+matter_of"),
    ("Order with respect to {} Fund in matter of Beta", "{} Fund", "with_respect_to+matter_of"),
    ("Order against {} Traders in the matter of Beta Industries Ltd", "{} Traders", "against+matter_of"),
    ("Settlement Order against M/s. {} (PAN: ABCDE1234F)", "{}", "against+matter_of"),
    ("Settlement application submitted by {} LLP in the matter of Gamma", "{} LLP", "by+matter_of"),
    ("Completion of Recovery Certificate issued to {} [Defaulter]", "{}", "issued+defaulter"),
    ("Recovery Proceedings RC No. 12 of 2020 - {}", "{}", "rc_no+dash+name"),
    ("Certificate No. 33 of 2021 - {} Ltd (PAN: X)", "{} Ltd", "certificate_no+against"),
    ("Interim order in the repsect of {} Fund", "{} Fund", "in_respect_of"),
    ("Notice with respect to Smt. {}", "{}", "with_respect_to"),
    ("Recovery against Mr. Dr. {}.", "{}", "against"),
    ("Summons issued {} Corp in the matter of Delta", "{} Corp", "issued_to+matter_of"),
    ("Summons issued to {}, PAN 5", "{}", "issued_to"),
    ("Unserved Hearing Notice to {}", "{}", "notice_to"),
    ("Order in the matter of {} Ltd. dated 2 May", "{} Ltd", "in_the_matter_of"),
    ("Auction relating to {}", "{}", "relating_to"),
    ("Release of Bank and Demat Accounts of {} under section 5", "{}", "accounts_of"),
    ("Sale Notice for Immovable Property of {}", "{}", "auction_of_entity"),
    ("Notice for E-Auction at noon of {}", "{}", "eauction_of"),
    ("SEBI vs. {} & Ors.", "{}", "sebi_vs"),
    ("Order against 14 entities in the matter of {} Ltd", "{} Ltd", "aggregate->in_the_matter_of"),
    ("Order in respect of {}, erstwhile member of an exchange", "{}", "in_respect_of"),
    ("Order in respect of {} Limited (Formerly Known as", "{} Limited", "in_respect_of"),
    ("Order in respect of the company in the matter of {}", "{}", "in_the_matter_of"),
    ("Order in respect of interim order for {}", "Order in respect of interim order for {}", "no_match"),
    ("Order of the day about {}", "Order of the day about {}", "no_match"),
    ("Plain {}", "Plain {}", "already_clean"),
)


def _title_case(field: int) -> str:
    def text(t: str) -> str:
        return " || ".join(f"p_name || '{p}'" if i else f"'{p}'" for i, p in enumerate(t.split("{}")))

    return " ".join(f"when {i} then {text(t[field])}" for i, t in enumerate(TITLES))


@q("X10_title_entities", f"select p_partkey as id, case p_partkey % {len(TITLES)} {_title_case(1)} end as name, case p_partkey % {len(TITLES)} {_title_case(2)} end as label from part")
def x10(s, d):
    titles = F.array(*[F.concat(*[x for i, p in enumerate(t.split("{}")) for x in ((F.col("name"), F.lit(p)) if i else (F.lit(p),))]) for t, _, _ in TITLES])
    t = parts(s, d).select("id", entity_of_title(F.element_at(titles, (F.col("id") % len(TITLES) + 1).cast("int"))).alias("e"))
    return t.select("id", "e.name", "e.label")


@q("O04_level_escalation", SCREEN + ", k as (select * from r where k <= 100), n as (select q_id, tier, count(*) as n from k group by 1, 2), b as (select a.q_id, a.tier, coalesce(sum(b.n), 0) as before from n a left join n b on a.q_id = b.q_id and b.tier < a.tier group by 1, 2) select k.q_id, k.id, k.tier::int as tier from k join b on k.q_id = b.q_id and k.tier = b.tier where before < 5")
def o04(s, d):
    from ..operators import screening

    return service.escalate(screening.screen(_queries(s), parties(s, d), 0.6, 100)).select("q_id", "id", "tier")


@q("U02_tier_union", SCREEN + " select q_id, id, tier::int as tier from r where k <= 15")
def u02(s, d):
    from ..operators import screening

    return screening.screen(_queries(s), parties(s, d), 0.6, 15).select("q_id", "id", "tier")


@q("E08_screen_call", f"with {PARTIES} select 1 as q_id, id, 1 as tier from parties where lower(name) = 'supplier#000000007'")
def e08(s, d):
    return service.screen_names(s, ["SUPPLIER#000000007"], parties(s, d), 1.0).where("tier = 1").select("q_id", "id", "tier")


@q("E08_investment_call", f"with {ODI} select id, total::double as total from odi where country ilike '%ation_1%' and total >= 100000 and substr(period_from, 7, 4) = '1995' order by strptime(period_from, '%d/%m/%Y') desc, odi.total desc, id limit 20")
def e08_odi(s, d):
    return service.investment_search(investments(s, d), country="ation_1", least=100000, year=1995, page=1, per_page=20).select("id", F.col("total").cast("double").alias("total"))


@q("E08_name_report", f"with {PARTIES}, h as (select * from parties where lower(name) = 'supplier#000000007') select 'SUPPLIER#000000007' as query, count(*) as hits, array_to_string(list(distinct address), ',') as agencies, 'supplier' as lists, 1 as tier, 'LOW' as verdict from h")
def e08_report(s, d):
    p = parties(s, d).withColumnRenamed("address", "source_agency")
    r = service.name_report(s, "SUPPLIER#000000007", p, 1.0)
    return r.select("query", "hits", joined("agencies").alias("agencies"), joined("lists").alias("lists"), "tier", "verdict")


@q("E08_company_report", f"with {ODI}, o as (select *, substr(period_from, 7, 4) as year from odi where lower(indian_party) = 'customer#000000007') select year, country, jv_or_wos, count(*) as n, sum(total)::double as total from o group by grouping sets ((), (year), (country), (jv_or_wos))")
def e08_company(s, d):
    return service.company_report(investments(s, d), " CUSTOMER#000000007 ")


@q("E08_health_call", f"with {PARTS}, {LOG} select count(*) as n, count(distinct source_id) as sources, (select max(scraped_at) from log) as last_seen from parts")
def e08_health(s, d):
    return service.health(parts(s, d), log(s, d))


@q("E08_export_call", f"with {ODI} select id, country, total::double as total from odi where total <= 400000")
def e08_export(s, d):
    got = service.export(investments(s, d), f"{landing(s)}/export", most=400000)
    return got.select("id", "country", F.col("total").cast("double").alias("total"))


@q("T07_cached_call", f"with {PARTS} select source_id, max(name) as last_name, count(*) as n from parts where id % 3 <> 0 and source_id <> '' group by 1")
def t07(s, d):
    """The list of sources, asked of a table's first version twice and of its second once: two computations, three answers."""
    p, cache, done = parts(s, d), ResultCache(s, landing(s)), []

    def ask(version: int):
        def compute():
            done.append(version)
            return service.source_list(p if version == 1 else p.where("id % 3 <> 0"))

        return cache.get("sources", {"least": 1}, version, compute)

    ask(1), ask(1)
    found = ask(2)
    if done != [1, 2]:
        raise RuntimeError(f"computed for versions {done}")
    return found


@q("F11_source_guards", f"with {PARTS} select count(*) as n from parts where source_id is not null and source_id <> '' and id % 5 <> 0")
def f11(s, d):
    guarded = F.when(F.col("id") % 5 != 0, F.col("source_id")).otherwise(F.when(F.col("id") % 2 == 0, ""))
    return parts(s, d).withColumn("sid", guarded).where("sid is not null and sid <> ''").agg(F.count("*").alias("n"))


#: Configurations of ``part``: wrong in a way that follows from the row.
CONFIG_PROBLEMS = """concat_ws(',', case when p_partkey % 7 = 0 then 'list_name' end, case when p_partkey % 4 = 3 then 'engine' end, case when p_partkey % 5 = 0 then 'field_map' end, case when p_size < 5 then 'validation.min_records' end,
  case when p_retailprice > 1500 then 'validation.max_empty_name_pct' end, case when p_size % 9 = 0 then 'resilience.retries' end, case when p_partkey % 4 = 0 and p_partkey % 3 = 2 then 'format' end, case when p_partkey % 4 = 1 and p_size % 2 = 1 then 'pagination.type' end)"""


@q("F17_config_checks", f"select p_partkey as id, {CONFIG_PROBLEMS} as problems, case when p_partkey % 2 = 0 then 5.0 else p_retailprice / 15 end as max_empty_name_pct, 60 as timeout_seconds, 10 as retry_delay_seconds, true as snapshot_raw from part")
def f17(s, d):
    p = table(s, d, "part")
    key, size, price = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")
    config = F.struct(
        F.col("p_name").alias("source_id"), F.col("p_type").alias("agency"), F.when(key % 7 == 0, "").otherwise(F.col("p_brand")).alias("list_name"), F.lit("IN").alias("country"), F.lit("http://host/list").alias("url"),
        F.element_at(F.array(*map(F.lit, ("file_download", "html_table", "api_json", "ftp"))), (key % 4 + 1).cast("int")).alias("engine"),
        F.element_at(F.array(*map(F.lit, ("csv", "tsv", "pdf"))), (key % 3 + 1).cast("int")).alias("format"), F.when(key % 5 != 0, F.struct(F.col("p_type").alias("name"))).alias("field_map"),
        F.struct((size - 5).alias("min_records"), F.when((key % 2 == 1) | (price > 1500), price / 15).alias("max_empty_name_pct")).alias("validation"),
        F.struct(F.when(size % 9 == 0, -1).alias("retries")).alias("resilience"), F.struct(F.when(size % 2 == 1, "cursor").otherwise("offset").alias("type")).alias("pagination"),
    )
    found = config_schema.checked(p.select(key.alias("id"), F.to_json(config).alias("config"), price.alias("price")))
    shown = F.when(F.col("id") % 2 == 0, F.when(F.col("price") > 1500, 5.0).otherwise(F.col("max_empty_name_pct"))).otherwise(F.col("max_empty_name_pct"))
    return found.select("id", joined("problems").alias("problems"), shown.alias("max_empty_name_pct"), "timeout_seconds", "retry_delay_seconds", "snapshot_raw")


@q("U06_header_difference", "select * from (values ('missing', 15), ('extra', 1)) v(kind, n)")
def u06(s, d):
    from ..sources.files import CANONICAL

    missing, extra = service.header_difference(["name", "address", "surprise"], CANONICAL)
    return s.createDataFrame([("missing", len(missing)), ("extra", len(extra))], "kind string, n int")


@q("K13_groups_and_links", f"with {PARTS}, r as (select lower(trim(name)) as key, source_id, min(id) as id from parts where {INTERESTING} group by 1, 2), g as (select key, count(*) as sources from r group by 1 having count(*) > 1) select count(*) as groups, sum(sources - 1)::bigint as links from g")
def k13(s, d):
    at = landing(s)
    p = parts(s, d)
    entities.groups(p).select("key", F.lit(1).alias("group"), F.lit(0).alias("link")).write.parquet(f"{at}/groups")
    entities.links(p).select("key", F.lit(0).alias("group"), F.lit(1).alias("link")).write.parquet(f"{at}/links")
    return s.read.parquet(f"{at}/groups", f"{at}/links").agg(F.sum("group").alias("groups"), F.sum("link").alias("links"))


@q("K18_match_file", f"with {PARTS} select name, count(distinct source_id) as n_sources from parts group by 1 having count(distinct source_id) >= 2")
def k18(s, d):
    at = landing(s)
    g = parts(s, d).groupBy("name").agg(F.countDistinct("source_id").alias("n_sources")).where("n_sources >= 2")
    g.orderBy(F.desc("n_sources"), "name").coalesce(1).write.option("header", True).csv(at)
    return s.read.schema("name string, n_sources long").option("header", True).csv(at)


@q("K19_tracker_rows", f"with {PARTS}, g as (select source_id, count(*) as rows, max(id) as last_id, bool_or(name like 'red%') as real from parts where source_id <> 'Brand#7' group by 1), k as (select distinct source_id, right(source_id, 1) as e from parts) select k.source_id, coalesce(rows, 0) as rows, last_id, case when e = '1' then 'pending_recon' when e = '2' then 'skipped' when e = '3' then 'blocked' when rows is null then 'failed' when rows < 3 or not real then 'partial' else 'completed' end as status from k left join g using (source_id)")
def k19(s, d):
    p = parts(s, d)
    g = p.where("source_id <> 'Brand#7'").groupBy("source_id").agg(F.count("*").alias("rows"), F.max("id").alias("last_id"), F.bool_or(F.col("name").startswith("red")).alias("real"))
    t = p.select("source_id").distinct().join(g, "source_id", "left").withColumn("e", F.right("source_id", F.lit(1)))
    status = rules.tracker_status(F.col("e") != "1", F.when(F.col("e") == "2", "duplicate").otherwise("list"), F.when(F.col("e") == "3", "blocked").otherwise("active"), F.col("rows"), F.lit(False), F.lit(1), F.lit("table"), F.coalesce("real", F.lit(False)))
    return t.select("source_id", F.coalesce("rows", F.lit(0)).alias("rows"), "last_id", status.alias("status"))


@q("K23_refresh_if_newer", f"select count(*) as n from {LISTED}")
def k23(s, d):
    at = landing(s)
    n = listed(s, d)
    sinks.write_snapshot(n.limit(3), f"{at}/backup", "1")
    if sinks.snapshot_stamps(s, f"{at}/backup")[0] < "2":
        sinks.write_snapshot(n, f"{at}/backup", "2")
    return s.read.parquet(f"{at}/backup/run={sinks.snapshot_stamps(s, f'{at}/backup')[0]}").agg(F.count("*").alias("n"))


@q("A25_risk_histogram", f"with {PARTS}, v as (select name || '/' || size as g, list(distinct case id % 6 when 0 then 'cbi_wanted' when 1 then 'loan_defaulter' else 'register' end) as v from parts group by 1), x as (select case when list_contains(v, 'cbi_wanted') then 'HIGH' when list_contains(v, 'loan_defaulter') then 'MEDIUM' else 'LOW' end as level from v) select level, count(*) as n from x group by 1")
def a25(s, d):
    source = rules.ladder((F.col("id") % 6 == 0, "cbi_wanted"), (F.col("id") % 6 == 1, "loan_defaulter"), default="register")
    g = parts(s, d).groupBy(F.concat_ws("/", "name", "size")).agg(rules.group_risk(F.collect_set(source))["level"].alias("level"))
    return g.groupBy("level").agg(F.count("*").alias("n"))
