"""Filters, joins, screening, entity groups, rules and health (F*, J*, R*, Y*, O*, U*) over the bound views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import similarity as Y
from ..functions import text as X
from ..functions import values as V
from ..operators import entities, rules, screening
from ..operators.gram_index import GramIndex
from ..operators.nearest import nearest
from ..shared import numbered
from .aggregates import INTERESTING
from .scalars import pick
from .views import DOCS, LOG, ODI, PARTIES, PARTS, docs, investments, joined, log, parties, parts, table

QUERIES: dict = {}


def q(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = (f, sql)
        return f

    return put


GRAMS = "list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{Nd}}]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"
JACCARD = "(len(list_intersect({0}, {1})) / (len({0}) + len({1}) - len(list_intersect({0}, {1})))::double)"
TEXT_GRAMS = "list_distinct(list_transform(range(1, length({0}) + 2), lambda i: substr('  ' || {0} || ' ', i, 3)))"


# --- filters -----------------------------------------------------------------------------------
@q("F01_field_map", f"with {LOG} select id, coalesce(json_extract_string(props, '$.k'), '') as k, concat_ws(' | ', nullif(source_id, ''), nullif(json_extract_string(props, '$.k'), '')) as joined from log")
def f01(s, d):
    k = V.json_path(F.col("props"), "$.k")
    return log(s, d).select("id", F.coalesce(k, F.lit("")).alias("k"), F.concat_ws(" | ", F.nullif("source_id", F.lit("")), F.nullif(k, F.lit(""))).alias("joined"))


@q("F02_canonical_row", f"with {PARTIES} select source_id as source_agency, source_id as source_list, trim(regexp_replace(name, '\\s+', ' ', 'g')) as name, '' as father_name, address, 'No' as has_document from parties")
def f02(s, d):
    return parties(s, d).select(F.col("source_id").alias("source_agency"), F.col("source_id").alias("source_list"), X.squeeze(F.col("name")).alias("name"), F.lit("").alias("father_name"), "address", F.lit("No").alias("has_document"))


@q("F03_named_rows", f"with {DOCS} select id, name, case when strpos(details, 'http') > 0 then 'Yes' else 'No' end as has_document from docs where trim(coalesce(name, '')) <> ''")
def f03(s, d):
    return docs(s, d).where(F.trim(F.coalesce("name", F.lit(""))) != "").select("id", "name", F.when(F.col("details").contains("http"), "Yes").otherwise("No").alias("has_document"))


@q("F04_optional_filters", f"with {ODI} select id, indian_party, total::double as total from odi where indian_party ilike '%00%' and country ilike '%a%' and upper(jv_or_wos) = upper('o') and strptime(period_from, '%d/%m/%Y') >= date '1995-01-01' and strptime(period_from, '%d/%m/%Y') <= date '1997-12-31' and total >= 1000 and total <= 400000 and substr(period_from, 7, 4) = '1996'")
def f04(s, d):
    day = V.day(F.col("period_from"))
    wanted = [F.col("indian_party").ilike("%00%"), F.col("country").ilike("%a%"), F.upper("jv_or_wos") == "O", day >= F.lit("1995-01-01").cast("date"), day <= F.lit("1997-12-31").cast("date"), F.col("total") >= 1000, F.col("total") <= 400000, F.substring("period_from", 7, 4) == "1996"]
    o = investments(s, d)
    for w in wanted:
        o = o.where(w)
    return o.select("id", "indian_party", F.col("total").cast("double").alias("total"))


@q("F05_contains", f"with {PARTS} select id, name from parts where name ilike '%blue%'")
def f05(s, d):
    return parts(s, d).where(F.col("name").ilike("%blue%")).select("id", "name")


@q("F06_equal_any_case", f"with {PARTS} select id from parts where lower(name) = lower('Blue WIDGET')")
def f06(s, d):
    return parts(s, d).where(F.lower("name") == F.lower(F.lit("Blue WIDGET"))).select("id")


@q("F07_all_tokens", f"with {PARTS} select id, name from parts where lower(name) like '%red%' and lower(name) like '%wid%'")
def f07(s, d):
    tokens = F.array(*[F.lit(t) for t in ("red", "wid")])
    return parts(s, d).where(F.forall(tokens, lambda t: F.contains(F.lower("name"), t))).select("id", "name")


@q("F08_any_contains", f"with {PARTS} select id from parts where name like '%red%' or name like '%bolt%'")
def f08(s, d):
    return parts(s, d).where(F.col("name").contains("red") | F.col("name").contains("bolt")).select("id")


@q("F09_in_list", f"with {PARTS} select id, source_id from parts where source_id in ('Brand#11', 'Brand#22', 'Brand#33')")
def f09(s, d):
    return parts(s, d).where(F.col("source_id").isin("Brand#11", "Brand#22", "Brand#33")).select("id", "source_id")


@q("F10_interesting_names", f"with {PARTS} select id, name from parts where {INTERESTING}")
def f10(s, d):
    return parts(s, d).where(rules.interesting_name(F.col("name"))).select("id", "name")


@q("F12_having", f"with {PARTS} select source_id, count(*) as n from parts group by 1 having count(*) >= 80")
def f12(s, d):
    return parts(s, d).groupBy("source_id").agg(F.count("*").alias("n")).where("n >= 80")


VISIBLE = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script>', ' ', 'g'), '(?is)<style\\b[^>]*>.*?</style>', ' ', 'g'), '(?is)<nav\\b[^>]*>.*?</nav>', ' ', 'g'), '(?is)<header\\b[^>]*>.*?</header>', ' ', 'g'), '(?is)<footer\\b[^>]*>.*?</footer>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"


@q("F13_page_kind", f"with p as (select page_id, lower(html) as b, {VISIBLE} as v from pages) select page_id, case when page_id % 17 = 0 then 'dead' when b like '%type=\"password\"%' or b like '%captcha%' then 'restricted' when b like '%<table%' then 'html' when length(v) < 300 and (b like '%id=\"root\"%' or b like '%id=\"app\"%' or b like '%ng-app%' or strpos(b, '__next') > 0) then 'js' when length(v) < 80 then 'js' else 'html' end as kind from p")
def f13(s, d):
    p = table(s, d, "pages").withColumn("v", X.visible_text(F.col("html")))
    status = F.when(F.col("page_id") % 17 == 0, 404).otherwise(200)
    return p.select("page_id", rules.page_kind(status, F.lit("text/html"), F.col("html"), F.col("v")).alias("kind"))


@q("F14_page_score", "with p as (select page_id, html, lower(html) as b from pages) select page_id, least(100, case when b like '%<title>%the%' then 30 when b like '%the%' then 10 else 0 end + case when len(regexp_extract_all(html, '(?i)<tr')) >= 3 then 30 else 0 end + case when len(regexp_extract_all(html, '(?i)href=\"[^\"]+\\.(?:pdf|csv|xlsx?)')) > 0 then 20 else 0 end + case when length(html) >= 10000 then 10 else 0 end) as score from p")
def f14(s, d):
    b, h = F.lower("html"), F.col("html")
    found = lambda p: F.size(F.regexp_extract_all(h, F.lit(p), F.lit(0)))
    score = rules.page_score(b.like("%<title>%the%").cast("int"), b.contains("the").cast("int"), found("(?i)<tr"), found(r'(?i)href="[^"]+\.(?:pdf|csv|xlsx?)'), F.lit(False), F.length(h))
    return table(s, d, "pages").select("page_id", score.alias("score"))


@q("F15_best_candidate", f"with {LOG}, c as (select user_id, id, case when value < 30 then -3 when value > 90 then 3 when value < 50 then 0 else 1 end as score from log) select user_id, arg_max(id, score * 10000000 - id) as best, max(score)::int as score, case when max(score) >= 3 then 'high' when max(score) >= 1 then 'medium' when max(score) >= 0 then 'low' else 'dead' end as label from c group by 1")
def f15(s, d):
    score = rules.candidate_score(F.when(F.col("value") < 30, 500).otherwise(200), (F.col("value") > 90).cast("int"), F.when(F.col("value") < 50, "home").otherwise("list"))
    c = log(s, d).select("user_id", "id", score.alias("score"))
    return c.groupBy("user_id").agg(F.max_by("id", F.col("score") * 10000000 - F.col("id")).alias("best"), F.max("score").alias("score")).withColumn("label", rules.candidate_label(F.col("score")))


@q("F16_output_gate", f"with {DOCS} select count(*) >= 10 as enough, 100.0 * count(*) filter (where trim(coalesce(name, '')) = '') / count(*) as empty_pct, count(*) filter (where regexp_matches(name, '<[a-zA-Z/!?][^>]*>')) as html, count(*) filter (where regexp_full_match(name, '\\d+')) as digits from docs")
def f16(s, d):
    n = F.col("name")
    return docs(s, d).agg((F.count("*") >= 10).alias("enough"), (F.lit(100.0) * F.count_if(F.trim(F.coalesce(n, F.lit(""))) == "") / F.count("*")).alias("empty_pct"), F.count_if(n.rlike("<[a-zA-Z/!?][^>]*>")).alias("html"), F.count_if(n.rlike(r"^\d+$")).alias("digits"))


@q("F18_row_validation", f"with {DOCS}, r as (select *, row_number() over (partition by name, source_id order by id) > 1 as dup from docs), p as (select source_id, unnest(list_filter([case when trim(coalesce(name, '')) = '' then 'empty_name' end, case when length(trim(name)) between 1 and 2 then 'serial' end, case when dup then 'duplicate' end], lambda x: x is not null)) as problem from r) select source_id, problem, count(*) as n from p group by 1, 2")
def f18(s, d):
    w = Window.partitionBy("name", "source_id").orderBy("id")
    n = F.trim(F.coalesce("name", F.lit("")))
    r = docs(s, d).withColumn("dup", F.row_number().over(w) > 1)
    problems = F.array_compact(F.array(F.when(n == "", "empty_name"), F.when(F.length(n).between(1, 2), "serial"), F.when(F.col("dup"), "duplicate")))
    return r.select("source_id", F.explode(problems).alias("problem")).groupBy("source_id", "problem").agg(F.count("*").alias("n"))


#: Stated here once more, so that a wrong word in the rules shows.
NAV = "'home', 'about', 'contact', 'login', 'search', 'menu', 'back', 'next', 'previous', 'submit', 'click here', 'read more', 'download', 'skip to content'"
BLOCKED = ("request rejected", "access denied", "please enable javascript", "javascript is required", "captcha required", "verify you are human", "are you a robot", "checking your browser", "human verification", "the requested url was rejected")
HIGH = "wanted|sanction|fugitive|terror|banned|red[-_]?notice|interpol|nia_|mha_|ofac|un_|cbi_|ed_"
MEDIUM = "defaulter|debarred|suspend|enforc|penalt|disqualif|revok|disciplin|caution|warn|alert|prohibit|cancel"


@q("F19_garbage_flags", f"with {DOCS}, k as (select source_id, name, details, count(*) as c from docs group by all), g as (select source_id, sum(case when lower(trim(name)) in ({NAV}) then c else 0 end) / sum(c) as nav, sum(case when c >= 2 then c else 0 end) / sum(c) as dup, sum(case when trim(coalesce(name, '')) = '' and trim(coalesce(details, '')) = '' then c else 0 end) / sum(c) as emp from k group by 1) select source_id, case when nav > 0.3 then 'garbage_nav' when dup > 0.5 then 'garbage_dupes' when emp > 0.7 then 'garbage_empty' else 'clean' end as flag, round(dup, 6) as dup from g")
def f19(s, d):
    k = docs(s, d).groupBy("source_id", "name", "details").agg(F.count("*").alias("c"))
    share = lambda cond: F.sum(F.when(cond, F.col("c")).otherwise(0)) / F.sum("c")
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    g = k.groupBy("source_id").agg(share(F.lower(F.trim("name")).isin(*rules.NAV_TERMS)).alias("nav"), share(F.col("c") >= 2).alias("dup"), share(blank(F.col("name")) & blank(F.col("details"))).alias("emp"))
    return g.select("source_id", rules.ladder((F.col("nav") > 0.3, "garbage_nav"), (F.col("dup") > 0.5, "garbage_dupes"), (F.col("emp") > 0.7, "garbage_empty"), default="clean").alias("flag"), F.round("dup", 6).alias("dup"))


@q("F20_production_gate", f"with {DOCS} select source_id, count(*) filter (where length(name) < 2) as short, count(*) filter (where length(name) > 200) as long, count(*) filter (where regexp_matches(name, '<[a-zA-Z/!?][^>]*>')) as html, case when count(*) filter (where length(name) > 200) * 20 > count(*) then 'CRITICAL' else 'WARNING' end as severity from docs group by 1")
def f20(s, d):
    n = F.col("name")
    return docs(s, d).groupBy("source_id").agg(F.count_if(F.length(n) < 2).alias("short"), F.count_if(F.length(n) > 200).alias("long"), F.count_if(n.rlike("<[a-zA-Z/!?][^>]*>")).alias("html"), F.when(F.count_if(F.length(n) > 200) * 20 > F.count("*"), "CRITICAL").otherwise("WARNING").alias("severity"))


@q("F21_expected_counts", f"with {PARTS}, r as (select distinct p_brand as source_id, 60 + (length(p_brand) + ascii(substr(p_brand, 7, 1))) % 60 as expected from part union all select 'Brand#99', 10), c as (select source_id, count(*) as n from parts where source_id <> 'Brand#11' group by 1) select r.source_id, expected, n, case when n is null then 'CRITICAL' when n = 0 then 'CRITICAL' when n < 0.8 * expected then 'WARNING' when n > 2 * expected then 'INFO' else 'OK' end as finding from r left join c on c.source_id = r.source_id")
def f21(s, d):
    p = parts(s, d)
    r = p.select("source_id").distinct().withColumn("expected", 60 + (F.length("source_id") + F.ascii(F.substring("source_id", 7, 1))) % 60).union(s.createDataFrame([("Brand#99", 10)], "source_id string, expected int"))
    c = p.where("source_id <> 'Brand#11'").groupBy("source_id").agg(F.count("*").alias("n"))
    return r.join(c, "source_id", "left").withColumn("finding", rules.ladder((F.col("n").isNull(), "CRITICAL"), (F.col("n") == 0, "CRITICAL"), (F.col("n") < 0.8 * F.col("expected"), "WARNING"), (F.col("n") > 2 * F.col("expected"), "INFO"), default="OK"))


@q("F22_legacy_checks", f"with {PARTS} select count(*) filter (where name is null) as nulls, count(*) filter (where length(name) > 11) as long_names, count(*) filter (where size not between 1 and 50) as bad_sizes, count(distinct source_agency) as kinds from parts")
def f22(s, d):
    return parts(s, d).agg(F.count_if(F.col("name").isNull()).alias("nulls"), F.count_if(F.length("name") > 11).alias("long_names"), F.count_if(~F.col("size").between(1, 50)).alias("bad_sizes"), F.countDistinct("source_agency").alias("kinds"))


@q("F23_tracker_status", f"with {DOCS}, c as (select source_id, count(*) as n, max(length(trim(name))) >= 5 as real from docs where source_id <> 'src3' group by 1), r as (select distinct source_id, case when source_id = 'src1' then 'dead' when source_id = 'src2' then '' else 'active' end as status from docs) select r.source_id, case when status not in ('', 'active') then status when n is null then 'failed' when n < 3 or not real then 'partial' else 'completed' end as tracked from r left join c on r.source_id = c.source_id")
def f23(s, d):
    x = docs(s, d)
    c = x.where("source_id <> 'src3'").groupBy("source_id").agg(F.count("*").alias("n"), (F.max(F.length(F.trim("name"))) >= 5).alias("real"))
    r = x.select("source_id").distinct().withColumn("status", rules.ladder((F.col("source_id") == "src1", "dead"), (F.col("source_id") == "src2", ""), default="active"))
    got = rules.tracker_status(F.lit(True), F.lit(""), F.col("status"), F.col("n"), F.lit(False), F.lit(None).cast("int"), F.lit(""), F.coalesce("real", F.lit(False)))
    return r.join(c, "source_id", "left").select("source_id", got.alias("tracked"))


@q("F24_failure_reason", f"with {LOG} select id, case when source_id = 'error' and value < 50 then 'network_error' when source_id = 'error' then 'empty_page' when source_id = 'click' then 'js_shell' when source_id = 'view' then 'login_required' end as reason from log")
def f24(s, d):
    status = rules.ladder((F.col("source_id") == "error", "failed"), (F.col("source_id") == "click", "js"), (F.col("source_id") == "view", "restricted"), default="active")
    notes = F.when(F.col("value") < 50, "Connection Timeout").otherwise("garbage rows")
    return log(s, d).select("id", rules.failure_reason(status, notes).alias("reason"))


@q("F25_recovery_verdict", f"with {LOG} select id, case when id % 11 = 0 then 'error' when value < 20 then 'dead or restricted' when value < 40 then 'soft 404' when value < 60 then 'parse files' when value < 80 then 'parse table' else 'render' end as verdict from log")
def f25(s, d):
    v = F.col("value")
    got = rules.recovery(F.when(F.col("id") % 11 == 0, "timeout"), F.when(v < 20, 503).otherwise(200), F.when(v < 40, 100).otherwise(5000), (v < 60).cast("int"), F.when(v >= 60, F.when(v < 80, 5).otherwise(0)).otherwise(0), v >= 80, F.lit(False))
    return log(s, d).select("id", got.alias("verdict"))


STRATEGIES = ("table", "blocks", "raw_text", "PDF_OCR", "new_kind", "xlsx_attached")


@q("F26_confidence", "with x as (select p_partkey as id, ['table', 'blocks', 'raw_text', 'PDF_OCR', 'new_kind', 'xlsx_attached'][(p_partkey % 6 + 1)::int] as strategy from part) select id, case when lower(strategy) in ('table', 'xlsx_attached') then 'high' when lower(strategy) in ('raw_text', 'pdf_ocr') then 'low' else 'medium' end as by_strategy, case when lower(strategy) in ('raw_text', 'pdf_ocr') then 'low' when lower(strategy) = 'blocks' then 'medium' else 'high' end as by_kind from x")
def f26(s, d):
    kind = F.element_at(F.array(*[F.lit(x) for x in STRATEGIES]), (F.col("id") % 6 + 1).cast("int"))
    return parts(s, d).select("id", rules.strategy_confidence(kind).alias("by_strategy"), rules.link_confidence(kind).alias("by_kind"))


@q("F27_http_outcome", "with x as (select o_orderkey as id, [200, 301, 403, 404, 503, 418][(o_orderkey % 6 + 1)::int] as st, case when o_orderkey % 13 = 0 then 'ConnectTimeout' end as err from orders) select id, case when err is not null then 'CRIT' when st = 200 then 'OK' when st = 301 then 'INFO' when st in (404, 503) then 'CRIT' else 'WARN' end as severity, case when err is not null then 'HTTP_DOWN' when st = 200 then 'HTTP_OK' when st = 301 then 'HTTP_REDIRECT' when st = 403 then 'HTTP_BLOCKED' when st in (404, 503) then 'HTTP_DOWN' else 'HTTP_ERROR' end as code from x")
def f27(s, d):
    o = table(s, d, "orders").select(F.col("o_orderkey").alias("id"))
    st = F.element_at(F.array(*[F.lit(x) for x in (200, 301, 403, 404, 503, 418)]), (F.col("id") % 6 + 1).cast("int"))
    return o.withColumn("r", rules.http_outcome(F.when(F.col("id") % 13 == 0, "ConnectTimeout"), st)).select("id", "r.severity", "r.code")


@q("F28_better_result", f"with {LOG} select id, (id % 7) < 3 and (id % 11) > (id % 7) as second from log")
def f28(s, d):
    return log(s, d).select("id", rules.better_result(F.col("id") % 7, F.col("id") % 11).alias("second"))


@q("F29_needs_script", "select page_id, regexp_matches(lower(html), '<tbody[^>]*>\\s*</tbody>') or strpos(lower(html), 'id=\"root\"') > 0 or strpos(lower(html), 'id=\"app\"') > 0 or strpos(lower(html), '__next') > 0 or strpos(lower(html), 'ng-app') > 0 or strpos(lower(html), 'datatable') > 0 as script from pages")
def f29(s, d):
    return table(s, d, "pages").select("page_id", rules.needs_script(F.col("html")).alias("script"))


@q("S15_blocked_pages", f"with p as (select page_id, substr(lower({VISIBLE}), 1, 8000) as v from pages) select page_id, " + " or ".join(f"strpos(v, '{w}') > 0" for w in BLOCKED) + " as blocked from p")
def s15(s, d):
    return table(s, d, "pages").select("page_id", rules.blocked_page(X.visible_text(F.col("html"))).alias("blocked"))


# --- joins -------------------------------------------------------------------------------------
@q("J01_group_links", f"with {PARTS}, r as (select lower(trim(name)) as key, source_id, min(id) as id from parts where {INTERESTING} group by 1, 2), a as (select key, min(id) as id_a, arg_min(source_id, id) as source_a from r group by 1 having count(*) > 1) select key, id_a, id as id_b, source_a, source_id as source_b from r join a using (key) where source_id <> source_a")
def j01(s, d):
    return entities.links(parts(s, d))


@q("J02_semi", f"with {PARTS} select id, name from parts where name in (select name from parts group by 1 having count(distinct source_id) > 20)")
def j02(s, d):
    p = parts(s, d).select("id", "name", "source_id")
    return p.join(p.groupBy("name").agg(F.countDistinct("source_id").alias("k")).where("k > 20"), "name", "left_semi").select("id", "name")


@q("J03_anchor_join", f"with {PARTS}, a as (select name, min(id) as anchor from parts group by 1) select id, anchor from parts join a using (name)")
def j03(s, d):
    p = parts(s, d).select("id", "name")
    return p.join(p.groupBy("name").agg(F.min("id").alias("anchor")), "name").select("id", "anchor")


@q("J04_similarity_join", f"with {PARTS}, g as (select distinct lower(trim(name)) as key from parts), n as (select distinct lower(trim(name)) as t from parts), x as (select key, t, {GRAMS.format('key')} as a, {GRAMS.format('t')} as b from g, n) select key, t, round({JACCARD.format('a', 'b')}, 6) as sim from x where {JACCARD.format('a', 'b')} >= 0.4")
def j04(s, d):
    p = parts(s, d)
    g = p.select(X.group_key(F.col("name")).alias("query")).distinct().withColumn("q_id", F.col("query"))
    n = p.select(X.group_key(F.col("name")).alias("name")).distinct().withColumns({"id": F.lit(0), "source_id": F.lit("")})
    return screening.similar(g, n, 0.4).select(F.col("q_id").alias("key"), F.col("name").alias("t"), F.round("sim", 6).alias("sim"))


FUZZY = f"""with {PARTS}, g as (select lower(trim(name)) as key, list(distinct source_id) as src from parts group by 1), n as (select distinct lower(trim(name)) as t from parts where length(trim(name)) > 4),
x as (select key, t, {GRAMS.format("key")} as a, {GRAMS.format("t")} as b from g, n where key <> t), h as (select key, t, {JACCARD.format("a", "b")} as sim from x where {JACCARD.format("a", "b")} > 0.3),
m as (select h.key, p.id, p.source_id, h.sim from h join parts p on lower(trim(p.name)) = h.t join g using (key) where not list_contains(src, p.source_id))@M2@,
b as (select *, row_number() over (partition by key, source_id order by round(sim, 9) desc, id) as r from m2) select key, id, source_id, round(sim, 6) as sim from b where r = 1"""


@q("J05_fuzzy_top_per_group", FUZZY.replace("@M2@", ", m2 as (select * from (select *, row_number() over (partition by key order by round(sim, 9) desc, id) as place from m) where place <= 10)"))
def j05(s, d):
    p = parts(s, d)
    g = p.groupBy(X.group_key(F.col("name")).alias("key")).agg(F.collect_set("source_id").alias("sources"))
    return entities.fuzzy_links(g, p, 0.3, per_group=10).withColumn("sim", F.round("sim", 6))


@q("W02_best_fuzzy_per_source", FUZZY.replace("@M2@", ", m2 as (select * from m)"))
def w02(s, d):
    p = parts(s, d)
    g = p.groupBy(X.group_key(F.col("name")).alias("key")).agg(F.collect_set("source_id").alias("sources"))
    return entities.fuzzy_links(g, p, 0.3).withColumn("sim", F.round("sim", 6))


@q("J06_left_aggregate", f"with {PARTS}, a as (select source_id, count(distinct source_agency) as agencies from parts group by 1), l as (select distinct 'Brand#' || (o_orderkey % 60) as source_id from orders) select l.source_id, coalesce(agencies, 0) as agencies from l left join a using (source_id)")
def j06(s, d):
    """Sources that a list names, with what the records have of them; some have none."""
    listed = table(s, d, "orders").select(F.concat(F.lit("Brand#"), F.col("o_orderkey") % 60).alias("source_id")).distinct()
    a = parts(s, d).groupBy("source_id").agg(F.countDistinct("source_agency").alias("agencies"))
    return listed.join(a, "source_id", "left").select("source_id", F.coalesce("agencies", F.lit(0)).alias("agencies"))


@q("J07_exists_in_array", f"with {PARTS}, g as (select name, list(distinct source_id) as src from parts group by 1) select name, len(list_filter(src, lambda x: regexp_matches(x, '#[12][1-3]'))) > 0 as hit from g")
def j07(s, d):
    return parts(s, d).groupBy("name").agg(F.collect_set("source_id").alias("src")).select("name", F.exists("src", lambda x: x.rlike("#[12][1-3]")).alias("hit"))


@q("J10_neighbour_ratio", None)
def j10(s, d):
    """Python's sequence matcher has no SQL; the tests run it over all pairs."""
    p = parts(s, d).select(X.cross_source_key(F.col("name")).alias("key"), "id", "name", F.concat_ws(": ", "source_agency", "source_id").alias("source"))
    got = entities.neighbour_matches(p)
    return got.select("name_a", "name_b", F.round("ratio", 3).alias("similarity"), F.array_join("sources", " || ").alias("sources_combined"))


@q("W11_positional_neighbours", f"with {PARTS}, k as (select name, row_number() over (order by min(id), name) as pos from parts group by 1) select a.name as ka, b.name as kb from k a join k b on b.pos > a.pos and b.pos <= a.pos + 9")
def w11(s, d):
    keys = parts(s, d).groupBy(F.col("name").alias("key")).agg(F.min("id").alias("first"))
    return entities.positional_pairs(keys, 9).select("ka", "kb")


@q("J11_registry_lookup", f"with {PARTS}, r as (select distinct source_agency, source_id, lower(replace(source_id, '#', '_')) as sid from parts where source_id < 'Brand#4') select p.id, coalesce(sid, '') as sid from parts p left join r on p.source_agency = r.source_agency and p.source_id = r.source_id")
def j11(s, d):
    p = parts(s, d)
    r = p.where("source_id < 'Brand#4'").select("source_agency", "source_id").distinct().withColumn("sid", F.lower(F.replace("source_id", F.lit("#"), F.lit("_"))))
    return p.join(r, ["source_agency", "source_id"], "left").select("id", F.coalesce("sid", F.lit("")).alias("sid"))


@q("J12_dimension_lookup", f"with {PARTIES} select p.id, r_name as region from parties p join nation on n_name = address join region on n_regionkey = r_regionkey")
def j12(s, d):
    n, r = table(s, d, "nation"), table(s, d, "region")
    return parties(s, d).join(n, F.col("address") == F.col("n_name")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("id", F.col("r_name").alias("region"))


COUNTS = "pre as (select source_id, count(*) as n from parts where id % 3 <> 0 and source_id <> 'Brand#11' group by 1), post as (select source_id, count(*) as n from parts where id % 4 <> 0 and source_id <> 'Brand#12' group by 1)"


def _counts(s, d):
    p = parts(s, d).select("id", "source_id")
    pre = p.where("id % 3 <> 0 and source_id <> 'Brand#11'").groupBy("source_id").agg(F.count("*").alias("pre"))
    post = p.where("id % 4 <> 0 and source_id <> 'Brand#12'").groupBy("source_id").agg(F.count("*").alias("post"))
    return pre.join(post, "source_id", "full_outer")


@q("J13_count_diff", f"with {PARTS}, {COUNTS} select coalesce(pre.source_id, post.source_id) as source_id, pre.n as pre, post.n as post, case when pre.n is null then 'new' when post.n is null then 'zeroed' when post.n > pre.n then 'added' when post.n < pre.n then 'removed' else 'same' end as change from pre full join post on pre.source_id = post.source_id")
def j13(s, d):
    return _counts(s, d).withColumn("change", rules.ladder((F.col("pre").isNull(), "new"), (F.col("post").isNull(), "zeroed"), (F.col("post") > F.col("pre"), "added"), (F.col("post") < F.col("pre"), "removed"), default="same"))


@q("J15_missing_anti", f"with {PARTS}, {COUNTS} select source_id from pre where source_id not in (select source_id from post)")
def j15(s, d):
    p = parts(s, d).select("id", "source_id")
    return p.where("id % 3 <> 0 and source_id <> 'Brand#11'").select("source_id").distinct().join(p.where("id % 4 <> 0 and source_id <> 'Brand#12'").select("source_id"), "source_id", "left_anti")


@q("J16_not_yet_done", "select o_custkey as id, count(*) as n from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0) group by 1")
def j16(s, d):
    o, c = table(s, d, "orders"), table(s, d, "customer")
    return o.join(c.where("c_acctbal > 0"), o["o_custkey"] == c["c_custkey"], "left_anti").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"))


@q("J17_absent_months", "with m as (select distinct strftime(o_orderdate, '%Y-%m') as m from orders), e as (select distinct strftime(l_shipdate, '%Y-%m') as m from lineitem) select m from e where m not in (select m from m)")
def j17(s, d):
    month = lambda t, c: table(s, d, t).select(F.date_format(c, "yyyy-MM").alias("m")).distinct()
    return month("lineitem", "l_shipdate").join(month("orders", "o_orderdate"), "m", "left_anti")


NAMES = ("Customer#000000001", "00000012", "Customer#00000013", "nobody here")


def _queries(s):
    return s.createDataFrame([(i + 1, n) for i, n in enumerate(NAMES)], "q_id int, query string")


QSQL = "qs as (select * from (values " + ", ".join(f"({i + 1}, '{n}')" for i, n in enumerate(NAMES)) + ") v(q_id, query))"


@q("J18_cross_reference", f"with {ODI}, {QSQL}, m as (select q_id, o.*, row_number() over (partition by q_id order by total desc nulls last, id) as k from qs join odi o on o.indian_party ilike '%' || query || '%'), t as (select * from m where k <= 50) select q_id, count(*) as n, sum(total)::double as total, array_to_string(list_sort(list(distinct country)), ',') as countries from t group by 1")
def j18(s, d):
    odi = investments(s, d)
    j = odi.join(screening.containing(_queries(s), odi.select(F.col("indian_party").alias("name"))), odi["indian_party"] == F.col("name"))
    w = Window.partitionBy("q_id").orderBy(F.desc_nulls_last("total"), "id")
    return j.withColumn("k", F.row_number().over(w)).where("k <= 50").groupBy("q_id").agg(F.count("*").alias("n"), F.sum("total").cast("double").alias("total"), joined(F.array_sort(F.collect_set("country"))).alias("countries"))


@q("J19_jurisdiction_flag", f"with {PARTS}, m as (select name, id, case when source_id like '%1' then 'black' when source_id like '%2' then 'grey' end as flag from parts) select name, arg_min(flag, id) filter (where flag is not null) as flag from m group by 1")
def j19(s, d):
    flag = rules.ladder((F.col("source_id").endswith("1"), "black"), (F.col("source_id").endswith("2"), "grey"))
    return parts(s, d).withColumn("flag", flag).groupBy("name").agg(F.min_by("flag", F.when(F.col("flag").isNotNull(), F.col("id"))).alias("flag"))


SCREEN = f"""with {PARTIES}, {QSQL}, x as (select q_id, query, id, name, source_id, {GRAMS.format("query")} as a, {GRAMS.format("name")} as b from qs, parties),
y as (select *, {JACCARD.format("a", "b")} as sim from x), t as (select q_id, query, id, name, source_id, case when lower(name) = lower(query) then 1 when strpos(lower(name), lower(query)) > 0 then 2 when sim >= 0.6 then 3 end as tier, case when lower(name) = lower(query) then 1.0 else sim end as sim from y),
r as (select *, row_number() over (partition by q_id order by tier, round(sim, 6) desc, length(name), id) as k from t where tier is not null)"""


@q("J20_bulk_screening", SCREEN + " select q_id, id, name, source_id, tier::int as tier, round(sim, 6) as sim, k::int as rank from r where k <= 10")
def j20(s, d):
    return screening.screen(_queries(s), parties(s, d), 0.6).withColumn("sim", F.round("sim", 6))


CHANGED = SCREEN.replace("parties as (", "base as (", 1).replace("qs as (", "parties as (select id, case when id % 5 = 0 then name || ' Ltd' else name end as name, source_id from base where id % 7 <> 0), qs as (", 1)


@q("J20_indexed_screening", CHANGED + " select q_id, id, name, source_id, tier::int as tier, round(sim, 6) as sim, k::int as rank from r where k <= 10")
def j20_index(s, d):
    """From the stored index, after a change that replaces a fifth of the names and removes a seventh."""
    p = parties(s, d).select("id", "name", "source_id")
    index = GramIndex(s)
    index.change(p)
    index.change(p.where("id % 5 = 0 and id % 7 <> 0").withColumn("name", F.concat("name", F.lit(" Ltd"))), p.where("id % 7 = 0").select("id"))
    return index.screen(_queries(s), 0.6).withColumn("sim", F.round("sim", 6))


@q("O03_screening_levels", SCREEN + ", m as (select q_id, count(*) as matches from r where k <= 10 group by 1) select q.q_id, query, coalesce(matches, 0) as matches, case when matches > 0 then 'LOW' else 'CLEAR' end as level from qs q left join m on m.q_id = q.q_id")
def o03(s, d):
    got = screening.report(_queries(s), screening.screen(_queries(s), parties(s, d), 0.6), s.createDataFrame([], "q_id int, hits long"))
    return got.select("q_id", "query", "matches", "level")


@q("O02_similarity_order", f"with {PARTS}, n as (select distinct name from parts), x as (select name, {GRAMS.format('name')} as a, {GRAMS.format(chr(39) + 'red wdget' + chr(39))} as b from n) select name, round({JACCARD.format('a', 'b')}, 4) as sim, row_number() over (order by round({JACCARD.format('a', 'b')}, 6) desc, length(name), name)::int as k from x where {JACCARD.format('a', 'b')} >= 0.3")
def o02(s, d):
    n = parts(s, d).select("name").distinct().withColumn("sim", Y.similarity(F.col("name"), F.lit("red wdget"))).where("sim >= 0.3")
    ordered = numbered(n, F.desc(F.round("sim", 6)), F.length("name"), F.col("name"), name="k")
    return ordered.select("name", F.round("sim", 4).alias("sim"), F.col("k").cast("int").alias("k"))


@q("J22_period_fix", f"with {ODI}, f as (select activity, max(substr(period_from, 7, 4)) as y from odi group by 1), o as (select id, activity, substr(period_from, 7, 4) as y from odi) select o.id, o.y as old, f.y as new from o join f using (activity) where o.y <> f.y")
def j22(s, d):
    o = investments(s, d).select("id", "activity", F.substring("period_from", 7, 4).alias("old"))
    f = o.groupBy("activity").agg(F.max("old").alias("new"))
    return o.join(f, "activity").where("old <> new").select("id", "old", "new")


@q("J23_cooldown", f"with {LOG}, last as (select user_id, max(scraped_at) as t from log where source_id = 'error' group by 1), a as (select user_id, min(id) as id, max(scraped_at) as now from log group by 1) select a.user_id, a.id, t is not null and a.now - t < interval 24 hours as held from a left join last using (user_id)")
def j23(s, d):
    x = log(s, d)
    last = x.where("source_id = 'error'").groupBy("user_id").agg(F.max("scraped_at").alias("t"))
    a = x.groupBy("user_id").agg(F.min("id").alias("id"), F.max("scraped_at").alias("now"))
    held = F.col("t").isNotNull() & (F.col("now") < F.col("t") + F.expr("interval 24 hours"))
    return a.join(last, "user_id", "left").select("user_id", "id", F.coalesce(held, F.lit(False)).alias("held"))


# --- entity resolution -------------------------------------------------------------------------
@q("J09_blocked_pairs", f"with {PARTS}, k as (select lower(name) as key, min(id) as id from parts group by 1), b as (select distinct id, substr(w, 1, 3) as blk from (select id, unnest(string_split(key, ' ')) as w from k) where length(w) >= 3) select distinct x.id as a, y.id as b from b x join b y using (blk) where x.id < y.id")
def j09(s, d):
    k = parts(s, d).groupBy(F.lower("name").alias("key")).agg(F.min("id").alias("id"))
    return entities.blocked_pairs(k.select("id", F.split("key", " ").alias("bag")))


EDGES = f"""{PARTS}, k as (select lower(name) as key, min(id) as id from parts group by 1), b as (select distinct id, key, substr(w, 1, 3) as blk from (select id, key, unnest(string_split(key, ' ')) as w from k) where length(w) >= 3),
p as (select distinct x.id as a, y.id as b, x.key as ka, y.key as kb from b x join b y using (blk) where x.id < y.id), g as (select a, b, {TEXT_GRAMS.format("ka")} as ga, {TEXT_GRAMS.format("kb")} as gb from p), e as (select a, b, {JACCARD.format("ga", "gb")} as score from g where {JACCARD.format("ga", "gb")} >= 0.6)"""


def _edges(s, d):
    n = parts(s, d)
    return entities.matches(n, 0.6)


@q("Y03_match_edges", f"with {EDGES} select a, b, round(score, 3) as score from e")
def y03(s, d):
    return _edges(s, d).select("a", "b", "score")


@q("J21_clusters", f"with recursive {EDGES}, two as (select a, b from e union all select b, a from e), r(x, y) as (select a, a from two union select r.x, two.b from r join two on r.y = two.a) select x as node, min(y) as label from r group by 1")
def j21(s, d):
    return entities.closure(_edges(s, d))


@q("A23_cluster_distribution", f"with recursive {EDGES}, two as (select a, b from e union all select b, a from e), r(x, y) as (select a, a from two union select r.x, two.b from r join two on r.y = two.a), c as (select x, min(y) as label from r group by 1), z as (select label, count(*) as size from c group by 1) select size, count(*) as clusters from z group by 1")
def a23(s, d):
    return entities.closure(_edges(s, d)).groupBy("label").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("clusters"))


# --- rules -------------------------------------------------------------------------------------
SOURCES = ("opensanctions_peps", "us_ofac_sdn", "sebi_orders", "fatf_greylist", "fatf_blacklist", "adb_debarred", "icij_papers", "interpol_red", "city_list", "opensanctions_eu")


def _sid(c):
    return F.element_at(F.array(*[F.lit(x) for x in SOURCES]), (c % 10 + 1).cast("int"))


SID = "[" + ", ".join(f"'{x}'" for x in SOURCES) + "][({0} % 10 + 1)::int]"
CATEGORY = "case when sid = 'opensanctions_peps' then 'pep' when sid like 'fatf%' then 'jurisdiction_risk' when sid = 'interpol_red' then 'criminal' when sid = 'icij_papers' then 'leak' when sid in ('us_ofac_sdn', 'opensanctions_eu') then 'sanctions' when sid = 'sebi_orders' then 'enforcement' when sid = 'adb_debarred' then 'debarment' else 'informational' end"


@q("R01_category", f"with x as (select p_partkey as id, {SID.format('p_partkey')} as sid from part) select id, sid, {CATEGORY} as category from x")
def r01(s, d):
    return parts(s, d).select("id", _sid(F.col("id")).alias("sid")).withColumn("category", rules.category(F.col("sid")))


LEVEL = "case when sid in ('us_ofac_sdn', 'opensanctions_eu', 'fatf_blacklist', 'interpol_red') then 'HIGH' when sid = 'city_list' then 'LOW' else 'MEDIUM' end"


@q("R02_level", f"with x as (select p_partkey as id, {SID.format('p_partkey')} as sid from part) select id, {LEVEL} as level from x")
def r02(s, d):
    return parts(s, d).select("id", rules.level(_sid(F.col("id"))).alias("level"))


@q("R03_overall", f"with x as (select p_brand || '/' || p_size as g, {SID.format('p_partkey')} as sid from part), l as (select g, list(distinct {LEVEL}) as ls from x group by 1) select g, case when list_contains(ls, 'HIGH') then 'HIGH' when list_contains(ls, 'MEDIUM') then 'MEDIUM' else 'LOW' end as level from l")
def r03(s, d):
    g = parts(s, d).groupBy(F.concat_ws("/", "source_id", "size").alias("g")).agg(F.collect_set(rules.level(_sid(F.col("id")))).alias("ls"))
    return g.select("g", rules.overall(F.col("ls"), F.lit(True), F.lit(False)).alias("level"))


AGENCIES = ("CBI", "SEBI", "RBI", "BSE")


@q("R04_verdict", "with x as (select p_name || '/' || p_size as name, ['CBI', 'SEBI', 'RBI', 'BSE'][(p_partkey % 4 + 1)::int] as agency, p_brand as lst from part), g as (select name, count(*) as hits, count(distinct agency) as k, bool_or(agency = 'CBI') as crit from x group by 1) select name, case when crit or k >= 4 then 'CRITICAL' when k >= 2 then 'HIGH' when hits >= 2 then 'MEDIUM' else 'LOW' end as verdict from g")
def r04(s, d):
    agency = F.element_at(F.array(*[F.lit(x) for x in AGENCIES]), (F.col("id") % 4 + 1).cast("int"))
    g = parts(s, d).groupBy(F.concat_ws("/", "name", "size").alias("name")).agg(F.collect_set(agency).alias("a"), F.collect_set("source_id").alias("l"), F.count("*").alias("hits"))
    return g.select("name", rules.verdict(F.col("a"), F.col("l"), F.col("hits")).alias("verdict"))


@q("R05_group_risk", f"with x as (select p_name as name, {SID.format('p_partkey')} as sid from part), g as (select name, list_filter(list(distinct sid), lambda v: regexp_matches(v, '(?i){HIGH}')) as hi, list_filter(list(distinct sid), lambda v: regexp_matches(v, '(?i){MEDIUM}')) as me from x group by 1) select name, case when len(hi) > 0 then 'HIGH' when len(me) > 0 then 'MEDIUM' else 'LOW' end as level, array_to_string(list_sort(case when len(hi) > 0 then hi else me end), ',') as signals from g")
def r05(s, d):
    g = parts(s, d).groupBy("name").agg(F.collect_set(_sid(F.col("id"))).alias("v")).withColumn("r", rules.group_risk(F.col("v")))
    return g.select("name", "r.level", joined(F.array_sort("r.signals")).alias("signals"))


@q("R06_cluster_score", "with x as (select p_name as name, ['CBI', 'SEBI', 'RBI', 'Bank of X', 'Interpol'][(p_partkey % 5 + 1)::int] as agency from part), g as (select distinct name, agency from x) select name, least(100, sum(case agency when 'CBI' then 30 when 'SEBI' then 20 when 'Bank of X' then 15 when 'Interpol' then 30 else 10 end))::int as score from g group by 1")
def r06(s, d):
    agency = F.element_at(F.array(*[F.lit(x) for x in ("CBI", "SEBI", "RBI", "Bank of X", "Interpol")]), (F.col("id") % 5 + 1).cast("int"))
    return parts(s, d).groupBy("name").agg(F.collect_set(agency).alias("a")).select("name", rules.cluster_score(F.col("a")).alias("score"))


@q("R07_company_risk", "with x as (select o_orderkey as id, o_orderstatus = 'F' and o_orderkey % 3 = 0 as def, o_orderkey % 7 = 0 as dor, o_orderkey % 5 = 0 as inact from orders) select id, case when def then 'HIGH' when dor or inact then 'MEDIUM' else 'LOW' end as level, concat_ws(',', case when def then 'DEFAULTER' end, case when dor then 'DORMANT' end, case when inact then 'INACTIVE' end) as flags from x")
def r07(s, d):
    o = table(s, d, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    yes = lambda c: F.when(c, " Yes ").otherwise("no")
    r = rules.company_risk(yes((F.col("o_orderstatus") == "F") & (F.col("id") % 3 == 0)), F.lit(None).cast("string"), yes(F.col("id") % 7 == 0), F.when(F.col("id") % 5 == 0, "Struck Off").otherwise("Active"))
    return o.select("id", r.alias("r")).select("id", "r.level", joined(F.col("r.flags")).alias("flags"))


DAYS = f"{LOG}, s as (select source_id, strftime(scraped_at, '%Y-%m-%d') as day, count(*) as n, max(scraped_at) as last from log where not (source_id = 'click' and day(scraped_at) = 20) group by 1, 2)"


@q("R08_source_health", f"with {DAYS}, c as (select * from s where day = '2024-01-21'), p as (select * from s where day = '2024-01-20') select c.source_id, case when p.n is null then 'NEW' when p.n > 0 and c.n < p.n and (p.n - c.n) * 100.0 / p.n > 50 then 'ANOMALY' when date_diff('day', c.last::date, date '2024-01-27') > 7 then 'STALE' else 'OK' end as status from c left join p on c.source_id = p.source_id")
def r08(s, d):
    x = log(s, d).withColumn("day", F.date_format("scraped_at", "yyyy-MM-dd")).where("not (source_id = 'click' and day = '2024-01-20')")
    g = x.groupBy("source_id", "day").agg(F.count("*").alias("n"), F.max("scraped_at").alias("last"))
    c, p = g.where("day = '2024-01-21'"), g.where("day = '2024-01-20'").select("source_id", F.col("n").alias("before"))
    return c.join(p, "source_id", "left").select("source_id", rules.source_health(F.col("before").isNotNull(), F.col("before"), F.col("n"), V.age_days(F.col("last"), "2024-01-27")).alias("status"))


@q("R09_count_alerts", f"with {PARTS}, {COUNTS}, x as (select coalesce(pre.source_id, post.source_id) as source_id, pre.n as b, post.n as a from pre full join post on pre.source_id = post.source_id), y as (select *, case when a is null and b > 0 then 'MISSING_FROM_SNAPSHOT' when b > 0 and a = 0 then 'DATA_ZEROED' when a < b then 'DATA_REMOVED' when a > 0 and a < 50 then 'BELOW_MIN_RECORDS' when a > b then 'DATA_ADDED' end as type from x) select source_id, type, case when type = 'DATA_REMOVED' and (b - a) * 100 / b >= 50 then 'CRIT' when type = 'DATA_ADDED' then 'INFO' else 'WARN' end as severity from y where type is not null")
def r09(s, d):
    r = _counts(s, d).withColumn("r", rules.count_alert(F.col("pre"), F.col("post"), F.lit(50)))
    return r.select("source_id", "r.type", "r.severity").where("type is not null")


#: Alerts around each event: kind, source and its status, and the action that must come out where age and history allow.
ALERTS = (
    ("CONTENT_CHANGED", "rbi_list", "active", "rescrape_content"), ("DATA_ZEROED", "rbi_list", None, "rollback_zeroed"), ("LAYOUT_CHANGED", "sebi_list", "active", "rescrape_layout"),
    ("CONTENT_CHANGED", "sebi_list", "dead_url", None), ("DATA_ZEROED", "mca_dump", "active", None), ("CONTENT_CHANGED", "boi_wilful_defaulters", "active", None),
    ("STALE", "ofac_list", "active", "rescrape_stale"), ("STALE", "opensanctions_peps", "active", None), ("BULK_STALE", "opensanctions_peps", "active", "redownload_bulk"),
    ("HTTP_BLOCKED", "nia_list", "active", "playwright_fallback"), ("HTTP_OK", "nia_list", "active", "rescrape_recovery"), ("HTTP_DOWN", "nia_list", "active", None), ("VERY_STALE", "ofac_list", "active", None), ("HTTP_OK", "fatf_list", "duplicate", None),
)
HISTORY = ("HTTP_OK", "HTTP_DOWN", "HTTP_BLOCKED", None)


def _alert_sql() -> str:
    def listed(values) -> str:
        return "[" + ", ".join("null" if v is None else f"'{v}'" for v in values) + "]"

    k, h = f"(id % {len(ALERTS)} + 1)::int", "(id // 3 % 4 + 1)::int"
    x = f"x as (select user_id, id, value, {listed(a[0] for a in ALERTS)}[{k}] as kind, {listed(a[1] for a in ALERTS)}[{k}] as sid, {listed(a[3] for a in ALERTS)}[{k}] as due, {listed(HISTORY)}[{h}] as was from log)"
    return f"with {LOG}, {x}, y as (select user_id, sid, id, case when due = 'rescrape_stale' and value < 7 then null when due = 'playwright_fallback' and was is distinct from 'HTTP_OK' then null when due = 'rescrape_recovery' and (was is null or was = 'HTTP_OK') then null else due end as action from x)"


def _actions(s, d):
    x = log(s, d).select("user_id", "id", "value", pick(F.col("id"), *[a[0] for a in ALERTS]).alias("kind"), pick(F.col("id"), *[a[1] for a in ALERTS]).alias("sid"), pick(F.col("id"), *[a[2] for a in ALERTS]).alias("status"), pick(F.floor(F.col("id") / 3), *HISTORY).alias("was"))
    return x.select("user_id", "sid", "id", rules.healing_action(F.col("sid"), F.col("kind"), F.col("value"), F.col("was"), F.col("status")).alias("action"))


ACTIONS = ("rollback_zeroed", "rescrape_content", "rescrape_layout", "rescrape_recovery", "redownload_bulk", "rescrape_stale", "playwright_fallback")


@q("R10_alert_actions", _alert_sql() + " select id, sid, action from y")
def r10_all(s, d):
    return _actions(s, d).select("id", "sid", "action")


@q("R10_healing_actions", _alert_sql() + f", z as (select *, row_number() over (partition by user_id, sid order by list_position({list(ACTIONS)}, action), id) as r from y where action is not null) select user_id, sid, id, action from z where r = 1")
def r10(s, d):
    return rules.one_action(_actions(s, d), "user_id", "sid")


@q("O09_priority_cap", _alert_sql() + f" select id, sid, action from y where action is not null order by list_position({list(ACTIONS)}, action), id limit 10")
def o09(s, d):
    return rules.first_actions(_actions(s, d), 10).select("id", "sid", "action")


@q("R11_change_labels", f"with {PARTS}, {COUNTS} select pre.source_id, concat_ws(',', case when pre.n > post.n then 'removed' end, case when (pre.n - post.n) / pre.n > 0.1 then 'large_drop' end) as labels from pre join post on pre.source_id = post.source_id")
def r11(s, d):
    c = _counts(s, d).where("pre is not null and post is not null")
    return c.select("source_id", joined(rules.change_label(F.lit("RBI"), F.greatest(F.col("post") - F.col("pre"), F.lit(0)), F.greatest(F.col("pre") - F.col("post"), F.lit(0)), F.col("pre"), F.col("post"))).alias("labels"))


@q("R12_suggestions", f"with {LOG} select id, case when source_id = 'error' and id % 2 = 0 then 'source moved or blocked' when source_id = 'error' then 'verify source and output' when source_id = 'view' then 'confirm the schedule' else 'review the log' end as todo from log")
def r12(s, d):
    status = rules.ladder((F.col("source_id") == "error", "BROKEN"), (F.col("source_id") == "view", "STALE"), default="NEW")
    return log(s, d).select("id", rules.suggestion(status, F.when(F.col("id") % 2 == 0, "row DROP").otherwise("x")).alias("todo"))


# --- similarity --------------------------------------------------------------------------------
@q("Y01_word_trigrams", f"with {PARTS}, n as (select distinct name from parts), x as (select name, {GRAMS.format('name')} as a, {GRAMS.format(chr(39) + 'Blue Widgets' + chr(39))} as b from n) select name, round({JACCARD.format('a', 'b')}, 6) as sim from x")
def y01(s, d):
    return parts(s, d).select("name").distinct().select("name", F.round(Y.similarity(F.col("name"), F.lit("Blue Widgets")), 6).alias("sim"))


@q("Y04_sequence_ratio", None)
def y04(s, d):
    return parts(s, d).select("name").distinct().select("name", F.round(Y.sequence_ratio(F.col("name"), F.lit("blue widget")), 6).alias("ratio"))


@q("Y05_cosine_top", "with v as (select vec_id, embedding::double[] as e from embeddings), q as (select vec_id as qid, e as qe from v where vec_id % 50 = 0), x as (select qid, vec_id, list_cosine_similarity(qe, e) as c from q, v where vec_id <> qid), r as (select *, row_number() over (partition by qid order by round(c, 9) desc, vec_id) as k from x) select qid, vec_id, round(c, 6) as c from r where k <= 3")
def y05(s, d):
    v = table(s, d, "embeddings").select("vec_id", "embedding")
    found = nearest(v, v.where("vec_id % 50 = 0"), 3)
    return found.select(F.col("query_id").alias("qid"), "vec_id", F.round("cosine", 6).alias("c"))
