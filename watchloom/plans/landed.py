"""Readers, writers, change capture and streams (S*, K*, T*, E*): tables are landed as files first, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import values as V
from ..operators import crawl, rules
from ..shared import shared_dir
from ..sources import configured, files, grammars, sinks
from ..sources import dump_labels as DL
from ..sources import json_array as J
from ..streaming import changes as C
from ..streaming import freshness, snapshots
from .views import LISTED, DOCS, LOG, ODI, PARTIES, PARTS, SNAPS, docs, investments, log, parties, parts, snapshot, table, listed

QUERIES: dict = {}


def q(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = (f, sql)
        return f

    return put


def landing(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}"


def _canonical(df: DataFrame) -> DataFrame:
    return files.canonical(df, source_agency=F.col("source_id"), source_list=F.col("source_id"))


@q("S01_canonical_scan", f"with {PARTIES} select name, address, source_id as source_list from parties where source_id <> 'none'")
def s01(s, d):
    at = landing(s)
    sinks.write_canonical(_canonical(parties(s, d)), f"{at}/good")
    parties(s, d).limit(5).coalesce(1).write.option("header", True).csv(f"{at}/bad")
    return files.read_canonical(s, f"{at}/*")[0].select("name", "address", "source_list")


@q("S02_source_files", f"with {PARTIES} select source_id, count(*) as n from parties group by 1")
def s02(s, d):
    at = landing(s)
    _canonical(parties(s, d)).withColumn("sid", F.col("source_list")).write.partitionBy("sid").option("header", True).csv(f"{at}/src")
    t = s.read.option("header", True).option("pathGlobFilter", "*.csv").csv(f"{at}/src").select("sid", F.col("_metadata.file_path").alias("file"))
    return t.where(~F.col("file").contains("master")).groupBy(F.col("sid").alias("source_id")).agg(F.count("*").alias("n"))


@q("S03_delimited_scan", f"with {PARTS} select id::varchar as id, name from parts")
def s03(s, d):
    at = landing(s)
    parts(s, d).select("id", "name").write.option("sep", "\t").csv(at)
    return files.read_delimited(s, at, header=False).select(F.col("0").alias("id"), F.col("1").alias("name"))


@q("S04_mislabelled_sheet", f"select n_nationkey::varchar as k, n_name as name from {LISTED}")
def s04(s, d):
    at = landing(s)
    listed(s, d).select(F.concat_ws("\t", F.col("n_nationkey").cast("string"), "n_name").alias("value")).coalesce(1).write.text(at)
    return files.read_as(s, "xls", f"{at}/*.txt").select(F.get("cells", 0).alias("k"), F.get("cells", 1).alias("name"))


@q("S05_xml_scan", f"select n_nationkey::bigint as k, n_name as name from {LISTED}")
def s05(s, d):
    at = landing(s)
    listed(s, d).select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("name")).write.format("xml").option("rootTag", "list").option("rowTag", "entry").save(at)
    return files.read_xml(s, at, "entry", "k long, name string")


@q("S06_json_path_scan", f"select n_name as name, n_regionkey::int as region from {LISTED}")
def s06(s, d):
    at = landing(s)
    n = listed(s, d).agg(F.to_json(F.struct(F.struct(F.collect_list(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))).alias("items")).alias("data"))).alias("value"))
    n.coalesce(1).write.text(at)
    r = files.read_json_records(s, at, "$.data.items")
    return r.select(V.json_path(F.col("record"), "$.name").alias("name"), V.json_path(F.col("record"), "$.region").cast("int").alias("region"))


@q("S08_api_records", f"with {LOG} select id, json_extract_string(props, '$.k')::int as k from log")
def s08(s, d):
    parsed = F.from_json("props", "k int")
    return log(s, d).select("id", parsed["k"].alias("k"))


def _table_pages(s, d) -> DataFrame:
    n = listed(s, d)
    row = F.concat(F.lit("<tr><td><a href='/n/"), F.col("n_nationkey").cast("string"), F.lit("'>"), F.col("n_name"), F.lit("</a></td><td>"), F.col("n_nationkey").cast("string"), F.lit("</td></tr>"))
    g = n.groupBy(F.col("n_regionkey").cast("long").alias("page_id")).agg(F.array_join(F.array_sort(F.collect_list(row)), "").alias("rows"))
    return g.select("page_id", F.concat(F.lit("<p>x</p><table><tr><td>small</td></tr></table><table><tr><th>Name</th><th>Key</th></tr>"), "rows", F.lit("</table>")).alias("html"))


@q("S10_html_tables", f"select n_regionkey::bigint as page_id, n_name as name, n_nationkey::varchar as key, '/n/' || n_nationkey as href from {LISTED}")
def s10(s, d):
    t = files.html_tables(_table_pages(s, d))
    return t.select("page_id", F.element_at("cells", "Name").alias("name"), F.element_at("cells", "1").alias("key"), F.element_at("cells", "_href").alias("href"))


@q("S20_required_headers", f"select n_regionkey::bigint as page_id, count(*) as n from {LISTED} group by 1")
def s20(s, d):
    t = files.html_tables(_table_pages(s, d)).where(F.forall(F.array(F.lit("Name"), F.lit("Key")), lambda k: F.array_contains(F.map_keys("cells"), k)))
    return t.groupBy("page_id").agg(F.count("*").alias("n"))


@q("S12_page_cascade", None)
def s12(s, d):
    return files.page_records(table(s, d, "pages").select("page_id", "html")).groupBy("strategy").agg(F.countDistinct("page_id").alias("pages"), F.count("*").alias("records"))


HEADS = ("Name of Person", "Father's Name", "Date of Birth", "Sex", "City", "Fine", "Case No", "PDF", "Misc")
FIELDS = ("name", "father_name", "date_of_birth", "gender", "address", "reward_amount", "case_unit", "document_url", None)


@q("S13_header_fields", "select * from (values " + ", ".join(f"({i}, '{h.replace(chr(39), chr(39) * 2)}', " + (f"'{f}')" if f else "null)") for i, (h, f) in enumerate(zip(HEADS, FIELDS, strict=True))) + ") v(i, header, field)")
def s13(s, d):
    h = s.createDataFrame([(i, h) for i, h in enumerate(HEADS)], "i int, header string")
    named = F.lower("header").rlike("name of") & (F.col("i") == 0)
    later = rules.ladder(*[(rules.has_any(F.lower("header"), words), field) for field, words in rules.HEADERS[1:]])
    return h.select("i", "header", F.when(named, "name").otherwise(later).alias("field"))


@q("S14_page_links", "with l as (select page_id, list_filter(regexp_extract_all(html, '(?i)href=[\"'']([^\"''#]+)[\"'']', 1), lambda u: not starts_with(lower(u), 'javascript:')) as u from pages) select page_id, list_filter(u, lambda x: regexp_matches(lower(x), '\\.pdf($|\\?)'))[1] as document_url, list_filter(u, lambda x: not regexp_matches(lower(x), '\\.pdf($|\\?)'))[1] as detail_page_url from l")
def s14(s, d):
    return files.page_links(table(s, d, "pages"))


@q("S16_merged_tables", "with c as (select conv_id, turn, role, case when lag(role) over w is distinct from role then 1 else 0 end as n from conversations window w as (partition by conv_id order by turn)) select conv_id, turn, sum(n) over (partition by conv_id order by turn)::bigint as table_no from c")
def s16(s, d):
    return files.merged_tables(table(s, d, "conversations"), "conv_id", "turn", "role").select("conv_id", "turn", "table_no")


@q("S17_text_lines", "with l as (select doc_id, unnest(string_split(text, chr(10))) as line from documents) select doc_id, count(*) as n from (select doc_id, trim(regexp_replace(line, '^\\d+[.)]\\s*', '')) as line from l) where line <> '' group by 1 having count(*) >= 3")
def s17(s, d):
    t = table(s, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return t.withColumn("line", F.trim(F.regexp_replace("line", r"^\d+[.)]\s*", ""))).where("line <> ''").groupBy("doc_id").agg(F.count("*").alias("n")).where("n >= 3")


@q("S18_attachments", "with l as (select distinct unnest(regexp_extract_all(html, '(?i)href=[\"'']([^\"''#]+)[\"'']', 1)) as u from pages) select u as file_url from l")
def s18(s, d):
    return table(s, d, "pages").select(F.explode(F.regexp_extract_all("html", F.lit(r"""(?i)href=["']([^"'#]+)["']"""), F.lit(1))).alias("file_url")).dropDuplicates(["file_url"])


@q("S19_attachment_dedupe", f"with {PARTS} select lower(name) as name, lower(source_agency) as agency, min(id) as id from parts group by 1, 2")
def s19(s, d):
    return parts(s, d).groupBy(F.lower("name").alias("name"), F.lower("source_agency").alias("agency")).agg(F.min("id").alias("id"))


@q("S21_row_fallback", f"with {LOG} select id, coalesce(json_extract_string(props, '$.k'), source_id) as name from log")
def s21(s, d):
    m = F.transform_keys(F.from_json("props", "map<string,string>"), lambda k, v: F.lower(k))
    return log(s, d).select("id", F.coalesce(F.element_at(m, "k"), F.col("source_id")).alias("name"))


def _label(labels: list[str]) -> str:
    return "case doc_id % {} {} end".format(len(labels), " ".join(f"when {i} then '{x}'" for i, x in enumerate(labels)))


#: What the landed dumps of ``documents`` carry: a label by id, and the first line under one of three keys or none.
COMPANY_DUMP = [*DL.COMPANY_LABELS, "Some Other List"]
NEGATIVE_DUMP = [*DL.NEGATIVE_LABELS, *DL.NEGATIVE_SKIPPED, "Some Other List", "Another List"]
FIRST_LINE = "trim(string_split(coalesce(text, ''), chr(10))[1])"


def _dump(s, d, labels: list[str]) -> str:
    """All documents as JSON arrays, a file a partition."""
    at = landing(s)
    line = F.element_at(F.split("text", "\n"), 1)
    t = table(s, d, "documents").select(
        F.col("doc_id").cast("string").alias("_id"), F.element_at(F.array(*[F.lit(x) for x in labels]), (F.col("doc_id") % len(labels) + 1).cast("int")).alias("source"),
        F.when(F.col("doc_id") % 4 == 0, line).alias("name"), F.when(F.col("doc_id") % 4 == 1, line).alias("defaulterName"), F.when(F.col("doc_id") % 4 == 2, line).alias("companyName"), F.struct(F.col("text").alias("value")).alias("raw"),
    )
    J.write_json_array(t, at)
    return at


@q("S22_routed_records", f"with d as (select doc_id, {_label(COMPANY_DUMP)} as label, case when doc_id % 4 <> 3 then {FIRST_LINE} else '' end as name from documents), r as (select * from (values {', '.join(f'({chr(39)}{k}{chr(39)}, {chr(39)}{v}{chr(39)})' for k, (v, _) in DL.COMPANY_LABELS.items())}) v(label, target)) select doc_id, target, name from d join r using (label) where name <> ''")
def s22(s, d):
    routes = s.createDataFrame([(k, v) for k, (v, _) in DL.COMPANY_LABELS.items()], "label string, target string")
    found, _ = J.route_records(J.read_json_array(s, _dump(s, d, COMPANY_DUMP)), routes, names=("name", "defaulterName", "companyName"))
    return found.select(J.written("_id").cast("long").alias("doc_id"), "target", "name")


@q("S23_label_outcomes", f"with d as (select {_label(NEGATIVE_DUMP)} as label, case when doc_id % 4 = 0 then {FIRST_LINE} else '' end as name from documents) select label, case when label in ({', '.join(f'{chr(39)}{x}{chr(39)}' for x in DL.NEGATIVE_SKIPPED)}) then 'skipped' when label in ('Some Other List', 'Another List') then 'unrouted' when name = '' then 'nameless' else 'routed' end as outcome, count(*) as n from d group by 1, 2")
def s23(s, d):
    routes = s.createDataFrame([(k, *v) for k, v in DL.NEGATIVE_LABELS.items()], "label string, target string, agency string")
    return J.label_outcomes(J.read_json_array(s, _dump(s, d, NEGATIVE_DUMP)), routes, DL.NEGATIVE_SKIPPED)


@q("S23_unmapped_labels", f"select {_label(NEGATIVE_DUMP)} as label, count(*) as n from documents where {_label(NEGATIVE_DUMP)} in ('Some Other List', 'Another List') group by 1")
def s23_unmapped(s, d):
    return s23(s, d).where("outcome = 'unrouted'").select("label", "n")


@q("S24_predicate_routes", f"with {PARTS} select id, case when name like '%red%' then 'r' when name like '%blue%' then 'b' else 'other' end as route from parts")
def s24(s, d):
    return parts(s, d).select("id", rules.ladder((F.lower("name").contains("red"), "r"), (F.lower("name").contains("blue"), "b"), default="other").alias("route"))


@q("S25_targets_transform", f"with {PARTIES} select id, concat_ws(' | ', 'Aliases: ' || substr(name, 1, 12), 'Countries: ' || address) as details from parties")
def s25(s, d):
    return parties(s, d).select("id", X.packed([("Aliases", F.substring("name", 1, 12)), ("Programs", F.lit("")), ("Countries", F.col("address"))]).alias("details"))


@q("S26_headerless_scan", f"with {PARTIES} select id::varchar as id, name, case when address = 'CHINA' then '' else address end as address from parties")
def s26(s, d):
    at = landing(s)
    parties(s, d).select("id", "name", F.when(F.col("address") == "CHINA", "-0-").otherwise(F.col("address")).alias("a")).write.csv(at)
    t = s.read.schema("_c0 string, _c1 string, _c2 string").csv(at)
    return t.select(F.col("_c0").alias("id"), F.col("_c1").alias("name"), F.when(F.trim("_c2") == "-0-", "").otherwise(F.col("_c2")).alias("address"))


@q("S27_joined_parts", f"with {PARTIES} select id, name || ' ' || source_id as full_name, source_id || ', ' || address as place from parties")
def s27(s, d):
    some = lambda sep, *c: F.array_join(F.filter(F.array(*c), lambda x: F.coalesce(F.trim(x), F.lit("")) != ""), sep)
    return parties(s, d).select("id", some(" ", F.col("name"), F.lit(""), F.col("source_id")).alias("full_name"), some(", ", F.col("source_id"), F.lit(None).cast("string"), F.col("address")).alias("place"))


@q("S28_entity_scan", f"with {PARTIES} select name, address from parties where source_id = 'supplier'")
def s28(s, d):
    at = landing(s)
    parties(s, d).where("source_id = 'supplier'").select(F.col("name").alias("Entity"), F.col("address").alias("Country")).write.option("header", True).csv(at)
    t = files.read_delimited(s, at, ",")
    return t.select(F.col("Entity").alias("name"), F.col("Country").alias("address"))


@q("S29_jurisdictions", "select * from (values ('A', 'Black List'), ('B', 'Grey List'), ('C', 'Grey List')) v(name, source_list)")
def s29(s, d):
    return files.jurisdiction_list(s, {"black": ["A"], "grey": ["B", "C"]}).select("name", "source_list")


@q("S30_sheet_body", f"with x as (select n_regionkey as r, n_nationkey, n_name from {LISTED}) select 'region ' || r as sheet, n_name as party, n_nationkey::int as total, make_date(2020, r + 1, 1) as period_from from x")
def s30(s, d):
    n = listed(s, d).select(F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias("sheet"), "n_regionkey", "n_nationkey", "n_name")
    cells = lambda *c: F.array(*[F.lit(x) if isinstance(x, str) else x for x in c])
    month = F.lpad((F.col("n_regionkey") + 1).cast("string"), 2, "0")
    one = n.select("sheet", "n_regionkey").distinct()
    above = one.select("sheet", F.lit(0).alias("row_no"), cells(F.concat(F.lit("From : 01/"), month, F.lit("/2020 To : 28/"), month, F.lit("/2020"))).alias("cells"))
    head = one.select("sheet", F.lit(3).alias("row_no"), cells("Sr", "Name of Indian Party", "Total").alias("cells"))
    body = n.select("sheet", (F.col("n_nationkey") * 2 + 4).cast("int").alias("row_no"), cells(F.lit("1"), F.col("n_name"), F.col("n_nationkey").cast("string")).alias("cells"))
    foot = one.select("sheet", F.lit(1 << 30).alias("row_no"), cells(" ", "Total", "12").alias("cells")).union(one.select("sheet", F.lit((1 << 30) + 1).alias("row_no"), cells("9", "Late Ltd", "1").alias("cells"))).union(one.select("sheet", F.lit(5).alias("row_no"), cells(" ", "").alias("cells")))
    every = above.union(head).union(body).union(foot).union(head.withColumn("sheet", F.lit("Summary"))).union(body.withColumn("sheet", F.lit("Summary"))).withColumn("file", F.lit("f"))
    return files.sheet_body(every, "indian party", ("total", "note")).select("sheet", F.get("cells", 1).alias("party"), F.get("cells", 2).cast("int").alias("total"), "period_from")


#: Configurations of one source each engine and shape (the ways in which they name fields are fixed values).
FILE_CONFIG = {"source_id": "file_list", "agency": "Agency F", "list_name": "List F", "engine": "file_download", "url": "http://f/list.csv", "format": "csv", "encoding": "latin-1", "delimiter": ",", "has_header": False, "field_map": {"name": "1", "details": "2,3,4", "address": "5,6"}, "validation": {"min_records": 100}}
API_CONFIG = {"source_id": "api_list", "agency": "Agency A", "list_name": "List A", "engine": "api_json", "url": "http://a/list", "response_path": "$.data", "field_map": {"name": "description", "details": "case_no,type", "case_unit": "case_no", "address": "$.place.city"}, "validation": {"min_records": 10}}
HTML_CONFIG = {"source_id": "web_list", "agency": "Agency W", "list_name": "List W", "engine": "html_table", "url": "http://w/en/list", "table_selector": "table", "field_map": {"name": "Name", "details": "With Effect From,Duration"}, "validation": {"min_records": 10}}
MIXED_CONFIG = {"source_id": "mixed_list", "agency": "Agency M", "list_name": "List M", "engine": "api_json", "url": "http://m/fetch", "response_path": "$.html", "response_format": "html_in_json", "field_map": {"name": "Name of Firm", "details": "Region,Branch", "address": "District,State"}, "validation": {"min_records": 1}}
XML_CONFIG = {"source_id": "xml_list", "agency": "Agency X", "list_name": "List X", "engine": "file_download", "url": "http://x/list.xml", "format": "xml", "response_path": ".//entry", "field_map": {"name": "name", "details": "region,code"}}
TSV_CONFIG = {"source_id": "sheet_list", "agency": "Agency S", "list_name": "List S", "engine": "file_download", "url": "http://s/list.xls", "format": "xls", "skip_rows": 1, "field_map": {"name": "Name", "details": "Key,Region"}}
SCRAPED = "2026-01-01 00:00:00"


def _from_config(s, config, path):
    found = configured.records(s, config, path, SCRAPED)
    return found.select("source_agency", "source_list", "name", "details", "address", "case_unit", "has_document", "document_url", "detail_page_url", "link_kind", "scraped_at")


def _config_sql(config, name, details, address="''", unit="''", url="''", rest=""):
    return f"select '{config['agency']}' as source_agency, '{config['list_name']}' as source_list, {name} as name, {details} as details, {address} as address, {unit} as case_unit, case when {url} <> '' then 'Yes' else 'No' end as has_document, {url} as document_url, '{config['url']}' as detail_page_url, 'config_engine' as link_kind, '{SCRAPED}' as scraped_at {rest}"


@q("S35_file_config", _config_sql(FILE_CONFIG, "c_name", "concat_ws(' | ', nullif(c_mktsegment, 'BUILDING'), c_custkey::varchar)", "concat_ws(' | ', n_name, 'k' || c_nationkey)", rest="from customer join nation on n_nationkey = c_nationkey where c_custkey % 9 <> 0"))
def s35_file(s, d):
    at = landing(s)
    c = table(s, d, "customer").join(table(s, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    rows = c.select("c_custkey", F.when(F.col("c_custkey") % 9 == 0, " ").otherwise(F.concat(F.lit("  "), F.col("c_name"))), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")), F.lit(""), F.col("c_custkey").cast("string").alias("k"), "n_name", F.concat(F.lit("k"), "c_nationkey"))
    rows.toDF(*[f"c{i}" for i in range(7)]).write.option("encoding", "ISO-8859-1").csv(at)
    return _from_config(s, FILE_CONFIG, at)


@q("S35_api_config", _config_sql(API_CONFIG, "p_name", "p_partkey::varchar || ' | ' || p_brand", "p_type", "p_partkey::varchar", rest="from part where p_partkey % 10 <> 3"))
def s35_api(s, d):
    at = landing(s)
    record = F.struct(F.when(F.col("p_partkey") % 10 == 3, "").otherwise(F.col("p_name")).alias("description"), F.col("p_partkey").alias("case_no"), F.col("p_brand").alias("type"), F.struct(F.col("p_type").alias("city")).alias("place"))
    pages = table(s, d, "part").groupBy(F.expr("p_partkey div 50")).agg(F.collect_list(record).alias("data"))
    pages.select(F.to_json(F.struct(F.lit(True).alias("ok"), "data")).alias("value")).repartition(40, "value").write.option("maxRecordsPerFile", 1).text(at)
    return _from_config(s, API_CONFIG, at)


def _table_html(heads, cells):
    head = "<table><tr><td>menu</td></tr></table><table><tr>" + "".join(f"<th>{h}</th>" for h in heads) + "</tr>"
    row = F.concat(F.lit("<tr>"), *[x for c in cells for x in (F.lit("<td>"), c, F.lit("</td>"))], F.lit("</tr>"))
    return lambda df, key: df.groupBy(key).agg(F.concat(F.lit(head), F.array_join(F.array_sort(F.collect_list(row)), ""), F.lit("</table>")).alias("value"))


@q("S35_html_config", _config_sql(HTML_CONFIG, "name", "source_id || ' | ' || size", url="'http://w/en/doc' || size || '.pdf'", rest=f"from (with {PARTS} select any_value(name) as name, source_id, size from parts group by lower(name), source_id, size)"))
def s35_html(s, d):
    at = landing(s)
    link = F.concat(F.lit("<a href='doc"), F.col("size").cast("string"), F.lit(".pdf'> "), F.col("name"), F.lit("</a>"))
    page = _table_html(("Name", "With Effect From", "Duration"), (link, F.col("source_id"), F.col("size").cast("string")))
    page(parts(s, d), F.expr("id div 100")).select("value").repartition(40, "value").write.option("maxRecordsPerFile", 1).text(at)
    return _from_config(s, HTML_CONFIG, at)


@q("S35_html_in_json_config", _config_sql(MIXED_CONFIG, "s_name", "'R' || s_nationkey || ' | ' || s_suppkey", "n_name", rest="from supplier join nation on n_nationkey = s_nationkey"))
def s35_mixed(s, d):
    at = landing(s)
    x = table(s, d, "supplier").join(table(s, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    page = _table_html(("Name of Firm", "Region", "Branch", "District", "State"), (F.col("s_name"), F.concat(F.lit("R"), F.col("s_nationkey").cast("string")), F.col("s_suppkey").cast("string"), F.col("n_name"), F.lit(" ")))
    page(x, "s_nationkey").select(F.to_json(F.struct(F.col("value").alias("html"))).alias("value")).repartition(25, "value").write.option("maxRecordsPerFile", 1).text(at)
    return _from_config(s, MIXED_CONFIG, at)


@q("S35_xml_config", _config_sql(XML_CONFIG, "n_name", "'R' || n_regionkey || ' | ' || n_nationkey", rest=f"from {LISTED}"))
def s35_xml(s, d):
    at = landing(s)
    listed(s, d).select(F.col("n_name").alias("name"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("region"), F.col("n_nationkey").alias("code")).write.format("xml").option("rootTag", "list").option("rowTag", "entry").save(at)
    return _from_config(s, XML_CONFIG, at)


@q("S35_sheet_config", _config_sql(TSV_CONFIG, "n_name", "n_nationkey || ' | ' || n_regionkey", rest=f"from {LISTED}"))
def s35_sheet(s, d):
    at = landing(s)
    lines = listed(s, d).select(F.col("n_nationkey").alias("o"), F.concat_ws("\t", F.col("n_nationkey").cast("string"), "n_name", F.col("n_regionkey").cast("string")).alias("value"))
    top = s.createDataFrame([(-2, "a banner"), (-1, "Key\tName \tRegion")], "o int, value string")
    top.union(lines).coalesce(1).sortWithinPartitions("o").select("value").write.text(at)
    return _from_config(s, TSV_CONFIG, f"{at}/*.txt")


@q("S35_config_problems", "select * from (values (0, 'file_list'), (2, 'strict')) v(n, config)")
def s35_problems(s, d):
    found = configured.records(s, FILE_CONFIG, _land_names(s, d), SCRAPED)
    strict = FILE_CONFIG | {"validation": {"min_records": 10**9, "required_fields": ["name", "gender"]}}
    return s.createDataFrame([(len(configured.problems(found, c)), n) for c, n in ((FILE_CONFIG, "file_list"), (strict, "strict"))], "n int, config string")


def _land_names(s, d):
    at = landing(s)
    table(s, d, "customer").select("c_custkey", "c_name").write.csv(at)
    return at


@q("S31_alias_columns", f"select n_nationkey::varchar as k, n_name as name from {LISTED}")
def s31(s, d):
    n = listed(s, d).select(F.map_from_arrays(F.array(F.lit("Sr No"), F.lit("Entity Name")), F.array(F.col("n_nationkey").cast("string"), F.col("n_name"))).alias("cells"))
    alias = lambda *names: F.coalesce(*[F.element_at("cells", F.lit(x)) for x in names])
    return n.select(alias("No", "Sr No").alias("k"), alias("Name", "Entity Name").alias("name"))


@q("S32_labelled_fields", f"select n_nationkey as k, n_name as name, 'R' || n_regionkey as region from {LISTED}")
def s32(s, d):
    text = F.concat(F.lit("Name: "), F.col("n_name"), F.lit(" Name (alias): none Region: R"), F.col("n_regionkey").cast("string"))
    m = files.labelled_fields(text, ("Name", r"Name \(alias\)", "Region"))
    return listed(s, d).select(F.col("n_nationkey").alias("k"), F.element_at(m, "Name").alias("name"), F.element_at(m, "Region").alias("region"))


@q("S33_stateful_lines", "with c as (select conv_id, turn, case when role = 'user' then turn end as m from conversations) select conv_id, turn, last_value(m ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and current row) as company from c")
def s33(s, d):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return table(s, d, "conversations").select("conv_id", "turn", F.last(F.when(F.col("role") == "user", F.col("turn")), True).over(w).alias("company"))


@q("S34_ocr_words", "select * from (values (1, 1, 'name', 'A Ltd'), (1, 1, 'serial', '1'), (1, 2, 'name', 'B'), (1, 2, 'serial', '2.')) v(page, row_no, column_name, cell)")
def s34(s, d):
    words = s.createDataFrame([(1, 0.05, 1.0, "1"), (1, 0.3, 1.0, "A"), (1, 0.4, 1.0, "Ltd"), (1, 0.05, 2.0, "2."), (1, 0.31, 2.0, "B")], "page int, x double, y double, word string")
    bounds = s.createDataFrame([("serial", 0.0, 0.2), ("name", 0.2, 0.9)], "column_name string, lo double, hi double")
    return files.words_to_columns(words, bounds).select("page", F.col("row_no").cast("int").alias("row_no"), "column_name", "cell")


@q("S36_projection", f"with {PARTIES} select id, name from parties")
def s36(s, d):
    return parties(s, d).select("id", "name")


@q("S37_statistics_count", "select count(*) as n from lineitem")
def s37(s, d):
    return table(s, d, "lineitem").agg(F.count("*").alias("n"))


@q("S38_log_scan", "select * from (values ('a', 1), ('b', 2)) v(source_id, line_no)")
def s38(s, d):
    lines = s.createDataFrame([(1, "12:00 WARN failed source=a x"), (2, "WARN source=b"), (3, "INFO source=c"), (4, "WARN again source=a")], "line_no int, value string")
    return files.warned_sources(lines)


@q("S39_bulk_names", f"select n_name as name from {LISTED}")
def s39(s, d):
    at = landing(s)
    n = listed(s, d)
    n.select(F.concat(F.lit(" "), F.col("n_name")).alias("Name")).union(n.select(F.lit("  "))).write.option("header", True).csv(at)
    t = files.read_delimited(s, at, ",")
    return t.select(F.trim("Name").alias("name")).where("name <> ''")


# --- sinks -------------------------------------------------------------------------------------
@q("K01_canonical_write", f"with {PARTIES} select name, address, '' as gender from parties")
def k01(s, d):
    at = landing(s)
    sinks.write_canonical(_canonical(parties(s, d)), at)
    return s.read.option("header", True).csv(at).select("name", "address", F.coalesce("gender", F.lit("")).alias("gender"))


@q("K02_master_write", f"with {PARTIES} select source_id as source_list, count(*) as n from parties group by 1")
def k02(s, d):
    at = landing(s)
    sinks.write_canonical(_canonical(parties(s, d)), at, "parquet")
    return s.read.parquet(at).groupBy("source_list").agg(F.count("*").alias("n"))


@q("K03_replace_changed", f"with {PARTS} select source_id, count(*) as n, sum(size)::bigint as total from (select source_id, case when source_id = 'Brand#11' then size else size end as size from parts where not (source_id = 'Brand#11' and id % 2 = 0)) group by 1")
def k03(s, d):
    at = landing(s)
    p = parts(s, d).select("source_id", "id", "size")
    sinks.replace_partitions(p, at, "source_id")
    sinks.replace_changed(p.where("not (source_id = 'Brand#11' and id % 2 = 0)"), at, "source_id")
    return s.read.parquet(at).groupBy("source_id").agg(F.count("*").alias("n"), F.sum("size").alias("total"))


@q("K04_replace_source", f"with {PARTS} select source_id, count(*) as n from parts where source_id <> 'Brand#12' or id % 3 = 0 group by 1")
def k04(s, d):
    at = landing(s)
    p = parts(s, d).select("source_id", "id")
    sinks.replace_partitions(p, at, "source_id")
    for _ in range(2):  # a rerun changes nothing
        sinks.replace_partitions(p.where("source_id = 'Brand#12' and id % 3 = 0"), at, "source_id")
    return s.read.parquet(at).groupBy("source_id").agg(F.count("*").alias("n"))


@q("K08_split_write", f"with {PARTS} select source_agency as sid, count(*) as n from parts group by 1")
def k08(s, d):
    at = landing(s)
    parts(s, d).select(F.col("source_agency").alias("sid"), "id").write.partitionBy("sid").parquet(at)
    return s.read.parquet(at).groupBy("sid").agg(F.count("*").alias("n"))


@q("K09_replica_gap", f"with {PARTS} select id from parts where id % 10 = 0")
def k09(s, d):
    p = parts(s, d).select("id")
    return p.exceptAll(p.where("id % 10 <> 0"))


@q("K10_reload", f"select count(*) as n from {LISTED}")
def k10(s, d):
    at = landing(s)
    table(s, d, "orders").select("o_orderkey").write.mode("overwrite").parquet(at)
    listed(s, d).write.mode("overwrite").parquet(at)
    return s.read.parquet(at).agg(F.count("*").alias("n"))


@q("K11_snapshot_upsert", f"with {LOG} select source_id, count(*) as row_count, '2024-01-05' as day from log group by 1")
def k11(s, d):
    at = landing(s)
    g = log(s, d).groupBy("source_id").agg(F.count("*").alias("row_count")).withColumn("day", F.lit("2024-01-05"))
    sinks.replace_partitions(g.withColumn("row_count", F.lit(0).cast("long")), at, "day")
    sinks.replace_partitions(g, at, "day")
    return s.read.parquet(at).select("source_id", "row_count", F.date_format("day", "yyyy-MM-dd").alias("day"))


@q("K12_upsert", "select c_custkey as id, case when c_custkey % 3 = 0 then 'new' else c_mktsegment end as seg, c_acctbal as bal from customer")
def k12(s, d):
    c = table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("bal"))
    new = c.where("id % 3 = 0").select("id", F.lit("new").alias("seg"), F.lit(None).cast("double").alias("bal"))
    return sinks.upserted(c, new, ["id"], keep=("bal",))


@q("K14_update_from", f"with {PARTS}, m as (select name, max(amount) as top from parts group by 1) select id, top from parts join m using (name)")
def k14(s, d):
    p = parts(s, d)
    return p.join(p.groupBy("name").agg(F.max("amount").alias("top")), "name").select("id", "top")


@q("K15_export", f"with {ODI} select id, total::double as total, case when id % 4 = 0 then '' else country end as country from odi")
def k15(s, d):
    at = landing(s)
    investments(s, d).select("id", F.col("total").cast("double").alias("total"), F.when(F.col("id") % 4 != 0, F.col("country")).alias("country")).write.json(at)
    return s.read.schema("id long, total double, country string").json(at).select("id", "total", F.coalesce("country", F.lit("")).alias("country"))


@q("K16_hit_export", f"with {DOCS} select id::varchar as id, length(substr(replace(details, chr(10), ' '), 1, 500)) as n from docs")
def k16(s, d):
    at = landing(s)
    sinks.hits_export(docs(s, d).select("id", F.replace("details", F.lit("\n"), F.lit(" ")).alias("details")), at)
    t = s.read.option("header", True).option("escape", "\\").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(at)
    return t.select("id", F.length("details").cast("long").alias("n"))


@q("K17_cluster_report", f"with {PARTS} select name as cluster_id, array_to_string(list_sort(list(distinct source_agency)), '; ') as agencies from parts group by 1")
def k17(s, d):
    at = landing(s)
    g = parts(s, d).groupBy(F.col("name").alias("cluster_id")).agg(F.count("*").alias("record_count"), F.array_sort(F.collect_set("source_agency")).alias("agencies"), F.max("size").alias("risk_score"))
    sinks.cluster_export(g, at)
    return s.read.option("header", True).csv(at).select("cluster_id", "agencies")


@q("K20_guarded_overwrite", "select count(*) as n from orders")
def k20(s, d):
    at = landing(s)
    o = table(s, d, "orders").select("o_orderkey")
    sinks.guarded_overwrite(o, at)
    sinks.guarded_overwrite(o.where("o_orderkey % 3 = 0"), at)
    return s.read.parquet(at).agg(F.count("*").alias("n"))


@q("K05_one_off_load", f"with {PARTS} select source_id, count(*) as n from parts where source_id <> 'Brand#3' or id % 2 = 0 group by 1")
def k05(s, d):
    at = landing(s)
    p = parts(s, d).select("id", "name", "source_id")
    sinks.replace_partitions(p, at, "source_id")
    sinks.replace_source(p.where("id % 2 = 0"), at, "Brand#3")
    sinks.replace_source(p.where("id % 2 = 0"), at, "Brand#4", least=10**6)
    return s.read.parquet(at).groupBy("source_id").agg(F.count("*").alias("n"))


@q("K07_clustered_swap", "select o_custkey as k, count(*) as n from orders group by 1")
def k07(s, d):
    at = landing(s)
    o = table(s, d, "orders").select("o_orderkey", "o_custkey")
    sinks.clustered_swap(o.where("o_orderkey % 2 = 0"), at, "o_custkey")
    sinks.clustered_swap(o, at, "o_custkey")
    return s.read.parquet(at).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))


@q("K24_json_state", "select count(*)::int as sources, 'new' as state from (select distinct p_brand from part)")
def k24(s, d):
    at = f"{landing(s)}/state.json"
    n = parts(s, d).select("source_id").distinct().count()
    for state in ("old", "new"):
        sinks.write_json(s, at, {"sources": n, "state": state})
    return s.read.schema("sources int, state string").option("multiLine", True).json(at)


CIN_OF = "'U12345MH2001PTC' || lpad({0}::varchar, 6, '0')"


def _documents(s):
    return s.createDataFrame([("f", "Some Notice", "Delhi", "1.2.2020")], "file string, title string, office string, date string")


def _lines(df, *variants):
    number = F.concat(F.lit("U12345MH2001PTC"), F.lpad(F.col("id").cast("string"), 6, "0"))
    texts = F.array(*[F.concat(*[{"#": F.col("id").cast("string"), "N": F.upper("name"), "C": number, "D": F.lpad(F.col("id").cast("string"), 8, "1")}.get(t, F.lit(t)) for t in v]) for v in variants])
    return df.select(F.lit("f").alias("file"), F.lit(1).alias("page"), F.col("id").alias("line_no"), F.element_at(texts, (F.col("id") % len(variants) + 1).cast("int")).alias("line"))


@q("E04_companies", f"with x as (select p_partkey as id, upper(p_name) as n, {CIN_OF.format('p_partkey')} as cin from part) select id as line_no, case id % 3 when 0 then n || ' LTD' when 1 then n || ' TRADING LTD' else 'Some Notice' end as name, 'CIN: ' || cin || ' | Struck Off PDF: Some Notice | ROC: Delhi | PDF date: 1.2.2020 | Section: STK-7 U/S 248(5)' as details from x")
def e04(s, d):
    lines = _lines(parts(s, d), (" ", "#", ". ", "N", " LTD ", "C", " x"), ("#", " STK ", "C", " | ", "N", " TRADING LTD  and more"), ("#", ") ", "C"))
    return grammars.parsed("companies", lines, _documents(s)).select("line_no", "name", "details")


@q("E04_partnerships", "select p_partkey as line_no, case p_partkey % 2 when 0 then upper(p_name) || ' LLP, Some Road' else upper(p_name) end as name from part")
def e04_llps(s, d):
    lines = _lines(parts(s, d), ("#", " AAB-1234 ", "N", " LLP, Some Road ROC Delhi 12 1.1.2020"), ("AM-3132., ", "N"))
    return grammars.parsed("llps", lines, _documents(s)).select("line_no", "name")


@q("E04_directors", f"with x as (select p_partkey as id, upper(p_name) as n, {CIN_OF.format('p_partkey')} as cin, lpad(p_partkey::varchar, 8, '1') as din from part) select id as line_no, case id % 3 when 0 then n when 1 then 'Ram O''' else n end as name, 'DIN: ' || din || ' | Company: ' || case id % 3 when 0 then 'ACME LTD' when 1 then 'Lal ' || n || ' PRIVATE LIMITED' else 'Long Name Works' end || ' | CIN: ' || cin || ' | ROC: Delhi | ROC Code: ' || case id % 3 when 0 then 'RC-DL1' else '' end || ' | Source PDF: Some Notice | PDF date: 1.2.2020' as details from x")
def e04_directors(s, d):
    p = parts(s, d).select("id", "name")
    lines = _lines(p, ("#", " ", "C", " ACME LTD ", "D", " ", "N"), ("#", " ", "D", " Ram O'Lal ", "N", " PRIVATE LIMITED ", "C", " Violated"), ("#", " ", "D", " ", "N", " Long Name Works ", "C"))
    # the company's form is matched without case, from the first letters that it allows: after the apostrophe here;
    # each record on a page of its own under a header's words; what follows the director's name comes on a second line
    paged = lines.withColumn("page", F.col("line_no"))
    noise = paged.select("file", "page", F.lit(-1).alias("line_no"), F.lit("Section  Status for").alias("line"))
    tail = paged.where("line_no % 3 = 0").select("file", "page", (F.col("line_no") + 1).alias("line_no"), F.lit("RC-DL1 Active").alias("line"))
    found = grammars.parsed("directors", paged.unionByName(noise).unionByName(tail), _documents(s))
    return found.select("line_no", "name", "details")


@q("E06_table_with_header", f"select n_regionkey as region, n_name as name from {LISTED}")
def e06(s, d):
    page = _table_html(("Nation", "Key"), (F.col("n_name"), F.col("n_nationkey").cast("string")))
    big = "<table><tr><td>other</td></tr>" + "<tr><td>x</td></tr>" * 50 + "</table>"
    pages = page(listed(s, d), "n_regionkey").withColumn("html", F.concat(F.col("value"), F.lit(big)))
    return files.html_tables(pages, "n_regionkey", "html", header_word="nation").select(F.col("n_regionkey").alias("region"), F.element_at("cells", "Nation").alias("name"))


@q("K21_latest_snapshot", f"select count(*) as n from {LISTED} where n_nationkey < 20")
def k21(s, d):
    at = landing(s)
    n = listed(s, d)
    sinks.write_snapshot(n, at, "20240101")
    sinks.write_snapshot(n.where("n_nationkey < 20"), at, "20240102")
    return s.read.parquet(f"{at}/run={sinks.snapshot_stamps(s, at)[0]}").agg(F.count("*").alias("n"))


@q("K22_restore", f"with {PARTS} select source_id, count(*) as n from parts group by 1")
def k22(s, d):
    at = landing(s)
    p = parts(s, d).select("source_id", "id")
    sinks.replace_partitions(p, f"{at}/backup", "source_id")
    sinks.replace_partitions(p.where("source_id <> 'Brand#21'"), f"{at}/live", "source_id")
    sinks.restore(s, f"{at}/backup", f"{at}/live", "source_id", "Brand#21")
    return s.read.parquet(f"{at}/live").groupBy("source_id").agg(F.count("*").alias("n"))


PLACES = """p as (select rtrim(lower(split_part(bare, '/', 1)) || substr(bare, length(split_part(bare, '/', 1)) + 1), '/') as src, html from (select regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '[?#].*$', '') as bare, html from pages)),
h as (select src, unnest(regexp_extract_all(html, 'href=["'']([^"'']*)["'']', 1)) as href from p),
l as (select src, rtrim(split_part(src, '/', 1) || regexp_replace(href, '[?#].*$', ''), '/') as dst from h where regexp_replace(trim(href), '#.*$', '') <> ''),
f as (select distinct array_to_string(parts[1:i - 1], '/') as up, array_to_string(parts[1:i], '/') as down from (select parts, unnest(range(2, len(parts) + 1)) as i from (select string_split(src, '/') as parts from p))),
e as (select distinct src, dst from (select * from l union all select up, down from f union all select down, up from f) where src <> dst and split_part(src, '/', 1) = split_part(dst, '/', 1)),
d0 as (select split_part(src, '/', 1) as domain, min(src) as place from p group by 1),
n1 as (select domain, dst as place, row_number() over (partition by domain order by dst) as n from (select distinct domain, dst from d0 join e on src = place where dst not in (select place from d0))), d1 as (select domain, place from n1 where n <= 99),
c1 as (select domain, count(*) as k from (select domain from d0 union all select domain from d1) group by 1),
n2 as (select domain, dst as place, row_number() over (partition by domain order by dst) as n from (select distinct domain, dst from d1 join e on src = place where dst not in (select place from d0 union all select place from d1))), d2 as (select domain, place from n2 join c1 using (domain) where n <= 100 - k),
found as (select domain, place, 0 as depth from d0 union all select domain, place, 1 from d1 union all select domain, place, 2 from d2)"""


@q("S40_domain_crawl", f"with {PLACES} select domain, found.place, depth, count(p.src) as landed from found left join p on p.src = found.place group by 1, 2, 3")
def s40(s, d):
    pages = table(s, d, "pages")
    return crawl.with_pages(crawl.crawl(crawl.entries(pages), crawl.edges(pages)), pages)


# --- change capture and streams ------------------------------------------------------------------
DIFF = f"with {SNAPS} select case when p.name is null then 'added' when c.name is null then 'removed' else 'modified' end as change_type, coalesce(c.name, p.name) as entity_name, coalesce(c.source_list, p.source_list) as source_list from prev p full join curr c on p.name = c.name and p.source_list = c.source_list where p.name is null or c.name is null or p.details <> c.details"


@q("T01_page_changes", "select page_id, case when page_id % 5 = 0 then 'first_run' when page_id % 3 = 0 then 'changed' else 'unchanged' end as state from pages")
def t01(s, d):
    p = table(s, d, "pages").select("page_id", "html")
    old = p.where("page_id % 5 <> 0").select("page_id", F.sha2(F.when(F.col("page_id") % 3 == 0, F.concat("html", F.lit("x"))).otherwise(F.col("html")), 256).alias("h"))
    return C.page_changes(p, old, F.col("html"), "page_id")


@q("T02_row_changes", DIFF)
def t02(s, d):
    return C.changes(snapshot(s, d, False), snapshot(s, d, True), ["name", "details"])


@q("J14_hash_diff", DIFF.replace("coalesce(c.name, p.name) as entity_name, coalesce(c.source_list, p.source_list) as source_list", "count(*) as n").replace("p.details <> c.details", "p.details <> c.details group by 1"))
def j14(s, d):
    return C.changes(snapshot(s, d, False), snapshot(s, d, True), ["name", "details"]).groupBy("change_type").agg(F.count("*").alias("n"))


@q("T02_stream_changes", DIFF)
def t02_stream(s, d):
    at = landing(s)
    before, after = (snapshot(s, d, x).coalesce(1) for x in (False, True))
    before.write.parquet(f"{at}/in/1")
    after.write.parquet(f"{at}/in/2")
    run = snapshots.stream_lists(s, f"{at}/in/*", before.schema, f"{at}/state", f"{at}/ckpt", ["name", "details"], 16)
    run.awaitTermination()
    return snapshots.ListState(s, f"{at}/state").changes(1).drop("version")


@q("T02_incremental_changes", f"with {SNAPS}, third as (select name, source_list, case when source_list = 'F' and name like '%7' then details || ' again' else details end as details from curr where name not like '%99'), prev_ as (select * from curr) select case when p.name is null then 'added' when c.name is null then 'removed' else 'modified' end as change_type, coalesce(c.name, p.name) as entity_name, coalesce(c.source_list, p.source_list) as source_list from prev_ p full join third c on p.name = c.name and p.source_list = c.source_list where p.name is null or c.name is null or p.details <> c.details")
def t02_incremental(s, d):
    """The third of three snapshots against the state in buckets; a replay of the second in between."""
    second = snapshot(s, d, True)
    again = F.when((F.col("source_list") == "F") & F.col("name").endswith("7"), F.concat("details", F.lit(" again"))).otherwise(F.col("details"))
    third = second.where(~F.col("name").endswith("99")).withColumn("details", again)
    state = snapshots.ListState(s, landing(s), 16)
    for k, snap in enumerate((snapshot(s, d, False), second, second, third)):
        state.take(snap, ["name", "details"], version=min(k, 1) if k < 3 else 2)
    return state.changes(2).drop("version")


@q("T03_count_change", f"with {SNAPS} select (select count(*) from prev) as old_count, (select count(*) from curr) as new_count, 'count_change' as change_type")
def t03(s, d):
    a = snapshot(s, d, False).agg(F.count("*").alias("old_count"))
    b = snapshot(s, d, True).agg(F.count("*").alias("new_count"))
    return a.withColumn("j", F.lit(1)).join(b.withColumn("j", F.lit(1)), "j").where("old_count <> new_count").select("old_count", "new_count", F.lit("count_change").alias("change_type"))


@q("T04_all_sources", f"with {SNAPS}, d as (select coalesce(c.source_list, p.source_list) as source_list, p.name is null as add, c.name is null as rem from prev p full join curr c on p.name = c.name and p.source_list = c.source_list where p.name is null or c.name is null or p.details <> c.details) select source_list, count(*) filter (where add) as added, count(*) filter (where rem) as removed, count(*) filter (where not add and not rem) as modified from d group by 1")
def t04(s, d):
    c = C.changes(snapshot(s, d, False), snapshot(s, d, True), ["name", "details"])
    return c.groupBy("source_list").agg(*[F.count_if(F.col("change_type") == k).alias(k) for k in ("added", "removed", "modified")])


@q("T05_freshness_alarms", f"with {LOG}, g as (select user_id, max(scraped_at) as m from log group by 1) select user_id, date_diff('day', m::date, date '2024-02-08') as age from g where date_diff('day', m::date, date '2024-02-08') >= 10")
def t05(s, d):
    g = log(s, d).groupBy("user_id").agg(F.max("scraped_at").alias("m"))
    return g.select("user_id", V.age_days(F.col("m"), "2024-02-08").cast("long").alias("age")).where("age >= 10")


FRESH = """with e as (select distinct user_id::varchar as source_id, epoch_us(ts) // 1000 as ms, case when user_id % 10 = 0 then 3 else 1 end as factor from events), w as (select max(ms) - 3600000 as w from e),
f as (select source_id, factor, ms, lead(ms) over (partition by source_id order by ms) as nxt from e, w where ms <= w),
a as (select source_id, 'STALE' as alarm, ms + 43200000 * factor as due, ms, nxt from f union all select source_id, 'VERY_STALE', ms + 172800000 * factor, ms, nxt from f)
select source_id, alarm, epoch_ms(due) as at_time, epoch_ms(ms) as last_seen from a, w where due <= w and (nxt is null or nxt >= due)
union all select source_id, 'RECOVERED', epoch_ms(nxt), epoch_ms(ms) from f where nxt >= ms + 43200000 * factor"""


@q("T05_stream_freshness", FRESH)
def t05_stream(s, d):
    """Three landings, each taken up by a new run of the stream, with rows that come late and again."""
    at = landing(s)
    e = table(s, d, "events").select("user_id", "ts")
    first, last = e.agg(F.min("ts"), F.max("ts")).first()
    cuts = [first + (last - first) * k / 3 for k in range(4)]
    for k in range(3):
        own = e.where(F.col("ts").between(cuts[k], cuts[k + 1]))
        late = e.where((F.col("ts") < cuts[k]) & (F.col("user_id") % 5 == 0))
        own.unionByName(late).write.mode("append").parquet(f"{at}/in")
        stream = freshness.alarms(s.readStream.schema(e.schema).parquet(f"{at}/in"), "user_id", "ts", F.col("user_id") % 10 == 0, 0.5, 2)
        freshness.with_timers(stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/ckpt").trigger(availableNow=True)).awaitTermination()
    return s.read.schema(freshness.ALARMS).parquet(f"{at}/out").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("at", "last_seen")}).withColumnRenamed("at", "at_time")


@q("T06_run_state", f"with {PARTS}, o as (select distinct source_id, case when source_id < 'Brand#3' then 'HTTP_DOWN' else 'HTTP_OK' end as h from parts) select source_id, case when source_id like '%1' then 'HTTP_OK' else h end as last_http, case when source_id like '%1' and h = 'HTTP_DOWN' then '2024-01-02' end as last_healed from o")
def t06(s, d):
    o = parts(s, d).select("source_id").distinct().withColumns({"last_http": F.when(F.col("source_id") < "Brand#3", "HTTP_DOWN").otherwise("HTTP_OK"), "last_failed": F.lit(None).cast("string"), "last_healed": F.lit(None).cast("string")})
    alerts = o.where(F.col("source_id").endswith("1")).select("source_id", F.lit("HTTP_OK").alias("type"))
    return C.run_state(o, alerts, "2024-01-02").select("source_id", "last_http", "last_healed")


@q("T08_daily_windows", f"with {LOG} select date_trunc('day', scraped_at)::timestamp as start, source_id, count(*) as n from log group by 1, 2")
def t08(s, d):
    return C.windowed_counts(log(s, d), "scraped_at", "source_id")


@q("T08_stream_windows", f"with {LOG}, g as (select date_trunc('day', scraped_at)::timestamp as start, source_id, count(*) as n from log group by 1, 2) select * from g where start + interval 1 day <= (select max(scraped_at) - interval 1 hour from log)")
def t08_stream(s, d):
    """The windows that the watermark has closed, appended to a folder."""
    at = landing(s)
    e = log(s, d)
    e.write.parquet(f"{at}/in")
    counts = C.windowed_counts(s.readStream.schema(e.schema).parquet(f"{at}/in"), "scraped_at", "source_id")
    run = counts.writeStream.outputMode("append").format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/ckpt").trigger(availableNow=True).start()
    run.awaitTermination()
    return s.read.schema(counts.schema).parquet(f"{at}/out")


@q("T08_sliding_windows", f"with {LOG}, h as (select scraped_at, source_id, date_trunc('day', scraped_at) + interval 12 hours * floor(hour(scraped_at) / 12) as w from log), s as (select w as start, source_id from h union all select w - interval 12 hours, source_id from h) select start::timestamp as start, source_id, count(*) as n from s group by 1, 2")
def t08_sliding(s, d):
    return C.windowed_counts(log(s, d), "scraped_at", "source_id", "1 day", "12 hours")


@q("T09_sessions", f"with {LOG}, l as (select user_id, scraped_at, case when scraped_at - lag(scraped_at) over (partition by user_id order by scraped_at) < interval 6 hours then 0 else 1 end as new from log), g as (select *, sum(new) over (partition by user_id order by scraped_at rows unbounded preceding) as k from l) select user_id, min(scraped_at) as start, max(scraped_at) + interval 6 hours as \"end\", count(*) as n from g group by user_id, k")
def t09(s, d):
    return C.sessions(log(s, d), "scraped_at", "user_id", "6 hours")


@q("E01_reader_registry", f"select n_name as name from {LISTED}")
def e01(s, d):
    at = landing(s)
    listed(s, d).select("n_name").write.option("header", True).csv(at)
    return files.read_as(s, "csv", at).select(F.col("n_name").alias("name"))


@q("E05_cleaner_registry", f"with {PARTS} select id, case when source_agency = 'STANDARD' then upper(name) else name end as name from parts")
def e05(s, d):
    cleaners = {"STANDARD": F.upper("name")}
    clean = F.col("name")
    for agency, c in cleaners.items():
        clean = F.when(F.col("source_agency") == agency, c).otherwise(clean)
    return parts(s, d).select("id", clean.alias("name"))
