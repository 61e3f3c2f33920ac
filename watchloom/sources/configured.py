"""Sources described by a configuration: landed bytes -> canonical records, and checks of what came out.

A configuration names an engine (``file_download``, ``api_json``, ``html_table``), a format, where records lie, and a
map from canonical fields to the source's own: a column or key, several joined by ``a,b``, or a dotted path. Fetching is
not done here; the landed files of all pages lie under one path. Records without a name are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import squeeze
from .files import canonical, html_tables, read_delimited, read_sheet

# The canonical fields that a map may fill, and what their records carry.
MAPPED = ("details", "address", "date_of_birth", "document_url", "father_name", "gender", "case_unit", "reward_amount", "interpol_notice_id")
LINK_KIND = "config_engine"
HTML_TAG = r"<[a-zA-Z/!?][^>]*>"
DIGITS_ONLY = r"^\s*[\d.,\s-]+$"

#: Names of encodings in configurations and for Spark's readers.
CHARSETS = {"utf-8": "UTF-8", "utf8": "UTF-8", "utf-8-sig": "UTF-8", "latin-1": "ISO-8859-1", "latin1": "ISO-8859-1", "iso-8859-1": "ISO-8859-1", "ascii": "US-ASCII", "utf-16": "UTF-16"}

Get = Callable[[str], Column]


def fields(config: dict) -> dict[str, list[str]]:
    """The source's fields behind each canonical one."""
    return {k: [x.strip() for x in v.split(",")] if not v.startswith("$.") else [v] for k, v in (config.get("field_map") or {}).items() if isinstance(v, str)}


def mapped(config: dict, get: Get) -> dict[str, Column]:
    """Several fields are joined by " | ", empty ones left out."""

    def one(names: list[str]) -> Column:
        if len(names) == 1:
            return squeeze(get(names[0]))
        return F.concat_ws(" | ", *[F.nullif(squeeze(get(n)), F.lit("")) for n in names])

    return {k: F.coalesce(one(v), F.lit("")) for k, v in fields(config).items() if k == "name" or k in MAPPED}


def _record_column(expr: str) -> Column:
    """A key of a JSON record, as it stands or as a dotted path."""
    e = expr.strip().removeprefix("$.")
    whole = F.get_json_object("record", f"$['{e}']")
    path = "$" + "".join(f"[{p}]" if p.isdigit() else f"['{p}']" for p in e.split("."))
    return F.coalesce(whole, F.get_json_object("record", path)) if "." in e else whole


def _json_rows(texts: DataFrame, config: dict) -> DataFrame:
    path = (config.get("response_path") or "").lstrip("$.")
    steps = [p for p in path.split(".") if p]
    found = F.get_json_object("value", "$" + "".join(f"[{p}]" if p.isdigit() else f".{p}" for p in steps)) if steps else F.trim("value")
    listed = F.when(F.ltrim(found).startswith("["), found).when(F.ltrim(found).startswith("{"), F.concat(F.lit("["), found, F.lit("]")))
    return texts.select("file", F.posexplode(F.from_json(listed, "array<string>")).alias("row_no", "record"))


def _cells(name: str) -> Column:
    return F.try_element_at("cells", F.lit(name.strip().removeprefix("$.")))


def _rows(spark: SparkSession, config: dict, path: str) -> tuple[DataFrame, Get]:
    """The source's rows with ``file`` and ``row_no`` where they have an order, and how to get a field of one."""
    engine, kind = config["engine"], config.get("format")
    charset = CHARSETS[config.get("encoding", "utf-8").lower()]

    def whole() -> DataFrame:
        return spark.read.option("wholetext", True).option("encoding", charset).text(path).select(F.col("_metadata.file_path").alias("file"), "value")

    if engine == "html_table":
        if config.get("table_selector", "table") != "table":
            raise ValueError(f"table_selector {config['table_selector']!r} is not known")
        return html_tables(whole(), "file", "value"), _cells
    if engine == "api_json" and config.get("response_format") == "html_in_json":
        steps = "".join(f".{p}" for p in config["response_path"].lstrip("$.").split(".") if p)
        return html_tables(whole().select("file", F.get_json_object("value", f"${steps}").alias("value")), "file", "value"), _cells
    if engine == "api_json" or kind == "json":
        return _json_rows(whole(), config), _record_column
    if kind == "xml":
        tag = (config.get("response_path") or "").split("/")[-1]
        wanted = sorted({n for names in fields(config).values() for n in names})
        df = spark.read.format("xml").option("rowTag", tag).schema(", ".join(f"`{n}` string" for n in wanted)).load(path)
        return df, lambda n: F.col(f"`{n}`") if n in wanted else F.lit(None).cast("string")
    header, skip = config.get("has_header", True), int(config.get("skip_rows", 0))
    if kind in ("xls", "xlsx"):
        rows = read_sheet(spark, path, config.get("sheet_name", 0)).where(F.col("row_no") >= skip)
        if not header:
            return rows, lambda n: F.get("cells", int(n)) if n.isdigit() else F.lit(None).cast("string")
        heads = rows.where(F.col("row_no") == skip).select("file", F.transform("cells", lambda c: F.trim(c)).alias("heads"))
        return rows.where(F.col("row_no") > skip).join(heads, "file"), lambda n: F.when(F.array_position("heads", n) > 0, F.get("cells", F.array_position("heads", n).cast("int") - 1))
    df = read_delimited(spark, path, config.get("delimiter") or ("\t" if kind == "tsv" else ","), header, skip, charset)
    names = {c.strip(): c for c in df.columns}
    return df, lambda n: F.col(f"`{names[n]}`") if n in names else F.lit(None).cast("string")


def records(spark: SparkSession, config: dict, path: str, scraped_at: str) -> DataFrame:
    """Canonical records of a source's landed files.

    Rows of web tables that repeat a name, without case, and the first 120 characters of its details are taken once,
    at their first place; their first link is the document where the map names none.
    """
    rows, get = _rows(spark, config, path)
    got = mapped(config, get)
    web = config["engine"] == "html_table"
    href = _cells("_href") if web else F.lit(None).cast("string")
    named = rows.select(*[got.get(c, F.lit("")).alias(c) for c in ("name", *MAPPED)], href.alias("_href"), *([F.col("file"), F.col("row_no")] if web else [])).where("name <> ''")
    if web:
        first = F.min_by(F.struct("*"), F.struct("file", "row_no")).alias("r")
        named = named.groupBy(F.lower("name"), F.substring("details", 1, 120)).agg(first).select("r.*")
        absolute = F.col("_href").rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:") | F.col("_href").startswith("//")
        base, root = urljoin(config.get("url", ""), "."), urljoin(config.get("url", ""), "/")
        link = F.when(absolute, F.col("_href")).when(F.col("_href").startswith("/"), F.concat(F.lit(root.rstrip("/")), F.col("_href"))).otherwise(F.concat(F.lit(base), F.col("_href")))
        named = named.withColumn("document_url", F.when((F.col("document_url") == "") & F.col("_href").isNotNull(), link).otherwise(F.col("document_url")))
    fixed = {"source_agency": config.get("agency", ""), "source_list": config.get("list_name", ""), "detail_page_url": config.get("url", ""), "link_kind": LINK_KIND, "scraped_at": scraped_at}
    return canonical(named, has_document=F.when(F.col("document_url") != "", "Yes").otherwise("No"), **{k: F.lit(v) for k, v in fixed.items()})


def problems(found: DataFrame, config: dict) -> list[str]:
    """What is wrong with a source's records, by one aggregation; nothing where they pass."""
    v = config.get("validation") or {}
    required, least, most_empty = v.get("required_fields", ["name"]), v.get("min_records", 1), float(v.get("max_empty_name_pct", 5))
    name = F.trim("name")
    r = found.agg(
        F.count("*").alias("n"), F.count_if(name == "").alias("empty"), F.count_if(name.rlike(HTML_TAG)).alias("tags"), F.count_if((name != "") & name.rlike(DIGITS_ONLY)).alias("digits"),
        *[F.count_if(F.trim(c) == "").alias(f"no_{c}") for c in required],
    ).first()
    out = [f"{least} records are the least, {r.n} came"] if r.n < least else []
    if not r.n:
        return out
    out += [f"{r[f'no_{c}']} records have no {c}" for c in required if r[f"no_{c}"]]
    if r.empty / r.n * 100 > most_empty:
        out.append(f"{r.empty / r.n * 100:.1f} % of the names are empty, {most_empty} % may be")
    if r.tags:
        out.append(f"{r.tags} names hold HTML tags")
    if r.digits and not v.get("allow_digit_only_names", False):
        out.append(f"{r.digits} names are digits only")
    return out
