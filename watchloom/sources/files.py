"""Readers of landed files: CSV, TSV, JSON, XML, HTML and text, into one canonical record shape."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import stated_period

#: The canonical record: 17 text columns in this order (fixed values).
CANONICAL = ("source_agency", "source_list", "case_unit", "name", "father_name", "date_of_birth", "gender", "address", "reward_amount", "details", "has_document", "document_url", "detail_page_url", "interpol_notice_id", "link_kind", "scraped_at", "enrichment_status")
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CANONICAL])


def canonical(df: DataFrame, **columns: Column) -> DataFrame:
    """Any frame as canonical records; what isn't given is blank."""
    return df.select(*[F.coalesce(columns.get(c, F.col(c) if c in df.columns else F.lit("")).cast("string"), F.lit("")).alias(c) for c in CANONICAL])


def _lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """``(file, at, value)``: the physical lines of files, with the byte at which their split begins."""
    return spark.read.option("encoding", encoding).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")


def quotes_span_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> bool:
    """Whether some line has an odd number of quotes, so that a cell may go on in the next. Only then must a file be one task."""
    value = F.col("value")
    odd = (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))) % 2 == 1
    return not _lines(spark, path, encoding).where(odd).select(F.lit(1)).limit(1).isEmpty()


HEAD_BYTES = 1 << 20


def _numbered_lines(skip: int, before):
    """Lines without the first ``skip`` of each file, and whether one is the first that is left; ``before``: lines before each split at a file's beginning."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], int] = {}
        known = before.value
        for batch in batches:
            keep, first = [], []
            for split in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = skip + 2  # further down
                if split in known:
                    n = seen[split] = seen.get(split, known[split]) + 1
                keep.append(n > skip)
                first.append(n == skip + 1)
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(first, pa.bool_()), batch.column(2)], names=["file", "first", "value"])
            yield out.filter(pa.array(keep, pa.bool_()))

    return run


def lines_after(spark: SparkSession, path: str, skip: int = 0, encoding: str = "UTF-8") -> DataFrame:
    """``(file, first, value)``: the lines after the first ``skip`` of each file, which must lie in its first ``HEAD_BYTES``.

    Lines have numbers within their split; the few splits that begin that early are counted first.
    """
    lines = _lines(spark, path, encoding)
    heads = lines.where(F.col("at") < HEAD_BYTES).groupBy("file", "at").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    early = heads.select("file", "at", before.alias("before")).where(F.col("before") <= skip).collect()  # a row or two a file
    known = spark.sparkContext.broadcast({(r["file"], r["at"]): r["before"] for r in early})
    return lines.mapInArrow(_numbered_lines(skip, known), "file string, first boolean, value string")


def read_canonical(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Records of all files whose header is exact, and the files that were turned away with theirs.

    Headers are the first lines of the files' first splits, so the CSV scan has a fixed schema and no inference.
    """
    heads = lines_after(spark, path).where("first").select("file", (F.col("value") == ",".join(CANONICAL)).alias("exact"))
    rows = spark.read.schema(SCHEMA).option("header", True).option("enforceSchema", True).option("multiLine", quotes_span_lines(spark, path)).option("escape", '"').csv(path).select("*", F.col("_metadata.file_path").alias("file"))
    good = rows.join(heads.where("exact"), "file", "left_semi").drop("file")
    return canonical(good), heads.where("not exact").select("file")


MOST_HEADERS = 1000


def _cells_of_lines(lines: DataFrame, sep: str) -> DataFrame:
    """``(file, first, cells)`` of lines, by Spark's CSV parser."""
    firsts = [r["value"] for r in lines.where("first").select("value").distinct().take(MOST_HEADERS + 1)]
    if len(firsts) > MOST_HEADERS:
        raise ValueError(f"files have more than {MOST_HEADERS} different first lines")
    width = max((len(next(csv.reader([x], delimiter=sep))) for x in firsts), default=1)
    row = F.from_csv("value", F.lit(", ".join(f"c{i} string" for i in range(width))), {"sep": sep, "escape": '"', "mode": "PERMISSIVE"})
    return lines.select("file", "first", row.alias("r")).select("file", "first", F.array(*[F.col(f"r.c{i}") for i in range(width)]).alias("cells"))


def _cells_of_files(spark: SparkSession, path: str, sep: str, skip: int, encoding: str) -> DataFrame:
    """``(file, first, cells)`` of files whose quotes span lines; a file is one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = io.TextIOWrapper(io.BytesIO(content), encoding, "replace", newline="")
                for _ in range(skip):
                    text.readline()
                rows = [r for r in csv.reader(text, delimiter=sep) if r]
                cells = [[c or None for c in r] for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(cells), pa.string()), pa.array([i == 0 for i in range(len(cells))], pa.bool_()), pa.array(cells, pa.list_(pa.string()))], names=["file", "first", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, first boolean, cells array<string>")


def read_delimited(spark: SparkSession, path: str, sep: str = "\t", header: bool = True, skip_rows: int = 0, encoding: str = "UTF-8") -> DataFrame:
    """CSV or TSV as text columns; without a header they are named 0, 1, ...

    Quoted cells may hold separators, quotes and line ends; a file is split into tasks unless cells span lines. With ``skip_rows`` each file's
    first lines are dropped and each has a header of its own: columns meet by name, in the order of the headers' texts.
    """
    spans = quotes_span_lines(spark, path, encoding)
    if not skip_rows:
        df = spark.read.option("sep", sep).option("encoding", encoding).option("header", header).option("escape", '"').option("multiLine", spans).csv(path)
        return df if header else df.toDF(*[str(i) for i in range(len(df.columns))])
    cells = _cells_of_files(spark, path, sep, skip_rows, encoding) if spans else _cells_of_lines(lines_after(spark, path, skip_rows, encoding).where("trim(value) <> ''"), sep)
    if not header:
        width = cells.where("first").agg(F.max(F.size("cells"))).first()[0] or 1
        return cells.select(*[F.get("cells", F.lit(i)).alias(str(i)) for i in range(width)])
    heads = cells.where("first").select("file", F.col("cells").alias("head"))
    kinds = [r["head"] for r in heads.select("head").distinct().take(MOST_HEADERS + 1)]
    if len(kinds) > MOST_HEADERS:
        raise ValueError(f"files have more than {MOST_HEADERS} different headers")
    names = list(dict.fromkeys(c for head in sorted(kinds, key=str) for c in head if c))
    if not names:
        return spark.createDataFrame([], "`0` string")
    body = cells.where("not first").join(heads, "file")
    return body.select(*[F.get("cells", F.array_position("head", F.lit(c)).cast("int") - 1).alias(c) for c in names])


def read_json_records(spark: SparkSession, path: str, records: str = "$") -> DataFrame:
    """``(file, record)``: the elements of the array at a path of each document; one object counts as one."""
    docs = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value"))
    found = F.get_json_object("value", records) if records != "$" else F.trim("value")
    listed = F.when(F.ltrim(found).startswith("["), found).when(F.ltrim(found).startswith("{"), F.concat(F.lit("["), found, F.lit("]")))
    return docs.select("file", F.explode(F.from_json(listed, "array<string>")).alias("record"))


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


WORKBOOK, OLD_WORKBOOK = b"PK\x03\x04", b"\xd0\xcf\x11\xe0"
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def workbook_sheets(content: bytes) -> Iterator[tuple[str, list[list[str]]]]:
    """Name and rows of text cells of each sheet of an xlsx file, in the workbook's order."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = [["".join(t.text or "" for t in si.iter(f"{_MAIN}t"))] for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
            target = targets[sheet.get(f"{_REL}id")].lstrip("/")
            rows: list[list[str]] = []
            for row in ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{_MAIN}row"):
                at = int(row.get("r", len(rows) + 1))
                rows += [[] for _ in range(at - len(rows))]
                for cell in row.iter(f"{_MAIN}c"):
                    place = 0
                    for ch in (x for x in cell.get("r", "") if x.isalpha()):
                        place = place * 26 + ord(ch) - 64
                    own = rows[at - 1]
                    own += [""] * (place - len(own))
                    kind, value = cell.get("t"), cell.find(f"{_MAIN}v")
                    text = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t")) if kind == "inlineStr" else (value.text or "" if value is not None else "")
                    own[place - 1 if place else -1 :] = [shared[int(text)][0] if kind == "s" and text else text]
            yield sheet.get("name", ""), rows


def read_sheet(spark: SparkSession, path: str, sheet: str | int | None = None) -> DataFrame:
    """``(file, sheet, row_no, cells)`` of all sheets of workbooks, or of one by name or position.

    A file without a workbook's signature is mislabelled text and is read as tab-separated lines. A workbook that
    can't be read is an error, never text.
    """

    def sheets(content: bytes) -> Iterator[tuple[str, list[list[str]]]]:
        if content.startswith(WORKBOOK):
            yield from workbook_sheets(content)
        elif content.startswith(OLD_WORKBOOK):
            for name, cells in pd.read_excel(io.BytesIO(content), sheet_name=None, header=None, dtype=str).items():
                yield name, cells.fillna("").values.tolist()
        else:
            yield "", [line.split("\t") for line in content.decode("utf-8", "replace").splitlines()]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                for k, (name, cells) in enumerate(sheets(content)):
                    if sheet is None or sheet in (k, name):
                        yield pd.DataFrame([(file, name, i, [str(c) for c in r]) for i, r in enumerate(cells)], columns=["file", "sheet", "row_no", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(rows, "file string, sheet string, row_no int, cells array<string>")


class _Tables(HTMLParser):
    def __init__(self):
        super().__init__()
        self.tables: list[list[dict]] = []
        self._open: list[list[dict]] = []
        self._cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self._open.append([])
        elif tag == "tr" and self._open:
            self._open[-1].append({"cells": [], "head": False, "href": None})
        elif tag in ("td", "th") and self._open and self._open[-1]:
            self._cell = []
            self._open[-1][-1]["head"] |= tag == "th"
        elif tag == "a" and self._open and self._open[-1] and self._open[-1][-1]["href"] is None:
            self._open[-1][-1]["href"] = dict(attrs).get("href")

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self._cell is not None and self._open and self._open[-1]:
            self._open[-1][-1]["cells"].append(" ".join("".join(self._cell).split()))
            self._cell = None
        elif tag == "table" and self._open:
            self.tables.append(self._open.pop())

    def handle_data(self, data):
        if self._cell is not None:
            self._cell.append(data)


def table_rows(html: str | None, header_word: str | None = None) -> list[tuple[int, dict[str, str]]]:
    """The rows of the largest table, each cell by position and by header, the first link as ``_href``.

    With a word, only tables count whose first row holds it.
    """
    p = _Tables()
    p.feed(html or "")
    p.close()
    tables = [t for t in p.tables if header_word is None or t and header_word.lower() in " ".join(t[0]["cells"]).lower()]
    if not tables:
        return []
    rows = max(tables, key=len)
    head = next((r["cells"] for r in rows if r["head"]), [])
    out = []
    for r in rows:
        if r["cells"] == head or not any(r["cells"]):
            continue
        cells = {str(i): c for i, c in enumerate(r["cells"])}
        cells |= {h: c for h, c in zip(head, r["cells"], strict=False) if h}
        if r["href"]:
            cells["_href"] = r["href"]
        out.append((len(out), cells))
    return out


def html_tables(pages: DataFrame, key: str = "page_id", html: str = "html", header_word: str | None = None) -> DataFrame:
    """``(key, row_no, cells)`` for each row of each page's largest table, or the largest whose first row holds a word."""
    kind = pages.schema[key].dataType.simpleString()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(k, n, c) for k, h in zip(batch[key], batch[html], strict=True) for n, c in table_rows(h, header_word)], columns=[key, "row_no", "cells"])

    return pages.select(key, html).mapInPandas(rows, f"{key} {kind}, row_no int, cells map<string,string>")


def page_records(pages: DataFrame, least: int = 3) -> DataFrame:
    """Cascade: rows of a table, else repeating blocks, else the text as one record. ``(page_id, strategy, name)``."""
    t = html_tables(pages).groupBy("page_id").agg(F.count("*").alias("rows"), F.array_sort(F.collect_list(F.struct("row_no", F.element_at("cells", F.lit("0")).alias("name")))).alias("t"))
    blocks = F.transform(F.regexp_extract_all("html", F.lit(r"(?is)<(?:li|p)[^>]*>(.*?)</(?:li|p)>"), F.lit(1)), lambda b: F.trim(F.regexp_replace(b, r"<[^>]+>", " ")))
    j = pages.join(t, "page_id", "left").withColumn("b", F.filter(blocks, lambda x: x != ""))
    text = F.substring(F.trim(F.regexp_replace(F.regexp_replace("html", r"<[^>]+>", " "), r"\s+", " ")), 1, 5000)
    pick = F.when(F.col("rows") >= least, F.struct(F.lit("table").alias("strategy"), F.transform("t", lambda r: r["name"]).alias("names"))).when(F.size("b") >= least, F.struct(F.lit("blocks").alias("strategy"), F.col("b").alias("names"))).otherwise(F.struct(F.lit("raw_text").alias("strategy"), F.array(text).alias("names")))
    return j.select("page_id", pick.alias("p")).select("page_id", "p.strategy", F.posexplode("p.names").alias("row_no", "name"))


def page_links(pages: DataFrame) -> DataFrame:
    """``(page_id, document_url, detail_page_url)``: the first PDF link and the first other one."""
    links = F.filter(F.regexp_extract_all("html", F.lit(r"""(?i)href=["']([^"'#]+)["']"""), F.lit(1)), lambda u: ~F.lower(u).startswith("javascript:"))
    pdf = lambda u: F.lower(u).rlike(r"\.pdf(?:$|\?)")
    return pages.select("page_id", F.get(F.filter(links, pdf), F.lit(0)).alias("document_url"), F.get(F.filter(links, lambda u: ~pdf(u)), F.lit(0)).alias("detail_page_url"))


def labelled_fields(text: Column, labels: tuple[str, ...]) -> Column:
    """``Label: value Label: value`` -> map; longer labels are tried first, a value runs to the next label."""
    names = "|".join(sorted(labels, key=lambda x: (-len(x), x)))
    return F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), F.array(*[F.trim(F.regexp_extract(text, rf"(?:^|\s){x}:\s*(.*?)(?=\s(?:{names}):|$)", 1)) for x in labels]))


def merged_tables(rows: DataFrame, key: str, order: str, header: str) -> DataFrame:
    """Consecutive tables with one header become one: gaps and islands."""
    w = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("_new", F.when(F.lag(header).over(w).eqNullSafe(F.col(header)), 0).otherwise(1)).withColumn("table_no", F.sum("_new").over(w)).drop("_new")


def sheet_body(rows: DataFrame, header_word: str, stop_words: tuple[str, ...], skip: str = "summary") -> DataFrame:
    """``(file, sheet, period_from, period_to, row_no, cells)``: rows of each sheet after the first that holds the header word and before the first later one that begins with a stop word.

    Sheets named like ``skip`` and rows without text are left out. The period is what the sheet states above its header.
    """
    rows = rows.where(~F.lower("sheet").contains(skip)).withColumn("line", F.lower(F.array_join("cells", " ")))
    head = F.min(F.when(F.col("line").contains(header_word), F.col("row_no")))
    heads = rows.groupBy("file", "sheet").agg(head.alias("head"))
    j = rows.join(heads, ["file", "sheet"])
    period = j.where("row_no < head").select("file", "sheet", "row_no", stated_period(F.array_join("cells", " ")).alias("p")).where("p.period_from is not null").groupBy("file", "sheet").agg(F.min_by("p", "row_no").alias("p"))
    stop = F.exists(F.array(*[F.lit(x) for x in stop_words]), lambda x: F.startswith(F.regexp_replace("line", r"^[^a-z]+", ""), x))
    body = j.where("head is not null and row_no > head")
    ends = body.groupBy("file", "sheet").agg(F.min(F.when(stop, F.col("row_no"))).alias("stop"))
    body = body.join(ends, ["file", "sheet"]).where((F.col("stop").isNull() | (F.col("row_no") < F.col("stop"))) & (F.trim("line") != ""))
    return body.join(period, ["file", "sheet"], "left").select("file", "sheet", "p.period_from", "p.period_to", "row_no", "cells")


MOST_BOUNDS = 1000


def words_to_columns(words: DataFrame, bounds: DataFrame) -> DataFrame:
    """OCR words -> cells: the column by range of x, the row by the running number of serial marks.

    ``bounds`` are the columns of one layout, at most ``MOST_BOUNDS``; they are broadcast.
    """
    if len(bounds.take(MOST_BOUNDS + 1)) > MOST_BOUNDS:
        raise ValueError(f"a layout has at most {MOST_BOUNDS} columns")
    placed = words.join(F.broadcast(bounds), (F.col("x") >= F.col("lo")) & (F.col("x") < F.col("hi")))
    w = Window.partitionBy("page").orderBy("y", "x")
    serial = (F.col("column_name") == "serial") & F.col("word").rlike(r"^\d+\.?$")
    rows = placed.withColumn("row_no", F.sum(F.when(serial, 1).otherwise(0)).over(w)).where("row_no > 0")
    return rows.groupBy("page", "row_no", "column_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y", "x", "word"))), lambda r: r["word"]), " ").alias("cell"))


def warned_sources(log: DataFrame, first: int = 20) -> DataFrame:
    """Sources named in WARN lines, once each, in order."""
    found = log.select("line_no", F.nullif(F.regexp_extract("value", r"WARN.*?source=(\S+)", 1), F.lit("")).alias("source_id")).where("source_id is not null")
    return found.groupBy("source_id").agg(F.min("line_no").alias("line_no")).orderBy("line_no").limit(first)


JURISDICTIONS = (("black", 3), ("grey", 22))


def jurisdiction_list(spark: SparkSession, names: dict[str, list[str]]) -> DataFrame:
    """A static list of jurisdictions as canonical records."""
    df = spark.createDataFrame([(kind, n) for kind, ns in names.items() for n in ns], "kind string, name string")
    return canonical(df.withColumn("source_list", F.concat(F.initcap("kind"), F.lit(" List"))), name=F.col("name"), source_list=F.col("source_list"))


READERS: dict[str, Callable[..., DataFrame]] = {"csv": lambda s, p, **o: read_delimited(s, p, **({"sep": ","} | o)), "tsv": read_delimited, "json": read_json_records, "xml": read_xml, "xls": read_sheet, "xlsx": read_sheet}


def read_as(spark: SparkSession, kind: str, path: str, **options) -> DataFrame:
    return READERS[kind](spark, path, **options)
