"""Grammars over the text lines of landed documents: what a registry's notices list, line by line.

``lines(file, page, line_no, line)`` are the documents' text, ``documents(file, title, office, date)`` what is known of
each. A grammar gives ``(file, page, line_no, name, details)``. Decoding documents to text is not done here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# How numbers, codes and companies are written, words that are no data, and the labels of details.
COMPANY_NUMBER = r"[LU]\d{5}[A-Z]{2}\d{4}[A-Z]{3}\d{6}"
DIRECTOR_NUMBER = r"\b\d{6,8}\b"
SERIAL = rf"^\d+[\s.):-]+(?=\d{{6,8}}\b|{COMPANY_NUMBER}.*{DIRECTOR_NUMBER})"  # a line's number, right before the director's or the company's
OFFICE_CODE = r"\bRC[-A-Z0-9]{2,8}\b"
PARTNERSHIP_NUMBER = r"\b[A-Z]{2,3}-\d{4}\b"
COMPANY = r"(?i)\b[A-Z][A-Z0-9&.,()\- /]{2,}\s+(?:LIMITED|LTD\.?|LLP|PVT\.?\s*LTD\.?|PRIVATE\s+LIMITED)\b"
OFFICE_NAME = r"\bROC\s+[A-Z][a-z]+"
NOISE = ("violated", "section", "list", "office", "company", "status", "reason", "for", "as", "on", "disqualificat", "code", "period")
AFTER_NAME = r"(?i)\s+(Strike Off|Active|Disqualified|Violated).*$"
STRUCK_OFF = "STK-7 U/S 248(5)"
PARTNERSHIP_ACT = "LLP Act 75 / Rule 37 (Strike-Off)"


def _first(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, f"({pattern})", 1), F.lit(""))


def _before(c: Column, pattern: str) -> Column:
    return F.trim(F.substring(c, F.lit(1), F.regexp_instr(c, F.lit(pattern)) - 1))


def _after(c: Column, pattern: str) -> Column:
    return F.trim(F.substring(c, F.regexp_instr(c, F.lit(pattern)) + F.length(_first(c, pattern)), F.length(c)))


def _labelled(*fields: tuple[str, Column]) -> Column:
    return F.concat_ws(" | ", *[F.concat(F.lit(f"{k}: "), F.coalesce(v, F.lit(""))) for k, v in fields])


def _known(lines: DataFrame, documents: DataFrame) -> DataFrame:
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in ("title", "office", "date")]
    return lines.withColumn("line", F.trim("line")).where("line <> ''").join(documents.select("file", *blank), "file")


def _named(rows: DataFrame, name: Column, details: Column) -> DataFrame:
    return rows.select("file", "page", "line_no", F.substring(name, 1, 200).alias("name"), details.alias("details"))


def companies(lines: DataFrame, documents: DataFrame) -> DataFrame:
    """Struck-off companies: the longer of what stands before and after the company number."""
    x = _known(lines, documents).where(F.col("line").rlike(COMPANY_NUMBER))
    x = x.withColumn("before", F.trim(F.regexp_replace(_before(F.col("line"), COMPANY_NUMBER), r"^\d+[\s.):-]*", ""))).withColumn("after", _after(F.col("line"), COMPANY_NUMBER))
    x = x.withColumn("name", F.coalesce(F.nullif("before", F.lit("")), F.nullif("after", F.lit("")), F.substring("title", 1, 80)))
    x = x.withColumn("late", F.trim(F.regexp_replace("after", r"^[\s|,.-]+", "")))
    x = x.withColumn("name", F.trim(F.element_at(F.split(F.when(F.length("late") > F.length("name"), F.col("late")).otherwise(F.col("name")), "  "), 1)))
    details = _labelled(("CIN", _first(F.col("line"), COMPANY_NUMBER)), ("Struck Off PDF", F.substring("title", 1, 80)), ("ROC", F.col("office")), ("PDF date", F.col("date")), ("Section", F.lit(STRUCK_OFF)))
    return _named(x.where("length(name) >= 3"), F.col("name"), details)


def partnerships(lines: DataFrame, documents: DataFrame) -> DataFrame:
    """Struck-off partnerships: what follows the number, up to the office."""
    x = _known(lines, documents).where(F.col("line").rlike(PARTNERSHIP_NUMBER)).withColumn("after", _after(F.col("line"), PARTNERSHIP_NUMBER))
    name = F.when(F.col("after").rlike(OFFICE_NAME), _before(F.col("after"), OFFICE_NAME)).otherwise(F.col("after"))
    x = x.withColumn("name", F.trim(F.regexp_replace(name, r"^[\s,.]+", ""))).where("length(name) >= 3")
    details = _labelled(("LLPIN", _first(F.col("line"), PARTNERSHIP_NUMBER)), ("Source PDF", F.substring("title", 1, 80)), ("ROC", F.col("office")), ("PDF date", F.col("date")), ("Section", F.lit(PARTNERSHIP_ACT)), ("Address", F.substring("name", 1, 200)))
    return _named(x, F.col("name"), details)


def directors(lines: DataFrame, documents: DataFrame) -> DataFrame:
    """Disqualified directors, in either order of director and company; lines that continue one are joined to it.

    A line's number may have as many digits as a director's; it is that only where the line has no other.
    """
    noise = F.forall(F.split(F.lower("line"), r"\s+"), lambda w: w.isin(*NOISE))
    x = _known(lines, documents).where(~noise)
    page = Window.partitionBy("file", "page").orderBy("line_no")
    begins = (F.row_number().over(page) == 1) | F.col("line").rlike(r"^\d+\s") | F.col("line").rlike(COMPANY_NUMBER)
    x = x.withColumn("begins", begins.cast("int")).withColumn("record", F.sum("begins").over(page))
    parts = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    x = x.groupBy("file", "page", "record", "title", "office", "date").agg(F.min("line_no").alias("line_no"), F.array_join(F.transform(parts, lambda p: p["line"]), " ").alias("line"))
    x = x.where(F.col("line").rlike(COMPANY_NUMBER) & F.col("line").rlike(DIRECTOR_NUMBER))
    x = x.withColumn("line", F.regexp_replace("line", SERIAL, ""))
    line = F.col("line")
    x = x.withColumns({"cin": _first(line, COMPANY_NUMBER), "din": _first(line, DIRECTOR_NUMBER), "code": F.coalesce(_first(line, OFFICE_CODE), F.lit("")), "at_cin": F.regexp_instr(line, F.lit(COMPANY_NUMBER)), "at_din": F.regexp_instr(line, F.lit(DIRECTOR_NUMBER)), "at_code": F.regexp_instr(line, F.lit(OFFICE_CODE))})

    def between(a: str, n: str, b: Column) -> Column:
        start = F.col(a) + F.length(n)
        return F.trim(F.substring(line, start, F.greatest(b - start, F.lit(0))))

    end = F.when(F.col("at_code") > 0, F.col("at_code")).otherwise(F.length(line) + 1)
    company_first = F.struct(between("at_din", "din", end).alias("name"), between("at_cin", "cin", F.col("at_din")).alias("company"))
    x = x.withColumn("mid", between("at_din", "din", F.col("at_cin"))).withColumn("words", F.split("mid", r"\s+"))
    by_form = F.struct(_before(F.col("mid"), COMPANY).alias("name"), F.trim(F.substring("mid", F.regexp_instr("mid", F.lit(COMPANY)), F.length("mid"))).alias("company"))
    by_place = F.struct(F.array_join(F.slice("words", 1, 2), " ").alias("name"), F.array_join(F.slice("words", 3, 9999), " ").alias("company"))
    director_first = F.when(F.col("mid").rlike(COMPANY), by_form).when(F.size("words") >= 4, by_place)
    x = x.withColumn("found", F.when(F.col("at_cin") < F.col("at_din"), company_first).otherwise(director_first)).where("length(found.name) >= 3")
    x = x.withColumn("name", F.trim(F.regexp_replace(F.trim(F.regexp_replace("found.name", r"^\d+\s+", "")), AFTER_NAME, ""))).where((F.length("name") >= 3) & ~F.lower("name").isin(*NOISE))
    details = _labelled(("DIN", F.col("din")), ("Company", F.substring("found.company", 1, 120)), ("CIN", F.col("cin")), ("ROC", F.col("office")), ("ROC Code", F.col("code")), ("Source PDF", F.substring("title", 1, 80)), ("PDF date", F.col("date")))
    return _named(x, F.col("name"), details)


GRAMMARS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {"directors": directors, "companies": companies, "llps": partnerships}


def parsed(kind: str, lines: DataFrame, documents: DataFrame) -> DataFrame:
    return GRAMMARS[kind](lines, documents)
