"""The schema of source configurations: what each row's JSON lacks, and its settings with defaults. Built-ins only.

Configurations are rows of a table, so that thousands are checked in one pass. A JSON null is a value of the wrong type, a missing key takes
its default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
ENGINES = ("file_download", "html_table", "api_json")
FILE_FORMATS = ("csv", "tsv", "xml", "json", "xlsx", "xls")
HTTP_METHODS = ("GET", "POST")
PAGINATIONS = {"html_table": ("query_param", "next_link", "offset", "none"), "api_json": ("offset", "cursor", "page_number", "none")}
REQUIRED = ("source_id", "agency", "list_name", "country", "engine", "url")
#: Setting -> type and default.
SETTINGS = {
    "validation.min_records": ("int", 1),
    "validation.max_empty_name_pct": ("double", 5.0),
    "resilience.retries": ("int", 3),
    "resilience.retry_delay_seconds": ("int", 10),
    "resilience.timeout_seconds": ("int", 60),
    "resilience.snapshot_raw": ("boolean", True),
}


def _at(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def _kind(v: Column, path: str) -> Column:
    """The JSON type at a path: null where there is no such key, VOID for a JSON null."""
    return F.schema_of_variant(_at(v, path))


def _text(v: Column, path: str) -> Column:
    return (_kind(v, path) == "STRING") & (_at(v, path, "string") != "")


def _whole(v: Column, path: str, least: int, optional: bool = True) -> Column:
    ok = (_kind(v, path) == "BIGINT") & (_at(v, path, "long") >= least)
    return _kind(v, path).isNull() | ok if optional else ok


def _object(v: Column, path: str) -> Column:
    return _kind(v, path).startswith("OBJECT")


def _optional(v: Column, path: str, ok: Column, null_too: bool = True) -> Column:
    missing = _kind(v, path).isNull()
    return (missing | (_kind(v, path) == "VOID") if null_too else missing) | ok


def rules(v: Column) -> list[tuple[str, Column]]:
    """(field, whether it is right) in the order of the report; a null counts as wrong."""
    engine = F.coalesce(F.when(_kind(v, "engine") == "STRING", _at(v, "engine", "string")), F.lit(""))
    is_a = {e: engine == e for e in ENGINES}
    pct = _kind(v, "validation.max_empty_name_pct")
    number = (pct == "BIGINT") | (pct == "DOUBLE") | (pct == "FLOAT") | pct.startswith("DECIMAL")
    fields = _at(v, "validation.required_fields", "array<variant>")
    out = [(k, _text(v, k)) for k in REQUIRED]
    out += [
        ("engine", ~_text(v, "engine") | engine.isin(*ENGINES)),
        ("field_map", _object(v, "field_map")),
        ("field_map.name", ~F.coalesce(_object(v, "field_map"), F.lit(False)) | _text(v, "field_map.name")),
        ("validation.min_records", _whole(v, "validation.min_records", 0)),
        ("validation.required_fields", _kind(v, "validation.required_fields").isNull() | (_kind(v, "validation.required_fields").startswith("ARRAY") & F.forall(fields, lambda x: (F.schema_of_variant(x) == "STRING") & (F.try_variant_get(x, "$", "string") != "")))),
        ("validation.max_empty_name_pct", pct.isNull() | (number & _at(v, "validation.max_empty_name_pct", "double").between(0, 100))),
        ("resilience.retries", _whole(v, "resilience.retries", 0)),
        ("resilience.retry_delay_seconds", _whole(v, "resilience.retry_delay_seconds", 0)),
        ("resilience.timeout_seconds", _whole(v, "resilience.timeout_seconds", 1)),
        ("resilience.snapshot_raw", _optional(v, "resilience.snapshot_raw", _kind(v, "resilience.snapshot_raw") == "BOOLEAN", null_too=False)),
    ]
    file, table, api = (is_a[e] for e in ENGINES)
    own = [
        (file, "format", F.coalesce(_at(v, "format", "string").isin(*FILE_FORMATS), F.lit(False))),
        (file & _at(v, "format", "string").isin("csv", "tsv"), "delimiter", _optional(v, "delimiter", _text(v, "delimiter"))),
        (file, "skip_rows", _whole(v, "skip_rows", 0)),
        (file, "encoding", _optional(v, "encoding", _text(v, "encoding"), null_too=False)),
        (table, "table_selector", _optional(v, "table_selector", _text(v, "table_selector"))),
        (api, "method", _optional(v, "method", _at(v, "method", "string").isin(*HTTP_METHODS), null_too=False)),
        (api, "headers", _optional(v, "headers", _object(v, "headers"), null_too=False)),
        (api, "body_template", _optional(v, "body_template", _object(v, "body_template"))),
        (api, "response_path", _optional(v, "response_path", _text(v, "response_path"))),
    ]
    for e, kinds in PAGINATIONS.items():
        paged = is_a[e] & _kind(v, "pagination").isNotNull()
        own += [(paged, "pagination", _object(v, "pagination")), (paged & _object(v, "pagination"), "pagination.type", _at(v, "pagination.type", "string").isin(*kinds)), (paged & _object(v, "pagination"), "pagination.max_pages", _whole(v, "pagination.max_pages", 1))]
    return out + [(name, ~F.coalesce(where, F.lit(False)) | F.coalesce(ok, F.lit(False))) for where, name, ok in own]


def checked(configs: DataFrame, column: str = "config") -> DataFrame:
    """``configs`` with ``problems``, the fields that are wrong, and a column for each setting with its default.

    What isn't a JSON object has the one problem ``config``. Settings of a wrong type are null.
    """
    with_v = configs.withColumn("__v", F.try_parse_json(column))
    v = F.col("__v")
    wrong = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules(v)]))
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    settings = {name.split(".")[1]: F.when(_kind(v, name).isNull(), F.lit(default)).otherwise(_at(v, name, kind)) for name, (kind, default) in SETTINGS.items()}
    return with_v.withColumn("problems", F.when(is_object, F.array_distinct(wrong)).otherwise(F.array(F.lit("config")))).withColumns(settings).drop("__v")
