"""Rule ladders: ordered conditions become one CASE expression each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the domain, in their order of precedence.
OVERRIDES = (("opensanctions_peps", "pep"), ("opensanctions_debarment", "debarment"), ("opensanctions_crime", "criminal"), ("fatf_blacklist", "jurisdiction_risk"), ("fatf_greylist", "jurisdiction_risk"), ("interpol", "criminal"), ("mca_proclaimed_offenders", "criminal"), ("icij_", "leak"))
PATTERNS = (
    ("sanctions", ("_sanctions", "sanctions_", "ofac", "un_sc", "un_consolidated", "_csl_", "us_csl", "consolidated_screening")),
    ("enforcement", ("sebi_", "_sebi", "mca_defaulter", "mca_disqualified", "mca_vanishing", "mca_corporate_fraud", "fiu_", "_fiu", "bse_debarred", "nse_debarred", "ed_enforce", "nia_wanted", "cbi_wanted")),
    ("debarment", ("adb_", "afdb_", "ebrd_", "idb_", "worldbank_")),
)
LEVEL_OF = {"sanctions": "HIGH", "criminal": "HIGH", "pep": "MEDIUM", "debarment": "MEDIUM", "enforcement": "MEDIUM", "leak": "MEDIUM", "jurisdiction_risk": "HIGH", "informational": "LOW"}
CRITICAL_AGENCIES = ("CBI", "NIA", "MHA")
NOTICE_WORDS = ("interpol", "red corner", "red notice", "yellow notice")
HIGH_WORDS = "wanted|sanction|fugitive|terror|banned|red[-_]?notice|interpol|nia_|mha_|ofac|un_|cbi_|ed_"
MEDIUM_WORDS = "defaulter|debarred|suspend|enforc|penalt|disqualif|revok|disciplin|caution|warn|alert|prohibit|cancel"
WEIGHTS = ((("cbi", "central bureau of investigation"), 30), (("nia", "national investigation agency"), 30), (("mha", "ministry of home affairs"), 30), (("unsc",), 30), (("interpol",), 30), (("sebi", "securities and exchange board"), 20), (("bse", "bombay stock exchange"), 20), (("nse", "national stock exchange"), 20), (("fiu", "financial intelligence unit"), 20), (("bank", "bom", "bob", "boi", "uco", "iob", "psb", "ib "), 15))
NAME_BLACKLIST = ("not available", "n/a", "na", "unknown", "none", "null", "test", "-", "--", "---", "tba", "tbd", "to be advised", "see notes", "see remarks", "anonymous", "no name", "various", "see attached", "the bearer", "bearer", "bearer 1", "person", "individual", "company", "entity", "limited", "ltd")
HIGH_STRATEGIES = ("table", "html_generic", "pdf_table", "pdf_structured", "xlsx_attached", "csv_attached")
LOW_STRATEGIES = ("raw_text", "unstructured", "pdf_ocr", "html_passthrough", "raw")
BLOCK_PHRASES = ("request rejected", "access denied", "please enable javascript", "javascript is required", "captcha required", "verify you are human", "are you a robot", "checking your browser", "human verification", "the requested url was rejected")
NAV_TERMS = ("home", "about", "contact", "login", "search", "menu", "back", "next", "previous", "submit", "click here", "read more", "download", "skip to content")
PRIORITY = ("rollback_zeroed", "rescrape_content", "rescrape_layout", "rescrape_recovery", "redownload_bulk", "rescrape_stale", "playwright_fallback")
DEAD_STATUSES = ("dead_url", "url_not_found", "dead", "duplicate")
BULK, SKIPPED = ("opensanctions_", "fatf_"), ("mca_", "icij_")
BLOCKED_FOR_GOOD = ("income_tax_defaulters_35", "boi_wilful_defaulters", "boi_wilful_defaulters_131", "delhi_police_wanted_209", "delhi_police_proclaimed", "fcra_registered_associations", "gail_banning_list_144", "us_consolidated_screening")
PRIORITY_AGENCIES = ("CBI", "Central Bureau of Investigation (CBI)", "National Investigation Agency (NIA)", "NIA", "Ministry of Home Affairs (MHA)", "MHA", "UNSC", "Interpol")
HEADERS = (
    ("name", ("name", "person", "entity", "company", "firm", "individual", "accused", "defaulter", "borrower", "consultant", "contractor", "vendor", "agency", "organisation", "organization")),
    ("father_name", ("father", "parent", "guardian", "s/o", "d/o", "w/o")), ("date_of_birth", ("birth", "dob", "date of birth")), ("gender", ("gender", "sex")),
    ("address", ("address", "residence", "location", "city", "state", "district", "country")), ("reward_amount", ("reward", "amount", "penalty", "fine")),
    ("case_unit", ("case", "fir", "rc no", "ref", "reference", "order no", "case no")), ("document_url", ("document", "pdf", "attachment", "order", "judgement", "judgment", "notice", "circular")),
)


def has_any(c: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def begins(c: Column, prefixes: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for p in prefixes:
        found = found | c.startswith(p)
    return found


def ladder(*rungs: tuple[Column, object], default: object = None) -> Column:
    """The value of the first rung that holds."""
    out = F
    for condition, value in rungs:
        out = out.when(condition, value)
    return out.otherwise(default)


def category(source_id: Column) -> Column:
    s = F.lower(F.coalesce(source_id, F.lit("")))
    return ladder(*[(s.contains(w), k) for w, k in OVERRIDES], *[(has_any(s, words), k) for k, words in PATTERNS], default="informational")


def level(source_id: Column) -> Column:
    s, k = F.lower(F.coalesce(source_id, F.lit(""))), category(source_id)
    return ladder(((k == "jurisdiction_risk") & s.contains("fatf_greylist"), "MEDIUM"), *[(k == name, v) for name, v in LEVEL_OF.items()], default="LOW")


def overall(levels: Column, any_match: Column, other_hit: Column) -> Column:
    """From the array of levels of a query's matches."""
    return ladder((F.array_contains(levels, "HIGH"), "HIGH"), (F.array_contains(levels, "MEDIUM"), "MEDIUM"), (any_match | other_hit, "LOW"), default="CLEAR")


def verdict(agencies: Column, lists: Column, hits: Column) -> Column:
    """From the arrays of a query's distinct agencies and lists and its number of hits."""
    critical = F.exists(agencies, lambda a: a.isin(*CRITICAL_AGENCIES))
    notice = F.exists(lists, lambda x: has_any(F.lower(x), NOTICE_WORDS))
    n = F.size(agencies)
    return ladder((hits == 0, "CLEAR"), (critical | notice | (n >= 4), "CRITICAL"), (n >= 2, "HIGH"), (hits >= 2, "MEDIUM"), default="LOW")


def group_risk(values: Column) -> Column:
    """``(level, signals)`` from the array of a group's sources and agencies."""
    high = F.filter(values, lambda v: v.rlike(f"(?i){HIGH_WORDS}"))
    medium = F.filter(values, lambda v: v.rlike(f"(?i){MEDIUM_WORDS}"))
    return F.struct(ladder((F.size(high) > 0, "HIGH"), (F.size(medium) > 0, "MEDIUM"), default="LOW").alias("level"), ladder((F.size(high) > 0, high), default=medium).alias("signals"))


def agency_weight(agency: Column) -> Column:
    a = F.lower(agency)
    return ladder(*[(has_any(a, words), w) for words, w in WEIGHTS], default=10)


def cluster_score(agencies: Column) -> Column:
    return F.least(F.lit(100), F.aggregate(F.transform(agencies, agency_weight), F.lit(0), lambda s, w: s + w))


def company_risk(defaulter: Column, vanishing: Column, dormant: Column, status: Column) -> Column:
    yes = lambda c: F.coalesce(F.lower(F.trim(c)) == "yes", F.lit(False))
    s = F.trim(F.coalesce(status, F.lit("")))
    inactive = (s != "") & (F.lower(s) != "active")
    flags = F.array_compact(F.array(F.when(yes(defaulter), "DEFAULTER"), F.when(yes(vanishing), "VANISHING"), F.when(yes(dormant), "DORMANT"), F.when(inactive, "INACTIVE")))
    return F.struct(ladder((yes(defaulter) | yes(vanishing), "HIGH"), (yes(dormant) | inactive, "MEDIUM"), default="LOW").alias("level"), flags.alias("flags"))


def source_health(had: Column, before: Column, now: Column, age: Column) -> Column:
    drop = (before - now) / before * 100.0
    return ladder((~had, "NEW"), ((before > 0) & (now == 0), "BROKEN"), ((before > 0) & (now < before) & (drop > 50.0), "ANOMALY"), (age > 7, "STALE"), default="OK")


def count_alert(before: Column, after: Column, floor: Column) -> Column:
    """``(type, severity)`` of the count of a source before and after a run."""
    delta = after - before
    removed = delta < 0
    kind = ladder((after.isNull() & (before > 0), "MISSING_FROM_SNAPSHOT"), ((before > 0) & (after == 0), "DATA_ZEROED"), (removed, "DATA_REMOVED"), ((floor > 0) & (after > 0) & (after < floor), "BELOW_MIN_RECORDS"), (delta > 0, "DATA_ADDED"))
    grave = -delta / F.greatest(before, F.lit(1)) * 100 >= 50
    return F.struct(kind.alias("type"), ladder((kind == "DATA_ZEROED", "CRIT"), ((kind == "DATA_REMOVED") & grave, "CRIT"), (kind == "DATA_ADDED", "INFO"), (kind.isNotNull(), "WARN")).alias("severity"))


def healing_action(source_id: Column, kind: Column, age: Column, last_http: Column, status: Column) -> Column:
    """What an alert calls for, null for nothing: sources that are dead, static or blocked for good get nothing."""
    off = source_id.isNull() | (source_id == "") | F.coalesce(status.isin(*DEAD_STATUSES), F.lit(False)) | begins(source_id, SKIPPED) | source_id.isin(*BLOCKED_FOR_GOOD)
    return ladder((off, None), (kind == "CONTENT_CHANGED", "rescrape_content"), (kind == "LAYOUT_CHANGED", "rescrape_layout"), (kind == "DATA_ZEROED", "rollback_zeroed"), ((kind == "STALE") & (F.coalesce(age, F.lit(0)) >= 7) & ~begins(source_id, BULK), "rescrape_stale"), (kind == "BULK_STALE", "redownload_bulk"), ((kind == "HTTP_BLOCKED") & (last_http == "HTTP_OK"), "playwright_fallback"), ((kind == "HTTP_OK") & last_http.isin("HTTP_DOWN", "HTTP_BLOCKED"), "rescrape_recovery"))


def priority(action: Column) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in PRIORITY]), action)


def one_action(actions: DataFrame, *source: str) -> DataFrame:
    """Of each source's ``(id, action)`` the most pressing, the least id among equals."""
    best = F.min(F.struct(priority(F.col("action")).alias("p"), "id", "action")).alias("best")
    return actions.where("action is not null").groupBy(*source).agg(best).select(*source, "best.id", "best.action")


def first_actions(actions: DataFrame, most: int) -> DataFrame:
    """A run's actions, most pressing first, up to its limit."""
    return actions.where("action is not null").orderBy(priority(F.col("action")), "id").limit(most)


def change_label(agency: Column, added: Column, removed: Column, before: Column, after: Column) -> Column:
    """Why a source's changes are of high priority."""
    return F.array_compact(F.array(F.when(agency.isin(*PRIORITY_AGENCIES) & (added > 0), "added"), F.when(removed > 0, "removed"), F.when((before > 0) & ((before - after) / F.greatest(before, F.lit(1)) > 0.10), "large_drop")))


def suggestion(status: Column, notes: Column) -> Column:
    n = F.lower(F.coalesce(notes, F.lit("")))
    return ladder(((status == "BROKEN") & has_any(n, ("0", "drop", "missing")), "source moved or blocked"), (status == "BROKEN", "verify source and output"), (status == "ANOMALY", "confirm the layout"), (status == "STALE", "confirm the schedule"), default="review the log")


def interesting_name(name: Column) -> Column:
    n = F.trim(name)
    return name.isNotNull() & (F.length(n) > 3) & ~n.rlike(r"^[0-9\s\p{Punct}]+$") & ~F.lower(n).isin(*NAME_BLACKLIST)


def strategy_confidence(strategy: Column) -> Column:
    s = F.lower(F.coalesce(strategy, F.lit("")))
    return ladder((s.isin(*HIGH_STRATEGIES), "high"), (s.isin(*LOW_STRATEGIES), "low"), default="medium")


def link_confidence(kind: Column) -> Column:
    s = F.lower(F.coalesce(kind, F.lit("")))
    return ladder((s == "", "medium"), (has_any(s, ("ocr", "unstructured", "raw")), "low"), (has_any(s, ("block", "discovery", "api_")), "medium"), default="high")


def http_outcome(error: Column, status: Column) -> Column:
    return F.struct(
        ladder((error == "no_url", "WARN"), (has_any(error, ("Timeout", "ConnectionError", "NameResolutionError")), "CRIT"), (error.isNotNull() & (error != ""), "WARN"), (status.isNull(), "WARN"), (status.between(200, 299), "OK"), (status.between(300, 399), "INFO"), (status.isin(401, 403, 429, 451), "WARN"), ((status == 404) | status.between(500, 599), "CRIT"), default="WARN").alias("severity"),
        ladder((error == "no_url", "NO_URL"), (has_any(error, ("Timeout", "ConnectionError", "NameResolutionError")), "HTTP_DOWN"), (error.isNotNull() & (error != ""), "HTTP_ERROR"), (status.isNull(), "HTTP_ERROR"), (status.between(200, 299), "HTTP_OK"), (status.between(300, 399), "HTTP_REDIRECT"), (status.isin(401, 403, 429, 451), "HTTP_BLOCKED"), ((status == 404) | status.between(500, 599), "HTTP_DOWN"), default="HTTP_ERROR").alias("code"),
    )


def page_kind(status: Column, content_type: Column, html: Column, visible: Column) -> Column:
    body = F.lower(html)
    return ladder((status.isNull() | (status >= 400), "dead"), (F.lower(content_type).contains("pdf"), "pdf"), (has_any(body, ('type="password"', "g-recaptcha", "captcha")), "restricted"), (body.contains("<table"), "html"), ((F.length(visible) < 300) & has_any(body, ('id="root"', 'id="app"', "ng-app", "__next")), "js"), (F.length(visible) < 80, "js"), default="html")


def page_score(strong: Column, weak: Column, rows: Column, downloads: Column, in_url: Column, size: Column) -> Column:
    points = ladder((strong > 0, 30), (weak > 0, 10), default=0) + F.when(rows >= 3, 30).otherwise(0) + F.when(downloads > 0, 20).otherwise(0) + F.when(in_url, 10).otherwise(0) + F.when(size >= 10_000, 10).otherwise(0)
    return F.least(F.lit(100), points)


def candidate_score(status: Column, keywords: Column, path: Column) -> Column:
    return ladder((status != 200, -3), (keywords > 0, 3), (path.isin("", "index.html", "home", "en"), 0), default=1)


def candidate_label(score: Column) -> Column:
    return ladder((score >= 3, "high"), (score >= 1, "medium"), (score >= 0, "low"), default="dead")


def blocked_page(visible: Column) -> Column:
    return F.exists(F.array(*[F.lit(p) for p in BLOCK_PHRASES]), lambda p: F.contains(F.substring(F.lower(visible), 1, 8000), p))


def header_field(header: Column) -> Column:
    h = F.lower(F.coalesce(header, F.lit("")))
    return ladder(*[(has_any(h, words), field) for field, words in HEADERS])


def failure_reason(status: Column, notes: Column) -> Column:
    n = F.lower(F.coalesce(notes, F.lit("")))
    return ladder(
        ((status == "url_not_found") & has_any(n, ("404", "nxdomain", "moved", "gone")), "dead_url"), (status == "url_not_found", "data_not_published"),
        ((status == "js") & has_any(n, ("browser yields", "browser-render", "browser render")), "js_no_api"), (status == "js", "js_shell"), (status == "restricted", "login_required"), (status == "dead", "dead_url"),
        ((status == "failed") & has_any(n, ("network", "unreachable", "timeout")), "network_error"), ((status == "failed") & n.contains("ocr") & n.contains("fail") & ~has_any(n, ("garbage", "duplicate", "chrome_content_not_data", "chrome content")), "pdf_scan_failed"), (status == "failed", "empty_page"),
    )


def recovery(err: Column, status: Column, size: Column, files: Column, rows: Column, js: Column, redirected: Column) -> Column:
    return ladder((err.isNotNull() & (err != ""), "error"), (status >= 400, "dead or restricted"), (size < 1500, "soft 404"), ((files > 0) & (rows < 3), "parse files"), (rows >= 3, "parse table"), (js, "render"), (redirected, "dead"), default="walled")


def tracker_status(known: Column, kind: Column, status: Column, rows: Column, custom: Column, floor: Column, link_kind: Column, real_name: Column) -> Column:
    return ladder((~known, "pending_recon"), (kind == "duplicate", "skipped"), ((status != "") & (status != "active"), status), (rows.isNull(), "failed"), ((rows == 0) & custom & (floor == 0), "completed"), (rows == 0, "partial"), (custom & real_name, "completed"), (custom, "partial"), ((link_kind == "unstructured") | (rows < 3) | ~real_name, "partial"), default="completed")


def better_result(first_rows: Column, second_rows: Column, least: int = 3) -> Column:
    """Whether the second way of reading a page is to be taken: the first is thin and the second has more."""
    return (first_rows < least) & (second_rows > first_rows)


def needs_script(html: Column) -> Column:
    return F.lower(html).rlike(r"<tbody[^>]*>\s*</tbody>") | has_any(F.lower(html), ('id="root"', 'id="app"', "__next", "ng-app", "datatable"))
