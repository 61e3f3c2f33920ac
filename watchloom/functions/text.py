"""Text normalisers and extractors as Column builders. Patterns are Java regex; ``(?U)`` makes classes Unicode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .phrases import between, compiled, one_of, slug_between

# Words, marks and patterns decide which names and keys come out.
HONORIFICS = r"(?iU)\b(?:M/s\.?|Mr\.?|Mrs\.?|Ms\.?|Shri\.?|Smt\.?|Dr\.?|CA\.?|Sri\.?|Prof\.?)\b"
COMPANY_SUFFIXES = r"(?iU)\b(?:Ltd\.?|Limited|Pvt\.?|Private|Co\.?|Company|Corp\.?|Corporation|LLP|LLC|Inc\.?|Industries|Enterprises?|Trust|Foundation|Society)\b"
STOP_TOKENS = ("the", "and", "&", "of", "for", "a", "an", "huf", "ors", "others", "anr")
ALIAS_SEPARATOR = r"\s+(?:@|alias|a\.k\.a\.|aka)\s+"
LEADING_TITLE = r"^(?:mr\.?|mrs\.?|ms\.?|shri|smt\.?|dr\.?|prof\.?)\s+"
STACKED_TITLES = r"(?i)^(?:(?:mr|mrs|ms|shri|smt|dr|prof|sri)\.?\s+)+"
MISSING = ("-", "--", "n/a", "na", "unknown", "none")
LONG_NAME = 80
EXCHANGE_MARKS, EXCHANGE_FOLLOWS = "(;.,", ("Address", "Director", "Listed")
EXCHANGE_TITLE = r"(?i)^\s*(?:Mr\.?|Mrs\.?|Ms\.?|Shri\.?|Sri\.?|Smt\.?|M/S\.?)\s+"
COMMODITY_ADDRESS = (r"\.\s+(?=\d)", r"\s+(?=\d{1,3}\s*[,/])", r"\s+(?=\d{2,}\b)", r",\s+(?=\d)")
POLICE_ENDS = ("in connection with", "involved in", "@", "END")
POLICE_AGE = r"(?i)^\s*(.+?)\s*\(\s*\d{1,3}\s*Yrs?\b"
POLICE_TITLE = r"(?i)^\s*(?:Shri\.?|Sri\.?|Smt\.?|Ms\.?|Mr\.?)\s+"
DESCRIPTION = r"Description:\s*([^|]+)"
ORDER_TAIL = r",\s*(?:Order-in-Original|Order-in-original|S/o|D/o|R/o)"
COMPANY_NAME_HINDI = r"कंपनी का नाम:\s*([^|]+)"
FATHER_LABELS = ("FATHER'S NAME", "FATHERS NAME")
PROCLAIMED_ENDS = ("to appear", "in the case", "in the matter", "(", ", for", "under")
SLUG_STARTS, SLUG_ENDS = ("-on-", "imposes-fines-to-", "fines-"), ("-for-", "-and-its-", "-imposing-")
SLUG_FINED = r"^([a-z0-9][a-z0-9-]+?)-(?:fined|fines|fine)-usd"
SLUG_ALERT = r"concerning-(?:fraudulent-)?(?:website-|scheme-)?(.+)$"
ORDER_MARK = r"(?i)(?:[\s,]+(?:Order|u/s|Dated\b|\(reporting\s+entity\)))"
OCR_CLUTTER = r"[\|_\[\]{}~=]+"
COMPANY_END = r"(?i)((?:private limited|pvt\.? ltd\.?|limited|ltd\.?|llp))\s*[,;]?\s+(?=[A-Z0-9])"


def squeeze(c: Column) -> Column:
    """Blanks and no-break spaces collapse to one blank."""
    return F.trim(F.regexp_replace(F.translate(c, " ", " "), r"\s+", " "))


def squeeze_edges(c: Column) -> Column:
    return F.btrim(squeeze(c), F.lit(" .,;-"))


def blank_missing(c: Column) -> Column:
    return F.when(c.isNull() | F.lower(F.trim(c)).isin(*MISSING), F.lit("")).otherwise(F.trim(c))


def drop_controls(c: Column) -> Column:
    """Control characters but tab, line feed and carriage return go."""
    return F.trim(F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", ""))


def valid_request(c: Column) -> Column:
    return F.length(drop_controls(c)).between(2, 500)


def entity_key(c: Column) -> Column:
    """Lower case without honorifics, company suffixes and marks."""
    s = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    for pattern in (HONORIFICS, COMPANY_SUFFIXES, r"(?U)[^\w\s]+"):
        s = F.regexp_replace(s, pattern, " ")
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def token_bag(key: Column) -> Column:
    """Sorted tokens without stop words; repeated tokens stay."""
    return F.array_sort(F.filter(F.split(key, " "), lambda t: (t != "") & ~t.isin(*STOP_TOKENS)))


def cross_source_key(c: Column) -> Column:
    """What comes before an alias, without one title, of a-z, 0-9 and Devanagari."""
    s = F.element_at(F.split(F.lower(F.trim(F.coalesce(c, F.lit("")))), ALIAS_SEPARATOR), 1)
    s = F.regexp_replace(s, LEADING_TITLE, "")
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"[^a-z0-9ऀ-ॿ\s]", " "), r"\s+", " "))


def group_key(c: Column) -> Column:
    return F.lower(F.trim(c))


def strip_titles(c: Column) -> Column:
    return F.regexp_replace(c, STACKED_TITLES, "")


def keep_original(details: Column, original: Column, prefix: str = "original_title: ") -> Column:
    """The original put before the details once; a second pass changes nothing."""
    return F.when(F.coalesce(details, F.lit("")).contains(prefix), details).otherwise(F.concat_ws(" | ", F.concat(F.lit(prefix), original), F.nullif(F.trim(details), F.lit(""))))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null where there is none."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def upto(c: Column, pattern: str) -> Column:
    """What comes before the first match, null where there is none."""
    at = F.regexp_instr(c, F.lit(pattern))
    return F.when(at > 0, F.substring(c, F.lit(1), at - 1))


def _if_long(c: Column, shorter: Column) -> Column:
    return F.when(F.length(c) > LONG_NAME, F.coalesce(shorter, c)).otherwise(c)


def exchange_name(c: Column) -> Column:
    """A long name without address, director or listing that follow it."""
    head = F.btrim(F.regexp_replace(F.btrim(F.btrim(upto(c, rf"(?i)\s*[{EXCHANGE_MARKS}]\s*(?:{'|'.join(EXCHANGE_FOLLOWS)})")), F.lit(",;.- ")), EXCHANGE_TITLE, ""))
    return _if_long(c, F.when(F.length(head) >= 3, head))


def commodity_name(c: Column) -> Column:
    """A long name up to the earliest mark that begins a postal address; a mark within ten characters doesn't count."""
    head = F.least(*[F.nullif(F.regexp_instr(c, F.lit(p)), F.lit(0)) for p in COMMODITY_ADDRESS])
    return _if_long(c, F.when(head > 10, F.btrim(F.btrim(F.substring(c, F.lit(1), head - 1)), F.lit(".,;:- "))))


def police_name(c: Column) -> Column:
    """Who a long notice names, or who comes before an age."""
    found = [F.btrim(F.regexp_replace(F.btrim(extract(c, p)), POLICE_TITLE, "")) for p in (between(("namely",), POLICE_ENDS), POLICE_AGE)]
    return _if_long(c, F.coalesce(*[F.when(F.length(x) >= 3, x) for x in found]))


def described_name(details: Column) -> Column:
    """The name at the beginning of the description within details, null where there is none."""
    text = F.btrim(F.rtrim(F.btrim(extract(details, DESCRIPTION)), F.lit(",")))
    head = F.element_at(F.split(F.element_at(F.split(text, ORDER_TAIL, 2), 1), " Order-in-Original", 2), 1)
    return F.btrim(F.btrim(head, F.lit(", ")))


def hindi_company(details: Column) -> Column:
    return F.btrim(F.rtrim(F.btrim(extract(details, COMPANY_NAME_HINDI)), F.lit(",")))


def father_name(c: Column) -> Column:
    """The name in prose on a father; other text stays, null becomes empty."""
    text = squeeze(F.coalesce(c, F.lit("")))
    return F.coalesce(F.btrim(squeeze(extract(text, rf"(?i){one_of(FATHER_LABELS)}(.+)$")), F.lit(".,;: -")), text)


def proclaimed(title: Column) -> Column:
    """``struct(name, father)`` of a proclamation's title, both empty where it names nobody."""
    title = F.coalesce(title, F.lit(""))
    found = rf"(?i){compiled('against')}\s+(.+?)\s*(?:[, ]\s*{compiled('S/o')}\s+(\w+)|{one_of(PROCLAIMED_ENDS)})"
    return F.struct(squeeze_edges(F.regexp_extract(title, found, 1)).alias("name"), squeeze_edges(F.regexp_extract(title, found, 2)).alias("father"))


def titled(c: Column) -> Column:
    """Each run of letters with a capital at its beginning only."""
    return F.array_join(F.transform(F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1)), lambda x: F.initcap(x)), "")


def slug_party(address: Column) -> Column:
    """The party that an announcement's address names: after "on" or "fines", before "fined", in an alert, or all of it."""
    t = F.element_at(F.split(F.rtrim(F.btrim(address), F.lit("/")), "/"), -1)

    def named(pattern: str, least: int | None = None) -> Column:
        party = extract(t, pattern)
        return party if least is None else F.when((F.length(party) > least) & (F.length(party) < 120), party)

    alert = t.startswith("adgms-fsra-issues-alert") | t.startswith("adgm-fsra-issues-alert")
    fined = named(slug_between(SLUG_STARTS, SLUG_ENDS), 5)
    first = F.when(~alert & ~fined.startswith("usd-") & ~fined.startswith("a-financial-penalty"), fined)
    return titled(F.btrim(F.replace(F.coalesce(first, named(SLUG_FINED), named(SLUG_ALERT, 3), t), F.lit("-"), F.lit(" "))))


def split_description(c: Column) -> Column:
    """``struct(name, rest)`` of a description, cut at its first order mark."""
    text = squeeze(F.coalesce(c, F.lit("")))
    at = F.regexp_instr(text, F.lit(ORDER_MARK))
    return F.struct(F.when(at > 0, F.btrim(F.substring(text, F.lit(1), at - 1), F.lit(" .,;-"))).otherwise(text).alias("name"), F.when(at > 0, F.btrim(F.substring(text, at, F.length(text)))).otherwise("").alias("rest"))


def without_clutter(c: Column) -> Column:
    """Text without the pipes, underscores and brackets that recognition leaves."""
    return F.btrim(squeeze(F.regexp_replace(c, OCR_CLUTTER, " ")), F.lit(" .,:;-"))


def person_parts(c: Column) -> Column:
    """``name s/o father r/o address``."""
    end = r"(?=\s+(?:s/o|d/o|w/o|r/o)\b|$)"
    return F.struct(
        F.trim(F.regexp_replace(c, r"(?i)\s+(?:s/o|d/o|w/o|r/o)\b.*$", "")).alias("name"),
        F.trim(extract(c, rf"(?i)\b(?:s/o|d/o|w/o)\s+(.*?){end}")).alias("father"),
        F.trim(extract(c, r"(?i)\br/o\s+(.*)$")).alias("address"),
    )


def split_companies(c: Column) -> Column:
    return F.split(F.regexp_replace(c, COMPANY_END, "$1||"), r"\|\|")


def split_persons(c: Column) -> Column:
    """A run of capitalised names with titles -> names."""
    return F.filter(F.split(F.regexp_replace(c, r"\s+(?=(?:MR|MRS|MS|SHRI|SMT|DR)\.?\s)", "||"), r"\|\|"), lambda x: F.trim(x) != "")


def versus(c: Column) -> Column:
    parts = F.split(c, r"(?i)\s+(?:vs?\.?|versus)\s+", 2)
    return F.struct(F.trim(F.element_at(parts, 1)).alias("first"), F.when(F.size(parts) > 1, F.trim(F.element_at(parts, 2))).alias("second"))


def slug(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), F.lit("-"))


def file_name(c: Column) -> Column:
    return F.regexp_replace(c, r"[^A-Za-z0-9_.-]", "_")


def packed(fields: list[tuple[str, Column]], cut: int = 200) -> Column:
    """``label: value | ...`` in the given order, blanks left out."""
    return F.concat_ws(" | ", *[F.when(F.trim(v) != "", F.concat(F.lit(f"{k}: "), F.substring(F.trim(v), 1, cut))) for k, v in fields])


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns], F.lit(""))


def short_label(c: Column) -> Column:
    """The acronym in parentheses, else up to 30 characters of whole words."""
    return F.coalesce(extract(c, r"\(([A-Z]{2,10})\)"), F.when(F.length(c) <= 30, c).otherwise(F.regexp_replace(F.substring(c, 1, 30), r"\s+\S*$", "")))


def ellipsis(c: Column, n: int) -> Column:
    return F.when(F.length(c) <= n, c).otherwise(F.concat(F.substring(c, 1, n - 1), F.lit("…")))


def escape_html(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def human_number(c: Column, millions: bool = True) -> Column:
    """Thousands as ``1.2K`` and ``114K``; from a million on ``4.84M``, or thousands still without ``millions``."""

    def rounded(x: Column, digits: int) -> Column:
        return F.format_string(f"%.{digits}f", x)

    large = F.when(c.isNull(), "-")
    if millions:
        large = large.when(c >= 1_000_000, F.concat(rounded(c / 1e6, 2), F.lit("M")))
    return large.when(c >= 10_000, F.concat(rounded(c / 1e3, 0), F.lit("K"))).when(c >= 1000, F.concat(rounded(c / 1e3, 1), F.lit("K"))).otherwise(c.cast("string"))


def stable_page(c: Column) -> Column:
    """A page without what changes at each load: tokens, times, csrf fields."""
    for pattern in (r"(?is)<time[^>]*>.*?</time>", r"(?is)<meta[^>]+csrf[^>]*>", r"(?is)<input[^>]+type=.hidden.[^>]*>", r"(?is)<script[^>]*>.*?</script>"):
        c = F.regexp_replace(c, pattern, "")
    return c


def visible_text(c: Column) -> Column:
    c = F.regexp_replace(c, r"(?is)<(script|style|nav|header|footer)\b[^>]*>.*?</\1>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", " "), r"\s+", " "))


def page_title(c: Column) -> Column:
    return F.trim(extract(c, r"(?is)<title[^>]*>(.*?)</title>"))


def person_like(c: Column) -> Column:
    return c.rlike(r"^[A-Za-z.]+(?: [A-Za-z.]+){1,4}$") & ~company_like(c)


def company_like(c: Column) -> Column:
    return c.rlike(r"(?i)\b(?:limited|ltd|llp|private|pvt|company|corporation|inc)\b")


def mostly_latin(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^A-Za-z]", "")) >= F.length(F.regexp_replace(c, r"[^ऀ-ॿ]", ""))
