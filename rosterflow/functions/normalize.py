"""Identity and text normalization as Column expressions: they fold, push down and stay in codegen.

White space and punctuation mean ASCII throughout; results that are blank are null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal suffixes dropped from the end of company names.
LEGAL_SUFFIXES = ("incorporated", "inc", "corporation", "corp", "company", "co", "llc", "limited", "ltd", "plc", "llp", "lp", "gmbh", "ag", "sa", "bv", "nv", "pte", "pty", "sarl", "oy", "ab")
# Trust rank of sources; any other ranks 0.
SOURCE_RANKS = {"linkedin_import": 500, "linkedin_profile": 500, "legacy_backfill": 400, "resume_upload": 300, "resume": 300, "recruiter_note_summary": 200, "transcript_summary": 200, "recruiter_note_raw": 100, "manual_profile_note": 100}
# Upper bounds of the staff ranges.
STAFF_RANGES = ((10, "1-10"), (50, "11-50"), (200, "51-200"), (500, "201-500"), (1000, "501-1000"), (5000, "1001-5000"), (10000, "5001-10000"))
PROFILE_HOST = "linkedin.com"


def or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def blank_to_null(c: Column) -> Column:
    """Strip white space of every script from both ends; blank is null."""
    return or_null(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))


def trimmed(c: Column) -> Column:
    """Strip spaces; blank is null."""
    return or_null(F.trim(c))


def identity_text(c: Column) -> Column:
    text = F.regexp_replace(F.lower(F.trim(c)), r"\p{Punct}+", " ")
    return or_null(F.trim(F.regexp_replace(text, r"\s+", " ")))


def search_text(c: Column) -> Column:
    """Keeps punctuation, so C++ and C# stay apart."""
    return or_null(F.trim(F.regexp_replace(F.lower(F.trim(c)), r"\s+", " ")))


def identity_url(c: Column) -> Column:
    low = F.lower(F.trim(c))
    whole = F.when(low.startswith("//"), F.concat(F.lit("https:"), low)).when(low.rlike(r"^[a-z][a-z0-9+.-]*://"), low).otherwise(F.concat(F.lit("https://"), F.regexp_replace(low, "^/+", "")))
    bare = F.regexp_replace(F.regexp_replace(whole, r"(?s)[#].*\z", ""), r"(?s)[?].*\z", "")
    return F.when(low != "", or_null(F.regexp_replace(F.regexp_replace(bare, "^http://", "https://"), r"/+\z", "")))


def profile_username(c: Column, host: str = PROFILE_HOST) -> Column:
    low = F.lower(F.trim(c))
    name = low
    for pattern in ("^@+", "^/+", "^(?:in|company|school)/", r"/+\z"):
        name = F.regexp_replace(name, pattern, "")
    return F.when(~low.contains(f"{host}/"), or_null(name))


def _on_site(c: Column, host: str) -> Column:
    dotted = host.replace(".", r"\.")
    return F.regexp_replace(identity_url(c), rf"^https://(?:[a-z]{{2,3}}\.|m\.)?{dotted}", f"https://www.{host}")


def _slug(url: Column, host: str, kind: str) -> Column:
    dotted = host.replace(".", r"\.")
    return or_null(F.regexp_extract(url, rf"^https://www\.{dotted}/{kind}/([^/?#]+)", 1))


def candidate_url(c: Column, host: str = PROFILE_HOST) -> Column:
    """/in/ links keep the first segment, /pub/ links the whole path; anything else is null."""
    url = _on_site(c, host)
    dotted = host.replace(".", r"\.")
    slug = _slug(url, host, "in")
    public = or_null(F.regexp_extract(url, rf"^https://www\.{dotted}/pub/(.+)\z", 1))
    return F.when(slug.isNotNull(), F.concat(F.lit(f"https://www.{host}/in/"), slug)).when(public.isNotNull(), F.concat(F.lit(f"https://www.{host}/pub/"), public))


def candidate_username_in_url(c: Column, host: str = PROFILE_HOST) -> Column:
    return _slug(_on_site(c, host), host, "in")


def company_url(c: Column, host: str = PROFILE_HOST) -> Column:
    url = _on_site(c, host)
    parts = [F.when(_slug(url, host, k).isNotNull(), F.concat(F.lit(f"https://www.{host}/{k}/"), _slug(url, host, k))) for k in ("company", "school")]
    return F.coalesce(*parts)


def company_username_in_url(c: Column, host: str = PROFILE_HOST) -> Column:
    return _slug(_on_site(c, host), host, "(?:company|school)")


def email_address(c: Column) -> Column:
    """Lower case, spaces and a leading mailto: off; nothing else is folded."""
    return or_null(F.trim(F.regexp_replace(F.lower(F.trim(c)), "^mailto:", "")))


def company_name(c: Column) -> Column:
    """Identity text without legal suffixes, as long as a word is left before them."""
    return F.regexp_replace(identity_text(c), rf"(?: (?:{'|'.join(LEGAL_SUFFIXES)}))+\z", "")


def source_rank(c: Column) -> Column:
    name = F.lower(F.trim(c))
    rank = F.lit(0)
    for source, value in SOURCE_RANKS.items():
        rank = F.when(name == source, F.lit(value)).otherwise(rank)
    return rank


def replaces(old_source: Column, new_source: Column, old: Column, new: Column) -> Column:
    """Whether a new value takes the place of an old one: it fills a blank or its source outranks."""
    return trimmed(new).isNotNull() & (trimmed(old).isNull() | (source_rank(new_source) > source_rank(old_source)))


def date_precision(c: Column, is_end: bool = False, current: Column | None = None) -> Column:
    text = F.lower(F.trim(c))
    known = ["year", "month", "day", "unknown", *(["present"] if is_end else [])]
    out = F.when(text.isin(known), text).otherwise(F.lit("unknown"))
    return F.when(F.coalesce(current, F.lit(False)), F.lit("present")).otherwise(out) if is_end and current is not None else out


def at_precision(d: Column, precision: Column) -> Column:
    """A date cut to a normalized precision; present has none."""
    return F.when(precision == "present", F.lit(None).cast("date")).when(precision == "year", F.trunc(d, "year")).when(precision == "month", F.trunc(d, "month")).otherwise(d)


def is_current(flag: Column, end_precision: Column) -> Column:
    return F.coalesce(flag, F.lit(False)) | F.coalesce(F.lower(F.trim(end_precision)) == "present", F.lit(False))


def experience_hash(candidate: Column, title: Column, company_id: Column, company: Column, start: Column, start_precision: Column, end: Column, end_precision: Column, current: Column) -> Column:
    """md5 over the parts that make a job the same job; display text does not matter."""
    now = is_current(current, end_precision)
    first, last = date_precision(start_precision), date_precision(end_precision, True, now)
    who = F.when(company_id.isNotNull(), F.concat(F.lit("company_id:"), company_id)).otherwise(F.concat(F.lit("company_name:"), F.coalesce(company_name(company), F.lit(""))))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.md5(F.concat_ws("|", text(candidate), text(search_text(title)), who, text(at_precision(start, first)), first, text(at_precision(end, last)), last, F.when(now, F.lit("1")).otherwise(F.lit("0"))))


def member(json: Column, name: str) -> Column:
    """A member of a JSON object as text; null where the JSON isn't valid."""
    return F.try_variant_get(F.try_parse_json(json), f"$.{name}", "string")


def document_key(kind: Column, subtype: Column, url: Column, ref: Column, metadata: Column) -> Column:
    """What makes a document the same document: constant for profiles, else key, reference or link."""
    kind_, sub = or_null(F.lower(F.trim(kind))), or_null(F.lower(F.trim(subtype)))
    found = F.coalesce(trimmed(member(metadata, "document_identity_key")), trimmed(ref), identity_url(url))
    return F.when(kind_ == "linkedin_profile", kind_).otherwise(F.concat(kind_, F.lit(":"), F.coalesce(F.concat(sub, F.lit(":")), F.lit("")), found))


def content_hash(kind: Column, text: Column, metadata: Column) -> Column:
    supplied = or_null(F.lower(F.trim(F.coalesce(*[member(metadata, k) for k in ("content_sha256", "content_hash", "text_hash")]))))
    return F.md5(F.concat_ws("|", F.coalesce(F.lower(F.trim(kind)), F.lit("")), F.coalesce(search_text(text), supplied, F.lit(""))))


def text_list(c: Column) -> Column:
    """Trimmed non-blank values, the first of equal ones, in order; an empty list is null."""
    values = F.array_distinct(F.filter(F.transform(c, blank_to_null), lambda x: x.isNotNull()))
    return F.when(F.size(values) > 0, values)


def website(c: Column) -> Column:
    """Scheme and host of a site in lower case."""
    text = blank_to_null(c)
    whole = F.when(text.contains("://"), text).otherwise(F.concat(F.lit("https://"), text))
    scheme, host = F.lower(F.regexp_extract(whole, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)), F.lower(F.regexp_extract(whole, "^[^:]*://([^/?#]*)", 1))
    return F.when(host != "", F.concat(F.when(scheme == "", F.lit("https")).otherwise(scheme), F.lit("://"), host))


def staff_range(count: Column, fallback: Column) -> Column:
    out = F.lit("10001+")
    for top, label in reversed(STAFF_RANGES):
        out = F.when(count <= top, F.lit(label)).otherwise(out)
    return F.when(count.isNull(), blank_to_null(fallback)).when(count > 0, out)


def identity_phase(*keys: Column) -> Column:
    """0 where any key is filled, else 1."""
    return F.when(F.coalesce(*[blank_to_null(k) for k in keys]).isNotNull(), F.lit(0)).otherwise(F.lit(1))


def boolish(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low.isin("true", "t", "1", "yes", "y"), F.lit(True)).when(low.isin("false", "f", "0", "no", "n"), F.lit(False))


def iso_timestamp(c: Column) -> Column:
    """The text if it is an ISO timestamp, else null."""
    return F.when(F.try_to_timestamp(c).isNotNull(), c)


def line_text(c: Column) -> Column:
    """Lines trimmed, runs of blanks single, empty lines dropped."""
    lines = F.split(F.regexp_replace(c, "\r\n?", "\n"), "\n")
    clean = F.filter(F.transform(lines, lambda x: F.regexp_replace(F.regexp_replace(x, r"^\s+|\s+$", ""), r"[ \t]+", " ")), lambda x: x != "")
    return or_null(F.array_join(clean, "\n"))


def document_text(c: Column) -> Column:
    """Sections (lines that start with ``## `` and what follows) with clean lines, a blank line between."""
    body = line_text(F.regexp_replace(c, r"[ \t\x0B\f]+", " "))
    return F.regexp_replace(body, "\n## ", "\n\n## ")


def text_sha256(c: Column) -> Column:
    return F.sha2(F.coalesce(c, F.lit("")).cast("binary"), 256)
