"""DuckDB forms of the normalization functions, for the SQL the queries are compared with."""

from __future__ import annotations

from rosterflow.functions.normalize import LEGAL_SUFFIXES, SOURCE_RANKS, STAFF_RANGES

HOST = "linkedin.example"
_H = HOST.replace(".", r"\.")
WS = " \\t\\n\\r\\f\\v"


def trimmed(x: str) -> str:
    return f"nullif(trim({x}, ' '), '')"


def blank_to_null(x: str) -> str:
    return rf"nullif(regexp_replace({x}, '^[\s\p{{Z}}\x0b\x85]+|[\s\p{{Z}}\x0b\x85]+$', '', 'g'), '')"


def identity_text(x: str) -> str:
    return rf"nullif(trim(regexp_replace(regexp_replace(lower(trim({x}, ' ')), '[[:punct:]]+', ' ', 'g'), '[\s\x0b]+', ' ', 'g'), ' '), '')"


def search_text(x: str) -> str:
    return rf"nullif(trim(regexp_replace(lower(trim({x}, ' ')), '[\s\x0b]+', ' ', 'g'), ' '), '')"


def identity_url(x: str) -> str:
    low = f"lower(trim({x}, ' '))"
    whole = f"case when {low} like '//%' then 'https:' || {low} when regexp_matches({low}, '^[a-z][a-z0-9+.-]*://') then {low} else 'https://' || regexp_replace({low}, '^/+', '') end"
    bare = f"regexp_replace(regexp_replace({whole}, '(?s)[#].*$', ''), '(?s)[?].*$', '')"
    return f"case when {low} <> '' then nullif(regexp_replace(regexp_replace({bare}, '^http://', 'https://'), '/+$', ''), '') end"


def profile_username(x: str) -> str:
    low = f"lower(trim({x}, ' '))"
    name = low
    for p in ("^@+", "^/+", "^(in|company|school)/", "/+$"):
        name = f"regexp_replace({name}, '{p}', '')"
    return f"case when not contains({low}, '{HOST}/') then nullif({name}, '') end"


def _site(x: str) -> str:
    return rf"regexp_replace({identity_url(x)}, '^https://([a-z]{{2,3}}\.|m\.)?{_H}', 'https://www.{HOST}')"


def slug(x: str, kind: str) -> str:
    return rf"nullif(regexp_extract({_site(x)}, '^https://www\.{_H}/{kind}/([^/?#]+)', 1), '')"


def candidate_url(x: str) -> str:
    public = rf"nullif(regexp_extract({_site(x)}, '^https://www\.{_H}/pub/(.+)$', 1), '')"
    return f"coalesce('https://www.{HOST}/in/' || {slug(x, 'in')}, 'https://www.{HOST}/pub/' || {public})"


def company_url(x: str) -> str:
    return f"coalesce('https://www.{HOST}/company/' || {slug(x, 'company')}, 'https://www.{HOST}/school/' || {slug(x, 'school')})"


def candidate_username_in_url(x: str) -> str:
    return slug(x, "in")


def company_username_in_url(x: str) -> str:
    return slug(x, "(?:company|school)")


def email_address(x: str) -> str:
    return f"nullif(trim(regexp_replace(lower(trim({x}, ' ')), '^mailto:', ''), ' '), '')"


def company_name(x: str) -> str:
    return f"regexp_replace({identity_text(x)}, '( ({'|'.join(LEGAL_SUFFIXES)}))+$', '')"


def source_rank(x: str) -> str:
    return f"case lower(trim(coalesce({x}, ''), ' ')) " + " ".join(f"when '{k}' then {v}" for k, v in SOURCE_RANKS.items()) + " else 0 end"


def replaces(old_source: str, new_source: str, old: str, new: str) -> str:
    return f"({trimmed(new)} is not null and ({trimmed(old)} is null or {source_rank(new_source)} > {source_rank(old_source)}))"


def date_precision(x: str, is_end: bool = False, current: str | None = None) -> str:
    known = "'year', 'month', 'day', 'unknown'" + (", 'present'" if is_end else "")
    out = f"case when lower(trim({x}, ' ')) in ({known}) then lower(trim({x}, ' ')) else 'unknown' end"
    return f"case when coalesce({current}, false) then 'present' else {out} end" if is_end and current else out


def at_precision(d: str, p: str) -> str:
    return f"case when ({p}) = 'present' then null when ({p}) = 'year' then cast(date_trunc('year', {d}) as date) when ({p}) = 'month' then cast(date_trunc('month', {d}) as date) else {d} end"


def is_current(flag: str, p: str) -> str:
    return f"(coalesce({flag}, false) or coalesce(lower(trim({p}, ' ')) = 'present', false))"


def experience_hash(candidate: str, title: str, company_id: str, company: str, start: str, sp: str, end: str, ep: str, current: str) -> str:
    now = is_current(current, ep)
    first, last = date_precision(sp), date_precision(ep, True, now)
    who = f"case when {company_id} is not null then 'company_id:' || {company_id} else 'company_name:' || coalesce({company_name(company)}, '') end"
    text = lambda x: f"coalesce(cast({x} as varchar), '')"
    parts = [text(candidate), text(search_text(title)), who, text(f"({at_precision(start, first)})"), f"({first})", text(f"({at_precision(end, last)})"), f"({last})", f"case when {now} then '1' else '0' end"]
    return "md5(" + " || '|' || ".join(parts) + ")"


def member(json: str, name: str) -> str:
    return f"case when json_valid({json}) then json_extract_string({json}, '$.{name}') end"


def document_key(kind: str, subtype: str, url: str, ref: str, metadata: str) -> str:
    k, s = f"nullif(lower(trim({kind}, ' ')), '')", f"nullif(lower(trim({subtype}, ' ')), '')"
    found = f"coalesce({trimmed(member(metadata, 'document_identity_key'))}, {trimmed(ref)}, {identity_url(url)})"
    return f"case when {k} = 'linkedin_profile' then {k} else {k} || ':' || coalesce({s} || ':', '') || {found} end"


def content_hash(kind: str, text: str, metadata: str) -> str:
    supplied = "nullif(lower(trim(coalesce(" + ", ".join(member(metadata, k) for k in ("content_sha256", "content_hash", "text_hash")) + "), ' ')), '')"
    return f"md5(coalesce(lower(trim({kind}, ' ')), '') || '|' || coalesce({search_text(text)}, {supplied}, ''))"


def text_list(x: str) -> str:
    clean = f"list_filter(list_transform({x}, lambda e: {blank_to_null('e')}), lambda e: e is not null)"
    return f"list_filter({clean}, lambda e, i: list_position({clean}, e) = i)"


def website(x: str) -> str:
    t = blank_to_null(x)
    whole = f"case when contains({t}, '://') then {t} else 'https://' || {t} end"
    scheme, host = f"lower(regexp_extract({whole}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1))", f"lower(regexp_extract({whole}, '^[^:]*://([^/?#]*)', 1))"
    return f"case when {host} <> '' then case when {scheme} = '' then 'https' else {scheme} end || '://' || {host} end"


def staff_range(n: str, fallback: str) -> str:
    return f"case when {n} is null then {blank_to_null(fallback)} when {n} <= 0 then null " + " ".join(f"when {n} <= {t} then '{x}'" for t, x in STAFF_RANGES) + " else '10001+' end"


def identity_phase(*keys: str) -> str:
    return f"case when coalesce({', '.join(blank_to_null(k) for k in keys)}) is not null then 0 else 1 end"
