"""Queries of the normalization and date functions over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions import dates, normalize as n
from rosterflow.plans import duck as q
from rosterflow.sources.tables import from_json_array, keyset_page, project, table

H = q.HOST
c = F.col


def _distinct(spark: SparkSession, d: str, name: str, *columns) -> DataFrame:
    return table(spark, d, name).select(*columns).distinct()


def norm_identity_text(spark: SparkSession, d: str) -> DataFrame:
    return _distinct(spark, d, "tmp_company_input", "source_id", n.identity_text(c("name")).alias("value"))


def norm_search_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tmp_experience_input").select(n.search_text(c("title")).alias("title"), n.search_text(c("location")).alias("location")).groupBy("title", "location").agg(F.count("*").alias("n"))


def norm_identity_url(spark: SparkSession, d: str) -> DataFrame:
    return _distinct(spark, d, "tmp_company_input", "source_id", n.identity_url(c("linkedin_url")).alias("link"), n.identity_url(c("website")).alias("site"))


def norm_linkedin_username(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "tmp_company_input").select(c("source_id").alias("id"), c("linkedin_username").alias("u"))
    b = table(spark, d, "tmp_candidate_input").select(c("source_candidate_id").alias("id"), c("raw_linkedin_username").alias("u"))
    return a.union(b).select("id", n.profile_username(c("u"), H).alias("username")).distinct()


def norm_candidate_linkedin_url(spark: SparkSession, d: str) -> DataFrame:
    url = c("raw_linkedin_url")
    return _distinct(spark, d, "tmp_candidate_input", "source_candidate_id", n.candidate_url(url, H).alias("url"), n.candidate_username_in_url(url, H).alias("username"))


def norm_company_linkedin_url(spark: SparkSession, d: str) -> DataFrame:
    url = c("linkedin_url")
    return _distinct(spark, d, "tmp_company_input", "source_id", n.company_url(url, H).alias("url"), n.company_username_in_url(url, H).alias("username"))


def norm_email(spark: SparkSession, d: str) -> DataFrame:
    return _distinct(spark, d, "tmp_email_input", "source_row_id", n.email_address(c("email_raw")).alias("email"))


def norm_company_name(spark: SparkSession, d: str) -> DataFrame:
    return _distinct(spark, d, "tmp_company_input", "source_id", n.company_name(c("name")).alias("company"))


def source_precedence(spark: SparkSession, d: str) -> DataFrame:
    """Ranks of all sources, and how many of each outrank a resume for the company type."""
    rows = table(spark, d, "tmp_company_input").dropDuplicates(["source_id"])
    wins = n.replaces(F.lit("resume"), c("incoming_source"), F.lit("Private"), c("company_type"))
    return rows.groupBy(F.lower(F.trim("incoming_source")).alias("source")).agg(F.max(n.source_rank(c("incoming_source"))).alias("rank"), F.count("*").alias("n"), F.count_if(wins).alias("n_replacing"))


def experience_dates(spark: SparkSession, d: str) -> DataFrame:
    now = n.is_current(c("raw_is_current"), c("end_date_precision_raw"))
    first, last = n.date_precision(c("start_date_precision_raw")), n.date_precision(c("end_date_precision_raw"), True, now)
    return _distinct(spark, d, "tmp_experience_input", "source_candidate_id", "source_path", "source_array_index", n.at_precision(c("start_date_raw"), first).alias("start_date"), first.alias("start_precision"), n.at_precision(c("end_date_raw"), last).alias("end_date"), last.alias("end_precision"), now.alias("is_current"))


_HASH = ("resolved_candidate_id", "title", "company_id", "raw_company_name", "start_date_raw", "start_date_precision_raw", "end_date_raw", "end_date_precision_raw", "raw_is_current")


def experience_hash(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "tmp_experience_input").withColumn("company_id", n.trimmed(c("incoming_linkedin_id")))
    return rows.select("source_candidate_id", "source_path", "source_array_index", n.experience_hash(*[c(x) for x in _HASH]).alias("source_hash")).distinct()


_DOC = ("source_type", "source_subtype", "source_url", "external_source_ref", "metadata_json")


def document_identity_key(spark: SparkSession, d: str) -> DataFrame:
    return _distinct(spark, d, "tmp_source_document_input", "external_source_ref", n.document_key(*[c(x) for x in _DOC]).alias("identity_key"))


def document_content_hash(spark: SparkSession, d: str) -> DataFrame:
    return _distinct(spark, d, "tmp_source_document_input", "external_source_ref", n.content_hash(c("source_type"), c("normalized_text"), c("metadata_json")).alias("content_hash"))


def staff_count_range(spark: SparkSession, d: str) -> DataFrame:
    return _distinct(spark, d, "tmp_company_input", "source_id", n.staff_range(c("staff_count"), c("staff_count_range")).alias("staff_range"), n.identity_phase(c("linkedin_id"), c("linkedin_username"), c("linkedin_url")).alias("phase"))


def clean_website(spark: SparkSession, d: str) -> DataFrame:
    return _distinct(spark, d, "tmp_company_input", "source_id", n.website(c("website")).alias("site"))


def clean_text_list(spark: SparkSession, d: str) -> DataFrame:
    return _distinct(spark, d, "tmp_company_input", "source_id", F.coalesce(F.array_join(n.text_list(c("industries")), "|"), F.lit("")).alias("industries"), F.coalesce(F.array_join(n.text_list(c("specialties")), "|"), F.lit("")).alias("specialties"))


def parse_date_strings(spark: SparkSession, d: str) -> DataFrame:
    """Order dates written in eight ways, read back with their precision."""
    day = F.to_date("o_orderdate")
    forms = F.array(*[F.struct(F.lit(i).alias("form"), F.date_format(day, p).alias("text")) for i, p in enumerate(("yyyy-MM-dd", "yyyy/MM/dd", "MMM d yyyy", "d MMMM yyyy", "yyyy-MM", "MMMM yyyy", "yyyy MMM", "yyyy"))])
    rows = table(spark, d, "orders").select("o_orderkey", F.inline(forms))
    got = dates.parse_date(c("text"), True)
    return rows.select("o_orderkey", "form", got["date"].alias("parsed"), got["precision"].alias("precision"))


def payload_dates(spark: SparkSession, d: str) -> DataFrame:
    """The stated dates of every job, parsed; how often each precision occurs."""
    start, end = dates.parse_date(n.member(c("raw_date_payload"), "start"), False), dates.parse_date(n.member(c("raw_date_payload"), "end"), True)
    return table(spark, d, "tmp_experience_input").groupBy(start["precision"].alias("start_precision"), end["precision"].alias("end_precision")).agg(F.count("*").alias("n"), F.min(start["date"]).alias("first_start"), F.max(end["date"]).alias("last_end"))


TITLES, COMPANIES = ("title", "position_title", "position", "role"), ("company", "companyName", "company_name", "organization")


def _first(doc, names):
    """The first member that is not null, as variant."""
    return F.coalesce(*[F.when(~F.is_variant_null(F.try_variant_get(doc, f"$.{x}", "variant")), F.try_variant_get(doc, f"$.{x}", "variant")) for x in names])


def json_first_present(spark: SparkSession, d: str) -> DataFrame:
    """Title and company of every item, whichever member holds them; a company may be an object."""
    doc = F.try_parse_json("raw_item")
    company = _first(doc, COMPANIES)
    name = F.coalesce(F.try_variant_get(company, "$.name", "string"), F.when(F.schema_of_variant(company) == "STRING", company.cast("string")))
    rows = table(spark, d, "tmp_experience_input").select("source_candidate_id", "source_path", "source_array_index", n.blank_to_null(_first(doc, TITLES).cast("string")).alias("title"), n.blank_to_null(name).alias("company"))
    return rows.distinct()


def experience_flatten(spark: SparkSession, d: str) -> DataFrame:
    """Work history of profile documents: one row for each item with its ordinal, from whichever array is there."""
    doc = F.try_parse_json("raw_payload")
    work = F.coalesce(F.try_variant_get(doc, "$.data.experience", "array<variant>"), F.try_variant_get(doc, "$.data.workExperience", "array<variant>"))
    flat = F.try_variant_get(doc, "$.data.experience", "array<variant>").isNotNull()
    rows = table(spark, d, "tmp_source_document_input").dropDuplicates(["external_source_ref"]).select("external_source_ref", work.alias("items"), F.when(flat, "experience").otherwise("workExperience").alias("path"))
    return rows.select("external_source_ref", "path", F.posexplode("items").alias("ordinal", "item")).select("external_source_ref", "path", "ordinal", F.try_variant_get("item", "$.title", "string").alias("title"))


def structural_emptiness(spark: SparkSession, d: str) -> DataFrame:
    fields = [n.trimmed(c(x)) for x in ("title", "description", "location", "raw_company_name", "incoming_linkedin_id", "incoming_linkedin_username", "incoming_linkedin_url")]
    empty = F.coalesce(*fields, c("start_date_raw").cast("string"), c("end_date_raw").cast("string")).isNull() & ~F.coalesce(c("raw_is_current"), F.lit(False))
    return table(spark, d, "tmp_experience_input").groupBy(empty.alias("empty"), F.coalesce("candidate_skip_reason", F.lit("none")).alias("skip_reason")).agg(F.count("*").alias("n"))


def keyset_pages(spark: SparkSession, d: str) -> DataFrame:
    """The page of 500 companies after a cursor, in (phase, id) order."""
    rows = table(spark, d, "tmp_company_input").select(n.identity_phase(c("linkedin_id"), c("linkedin_username"), c("linkedin_url")).alias("phase"), "source_id").distinct()
    return keyset_page(rows, ["phase", "source_id"], (0, "8"), 500)


def missing_column_projection(spark: SparkSession, d: str) -> DataFrame:
    """Mail rows under the names of another version of the table; columns it lacks are null."""
    wanted = {"row_id": ("string", ["row_id", "source_row_id"]), "email": ("string", ["email", "email_address", "email_raw"]), "kind": ("string", ["type", "email_type", "raw_email_type"]), "bounced": "boolean", "verification_attempts": "int"}
    return project(table(spark, d, "tmp_email_input"), wanted).distinct()


def json_recordset(spark: SparkSession, d: str) -> DataFrame:
    """References of company records as typed rows."""
    rows = from_json_array(table(spark, d, "tmp_company_input").select("source_record_refs").distinct(), "source_record_refs", "source_table string, source_id string, raw_name string")
    return rows.groupBy("source_table").agg(F.count("*").alias("n"), F.countDistinct("source_id").alias("n_ids"), F.countDistinct("raw_name").alias("n_names"))


def boolish_values(spark: SparkSession, d: str) -> DataFrame:
    """Flags written as text, read back."""
    text = F.when(c("raw_is_primary"), F.element_at(F.array(*[F.lit(x) for x in ("Yes", "t", " 1 ", "true")]), (F.coalesce("verification_attempts", F.lit(0)) % 4 + 1).cast("int"))).otherwise(F.element_at(F.array(*[F.lit(x) for x in ("no", "F", "0", "maybe")]), (F.coalesce("verification_attempts", F.lit(0)) % 4 + 1).cast("int")))
    return table(spark, d, "tmp_email_input").groupBy(n.boolish(text).alias("flag")).agg(F.count("*").alias("n"))


def line_texts(spark: SparkSession, d: str) -> DataFrame:
    """Hashes of document texts after cleaning their lines."""
    return table(spark, d, "tmp_source_document_input").dropDuplicates(["external_source_ref"]).select("external_source_ref", n.text_sha256(n.line_text(c("raw_text"))).alias("sha"), F.length(n.document_text(c("raw_text"))).cast("bigint").alias("n_chars"))


_first_sql = lambda names: "coalesce(" + ", ".join(f"nullif(json_extract(j, '$.{x}'), 'null'::json)" for x in names) + ")"
_lines = r"list_filter(list_transform(string_split(regexp_replace(raw_text, '\r\n?', chr(10), 'g'), chr(10)), lambda x: regexp_replace(regexp_replace(x, '^[\s\x0b]+|[\s\x0b]+$', '', 'g'), '[ \t]+', ' ', 'g')), lambda x: x <> '')"
_lines2 = r"list_filter(list_transform(string_split(regexp_replace(regexp_replace(raw_text, '[ \t\x0b\f]+', ' ', 'g'), '\r\n?', chr(10), 'g'), chr(10)), lambda x: regexp_replace(x, '^[\s\x0b]+|[\s\x0b]+$', '', 'g')), lambda x: x <> '')"
_exp = "source_candidate_id, source_path, source_array_index"
_now = q.is_current("raw_is_current", "end_date_precision_raw")
_sp, _ep = q.date_precision("start_date_precision_raw"), q.date_precision("end_date_precision_raw", True, _now)
SQL = {
    "norm_identity_text": f"select distinct source_id, {q.identity_text('name')} as value from tmp_company_input",
    "norm_search_text": f"select {q.search_text('title')} as title, {q.search_text('location')} as location, count(*) as n from tmp_experience_input group by 1, 2",
    "norm_identity_url": f"select distinct source_id, {q.identity_url('linkedin_url')} as link, {q.identity_url('website')} as site from tmp_company_input",
    "norm_linkedin_username": f"select distinct id, {q.profile_username('u')} as username from (select source_id as id, linkedin_username as u from tmp_company_input union all select source_candidate_id, raw_linkedin_username from tmp_candidate_input)",
    "norm_candidate_linkedin_url": f"select distinct source_candidate_id, {q.candidate_url('raw_linkedin_url')} as url, {q.candidate_username_in_url('raw_linkedin_url')} as username from tmp_candidate_input",
    "norm_company_linkedin_url": f"select distinct source_id, {q.company_url('linkedin_url')} as url, {q.company_username_in_url('linkedin_url')} as username from tmp_company_input",
    "norm_email": f"select distinct source_row_id, {q.email_address('email_raw')} as email from tmp_email_input",
    "norm_company_name": f"select distinct source_id, {q.company_name('name')} as company from tmp_company_input",
    "source_precedence": f"select lower(trim(incoming_source)) as source, max({q.source_rank('incoming_source')}) as rank, count(*) as n, count(*) filter (where {q.replaces(chr(39) + 'resume' + chr(39), 'incoming_source', chr(39) + 'Private' + chr(39), 'company_type')}) as n_replacing from (select distinct * from tmp_company_input) group by 1",
    "experience_dates": f"select distinct {_exp}, {q.at_precision('start_date_raw', _sp)} as start_date, {_sp} as start_precision, {q.at_precision('end_date_raw', _ep)} as end_date, {_ep} as end_precision, {_now} as is_current from tmp_experience_input",
    "experience_hash": f"select distinct {_exp}, {q.experience_hash('resolved_candidate_id', 'title', q.trimmed('incoming_linkedin_id'), 'raw_company_name', 'start_date_raw', 'start_date_precision_raw', 'end_date_raw', 'end_date_precision_raw', 'raw_is_current')} as source_hash from tmp_experience_input",
    "document_identity_key": f"select distinct external_source_ref, {q.document_key(*_DOC)} as identity_key from tmp_source_document_input",
    "document_content_hash": f"select distinct external_source_ref, {q.content_hash('source_type', 'normalized_text', 'metadata_json')} as content_hash from tmp_source_document_input",
    "staff_count_range": f"select distinct source_id, {q.staff_range('staff_count', 'staff_count_range')} as staff_range, {q.identity_phase('linkedin_id', 'linkedin_username', 'linkedin_url')} as phase from tmp_company_input",
    "clean_website": f"select distinct source_id, {q.website('website')} as site from tmp_company_input",
    "clean_text_list": f"select distinct source_id, coalesce(array_to_string({q.text_list('industries')}, '|'), '') as industries, coalesce(array_to_string({q.text_list('specialties')}, '|'), '') as specialties from tmp_company_input",
    "parse_date_strings": "select o_orderkey, f.form, case when f.form < 4 then cast(o_orderdate as date) when f.form < 7 then cast(date_trunc('month', o_orderdate) as date) else cast(date_trunc('year', o_orderdate) as date) end as parsed, case when f.form < 4 then 'day' when f.form < 7 then 'month' else 'year' end as precision from orders, (select cast(unnest(range(8)) as integer) as form) f",
    "payload_dates": "with p as (select json_extract_string(raw_date_payload, '$.start') as s, json_extract_string(raw_date_payload, '$.end') as e from tmp_experience_input), t as (select case when s is null or trim(s) = '' then 'unknown' when length(s) = 10 then 'day' when length(s) = 7 then 'month' when length(s) = 4 then 'year' else 'unknown' end as start_precision, case when e is null or trim(e) = '' then 'unknown' when lower(e) in ('present', 'current', 'ongoing', 'now', 'today') then 'present' when length(e) = 10 then 'day' when length(e) = 7 then 'month' when length(e) = 4 then 'year' else 'unknown' end as end_precision, try_cast(rpad(s, 10, '-01-01') as date) as sd, try_cast(rpad(e, 10, '-01-01') as date) as ed from p) select start_precision, end_precision, count(*) as n, min(sd) as first_start, max(case when end_precision <> 'present' then ed end) as last_end from t group by 1, 2",
    "json_first_present": f"select distinct {_exp}, {q.blank_to_null(_first_sql(TITLES) + '->>' + chr(39) + '$' + chr(39))} as title, {q.blank_to_null('case json_type(k) when ' + chr(39) + 'OBJECT' + chr(39) + ' then k->>' + chr(39) + '$.name' + chr(39) + ' when ' + chr(39) + 'VARCHAR' + chr(39) + ' then k->>' + chr(39) + '$' + chr(39) + ' end')} as company from (select *, {_first_sql(COMPANIES)} as k from (select *, case when json_valid(raw_item) then raw_item::json end as j from tmp_experience_input))",
    "experience_flatten": "with t as (select distinct external_source_ref, case when json_valid(raw_payload) then raw_payload::json end as j from tmp_source_document_input), w as (select external_source_ref, case when json_type(j, '$.data.experience') = 'ARRAY' then 'experience' else 'workExperience' end as path, case when json_type(j, '$.data.experience') = 'ARRAY' then json_extract(j, '$.data.experience[*]') when json_type(j, '$.data.workExperience') = 'ARRAY' then json_extract(j, '$.data.workExperience[*]') end as items from t) select external_source_ref, path, cast(i - 1 as integer) as ordinal, json_extract_string(items[i], '$.title') as title from (select *, unnest(range(1, len(items) + 1)) as i from w)",
    "structural_emptiness": "select (coalesce(nullif(trim(title), ''), nullif(trim(description), ''), nullif(trim(location), ''), nullif(trim(raw_company_name), ''), nullif(trim(incoming_linkedin_id), ''), nullif(trim(incoming_linkedin_username), ''), nullif(trim(incoming_linkedin_url), ''), cast(start_date_raw as varchar), cast(end_date_raw as varchar)) is null and not coalesce(raw_is_current, false)) as empty, coalesce(candidate_skip_reason, 'none') as skip_reason, count(*) as n from tmp_experience_input group by 1, 2",
    "keyset_pages": f"select * from (select distinct {q.identity_phase('linkedin_id', 'linkedin_username', 'linkedin_url')} as phase, source_id from tmp_company_input) where (phase, source_id) > (0, '8') order by phase, source_id limit 500",
    "missing_column_projection": "select distinct source_row_id as row_id, email_raw as email, raw_email_type as kind, cast(null as boolean) as bounced, verification_attempts from tmp_email_input",
    "json_recordset": "select json_extract_string(e, '$.source_table') as source_table, count(*) as n, count(distinct json_extract_string(e, '$.source_id')) as n_ids, count(distinct json_extract_string(e, '$.raw_name')) as n_names from (select unnest(json_extract(source_record_refs, '$[*]')) as e from (select distinct source_record_refs from tmp_company_input)) group by 1",
    "boolish_values": "select case when raw_is_primary then true when coalesce(verification_attempts, 0) % 4 = 3 then null else false end as flag, count(*) as n from tmp_email_input group by 1",
    "line_texts": f"select external_source_ref, sha256(coalesce(array_to_string({_lines}, chr(10)), '')) as sha, length(replace(nullif(array_to_string({_lines2}, chr(10)), ''), chr(10) || '## ', chr(10) || chr(10) || '## ')) as n_chars from (select distinct external_source_ref, raw_text from tmp_source_document_input)",
}
QUERIES = {f.__name__: f for f in (norm_identity_text, norm_search_text, norm_identity_url, norm_linkedin_username, norm_candidate_linkedin_url, norm_company_linkedin_url, norm_email, norm_company_name, source_precedence, experience_dates, experience_hash, document_identity_key, document_content_hash, staff_count_range, clean_website, clean_text_list, parse_date_strings, payload_dates, json_first_present, experience_flatten, structural_emptiness, keyset_pages, missing_column_projection, json_recordset, boolish_values, line_texts)}
