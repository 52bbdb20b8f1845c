"""Queries of resolution, merge, mail and document operators over whole tables, and their SQL.

Existing records are those of the legacy backfill that are the first with each of their keys; all others come in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterflow.functions import normalize as n
from rosterflow.operators import documents, emails, experience, merge, resolve
from rosterflow.operators.joins import winners
from rosterflow.plans import duck as q
from rosterflow.plans.functions import _HASH
from rosterflow.runtime import written
from rosterflow.sources.tables import table

c = F.col
H = q.HOST


_COMPANY = ("source_id", "name", "linkedin_id", "linkedin_username", "linkedin_url", "incoming_source")
_PERSON = ("source_candidate_id", "raw_linkedin_username", "raw_linkedin_url", "legacy_source")


def _companies(spark: SparkSession, d: str, *fields: str) -> tuple[DataFrame, DataFrame]:
    # normalized once and existing ones told apart once; every lookup below reads the keys
    rows = written(resolve.company_keys(table(spark, d, "tmp_company_input").select(*_COMPANY, *fields).dropDuplicates(["source_id"]), H), "company_keys")
    old = F.coalesce(F.lower(F.trim("incoming_source")) == "legacy_backfill", F.lit(False))
    existing = winners(rows.where(old & ~c("clash")).withColumn("id", c("source_id")), ["lid", "uname", "url"], "id")
    return rows.where(~old), written(existing, "companies")


def resolve_company(spark: SparkSession, d: str) -> DataFrame:
    return resolve.resolve_companies(*_companies(spark, d))


def _candidates(spark: SparkSession, d: str, *fields: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, d, "tmp_candidate_input").select(*_PERSON, *fields).dropDuplicates(["source_candidate_id"])
    given, linked = n.profile_username(c("raw_linkedin_username"), H), n.candidate_username_in_url(c("raw_linkedin_url"), H)
    rows = rows.withColumns({"source_id": c("source_candidate_id"), "uname": F.coalesce(given, linked), "url": n.candidate_url(c("raw_linkedin_url"), H), "clash": F.coalesce(given != linked, F.lit(False))})
    rows = written(rows, "candidate_keys")
    existing = winners(rows.where("legacy_source = 'linkedin_import' and not clash").withColumn("id", c("source_id")), ["uname", "url"], "id")
    return rows, written(existing, "profiles")


def resolve_candidate(spark: SparkSession, d: str) -> DataFrame:
    return resolve.resolve_candidates(*_candidates(spark, d))


def ambiguity_evidence(spark: SparkSession, d: str) -> DataFrame:
    incoming, existing = _companies(spark, d)
    return resolve.evidence(resolve.resolve_companies(incoming, existing), incoming, existing, ["lid", "uname", "url", "nname"])


def ambiguity_log(spark: SparkSession, d: str) -> DataFrame:
    """Ambiguities of companies that are not open yet; those of resumes are taken to be open."""
    incoming, existing = _companies(spark, d)
    found = resolve.resolve_companies(incoming, existing).where("decision = 'ambiguous'").join(incoming.select("source_id", "incoming_source", "lid", "uname", "url"), "source_id")
    rows = found.select(F.lit("company").alias("entity_type"), "ambiguity_type", F.lower(F.trim("incoming_source")).alias("source_system"), c("source_id").alias("source_record_ref"), F.md5(F.concat_ws("|", F.coalesce("lid", F.lit("")), F.coalesce("uname", F.lit("")), F.coalesce("url", F.lit("")))).alias("input_hash"))
    return resolve.log_ambiguities(rows, rows.where("source_system = 'resume'").withColumn("status", F.lit("open")))


def company_name_sequential(spark: SparkSession, d: str) -> DataFrame:
    return resolve.name_sequence(*_companies(spark, d))


def company_sequence(spark: SparkSession, d: str) -> DataFrame:
    """All companies taken in order, each seeing what the earlier ones wrote."""
    incoming, existing = _companies(spark, d)
    phased = incoming.withColumn("phase", n.identity_phase(c("linkedin_id"), c("linkedin_username"), c("linkedin_url")))
    return resolve.resolve_in_sequence(phased, existing)


_FIELDS = {x: "text" for x in ("name", "normalized_name", "linkedin_id", "username", "linkedin_url", "url_normalized", "website", "description", "company_type", "staff_count_range", "headquarters_city", "headquarters_country", "logo_url", "enrichment_status")} | {"industries": "list", "specialties": "list", "staff_count": "value", "last_enrichment_sync": "value"}
_CANONICAL = {"normalized_name": "nname", "username": "uname", "url_normalized": "url"}


def _company_hits(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Existing companies, and all records that match one of them with its id."""
    stored = [x for x in _FIELDS if x not in (*_COMPANY, *_CANONICAL)]
    incoming, existing = _companies(spark, d, *stored, "source_record_refs")
    hits = resolve.resolve_companies(incoming, existing).where("decision = 'match_existing'").select("source_id", "matched_id")
    rows = incoming.withColumn("phase", n.identity_phase(c("linkedin_id"), c("linkedin_username"), c("linkedin_url"))).withColumns({f: c(x) for f, x in _CANONICAL.items()} | {"source": c("incoming_source")})
    found = rows.select("source_id", "phase", "source", "source_record_refs", *_FIELDS).join(hits, "source_id")
    return existing.withColumns({f: c(x) for f, x in _CANONICAL.items()} | {"source": c("incoming_source")}), found


def company_merge(spark: SparkSession, d: str) -> DataFrame:
    """Each existing company with all records that match it merged in, in order of phase and id, by source precedence."""
    existing, hits = _company_hits(spark, d)
    got = merge.fold(existing, hits, _FIELDS, ["phase", "source_id"])
    listed = lambda x: F.coalesce(F.array_join(x, "|", "~"), F.lit("")).alias(x)
    basis = F.when(n.trimmed(c("linkedin_id")).isNotNull(), "linkedin_id").when(c("username").isNotNull(), "linkedin_username").when(c("url_normalized").isNotNull(), "linkedin_url").otherwise("name")
    return got.select("id", "effective_action", "n_merged", *[listed(f) if k == "list" else c(f) for f, k in _FIELDS.items()], c("source").alias("data_source"), basis.alias("identity_basis"))


def company_refs(spark: SparkSession, d: str) -> DataFrame:
    """The references of each merged company and of all records merged into it, each once: a table, as there may be very many."""
    existing, hits = _company_hits(spark, d)
    hits = written(hits.select(c("matched_id").alias("id"), "source_record_refs"), "hits")
    rows = hits.select(*merge.refs(c("id"), c("source_record_refs"))).unionByName(existing.join(hits.select("id").distinct(), "id", "left_semi").select(*merge.refs(c("id"), c("source_record_refs"))))
    doc = F.parse_json("ref")
    return rows.distinct().select("id", *[F.try_variant_get(doc, f"$.{x}", "string").alias(x) for x in ("source_table", "source_id", "raw_name", "raw_linkedin_id")])


_PROFILE = {x: "text" for x in ("full_name", "first_name", "last_name", "username", "url_normalized", "headline", "summary", "location", "profile_picture_url", "phone", "education_summary", "linkedin_enrichment_status")} | {"education_schools": "list", "education_degrees": "list", "education_fields": "list", "top_skills": "list", "linkedin_enrichment_date": "value"}


def profile_merge(spark: SparkSession, d: str) -> DataFrame:
    """Profiles as resumes made them, with name and link only, and all candidates that match them merged in by source precedence.

    The order is that of creation and id. The link as displayed is that of the record whose normalized link stays.
    """
    incoming, existing = _candidates(spark, d, *[x for x in _PROFILE if x not in ("username", "url_normalized")], "legacy_created_at")
    hits = resolve.resolve_candidates(incoming, existing).where("decision = 'match_existing'").select("source_id", "matched_id")
    known = {"id", "full_name", "uname", "url", "raw_linkedin_url"}
    existing = existing.select(*[c(x) if x in known else F.lit("resume" if x == "legacy_source" else None).cast(existing.schema[x].dataType).alias(x) for x in existing.columns])
    shaped = lambda df: df.withColumns({"username": c("uname"), "source": c("legacy_source"), "link": F.when(c("url").isNotNull(), F.struct(c("url").alias("url"), c("raw_linkedin_url").alias("shown"))), "url_normalized": c("url"), "made": F.coalesce(F.unix_micros(c("legacy_created_at").cast("timestamp")), F.lit(2**62))})
    fields = _PROFILE | {"link": "value"}
    found = shaped(incoming).select("source_id", "made", "source", *fields).join(hits, "source_id")
    got = merge.fold(shaped(existing), found, fields, ["made", "source_id"])
    listed = lambda x: F.coalesce(F.array_join(x, "|", "~"), F.lit("")).alias(x)
    return got.select("id", "effective_action", "n_merged", *[listed(f) if k == "list" else c(f) for f, k in _PROFILE.items()], c("link.shown").alias("linkedin_url"), c("source").alias("data_source"))


def profile_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The profile table after the candidates that match by link or name fill its blanks; others are added."""
    cols = ("full_name", "headline", "location", "phone")
    incoming, existing = _candidates(spark, d, *cols)
    decided = resolve.resolve_candidates(incoming, existing)
    took = incoming.join(decided, "source_id")
    fresh = took.where("decision = 'create_new'").select(c("source_id").alias("id"), *cols)
    hits = took.where("decision = 'match_existing' and matched_id <> source_id").groupBy("matched_id").agg(*[F.min_by(x, F.when(n.trimmed(c(x)).isNotNull(), c("source_id"))).alias(f"new_{x}") for x in cols])
    filled = existing.join(hits, c("id") == c("matched_id")).select("id", *[F.coalesce(n.trimmed(c(x)), c(f"new_{x}")).alias(x) for x in cols])
    return merge.upsert(existing.select("id", *cols), filled.unionByName(fresh), "id")


def _mail(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = emails.email_rows(table(spark, d, "tmp_email_input"), table(spark, d, "tmp_candidate_input"))
    kept = emails.survivors(emails.unsuppressed(rows))
    claims = rows.where("quality = 'good'").groupBy("email").agg(F.min("candidate_id").alias("holder"))
    return rows, kept, claims


def email_survivors(spark: SparkSession, d: str) -> DataFrame:
    return _mail(spark, d)[1].select("candidate_id", "email", "row_id", "priority", "n_rows", "n_primary")


def email_lineage(spark: SparkSession, d: str) -> DataFrame:
    return emails.lineage(emails.unsuppressed(_mail(spark, d)[0]))


def email_fallback_suppression(spark: SparkSession, d: str) -> DataFrame:
    rows = _mail(spark, d)[0]
    return emails.unsuppressed(rows).groupBy("priority").agg(F.count("*").alias("n"), F.countDistinct("candidate_id").alias("n_candidates"))


def email_conflicts(spark: SparkSession, d: str) -> DataFrame:
    _, kept, claims = _mail(spark, d)
    return emails.conflicts(kept, claims).where("conflict").select("candidate_id", "email", "row_id", "holder", "n_candidates")


def email_primary_plan(spark: SparkSession, d: str) -> DataFrame:
    rows, kept, claims = _mail(spark, d)
    return emails.primary_plan(rows, emails.conflicts(kept, claims))


def email_merge(spark: SparkSession, d: str) -> DataFrame:
    """The first row of each candidate's address, completed by the best of its later rows."""
    return emails.merged(_mail(spark, d)[0])


def email_demotions(spark: SparkSession, d: str) -> DataFrame:
    """Addresses that stop being primary once each candidate's choice is made."""
    rows, kept, claims = _mail(spark, d)
    return emails.demotions(rows, emails.primary_plan(rows, emails.conflicts(kept, claims)))


def experience_match(spark: SparkSession, d: str) -> DataFrame:
    """Jobs of the nested history against those of the flat one of the same candidate."""
    rows = table(spark, d, "tmp_experience_input").dropDuplicates(["source_candidate_id", "source_path", "source_array_index"]).withColumn("company_id", n.trimmed(c("incoming_linkedin_id")))
    rows = rows.select(c("source_candidate_id").alias("candidate_id"), c("source_array_index").cast("string").alias("ref"), n.experience_hash(*[c("source_candidate_id") if x == "resolved_candidate_id" else c(x) for x in _HASH]).alias("hash"), "title", c("candidate_skip_reason").alias("skip"), "source_family", F.concat_ws("|", "source_candidate_id", "source_path", "source_array_index").alias("id"))
    return experience.match(rows.where("source_family = 'nested'"), rows.where("source_family = 'flat'"))


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return documents.keyed(table(spark, d, "tmp_source_document_input"))


def document_versions(spark: SparkSession, d: str) -> DataFrame:
    return documents.versions(_documents(spark, d).where("candidate_id is not null"))


def document_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Half of the documents, as they come in, against all of the other half, which are active; several of a family are ambiguous."""
    docs = written(_documents(spark, d).withColumn("id", c("external_source_ref")).withColumn("held", F.md5("external_source_ref") < "8"), "documents")
    active = docs.where("held and candidate_id is not null and kind is not null").select("id", "candidate_id", "kind", "identity_key", "content_hash", F.lit(1).alias("version"))
    return documents.decide(docs.where("not held"), active)


def document_apply(spark: SparkSession, d: str) -> DataFrame:
    """What the decisions write: new rows with their version, and rows that are active no longer."""
    return documents.applied(document_decisions(spark, d))


def section_text(spark: SparkSession, d: str) -> DataFrame:
    """Profile texts of candidates in sections, jobs included; their hash, length and the fields they come from."""
    rows = table(spark, d, "tmp_candidate_input").select("source_candidate_id", "headline", "summary", "location", "skills_text", "top_skills", "education_summary").dropDuplicates(["source_candidate_id"])
    title, company = n.line_text(c("title")), n.line_text(c("raw_company_name"))
    line = n.or_null(F.concat_ws("\n", F.concat(F.lit("company: "), company), F.concat(F.lit("title: "), title)))
    order = F.struct((~F.coalesce("raw_is_current", F.lit(False))).alias("past"), (-F.coalesce(F.unix_date("start_date_raw"), F.lit(-(10**6)))).alias("late"), "source_path", "source_array_index")
    jobs = table(spark, d, "tmp_experience_input").select("source_candidate_id", "source_path", "source_array_index", "title", "raw_company_name", "start_date_raw", "raw_is_current").dropDuplicates(["source_candidate_id", "source_path", "source_array_index"])
    jobs = jobs.select("source_candidate_id", order.alias("o"), line.alias("line"), F.when(c("raw_is_current"), F.struct(title.alias("title"), company.alias("company"))).alias("now"))
    work = jobs.groupBy("source_candidate_id").agg(F.array_sort(F.collect_list(F.when(c("line").isNotNull(), F.struct("o", "line")))).alias("lines"), F.min(F.when(c("now").isNotNull(), F.struct("o", "now"))).alias("current"))
    got = rows.join(work, "source_candidate_id", "left")
    skills = F.coalesce(n.line_text(c("skills_text")), n.or_null(F.array_join("top_skills", "\n")))
    sections = {"Headline": n.line_text(c("headline")), "Profile Summary": n.line_text(c("summary")), "Location": n.line_text(c("location")), "Current Title": c("current.now.title"), "Current Company": c("current.now.company"), "Skills": skills, "Education": n.line_text(c("education_summary")), "Work Experience": n.or_null(F.array_join(F.transform("lines", lambda x: x["line"]), "\n"))}
    text = documents.sectioned_text(list(sections.items()))
    used = F.array_join(F.array_compact(F.array(*[F.when(v.isNotNull(), F.lit(k)) for k, v in sections.items()])), "|")
    return got.select("source_candidate_id", F.md5(text).alias("text_md5"), F.length(text).cast("bigint").alias("n_chars"), used.alias("fields_used"))


def resolution_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Decisions of companies by decision, basis and kind of ambiguity, each on its own and together."""
    rows = resolve_company(spark, d)
    return rows.rollup("decision", "match_basis").agg(F.count("*").alias("n"), F.grouping_id().cast("bigint").alias("level"))


def resolution_samples(spark: SparkSession, d: str) -> DataFrame:
    """The first five records of each decision."""
    rows = resolve_company(spark, d)
    w = Window.partitionBy("decision").orderBy("source_id")
    return rows.withColumn("rn", F.row_number().over(w)).where("rn <= 5").select("decision", "source_id", c("rn").cast("bigint").alias("rn"))


def email_summary(spark: SparkSession, d: str) -> DataFrame:
    """Counts of all steps of the mail job, tagged and in order."""
    rows, kept, claims = _mail(spark, d)
    checked = emails.conflicts(kept, claims)
    a = rows.agg(F.count("*").alias("n")).select(F.lit(1).alias("step"), F.lit("rows").alias("what"), "n")
    b = kept.agg(F.sum(F.greatest(c("n_rows") - 1, F.lit(0))).alias("n")).select(F.lit(2).alias("step"), F.lit("collapsed").alias("what"), "n")
    e = checked.agg(F.count_if("conflict").alias("n")).select(F.lit(3).alias("step"), F.lit("conflicts").alias("what"), "n")
    return a.unionByName(b).unionByName(e).orderBy("step")


_KEYS = f"""
keyed as (select *, nullif(lower(trim(linkedin_id, ' ')), '') as lid, coalesce({q.profile_username('linkedin_username')}, {q.company_username_in_url('linkedin_url')}) as uname, {q.company_url('linkedin_url')} as url, {q.company_name('name')} as nname,
  coalesce({q.profile_username('linkedin_username')} <> {q.company_username_in_url('linkedin_url')}, false) as clash, coalesce(lower(trim(incoming_source, ' ')) = 'legacy_backfill', false) as old from (select distinct * from tmp_company_input)),
ranked as (select *, min(source_id) over (partition by lid) as f1, min(source_id) over (partition by uname) as f2, min(source_id) over (partition by url) as f3 from keyed where old and not clash),
existing as (select *, source_id as id from ranked where (lid is null or f1 = source_id) and (uname is null or f2 = source_id) and (url is null or f3 = source_id)),
incoming as (select * from keyed where not old),
names as (select nname, count(*) as n, min(id) as id from existing where nname is not null group by 1),
looked as (select i.*, a.id as a, b.id as b, b.lid as bl, u.id as u, u.lid as ul, m.n as mn, m.id as mid from incoming i left join existing a on a.lid = i.lid left join existing b on b.uname = i.uname left join existing u on u.url = i.url left join names m on m.nname = i.nname),
decided as (select *, case when clash then 'conflicting_incoming_linkedin_identity' when a <> b or a <> u or b <> u then 'conflicting_existing_strong_identity'
    when lid is not null and a is null and bl <> lid then 'linkedin_id_conflicts_with_username_match' when lid is not null and a is null and ul <> lid then 'linkedin_id_conflicts_with_url_match'
    when coalesce(lid, uname, url) is null and mn > 1 then 'multiple_normalized_name_matches' end as why from looked),
resolved as (select *, case when why is not null then 'ambiguous' when coalesce(a, b, u) is not null or (coalesce(lid, uname, url) is null and mn = 1) then 'match_existing' else 'create_new' end as decision,
  case when why is null then coalesce(a, b, u, case when coalesce(lid, uname, url) is null and mn = 1 then mid end) end as matched_id,
  case when why is not null then null when a is not null then 'linkedin_id' when b is not null and b = u then 'linkedin_username_and_url' when b is not null then 'linkedin_username' when u is not null then 'linkedin_url_normalized' when coalesce(lid, uname, url) is null and mn = 1 then 'normalized_name' end as match_basis, why as ambiguity_type from decided)
"""
_PKEYS = f"""
keyed as (select *, source_candidate_id as source_id, coalesce({q.profile_username('raw_linkedin_username')}, {q.candidate_username_in_url('raw_linkedin_url')}) as uname, {q.candidate_url('raw_linkedin_url')} as url,
  coalesce({q.profile_username('raw_linkedin_username')} <> {q.candidate_username_in_url('raw_linkedin_url')}, false) as clash from (select distinct * from tmp_candidate_input)),
ranked as (select *, min(source_id) over (partition by uname) as f2, min(source_id) over (partition by url) as f3 from keyed where legacy_source = 'linkedin_import' and not clash),
existing as (select *, source_id as id from ranked where (uname is null or f2 = source_id) and (url is null or f3 = source_id)),
looked as (select i.*, a.id as a, b.id as b, u.id as u from keyed i left join existing a on a.id = i.source_id left join existing b on b.uname = i.uname left join existing u on u.url = i.url),
resolved as (select *, case when clash then 'ambiguous' when a <> b or a <> u then 'ambiguous' when a is not null then 'match_existing' when b <> u then 'ambiguous' when coalesce(b, u) is not null then 'match_existing' else 'create_new' end as decision,
  case when clash then 'conflicting_incoming_linkedin_identity' when a <> b or a <> u then 'legacy_id_conflicts_with_linkedin_identity' when a is null and b <> u then 'conflicting_existing_linkedin_identity' end as ambiguity_type,
  case when clash or a <> b or a <> u or b <> u then null else coalesce(a, b, u) end as matched_id,
  case when clash or a <> b or a <> u or b <> u then null when a is not null then 'legacy_candidate_id' when b is not null and b = u then 'linkedin_username_and_url' when b is not null then 'linkedin_username' when u is not null then 'linkedin_url_normalized' end as match_basis from looked)
"""
_MAIL = f"""
direct as (select source_candidate_id as candidate_id, 0 as priority, source_row_id as row_id, {q.email_address('email_raw')} as email, coalesce(raw_is_primary, false) as is_primary, quality, result, verification_date, coalesce(verification_attempts, 0) as verification_attempts, last_verification_attempt, source_created_at as created, raw_email_type as kind, coalesce(raw_email_source, 'legacy_candidate_emails') as source, resultcode, subresult, raw_response
  from (select distinct * from tmp_email_input) where source_candidate_id in (select source_candidate_id from tmp_candidate_input)),
back as (select source_candidate_id, 1, source_candidate_id, {q.email_address('fallback_email_raw')}, false, null, null, null, 0, null, legacy_created_at, null, 'legacy_candidates_email_fallback', null, null, null from (select distinct * from tmp_candidate_input)),
rows_ as (select * from (select * from direct union all select * from back) where email is not null),
rows2 as (select * from rows_ r where priority = 0 or not exists (select 1 from rows_ o where o.priority = 0 and o.candidate_id = r.candidate_id and o.email = r.email)),
kept as (select *, count(*) over (partition by candidate_id, email) as n_rows, count(*) filter (where is_primary) over (partition by candidate_id, email) as n_primary,
  row_number() over (partition by candidate_id, email order by priority, is_primary desc, verification_date desc nulls last, verification_attempts desc, last_verification_attempt desc nulls last, created asc nulls last, row_id) as rn from rows2),
survivors as (select * from kept where rn = 1),
claims as (select email, min(candidate_id) as holder from rows_ where quality = 'good' group by 1),
checked as (select s.*, holder, w.n_candidates, case when holder is null then n_candidates > 1 else holder <> s.candidate_id end as conflict from survivors s join (select email, count(distinct candidate_id) as n_candidates from survivors group by 1) w using (email) left join claims using (email))
"""
_DOCS = f"""
docs as (select distinct external_source_ref, source_candidate_id as candidate_id, nullif(lower(trim(source_type, ' ')), '') as kind, {q.document_key('source_type', 'source_subtype', 'source_url', 'external_source_ref', 'metadata_json')} as identity_key, {q.content_hash('source_type', 'normalized_text', 'metadata_json')} as content_hash, effective_at from tmp_source_document_input)
"""


def _folded_sql(fields: dict[str, str]) -> str:
    """Merge in order as windows over each group, for the SQL: what outranks all before, field by field."""
    full = {"text": lambda x: f"{q.trimmed(x)} is not null", "list": lambda x: f"coalesce(len({x}), 0) > 0", "value": lambda x: f"{x} is not null"}
    cell = lambda f, k: f"case when count(*) filter (where over and {full[k](f'i_{f}')}) > 0 then last(i_{f} order by ord) filter (where over and {full[k](f'i_{f}')}) when {full[k](f'any_value(e_{f})')} then any_value(e_{f}) else coalesce(first(i_{f} order by ord) filter (where {full[k](f'i_{f}')}), any_value(e_{f})) end as {f}"
    every = {"source": "text", **fields}
    return f"""walk as (select *, {q.source_rank('i_source')} as rk, max({q.source_rank('i_source')}) over (partition by id order by ord rows between unbounded preceding and 1 preceding) as before from pairs),
marked as (select *, rk > coalesce(before, -1) and rk > {q.source_rank('e_source')} as over from walk),
folded as (select id, count(*) as n_merged, {', '.join(cell(f, k) for f, k in every.items())}, {', '.join(f'any_value(e_{f}) as e_{f}' for f in every)} from marked group by id),
acted as (select *, case when {' and '.join(f'{f} is not distinct from e_{f}' for f in every)} then 'no_op' else 'update' end as effective_action from folded)"""


def _pairs_sql(fields: dict[str, str], names: dict[str, str], order: str) -> str:
    every = ["source", *fields]
    return f"pairs as (select h.id, row_number() over (partition by h.id order by {order}) as ord, {', '.join(f'h.{names.get(f, f)} as i_{f}, e.{names.get(f, f)} as e_{f}' for f in every)} from hits h join existing e on e.id = h.id)"


_PRIMARY = """free as (select * from checked where not conflict), per as (select candidate_id, count(*) as n_emails, count(*) filter (where is_primary) as n_flagged, min(email) as one_email, first(email order by priority, verification_date desc nulls last, verification_attempts desc, last_verification_attempt desc nulls last, created asc nulls last, row_id) filter (where is_primary) as best from free group by 1), hints as (select candidate_id, min(email) as hint from rows_ where priority = 1 group by 1 having count(*) = 1), hinted as (select h.* from hints h join free f on f.candidate_id = h.candidate_id and f.email = h.hint)"""
_CHOICE = "case when n_flagged > 0 then best when n_emails = 1 then one_email else hint end"
_listed = lambda x: f"coalesce(array_to_string(list_transform({x}, lambda x: coalesce(x, '~')), '|'), '') as {x}"
_outs = lambda fields: ", ".join(_listed(f) if k == "list" else f for f, k in fields.items())
_KINDS = {"text": "varchar", "list": "varchar[]", "value": "timestamp"}
_CN = {**_CANONICAL, "source": "incoming_source"}
_PN = {"username": "uname", "url_normalized": "url", "source": "legacy_source"}
_UP = f"{q.source_rank('i.incoming_source')} > {q.source_rank('e.incoming_source')}"
_lines = lambda x: rf"nullif(array_to_string(list_filter(list_transform(string_split(regexp_replace({x}, '\r\n?', chr(10), 'g'), chr(10)), lambda x: regexp_replace(regexp_replace(x, '^[\s\x0b]+|[\s\x0b]+$', '', 'g'), '[ \t]+', ' ', 'g')), lambda x: x <> ''), chr(10)), '')"
_parts = (("Headline", _lines("headline")), ("Profile Summary", _lines("summary")), ("Location", _lines("location")), ("Current Title", "now_title"), ("Current Company", "now_company"), ("Skills", f"coalesce({_lines('skills_text')}, nullif(array_to_string(top_skills, chr(10)), ''))"), ("Education", _lines("education_summary")), ("Work Experience", "work"))
_section = " , ".join(f"'## {t}' || chr(10) || {v}" for t, v in _parts)
_used = ", ".join(f"case when {v} is not null then '{t}' end" for t, v in _parts)
_DECIDED = """act as (select * from docs where md5(external_source_ref) < '8' and candidate_id is not null and kind is not null),
inc as (select * from docs where md5(external_source_ref) >= '8' and candidate_id is not null and kind is not null),
byk as (select candidate_id, kind, identity_key, count(*) as kn, min(external_source_ref) as kid, min(content_hash) as kh from act where identity_key is not null group by 1, 2, 3),
byh as (select candidate_id, kind, content_hash, count(*) as hn, min(external_source_ref) as hid from act where kind <> 'resume' or identity_key is null group by 1, 2, 3),
anon as (select candidate_id, kind, count(*) as an from act where identity_key is null group by 1, 2),
led as (select i.*, kn, kid, kh, hn, hid, an from inc i left join byk using (candidate_id, kind, identity_key) left join byh using (candidate_id, kind, content_hash) left join anon using (candidate_id, kind)),
decided as (select external_source_ref,
  case when identity_key is not null then case when kn > 1 then 'ambiguous' when kn = 1 and kh = content_hash then 'no_op' when kn = 1 then 'supersede' else 'parallel' end when hn = 1 then 'no_op' when hn > 1 or (kind = 'resume' and an > 0) then 'ambiguous' else 'parallel' end as decision,
  case when identity_key is not null then case when kn = 1 then kid end when hn = 1 then hid end as matched_id,
  cast(case when identity_key is not null then case when kn > 1 then null when kn = 1 and kh <> content_hash then 2 else 1 end when hn = 1 then 1 when hn > 1 or (kind = 'resume' and an > 0) then null else 1 end as integer) as next_version,
  case when identity_key is not null then case when kn > 1 then case when kind = 'linkedin_profile' then 'multiple_active_linkedin_profiles' else 'multiple_active_document_identity_matches' end end when hn > 1 then case when kind = 'resume' then 'multiple_anonymous_resume_content_matches' else 'multiple_same_content_matches' end when hn is null and kind = 'resume' and an > 0 then 'anonymous_resume_identity_conflict' end as ambiguity_type from led)"""
SQL = {
    "resolve_company": f"with {_KEYS} select source_id, decision, matched_id, match_basis, ambiguity_type from resolved",
    "resolve_candidate": f"with {_PKEYS} select source_id, decision, matched_id, match_basis, ambiguity_type from resolved",
    "ambiguity_evidence": f"with {_KEYS}, hits as (select r.source_id, e.id from resolved r join existing e on r.decision = 'ambiguous' and (r.lid = e.lid or r.uname = e.uname or r.url = e.url or r.nname = e.nname)) select r.source_id, r.ambiguity_type, coalesce((select string_agg(distinct h.id, '|' order by h.id) from hits h where h.source_id = r.source_id), '') as matched_record_ids from resolved r where decision = 'ambiguous'",
    "ambiguity_log": f"with {_KEYS} select distinct 'company' as entity_type, ambiguity_type, coalesce(lower(trim(incoming_source, ' ')), '') as source_system, source_id as source_record_ref, md5(coalesce(lid, '') || '|' || coalesce(uname, '') || '|' || coalesce(url, '')) as input_hash from resolved where decision = 'ambiguous' and coalesce(lower(trim(incoming_source, ' ')), '') <> 'resume'",
    "company_name_sequential": f"with {_KEYS}, only_names as (select *, min(source_id) over (partition by nname) as maker from incoming where coalesce(lid, uname, url) is null and nname is not null and not clash) select o.source_id, o.nname, case when coalesce(m.n, 0) > 1 then 'ambiguous' when m.n is null and o.source_id = o.maker then 'create_new' else 'match_existing' end as action, case when coalesce(m.n, 0) <= 1 then coalesce(m.id, o.maker) end as company_id from only_names o left join names m using (nname)",
    "company_merge": f"with {_KEYS}, hits as (select r.* exclude (id), matched_id as id from (select *, null as id from resolved) r where decision = 'match_existing'), {_pairs_sql(_FIELDS, _CN, f"{q.identity_phase('h.linkedin_id', 'h.linkedin_username', 'h.linkedin_url')}, h.source_id")}, {_folded_sql(_FIELDS)} select id, effective_action, n_merged, {_outs(_FIELDS)}, source as data_source, case when {q.trimmed('linkedin_id')} is not null then 'linkedin_id' when username is not null then 'linkedin_username' when url_normalized is not null then 'linkedin_url' else 'name' end as identity_basis from acted",
    "company_refs": f"with {_KEYS}, hits as (select matched_id as id, source_record_refs from resolved where decision = 'match_existing'), every as (select * from hits union all select id, source_record_refs from existing where id in (select id from hits)) select distinct id, {', '.join(f"json_extract_string(r, '$.{x}') as {x}" for x in ('source_table', 'source_id', 'raw_name', 'raw_linkedin_id'))} from (select id, unnest(case json_type(source_record_refs) when 'ARRAY' then json_extract(source_record_refs, '$[*]') when 'OBJECT' then [cast(source_record_refs as json)] end) as r from every)",
    "profile_merge": f"with {_PKEYS}, hits as (select r.* exclude (id), matched_id as id from (select *, null as id from resolved) r where decision = 'match_existing'), early as (select id, full_name, uname, url, raw_linkedin_url, 'resume' as legacy_source, {', '.join(f'cast(null as {_KINDS[k]}) as {f}' for f, k in _PROFILE.items() if f not in ('full_name', 'username', 'url_normalized'))} from existing), {_pairs_sql(_PROFILE | {'shown': 'value'}, _PN | {'shown': 'shown'}, 'h.legacy_created_at asc nulls last, h.source_id').replace('h.shown', 'case when h.url is not null then struct_pack(url := h.url, shown := h.raw_linkedin_url) end').replace('e.shown', 'case when e.url is not null then struct_pack(url := e.url, shown := e.raw_linkedin_url) end').replace('join existing e', 'join early e')}, {_folded_sql(_PROFILE | {'shown': 'value'})} select id, effective_action, n_merged, {_outs(_PROFILE)}, shown.shown as linkedin_url, source as data_source from acted",
    "profile_upsert": f"with {_PKEYS}, hits as (select matched_id, {', '.join(f'min_by({x}, source_id) filter (where {q.trimmed(x)} is not null) as n_{x}' for x in ('full_name', 'headline', 'location', 'phone'))} from resolved where decision = 'match_existing' and matched_id <> source_id group by 1) select e.id, {', '.join(f'case when h.matched_id is null then e.{x} else coalesce({q.trimmed(f'e.{x}')}, n_{x}) end as {x}' for x in ('full_name', 'headline', 'location', 'phone'))} from existing e left join hits h on h.matched_id = e.id union all select source_id, full_name, headline, location, phone from resolved where decision = 'create_new'",
    "email_survivors": f"with {_MAIL} select candidate_id, email, row_id, priority, n_rows, n_primary from survivors",
    "email_lineage": f"with {_MAIL} select candidate_id, email, string_agg(row_id, '|' order by rn) as contributors from kept group by 1, 2",
    "email_fallback_suppression": f"with {_MAIL} select priority, count(*) as n, count(distinct candidate_id) as n_candidates from rows2 group by 1",
    "email_conflicts": f"with {_MAIL} select candidate_id, email, row_id, holder, n_candidates from checked where conflict",
    "email_primary_plan": f"with {_MAIL}, {_PRIMARY} select candidate_id, n_emails, n_flagged, case when n_flagged = 1 then 'flagged' when n_flagged > 1 then 'best_flagged' when n_emails = 1 then 'only' when hint is not null then 'fallback' else 'none' end as rule, {_CHOICE} as primary_email from per left join hinted using (candidate_id)",
    "email_merge": f"with {_MAIL}, seen as (select *, row_number() over (partition by candidate_id, email order by created asc nulls last, row_id) as nth from rows_), o as (select * from seen where nth = 1), w as (select *, row_number() over (partition by candidate_id, email order by priority, is_primary desc, verification_date desc nulls last, verification_attempts desc, last_verification_attempt desc nulls last, created asc nulls last, row_id) as best from seen where nth > 1) select o.candidate_id, o.email, o.row_id, w.row_id as merged_row_id, {', '.join(f"case when {q.trimmed(f'o.{x}')} is not null then o.{x} else coalesce({q.trimmed(f'w.{x}')}, o.{x}) end as {x}" for x in ('kind', 'source', 'quality', 'result', 'resultcode', 'subresult'))}, greatest(o.verification_date, w.verification_date) as verification_date, greatest(o.verification_attempts, w.verification_attempts) as verification_attempts, greatest(o.last_verification_attempt, w.last_verification_attempt) as last_verification_attempt, md5(coalesce(o.raw_response, w.raw_response, '')) as response_md5 from o join w on w.best = 1 and w.candidate_id = o.candidate_id and w.email = o.email",
    "email_demotions": f"with {_MAIL}, {_PRIMARY}, plan as (select candidate_id, {_CHOICE} as choice from per left join hinted using (candidate_id)) select r.candidate_id, r.email, choice as primary_email, count(*) as n_rows from rows_ r join plan p on p.candidate_id = r.candidate_id where r.is_primary and ((choice is not null and r.email <> choice) or (choice is null and r.source in ('legacy_candidate_emails', 'legacy_candidates_email_fallback'))) group by 1, 2, 3",
    "experience_match": f"with r as (select distinct source_candidate_id as candidate_id, cast(source_array_index as varchar) as ref, {q.experience_hash('source_candidate_id', 'title', q.trimmed('incoming_linkedin_id'), 'raw_company_name', 'start_date_raw', 'start_date_precision_raw', 'end_date_raw', 'end_date_precision_raw', 'raw_is_current')} as hash, title, candidate_skip_reason as skip, source_family, source_candidate_id || '|' || source_path || '|' || source_array_index as id from tmp_experience_input), x as (select * from r where source_family = 'flat'), a as (select candidate_id, ref, count(*) as n, min(id) as id, min_by(hash, id) as h, min_by(title, id) as t from x group by 1, 2), b as (select candidate_id, hash, count(*) as n, min(id) as id, min_by(title, id) as t from x group by 1, 2), j as (select i.*, a.id as aid, a.n as an, a.h as ah, b.id as bid, b.n as bn, case when a.id is not null then a.t else b.t end as old_title from r i left join a on a.candidate_id = i.candidate_id and a.ref = i.ref left join b on b.candidate_id = i.candidate_id and b.hash = i.hash where i.source_family = 'nested'), k as (select *, {q.search_text('old_title')} is distinct from {q.search_text('title')} and title is not null as retitled from j), l as (select *, case when skip is not null then 'skip' when an > 1 or bn > 1 or coalesce(aid <> bid, false) then 'ambiguous' when coalesce(aid, bid) is null then 'create_new' when retitled or coalesce(ah <> hash, false) then 'match_existing' else 'no_op' end as action from k) select candidate_id, ref, action, case when action in ('match_existing', 'no_op') then coalesce(aid, bid) end as matched_id, case when action = 'match_existing' then case when retitled then title else old_title end end as new_title from l",
    "document_versions": f"with {_DOCS}, o as (select *, lag(content_hash) over w as before, lead(external_source_ref) over w as after from docs where candidate_id is not null window w as (partition by candidate_id, kind, identity_key order by effective_at asc nulls last, external_source_ref)) select external_source_ref, candidate_id, kind, case when before is null then 'insert' when content_hash <> before then 'supersede' else 'no_op' end as action, cast(sum(case when content_hash is distinct from before then 1 else 0 end) over (partition by candidate_id, kind, identity_key order by effective_at asc nulls last, external_source_ref) as bigint) as version, after is null as is_last from o",
    "document_decisions": f"with {_DOCS}, {_DECIDED} select external_source_ref, decision, matched_id, next_version, ambiguity_type from decided",
    "document_apply": f"with {_DOCS}, {_DECIDED} select external_source_ref, case decision when 'no_op' then 'keep' when 'ambiguous' then 'log' else 'insert' end as change, next_version as version, decision <> 'ambiguous' and decision <> 'no_op' as is_active from decided union all select matched_id, 'deactivate', min(next_version - 1), false from decided where decision = 'supersede' group by 1",
    "section_text": f"with e as (select distinct on (source_candidate_id, source_path, source_array_index) *, {_lines('title')} as t, {_lines('raw_company_name')} as k from tmp_experience_input), w as (select *, nullif(concat_ws(chr(10), 'company: ' || k, 'title: ' || t), '') as line, row_number() over (partition by source_candidate_id order by coalesce(raw_is_current, false) desc, coalesce(start_date_raw, date '0001-01-01') desc, source_path, source_array_index) as rn from e), j as (select source_candidate_id, nullif(string_agg(line, chr(10) order by rn), '') as work, arg_min({{'t': t, 'k': k}}, rn) filter (where raw_is_current) as now from w group by 1), p as (select distinct c.*, work, now.t as now_title, now.k as now_company from (select distinct * from tmp_candidate_input) c left join j using (source_candidate_id)) select source_candidate_id, md5(t) as text_md5, length(t) as n_chars, array_to_string(list_filter([{_used}], lambda x: x is not null), '|') as fields_used from (select *, nullif(array_to_string(list_filter([{_section}], lambda x: x is not null), chr(10) || chr(10)), '') as t from p)",
    "resolution_histogram": f"with {_KEYS} select decision, match_basis, count(*) as n, cast(grouping(decision, match_basis) as bigint) as level from resolved group by rollup (decision, match_basis)",
    "resolution_samples": f"with {_KEYS} select decision, source_id, rn from (select decision, source_id, row_number() over (partition by decision order by source_id) as rn from resolved) where rn <= 5",
    "email_summary": f"with {_MAIL} select 1 as step, 'rows' as what, count(*) as n from rows_ union all select 2, 'collapsed', cast(sum(greatest(n_rows - 1, 0)) as bigint) from survivors union all select 3, 'conflicts', count(*) filter (where conflict) from checked",
}
QUERIES = {f.__name__: f for f in (resolve_company, resolve_candidate, ambiguity_evidence, ambiguity_log, company_name_sequential, company_sequence, company_merge, company_refs, profile_merge, profile_upsert, email_survivors, email_lineage, email_fallback_suppression, email_conflicts, email_primary_plan, email_merge, email_demotions, experience_match, document_versions, document_decisions, document_apply, section_text, resolution_histogram, resolution_samples, email_summary)}
