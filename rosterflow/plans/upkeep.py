"""Queries of payload values, open ambiguities, corpus upkeep, hygiene and evaluation over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterflow.functions import normalize as n
from rosterflow.functions import payloads as p
from rosterflow.operators import quality, resolve
from rosterflow.operators import retrieval as r
from rosterflow.operators.joins import lookup
from rosterflow.plans import duck as q
from rosterflow.plans import retrieval as base
from rosterflow.plans.entities import _KEYS, _companies
from rosterflow.sources.tables import table

c = F.col
_EXP = ("source_candidate_id", "source_path", "source_array_index")


def _jobs_once(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(spark, d, "tmp_experience_input").select(*_EXP, *columns).dropDuplicates(list(_EXP))


def item_dates(spark: SparkSession, d: str) -> DataFrame:
    """Start and end of every work history item, in whichever member and shape."""
    doc = F.try_parse_json("raw_item")
    start, end = p.date_value(p.first_present(doc, p.STARTS), False), p.date_value(p.first_present(doc, p.ENDS), True)
    rows = _jobs_once(spark, d, "raw_item").select(*_EXP, start.alias("s"), end.alias("e"))
    return rows.select(*_EXP, c("s.date").alias("start_date"), c("s.precision").alias("start_precision"), c("e.date").alias("end_date"), c("e.precision").alias("end_precision"))


def company_inputs(spark: SparkSession, d: str) -> DataFrame:
    """Name, id, user name and link of the company of every item, on the item or in its company object."""
    return _jobs_once(spark, d, "raw_item").select(*_EXP, p.company_inputs(F.try_parse_json("raw_item")).alias("x")).select(*_EXP, c("x.name").alias("company"), c("x.id").alias("company_id"), c("x.username").alias("username"), c("x.url").alias("url"))


def payload_texts(spark: SparkSession, d: str) -> DataFrame:
    """All document payloads written out as text."""
    got = p.formatted_payloads(table(spark, d, "tmp_source_document_input").select("external_source_ref", "raw_payload").dropDuplicates(["external_source_ref"]), "external_source_ref", "raw_payload")
    return got.select(c("key").alias("external_source_ref"), F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"))


def fallback_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Effective time and fallback payload of every candidate; two of its members read back."""
    rows = table(spark, d, "tmp_candidate_input").dropDuplicates(["source_candidate_id"])
    used = F.array_compact(F.array(*[F.when(n.trimmed(c(x)).isNotNull(), F.lit(x)) for x in ("headline", "summary", "location", "skills_text")]))
    doc = F.parse_json(p.fallback_payload(c("source_candidate_id"), used, {x: c(x) for x in ("headline", "summary", "location", "skills_text", "top_skills", "education_summary")}))
    at = p.effective_at(c("linkedin_enrichment_date"), c("legacy_updated_at"), c("legacy_created_at"))
    return rows.select("source_candidate_id", at.alias("effective_at"), F.variant_get(doc, "$.raw_source_fields.headline", "string").alias("headline"), F.size(F.variant_get(doc, "$.source_fields_used", "array<string>")).cast("bigint").alias("n_used"))


def ambiguity_renewals(spark: SparkSession, d: str) -> DataFrame:
    """Ambiguous companies put into the log: the newest open entry of the same record is renewed, else one is added.

    Those with an even last digit are taken to be open already with an older input, and closed once since.
    """
    incoming, existing = _companies(spark, d)
    found = resolve.resolve_companies(incoming, existing).where("decision = 'ambiguous'")
    new = found.select(F.lit("company").alias("entity_type"), F.lit("companies").alias("source_system"), c("source_id").alias("source_record_ref"), F.md5("ambiguity_type").alias("input_hash"))
    held = new.where("conv(right(source_record_ref, 1), 16, 10) % 2 = 0").drop("input_hash")
    entry = lambda mark, status, made: held.withColumns({"id": F.concat(F.lit(mark), "source_record_ref"), "status": F.lit(status), "created": F.lit(made)})
    return resolve.renew_ambiguities(new, entry("old:", "open", 1).unionByName(entry("shut:", "closed", 2)))


def provenance(spark: SparkSession, d: str) -> DataFrame:
    """How each company record was matched, as nested JSON; read back."""
    incoming, existing = _companies(spark, d)
    got = resolve.resolve_companies(incoming, existing).join(incoming.select("source_id", "name"), "source_id")
    match = F.struct("decision", "match_basis", "matched_id", "ambiguity_type")
    doc = F.parse_json(F.to_json(F.struct(F.lit("companies").alias("source_table"), "source_id", c("name").alias("raw_name"), match.alias("match")), {"ignoreNullFields": "false"}))
    return got.select("source_id", F.variant_get(doc, "$.raw_name", "string").alias("raw_name"), F.variant_get(doc, "$.match.decision", "string").alias("decision"), F.variant_get(doc, "$.match.match_basis", "string").alias("match_basis"))


# Fixed order: kinds of sections of job descriptions and words by which a paragraph is told, else it is context.
JD = (("must_have", "must|required|requires|essential|erforderlich|exigé|requis"), ("preferred", "preferred|plus|ideally|bonus|wünschenswert|souhaité"), ("responsibilities", "responsib|you will|duties|lead|manage|build|aufgaben|missions"))


def jd_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of job descriptions as chunks: the first is the summary, the others are told by their words."""
    rows = table(spark, d, "documents").where("source = 'jd'").select("doc_id", F.posexplode(F.filter(F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n\n+"), lambda x: F.trim(F.replace(x, F.lit("\n"), F.lit(" "))) != "")).alias("chunk_index", "chunk"))
    kind = F.when(c("chunk_index") == 0, "summary")
    for name, words in JD:
        kind = kind.when(F.lower("chunk").rlike(words), name)
    return rows.select("doc_id", "chunk_index", kind.otherwise("domain_context").alias("kind"), F.md5("chunk").alias("md5"), F.length("chunk").alias("char_count"))


def reference_snapshot_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Of each candidate as a reference: the current role, the three latest jobs and the skills, as frozen chunks."""
    jobs = _jobs_once(spark, d, "title", "raw_company_name", "start_date_raw", "raw_is_current").where("source_candidate_id is not null and title is not null")
    order = [(~F.coalesce("raw_is_current", F.lit(False))), c("start_date_raw").desc_nulls_last(), "title", "source_path", "source_array_index"]
    w = Window.partitionBy("source_candidate_id").orderBy(*order)
    top = jobs.withColumn("rn", F.row_number().over(w)).where("rn <= 3")
    text = F.concat_ws(" - ", "title", "raw_company_name")
    chunks = top.select("source_candidate_id", c("rn").cast("int").alias("position"), F.when(F.coalesce("raw_is_current", F.lit(False)) & (c("rn") == 1), "current_role").otherwise("experience").alias("kind"), F.md5(text).alias("md5"))
    people = table(spark, d, "tmp_candidate_input").dropDuplicates(["source_candidate_id"]).where("size(top_skills) > 0")
    skills = people.select("source_candidate_id", F.lit(4).alias("position"), F.lit("skills").alias("kind"), F.md5(F.array_join("top_skills", ", ")).alias("md5"))
    return chunks.unionByName(skills)


# Priorities of sources, least first; others come last.
PRIORITY = {"linkedin_profile": 10, "resume": 20, "recruiter_note_raw": 5}


def chunk_metadata(spark: SparkSession, d: str) -> DataFrame:
    """What search needs of each chunk: size, estimate of tokens, priority and trust of its source, whether it is searchable."""
    rows = table(spark, d, "tmp_source_document_input").select("external_source_ref", "source_type", "trust_level", "candidate_skip_reason").dropDuplicates(["external_source_ref"])
    rank = F.create_map(*[F.lit(x) for pair in PRIORITY.items() for x in pair])[F.lower(F.trim("source_type"))]
    chunks = base.candidate_chunks(spark, d).join(rows, "external_source_ref")
    return chunks.select("external_source_ref", "chunk_index", "char_count", "token_estimate", F.coalesce(rank, F.lit(0)).alias("source_priority"), "trust_level", (c("candidate_skip_reason").isNull() & (c("char_count") > 0)).alias("is_searchable"))


def embedding_store(spark: SparkSession, d: str) -> DataFrame:
    """One row for each chunk, model and version: the latest active one; how many others it replaces."""
    rows = table(spark, d, "candidate_chunk_embeddings").select("id", "chunk_id", "model_name", "model_version", "is_active", "generated_at").dropDuplicates(["id"])
    best = F.min(F.struct((~F.coalesce("is_active", F.lit(False))).alias("off"), c("generated_at").isNull().alias("never"), (-F.unix_micros(c("generated_at").cast("timestamp"))).alias("age"), "id")).alias("b")
    return rows.groupBy("chunk_id", "model_name", "model_version").agg(best, F.count("*").alias("n")).select("chunk_id", "model_name", "model_version", c("b.id").alias("id"), (~c("b.off")).alias("is_active"), (c("n") - 1).alias("n_replaced"))


def chunk_vs_candidate(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of each job by their best chunk against their mean vector: scores of both and which is higher."""
    vectors = base._embeddings(spark, d)
    long = vectors.select("candidate_id", F.posexplode("embedding").alias("i", "x"))
    means = long.groupBy("candidate_id", "i").agg(F.avg(c("x").cast("double")).alias("x")).groupBy("candidate_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda v: v["x"]).alias("embedding"))
    mean = r.scores(base._jobs(spark, d), means, "vec_id", "candidate_id", "embedding", -2.0, None).select("query_id", c("vector_id").alias("candidate_id"), base._cut("score").alias("mean_score"))
    hits = r.scores(base._jobs(spark, d), vectors, "vec_id", "vec_id", "embedding", -2.0, None)
    chunk = hits.groupBy("query_id", (c("vector_id") % 100).alias("candidate_id")).agg(F.max("score").alias("score")).withColumn("chunk_score", base._cut("score"))
    return chunk.join(mean, ["query_id", "candidate_id"]).select("query_id", "candidate_id", "chunk_score", "mean_score")


def retrieval_eval(spark: SparkSession, d: str) -> DataFrame:
    """Good ones among the ten best of each job by three strategies: the job alone, with its best hit as reference, with weights of sources.

    A job's reference is the vector nearest to it; with one reference both count 60 to 40. Every seventh vector stands for a lighter source.
    """
    vectors = table(spark, d, "embeddings").select("vec_id", "label", "embedding")
    jobs = base._jobs(spark, d).select("vec_id", "embedding")
    own = r.scores(jobs, vectors, "vec_id", "vec_id", "embedding", -2.0, None).where("query_id <> vector_id")
    nearest = own.groupBy("query_id").agg(F.min(F.struct((-c("score")).alias("s"), "vector_id")).alias("b")).select(c("query_id").alias("job"), c("b.vector_id").alias("vec_id"))
    refs = r.scores(nearest.join(vectors, "vec_id").dropDuplicates(["vec_id"]), vectors, "vec_id", "vec_id", "embedding", -2.0, None)
    both = own.join(nearest.toDF("query_id", "ref"), "query_id").join(refs.select(c("query_id").alias("ref"), "vector_id", c("score").alias("ref_score")), ["ref", "vector_id"])
    light = F.when(c("vector_id") % 7 == 0, 0.8).otherwise(1.0)
    ways = F.array(*[F.struct(F.lit(name).alias("strategy"), F.round(score, 6).alias("value")) for name, score in (("job", c("score")), ("job_and_reference", r.weight(F.lit(1), 1) * c("score") + r.weight(F.lit(1), 2) * c("ref_score")), ("source_weighted", light * c("score")))])
    ranked = both.select("query_id", "vector_id", F.inline(ways)).withColumn("rn", F.row_number().over(Window.partitionBy("query_id", "strategy").orderBy(F.desc("value"), "vector_id"))).where("rn <= 10")
    labels = vectors.select(c("vec_id").alias("vector_id"), "label")
    asked = labels.select(c("vector_id").alias("query_id"), c("label").alias("wanted"))
    return ranked.join(labels, "vector_id").join(asked, "query_id").groupBy("query_id", "strategy").agg(F.count_if(c("label") == c("wanted")).alias("n_good"), F.count("*").alias("n_hits"))


def reference_import(spark: SparkSession, d: str) -> DataFrame:
    """References named by profile links in documents: attached to the candidate with that link, else created; links that say nothing are skipped."""
    rows = table(spark, d, "tmp_source_document_input").select("external_source_ref", "raw_linkedin_url", "title").dropDuplicates(["external_source_ref"]).withColumn("url", n.candidate_url(c("raw_linkedin_url"), q.HOST))
    people = table(spark, d, "tmp_candidate_input").select("source_candidate_id", "raw_linkedin_url").dropDuplicates(["source_candidate_id"]).select("source_candidate_id", n.candidate_url(c("raw_linkedin_url"), q.HOST).alias("known")).where("known is not null").groupBy("known").agg(F.min("source_candidate_id").alias("candidate_id"))
    got = lookup(rows, "url", people, "known", "external_source_ref")
    action = F.when(c("url").isNull(), "skip").when(c("candidate_id").isNotNull(), "attach").otherwise("create")
    return got.select("external_source_ref", action.alias("action"), "candidate_id", F.coalesce(n.search_text(c("title")), F.lit("unlabelled")).alias("archetype"))


def promoted_signals(spark: SparkSession, d: str) -> DataFrame:
    """Latest value of each user's signal; earlier ones are superseded, errors are never promoted."""
    rows = table(spark, d, "events").where("event_type <> 'error'")
    last = rows.groupBy("user_id", "event_type").agg(F.max(F.struct("ts", "event_id", "value")).alias("x"), F.count("*").alias("n"))
    return last.select("user_id", "event_type", "x.event_id", "x.value", (c("n") - 1).alias("n_superseded"))


def enrichment_freshness(spark: SparkSession, d: str) -> DataFrame:
    """Age of each company's enrichment against the newest of all, and whether a fresh import may overwrite it by rank."""
    rows = table(spark, d, "tmp_company_input").select("source_id", "last_enrichment_sync", "incoming_source").dropDuplicates(["source_id"])
    newest = rows.agg(F.max("last_enrichment_sync").alias("newest"))
    age = F.datediff("newest", "last_enrichment_sync")
    state = F.when(age.isNull(), "never").when(age > 365, "stale").otherwise("fresh")
    return rows.crossJoin(F.broadcast(newest)).select("source_id", age.alias("age_days"), state.alias("state"), (n.source_rank(c("incoming_source")) < n.SOURCE_RANKS["linkedin_import"]).alias("may_overwrite"))  # one row


def note_promotion(spark: SparkSession, d: str) -> DataFrame:
    """What counts of each candidate's notes: the latest approved summary with its weight, else raw notes with theirs."""
    rows = table(spark, d, "documents").where("source in ('recruiter_note_raw', 'recruiter_note_summary') and source_candidate_id is not null")
    best = F.min(F.struct((c("source") == "recruiter_note_raw").alias("raw"), c("effective_at").isNull().alias("never"), (-F.unix_micros(c("effective_at").cast("timestamp"))).alias("age"), "doc_id", "source")).alias("b")
    weights = F.create_map(*[F.lit(x) for pair in r.SOURCE_WEIGHTS.items() for x in pair])
    return rows.groupBy("source_candidate_id").agg(best, F.count_if(c("source") == "recruiter_note_raw").alias("n_raw")).select("source_candidate_id", c("b.doc_id").alias("doc_id"), c("b.source").alias("source"), weights[c("b.source")].alias("weight"), "n_raw")


def run_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counts by week, kind and both, as runs by strategy and status would be counted."""
    rows = table(spark, d, "events").select(F.date_trunc("month", "ts").cast("date").alias("month"), "event_type", "value")
    return rows.cube("month", "event_type").agg(F.count("*").alias("n"), F.count("value").alias("n_valued"), F.grouping_id().cast("bigint").alias("level"))


def model_costs(spark: SparkSession, d: str) -> DataFrame:
    """Vectors, numbers and share of usable ones by model and version."""
    rows = table(spark, d, "candidate_chunk_embeddings").dropDuplicates(["id"])
    good = F.coalesce(c("is_active") & (F.size("embedding") == c("embedding_dimensions")), F.lit(False))
    return rows.groupBy("model_name", "model_version").agg(F.count("*").alias("n_vectors"), F.sum(F.coalesce(F.size("embedding"), F.lit(0)).cast("bigint")).alias("n_numbers"), F.round(F.avg(good.cast("double")), 6).alias("usable_share"))


def existence_check(spark: SparkSession, d: str) -> DataFrame:
    """Columns that later steps rely on and their tables lack, and vector columns where none are allowed; no row means all is well."""
    want = {"tmp_company_input": ("source_id", "name", "parent_company"), "tmp_candidate_input": ("source_candidate_id",), "documents": ("doc_id", "text", "embedding_model")}
    frames = {x: table(spark, d, x) for x in want}
    return quality.missing_columns(spark, frames, want).unionByName(quality.vector_columns(spark, {x: table(spark, d, x) for x in ("embeddings", "tmp_company_input", "tmp_candidate_input")}))


_h = lambda x: f"json_extract(j, '$.{x}')"
_pres = lambda names, j="j": "coalesce(" + ", ".join(f"nullif(json_extract({j}, '$.{x}'), 'null'::json)" for x in names) + ")"
_scal = lambda x: f"case when json_type({x}) not in ('OBJECT', 'ARRAY') then {q.blank_to_null(f'({x} ->> chr(36))')} end"
_either = lambda names: f"coalesce({_scal(_pres(names))}, case when json_type(k) = 'OBJECT' then {_scal(_pres(names, 'k'))} end)"
_dedup = "(select distinct source_candidate_id, source_path, source_array_index, raw_item from tmp_experience_input)"
_SIM = base._sim
_low = "lower(chunk)"
SQL = {
    "company_inputs": f"select source_candidate_id, source_path, source_array_index, case when json_type(k) = 'OBJECT' then coalesce({', '.join(_scal(f'json_extract(k, {chr(39)}$.{x}{chr(39)})') for x in p.COMPANY_NAMES)}) else {_scal('k')} end as company, {_either(p.COMPANY_IDS)} as company_id, {_either(p.COMPANY_USERS)} as username, {_either(p.COMPANY_LINKS)} as url from (select *, {_pres(p.COMPANIES)} as k from (select *, case when json_valid(raw_item) then raw_item::json end as j from {_dedup}))",
    "fallback_payloads": f"select distinct source_candidate_id, coalesce(linkedin_enrichment_date, legacy_updated_at, legacy_created_at) as effective_at, headline, cast({' + '.join(f'({q.trimmed(x)} is not null)::int' for x in ('headline', 'summary', 'location', 'skills_text'))} as bigint) as n_used from (select distinct * from tmp_candidate_input)",
    "ambiguity_renewals": f"with {_KEYS}, a as (select source_id, md5(ambiguity_type) as input_hash, right(source_id, 1) in ('0', '2', '4', '6', '8', 'a', 'c', 'e') as held from resolved where decision = 'ambiguous') select 'company' as entity_type, 'companies' as source_system, source_id as source_record_ref, input_hash, case when held then 'renew' else 'insert' end as action, case when held then 'old:' || source_id end as log_id from a",
    "chunk_vs_candidate": f"with {base._JOBS}, m as (select candidate_id, list(x order by i) as embedding from (select vec_id % 100 as candidate_id, i, avg(embedding[i]::double) as x from embeddings, unnest(range(1, len(embedding) + 1)) t(i) group by 1, 2) group by 1), s as (select j.vec_id as query_id, candidate_id, floor(round({_SIM('j', 'm')}, 6) * 10000 + 0.001) / 10000 as mean_score from jobs j, m), k as (select j.vec_id as query_id, e.vec_id % 100 as candidate_id, floor(max(round({_SIM('j', 'e')}, 6)) * 10000 + 0.001) / 10000 as chunk_score from jobs j, embeddings e group by 1, 2) select query_id, candidate_id, chunk_score, mean_score from k join s using (query_id, candidate_id)",
    "provenance": f"with {_KEYS} select source_id, name as raw_name, decision, match_basis from resolved",
    "jd_chunks": rf"with s as (select doc_id, list_filter(string_split_regex(regexp_replace(text, '\r\n?', chr(10), 'g'), '\n\n+'), lambda x: trim(replace(x, chr(10), ' '), ' ') <> '') as xs from documents where source = 'jd'), u as (select doc_id, i - 1 as chunk_index, xs[i] as chunk from (select *, unnest(range(1, len(xs) + 1)) as i from s)) select doc_id, cast(chunk_index as integer) as chunk_index, case when chunk_index = 0 then 'summary' {' '.join(f'when regexp_matches({_low}, {chr(39)}{w}{chr(39)}) then {chr(39)}{k}{chr(39)}' for k, w in JD)} else 'domain_context' end as kind, md5(chunk) as md5, cast(length(chunk) as integer) as char_count from u",
    "reference_snapshot_chunks": "with e as (select distinct source_candidate_id, source_path, source_array_index, title, raw_company_name, start_date_raw, coalesce(raw_is_current, false) as now from tmp_experience_input where source_candidate_id is not null and title is not null), t as (select *, row_number() over (partition by source_candidate_id order by now desc, start_date_raw desc nulls last, title, source_path, source_array_index) as rn from e) select source_candidate_id, cast(rn as integer) as position, case when now and rn = 1 then 'current_role' else 'experience' end as kind, md5(concat_ws(' - ', title, raw_company_name)) as md5 from t where rn <= 3 union all select source_candidate_id, 4, 'skills', md5(array_to_string(top_skills, ', ')) from (select distinct * from tmp_candidate_input) where len(top_skills) > 0",
    "chunk_metadata": f"with k as ({base.SQL['candidate_chunks']}), d as (select distinct external_source_ref, source_type, trust_level, candidate_skip_reason from tmp_source_document_input) select k.external_source_ref, chunk_index, char_count, token_estimate, case lower(trim(source_type, ' ')) {' '.join(f'when {chr(39)}{a}{chr(39)} then {b}' for a, b in PRIORITY.items())} else 0 end as source_priority, trust_level, candidate_skip_reason is null and char_count > 0 as is_searchable from k join d using (external_source_ref)",
    "embedding_store": "with e as (select distinct id, chunk_id, model_name, model_version, coalesce(is_active, false) as active, generated_at from candidate_chunk_embeddings), r as (select *, row_number() over w as rn, count(*) over (partition by chunk_id, model_name, model_version) as n from e window w as (partition by chunk_id, model_name, model_version order by active desc, generated_at desc nulls last, id)) select chunk_id, model_name, model_version, id, active as is_active, n - 1 as n_replaced from r where rn = 1",
    "retrieval_eval": f"with {base._JOBS}, own as (select j.vec_id as query_id, e.vec_id as vector_id, round({_SIM('j', 'e')}, 6) as score from jobs j, embeddings e where j.vec_id <> e.vec_id), near as (select query_id, first(vector_id order by score desc, vector_id) as ref from own group by 1), refs as (select n.query_id, e.vec_id as vector_id, round({_SIM('x', 'e')}, 6) as ref_score from near n join embeddings x on x.vec_id = n.ref, embeddings e), b as (select o.*, ref_score from own o join refs using (query_id, vector_id)), w as (select query_id, vector_id, 'job' as strategy, round(score, 6) as value from b union all select query_id, vector_id, 'job_and_reference', round(0.6::double * score + 0.4::double * ref_score, 6) from b union all select query_id, vector_id, 'source_weighted', round(case when vector_id % 7 = 0 then 0.8 else 1.0 end::double * score, 6) from b), k as (select *, row_number() over (partition by query_id, strategy order by value desc, vector_id) as rn from w) select query_id, strategy, count(*) filter (where e.label = a.label) as n_good, count(*) as n_hits from k join embeddings e on e.vec_id = vector_id join embeddings a on a.vec_id = query_id where rn <= 10 group by 1, 2",
    "reference_import": f"with d as (select distinct external_source_ref, title, {q.candidate_url('raw_linkedin_url')} as url from tmp_source_document_input), k as (select {q.candidate_url('raw_linkedin_url')} as known, min(source_candidate_id) as candidate_id from tmp_candidate_input group by 1) select external_source_ref, case when url is null then 'skip' when candidate_id is not null then 'attach' else 'create' end as action, candidate_id, coalesce({q.search_text('title')}, 'unlabelled') as archetype from d left join k on known = url",
    "promoted_signals": "select user_id, event_type, first(event_id order by ts desc, event_id desc) as event_id, first(value order by ts desc, event_id desc) as value, count(*) - 1 as n_superseded from events where event_type <> 'error' group by 1, 2",
    "enrichment_freshness": f"with r as (select distinct source_id, last_enrichment_sync, incoming_source from tmp_company_input), m as (select max(last_enrichment_sync) as newest from r), a as (select source_id, cast(date_diff('day', cast(last_enrichment_sync as date), cast(newest as date)) as integer) as age_days, incoming_source from r, m) select source_id, age_days, case when age_days is null then 'never' when age_days > 365 then 'stale' else 'fresh' end as state, {q.source_rank('incoming_source')} < 500 as may_overwrite from a",
    "note_promotion": f"with r as (select *, row_number() over (partition by source_candidate_id order by source = 'recruiter_note_raw', effective_at desc nulls last, doc_id) as rn, count(*) filter (where source = 'recruiter_note_raw') over (partition by source_candidate_id) as n_raw from documents where source in ('recruiter_note_raw', 'recruiter_note_summary') and source_candidate_id is not null) select source_candidate_id, doc_id, source, case source {' '.join(f'when {chr(39)}{k}{chr(39)} then {v}' for k, v in r.SOURCE_WEIGHTS.items())} end::double as weight, n_raw from r where rn = 1",
    "run_counters": "select cast(date_trunc('month', ts) as date) as month, event_type, count(*) as n, count(value) as n_valued, cast(grouping(cast(date_trunc('month', ts) as date), event_type) as bigint) as level from events group by cube (cast(date_trunc('month', ts) as date), event_type)",
    "model_costs": "select model_name, model_version, count(*) as n_vectors, cast(sum(coalesce(len(embedding), 0)) as bigint) as n_numbers, round(avg(case when is_active and len(embedding) = embedding_dimensions then 1.0 else 0.0 end), 6) as usable_share from (select distinct on (id) * from candidate_chunk_embeddings) group by 1, 2",
    "existence_check": "select * from (values ('tmp_company_input', 'parent_company', 'missing'), ('documents', 'embedding_model', 'missing'), ('embeddings', 'embedding', 'vector')) t(table_name, column_name, finding)",
}
QUERIES = {f.__name__: f for f in (item_dates, company_inputs, payload_texts, fallback_payloads, ambiguity_renewals, provenance, jd_chunks, reference_snapshot_chunks, chunk_metadata, embedding_store, chunk_vs_candidate, retrieval_eval, reference_import, promoted_signals, enrichment_freshness, note_promotion, run_counters, model_costs, existence_check)}
