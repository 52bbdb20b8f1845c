"""Queries of retrieval, ranking, feedback, quality and hygiene operators over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterflow.functions import normalize as n
from rosterflow.operators import documents, quality, retrieval as r
from rosterflow.plans import duck as q
from rosterflow.runtime import shared_folder, written
from rosterflow.sources.tables import table
from rosterflow.streaming import ingest as stream

c = F.col
ACTIONS = {"purchase": "strong", "error": "rejected", "view": "skipped", "signup": "needs_screening"}
REQUIRED, MAIN, BROAD = ("python", "sql"), ("python", "sql", "kubernetes"), ("team", "systems", "kompanii")


def _cut(x: str):
    """Four digits, cut off and not rounded, so that no engine's way with halves matters."""
    return F.floor(c(x) * 10_000 + 0.001).cast("double") / 10_000


def _embeddings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").withColumn("candidate_id", c("vec_id") % 100)


def _jobs(spark: SparkSession, d: str) -> DataFrame:
    """The stated query set of all searches: every vector whose id is divisible by 100, each a job and a reference."""
    return table(spark, d, "embeddings").where("vec_id % 100 = 0")


def vector_topk(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest vectors of each job with a cosine of 0.1 or more."""
    got = r.scores(_jobs(spark, d), table(spark, d, "embeddings"), "vec_id", "vec_id", "embedding", 0.1, 10)
    return got.select("query_id", "vector_id", _cut("score").alias("score"), c("rank").cast("bigint").alias("rank"))


def candidate_collapse(spark: SparkSession, d: str) -> DataFrame:
    """All hits of each job collapsed to candidates with the best evidence."""
    hits = r.scores(_jobs(spark, d), _embeddings(spark, d), "vec_id", "vec_id", "embedding", 0.2, None)
    hits = hits.withColumn("candidate_id", c("vector_id") % 100).withColumn("job", c("query_id"))
    return r.collapse(hits, ["job", "candidate_id"]).select("job", "candidate_id", _cut("score").alias("score"), "best_vector", "n_hits")


def reference_retrieval(spark: SparkSession, d: str) -> DataFrame:
    """One pass for each reference, which doesn't find itself; the best reference of each candidate stays."""
    hits = r.scores(_jobs(spark, d), _embeddings(spark, d), "vec_id", "vec_id", "embedding", 0.2, None).where("query_id <> vector_id")
    return r.collapse(hits.withColumn("candidate_id", c("vector_id") % 100), ["candidate_id"]).select("candidate_id", "best_query", _cut("score").alias("score"), "n_hits")


def retrieval_recall(spark: SparkSession, d: str) -> DataFrame:
    """Recall and precision at ten of each job, its label taken for what is wanted."""
    jobs = _jobs(spark, d).select(c("vec_id").alias("query_id"), "label")
    gold = table(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("n_gold"))
    hits = vector_topk(spark, d).join(table(spark, d, "embeddings").select(c("vec_id").alias("vector_id"), c("label").alias("got")), "vector_id")
    per = hits.join(jobs, "query_id").groupBy("query_id", "label").agg(F.count_if(c("got") == c("label")).alias("n_good"), F.count("*").alias("n_hits"))
    return per.join(gold, "label").select("query_id", "label", "n_good", F.round(c("n_good") / c("n_hits"), 6).alias("precision"), F.round(c("n_good") / c("n_gold"), 6).alias("recall"))


def keyword_funnel(spark: SparkSession, d: str) -> DataFrame:
    got = r.funnel(table(spark, d, "documents"), "doc_id", "text", REQUIRED, MAIN, BROAD, 100)
    return got.select(c("key").alias("doc_id"), c("level").cast("bigint").alias("level"), "evidence", "coverage")


def rejection_filter(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of candidates that were not rejected and aren't close (0.7) to any vector of one that was.

    A candidate stands for ten vectors; candidates are rejected a quarter of whose user's events are errors. The ids go first, by an
    anti-join; rejected vectors are a query set of their own, read in blocks.
    """
    vectors = table(spark, d, "embeddings").withColumn("candidate_id", F.floor(c("vec_id") / 10))
    rejected = table(spark, d, "events").groupBy(c("user_id").alias("candidate_id")).agg(F.count("*").alias("n"), F.count_if(c("event_type") == "error").alias("bad")).where("4 * bad >= n").select("candidate_id")
    bad = vectors.join(rejected, "candidate_id", "left_semi")
    left = vectors.join(rejected, "candidate_id", "left_anti")
    near = r.scores(bad, left, "vec_id", "vec_id", "embedding", 0.7, None).select(c("vector_id").alias("vec_id")).distinct()
    return left.join(near, "vec_id", "left_anti").groupBy("candidate_id").agg(F.count("*").alias("n_left"))


def recruiter_feedback_latest(spark: SparkSession, d: str) -> DataFrame:
    """The latest action of each user; clicks aren't actions."""
    action = F.create_map(*[F.lit(x) for p in ACTIONS.items() for x in p])[c("event_type")]
    rows = table(spark, d, "events").withColumn("action", action).where("action is not null")
    last = rows.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "action")).alias("x"), F.count("*").alias("n_actions"))
    return last.select("user_id", "x.action", "x.event_id", "n_actions")


def ensemble_rank(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of all jobs and references in one ranking, weighted by the number of references and by source."""
    job = candidate_collapse(spark, d).groupBy("candidate_id").agg(F.max("score").alias("job_score"))
    ref = reference_retrieval(spark, d).select("candidate_id", c("score").alias("reference_score"), "best_query")
    n_ref = _jobs(spark, d).agg(F.count("*").alias("n_references"))
    weights = F.create_map(*[F.lit(x) for p in r.SOURCE_WEIGHTS.items() for x in p])
    sources = table(spark, d, "documents").groupBy((c("doc_id") % 100).alias("candidate_id")).agg(F.max(weights[c("source")]).alias("source_weight"))
    pool = job.join(ref, "candidate_id", "full").join(sources, "candidate_id", "left").crossJoin(F.broadcast(n_ref))  # one row
    out = r.ensemble(pool, c("n_references"))
    return out.select("candidate_id", _cut("final_score").alias("final_score"), "job_score", "reference_score", "n_references")


def bounded_iteration(spark: SparkSession, d: str) -> DataFrame:
    """Up to three rounds for each job: the best new candidate of a round is the reference of the next.

    All new candidates of a round at 0.15 or more go into the job's history, so only the new reference has to search.
    """
    vectors = table(spark, d, "embeddings").select("vec_id", "embedding")
    seeds = _jobs(spark, d).select(c("vec_id").alias("job"), "vec_id", "embedding")
    history = None
    for round_ in range(1, 4):
        asked = seeds.select("vec_id", "embedding").dropDuplicates(["vec_id"])
        hits = r.scores(asked, vectors, "vec_id", "vec_id", "embedding", 0.15, None)
        new = hits.join(seeds.select("job", c("vec_id").alias("query_id")), "query_id").where("vector_id <> job").select("job", "vector_id", "score")
        new = new if history is None else new.join(history.select("job", "vector_id"), ["job", "vector_id"], "left_anti")
        new = written(new.withColumn("round", F.lit(round_)), "round")
        history = new if history is None else history.unionByName(new)
        best = new.groupBy("job").agg(F.min(F.struct((-c("score")).alias("s"), "vector_id")).alias("b")).select("job", c("b.vector_id").alias("vec_id"))
        seeds = best.join(vectors, "vec_id")
    return history.select("job", "vector_id", _cut("score").alias("score"), "round")


def hard_filter_outcome(spark: SparkSession, d: str) -> DataFrame:
    """Balance and segment tests of customers; what isn't known needs screening, and a wish never filters."""
    balance = F.when(c("c_custkey") % 7 == 0, None).otherwise(c("c_acctbal"))
    verdict, unknown = r.outcome(("balance", balance > 0), ("segment", F.when(c("c_custkey") % 11 != 0, c("c_mktsegment") != "MACHINERY")))
    return table(spark, d, "customer").select("c_custkey", verdict.alias("outcome"), unknown.alias("screening_reasons"), F.when(c("c_nationkey") < 5, 1).otherwise(0).alias("preferred"))


def candidate_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Sections of document texts as chunks, counted by source type."""
    docs = table(spark, d, "tmp_source_document_input").dropDuplicates(["external_source_ref"])
    got = documents.split_sections(docs, "external_source_ref", "normalized_text")
    return got.select("external_source_ref", "chunk_index", F.md5("chunk_text").alias("md5"), "char_count", "token_estimate")


def chunk_identity_violations(spark: SparkSession, d: str) -> DataFrame:
    """Titles under which one candidate has documents of different text: no chunk id may stand for both."""
    rows = table(spark, d, "documents").where("title is not null")
    return rows.groupBy("source_candidate_id", "title").agg(F.countDistinct(F.md5(F.coalesce("text", F.lit("")))).alias("n_texts"), F.count("*").alias("n_documents")).where("n_texts > 1")


def aggregate_search_documents(spark: SparkSession, d: str) -> DataFrame:
    """One row for each candidate, rebuilt whole: current role, former employers, number of jobs and of days employed."""
    from rosterflow.operators.intervals import OPEN, interval_days, merge_intervals

    rows = table(spark, d, "tmp_experience_input").dropDuplicates(["source_candidate_id", "source_path", "source_array_index"]).where("source_candidate_id is not null")
    now = F.coalesce("raw_is_current", F.lit(False))
    role = F.min(F.struct((~now).alias("past"), (-F.coalesce(F.unix_date("start_date_raw"), F.lit(-10**6))).alias("late"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("raw_company_name", F.lit("")).alias("company"), "source_path", "source_array_index")).alias("role")
    per = rows.groupBy("source_candidate_id").agg(F.count("*").alias("n_jobs"), F.countDistinct(n.company_name(c("raw_company_name"))).alias("n_companies"), role)
    spans = merge_intervals(interval_days(rows, "source_candidate_id", "start_date_raw", "end_date_raw", "raw_is_current")).where(f"kind = 'period' and hi < {OPEN}")
    days = spans.groupBy(c("entity").alias("source_candidate_id")).agg(F.sum(c("hi") - c("lo") + 1).alias("closed_days"))
    return per.join(days, "source_candidate_id", "left").select("source_candidate_id", "n_jobs", "n_companies", c("role.title").alias("current_title"), c("role.company").alias("current_company"), F.coalesce("closed_days", F.lit(0)).alias("closed_days"))


def qa_orphans(spark: SparkSession, d: str) -> DataFrame:
    return quality.orphans(table(spark, d, "tmp_experience_input"), table(spark, d, "tmp_candidate_input"), "source_candidate_id", "source_candidate_id")


def qa_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicates(table(spark, d, "tmp_email_input"), ["source_row_id"])


def qa_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Candidates with exactly one, several or no profile document."""
    per = table(spark, d, "tmp_source_document_input").where("source_type = 'linkedin_profile'").groupBy("source_candidate_id").agg(F.countDistinct("external_source_ref").alias("n"))
    rows = table(spark, d, "tmp_candidate_input").select("source_candidate_id").distinct().join(per, "source_candidate_id", "left")
    state = F.when(c("n").isNull(), "none").when(c("n") == 1, "one").otherwise("several")
    return rows.groupBy(state.alias("profiles")).agg(F.count("*").alias("n_candidates"))


def qa_row_counts(spark: SparkSession, d: str) -> DataFrame:
    names = ("tmp_company_input", "tmp_candidate_input", "tmp_email_input", "tmp_experience_input", "tmp_source_document_input", "documents")
    out = None
    for x in names:
        got = table(spark, d, x).agg(F.count("*").alias("n_rows")).select(F.lit(x).alias("table_name"), "n_rows")
        out = got if out is None else out.unionByName(got)
    return out


def qa_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return quality.out_of_vocabulary(table(spark, d, "documents").select(F.lower("source").alias("source")), "source", ["linkedin_profile", "resume", "recruiter_note_raw", "recruiter_note_summary", "transcript_summary", "manual_profile_note"])


def read_path_diff(spark: SparkSession, d: str) -> DataFrame:
    """Companies whose site or staff range differs between stored and derived values."""
    rows = table(spark, d, "tmp_company_input").dropDuplicates(["source_id"])
    new = rows.select("source_id", n.website(c("website")).alias("website"), n.staff_range(c("staff_count"), c("staff_count_range")).alias("staff_count_range"))
    return quality.diff(rows, new, "source_id", ["website", "staff_count_range"])


def hygiene_digest(spark: SparkSession, d: str) -> DataFrame:
    """Events by kind and week."""
    got = stream.windowed_counts(table(spark, d, "events"), "ts", "event_type")
    return got.select(F.to_date("week").alias("week"), "event_type", "n")


def job_change_alerts(spark: SparkSession, d: str) -> DataFrame:
    """Changes of employer from one job to the next by start, under the normalized name."""
    w = Window.partitionBy("source_candidate_id").orderBy("start_date_raw", "source_path", "source_array_index")
    rows = table(spark, d, "tmp_experience_input").where("start_date_raw is not null and source_candidate_id is not null").select("source_candidate_id", "start_date_raw", "source_path", "source_array_index", n.company_name(c("raw_company_name")).alias("company")).where("company is not null").distinct()
    rows = rows.withColumn("before", F.lag("company").over(w))
    return rows.where("before <> company").groupBy("source_candidate_id").agg(F.count("*").alias("n_changes"), F.max("start_date_raw").alias("last_change"))


def resumable_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Events taken in as a stream, twice; the second run finds nothing new."""
    import uuid

    at = f"{shared_folder(spark)}/rosterflow/ingest-{uuid.uuid4().hex}"
    src = table(spark, d, "events")
    src.select("event_id", "user_id", "event_type", "value").write.parquet(f"{at}/in")
    for _ in range(2):
        stream.ingest(spark, f"{at}/in", "event_id long, user_id long, event_type string, value double", "event_id", f"{at}/out", f"{at}/state")
    return spark.read.parquet(f"{at}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("n_ids"))


_JOBS = "jobs as (select * from embeddings where vec_id % 100 = 0)"
_sim = lambda a, b: f"list_cosine_similarity(cast({a}.embedding as double[]), cast({b}.embedding as double[]))"
_COS = f"round({_sim('j', 'e')}, 6)"
_HITS = lambda t: f"hits as (select j.vec_id as query_id, e.vec_id as vector_id, {_COS} as score from jobs j, embeddings e where round({_sim('j', 'e')}, 9) >= {t})"
_TOP = f"{_JOBS}, {_HITS(0.1)}, topk as (select query_id, vector_id, floor(score * 10000 + 0.001) / 10000 as score, row_number() over (partition by query_id order by score desc, vector_id) as rank from hits qualify rank <= 10)"


def _round_sql(i: int) -> str:
    seen = "" if i == 1 else " and not exists (select 1 from (" + " union all ".join(f"select job, vector_id from r{k}" for k in range(1, i)) + ") h where h.job = s.job and h.vector_id = e.vec_id)"
    seed = "s1 as (select vec_id as job, embedding from jobs)" if i == 1 else f"s{i} as (select b.job, e.embedding from (select job, first(vector_id order by score desc, vector_id) as v from r{i - 1} group by 1) b join embeddings e on e.vec_id = b.v)"
    return f"{seed}, r{i} as (select s.job, e.vec_id as vector_id, round({_sim('s', 'e')}, 6) as score from s{i} s, embeddings e where e.vec_id <> s.job and round({_sim('s', 'e')}, 9) >= 0.15{seen})"


_words = r"list_distinct(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}+#]+'))"
_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_sec = "list_filter(string_split(chr(10) || replace(t, chr(10) || '## ', chr(10) || chr(10) || '## '), chr(10) || '## '), lambda x: trim(replace(x, chr(10), ' '), ' ') <> '')"
SQL = {
    "vector_topk": f"with {_TOP} select query_id, vector_id, score, rank from topk",
    "candidate_collapse": f"with {_JOBS}, {_HITS(0.2)} select query_id as job, vector_id % 100 as candidate_id, floor(max(score) * 10000 + 0.001) / 10000 as score, first(vector_id order by score desc, vector_id) as best_vector, count(*) as n_hits from hits group by 1, 2",
    "reference_retrieval": f"with {_JOBS}, {_HITS(0.2)} select vector_id % 100 as candidate_id, first(query_id order by score desc, query_id, vector_id) as best_query, floor(max(score) * 10000 + 0.001) / 10000 as score, count(*) as n_hits from hits where query_id <> vector_id group by 1",
    "retrieval_recall": f"with {_TOP}, per as (select t.query_id, j.label, count(*) filter (where e.label = j.label) as n_good, count(*) as n_hits from topk t join jobs j on j.vec_id = t.query_id join embeddings e on e.vec_id = t.vector_id group by 1, 2) select query_id, label, n_good, round(n_good / n_hits, 6) as precision, round(n_good / n_gold, 6) as recall from per join (select label, count(*) as n_gold from embeddings group by 1) using (label)",
    "keyword_funnel": f"with w as (select doc_id, {_words} as w from documents), g as (select doc_id, list_intersect(w, {_list(REQUIRED)}) as a, list_intersect(w, {_list(MAIN)}) as b, list_intersect(w, {_list(BROAD)}) as o from w), l as (select *, case when len(a) = {len(REQUIRED)} then 1 when len(b) > 0 then 2 when len(o) > 0 then 3 end as level from g), k as (select level, count(*) as n from l where level is not null group by 1) select doc_id, cast(level as bigint) as level, array_to_string(list_sort(list_distinct(list_concat(a, b, o))), '|') as evidence, round(len(a) / {len(REQUIRED)}, 6) as coverage from l where level is not null and coalesce((select sum(n) from k where k.level < l.level), 0) < 100",
    "rejection_filter": f"with v as (select *, cast(floor(vec_id / 10) as bigint) as candidate_id from embeddings), rej as (select user_id as candidate_id from events group by 1 having 4 * count(*) filter (where event_type = 'error') >= count(*)), l as (select * from v where candidate_id not in (select candidate_id from rej)), near as (select distinct e.vec_id from v j, l e where j.candidate_id in (select candidate_id from rej) and round({_sim('j', 'e')}, 9) >= 0.7) select candidate_id, count(*) as n_left from l where vec_id not in (select vec_id from near) group by 1",
    "recruiter_feedback_latest": f"with a as (select *, case event_type {' '.join(f'when {chr(39)}{k}{chr(39)} then {chr(39)}{v}{chr(39)}' for k, v in ACTIONS.items())} end as action from events) select user_id, first(action order by ts desc, event_id desc) as action, first(event_id order by ts desc, event_id desc) as event_id, count(*) as n_actions from a where action is not null group by 1",
    "ensemble_rank": f"with {_JOBS}, {_HITS(0.2)}, refs as (select * from hits where query_id <> vector_id), a as (select vector_id % 100 as candidate_id, floor(max(score) * 10000 + 0.001) / 10000 as job_score from hits group by 1), b as (select vector_id % 100 as candidate_id, floor(max(score) * 10000 + 0.001) / 10000 as reference_score from refs group by 1), s as (select doc_id % 100 as candidate_id, max(case source {' '.join(f'when {chr(39)}{k}{chr(39)} then {v}' for k, v in r.SOURCE_WEIGHTS.items())} end) as w from documents group by 1), n as (select count(*) as n_references from jobs), p as (select coalesce(a.candidate_id, b.candidate_id) as candidate_id, job_score, reference_score from a full join b on a.candidate_id = b.candidate_id) select p.candidate_id, floor(((case when n_references = 0 then 1.0 when n_references = 1 then 0.6 when n_references <= 3 then 0.4 else 0.25 end)::double * coalesce(job_score, 0) + (case when n_references = 0 then 0 when n_references = 1 then 0.4 when n_references <= 3 then 0.6 else 0.75 end)::double * coalesce(reference_score, 0)) * coalesce(w, 1.0)::double * 10000 + 0.001) / 10000 as final_score, job_score, reference_score, n_references from p left join s on s.candidate_id = p.candidate_id, n",
    "bounded_iteration": f"with {_JOBS}, {_round_sql(1)}, {_round_sql(2)}, {_round_sql(3)} " + " union all ".join(f"select job, vector_id, floor(score * 10000 + 0.001) / 10000 as score, {i} as round from r{i}" for i in (1, 2, 3)),
    "hard_filter_outcome": "with t as (select *, case when c_custkey % 7 = 0 then null else c_acctbal > 0 end as a, case when c_custkey % 11 <> 0 then c_mktsegment <> 'MACHINERY' end as b from customer) select c_custkey, case when a = false or b = false then 'fail' when a is null or b is null then 'needs_screening' else 'pass' end as outcome, array_to_string(list_filter([case when a is null then 'balance' end, case when b is null then 'segment' end], lambda x: x is not null), '|') as screening_reasons, case when c_nationkey < 5 then 1 else 0 end as preferred from t",
    "candidate_chunks": rf"with d as (select distinct external_source_ref, nullif(array_to_string(list_filter(list_transform(string_split(regexp_replace(regexp_replace(normalized_text, '[ \t\x0b\f]+', ' ', 'g'), '\r\n?', chr(10), 'g'), chr(10)), lambda x: regexp_replace(x, '^[\s\x0b]+|[\s\x0b]+$', '', 'g')), lambda x: x <> ''), chr(10)), '') as t from tmp_source_document_input), s as (select external_source_ref, {_sec} as secs from d where t is not null), p as (select external_source_ref, flatten(list_transform(secs, lambda x: case when length(x) <= 1200 then [x] else string_split(x, chr(10)) end)) as pieces from s), u as (select external_source_ref, i - 1 as chunk_index, pieces[i] as x from (select *, unnest(range(1, len(pieces) + 1)) as i from p)), z as (select external_source_ref, chunk_index, trim(regexp_replace(x, '^' || chr(10) || '+', ''), ' ') as x from u where trim(x, ' ') <> '') select external_source_ref, cast(chunk_index as integer) as chunk_index, md5(x) as md5, cast(length(x) as integer) as char_count, cast(ceil(length(x) / 4) as integer) as token_estimate from z",
    "chunk_identity_violations": "select source_candidate_id, title, count(distinct md5(coalesce(text, ''))) as n_texts, count(*) as n_documents from documents where title is not null group by 1, 2 having count(distinct md5(coalesce(text, ''))) > 1",
    "aggregate_search_documents": f"with rows_ as (select distinct * from tmp_experience_input where source_candidate_id is not null), spans as (select distinct source_candidate_id as e, date_diff('day', date '1970-01-01', start_date_raw) as lo, case when coalesce(raw_is_current, false) then 2147483647 else date_diff('day', date '1970-01-01', end_date_raw) end as hi from rows_ where start_date_raw is not null), seen as (select *, max(hi) over (partition by e order by lo, hi rows between unbounded preceding and 1 preceding) as b from spans where hi >= lo), m as (select *, sum(case when b is null or lo > b + 1 then 1 else 0 end) over (partition by e order by lo, hi rows unbounded preceding) as i from seen), p as (select e, i, min(lo) as lo, max(hi) as hi from m group by 1, 2), days as (select e, cast(sum(hi - lo + 1) as bigint) as closed_days from p where hi < 2147483647 group by 1), ranked as (select *, row_number() over (partition by source_candidate_id order by coalesce(raw_is_current, false) desc, coalesce(start_date_raw, date '0001-01-01') desc, coalesce(title, ''), coalesce(raw_company_name, ''), source_path, source_array_index) as rn from rows_), per as (select source_candidate_id, count(*) as n_jobs, count(distinct {q.company_name('raw_company_name')}) as n_companies from rows_ group by 1) select per.source_candidate_id, n_jobs, n_companies, coalesce(title, '') as current_title, coalesce(raw_company_name, '') as current_company, coalesce(closed_days, 0) as closed_days from per join ranked on ranked.source_candidate_id = per.source_candidate_id and rn = 1 left join days on days.e = per.source_candidate_id",
    "qa_orphans": "select source_candidate_id, count(*) as n from tmp_experience_input where source_candidate_id is not null and source_candidate_id not in (select source_candidate_id from tmp_candidate_input) group by 1",
    "qa_duplicates": "select source_row_id, count(*) as n from tmp_email_input group by 1 having count(*) > 1",
    "qa_coverage": "select case when n is null then 'none' when n = 1 then 'one' else 'several' end as profiles, count(*) as n_candidates from (select distinct source_candidate_id from tmp_candidate_input) left join (select source_candidate_id, count(distinct external_source_ref) as n from tmp_source_document_input where source_type = 'linkedin_profile' group by 1) using (source_candidate_id) group by 1",
    "qa_row_counts": " union all ".join(f"select '{x}' as table_name, count(*) as n_rows from {x}" for x in ("tmp_company_input", "tmp_candidate_input", "tmp_email_input", "tmp_experience_input", "tmp_source_document_input", "documents")),
    "qa_vocabulary": "select lower(source) as source, count(*) as n from documents where lower(source) not in ('linkedin_profile', 'resume', 'recruiter_note_raw', 'recruiter_note_summary', 'transcript_summary', 'manual_profile_note') group by 1",
    "read_path_diff": f"select source_id, 'changed' as change from (select distinct source_id, website, staff_count_range, {q.website('website')} as w, {q.staff_range('staff_count', 'staff_count_range')} as s from tmp_company_input) where website is distinct from w or staff_count_range is distinct from s",
    "hygiene_digest": "select cast(date '1970-01-01' + cast(7 * floor(date_diff('day', date '1970-01-01', cast(ts as date)) / 7) as integer) as date) as week, event_type, count(*) as n from events group by 1, 2",
    "job_change_alerts": f"with t as (select distinct source_candidate_id, start_date_raw, source_path, source_array_index, {q.company_name('raw_company_name')} as company from tmp_experience_input where start_date_raw is not null and source_candidate_id is not null), o as (select *, lag(company) over (partition by source_candidate_id order by start_date_raw, source_path, source_array_index) as before from t where company is not null) select source_candidate_id, count(*) as n_changes, max(start_date_raw) as last_change from o where before <> company group by 1",
    "resumable_ingest": "select event_type, count(*) as n, count(distinct event_id) as n_ids from events group by 1",
}
QUERIES = {f.__name__: f for f in (vector_topk, candidate_collapse, reference_retrieval, retrieval_recall, keyword_funnel, rejection_filter, recruiter_feedback_latest, ensemble_rank, bounded_iteration, hard_filter_outcome, candidate_chunks, chunk_identity_violations, aggregate_search_documents, qa_orphans, qa_duplicates, qa_coverage, qa_row_counts, qa_vocabulary, read_path_diff, hygiene_digest, job_change_alerts, resumable_ingest)}
