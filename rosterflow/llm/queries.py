"""Queries of the problems on training data over whole tables, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm import copies, garbled, mixing, neighbors, spellings, survivor, tokens
from rosterflow.runtime import written
from rosterflow.sources.tables import table


def _addresses(spark: SparkSession, d: str) -> DataFrame:
    mails = table(spark, d, "tmp_email_input").select(F.col("source_row_id").alias("id"), F.col("email_raw").alias("raw"))
    fallbacks = table(spark, d, "tmp_candidate_input").select(F.col("source_candidate_id").alias("id"), F.col("fallback_email_raw").alias("raw"))
    rows = mails.unionByName(fallbacks).where("raw is not null")
    return rows.select("id", F.encode(copies.mail_address(F.col("raw")), "UTF-8").alias("value"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every record of an address but the first, with the first."""
    return copies.collapse(_addresses(spark, d)).where("id <> kept_id").select("kept_id", F.col("id").alias("copy_id"))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    """One record for each address with the number of its records over both tables."""
    return copies.counted(_addresses(spark, d)).select(F.decode("value", "UTF-8").alias("address"), "kept_id", "n_records")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """For each company and field the record whose value survives."""
    return survivor.company_survivors(table(spark, d, "tmp_company_input"))


def p3_records(spark: SparkSession, d: str) -> DataFrame:
    """One record for each company, its three fields those that survive; industries as JSON."""
    return survivor.company_records(table(spark, d, "tmp_company_input")).withColumn("industries", F.to_json("industries"))


def _names(spark: SparkSession, d: str) -> DataFrame:
    held = table(spark, d, "tmp_experience_input").select(F.col("raw_company_name").alias("name"))
    return held.unionByName(table(spark, d, "tmp_company_input").select("name"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of spellings that mean the same organisation."""
    return spellings.spelling_pairs(_names(spark, d))


def p5_members(spark: SparkSession, d: str) -> DataFrame:
    """Every spelling with the form it is attributed to."""
    return spellings.organisations(_names(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of vectors of which one is among the five nearest of the other."""
    return neighbors.similar_pairs(table(spark, d, "candidate_chunk_embeddings"), "id", ["model_name", "model_version"], "embedding", "is_active", "embedding_dimensions")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document's text."""
    return tokens.encode_texts(table(spark, d, "documents"), "doc_id", "text")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """How often the mix uses each document."""
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "source_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share that each source really reaches in the mix."""
    return mixing.shares(written(p9_mix(spark, d), "mixed"), table(spark, d, "source_targets"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with wrongly decoded text."""
    return garbled.garbled(table(spark, d, "documents"), "doc_id", "text").select(F.col("key").alias("doc_id"))


def p10_restored(spark: SparkSession, d: str) -> DataFrame:
    """Their text put right wherever it can be."""
    return garbled.restored_texts(table(spark, d, "documents"), "doc_id", "text").select(F.col("key").alias("doc_id"), "restored", "lossy")


P3_SQL = r"""
with c as (
  select source_id, staff_count, industries, last_enrichment_sync as synced,
         case lower(trim(coalesce(incoming_source, ''))) when 'linkedin_import' then 500 when 'linkedin_profile' then 500 when 'legacy_backfill' then 400
              when 'resume_upload' then 300 when 'resume' then 300 when 'recruiter_note_summary' then 200 when 'transcript_summary' then 200
              when 'recruiter_note_raw' then 100 when 'manual_profile_note' then 100 else 0 end as trust,
         nullif(lower(trim(linkedin_id)), '') as k1,
         nullif(regexp_extract(regexp_replace(regexp_replace(lower(trim(linkedin_username)), '^[@/]+', ''), '^(in|company|school)/+', ''), '^[^/]+'), '') as k2,
         nullif(regexp_extract(lower(trim(linkedin_url)), 'linkedin\.[a-z]+/+(?:company|school|in)/+([^/?#]+)', 1), '') as k3
  from (select distinct * from tmp_company_input) where source_id is not null),
links as (select source_id, 'i' || k1 as k from c where k1 is not null union select source_id, 'h' || k2 from c where k2 is not null union select source_id, 'h' || k3 from c where k3 is not null),
reach as (
  with recursive r(a, b) as (select source_id, source_id from links
    union select r.a, l2.source_id from r join links l1 on l1.source_id = r.b join links l2 on l2.k = l1.k)
  select a, b from r),
tree as (select a as source_id, min(b) as root from reach group by a),
sized as (select source_id, root, count(*) over (partition by root) as n from tree),
votes as (
  select root, 'staff_count' as field, c.source_id, trust, synced from c join sized s on s.source_id = c.source_id where n > 1 and staff_count > 0
  union all select root, 'industries', c.source_id, trust, synced from c join sized s on s.source_id = c.source_id where n > 1 and len(list_filter(industries, lambda x: x is not null and trim(x) <> '')) > 0
  union all select root, 'last_enrichment_sync', c.source_id, trust, synced from c join sized s on s.source_id = c.source_id where n > 1 and synced is not null)
select root as group_id, field, source_id from (select *, row_number() over (partition by root, field order by trust desc, synced desc nulls last, source_id) as rn from votes) where rn = 1
"""

P3_RECORDS_SQL = f"select group_id, any_value(staff_count) filter (where field = 'staff_count') as staff_count, any_value(cast(to_json(industries) as varchar)) filter (where field = 'industries') as industries, any_value(last_enrichment_sync) filter (where field = 'last_enrichment_sync') as last_enrichment_sync from ({P3_SQL}) join (select distinct on (source_id) * from tmp_company_input) using (source_id) group by group_id"

# written on its own, not from the operator's tables: characters folded one by one, then the address around the first @
_folded = """array_to_string(list_transform(string_split(raw, ''), lambda c: case when unicode(c) between 65281 and 65374 then chr(unicode(c) - 65248) when unicode(c) = 12288 then ' ' when unicode(c) in (65377, 12290) then '.' else c end), '')"""
_spaced = rf"""regexp_replace(regexp_replace(lower({_folded}), '[\p{{Cf}}\x{{115F}}\x{{1160}}\x{{17B4}}\x{{17B5}}\x{{3164}}\x{{FFA0}}\x{{034F}}\x{{FE00}}-\x{{FE0F}}\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f]', '', 'g'), '[\s\x0b\x1c-\x1f\x85\p{{Z}}]+', ' ', 'g')"""
_RECORDS = rf"""texts as (select distinct id, {_spaced} as t from (select source_row_id as id, email_raw as raw from tmp_email_input union all select source_candidate_id, fallback_email_raw from tmp_candidate_input) where id is not null and raw is not null),
found as (select id, regexp_extract(regexp_replace(t, ' ?@ ?', '@', 'g'), '([\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}\p{{Mn}}._%+-]*)@([\p{{L}}\p{{N}}-]+(?: ?\. ?[\p{{L}}\p{{N}}-]+)* ?\. ?\p{{L}}[\p{{L}}\p{{N}}-]+)', ['who', 'host']) as a from texts),
records as (select distinct id, case when a.who <> '' then a.who || '@' || replace(a.host, ' ', '') end as value from found)"""
P1_SQL = f"with {_RECORDS} select kept_id, id as copy_id from (select id, min(id) over (partition by value) as kept_id from records where value is not null) where id <> kept_id"
P1_GROUPS_SQL = f"with {_RECORDS} select value as address, min(id) as kept_id, count(*) as n_records from records where value is not null group by value"

QUERIES = {"p1_found": p1_found, "p1_groups": p1_groups, "p3_found": p3_found, "p3_records": p3_records, "p5_found": p5_found, "p5_members": p5_members, "p6_found": p6_found, "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_restored": p10_restored}
SQL = {"p1_found": P1_SQL, "p1_groups": P1_GROUPS_SQL, "p3_found": P3_SQL, "p3_records": P3_RECORDS_SQL}
