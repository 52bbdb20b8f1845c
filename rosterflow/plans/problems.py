"""Queries of the general problems 2, 4 and 7 over whole tables, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.operators.intervals import continuous_periods
from rosterflow.operators.nested import flat_table, members_table, nested_nodes, nested_objects
from rosterflow.operators.packed import split_packed
from rosterflow.sources.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every skill of every candidate's packed field with its place."""
    rows = split_packed(table(spark, d, "tmp_candidate_input"), "source_candidate_id", "skills_text")
    return rows.select(F.col("key").alias("source_candidate_id"), "pos", F.col("value").alias("skill"))


def p2_values(spark: SparkSession, d: str) -> DataFrame:
    """The same values with the alternative that read each, and whether it was malformed."""
    rows = split_packed(table(spark, d, "tmp_candidate_input"), "source_candidate_id", "skills_text")
    return rows.select(F.col("key").alias("source_candidate_id"), "pos", F.col("value").alias("skill"), "kind", "malformed")


def p2_malformed(spark: SparkSession, d: str) -> DataFrame:
    """How many values were read by which alternative, and how many after backtracking."""
    rows = split_packed(table(spark, d, "tmp_candidate_input"), "source_candidate_id", "skills_text")
    return rows.groupBy("kind", "malformed").agg(F.count("*").alias("n_values"), F.countDistinct("key").alias("n_records"))


def _nested(spark: SparkSession, d: str) -> tuple[DataFrame, str, str]:
    items = table(spark, d, "tmp_experience_input").select(F.concat_ws("|", F.coalesce("source_candidate_id", F.lit("")), F.coalesce("source_path", F.lit("")), F.coalesce(F.col("source_array_index").cast("string"), F.lit(""))).alias("key"), F.col("raw_item").alias("body"))
    payloads = table(spark, d, "tmp_source_document_input").select(F.col("external_source_ref").alias("key"), F.col("raw_payload").alias("body"))
    return items.unionByName(payloads), "key", "body"


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """All objects inside the work history items and document payloads, each with its parent."""
    return nested_objects(*_nested(spark, d))


def p4_members(spark: SparkSession, d: str) -> DataFrame:
    """The scalar members of all these objects."""
    return members_table(nested_nodes(*_nested(spark, d)))


# target tables: the members under which their objects are held, and their columns
TABLES = {
    "p4_jobs": (("experience", "workExperience"), {"title": ("string", ("title",)), "company": ("string", ("company", "organization"))}),
    "p4_positions": (("positions",), {"title": ("string", ("title",)), "months": ("int", ("months",))}),
    "p4_skills": (("skills",), {"name": ("string", ("name",))}),
    "p4_companies": (("company", "organization"), {"name": ("string", ("name",)), "followers": ("int", ("followers",)), "company_ref": ("string", ("companyId", "linkedinUrl"))}),
}


def _table_query(name: str):
    return lambda spark, d: flat_table(nested_nodes(*_nested(spark, d)), *TABLES[name])


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Continuous periods of employment of every candidate, and the gaps between them."""
    return continuous_periods(table(spark, d, "tmp_experience_input"), "source_candidate_id", "start_date_raw", "end_date_raw", "raw_is_current")


P7_SQL = """
with spans as (
  select source_candidate_id as entity, date_diff('day', date '1970-01-01', start_date_raw) as lo,
         case when coalesce(raw_is_current, false) then 2147483647 else date_diff('day', date '1970-01-01', end_date_raw) end as hi
  from tmp_experience_input where source_candidate_id is not null and start_date_raw is not null),
valid as (select entity, lo, hi from spans where hi >= lo),
seen as (select entity, lo, hi, max(hi) over (partition by entity order by lo, hi rows between unbounded preceding and 1 preceding) as before from valid),
marked as (select entity, lo, hi, sum(case when before is null or lo > before + 1 then 1 else 0 end) over (partition by entity order by lo, hi rows unbounded preceding) as island from seen),
periods as (select entity, island, min(lo) as lo, max(hi) as hi from marked group by entity, island),
gaps as (select entity, hi + 1 as lo, lead(lo) over (partition by entity order by island) - 1 as hi from periods),
both_kinds as (select entity, 'period' as kind, lo, hi from periods union all select entity, 'gap', lo, hi from gaps where hi is not null)
select entity as source_candidate_id, kind, cast(date '1970-01-01' + cast(lo as integer) as varchar) as start_date,
       case when hi = 2147483647 then 'open' else cast(date '1970-01-01' + cast(hi as integer) as varchar) end as end_date
from both_kinds
"""

_held = lambda j: f"case when json_type({j}) = 'VARCHAR' and json_valid({j} ->> '$') and json_type(cast({j} ->> '$' as json)) in ('OBJECT', 'ARRAY') then cast({j} ->> '$' as json) else {j} end"
_NODES = f"""
with recursive texts as (
  select distinct key, cast(body as json) as j from (
    select coalesce(source_candidate_id, '') || '|' || coalesce(source_path, '') || '|' || coalesce(cast(source_array_index as varchar), '') as key, raw_item as body from tmp_experience_input
    union all select external_source_ref, raw_payload from tmp_source_document_input) where json_valid(body)),
nodes as (
  select key, '$' as path, '$' as above, {_held('j')} as j from texts
  union all
  select n.key, case json_type(n.j) when 'OBJECT' then n.path || '.' || e.key else n.path || '[' || e.key || ']' end,
         case json_type(n.j) when 'OBJECT' then n.path else n.above end, {_held('e.value')}
  from nodes n, json_each(n.j) e where json_type(n.j) in ('OBJECT', 'ARRAY')),
found as (select key as record_key, path as node_path, above as parent_path, j from nodes where json_type(j) = 'OBJECT' and path <> '$')
"""
P4_SQL = f"{_NODES} select record_key, node_path, parent_path from found"
P4_MEMBERS_SQL = f"{_NODES} select record_key, node_path, member, value ->> '$' as value from (select f.record_key, f.node_path, e.key as member, {_held('e.value')} as value from found f, json_each(f.j) e) where json_type(value) not in ('OBJECT', 'ARRAY')"


def _table_sql(name: str) -> str:
    names, columns = TABLES[name]
    member = lambda m: f"case when json_type({_held(f'json_extract(j, {chr(39)}$.{m}{chr(39)})')}) not in ('OBJECT', 'ARRAY') then json_extract_string(j, '$.{m}') end"
    cells = ", ".join(f"try_cast(coalesce({', '.join(member(m) for m in tries)}) as {'integer' if kind == 'int' else 'varchar'}) as {c}" for c, (kind, tries) in columns.items())
    return rf"{_NODES} select record_key, node_path, parent_path, try_cast(nullif(regexp_extract(node_path, '\[([0-9]+)\]$', 1), '') as integer) as ordinal, {cells} from found where regexp_extract(regexp_replace(node_path, '(\[[0-9]+\])+$', ''), '[.]([^.]*)$', 1) in ({', '.join(f"'{x}'" for x in names)})"


QUERIES = {"p2_found": p2_found, "p2_values": p2_values, "p2_malformed": p2_malformed, "p4_found": p4_found, "p4_members": p4_members, **{x: _table_query(x) for x in TABLES}, "p7_found": p7_found}
SQL = {"p4_found": P4_SQL, "p4_members": P4_MEMBERS_SQL, **{x: _table_sql(x) for x in TABLES}, "p7_found": P7_SQL}
