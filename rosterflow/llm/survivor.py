"""Best representative of each duplicate group: field-by-field survivorship in one aggregation.

Records are first collapsed to their distinct key combinations, each with its partial best of every field,
so a key that holds a third of all records is one row before anything is joined. Combinations that share a
key are connected, then the partial bests are merged per group by the same aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.normalize import SOURCE_RANKS
from rosterflow.operators.components import connected
from rosterflow.runtime import written

def trust(source: Column) -> Column:
    """Rank of a source, case and outer spaces aside; null and unknown ones rank 0."""
    known = F.create_map(*[F.lit(x) for pair in SOURCE_RANKS.items() for x in pair])
    return F.coalesce(F.element_at(known, F.lower(F.trim(source))), F.lit(0))


def profile_id(raw: Column) -> Column:
    return F.nullif(F.lower(F.trim(F.regexp_replace(raw, r"[\s\p{Z}]+", " "))), F.lit(""))


def handle(raw: Column) -> Column:
    """A handle as written alone: ``@x``, ``/company/x/``, a whole link; else null."""
    text = F.lower(F.trim(F.regexp_replace(raw, r"[\s\p{Z}]+", " ")))
    text = F.regexp_replace(F.regexp_replace(text, r"^(?:[a-z][a-z0-9+.-]*:)?//", ""), r"[?#].*$", "")
    text = F.regexp_replace(text, r"^(?:[a-z0-9-]+\.)*linkedin\.[a-z]+/+", "")
    text = F.regexp_replace(F.regexp_replace(text, r"^[@/]+", ""), r"^(?:in|company|school)/+", "")
    return F.nullif(F.regexp_extract(text, r"^@?([^/\s]+)", 1), F.lit(""))


def handle_in_link(raw: Column) -> Column:
    """The handle within a profile link of any notation; null where the link leads elsewhere."""
    text = F.lower(F.trim(F.regexp_replace(raw, r"[\s\p{Z}]+", " ")))
    found = F.regexp_extract(text, r"^(?:[a-z][a-z0-9+.-]*:)?/*(?:[a-z0-9-]+\.)*linkedin\.[a-z]+/+(?:company|school|in)/+([^/?#\s]+)", 1)
    return F.nullif(found, F.lit(""))


def _best(rank: Column, synced: Column, source_id: Column, filled: Column, value: Column | None = None) -> Column:
    """Composite whose least is the survivor: filled, highest rank, latest sync (null last), least id; then its value, if asked for.

    The order is that of a maximum over (filled, rank, sync) with the numbers negated, so that the id, for
    which the least wins, can close the same struct.
    """
    return F.when(filled & source_id.isNotNull(), F.struct((-rank).alias("rank"), synced.isNull().alias("never"), (-F.unix_micros(synced.cast("timestamp"))).alias("age"), source_id.alias("source_id"), *([] if value is None else [value.alias("value")])))


def _groups(records: DataFrame, source_id: str, keys: Sequence[tuple[str, Column]], rank: Column, synced: Column, filled: Mapping[str, Column], values: Mapping[str, Column]) -> DataFrame:
    """(group_id, best_0 ...): the composite of each field's survivor in each group of two records or more."""
    ident = F.col(f"`{source_id}`")
    names = [f"k{i}" for i in range(len(keys))]
    rows = records.select(ident.alias("source_id"), *[F.when(k.isNotNull(), F.concat(F.lit(f"{kind}:"), k)).alias(n) for n, (kind, k) in zip(names, keys)], *[_best(rank, synced, ident, f, values.get(x)).alias(f"best_{i}") for i, (x, f) in enumerate(filled.items())])
    rows = rows.where(F.col("source_id").isNotNull() & F.coalesce(*names).isNotNull())
    merged = [F.min(f"best_{i}").alias(f"best_{i}") for i in range(len(filled))]
    combos = rows.groupBy(*names).agg(F.min("source_id").alias("first"), F.max("source_id").alias("last"), *merged)
    combos = written(combos.withColumn("node", F.array_min(F.array(*names))), "combos")
    edges = combos.select(F.col("node").alias("a"), F.explode(F.array(*names)).alias("b"))
    roots = connected(edges)
    grouped = combos.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("group_id"), F.max("last").alias("last"), *merged)
    return grouped.where("group_id <> last")


def survivors(records: DataFrame, source_id: str, keys: Sequence[tuple[str, Column]], rank: Column, synced: Column, filled: Mapping[str, Column]) -> DataFrame:
    """(group_id, field, source_id): for each group and field the record whose value survives.

    ``keys``: (kind, key); equal keys of one kind, in whichever column, connect records. A group has two records or more; its id
    is the least source id. Records without id or without any key stand alone. Re-sent records count once. Of
    a field that no record fills there is no row.
    """
    grouped = _groups(records, source_id, keys, rank, synced, filled, {})
    out = F.filter(F.array(*[F.struct(F.lit(name).alias("field"), F.col(f"best_{i}.source_id").alias("source_id")) for i, name in enumerate(filled)]), lambda x: x["source_id"].isNotNull())
    return grouped.select("group_id", F.inline(out))


def best_records(records: DataFrame, source_id: str, keys: Sequence[tuple[str, Column]], rank: Column, synced: Column, filled: Mapping[str, Column], values: Mapping[str, Column]) -> DataFrame:
    """group_id and each field: one record a group, built of the values that survive; null where no record fills a field.

    The values travel in the composites, so the records are read once and joined with nothing. See ``survivors``.
    """
    grouped = _groups(records, source_id, keys, rank, synced, filled, values)
    return grouped.select("group_id", *[F.col(f"best_{i}.value").alias(name) for i, name in enumerate(filled)])


def _company_rules() -> tuple:
    c = F.col
    staffed = F.coalesce(c("staff_count") > 0, F.lit(False))
    named = F.coalesce(F.exists("industries", lambda x: F.coalesce(F.regexp_replace(x, r"[\s\p{Z}]+", "") != "", F.lit(False))), F.lit(False))
    keys = [("id", profile_id(c("linkedin_id"))), ("handle", handle(c("linkedin_username"))), ("handle", handle_in_link(c("linkedin_url")))]
    return "source_id", keys, trust(c("incoming_source")), c("last_enrichment_sync"), {"staff_count": staffed, "industries": named, "last_enrichment_sync": c("last_enrichment_sync").isNotNull()}


def company_survivors(companies: DataFrame) -> DataFrame:
    """Survivorship of legacy company records; see ``survivors``."""
    return survivors(companies, *_company_rules())


def company_records(companies: DataFrame) -> DataFrame:
    """One record for each company of several records; see ``best_records``."""
    return best_records(companies, *_company_rules(), {x: F.col(x) for x in ("staff_count", "industries", "last_enrichment_sync")})
