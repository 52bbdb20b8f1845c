"""Source-precedence merge of incoming records into existing ones, with no-op detection; written as a rewrite.

Records that match one existing record merge in order: each fills blanks, and replaces values where its source outranks that of
the record as merged so far. ``fold`` gives the result of this sequence as aggregations. A record outranks all
before it only if it is the first of its rank, so one record a rank and group is all that has to meet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions import normalize as n

c = F.col


def filled(x: Column, kind: str) -> Column:
    """Whether a value counts: a text that isn't blank, a list with elements, a struct whose first member is filled."""
    if kind == "text":
        return n.trimmed(x).isNotNull()
    if kind == "list":
        return F.coalesce(F.size(x) > 0, F.lit(False))
    return x.isNotNull()


def fold(existing: DataFrame, incoming: DataFrame, fields: Mapping[str, str], order: Sequence[str]) -> DataFrame:
    """Existing records that any incoming one matches, with all of these merged into them in order.

    ``existing``: id, source and fields; ``incoming``: matched_id, source, the columns of ``order`` (unique together) and fields.
    ``fields``: name -> text, list or value. A field is that of the last incoming record that outranks all before it and
    fills it, else the existing one if filled, else the first that fills it; the source alike. Out come id, the fields, source,
    n_merged and effective_action (no_op or update). Two partial aggregations, no window: a group of any size is spread.
    """
    kinds = {"source": "text", **fields}
    ord_ = F.struct(*[c(x) for x in order])
    rows = incoming.select("matched_id", ord_.alias("ord"), n.source_rank(c("source")).alias("rank"), *kinds)
    fills = [F.min(F.when(filled(c(f), k), F.struct("ord", c(f).alias("v")))).alias(f"fill_{f}") for f, k in kinds.items()]
    ranks = rows.groupBy("matched_id", "rank").agg(F.min(F.struct("ord", *kinds)).alias("first"), F.count("*").alias("k"), *fills)
    # one entry for each rank: as many as there are ranks of sources
    groups = ranks.groupBy(c("matched_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct((-c("rank")).alias("down"), "rank", "first"))).alias("tops"), F.sum("k").alias("n_merged"), *[F.min(f"fill_{f}").alias(f"fill_{f}") for f in kinds])
    both = existing.select("id", *[c(f).alias(f"old_{f}") for f in kinds]).join(groups, "id")
    over = F.filter("tops", lambda x: (x["rank"] > n.source_rank(c("old_source"))) & ~F.exists("tops", lambda y: (y["rank"] >= x["rank"]) & (y["first"]["ord"] < x["first"]["ord"])))
    both = both.withColumn("over", over)
    out = []
    for f, kind in kinds.items():
        best = F.filter("over", lambda x: filled(x["first"][f], kind))  # noqa: B023
        out.append(F.when(F.size(best) > 0, best[0]["first"][f]).when(filled(c(f"old_{f}"), kind), c(f"old_{f}")).otherwise(F.coalesce(c(f"fill_{f}.v"), c(f"old_{f}"))).alias(f))
    merged = both.select("id", "n_merged", *out, *[f"old_{f}" for f in kinds])
    same = F.lit(True)
    for f in kinds:
        same = same & c(f).eqNullSafe(c(f"old_{f}"))
    return merged.select("id", *kinds, "n_merged", F.when(same, "no_op").otherwise("update").alias("effective_action"))


def refs(id_: Column, json: Column) -> tuple[Column, Column]:
    """(id, ref) of each element of a JSON array of references, or of a single object, for ``select``."""
    doc = F.try_parse_json(json)
    many = F.coalesce(F.try_variant_get(doc, "$", "array<variant>"), F.when(F.try_variant_get(doc, "$", "map<string,variant>").isNotNull(), F.array(doc)))
    return id_.alias("id"), F.explode(F.array_distinct(F.transform(many, lambda x: F.to_json(x)))).alias("ref")


def upsert(existing: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The whole table after an upsert: rows of ``changes`` replace those of equal key, new ones are added."""
    return existing.join(changes.select(key), key, "left_anti").unionByName(changes.select(*existing.columns))
