"""Work history: matching incoming jobs with existing ones by reference and by hash, and merging them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions import normalize as n

c = F.col


def match(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """What each incoming job does: (ref, candidate_id, hash, title, skip) against (id, ref, candidate_id, hash, title).

    By reference and by hash; if the two name different jobs it is ambiguous. Display text is replaced only if
    it differs in more than case and space, and a new hash must not be another job's.
    """
    by_ref = existing.groupBy("candidate_id", "ref").agg(F.min("id").alias("ref_id"), F.min_by("hash", "id").alias("ref_hash"), F.min_by("title", "id").alias("ref_title"), F.count("*").alias("n_ref"))
    by_hash = existing.groupBy("candidate_id", "hash").agg(F.min("id").alias("hash_id"), F.min_by("title", "id").alias("hash_title"), F.count("*").alias("n_hash"))
    rows = incoming.join(by_ref, ["candidate_id", "ref"], "left").join(by_hash, ["candidate_id", "hash"], "left")
    clash = (c("n_ref") > 1) | (c("n_hash") > 1) | F.coalesce(c("ref_id") != c("hash_id"), F.lit(False))
    target, old = F.coalesce("ref_id", "hash_id"), F.when(c("ref_id").isNotNull(), c("ref_title")).otherwise(c("hash_title"))
    retitled = ~n.search_text(old).eqNullSafe(n.search_text(c("title"))) & c("title").isNotNull()
    changed = retitled | (c("ref_id").isNotNull() & (c("ref_hash") != c("hash")))
    action = F.when(c("skip").isNotNull(), "skip").when(F.coalesce(clash, F.lit(False)), "ambiguous").when(target.isNull(), "create_new").when(F.coalesce(changed, F.lit(False)), "match_existing").otherwise("no_op")
    return rows.select("candidate_id", "ref", action.alias("action"), F.when(action.isin("match_existing", "no_op"), target).alias("matched_id"), F.when(action == "match_existing", F.when(retitled, c("title")).otherwise(old)).alias("new_title"))
