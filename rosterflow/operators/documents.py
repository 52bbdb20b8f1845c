"""Source documents: decisions against active ones, versions in order, text of sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.functions import normalize as n

c = F.col


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with their type, identity key and content hash; re-sent rows count once."""
    return docs.dropDuplicates(["external_source_ref"]).select("external_source_ref", c("source_candidate_id").alias("candidate_id"), n.or_null(F.lower(F.trim("source_type"))).alias("kind"), n.document_key(c("source_type"), c("source_subtype"), c("source_url"), c("external_source_ref"), c("metadata_json")).alias("identity_key"), n.content_hash(c("source_type"), c("normalized_text"), c("metadata_json")).alias("content_hash"), "effective_at")


def decide(incoming: DataFrame, active: DataFrame) -> DataFrame:
    """no_op, supersede, parallel or ambiguous for each incoming document against the active ones.

    ``active``: id, candidate_id, kind, identity_key, content_hash, version. Documents with a key are compared
    by key; anonymous ones by content. Rows without candidate or kind are left out.
    """
    rows = incoming.where("candidate_id is not null and kind is not null")
    pick = [F.count("*").alias("n"), F.min("id").alias("id"), F.max("version").alias("version"), F.min("content_hash").alias("hash")]
    by_key = active.where("identity_key is not null").groupBy("candidate_id", "kind", "identity_key").agg(*[x.alias(f"k_{a}") for x, a in zip(pick, ("n", "id", "version", "hash"))])
    by_hash = active.where("kind <> 'resume' or identity_key is null").groupBy("candidate_id", "kind", "content_hash").agg(*[x.alias(f"h_{a}") for x, a in zip(pick[:3], ("n", "id", "version"))])
    nameless = active.where("identity_key is null").groupBy("candidate_id", "kind").agg(F.count("*").alias("a_n"))
    got = rows.join(by_key, ["candidate_id", "kind", "identity_key"], "left").join(by_hash, ["candidate_id", "kind", "content_hash"], "left").join(nameless, ["candidate_id", "kind"], "left")
    named, one = c("identity_key").isNotNull(), c("k_n") == 1
    resume = c("kind") == "resume"
    many = F.when(c("kind") == "linkedin_profile", "multiple_active_linkedin_profiles").otherwise("multiple_active_document_identity_matches")

    def out(decision: str, matched: Column, version: Column, why: Column) -> Column:
        return F.struct(F.lit(decision).alias("decision"), matched.cast("string").alias("matched_id"), version.cast("int").alias("next_version"), why.cast("string").alias("ambiguity_type"))

    none = F.lit(None)
    d = (
        F.when(named & (c("k_n") > 1), out("ambiguous", none, none, many))
        .when(named & one & (c("k_hash") == c("content_hash")), out("no_op", c("k_id"), c("k_version"), none))
        .when(named & one, out("supersede", c("k_id"), c("k_version") + 1, none))
        .when(named, out("parallel", none, F.lit(1), none))
        .when(c("h_n") == 1, out("no_op", c("h_id"), c("h_version"), none))
        .when(c("h_n") > 1, out("ambiguous", none, none, F.when(resume, "multiple_anonymous_resume_content_matches").otherwise("multiple_same_content_matches")))
        .when(resume & (c("a_n") > 0), out("ambiguous", none, none, F.lit("anonymous_resume_identity_conflict")))
        .otherwise(out("parallel", none, F.lit(1), none))
    )
    return got.select("external_source_ref", d.alias("d")).select("external_source_ref", "d.*")


def applied(decisions: DataFrame) -> DataFrame:
    """(external_source_ref, change, version, is_active): rows that ``decisions`` of ``decide`` write.

    A new document is inserted; one that supersedes deactivates the row it matched, once however many do so; one that changes
    nothing keeps its match; an ambiguous one goes to the log only.
    """
    change = F.when(c("decision") == "no_op", "keep").when(c("decision") == "ambiguous", "log").otherwise("insert")
    new = decisions.select("external_source_ref", change.alias("change"), c("next_version").alias("version"), (~c("decision").isin("ambiguous", "no_op")).alias("is_active"))
    old = decisions.where("decision = 'supersede'").groupBy(c("matched_id").alias("external_source_ref")).agg(F.min(c("next_version") - 1).alias("version"))
    return new.unionByName(old.select("external_source_ref", F.lit("deactivate").alias("change"), "version", F.lit(False).alias("is_active")))


def versions(docs: DataFrame) -> DataFrame:
    """Documents of one family in order of time: what each does and which version it is.

    A document with the hash of the one before it is a no_op; another supersedes it. Documents without date come last.
    """
    w = Window.partitionBy("candidate_id", "kind", "identity_key").orderBy(c("effective_at").asc_nulls_last(), "external_source_ref")
    rows = docs.withColumn("before", F.lag("content_hash").over(w)).withColumn("new", (~c("content_hash").eqNullSafe(c("before"))).cast("int"))
    rows = rows.withColumn("version", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.lead("external_source_ref").over(w).isNull()
    action = F.when(c("before").isNull(), "insert").when(c("new") == 1, "supersede").otherwise("no_op")
    return rows.withColumn("is_last", last).select("external_source_ref", "candidate_id", "kind", action.alias("action"), "version", "is_last")


def sectioned_text(sections: list[tuple[str, Column]]) -> Column:
    """``## Title`` and text of each section that has any, with blank lines between."""
    parts = F.array(*[F.when(v.isNotNull(), F.concat(F.lit(f"## {title}\n"), v)) for title, v in sections])
    return n.or_null(F.array_join(F.array_compact(parts), "\n\n"))


def split_sections(docs: DataFrame, key: str, text: str, limit: int = 1200) -> DataFrame:
    """Chunks of sectioned texts: one for each ``## `` section, longer ones by paragraph; chunk_index from 0.

    ``limit`` is the length up to which a section stays whole. Texts without sections are one section ``body``.
    """
    lines = n.document_text(F.concat(F.lit(""), c(f"`{text}`")))
    sections = F.filter(F.split(F.concat(F.lit("\n"), lines), "\n## "), lambda x: F.trim(F.replace(x, F.lit("\n"), F.lit(" "))) != "")
    pieces = F.flatten(F.transform(sections, lambda s: F.when(F.length(s) <= limit, F.array(s)).otherwise(F.split(s, "\n"))))
    rows = docs.where(c(f"`{text}`").isNotNull()).select(c(f"`{key}`").alias(key), F.posexplode(pieces).alias("chunk_index", "chunk_text"))
    return rows.where("trim(chunk_text) <> ''").select(key, "chunk_index", F.trim(F.regexp_replace("chunk_text", "^\n+", "")).alias("chunk_text")).withColumn("char_count", F.length("chunk_text")).withColumn("token_estimate", F.ceil(c("char_count") / 4).cast("int"))
