"""Mail survivorship, cross-candidate conflicts and the choice of a primary address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions import normalize as n

c = F.col
DETAILS = ("quality", "result", "verification_date", "verification_attempts", "last_verification_attempt")


# Source labels of addresses that only the legacy tables vouch for.
LEGACY_LABELS = ("legacy_candidate_emails", "legacy_candidates_email_fallback")
TEXTS = ("kind", "source", "quality", "result", "resultcode", "subresult")


def email_rows(emails: DataFrame, candidates: DataFrame) -> DataFrame:
    """Direct rows of known candidates and the fallback row of each candidate, with normalized addresses; re-sent rows count once."""
    known = candidates.select("source_candidate_id", "fallback_email_raw", "legacy_created_at").dropDuplicates(["source_candidate_id"])
    direct = emails.dropDuplicates(["source_row_id"]).join(known.select("source_candidate_id"), "source_candidate_id", "left_semi")
    direct = direct.select(c("source_candidate_id").alias("candidate_id"), F.lit(0).alias("priority"), c("source_row_id").alias("row_id"), n.email_address(c("email_raw")).alias("email"), F.coalesce("raw_is_primary", F.lit(False)).alias("is_primary"), *DETAILS, c("source_created_at").alias("created"), c("raw_email_type").alias("kind"), F.coalesce("raw_email_source", F.lit(LEGACY_LABELS[0])).alias("source"), "resultcode", "subresult", "raw_response")
    given = {"candidate_id": c("source_candidate_id"), "priority": F.lit(1), "row_id": c("source_candidate_id"), "email": n.email_address(c("fallback_email_raw")), "is_primary": F.lit(False), "created": c("legacy_created_at"), "source": F.lit(LEGACY_LABELS[1])}
    back = known.select(*[given.get(x, F.lit(None)).cast(direct.schema[x].dataType).alias(x) for x in direct.columns])
    rows = direct.unionByName(back).where("email is not null")
    return rows.withColumn("verification_attempts", F.coalesce("verification_attempts", F.lit(0)))


def unsuppressed(rows: DataFrame) -> DataFrame:
    """Fallback rows give way to a direct row of the same candidate and address."""
    direct = rows.where("priority = 0").select("candidate_id", "email").distinct()
    return rows.where("priority = 0").unionByName(rows.where("priority = 1").join(direct, ["candidate_id", "email"], "left_anti"))


def _late(x: str) -> Column:
    """Latest first, nulls last, as numbers of which the least comes first."""
    return F.struct(c(x).isNull().alias("none"), (-F.unix_micros(c(x).cast("timestamp"))).alias("at"))


def preference() -> list[Column]:
    """What makes one row better than another, as a key of which the least is the best."""
    return [c("priority"), (~c("is_primary")).alias("second"), _late("verification_date").alias("verified"), (-c("verification_attempts")).alias("tries"), _late("last_verification_attempt").alias("tried"), F.struct(c("created").isNull().alias("none"), F.unix_micros(c("created").cast("timestamp")).alias("at")).alias("since"), c("row_id")]


def survivors(rows: DataFrame) -> DataFrame:
    """The best row of each candidate and address, and how many rows and flagged rows it stands for.

    One partial aggregation over ordered structs in place of a ranking window, so large groups don't meet.
    """
    best = F.min(F.struct(*preference(), F.struct(*[c(x) for x in ("is_primary", *DETAILS, "created")]).alias("kept"))).alias("best")
    got = rows.groupBy("candidate_id", "email").agg(best, F.count("*").alias("n_rows"), F.count_if("is_primary").alias("n_primary"))
    return got.select("candidate_id", "email", "best.row_id", "best.priority", "best.kept.*", "n_rows", "n_primary")


def lineage(rows: DataFrame) -> DataFrame:
    """Ids of all rows behind each survivor, the best first."""
    got = rows.groupBy("candidate_id", "email").agg(F.array_sort(F.collect_list(F.struct(*preference()))).alias("all"))
    return got.select("candidate_id", "email", F.array_join(F.transform("all", lambda x: x["row_id"]), "|").alias("contributors"))


def conflicts(kept: DataFrame, claims: DataFrame) -> DataFrame:
    """Survivors whose address another candidate holds, or that several want and none holds.

    ``claims``: (email, holder). Adds holder and the claimants; the others are what may be written.
    """
    wanted = kept.groupBy("email").agg(F.countDistinct("candidate_id").alias("n_candidates"))
    rows = kept.join(wanted, "email").join(claims, "email", "left")
    return rows.withColumn("conflict", F.when(c("holder").isNull(), c("n_candidates") > 1).otherwise(c("holder") != c("candidate_id")))


def primary_plan(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Each candidate's primary address: the flagged one, the best flagged, the only one, the fallback, or none.

    ``kept`` is the result of ``conflicts``; the flag is that of the surviving row.
    """
    free = kept.where("not conflict")
    best = F.min(F.when(c("is_primary"), F.struct(*preference(), c("email")))).alias("best")
    per = free.groupBy("candidate_id").agg(F.count("*").alias("n_emails"), F.count_if("is_primary").alias("n_flagged"), best, F.min("email").alias("only"))
    hint = rows.where("priority = 1").groupBy("candidate_id").agg(F.count("*").alias("n_hints"), F.min("email").alias("hint"))
    hint = hint.where("n_hints = 1").join(free.select("candidate_id", c("email").alias("hint")), ["candidate_id", "hint"], "left_semi")
    got = per.join(hint, "candidate_id", "left")
    rule = F.when(c("n_flagged") == 1, "flagged").when(c("n_flagged") > 1, "best_flagged").when(c("n_emails") == 1, "only").when(c("hint").isNotNull(), "fallback").otherwise("none")
    choice = F.when(c("n_flagged") > 0, c("best.email")).when(c("n_emails") == 1, c("only")).otherwise(c("hint"))
    return got.select("candidate_id", "n_emails", "n_flagged", rule.alias("rule"), choice.alias("primary_email"))


def merged(rows: DataFrame) -> DataFrame:
    """The first row of each candidate and address, merged with the best of the others.

    Blank texts are filled, never replaced; the newest times and the most attempts stay, and the first response that isn't null.
    Addresses with one row don't come out.
    """
    since = F.struct(c("created").isNull().alias("none"), F.unix_micros(c("created").cast("timestamp")).alias("at"))
    vals = F.struct(*TEXTS, "verification_date", "verification_attempts", "last_verification_attempt", "raw_response").alias("vals")
    first = rows.groupBy("candidate_id", "email").agg(F.min(F.struct(since.alias("since"), "row_id")).alias("f"), F.count("*").alias("n")).where("n > 1").select("candidate_id", "email", c("f.row_id").alias("first_id"))
    both = rows.join(first, ["candidate_id", "email"])
    late = c("row_id") != c("first_id")
    old = F.min(F.when(~late, F.struct("row_id", vals))).alias("old")
    new = F.min(F.when(late, F.struct(*preference(), vals))).alias("new")
    got = both.groupBy("candidate_id", "email").agg(old, new).where("new is not null")
    o, w = (lambda x: c(f"old.vals.{x}")), (lambda x: c(f"new.vals.{x}"))
    texts = [F.when(n.trimmed(o(x)).isNotNull(), o(x)).otherwise(F.coalesce(n.trimmed(w(x)), o(x))).alias(x) for x in TEXTS]
    latest = [F.greatest(o(x), w(x)).alias(x) for x in ("verification_date", "verification_attempts", "last_verification_attempt")]
    return got.select("candidate_id", "email", c("old.row_id").alias("row_id"), c("new.row_id").alias("merged_row_id"), *texts, *latest, F.md5(F.coalesce(o("raw_response"), w("raw_response"), F.lit(""))).alias("response_md5"))


def demotions(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Primary rows that lose the flag: with a choice all of other addresses, without one only those of LEGACY_LABELS.

    ``plan`` is that of ``primary_plan``; candidates that have no surviving address aren't touched.
    """
    choice = plan.select("candidate_id", "primary_email")
    flagged = rows.where("is_primary").join(choice, "candidate_id")
    lost = F.when(c("primary_email").isNotNull(), c("email") != c("primary_email")).otherwise(c("source").isin(*LEGACY_LABELS))
    return flagged.where(lost).groupBy("candidate_id", "email", "primary_email").agg(F.count("*").alias("n_rows"))
