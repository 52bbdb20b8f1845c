"""Entity resolution by several keys with explicit ambiguity, set-based and in sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions import normalize as n
from rosterflow.operators.components import connected
from rosterflow.operators.joins import any_key, lookup
from rosterflow.runtime import ship

c = F.col


def company_keys(df: DataFrame, host: str) -> DataFrame:
    """source_id and normalized keys of company records: lid, uname, url, nname; clash if name and link disagree."""
    given, linked = n.profile_username(c("linkedin_username"), host), n.company_username_in_url(c("linkedin_url"), host)
    keyed = df.select("*", n.or_null(F.lower(F.trim("linkedin_id"))).alias("lid"), F.coalesce(given, linked).alias("uname"), n.company_url(c("linkedin_url"), host).alias("url"), n.company_name(c("name")).alias("nname"), F.coalesce(given != linked, F.lit(False)).alias("clash"))
    return keyed


def _differ(a: str, b: str) -> Column:
    return F.coalesce(c(a) != c(b), F.lit(False))


def _first(*rules: tuple[Column, str, Column | None, str | None]) -> Column:
    """The first rule that holds: (condition, decision, matched id, basis or kind of ambiguity)."""
    out = None
    for cond, decision, matched, why in rules:
        basis, kind = (None, why) if decision == "ambiguous" else (why, None)
        got = F.struct(F.lit(decision).alias("decision"), (matched if matched is not None else F.lit(None)).cast("string").alias("matched_id"), F.lit(basis).cast("string").alias("match_basis"), F.lit(kind).cast("string").alias("ambiguity_type"))
        out = F.when(cond, got) if out is None else out.when(cond, got)
    return out


def resolve_companies(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Decision for each incoming record (``company_keys``) against existing ones (id, lid, uname, url, nname).

    All keys of a record are looked up by one join over (kind, key) and come together again by its id, so no null key
    meets another. Existing strong keys must be unique (``winners``).
    Columns: source_id, decision, matched_id, match_basis, ambiguity_type. Nulls match nothing.
    """
    keys = ("lid", "uname", "url", "nname")
    pairs = lambda: F.inline(F.filter(F.array(*[F.struct(F.lit(k).alias("kind"), c(k).alias("key")) for k in keys]), lambda x: x["key"].isNotNull()))
    held = existing.select("id", c("lid").alias("held"), pairs()).groupBy("kind", "key").agg(F.min("id").alias("id"), F.min("held").alias("held"), F.count("*").alias("n"))
    own = F.struct("lid", "uname", "url", "clash").alias("own")
    # every record has a pair of its own that matches nothing, so that those without keys stay
    asked = incoming.select("source_id", own, pairs()).unionByName(incoming.select("source_id", own, F.lit("-").alias("kind"), c("source_id").alias("key")))
    at = lambda k, x: F.max(F.when(c("kind") == k, c(x)))
    rows = asked.join(held, ["kind", "key"], "left").groupBy("source_id").agg(F.max("own").alias("own"), at("lid", "id").alias("by_lid"), at("uname", "id").alias("by_uname"), at("uname", "held").alias("lid_uname"), at("url", "id").alias("by_url"), at("url", "held").alias("lid_url"), at("nname", "n").alias("n_named"), at("nname", "id").alias("by_name"))
    rows = rows.select("source_id", "own.*", "by_lid", "by_uname", "lid_uname", "by_url", "lid_url", "n_named", "by_name")
    new_id = c("lid").isNotNull() & c("by_lid").isNull()
    strong = F.coalesce("lid", "uname", "url").isNotNull()
    decided = _first(
        (c("clash"), "ambiguous", None, "conflicting_incoming_linkedin_identity"),
        (_differ("by_lid", "by_uname") | _differ("by_lid", "by_url") | _differ("by_uname", "by_url"), "ambiguous", None, "conflicting_existing_strong_identity"),
        (new_id & _differ("lid_uname", "lid"), "ambiguous", None, "linkedin_id_conflicts_with_username_match"),
        (new_id & _differ("lid_url", "lid"), "ambiguous", None, "linkedin_id_conflicts_with_url_match"),
        (c("by_lid").isNotNull(), "match_existing", c("by_lid"), "linkedin_id"),
        (c("by_uname").isNotNull() & (c("by_uname") == c("by_url")), "match_existing", c("by_uname"), "linkedin_username_and_url"),
        (c("by_uname").isNotNull(), "match_existing", c("by_uname"), "linkedin_username"),
        (c("by_url").isNotNull(), "match_existing", c("by_url"), "linkedin_url_normalized"),
        (strong, "create_new", None, None),
        (c("n_named") > 1, "ambiguous", None, "multiple_normalized_name_matches"),
        (c("n_named") == 1, "match_existing", c("by_name"), "normalized_name"),
        (F.lit(True), "create_new", None, None),
    )
    return rows.select("source_id", decided.alias("d")).select("source_id", "d.*")


def resolve_candidates(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Decision for each incoming candidate (source_id, uname, url, clash) against existing (id, uname, url)."""
    by = lambda k: existing.where(c(k).isNotNull()).select(c(k).alias(f"x_{k}"), c("id").alias(f"by_{k}"))
    rows = incoming.select("source_id", "uname", "url", "clash")
    for k in ("uname", "url"):
        rows = lookup(rows, k, by(k), f"x_{k}", "source_id")
    rows = lookup(rows, "source_id", existing.select(c("id").alias("x_id"), c("id").alias("by_id")), "x_id", "source_id")
    decided = _first(
        (c("clash"), "ambiguous", None, "conflicting_incoming_linkedin_identity"),
        (_differ("by_id", "by_uname") | _differ("by_id", "by_url"), "ambiguous", None, "legacy_id_conflicts_with_linkedin_identity"),
        (c("by_id").isNotNull(), "match_existing", c("by_id"), "legacy_candidate_id"),
        (_differ("by_uname", "by_url"), "ambiguous", None, "conflicting_existing_linkedin_identity"),
        (c("by_uname").isNotNull() & (c("by_uname") == c("by_url")), "match_existing", c("by_uname"), "linkedin_username_and_url"),
        (c("by_uname").isNotNull(), "match_existing", c("by_uname"), "linkedin_username"),
        (c("by_url").isNotNull(), "match_existing", c("by_url"), "linkedin_url_normalized"),
        (F.lit(True), "create_new", None, None),
    )
    return rows.select("source_id", decided.alias("d")).select("source_id", "d.*")


def evidence(decisions: DataFrame, incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Of ambiguous records, the existing ids that any key matches, sorted and distinct."""
    unclear = incoming.join(decisions.where("decision = 'ambiguous'").select("source_id", "ambiguity_type"), "source_id")
    hits = any_key(unclear, existing, [(k, k) for k in keys], "source_id", "id")
    found = hits.groupBy("source_id").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    return unclear.select("source_id", "ambiguity_type").join(found, "source_id", "left").select("source_id", "ambiguity_type", F.coalesce(F.array_join("ids", "|"), F.lit("")).alias("matched_record_ids"))


def log_ambiguities(new: DataFrame, open_: DataFrame) -> DataFrame:
    """Ambiguities to insert: one for each (entity, type, system, ref, input hash), none that is open already."""
    key = ["entity_type", "ambiguity_type", "source_system", "source_record_ref", "input_hash"]
    filled = [F.coalesce(c(k), F.lit("")).alias(k) for k in key]
    first = new.select(*filled).distinct()
    return first.join(open_.where("status = 'open'").select(*filled).distinct(), key, "left_anti")


def renew_ambiguities(new: DataFrame, log: DataFrame) -> DataFrame:
    """What happens to new ambiguities given a log (id, status, created): the newest open entry of the same record is renewed
    whatever its input was, else one is added. Repeated ambiguities of one record count once, the least input first.
    """
    key = ["entity_type", "source_system", "source_record_ref"]
    once = new.groupBy(*key).agg(F.min("input_hash").alias("input_hash"))
    newest = log.where("status = 'open'").groupBy(*key).agg(F.max(F.struct("created", "id")).alias("x"))
    got = once.join(newest, key, "left")
    return got.select(*key, "input_hash", F.when(c("x").isNull(), "insert").otherwise("renew").alias("action"), c("x.id").alias("log_id"))


def name_sequence(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Records that only have a name, as if taken one after another: later ones see what earlier ones made.

    The first record of a name nobody holds makes the company, the others match it.
    """
    names = existing.where("nname is not null").groupBy(c("nname").alias("x_n")).agg(F.count("*").alias("held"), F.min("id").alias("holder"))
    only = incoming.where("coalesce(lid, uname, url) is null and nname is not null and not clash")
    first = only.groupBy(c("nname").alias("x_n")).agg(F.min("source_id").alias("maker"))
    rows = lookup(lookup(only, "nname", names, "x_n", "source_id"), "nname", first, "x_n", "source_id")
    held = F.coalesce("held", F.lit(0))
    action = F.when(held > 1, "ambiguous").when((held == 0) & (c("source_id") == c("maker")), "create_new").otherwise("match_existing")
    return rows.select("source_id", "nname", action.alias("action"), F.when(held <= 1, F.coalesce("holder", "maker")).alias("company_id"))


def resolve_in_sequence(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Exact result of taking incoming records in order (phase, source_id), each seeing what the earlier ones wrote.

    Records and companies that share a key are connected; components can't influence one another, so the
    ladder runs row by row inside each component only. Components grow with shared keys, not with the table;
    a component is one group, so keys shared by very many records should be cleaned first.
    """
    ship(incoming.sparkSession)
    weak = incoming.where("coalesce(lid, uname, url) is null and nname is not null").select("nname").distinct()
    cols = ["lid", "uname", "url", "nname"]
    rows = incoming.select(F.concat(F.lit("r:"), "source_id").alias("node"), "phase", "clash", *cols).unionByName(existing.select(F.concat(F.lit("c:"), "id").alias("node"), F.lit(-1).alias("phase"), F.lit(False).alias("clash"), *cols))
    edges = None
    for k in cols:
        got = rows.where(c(k).isNotNull())
        got = got.join(weak, "nname", "left_semi") if k == "nname" else got
        got = got.select(c("node").alias("a"), F.concat(F.lit(f"{k}:"), c(k)).alias("b"))
        edges = got if edges is None else edges.union(got)
    grouped = rows.join(connected(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))
    out = "source_id string, action string, company_id string, basis string, ambiguity_type string"
    return grouped.groupBy("root").applyInPandas(_ladder, out)


def _ladder(group):
    import pandas as pd

    held: dict[str, dict] = {}
    by = {k: {} for k in ("lid", "uname", "url")}
    names: dict[str, set] = {}
    out = []
    for r in group.astype(object).where(group.notna(), None).sort_values(["phase", "node"]).to_dict("records"):
        ident = r["node"][2:]
        if r["node"][0] == "c":
            held[ident] = r
            for k in by:
                if r[k]:
                    by[k][r[k]] = ident
            if r["nname"]:
                names.setdefault(r["nname"], set()).add(ident)
            continue
        hits = {k: by[k].get(r[k]) if r[k] else None for k in by}
        found = {h for h in hits.values() if h}
        action, match, basis, why = "create_new", None, None, None
        if r["clash"]:
            why = "conflicting_incoming_linkedin_identity"
        elif len(found) > 1:
            why = "conflicting_existing_strong_identity"
        elif found and r["lid"] and not hits["lid"] and held[next(iter(found))]["lid"] not in (None, r["lid"]):
            why = "linkedin_id_conflicts_with_username_match" if hits["uname"] else "linkedin_id_conflicts_with_url_match"
        elif found:
            match = next(iter(found))
            basis = "linkedin_id" if hits["lid"] else "linkedin_username_and_url" if hits["uname"] and hits["url"] else "linkedin_username" if hits["uname"] else "linkedin_url_normalized"
        elif not any(r[k] for k in by) and r["nname"]:
            named = names.get(r["nname"], set())
            if len(named) > 1:
                why = "multiple_normalized_name_matches"
            elif named:
                match, basis = next(iter(named)), "normalized_name"
        if why:
            action = "ambiguous"
        else:
            if match:
                action = "match_existing"
            elif not any(r[k] for k in (*by, "nname")):
                action = "skip"
            else:
                held[ident] = {"lid": None, "uname": None, "url": None, "nname": None}
            if action != "skip":
                target = match or ident
                for k in by:  # blanks of the company are filled
                    if r[k] and not held[target][k]:
                        held[target][k] = r[k]
                        by[k][r[k]] = target
                if r["nname"] and not held[target]["nname"]:
                    held[target]["nname"] = r["nname"]
                    names.setdefault(r["nname"], set()).add(target)
        out.append((ident, action, (match or ident) if action in ("match_existing", "create_new") else None, basis, why))
    return pd.DataFrame(out, columns=["source_id", "action", "company_id", "basis", "ambiguity_type"])
