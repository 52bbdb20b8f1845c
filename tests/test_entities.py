import random

from pyspark.sql import functions as F

from rosterflow.operators import components, documents, emails, experience, merge, quality, resolve
from rosterflow.operators.joins import any_key, winners
from rosterflow.sources import tables

H = "linkedin.com"
KEYS = "source_id string, name string, linkedin_id string, linkedin_username string, linkedin_url string"


def companies(spark, rows):
    return resolve.company_keys(spark.createDataFrame(rows, KEYS), H)


def test_company_ladder(spark):
    old = companies(spark, [("1", "Acme Inc", "li-1", "acme", None), ("2", "Beta", None, "beta", "linkedin.com/company/beta"), ("3", "Twin", None, None, None), ("4", "Twin Ltd", None, None, None), ("5", "Solo", None, None, None)]).withColumn("id", F.col("source_id"))
    new = companies(spark, [("a", None, "LI-1 ", None, None), ("b", None, None, "@beta", None), ("c", None, None, "x", "linkedin.com/company/y"), ("d", None, "li-1", "beta", None), ("e", None, "li-9", "acme", None), ("f", "Solo LLC", None, None, None), ("g", "TWIN", None, None, None), ("h", "Solo", "li-8", None, None), ("i", None, None, None, None), ("j", None, None, None, "https://de.linkedin.com/company/Beta/about")])
    got = {r.source_id: (r.decision, r.matched_id, r.match_basis or r.ambiguity_type) for r in resolve.resolve_companies(new, old).collect()}
    assert got == {
        "a": ("match_existing", "1", "linkedin_id"),
        "b": ("match_existing", "2", "linkedin_username"),
        "c": ("ambiguous", None, "conflicting_incoming_linkedin_identity"),
        "d": ("ambiguous", None, "conflicting_existing_strong_identity"),
        "e": ("ambiguous", None, "linkedin_id_conflicts_with_username_match"),
        "f": ("match_existing", "5", "normalized_name"),
        "g": ("ambiguous", None, "multiple_normalized_name_matches"),
        "h": ("create_new", None, None),
        "i": ("create_new", None, None),
        "j": ("match_existing", "2", "linkedin_username_and_url"),
    }


def test_sequence_equals_one_after_another(spark):
    rng = random.Random(11)
    pick = lambda p, xs: rng.choice(xs) if rng.random() < p else None
    rows = [(f"s{i:03}", pick(0.7, [f"{x}{k}" for x in ("Acme", "Beta Ltd ", "Gamma") for k in range(9)]), pick(0.3, [f"li-{k}" for k in range(15)]), pick(0.3, [f"u{k}" for k in range(15)]), None) for i in range(150)]
    keyed = companies(spark, rows).withColumn("phase", F.when(F.coalesce("lid", "uname").isNotNull(), 0).otherwise(1))
    empty = companies(spark, []).withColumn("id", F.col("source_id"))
    got = {r.source_id: (r.action, r.company_id) for r in resolve.resolve_in_sequence(keyed, empty).collect()}
    whole = keyed.select(F.concat(F.lit("r:"), "source_id").alias("node"), "phase", "clash", "lid", "uname", "url", "nname").toPandas()
    want = {r.source_id: (r.action, r.company_id) for r in resolve._ladder(whole).itertuples()}
    assert got == want and {"create_new", "match_existing"} <= {a for a, _ in got.values()}


def test_components(spark):
    rng = random.Random(4)
    edges = [(f"n{rng.randrange(400):03}", f"n{rng.randrange(400):03}") for _ in range(260)] + [(f"p{i:03}", f"p{i + 1:03}") for i in range(100)] + [(None, "x"), ("x", None), ("y", "y")]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a and b and a != b:
            a, b = sorted((find(a), find(b)))
            up[b] = a
    got = [(r.node, r.root) for r in components.connected(spark.createDataFrame(edges, "a string, b string")).collect()]
    assert len(got) == len(set(got)) and dict(got) == {x: find(x) for x in up}


def test_keys(spark):
    a = spark.createDataFrame([("1", "x", None), ("2", "x", "p"), ("3", None, "p"), ("4", None, None)], "source_id string, k string, m string")
    assert sorted(r.source_id for r in winners(a, ["k", "m"], "source_id").collect()) == ["1", "4"]
    b = a.withColumnRenamed("source_id", "id")
    assert {tuple(r) for r in any_key(a, b, [("k", "k"), ("m", "m")], "source_id", "id").collect()} == {("1", "1"), ("1", "2"), ("2", "1"), ("2", "2"), ("2", "3"), ("3", "2"), ("3", "3")}


def _folded(old, rows):
    """The merge as it is told: one record after another."""
    source, name, tags, size = old[1:]
    for _, src, nm, tg, sz in sorted(rows):
        up = RANK.get((src or "").strip().lower(), 0) > RANK.get((source or "").strip().lower(), 0)
        if nm and nm.strip() and (not (name and name.strip()) or up):
            name = nm
        if tg and (not tg_ok(tags) or up):
            tags = tg
        if sz is not None and (size is None or up):
            size = sz
        if src and src.strip() and (not (source and source.strip()) or up):
            source = src
    return source, name, tags, size


def tg_ok(x):
    return bool(x)


RANK = {"linkedin_profile": 500, "legacy_backfill": 400, "resume": 300, "transcript_summary": 200, "manual_profile_note": 100}


def test_fold_is_the_merge_in_order(spark):
    rng = random.Random(4)
    sources = [*RANK, None, " ", "odd", " RESUME "]
    value = lambda: (rng.choice(sources), rng.choice([None, "", " ", "a", "b", "c"]), rng.choice([None, [], ["x"], ["y", None]]), rng.choice([None, 1, 2, 3]))
    old = [(str(i), *value()) for i in range(200)]
    new = [(o[0], j, *value()) for o in old for j in range(rng.randrange(6))]
    new += [("7", 100 + j, "odd", "late", None, None) for j in range(2_000)]  # a hot company
    kind = "source string, name string, tags array<string>, size int"
    e, i = spark.createDataFrame(old, f"id string, {kind}"), spark.createDataFrame(new, f"matched_id string, at int, {kind}").repartition(5)
    fields = {"name": "text", "tags": "list", "size": "value"}
    got = {r.id: r for r in merge.fold(e, i, fields, ["at"]).collect()}
    want = {o[0]: _folded(o, [(j, *v) for m, j, *v in new if m == o[0]]) for o in old if any(m == o[0] for m, *_ in new)}
    assert {k: (r.source, r.name, r.tags, r["size"]) for k, r in got.items()} == want
    assert all((r.effective_action == "no_op") == (tuple(want[k]) == old[int(k)][1:]) and r.n_merged == sum(m == k for m, *_ in new) for k, r in got.items())
    assert merge.fold(e, i.limit(0), fields, ["at"]).count() == 0 and merge.fold(e.limit(0), i, fields, ["at"]).count() == 0


def test_refs(spark):
    df = spark.createDataFrame([("a", '[{"x": 1}, {"x": 1}, "t"]'), ("a", '{"x": 1}'), ("b", "broken"), ("c", None), ("d", "[]")], "k string, j string")
    assert sorted(map(tuple, df.select(*merge.refs(F.col("k"), F.col("j"))).distinct().collect())) == [("a", '"t"'), ("a", '{"x":1}')]


def test_mail_merge_and_demotion(spark):
    from datetime import datetime as t

    cols = "candidate_id string, priority int, row_id string, email string, is_primary boolean, quality string, result string, verification_date timestamp, verification_attempts int, last_verification_attempt timestamp, created timestamp, kind string, source string, resultcode string, subresult string, raw_response string"
    row = lambda c, i, e, p, q, v, n, made, s="form", raw=None: (c, 0, i, e, p, q, None, v, n, v, made, None, s, None, None, raw)
    a, b = t(2024, 1, 1), t(2025, 1, 1)
    rows = spark.createDataFrame([row("1", "x", "p@m", True, " ", a, 1, a), row("1", "y", "p@m", False, "good", b, 3, b, raw="{}"), row("1", "z", "q@m", True, "good", None, 0, None), row("2", "u", "r@m", True, None, None, 0, a, "legacy_candidate_emails"), row("2", "w", "s@m", True, None, None, 0, a)], cols)
    got = emails.merged(rows).collect()
    assert [(r.email, r.row_id, r.merged_row_id, r.quality, r.verification_date, r.verification_attempts) for r in got] == [("p@m", "x", "y", "good", b, 3)]
    plan = spark.createDataFrame([("1", "p@m"), ("2", None)], "candidate_id string, primary_email string")
    assert sorted((r.candidate_id, r.email) for r in emails.demotions(rows, plan).collect()) == [("1", "q@m"), ("2", "r@m")]
    assert emails.merged(rows.limit(0)).count() == 0


def test_ambiguities_are_logged_once(spark):
    schema = "entity_type string, ambiguity_type string, source_system string, source_record_ref string, input_hash string"
    new = spark.createDataFrame([("c", "t", None, "1", "h"), ("c", "t", None, "1", "h"), ("c", "t", "s", "2", "h")], schema)
    opened = spark.createDataFrame([("c", "t", "s", "2", "h", "open"), ("c", "t", None, "1", "h", "resolved")], schema + ", status string")
    assert [r.source_record_ref for r in resolve.log_ambiguities(new, opened).collect()] == ["1"]


def test_document_decisions(spark):
    schema = "candidate_id string, kind string, identity_key string, content_hash string"
    active = spark.createDataFrame([("a", "linkedin_profile", "linkedin_profile", "h1", "d1", 1), ("b", "linkedin_profile", "linkedin_profile", "h1", "d2", 1), ("b", "linkedin_profile", "linkedin_profile", "h2", "d3", 2), ("a", "resume", None, "h1", "d4", 1), ("c", "note", None, "h1", "d5", 1), ("c", "note", None, "h1", "d6", 2)], schema + ", id string, version int")
    new = spark.createDataFrame([("a", "linkedin_profile", "linkedin_profile", "h1", "1"), ("a", "linkedin_profile", "linkedin_profile", "h2", "2"), ("b", "linkedin_profile", "linkedin_profile", "h1", "3"), ("c", "linkedin_profile", "linkedin_profile", "h1", "4"), ("a", "resume", None, "h1", "5"), ("a", "resume", None, "h2", "6"), ("b", "resume", None, "h1", "7"), ("c", "note", None, "h1", "8"), ("c", "note", None, "h2", "9"), (None, "note", None, "h", "10")], schema + ", external_source_ref string")
    got = {r.external_source_ref: (r.decision, r.next_version, r.ambiguity_type) for r in documents.decide(new, active).collect()}
    assert got == {"1": ("no_op", 1, None), "2": ("supersede", 2, None), "3": ("ambiguous", None, "multiple_active_linkedin_profiles"), "4": ("parallel", 1, None), "5": ("no_op", 1, None), "6": ("ambiguous", None, "anonymous_resume_identity_conflict"), "7": ("parallel", 1, None), "8": ("ambiguous", None, "multiple_same_content_matches"), "9": ("parallel", 1, None)}


def test_experience_match(spark):
    old = spark.createDataFrame([("x", "0", "c", "h0", "Dev"), ("y", "1", "c", "h1", "Ops")], "id string, ref string, candidate_id string, hash string, title string")
    new = spark.createDataFrame([("0", "c", "h0", " dev ", None), ("1", "c", "h9", "Ops Lead", None), ("7", "c", "h1", "Ops", None), ("0", "c", "h1", "Ops", None), ("9", "c", "h7", "New", None), ("9", "d", "h7", "New", "missing_candidate_link")], "ref string, candidate_id string, hash string, title string, skip string")
    got = sorted((r.candidate_id, r.ref, r.action, r.new_title) for r in experience.match(new, old).collect())
    assert got == [("c", "0", "ambiguous", None), ("c", "0", "no_op", None), ("c", "1", "match_existing", "Ops Lead"), ("c", "7", "no_op", None), ("c", "9", "create_new", None), ("d", "9", "skip", None)]


def test_quality_and_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, None)], "k int, v string")
    assert quality.duplicates(df, ["k"]).count() == 1
    assert [r.v for r in quality.out_of_vocabulary(df, "v", ["a"]).collect()] == ["b"]
    assert [(r.column_name, r.actual) for r in quality.schema_diff(spark, df, {"k": "int", "w": "string"}).collect()] == [("v", "string"), ("w", None)]
    assert tables.project(df, {"k": "long", "v": ("string", ["w", "v"]), "z": "date"}).dtypes == [("k", "bigint"), ("v", "string"), ("z", "date")]
    assert [r.k for r in tables.keyset_page(df, ["k"], (1,), 1).collect()] == [2]
    order = spark.createDataFrame([(2, 0), (1, 1)], "k int, ordinality int")
    assert [r.k for r in tables.by_manifest(df.dropDuplicates(["k"]), order, "k").collect()] == [2, 1]
    (tmp_path / "m.json").write_text('{"x": {"match_action": "create_new", "resolved_candidate_id": "y"}}')
    assert tables.candidate_map(spark, str(tmp_path / "m.json")).first().resolved_candidate_id == "y"
