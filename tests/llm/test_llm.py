import json
import random
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import compare
from rosterflow.llm import copies, garbled, mixing, neighbors, queries, spellings, survivor, tokens

D = "/root/testdata/sf0.001"
VOCABULARY = tokens.VOCABULARY


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    got, want = compare(spark, queries.QUERIES[name], queries.SQL[name], D)
    assert got == want and got


def test_queries_without_sql(spark):
    got = {x: queries.QUERIES[x](spark, D).collect() for x in sorted(set(queries.QUERIES) - set(queries.SQL))}
    texts = {r.doc_id: r for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    assert {r.doc_id for r in got["p8_ids"]} == set(texts) and all(tokens.decode_ids(list(r.ids)) == (texts[r.doc_id].text or "").encode() for r in got["p8_ids"])
    assert all(a < b for a, b in got["p6_found"]) and all(a < b for a, b in got["p5_found"])
    members: dict = {}
    for name, org in got["p5_members"]:
        members.setdefault(org, []).append(name)
    assert {(a, b) for g in members.values() for a in g for b in g if a < b} == {tuple(r) for r in got["p5_found"]}
    assert {r.doc_id for r in got["p10_found"]} == {r.doc_id for r in got["p10_restored"]} and all(r.restored != texts[r.doc_id].text or r.lossy for r in got["p10_restored"])
    goals = {r.source: r for r in spark.read.parquet(f"{D}/source_targets.parquet").collect()}
    assert {r.doc_id for r in got["p9_mix"]} == set(texts) and all(r.uses <= (goals[r.source].max_repeats if r.source in goals else 0) for r in got["p9_mix"])
    used: dict = {}
    for r in got["p9_mix"]:
        used[r.source] = used.get(r.source, 0) + r.uses * r.n_tokens
    assert all(r.used_tokens == used.get(r.source, 0) for r in got["p9_shares"])


# hidden copies

ADDRESSES = [
    (" Jo.Doe+cv@Mail.Example\r\n", "jo.doe+cv@mail.example"),
    ("MAILTO:jo_doe@mail.example?subject=Application", "jo_doe@mail.example"),
    ("e-mail - jo-doe@mail.example", "jo-doe@mail.example"),
    ('"Doe, Jo" <jo.doe @ mx.mail. example>;;', "jo.doe@mx.mail.example"),
    ("jo.doe@mail.example (Jo Doe).", "jo.doe@mail.example"),
    ("Jo Doe | ｊｏ＠mail.example", "jo@mail.example"),
    ("jo​.do\xade@ma⁠il.example", "jo.doe@mail.example"),
    ("«łucja@mail.example»", "łucja@mail.example"),
    ("unknown@", None),
    ("@", None),
    ("see notes", None),
    ("", None),
    (None, None),
    ("x" * 100_000 + "@mail.example", "x" * 100_000 + "@mail.example"),
]


def test_addresses(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(ADDRESSES)], "i int, raw string")
    got = {r.i: r.x for r in df.select("i", copies.mail_address(F.col("raw")).alias("x")).collect()}
    assert [got[i] for i in range(len(ADDRESSES))] == [w for _, w in ADDRESSES]


def test_collapse_splits_and_spreads(spark):
    rng = random.Random(2)
    values = ["same"] * 400 + ["a" * 50 + str(rng.randrange(200)) for _ in range(400)] + [f"{rng.randrange(300)}" for _ in range(400)] + ["", "a", "a" * 50]
    rows = [(f"id{i:05}", v.encode()) for i, v in enumerate(values)]
    rng.shuffle(rows)
    rows += rows[:300] + [(None, b"same"), ("idx", None)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "id string, value binary, bucket string, salt int").repartition(6)
    got = [tuple(r) for r in copies.collapse(df, limit=25).collect()]
    want = {}
    for i, v in rows:
        if i and v is not None:
            want.setdefault(v, set()).add(i)
    assert len(got) == sum(map(len, want.values()))
    assert {(bytes(v), i, k) for v, i, k in got} == {(v, i, min(m)) for v, m in want.items() for i in m}
    assert copies.collapse(df.limit(0)).count() == 0
    assert {(bytes(r.value), r.kept_id, r.n_records) for r in copies.counted(df, limit=25).collect()} == {(v, min(m), len(m)) for v, m in want.items()}
    assert copies.counted(df.limit(0)).count() == 0


def test_any_number_of_buckets_is_split_at_the_same_limit(spark, monkeypatch):
    monkeypatch.setattr(copies, "STEP", 3)
    df = spark.range(12_000).selectExpr("concat('r', id) as id", "encode(lpad(conv(cast(id % 4000 as string), 10, 36), 4, '0'), 'UTF-8') as value")
    parts = copies._buckets(df, 2).groupBy("bucket", "salt").count()
    assert parts.count() > 1_024 and parts.where("bucket = substring(bucket, 1, 0)").count() == 0
    assert copies.counted(df, limit=2).where("n_records = 3").count() == 4_000


# survivorship

COMPANY = "source_id string, linkedin_id string, linkedin_username string, linkedin_url string, incoming_source string, last_enrichment_sync timestamp, staff_count int, industries array<string>, field string, best_0 int"


def test_survivors(spark):
    from datetime import datetime as t

    a, b = t(2024, 1, 1), t(2025, 1, 1)
    rows = [
        ("1", " 77 ", None, None, " RESUME ", a, 5, [" "], "x", 1),
        ("2", "77", "@Acme/", None, "resume", b, 9, None, "x", 1),
        ("2", "77", "@Acme/", None, "resume", b, 9, None, "x", 1),
        ("3", None, None, "de.linkedin.example/company/ACME/about?x", "odd", None, -1, ["Food"], "x", 1),
        ("4", None, "/company/solo", None, "linkedin_profile", b, 7, ["A"], "x", 1),
        ("4", None, "/company/solo", None, "linkedin_profile", b, 7, ["A"], "x", 1),
        ("5", "", "", "https://x.example", None, None, None, None, "x", 1),
        ("7", "9", None, None, "resume", b, 3, ["A"], "x", 1),
        ("6", "9", None, None, "resume", b, 4, None, "x", 1),
        (None, "9", None, None, "linkedin_profile", b, 4, None, "x", 1),
    ]
    got = sorted(tuple(r) for r in survivor.company_survivors(spark.createDataFrame(rows, COMPANY)).collect())
    assert got == [("1", "industries", "3"), ("1", "last_enrichment_sync", "2"), ("1", "staff_count", "2"), ("6", "industries", "7"), ("6", "last_enrichment_sync", "6"), ("6", "staff_count", "6")]
    assert survivor.company_survivors(spark.createDataFrame([], COMPANY)).count() == 0


# spellings

SAME = [
    ["Dafukrol Heka Analytics Ltd", "DAFUKROL  HEKA ANALYTICS", "Dafukrol-Heka Analyt.", "Dafukrol H. Analytics (EMEA)", "The Dafurkol Heka Analytics Ltd.", "Analytics Dafukrol Heka", "Dafukrolheka Analytics"],
    ["Dafukrol Heka Publishing Group", "Dafukrol Heka Publ."],
    ["Katherine Bagegretretin Consulting", "Kathy Bagegretretin Cons.", "Bagegretretin, Kate - Consulting", "Consulting by K. Bagegretretin"],
    ["Robert Bagegretretin Consulting"],
    ["University of Kodramix Rupo", "Univ. of Kodramix Rupo", "UNI KODRAMIX RUPO"],
]


def test_spellings(spark):
    rows = [(n,) for group in SAME for i, n in enumerate(group) for _ in range(9 if i == 0 else 1)] + [("Freelance",), ("N/A",), (" ",), (None,), ("self-employed",)]
    df = spark.createDataFrame([(n, "x", "y") for n, in rows], "name string, form string, organisation string")
    got = {tuple(r) for r in spellings.spelling_pairs(df).collect()}
    assert got == {(a, b) for g in SAME for a in g for b in g if a < b}
    assert spellings.spelling_pairs(df.limit(0)).count() == 0


APART = [[("Acme", 1000), ("Acme Widgets", 1)], [("Sony", 1000), ("Sonny", 900)], [("Apple", 2000), ("Apple Bank", 2)], [("Robert Zukor Consulting", 9), ("Richard Zukor Consulting", 1)], [("Stratus Consulting", 1), ("Stratus Brewing", 1000)]]
TOGETHER = [[("Nimbus Dentistry", 9), ("Nimbus Dent.", 1)], [("Nimbus Brewing", 9), ("Nimbus Brew.", 1)], [("Charles Kowal Consulting", 9), ("Chuck Kowal Consulting", 1)], [("Jennifer Kowal Law", 9), ("Jenny Kowal Law", 2)], [("Bartholomew Orly Roofing", 3), ("Bart Orly Roofing", 3)], [("Tolver Heka Masonry", 4), ("Masonry Tolver Heka", 1)]]


def test_self_is_a_candidate_and_lists_gate_nothing(spark):
    df = spark.createDataFrame([(n,) for g in APART + TOGETHER for n, k in g for _ in range(k)], "name string")
    got = {tuple(r) for r in spellings.spelling_pairs(df).collect()}
    assert got == {tuple(sorted(n for n, _ in g)) for g in TOGETHER}


# what shared no key: a trade untold beside another error, other words all common, a head in one word, letters beyond the second, nicknames listed otherwise, initials on both sides, no proper name
KEPT_APART = [[("Robins", 1000), ("RBS", 3)], [("Sunrise", 1000), ("Sun", 3)], [("Hyperion", 1000), ("HP", 20)], [("J Consulting", 20), ("K Consulting", 1)]]
LINKED = [[("Kemvik Ronal Analytics", 50), ("Ronal Kemvik", 1)], [("Marvexin Hotel", 40), ("Mrvx Hotel", 1)], [("Brixtonia Foods", 50), ("Brix. Foods", 1)], [("Harbor Stone Analytics", 50), ("Hrbr Stone Analytics", 1)], [("Tolvero Pegasus Analytics", 50), ("Tolvero Peg Analytics", 1)], [("Umbrel Lisken P Foods", 30), ("Umbrell P Foods", 1)], [("Consulting Group", 9), ("Consulting Group Ltd", 1)], [("Capital Holdings", 9), ("Captal Holdings", 1)]]


def test_whatever_meets_the_threshold_is_a_candidate(spark):
    hotels = [(f"{a}{b}la Hotel",) for a in ("Wend", "Zarg", "Plom", "Quix", "Jorv") for b in "aeioutnrs" for _ in range(3)]
    df = spark.createDataFrame(hotels + [(n,) for g in KEPT_APART + LINKED for n, k in g for _ in range(k)], "name string")
    got = {tuple(r) for r in spellings.spelling_pairs(df).collect()}
    assert got == {tuple(sorted(n for n, _ in g)) for g in LINKED}


_word = st.one_of(st.text("abrst", min_size=1, max_size=6), st.sampled_from(["tedd", "ted", "teddington", "theodore", "kit", "kitte", "peg", "pegasus", "annie", "annex", "bill", "billing", "rob", "st" * 30]))
_body = st.builds(lambda p, i, g, t, w, r: {"proper": [] if r else p, "initial": "" if r else i, "given": "" if r else g, "trades": [] if r else t, "raw": r, "words": [] if r else w}, st.lists(_word, min_size=1, max_size=3), st.sampled_from(["", "", "a", "b"]), st.sampled_from(["", "", "r", "robert"]), st.lists(st.sampled_from(["design", "legal", "media"]), max_size=2, unique=True), st.lists(_word, max_size=3), st.sampled_from(["", "", "", "", "legal group", "lega group", "a legal", "b legal"]))


def _bent(body, data):
    """A body that may have come out of another: a word shortened, letters dropped, words moved or lost, trades untold."""
    out = {k: list(v) if isinstance(v, list) else v for k, v in body.items()}
    for step in data.draw(st.lists(st.sampled_from(["short", "letter", "move", "lose", "untold", "fewer", "initial", "words"]), max_size=2)):
        p = out["proper"]
        i = data.draw(st.integers(0, max(len(p) - 1, 0)))
        if step == "untold":
            out["trades"] = []
        elif step == "fewer":
            out["trades"] = out["trades"][:1]
        elif p and step == "short":
            keep = data.draw(st.lists(st.booleans(), min_size=len(p[i]), max_size=len(p[i])))
            p[i] = p[i][0] + "".join(x for x, k in zip(p[i][1:], keep[1:]) if k)
        elif p and step == "letter":
            at = data.draw(st.integers(0, len(p[i])))
            p[i] = p[i][:at] + data.draw(st.sampled_from(["", "a", "t"])) + p[i][at + 1 :] or "a"
        elif p and step == "move":
            p.append(p.pop(i))
        elif len(p) > 1 and step == "lose":
            p.pop()
        elif len(p) > 1 and step == "initial":
            out["initial"], out["proper"] = p[1][0], p[:1]
        elif p and step == "words":
            out["words"] = list(p)
    return out


@settings(max_examples=2000, deadline=None)
@given(_body, _body, st.booleans(), st.data())
def test_whatever_errors_accept_shares_a_key(c, other, bent, data):
    v = _bent(c, data) if bent else other
    if v["raw"] and v["raw"] == c["raw"] or spellings.errors(v, c) is None:
        return
    assert {k for k, r in spellings._keys(v) if r & 2} & {k for k, r in spellings._keys(c) if r & 1}


@pytest.mark.parametrize("a,b,same", [("jenny", "jennifer", True), ("bart", "bartholomew", True), ("chuck", "charles", True), ("robert", "richard", False), ("charlotte", "charles", False), ("jonathan", "jennifer", False)])
def test_nicknames(a, b, same):
    assert spellings.nickname(a, b) == spellings.nickname(b, a) == same


def test_rates_are_learned(spark):
    rows = [("v", "c", 1, 50, [1, 0, 0, 0, 0, 0, 0], -12.0), ("w", "c", 5, 50, [0, 0, 1, 0, 0, 0, 0], -12.0)]
    rates = spellings.channel(spark.createDataFrame(rows, "v string, c string, nv bigint, nc bigint, errors array<int>, chance double"), 10_000, [0.0] * spellings.SEEN)
    assert rates["typo"] < spellings.RATES["typo"] and rates["typo"] < rates["lost"] < 0 and rates["initial"] < spellings.RATES["initial"]


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
def test_one_error(a, b):
    n, m = len(a), len(b)
    d = [[i + j if i * j == 0 else 0 for j in range(m + 1)] for i in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    assert spellings.one_error(a, b) == (d[n][m] if d[n][m] <= 1 else None)
    if d[n][m] <= 1:
        assert spellings._less(a) & spellings._less(b)


# nearest vectors

VECTORS = "id string, model_name string, model_version string, embedding array<float>, is_active boolean, embedding_dimensions smallint, first int, key string"


def _vectors(n, dims, seed, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(1, n // 12), dims))
    x = centres[rng.integers(0, len(centres), n)] + spread * rng.standard_normal((n, dims))
    return (x * rng.uniform(0.1, 5, (n, 1))).astype(np.float32)


def _pairs(ids, x):
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    return {tuple(sorted((ids[i], ids[j]))) for i in range(len(ids)) for j in sorted(range(len(ids)), key=lambda j: (-round(s[i, j], 6), ids[j]))[:5]}


@pytest.mark.parametrize("uuids,block", [(True, 4096), (False, 4096), (True, 128)])
def test_neighbours(spark, uuids, block):
    x, y = _vectors(1500, 24, 1), _vectors(200, 16, 2)
    name = (lambda i: f"{i:08x}-0000-4000-8000-{i * 7919 % 99991:012x}") if uuids else (lambda i: f"row {i}")
    rows = [(name(i), "a", "1", v.tolist(), True, 24) for i, v in enumerate(x)] + [(name(5000 + i), "b", None, v.tolist(), True, 16) for i, v in enumerate(y)]
    bad = [(name(9000), "a", "1", x[0].tolist(), False, 24), (name(9001), "a", "1", None, True, 24), (name(9002), "a", "1", x[0].tolist()[:20], True, 24), (name(9003), "a", "1", [float("nan")] * 24, True, 24), (name(9004), "a", "1", [0.0] * 24, True, 24), (name(9005), "a", "1", [float("inf")] + [1.0] * 23, True, 24), (None, "a", "1", x[0].tolist(), True, 24), (name(9006), "a", "1", x[0].tolist(), None, 24), (name(9007), "a", "1", [None] + [1.0] * 23, True, 24), (name(9008), "a", "1", [], True, 0)]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows + rows[:50] + bad], VECTORS)
    got = {tuple(r) for r in neighbors.similar_pairs(df, "id", ["model_name", "model_version"], "embedding", "is_active", "embedding_dimensions", block=block).collect()}
    want = _pairs([r[0] for r in rows[:1500]], x) | _pairs([r[0] for r in rows[1500:]], y)
    assert all(a < b for a, b in got)
    if block > 1500:
        assert len(got ^ want) <= 12  # cosines that differ by less than 1e-5
    else:
        assert len(got & want) / len(want) >= 0.9
    assert not {i for p in got for i in p} & {r[0] for r in bad}


def test_neighbours_of_equal_vectors_and_of_none(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(f"{i:08x}-0000-4000-8000-000000000000", "a", "1", v, True, 3, 1, "k") for i in range(300)]
    df = spark.createDataFrame(rows, VECTORS)
    got = [tuple(r) for r in neighbors.similar_pairs(df, "id", ["model_name", "model_version"], "embedding", "is_active", "embedding_dimensions", block=32).collect()]
    assert len({i for p in got for i in p}) == 300 and len(got) >= 300 * 5 / 2
    assert neighbors.similar_pairs(df.limit(0), "id", ["model_name"], "embedding", "is_active", "embedding_dimensions").count() == 0
    assert neighbors.similar_pairs(df.limit(1), "id", ["model_name"], "embedding", "is_active", "embedding_dimensions").count() == 0


def _dense(n, dims, seed):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(dims)
    return (centre + 0.02 * rng.standard_normal((n, 4)) @ rng.standard_normal((4, dims))).astype(np.float32)


def test_neighbours_in_one_dense_cluster(spark):
    x = np.concatenate([_dense(500, 24, 3), _vectors(500, 24, 4)])
    name = lambda i: f"{i * 7919 % 99991:08x}-0000-4000-8000-{i:012x}"
    rows = [(name(i), "a", "1", v.tolist(), True, 24, 1, "k") for i, v in enumerate(x)]
    got = {tuple(r) for r in neighbors.similar_pairs(spark.createDataFrame(rows, VECTORS), "id", ["model_name", "model_version"], "embedding", "is_active", "embedding_dimensions", block=32).collect()}
    want = _pairs([r[0] for r in rows], x)
    dense = {name(i) for i in range(500)}
    mine = {p for p in want if p[0] in dense and p[1] in dense}
    assert len(got & mine) / len(mine) >= 0.85


def test_equal_strings_are_spread_by_content(monkeypatch):
    monkeypatch.setattr(neighbors, "HOT", 500)
    x, salt = _dense(4000, 24, 5), np.arange(4000)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = neighbors.Tree(x, 4000, 1, 10_000)
    first, bits = next(tree.symbols(x)), tree.bits(x)
    share = tree.share(x, first, bits, salt)
    s = x.astype(np.float64) @ x.T.astype(np.float64)
    np.fill_diagonal(s, -2)
    assert tree.spread and len(set(share)) > 1 and np.mean(share[s.argmax(axis=1)] == share) > 0.7
    same = np.repeat(x[:1], 4000, axis=0)  # copies have no content to go by
    tree = neighbors.Tree(same, 4000, 1, 10_000)
    assert len(set(tree.share(same, next(tree.symbols(same)), tree.bits(same), salt))) == 8


def test_blocks_cover_everything():
    rng = np.random.default_rng(0)
    for high in (2**32, 2, 2**20):
        bits = np.sort(rng.integers(0, high, 3000).astype(np.uint64))
        got = neighbors.blocks(bits, 100)
        assert sorted(i for lo, hi, _, _ in got for i in range(lo, hi)) == list(range(3000))
        assert all(a <= lo < hi <= b and (b - a <= 100 or high == 2) and (4 * (b - a) >= 100) for lo, hi, a, b in got)


def test_pairs_do_not_depend_on_the_number_of_tasks(spark):
    x = _vectors(3000, 24, 6)
    rows = [(f"{i:08x}-0000-4000-8000-{i * 7919 % 99991:012x}", "a", "1", v.tolist(), True, 24, 1, "k") for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, VECTORS)
    args = ("id", ["model_name", "model_version"], "embedding", "is_active", "embedding_dimensions")
    one = {tuple(r) for r in neighbors.similar_pairs(df, *args, block=128).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        other = {tuple(r) for r in neighbors.similar_pairs(df.repartition(9), *args, block=128).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = _pairs([r[0] for r in rows], x)
    assert one == other and len(one & want) / len(want) >= 0.95


# tokens


@pytest.fixture(scope="module")
def encoding():
    with open(VOCABULARY, "rb") as f:
        return tokens._encoding(f.read())


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab 1\n\t '’sé漢😀., 　"), max_size=400), st.integers(3, 40), st.integers(1, 12))
def test_pieces_are_encoded_as_the_whole(text, chunk, overlap):
    with open(VOCABULARY, "rb") as f:
        e = tokens._encoding(f.read())
    parts = list(tokens.pieces(text, chunk, overlap))
    assert "".join(parts) == text
    assert [i for p in parts for i in e.encode_ordinary(p)] == e.encode_ordinary(text)
    assert e.decode_bytes(e.encode_ordinary(text)) == text.encode()


def test_a_long_text_is_many_rows(spark, encoding, monkeypatch):
    monkeypatch.setattr(tokens, "ROWS", 20_000)
    texts = ["Für déjà vu, we're 42 of 漢字!\r\n" * 3_000, "a" * 30_000 + " b c" * 9_000, "x y\n\n  z " * 9_000, "ab " * 30_000, "short", None]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] + [(0, texts[0], "s")], "doc_id long, text string, source string").repartition(3)
    got = sorted((r.doc_id, list(r.ids)) for r in tokens.encode_texts(df, "doc_id", "text").collect())
    assert got == sorted((i, encoding.encode_ordinary(texts[i]) if texts[i] else []) for i in [0, *range(len(texts))])
    counts = sorted((r.doc_id, r.source, r.n_tokens) for r in tokens.encode_texts(df, "doc_id", "text", count_only=True, carry=("source",)).collect())
    assert counts == [(i, "s", len(ids)) for i, ids in got]
    heads, tails = zip(*(tokens.boundaries(texts[3][s : s + tokens.CHUNK + tokens.OVERLAP + 1], False) for s in range(0, 40_000, tokens.CHUNK)))
    assert len(tokens.stitched(list(heads), list(tails))) == len(heads)


def test_encode_texts(spark, encoding):
    texts = [None, "", " ", "<|endoftext|> plain", "déjà vu 漢字 👩‍💻" * 5000, "a" * 60_000, "x y " * 20_000, "\r\n\r\n  \t"]
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)] + [(3, texts[3], "n")], "doc_id long, text string, ids string")
    got = [(r.doc_id, list(r.ids)) for r in tokens.encode_texts(df, "doc_id", "text").collect()]
    assert len(got) == len(texts) + 1
    for i, ids in got:
        assert ids == (encoding.encode_ordinary(texts[i]) if texts[i] else [])
        assert tokens.decode_ids(ids) == (texts[i] or "").encode()
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(VOCABULARY.replace(".tiktoken", ".json"))
    other.encode_special_tokens = True
    assert all(other.encode(texts[i] or "", add_special_tokens=False).ids == ids for i, ids in got if i != 5)
    assert tokens.encode_texts(df.limit(0), "doc_id", "text").count() == 0


# mixing


def test_weights():
    sizes, targets = {"a": 1000, "b": 100, "c": 10, "d": 0}, {"a": (0.5, 1), "b": (0.3, 2), "c": (0.1, 4), "d": (0.1, 3), "e": (0.1, 1)}
    for budget, spill in ((None, 0.1), (900, 0.1), (900, 0.0), (10**9, 0.1), (50, 0.0)):
        w, a, b = mixing.weights(sizes, targets, budget, spill=spill)
        assert set(w) == {"a", "b", "c"} and abs(sum(w.values()) - 1) < 1e-9 and b == min(1240, 1110 if budget is None else budget)
        assert all(b * w[s] <= targets[s][1] * sizes[s] * (1 + 1e-9) for s in w)
        assert (0 < a <= 1) == (b > 50)  # the small source c can give 40 tokens at most
    w, a, _ = mixing.weights(sizes, targets, 50)
    assert a == 0 and abs(w["a"] / w["b"] - 5 / 3) < 1e-9
    flat = {"a": (0.98, 9), "b": (0.01, 9), "c": (0.01, 9)}
    _, a, _ = mixing.weights({"a": 40, "b": 30, "c": 30}, flat, 10, min_entropy=0.9)
    assert 0 < a < 1
    assert mixing.weights({}, targets) == ({}, 0.0, 0.0) and mixing.weights(sizes, targets, 0)[2] == 0


@pytest.mark.parametrize("in_block", [50, 2_000])
def test_mix(spark, monkeypatch, in_block):
    monkeypatch.setattr(mixing, "IN_BLOCK", in_block)
    rng = random.Random(1)
    rows = [(i, " ".join(["word"] * rng.randrange(1, 60)), "big" if i % 3 else rng.choice(["small", "tiny", None, "unlisted"]), 1, 2) for i in range(1500)] + [(9000, None, "small", 1, 2), (9001, "", "small", 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, uses int, block int")
    goals = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 2), ("tiny", 0.1, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    got = mixing.mix(df, goals, budget=10_000).collect()
    assert len(got) == len(rows) and {r.doc_id for r in got} == {r[0] for r in rows}
    most = {"big": 1, "small": 2, "tiny": 3}
    assert all(0 <= r.uses <= most.get(r.source, 0) for r in got) and all(r.uses == 0 for r in got if not r.n_tokens)
    used = {s: sum(r.uses * r.n_tokens for r in got if r.source == s) for s in most}
    total = sum(used.values())
    assert 10_000 - 3 * 60 < total <= 10_000
    assert all(abs(used[s] / total - t / 0.9) < 0.01 for s, t in (("big", 0.5), ("small", 0.3), ("tiny", 0.1)))
    whole = sum(r.n_tokens for r in got if r.source in most)
    mixed = mixing.mix(df, goals)
    report = {r.source: r for r in mixing.shares(mixed, goals).collect()}
    assert report["none"].used_tokens == 0 and report["unlisted"].target_share is None and abs(sum(r.actual_share for r in report.values()) - 1) < 1e-9
    assert report["big"].exponent > 0 and report["small"].most_uses <= 2 and report["tiny"].most_uses <= 3
    assert whole - 3 * 60 < sum(r.used_tokens for r in report.values()) <= whole
    assert all(abs(r.actual_share - r.planned_share) < 0.005 for r in report.values())
    assert mixing.mix(df.limit(0), goals).count() == 0 and mixing.mix(df, goals.limit(0)).agg(F.sum("uses")).first()[0] == 0


# garbled text

CLEAN = [
    "Zürich, Göteborg und Málaga – “déjà vu”… £5 §3 ½ №4 €9",
    "REUNIÃO: SITUAÇÃO, DECISÃO. INFORMAÇÃO NÃO",
    "Уже работает… «Ещё её», №5 ёж",
    "面接では説明していました。 ２年",
    "L’équipe a « réussi »\xa0: qualité\xa0» À «\xa0Lyon\xa0»",
    "naïve café—ärztlich “À bientôt” 'É”",
    "plain ascii",
    "👩‍💻 שלום مرحبا नमस्ते",
    "",
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_text_is_left_alone(text):
    assert garbled.repair(text) == (text, 0, None, False)


@pytest.mark.parametrize("encoding", ["cp1252", "latin-1", "cp1250", "cp1251", "cp437", "mac_roman"])
@pytest.mark.parametrize("text", ["Für Zürich: größer, schön – geprüft", "El señor dirigió un equipo pequeño", "Greta’s team – “good”… €9"])
def test_garbled_text_is_restored(encoding, text):
    raw = text.encode()
    if encoding.startswith("cp125"):
        bad = "".join(bytes([b]).decode(encoding, "ignore") or chr(b) for b in raw)
    else:
        bad = raw.decode(encoding)
    assert garbled.repair(bad)[0] == text
    whole, n, _, lost = garbled.repair("Before. " + bad + " After ü.")
    assert n and not lost and whole == "Before. " + text + " After ü."


def test_read_wrongly_twice_and_lost():
    twice = "señor español".encode().decode("cp1252").encode().decode("cp1252")
    assert garbled.repair(twice)[0] == "señor español"
    assert garbled.repair("Z�rich")[3]
    assert garbled.repair(None) == (None, 0, None, False)
    long = "größer ".encode().decode("latin-1") * 30_000
    assert garbled.repair(long)[0] == "größer " * 30_000


def test_garbled_table(spark):
    good, n = "Für Zürich geprüft", 60
    rows = [(i, good, "w") for i in range(n)] + [(100, good.encode("cp1252").decode("mac_roman"), "w"), (101, good.encode().decode("cp1252"), "w"), (102, None, "w"), (103, "", "w"), (104, "F�r", "w"), (105, "ascii", "w")]
    df = spark.createDataFrame(rows + rows[-4:], "doc_id long, text string, word string")
    found = {r.key: r for r in garbled.garbled(df, "doc_id", "text").collect()}
    assert set(found) == {100, 101, 104} and found[104].lossy
    fixed = {r.key: r.restored for r in garbled.restored_texts(df, "doc_id", "text").collect()}
    assert fixed[100] == good and fixed[101] == good
    assert garbled.garbled(df.limit(0), "doc_id", "text").count() == 0


def test_lone_marks_prove_nothing(spark):
    rows = [(i, "Ltd ™ ® © all") for i in range(20)] + [(100 + i, "Москва и Киев") for i in range(220)] + [(400 + i, "• Günter") for i in range(40)]
    rows += [(900, "¥ GŸnter")]  # here the mark has a word that was misread the same way beside it
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.key for r in garbled.garbled(df, "doc_id", "text").collect()] == [900]
    assert [r.restored for r in garbled.restored_texts(df, "doc_id", "text").collect()] == ["• Günter"]


def test_a_source_read_wrongly_as_a_whole(spark):
    names = ["München", "Zürich", "Göteborg", "Größe", "für", "geprüft", "zuverlässig"]
    good = [f"{a}, {b}. Ende – {c}" for a in names for b in names for c in names if len({a, b, c}) == 3]
    bad = [t.encode("cp1252").decode("mac_roman") for t in good[::2]]
    lone = "Nur München!".encode("cp1252").decode("mac_roman")  # proven by the other texts
    df = spark.createDataFrame([*enumerate(good), *((1000 + i, t) for i, t in enumerate(bad)), (5000, lone)], "doc_id long, text string")
    assert {r.key for r in garbled.garbled(df, "doc_id", "text").collect()} == {1000 + i for i in range(len(bad))} | {5000}
    fixed = {r.key: r.restored for r in garbled.restored_texts(df, "doc_id", "text").collect()}
    assert fixed == {1000 + i: t for i, t in enumerate(good[::2])} | {5000: "Nur München!"}


def test_automaton_takes_well_formed_spans_only():
    back = garbled._bytes_of("latin-1")[1]
    found = garbled.automaton("latin-1").findall("".join(map(chr, b"\xc3\xbc \xc0\x80 \xe0\x80\x80 \xed\xa0\x80 \xf0\x9f\x98\x80 \xf5\x80")))
    assert [bytes(back[c] for c in f).decode() for f in found] == ["ü", "😀"]
    assert unicodedata.name("ü") and json.dumps(found)
