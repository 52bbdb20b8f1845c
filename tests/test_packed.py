import pytest

from rosterflow.operators.packed import parse, split_packed

CASES = [
    (None, []),
    ("", []),
    (" n/a ", []),
    ("-", []),
    ("Skills: ", []),
    ("C++", ["C++"]),
    ("Rust, Go;  ;SQL,,", ["Rust", "Go", "SQL"]),
    ("Cloud (compute, storage; network) / Payroll (on/off site)", ["Cloud (compute, storage; network)", "Payroll (on/off site)"]),
    ('"Reporting, monthly", CI/CD', ["Reporting, monthly", "CI/CD"]),
    ('"Support ""tier 2"" desk" | R&D', ['Support "tier 2" desk', "R&D"]),
    ('["Fran\\u00e7ais", "Support \\"tier 2\\" desk", "SEO; certified"]', ["Français", 'Support "tier 2" desk', "SEO; certified"]),
    ('{CAD,"Quality control",C++}', ["CAD", "Quality control", "C++"]),
    ("1.) Git\n2.) .NET\n3.) 3D modelling", ["Git", ".NET", "3D modelling"]),
    ("1) Git, 2) Scala, 24/7 operations", ["Git", "Scala", "24/7 operations"]),
    ("- Java\r\n- GMP", ["Java", "GMP"]),
    ("•Go\n•  R \n• “Lean / Six Sigma”", ["Go", "R", "Lean / Six Sigma"]),
    ("Top skills: Git，SQL、R", ["Git", "SQL", "R"]),
    ("'Sales, inside'; don't know; it's", ["Sales, inside", "don't know", "it's"]),
    ("IFRS - advanced | Key accounts", ["IFRS - advanced", "Key accounts"]),
    ("SQL, SQL", ["SQL", "SQL"]),
]


@pytest.mark.parametrize("text,values", CASES)
def test_values(text, values):
    assert [v for v, _, _ in parse(text)] == values


def test_backtracks_on_malformed_quotes():
    assert parse('"open, Go') == [('"open', "bare", True), ("Go", "bare", False)]
    assert parse('"a" b, c') == [('"a" b', "bare", True), ("c", "bare", False)]
    assert [(v, bad) for v, _, bad in parse("left (open, Go")] == [("left (open", True), ("Go", False)]


BRACKETS = [
    ("[Python, SQL], [Java]", [("Python", "bracketed", False), ("SQL", "bracketed", False), ("Java", "bracketed", False)]),
    ("Python [ML, NLP], SQL", [("Python [ML, NLP]", "bare", False), ("SQL", "bare", False)]),
    ("Go, [a, [b, 'c, d']]", [("Go", "bare", False), ("a", "bracketed", False), ("b", "bracketed", False), ("c, d", "quoted", False)]),
    ("[a, b", [("[a", "bare", True), ("b", "bare", False)]),
    ("a], b", [("a]", "bare", True), ("b", "bare", False)]),
    ("[a] b, c", [("[a] b", "bare", False), ("c", "bare", False)]),
    ('["a]", b]', [("a]", "quoted", False), ("b", "bracketed", False)]),
    ("{x; (y, z)}", [("x", "bracketed", False), ("(y, z)", "bracketed", False)]),
]


@pytest.mark.parametrize("text,values", BRACKETS)
def test_brackets_are_an_alternative(text, values):
    assert parse(text) == values


@pytest.mark.parametrize("text", ["n.a.", "N/A", "keine Angabe", "Skills: see CV", "[]", "{ }", "--", "k/no skills"[2:]])
def test_fields_that_hold_nothing(text):
    assert parse(text) == []


def test_deep_and_open_brackets_end_soon():
    assert len(parse("[a, " * 50_000 + "]")) == 50_000
    assert parse("[" * 3_000 + "a" + "]" * 3_000)[0][0].strip("[]") == "a"


def test_very_long_text_is_parsed_whole():
    many = 60_000
    assert len(parse(", ".join(["Go", '"a, b"', "(x"] * many))) == 3 * many


def test_table(spark):
    rows = [("a", "Go, R"), ("a", "Go, R"), (None, "SQL"), ("b", None)]
    df = spark.createDataFrame([(k, t, "x", "y", "z") for k, t in rows], "id string, field string, key string, pos string, value string")
    got = sorted(((r.key or "", r.pos, r.value) for r in split_packed(df, "id", "field").collect()))
    assert got == [("", 1, "SQL"), ("a", 1, "Go"), ("a", 2, "R")]
    assert split_packed(df.limit(0), "id", "field").count() == 0
