import json

import pytest

from rosterflow.operators.nested import flat_table, members_table, nested_nodes, nested_objects


def brute(key, text):
    out = set()

    def walk(v, path, above):
        if isinstance(v, str) and v.strip()[:1] in ("{", "["):
            try:
                v = json.loads(v)
            except ValueError:
                return
        if isinstance(v, dict):
            if path != "$":
                out.add((key, path, above))
            for n, x in v.items():
                walk(x, f"{path}.{n}", path)
        elif isinstance(v, list):
            for i, x in enumerate(v):
                walk(x, f"{path}[{i}]", above)

    try:
        walk(json.loads(text), "$", "$")
    except (TypeError, ValueError):
        pass
    return out


deep = "1"
for i in range(40):
    deep = '{"a": %s}' % deep if i % 2 else "[%s, {}]" % deep
TEXTS = [
    '{"a": {"b": [1, {"c": {}}, [{"d": {}}]]}, "s": "{\\"x\\": [{}]}", "n": null, "t": "{broken"}',
    '[{"a": 1}, {"a": {}}]',
    '"{\\"q\\": {}}"',
    '"text"',
    "12",
    "null",
    "",
    "  ",
    None,
    '{"a": {}',
    '{"a": {}} tail',
    '{"a": {}}{"b": {}}',
    '{"a": {}}]',
    '{"k": 1, "k": {"z": {}}}',
    '{"a.b": {"$c": {}}, "": {}}',
    ' {"a": {}} ',
    deep,
    '{"long": "%s", "o": {}}' % ("x" * 200_000),
]


@pytest.mark.parametrize("generations", [3, 14])
def test_against_brute_force(spark, generations):
    rows = [(f"r{i}", t, "path", "rest") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows + rows[:2], "id string, body string, node_path string, rest string")
    got = [tuple(r) for r in nested_objects(df, "id", "body", generations).collect()]
    want = set().union(*(brute(k, t) for k, t, *_ in rows))
    assert len(got) == len(set(got)) and set(got) == want


def test_empty(spark):
    df = spark.createDataFrame([], "id string, body string")
    assert nested_objects(df, "id", "body").count() == 0


def test_target_tables(spark):
    text = '{"jobs": [{"title": "a", "n": 1, "skills": {"name": "s", "more": "[{\\"name\\": \\"t\\"}]"}}, "no", {"title": null, "n": "x"}], "skills": [[{"name": "u"}]]}'
    df = spark.createDataFrame([("k", text, 1), ("k", text, 1), (None, text, 1), ("e", "{}", 1), ("b", "{broken", 1)], "key string, text string, nodes int")
    before = spark.conf.get("spark.sql.variant.allowDuplicateKeys")
    nodes = nested_nodes(df, "key", "text", generations=2)
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == before
    jobs = flat_table(nodes, ["jobs"], {"title": ("string", ("name", "title")), "n": ("int", ("n",))})
    assert sorted(map(tuple, jobs.where("record_key = 'k'").collect())) == [("k", "$.jobs[0]", "$", 0, "a", 1), ("k", "$.jobs[2]", "$", 2, None, None)]
    skills = flat_table(nodes, ["skills"], {"name": ("string", ("name",))}).where("record_key is null")
    assert sorted((r.node_path, r.parent_path, r.ordinal, r["name"]) for r in skills.collect()) == [("$.jobs[0].skills", "$.jobs[0]", None, "s"), ("$.skills[0][0]", "$", 0, "u")]
    cells = {(r.node_path, r.member): r.value for r in members_table(nodes).where("record_key = 'k'").collect()}
    assert cells == {("$.jobs[0]", "title"): "a", ("$.jobs[0]", "n"): "1", ("$.jobs[0].skills", "name"): "s", ("$.jobs[0].skills.more[0]", "name"): "t", ("$.jobs[2]", "title"): None, ("$.jobs[2]", "n"): "x", ("$.skills[0][0]", "name"): "u"}
    assert members_table(nested_nodes(df.limit(0), "key", "text")).count() == 0
