import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterflow.functions import payloads as p

DAY = dt.date
DATES = [
    ('"May 2020"', DAY(2020, 5, 1), "month"),
    ("2019", DAY(2019, 1, 1), "year"),
    ("12", None, "unknown"),
    ('{"year": 2020, "month": "Sept.", "day": 3}', DAY(2020, 9, 3), "day"),
    ('{"year": 2020, "month": 2, "day": 31}', None, "unknown"),
    ('{"year": 2020, "day": 3}', DAY(2020, 1, 1), "year"),
    ('{"value": {"date": "2021-02-03"}}', DAY(2021, 2, 3), "day"),
    ('{"text": "odd", "year": 2001}', DAY(2001, 1, 1), "year"),
    ('{"precision": " Present "}', None, "present"),
    ('"today"', None, "present"),
    ("{}", None, "unknown"),
    ("null", None, "unknown"),
    (None, None, "unknown"),
    ("[1]", None, "unknown"),
]


def test_date_values(spark):
    df = spark.createDataFrame([(i, x) for i, (x, _, _) in enumerate(DATES)], "i int, j string")
    got = {r.i: (r.d.date, r.d.precision) for r in df.select("i", p.date_value(F.try_parse_json("j"), True).alias("d")).collect()}
    assert [got[i] for i in range(len(DATES))] == [x[1:] for x in DATES]


def test_company_inputs(spark):
    rows = ['{"company": {"name": " Acme ", "companyId": 7, "linkedinUrl": "u"}, "url": " "}', '{"companyName": "B", "company_id": "x"}', '{"company": {"name": null, "label": "L"}}', '{"company": []}', "no"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, j string")
    got = [tuple(r.x) for r in df.orderBy("i").select(p.company_inputs(F.try_parse_json("j")).alias("x")).collect()]
    assert got == [("Acme", "7", None, "u"), ("B", "x", None, None), ("L", None, None, None), (None,) * 4, (None,) * 4]


@pytest.mark.parametrize("value,text", [
    ({"b": 1, "a": [" x  y ", {"k": True, "j": None}]}, "a:\n  x y\n  k: True\nb: 1"),
    ([], None), ({}, None), ("", None), (" \r\n ", None), (None, None), ([[1], 2.5], "1\n2.5"), ({"z": {"y": "1\n\n2"}}, "z:\n  y:\n    1\n    2"),
])
def test_formatted(value, text):
    assert p.formatted(value) == text


def test_formatted_table(spark):
    df = spark.createDataFrame([("a", '{"x": 1}', 1), ("b", "{broken", 1), ("c", None, 1), ("d", "[" * 50_000, 1)], "id string, body string, key int")
    got = {r.key: r.text for r in p.formatted_payloads(df, "id", "body").collect()}
    assert got["a"] == "x: 1" and got["b"] == "{broken" and got["c"] is None and len(got["d"]) == 50_000
    assert p.formatted_payloads(df.limit(0), "id", "body").count() == 0
