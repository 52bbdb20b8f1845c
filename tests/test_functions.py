from datetime import date

import pytest
from pyspark.sql import functions as F

from rosterflow.functions import dates, normalize as n


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "f,raw,want",
    [
        (n.email_address, " MAILTO:Person+Alias@Example.com ", "person+alias@example.com"),
        (n.email_address, "A B@example.com", "a b@example.com"),
        (n.email_address, " ", None),
        (n.company_name, "ACME, Inc.", "acme"),
        (n.company_name, "Foo Co. Ltd", "foo"),
        (n.company_name, "Ltd", "ltd"),
        (n.company_name, None, None),
        (n.identity_text, "  A--b  C! ", "a b c"),
        (n.identity_text, "...", None),
        (n.search_text, " C++  and\tC# ", "c++ and c#"),
        (n.identity_url, "//X.example/a/?q#f", "https://x.example/a"),
        (n.identity_url, "http://x.example//", "https://x.example"),
        (n.identity_url, "/x.example", "https://x.example"),
        (n.profile_username, "@@/in/Jo-Doe/", "jo-doe"),
        (n.profile_username, "www.linkedin.com/in/jo", None),
        (n.candidate_url, "de.linkedin.com/in/Jo/en?x=1", "https://www.linkedin.com/in/jo"),
        (n.candidate_url, "linkedin.com/pub/jo/1/2/3/", "https://www.linkedin.com/pub/jo/1/2/3"),
        (n.candidate_url, "linkedin.com/company/x", None),
        (n.company_url, "m.linkedin.com/school/Mit/about", "https://www.linkedin.com/school/mit"),
        (n.company_username_in_url, "linkedin.com/company/acme#x", "acme"),
        (n.website, "HTTP://Www.X.example/a?b", "http://www.x.example"),
        (n.website, " x.example/a ", "https://x.example"),
        (n.blank_to_null, " \t\n", None),
        (n.boolish, " Yes ", True),
        (n.boolish, "F", False),
        (n.boolish, "maybe", None),
        (n.line_text, " a  b \r\n\r\n c\t d ", "a b\nc d"),
    ],
)
def test_text(spark, f, raw, want):
    assert one(spark, f(F.lit(raw).cast("string"))) == want


def test_precedence(spark):
    r = lambda *a: one(spark, n.replaces(*[F.lit(x).cast("string") for x in a]))
    assert r("resume", "linkedin_profile", "old", "new") and not r("linkedin_profile", "resume", "old", "new")
    assert r("linkedin_profile", "resume", " ", "new") and not r("resume", "linkedin_profile", "old", " ")
    assert not r("resume", "resume_upload", "old", "new")


@pytest.mark.parametrize("precision,want", [("year", date(2018, 1, 1)), ("month", date(2018, 7, 1)), ("day", date(2018, 7, 19)), ("present", None)])
def test_dates_are_cut_to_precision(spark, precision, want):
    assert one(spark, n.at_precision(F.lit(date(2018, 7, 19)), F.lit(precision))) == want


@pytest.mark.parametrize(
    "text,is_end,want",
    [
        ("2020-05-21", False, (date(2020, 5, 21), "day")),
        ("2020-05-21T10:00:00", False, (date(2020, 5, 21), "day")),
        ("2020/05", False, (date(2020, 5, 1), "month")),
        ("2020", False, (date(2020, 1, 1), "year")),
        ("May 21 2020", False, (date(2020, 5, 21), "day")),
        ("3 September 2020", False, (date(2020, 9, 3), "day")),
        ("Sept 2020", False, (date(2020, 9, 1), "month")),
        ("2020 dec", False, (date(2020, 12, 1), "month")),
        ("Present", True, (None, "present")),
        ("Present", False, (None, "unknown")),
        ("2020-13", False, (None, "unknown")),
        ("2021-02-30", False, (None, "unknown")),
        ("soon", True, (None, "unknown")),
        ("", True, (None, "unknown")),
        (None, True, (None, "unknown")),
    ],
)
def test_written_dates(spark, text, is_end, want):
    assert tuple(one(spark, dates.parse_date(F.lit(text).cast("string"), is_end))) == want


def test_experience_hash_ignores_display(spark):
    base = ["c", "Data  Engineer", None, "ACME Inc.", date(2020, 5, 3), "month", None, "present", None]
    kinds = ["string"] * 4 + ["date", "string", "date", "string", "boolean"]
    h = lambda **k: one(spark, n.experience_hash(*[F.lit(k.get(str(i), b)).cast(t) for i, (b, t) in enumerate(zip(base, kinds))]))
    assert h() == h(**{"1": " data engineer", "3": "acme", "4": date(2020, 5, 30), "8": True})
    assert h() != h(**{"1": "Data-Engineer"}) and h() != h(**{"2": "x"})
