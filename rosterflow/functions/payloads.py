"""Values of legacy payloads: texts and dates in several shapes, company inputs, and whole values as text."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions import dates
from rosterflow.functions import normalize as n
from rosterflow.runtime import ship

# Members of payloads by what they hold, in order of preference.
TITLES = ("title", "position_title", "position", "role")
STARTS = ("start_date", "startDate", "start")
ENDS = ("end_date", "endDate", "end")
COMPANIES = ("company", "companyName", "company_name", "organization")
COMPANY_NAMES = ("name", "companyName", "company_name", "text", "label", "display")
COMPANY_IDS = ("company_id", "companyId", "linkedin_company_id", "linkedinCompanyId")
COMPANY_USERS = ("company_linkedin_username", "companyLinkedinUsername", "company_username", "companyUsername", "linkedin_username", "linkedinUsername")
COMPANY_LINKS = ("company_linkedin_url", "companyLinkedinUrl", "company_url", "companyUrl", "linkedin_company_url", "linkedinCompanyUrl", "linkedin_url", "linkedinUrl", "url")
TEXTS = ("text", "value", "name", "title", "label", "display")


def _get(doc: Column, name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(doc, f"$.{name}", kind)


def _is_object(doc: Column) -> Column:
    return F.try_variant_get(doc, "$", "map<string,variant>").isNotNull()


def _is_list(doc: Column) -> Column:
    return F.try_variant_get(doc, "$", "array<variant>").isNotNull()


def first_present(doc: Column, names: Sequence[str]) -> Column:
    """The first of the members that is there and isn't null, as variant."""
    return F.coalesce(*[F.when(~F.is_variant_null(_get(doc, x)), _get(doc, x)) for x in names])


def scalar_text(value: Column) -> Column:
    """A scalar as text without outer white space; blank, objects and lists are null."""
    return F.when(~_is_object(value) & ~_is_list(value), n.blank_to_null(F.try_variant_get(value, "$", "string")))


def text_field(doc: Column, names: Sequence[str], within: Sequence[str] = TEXTS) -> Column:
    """Text of the first member present; of an object its first member that says something."""
    value = first_present(doc, names)
    return F.when(_is_object(value), F.coalesce(*[scalar_text(_get(value, x)) for x in within])).otherwise(scalar_text(value))


def company_inputs(doc: Column) -> Column:
    """struct<name, id, username, url> of a work history item; each from the item, else from its company object."""
    inner = first_present(doc, COMPANIES)
    either = lambda names: F.coalesce(scalar_text(first_present(doc, names)), F.when(_is_object(inner), scalar_text(first_present(inner, names))))
    return F.struct(text_field(doc, COMPANIES, COMPANY_NAMES).alias("name"), either(COMPANY_IDS).alias("id"), either(COMPANY_USERS).alias("username"), either(COMPANY_LINKS).alias("url"))


def _bound(value: Column, then) -> Column:
    """``then`` of ``value``, which is evaluated once however often it is used."""
    return F.transform(F.array(value), then)[0]


def date_value(value: Column, is_end: bool, depth: int = 2) -> Column:
    """struct<date, precision> of a text, a year as number, or an object: ``value`` or ``date`` within, a text, or year, month, day.

    Objects are followed ``depth`` deep. A day that doesn't exist is unknown; months may be names.
    """

    def read(v: Column) -> Column:
        object_ = _is_object(v)
        return F.struct(
            F.when(object_, text_field(v, ("text", "label", "display", "raw"))).when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).alias("text"),
            F.when(object_, F.try_variant_get(v, "$.year", "int")).otherwise(F.when(F.schema_of_variant(v) != "STRING", F.try_variant_get(v, "$", "double").cast("int"))).alias("year"),
            F.when(object_, dates.month_number(scalar_text(_get(v, "month")))).alias("month"),
            F.when(object_, F.try_variant_get(v, "$.day", "int")).alias("day"),
            (object_ & (F.lower(scalar_text(_get(v, "precision"))) == "present")).alias("open"),
            object_.alias("object"),
        )

    def made(x: Column) -> Column:
        parsed = dates.parse_date(F.coalesce(x["text"], F.lit("")), is_end)
        sane = x["object"] | x["year"].between(1000, 9999)
        text = F.format_string("%04d-%02d-%02d", x["year"], F.coalesce(x["month"], F.lit(1)), F.when(x["month"].isNotNull(), F.coalesce(x["day"], F.lit(1))).otherwise(F.lit(1)))
        exact = F.when(sane & x["year"].isNotNull(), F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))))
        precision = F.when(exact.isNull(), F.when(F.coalesce(x["open"], F.lit(False)) & x["year"].isNull() & F.lit(is_end), "present").otherwise("unknown")).when(x["month"].isNotNull() & x["day"].isNotNull(), "day").when(x["month"].isNotNull(), "month").otherwise("year")
        parts = F.struct(exact.alias("date"), precision.alias("precision"))
        return _bound(parsed, lambda t: F.when(t["precision"] != "unknown", t).otherwise(parts))

    for _ in range(depth):
        value = _bound(value, lambda v: F.when(_is_object(v), F.coalesce(first_present(v, ("value", "date")), v)).otherwise(v))
    return _bound(_bound(value, read), made)


def formatted(value: Any) -> str | None:
    """A JSON value as text: lists line by line, objects as ``key: value`` in order of keys, what has several lines indented below."""
    if isinstance(value, str):
        lines = (" ".join(x.replace("\t", " ").split(" ")) for x in value.replace("\r\n", "\n").replace("\r", "\n").split("\n"))
        return "\n".join(" ".join(p for p in x.strip().split(" ") if p) for x in lines if x.strip()) or None
    if isinstance(value, list):
        return "\n".join(x for x in map(formatted, value) if x) or None
    if isinstance(value, dict):
        out = []
        for k in sorted(value):
            text = formatted(value[k])
            if text is not None:
                out.append(f"{k}:\n" + "\n".join("  " + x for x in text.split("\n")) if "\n" in text else f"{k}: {text}")
        return "\n".join(out) or None
    return None if value is None else str(value)


def formatted_payloads(df: DataFrame, key: str, field: str) -> DataFrame:
    """key and text of each row's JSON; what isn't valid JSON is taken as text, null and blank give null. No shuffle.

    The depth of a value isn't known beforehand, so this is the one function that needs Python.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{field}`").cast("string").alias("body"))

    def one(body: str | None) -> str | None:
        if body is None:
            return None
        try:
            return formatted(json.loads(body))
        except (ValueError, RecursionError):
            return formatted(body)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([one(x) for x in batch.column(1).to_pylist()], pa.string())], ["key", "text"])

    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, text string")


def effective_at(*times: Column) -> Column:
    """The first time that is known."""
    return F.coalesce(*times)


def fallback_payload(ident: Column, used: Column, fields: dict[str, Column]) -> Column:
    """A payload for records that have none: where they come from, what was used, and the raw fields, nulls kept."""
    raw = F.struct(*[v.alias(k) for k, v in fields.items()])
    return F.to_json(F.struct(F.lit("candidates").alias("source_table"), ident.cast("string").alias("legacy_candidate_id"), used.alias("source_fields_used"), raw.alias("raw_source_fields")), {"ignoreNullFields": "false"})
