"""Dates written by people, with their precision, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words for an end that has not come.
PRESENT = ("present", "current", "ongoing", "now", "today")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def month_number(c: Column) -> Column:
    """1 to 12 from a number, a full name, its first three letters or ``sept``; dots don't matter."""
    text = F.lower(F.replace(F.trim(c), F.lit("."), F.lit("")))
    number = F.when(text.rlike("^[0-9]{1,2}$"), text.cast("int"))
    names = {name[:k]: n for n, name in enumerate(MONTHS, 1) for k in (3, len(name))} | {"sept": 9}
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.when(number.between(1, 12), number), F.element_at(known, text))


_NUMBERS = r"^[0-9]{4}(?:[-/][0-9]{2}(?:[-/][0-9]{2}(?:[T ][0-9:.+Z-]*)?)?)?$"
_NAMES = r"^(?:[A-Za-z]+ [0-9]{1,2} [0-9]{4}|[0-9]{1,2} [A-Za-z]+ [0-9]{4}|[A-Za-z]+ [0-9]{4}|[0-9]{4} [A-Za-z]+)$"


def _bound(value: Column, then) -> Column:
    """``then`` of ``value``, which is evaluated once however often it is used."""
    return F.transform(F.array(value), then)[0]


def parse_date(c: Column, is_end: bool) -> Column:
    """struct<date, precision> of a date as people write it.

    Present words (for ends), ``2020-05-21`` with or without a time, ``2020/05``, ``2020``, ``May 21 2020``, ``21 May
    2020``, ``May 2020``, ``2020 May``; anything else, or a day that doesn't exist, is unknown.
    """

    def parts(t: Column) -> Column:
        numbers, names = t.rlike(_NUMBERS), t.rlike(_NAMES)
        month = F.when(numbers, or_empty(F.substring(t, 6, 2))).when(names, F.coalesce(F.lpad(month_number(F.regexp_extract(t, "([A-Za-z]+)", 1)).cast("string"), 2, "0"), F.lit("none")))
        day = F.when(numbers, or_empty(F.substring(t, 9, 2))).when(names, F.lpad(or_empty(F.regexp_extract(t, "(?:^|[A-Za-z] )([0-9]{1,2}) ", 1)), 2, "0"))
        year = F.when(numbers | names, F.regexp_extract(t, "([0-9]{4})", 1))
        present = F.lower(F.regexp_replace(t, "[.]", "")).isin(*PRESENT) if is_end else F.lit(False)
        return F.struct(year.alias("y"), month.alias("m"), day.alias("d"), F.coalesce(present, F.lit(False)).alias("now"))

    def made(p: Column) -> Column:
        text = F.concat(p["y"], F.lit("-"), F.coalesce(p["m"], F.lit("01")), F.lit("-"), F.coalesce(p["d"], F.lit("01")))
        date = F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))
        return F.struct(date.alias("date"), F.when(p["now"], "present").when(date.isNull(), "unknown").when(p["d"].isNotNull(), "day").when(p["m"].isNotNull(), "month").otherwise("year").alias("precision"))

    return _bound(F.regexp_replace(F.trim(c), r"\s+", " "), lambda t: _bound(parts(t), made))


def or_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))
