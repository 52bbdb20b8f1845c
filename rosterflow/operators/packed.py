"""Several values packed in one field: a parsing expression grammar with ordered alternatives.

    field     <- nothing / label? list
    list      <- ( gap / value )*
    gap       <- separator / white / line-mark
    value     <- quoted / bracketed / bare
    quoted    <- '"' ( '""' / '\\' . / [^"] )* '"' &( white* ( separator / end ) )  and alike for ' and the typographic pairs
    bracketed <- '[' list ']' &( white* ( separator / end ) )  and alike for { }
    bare      <- ( '(' balanced ')' / '[' balanced ']' / '{' balanced '}' / !separator . )+
    separator <- [,;|\n\t] / bullets / CJK commas / white '/' white

Alternatives are tried in order. A quoted value that isn't closed, or goes on after its closing mark, and a bracket without
its counterpart are parsed again as bare values and flagged. Nothing is dropped: every other character belongs to a value.
The values of a bracketed list are values of the list it stands in; brackets behind a word are part of the value.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.runtime import ship

# Phrases that say a field holds nothing, letters only.
NOTHING = {"", "na", "none", "null", "nil", "nan", "tbd", "tba", "unknown", "unbekannt", "keine", "keineangabe", "keineangaben", "nothing", "noskills", "nodata", "noinformation", "notapplicable", "notavailable", "notspecified", "notprovided", "notgiven", "seecv", "seeresume", "seenotes", "seeprofile", "sieheprofil", "siehelebenslauf"}
# Marks that separate values, and marks that may open a line of a list.
SEPARATORS = ",;|\n\t\v\f\x85  •·‣▪◦●、，；｜"
LINE_MARKS = r"(?:\d{1,4}(?:\.\)|[.)])(?=\s)|[-–—*](?=\s)|[✓✔➢►])\s*"
CLOSING = {'"': '"', "'": "'", "“": "”", "„": "“", "‘": "’", "«": "»"}
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}

_label = re.compile(r"\s*[^\W\d_]+(?: [^\W\d_]+){0,2}\s?:(?=\s)\s*")
_mark = re.compile(rf"[^\S\n]*{LINE_MARKS}")
_stop = re.compile(rf"[{re.escape(SEPARATORS)}()\[\]{{}}/]")
_after = re.compile(rf"\s*(?:[{re.escape(SEPARATORS)}]|/(?=\s)|\Z)")
_inside = re.compile(rf"\s*(?:[{re.escape(SEPARATORS)}\])}}]|/(?=\s)|\Z)")
_escape = re.compile(r"\\(u[0-9a-fA-F]{4}|.)", re.S)
_brackets = {"(": ")", "[": "]", "{": "}"}
_signs = re.compile("[()\\[\\]{}" + "".join(CLOSING) + "]")
DEPTH = 50  # lists within lists; what is nested deeper is a bare value


def _unescaped(text: str) -> str:
    def one(m: re.Match) -> str:
        x = m[1]
        return chr(int(x[1:], 16)) if len(x) == 5 else ESCAPES.get(x, x)

    text = _escape.sub(one, text)
    if re.search("[\ud800-\udfff]", text):  # halves of pairs written as two escapes
        text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return text


def _empty(text: str) -> bool:
    letters = "".join(c for c in text.casefold() if c.isalnum())
    return letters in NOTHING and (letters != "" or not any(c.isalnum() or c in "+#" for c in text))


def _pairs(text: str, at: int) -> dict[int, int]:
    """Place of each opening bracket that is closed -> place of what closes it; quoted values are passed over."""
    stack: list[tuple[str, int]] = []
    out: dict[int, int] = {}
    while m := _signs.search(text, at):
        i, c = m.start(), m[0]
        at = i + 1
        if c in _brackets:
            stack.append((_brackets[c], i))
        elif c in CLOSING:
            before = i - 1
            while before >= 0 and text[before].isspace():
                before -= 1
            if (before < 0 or text[before] in SEPARATORS or text[before] in _brackets) and (got := _quoted(text, i, len(text), _inside)):
                at = got[1]
        elif any(close == c for close, _ in stack[-DEPTH:]):
            while stack[-1][0] != c:
                stack.pop()  # never closed
            out[stack.pop()[1]] = i
    return out


def _quoted(text: str, at: int, end: int, after: re.Pattern = _after) -> tuple[str, int] | None:
    """The quoted value that starts at ``at`` and its end, or None to backtrack."""
    close = CLOSING[text[at]]
    parts, i = [], at + 1
    while True:
        j = text.find(close, i, end)
        if j < 0:
            return None
        back = 0
        while text[j - 1 - back] == "\\" and j - 1 - back > at:
            back += 1
        if back % 2:  # an escaped mark
            parts.append(text[i : j + 1])
            i = j + 1
        elif close == text[at] and text[j + 1 : j + 2] == close and j + 1 < end:  # a doubled mark
            parts.append(text[i : j + 1])
            i = j + 2
        else:
            parts.append(text[i:j])
            if not after.match(text, j + 1, end):
                return None
            body = "".join(parts)
            return (_unescaped(body) if "\\" in body else body), j + 1


def _bare(text: str, at: int, end: int, pairs: dict[int, int]) -> tuple[int, bool]:
    """End of the bare value that starts at ``at``, and whether a bracket in it lacks its counterpart."""
    malformed = False
    while m := _stop.search(text, at, end):
        i, x = m.start(), m[0]
        if x in _brackets:
            close = pairs.get(i, end)
            malformed |= close >= end
            at = i + 1 if close >= end else close + 1
        elif x in ")]}":
            malformed |= x != ")"
            at = i + 1
        elif x == "/" and not (text[i - 1].isspace() and (i + 1 >= end or text[i + 1].isspace())):
            at = i + 1
        else:
            return i, malformed
    return end, malformed


def _list(text: str, at: int, end: int, kind: str, pairs: dict[int, int], depth: int, out: list[tuple[str, str, bool]]) -> None:
    fresh, numbered, first = True, False, len(out)  # at the start of a line, where a list mark may stand; in a numbered list at any value
    while at < end:
        c = text[at]
        if c in SEPARATORS or c.isspace():
            fresh = fresh or numbered or c in "\n\x85\u2028\u2029•·‣▪◦●"
            at += 1
            continue
        if c == "/" and (at + 1 >= end or text[at + 1].isspace()) and (at == 0 or text[at - 1].isspace()):
            at += 1
            continue
        if fresh and (m := _mark.match(text, at, end)) and m.end() > at:
            numbered = numbered or len(out) == first and m[0].strip()[0] == "1"
            at, fresh = m.end(), False
            continue
        fresh, malformed = False, False
        if c in CLOSING:
            if got := _quoted(text, at, end):
                value, at = got
                if value.strip():
                    out.append((value.strip(), "quoted", False))
                continue
            malformed = c in '"“„«'
        elif c in "[{" and depth < DEPTH and (close := pairs.get(at, end)) < end and _after.match(text, close + 1, end):
            _list(text, at + 1, close, "bracketed", pairs, depth + 1, out)
            at = close + 1
            continue
        stop, odd = _bare(text, at, end, pairs)
        if value := text[at:stop].strip():
            out.append((value, kind, malformed or odd))
        at = stop


def parse(text: str | None) -> list[tuple[str, str, bool]]:
    """Values of a packed field as (value, kind, malformed); kind is quoted, bracketed or bare."""
    if text is None or _empty(text):
        return []
    at = m.end() if (m := _label.match(text)) else 0
    if at and _empty(text[at:]):
        return []
    out: list[tuple[str, str, bool]] = []
    _list(text, at, len(text), "bare", _pairs(text, at), 0, out)
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1).to_pylist()
        at, pos, values, kinds, bad = [], [], [], [], []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int32())), pa.array(pos, pa.int32()), pa.array(values, pa.string()), pa.array(kinds, pa.string()), pa.array(bad, pa.bool_())], ["key", "pos", "value", "kind", "malformed"])

        for i, text in enumerate(texts):
            for n, (value, kind, malformed) in enumerate(parse(text), 1):
                at.append(i)
                pos.append(n)
                values.append(value)
                kinds.append(kind)
                bad.append(malformed)
            if len(at) >= 50_000:
                yield flush()
                at, pos, values, kinds, bad = [], [], [], [], []
        yield flush()


def split_packed(df: DataFrame, key: str, field: str) -> DataFrame:
    """One row per value of ``field``: key, pos (from 1), value, kind, malformed.

    Re-sent rows (same key and field) count once; null, empty and "nothing" fields give no row; a null
    key is kept as such; other columns of ``df``, whatever their names, are not read. Texts of any
    length are parsed whole. An empty table gives an empty result.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{field}`").cast("string").alias("text")).where("text is not null").dropDuplicates()
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(_rows, f"key {kind}, pos int, value string, kind string, malformed boolean")
