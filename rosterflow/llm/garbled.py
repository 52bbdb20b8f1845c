"""Garbled text from wrong character encoding: legacy bytes, a byte-structure automaton, span-wise decoding.

For each legacy encoding the characters of a text are mapped back to bytes, and an automaton over the byte classes
of UTF-8 (lead, continuation; no overlong forms, no surrogates) finds the maximal well-formed multibyte spans. The
automaton runs as a compiled expression whose classes are the characters of those bytes. A span is decoded, again
if the result is garbled itself, and taken if what comes out is writing rather than an accident of two
adjoining marks. What lies outside the spans is not touched. U+FFFD, or a lead whose continuation
was lost, marks text that can't be recovered.

Text of one single-byte encoding read as another has no multibyte structure. ``misread`` finds it by the same way back
to bytes, word by word: a word is misread if, of its other readings, one occurs far more often in the whole corpus, or if
several words of its text turn into commoner or less odd ones by one pair of encodings.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.runtime import ship, written

# Encodings with which UTF-8 is wrongly read. C1 controls stand for bytes an encoding lacks.
ENCODINGS = ("cp1252", "iso8859_15", "cp1250", "cp1254", "cp1251", "cp437", "cp850", "mac_roman")
ROUNDS = 4  # text may have been read wrongly several times over
# Continuations that are ordinary marks after a capital or a letter, so prove nothing alone.
CLOSERS = set("“”„’‘…–—»«•™®°§ ›‹·")
# Cyrillic letters of cp1251 at continuation places that occur in ordinary words.
CYRILLIC_OWN = set("ёЁіІїЇєЄґҐўЎ№")


@lru_cache(maxsize=None)
def _bytes_of(encoding: str) -> tuple[dict[int, str], dict[str, int]]:
    chars = {}
    for b in range(0x80, 0x100):
        try:
            chars[b] = bytes([b]).decode(encoding)
        except UnicodeDecodeError:
            chars[b] = chr(b)
    back = {c: b for b, c in chars.items()}
    if encoding.startswith("cp125"):
        for b in range(0x80, 0xA0):
            back.setdefault(chr(b), b)
    return chars, back


@lru_cache(maxsize=None)
def automaton(encoding: str) -> re.Pattern:
    _, back = _bytes_of(encoding)

    def any_of(lo: int, hi: int) -> str:
        return "[" + "".join(re.escape(c) for c, b in back.items() if lo <= b <= hi) + "]"

    cont = any_of(0x80, 0xBF)
    forms = [
        any_of(0xC2, 0xDF) + cont,
        any_of(0xE0, 0xE0) + any_of(0xA0, 0xBF) + cont,
        any_of(0xE1, 0xEC) + cont + cont,
        any_of(0xED, 0xED) + any_of(0x80, 0x9F) + cont,
        any_of(0xEE, 0xEF) + cont + cont,
        any_of(0xF0, 0xF0) + any_of(0x90, 0xBF) + cont + cont,
        any_of(0xF1, 0xF3) + cont + cont + cont,
        any_of(0xF4, 0xF4) + any_of(0x80, 0x8F) + cont + cont,
    ]
    return re.compile(f"(?:{'|'.join(forms)})+")


# Blocks of characters that writing is made of; first and last.
WRITING = ((0x00A0, 0x017F), (0x0218, 0x021B), (0x0300, 0x0328), (0x0386, 0x03CE), (0x0401, 0x045F), (0x0490, 0x0491), (0x05D0, 0x05EA), (0x0621, 0x064A), (0x0660, 0x0669), (0x0900, 0x097F), (0x0E01, 0x0E5B), (0x1E00, 0x1EFF), (0x2003, 0x2003), (0x200B, 0x206F), (0x20A0, 0x20BF), (0x2100, 0x22FF), (0x2500, 0x27BF), (0x3000, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0xFB00, 0xFB06), (0xFE0F, 0xFE0F), (0xFEFF, 0xFEFF), (0xFF00, 0xFFEF), (0x1F000, 0x1FAFF))


@lru_cache(maxsize=65_536)
def _written(c: str) -> bool:
    n = ord(c)
    return n >= 0x80 and any(a <= n <= b for a, b in WRITING) and unicodedata.category(c) not in ("Cn", "Cc", "Cs", "Co")


_common = re.compile("[‐-⁄₠-₿№™​-‍⁠]")
_ascii_letter = re.compile("[A-Za-z]")


@lru_cache(maxsize=65_536)
def _fixed(span: str, encoding: str, depth: int = 0) -> str | None:
    """What the span says, or None if it says nothing sensible."""
    _, back = _bytes_of(encoding)
    out = bytes(back[c] for c in span).decode("utf-8")
    if depth < ROUNDS:
        again, n = _repair_with(out, encoding, depth + 1, True)
        if not n and encoding != "cp1252":
            again, n = _repair_with(out, "cp1252", depth + 1, True)
        if n:
            out = again
    return out if all(_written(c) for c in out if c > "\x7f") else None


def _strong(text: str, lo: int, hi: int, span: str, out: str, encoding: str) -> bool:
    """Whether the span proves by itself that the text was read wrongly."""
    before, after = text[lo - 1 : lo], text[hi : hi + 1]
    chars, back = _bytes_of(encoding)
    first = back[span[0]]
    conts = [c for c in span if back[c] < 0xC0]
    if any("\x80" <= c <= "\x9f" for c in span):
        return True
    sequences = sum(back[c] >= 0xC0 for c in span)
    far = ord(out[0]) >= 0x0300 and not _common.match(out[0])
    if encoding == "cp1251":
        touching = bool(_ascii_letter.match(before) or _ascii_letter.match(after))
        odd = any(c in "§°®™" or c not in CLOSERS and c not in CYRILLIC_OWN for c in conts)
        if first >= 0xE0 and not _common.match(out[0]):
            return odd and sequences >= 2
        return odd or touching or sequences >= 3
    if encoding == "mac_roman":
        if span[0] in "–—“”‘’÷◊ÿŸ⁄€‹›ﬁﬂ":
            return sequences >= 3 and all(c.isalpha() for c in out)
        if first in (0xC2, 0xC3, 0xC4, 0xC5):
            return True
        return bool(_common.match(out[0])) or sequences >= 2 and first >= 0xE1 and all(ord(c) >= 0x3000 for c in out)
    if encoding in ("cp437", "cp850"):
        if unicodedata.category(span[0]) == "So" or "─" <= span[0] <= "▟":
            return True
        return bool(_common.match(out[0])) or sequences >= 3
    if first >= 0xE0:
        return bool(_common.match(out[0])) or sequences >= 2 or first >= 0xF0
    if far and sequences < 2 and not 0x0400 <= ord(out[0]) <= 0x04FF:
        return False
    if all(c in CLOSERS for c in conts) and sequences == 1:
        return before.islower() or after.islower() or span[0] in "ÂĂ" and (conts[0] in "°§®»«· " or before.isdigit() or after.isdigit())
    return True


def _repair_with(text: str, encoding: str, depth: int = 0, sure: bool = False) -> tuple[str, int]:
    """The text with its spans of one encoding decoded, and how many there were."""
    found = []
    proven = sure
    for m in automaton(encoding).finditer(text):
        out = _fixed(m[0], encoding, depth)
        if out is not None:
            found.append((m.start(), m.end(), out))
            proven = proven or _strong(text, m.start(), m.end(), m[0], out, encoding)
    if not found or not proven:
        return text, 0
    parts, at = [], 0
    for lo, hi, out in found:
        parts += [text[at:lo], out]
        at = hi
    return "".join(parts) + text[at:], len(found)


# A lead of two or three bytes in its commonest wrong reading whose continuation was lost or replaced.
_lost = re.compile("[�\x80-\x84\x86-\x9f]|(?<=[a-zß-ÿ ])Ã(?=[?\\s])|â(?:€|\u0080)(?=[?\\s\\w]|$)|â‚(?!¬)|â€(?=[?])")


_run = re.compile(r"[^\x00-\x7f]{2,}")


@lru_cache(maxsize=131_072)
def _reads(run: str) -> tuple[str, ...]:
    """Encodings in which a run of characters beyond ASCII holds a span; every span lies within such a run."""
    return tuple(e for e in ENCODINGS if any(_fixed(m[0], e) is not None for m in automaton(e).finditer(run)))


def _inferred(text: str) -> str:
    """Two continuations that get lost on the way are the only ones their leads can lack: 0x9D and 0xA0."""
    return re.sub("Ã (?= |[\\w“(])", "à", re.sub("â€(?=[\\s.,;:!?)]|$)", "”", text).replace("Ã  ", "à "))


def repair(text: str | None) -> tuple[str | None, int, str | None, bool]:
    """(restored text, spans decoded, encodings, whether anything is lost) of one text."""
    if not text or text.isascii():
        return text, 0, None, False
    total, used = 0, []
    for _ in range(ROUNDS):
        best = ("", 0, None)
        live = {e for run in set(_run.findall(text)) for e in _reads(run)}
        for e in ENCODINGS:
            if e not in live:
                continue
            got, n = _repair_with(text, e)
            if n and len(text) - len(got) > best[1]:
                best = (got, len(text) - len(got), e)
                count = n
        if not best[2]:
            break
        text, total = _inferred(best[0]) if best[2] == "cp1252" else best[0], total + count
        if best[2] not in used:
            used.append(best[2])
    return text, total, ",".join(used) or None, bool(_lost.search(text))


_gap, _edges, _digits = re.compile("([ \t\n\r\f\v]+)"), re.compile(r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$"), re.compile("[0-9]+")


def _bare(word: str) -> str:
    """A word without the ASCII punctuation around it, digits all written as 9."""
    return _edges.sub("", _digits.sub("9", word))


def words_of(text: str) -> list[str]:
    """The distinct words of a text that hold a character beyond ASCII."""
    return list(dict.fromkeys(_bare(w) for w in _gap.split(text) if not w.isascii()))


def _reader(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [repair(t) for t in batch.column(1).to_pylist()]
            marked = [bool(n or lost) for _, n, _, lost in got]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([t if m and keep else None for m, (t, _, _, _) in zip(marked, got)], pa.string()),
                pa.array([n if m else None for m, (_, n, _, _) in zip(marked, got)], pa.int32()),
                pa.array([used for _, _, used, _ in got], pa.string()),
                pa.array([lost if m else None for m, (_, _, _, lost) in zip(marked, got)], pa.bool_()),
                pa.array([words_of(t) for t, _, _, _ in got], pa.list_(pa.string())),
            ], ["key", "restored", "spans", "encodings", "lossy", "words"])

    return run


def read_through(df: DataFrame, key: str, text: str, keep: bool = False) -> DataFrame:
    """key, restored, spans, encodings, lossy, words of every row whose text isn't plain ASCII.

    ``spans``, ``encodings`` and ``lossy`` are null where no span was found and nothing is lost; ``restored`` is null there,
    too, and everywhere unless ``keep``. ``words`` are those beyond ASCII of what the spans gave back. Null, empty and
    plain ASCII texts never leave the JVM; rows that are repeated come repeatedly; whole texts are examined, once. No shuffle.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text")).where("text rlike '[^\\\\x00-\\\\x7F]'")
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(_reader(keep), f"key {kind}, restored string, spans int, encodings string, lossy boolean, words array<string>")


# Single-byte encodings that are taken for each other.
SINGLE = ("cp1252", "latin-1", "cp1250", "cp1251", "cp437", "cp850", "cp852", "mac_roman", "koi8_r", "iso8859_5", "cp866", "cp1253")
TIMES, LEAST = 10, 10  # a reading must occur this many times as often as the word, and in so many texts at least


def readings(word: str) -> dict[str, list[str]]:
    """Other readings of a word -> the encodings (read>meant) that give it."""
    out: dict[str, list[str]] = {}
    for read in SINGLE:
        try:
            raw = word.encode(read)
        except UnicodeEncodeError:
            continue
        for meant in SINGLE:
            try:
                other = raw.decode(meant)
            except UnicodeDecodeError:
                continue
            if other != word:
                out.setdefault(other, []).append(f"{read}>{meant}")
    return out


def _readings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(w, n, r, e) for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for r, e in readings(w).items()]
        cols = list(zip(*rows)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.list_(pa.string()))], ["word", "n", "meant", "pairs"])


# Marks that join the parts of an ordinary word.
JOINS = set("’‑·–­")


def _script(c: str) -> str:
    return "LATIN" if c < "\u0250" else unicodedata.name(c, "?").split()[0]


@lru_cache(maxsize=65_536)
def odd(word: str) -> int:
    """Places of a word that no writing has: controls, marks between letters, capitals after small ones, mixed scripts."""
    n = 0
    for i, c in enumerate(word):
        before, after = word[i - 1 : i] if i else "", word[i + 1 : i + 2]
        if "\x80" <= c <= "\x9f":
            n += 1
        elif c > "\x7f" and not c.isalpha() and c not in JOINS and unicodedata.category(c)[0] != "M" and before.isalpha() and after.isalpha():
            n += 1
        elif before.isalpha() and c.isalpha() and max(before, c) > "\x7f":
            n += before.islower() and c.isupper() or _script(before) != _script(c)
    return n


def plausible(word: str, n: int, ways: list[dict]) -> list[dict]:
    """The readings of a word that may be meant: commoner and no odder, or less odd; ``strong`` are those TIMES as common."""
    out = []
    for w in ways:
        less = odd(w["meant"]) - odd(word)
        if w["m"] >= TIMES * n or less < 0 or less == 0 and w["m"] > n:
            out.append({**w, "n": n, "strong": w["m"] >= TIMES * n})
    return out


WAYS = pa.list_(pa.struct([("meant", pa.string()), ("m", pa.int64()), ("pairs", pa.list_(pa.string())), ("n", pa.int64()), ("strong", pa.bool_())]))


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(w, plausible(w, n, ways)) for w, n, ways in zip(*(batch.column(x).to_pylist() for x in ("word", "n", "ways")))]
        rows = [r for r in rows if r[1]]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], WAYS)], ["word", "ways"])


def judged(words: list[dict]) -> list[tuple[str, str, str, int, bool]]:
    """(word, meant, reading, n, sure) of the words of one text that may be misread; ``sure`` if the text itself proves it.

    A text was read wrongly by a pair of encodings if two words of three characters, with letters, say so; then all its words that
    the pair explains are taken. Else a word needs a strong reading. One with a letter, or with a control where a letter
    should be, then speaks for itself. Marks alone ('®', '§9') are ordinary in clean texts however common their
    reading is, so they need another word misread by the same encodings.
    """
    lettered = lambda x: any(c.isalpha() for c in x)
    votes: Counter = Counter()
    others: Counter = Counter()
    for w in words:
        for way in w["ways"]:
            for p in way["pairs"]:
                votes[p] += len(w["word"]) > 2 and lettered(w["word"]) and lettered(way["meant"])
                others[p] += way["strong"]
    out = []
    for w in words:
        word = w["word"]
        *_, reading, way = min(((-votes[p], -others[p], -way["m"], way["meant"], p, way) for way in w["ways"] for p in way["pairs"]), key=lambda x: x[:5])
        own = lettered(word) or any("\x80" <= c <= "\x9f" for c in word)
        out.append((word, way["meant"], reading, way["n"], votes[reading] > 1 or way["strong"] and (own or others[reading] > 1)))
    return out


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, cols = [], ([], [], [], [], [])
        for i, words in enumerate(batch.column("words").to_pylist()):
            for row in judged(words):
                at.append(i)
                for col, x in zip(cols, row):
                    col.append(x)
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(at, pa.int32())), *[pa.array(x, t) for x, t in zip(cols, kinds)]], ["key", "word", "meant", "reading", "n", "sure"])


def misread(read: DataFrame) -> DataFrame:
    """(key, word, meant, reading): words of texts (key, words) that were read in the wrong single-byte encoding.

    Only keys and words move, never texts. Counts are those of all texts. What the words of one text say together decides
    (``judged``); a word that is proven so in half of its texts is taken in the others, too.
    """
    ship(read.sparkSession)
    words = read.where("key is not null").select("key", F.explode("words").alias("word"))
    counts = written(words.groupBy("word").agg(F.count("*").alias("n")), "words")
    other = counts.mapInArrow(_readings, "word string, n bigint, meant string, pairs array<string>")
    known = counts.where(F.col("n") >= LEAST).select(F.col("word").alias("meant"), F.col("n").alias("m"))
    better = other.join(known, "meant").groupBy("word", "n").agg(F.array_sort(F.collect_set(F.struct("meant", "m", "pairs"))).alias("ways"))
    ways = written(better.mapInArrow(_plausible, "word string, ways array<struct<meant: string, m: bigint, pairs: array<string>, n: bigint, strong: boolean>>"), "ways")
    # the 1,000 commonest words that can't be misread are taken out first, so that no hot word is shuffled for nothing
    common = counts.join(ways, "word", "left_anti").orderBy(F.desc("n"), "word").limit(1_000).select("word")
    hits = words.join(F.broadcast(common), "word", "left_anti").join(ways, "word")
    of_text = hits.groupBy("key").agg(F.collect_set(F.struct("word", "ways")).alias("words"))
    rows = written(of_text.mapInArrow(_judged, f"key {of_text.schema['key'].dataType.simpleString()}, word string, meant string, reading string, n bigint, sure boolean"), "judged")
    # of a word every text has its own best reading; the one proven in half of them is a single one
    proven = rows.groupBy("word", "meant").agg(F.count_if("sure").alias("sure"), F.max("n").alias("n"), F.min(F.when(F.col("sure"), F.col("reading"))).alias("how")).where("sure * 2 > n and sure > 1").select("word", "meant", "how")
    also = rows.where("not sure").drop("meant", "reading").join(proven, "word").select("key", "word", "meant", F.col("how").alias("reading"))
    return rows.where("sure").select("key", "word", "meant", "reading").unionByName(also)


def _found(read: DataFrame) -> DataFrame:
    """key, spans, encodings, lossy, words, spanned from rows of ``read_through`` that are written."""
    bad = misread(read)
    words = bad.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("word", "meant", "reading"))).alias("words"))
    spanned = read.where("key is not null and spans is not null").select("key", "spans", "encodings", "lossy", F.lit(True).alias("spanned"))
    return spanned.dropDuplicates(["key"]).join(words, "key", "full")


def garbled(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, spans, encodings, lossy, words: every row with wrongly decoded text, recoverable or not.

    ``spans`` and ``encodings`` are null where only single words were misread, ``words`` where none were.
    One row for each key; null keys are left out.
    """
    return _found(written(read_through(df, key, text), "read")).drop("spanned")


def restored_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, restored, lossy: the texts of all garbled rows with spans and words put right.

    One row for each key; of a key that comes with several texts one is taken.
    """
    read = written(read_through(df, key, text, keep=True), "read")
    found = written(_found(read).select("key", "words", "lossy", "spanned"), "found")
    whole = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    # texts in which only words were misread are few; those with spans were restored on the way
    rest = whole.where("text rlike '[^\\\\x00-\\\\x7F]'").join(found.where("spanned is null").select("key"), "key", "left_semi")
    texts = read.where("spans is not null").select("key", F.col("restored").alias("text")).unionByName(rest).dropDuplicates(["key"])
    return found.select("key", "words", "lossy").join(texts, "key").mapInArrow(_put_right, f"key {whole.schema['key'].dataType.simpleString()}, restored string, lossy boolean")


def _put_right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = {n: batch.column(n).to_pylist() for n in ("words", "text", "lossy")}
        out = []
        for words, text in zip(cols["words"], cols["text"]):
            meant = {w["word"]: w["reading"].split(">") for w in words or ()}

            def one(w: str) -> str:
                if w.isascii() or (reading := meant.get(_bare(w))) is None:
                    return w
                try:
                    return w.encode(reading[0]).decode(reading[1])
                except UnicodeError:
                    return w

            out.append("".join(map(one, _gap.split(text))) if meant else text)
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.string()), pa.array([bool(x) for x in cols["lossy"]], pa.bool_())], ["key", "restored", "lossy"])
