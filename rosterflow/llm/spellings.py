"""Variant spellings of organisation names: noisy-channel attribution.

Every distinct spelling is read as proper name, trade, legal form and decoration. Spellings of the same reading are
one form, whose frequency is that of its spellings. A form may have come from another through the channel: a typo,
an abbreviated or lost word, an initial, a nickname, a changed order. Forms are candidates for each other where
they share a key that survives one error; the posterior of a candidate is its frequency prior times
the likelihood of the errors. The form itself is a candidate, too: its frequency times the chance that an organisation of
its own lies that near another one. Each form is attached to its maximum; linked forms are an organisation.

What the corpus tells is learned from it: the rates of all kinds of errors (by expectation and maximisation, from the
rates below as a start), how much a letter and a common word tell, and so the chance of a coincidence. The lists
of words spare the learning of what is generally known. No link depends on a word being listed: unlisted trades and names are
compared word by word, with abbreviations and nicknames recognised by their shape.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.normalize import LEGAL_SUFFIXES
from rosterflow.operators.components import connected
from rosterflow.runtime import ship, written

# Words by which a company's name ends for legal reasons.
LEGAL = set(LEGAL_SUFFIXES) | {"mbh", "kg", "sas", "srl", "spa", "oyj", "as", "aps"}
# Words that adorn a name and tell no company from another.
DECORATION = ("group", "holdings", "holding", "services", "partners", "associates", "international")
# Their usual short forms.
ADORNS_SHORT = ("grp", "hldg", "hldgs", "svcs", "serv", "ptnrs", "prtnrs", "assoc", "assocs", "intl")
# What companies trade in.
TRADES = ("consulting", "technologies", "foods", "insurance", "analytics", "solutions", "hospitality", "electronics", "publishing", "recruitment", "staffing", "pharmaceuticals", "transport", "industries", "engineering", "biosciences", "communications", "logistics", "financial", "manufacturing", "systems", "laboratories", "construction", "design", "advisory", "coaching", "bookkeeping", "architects", "energy", "software", "media", "retail", "security", "capital", "ventures", "properties", "chemicals", "textiles", "robotics", "education", "healthcare", "travel", "legal", "accounting", "marketing")
# What institutions are called, before "of".
INSTITUTIONS = ("university", "institute", "hospital", "bank", "port", "college", "ministry", "museum", "city")
# Offices and regions after a name.
PLACES = {"hq", "dach", "emea", "apac", "latam", "benelux", "nordics", "uk", "us", "usa", "eu", "head office", "headquarters", "global", "remote"}
# Entries that name no organisation.
NOBODY = {"", "n a", "na", "none", "null", "nil", "unknown", "confidential", "undisclosed", "parental leave", "maternity leave", "paternity leave", "sabbatical", "career break", "stealth startup", "stealth mode startup", "stealth", "freelance", "freelancer", "self employed", "selfemployed", "self employment", "various clients", "various", "multiple clients", "various companies", "independent", "independent contractor", "contractor", "unemployed", "not applicable", "not available", "tbd", "private", "retired", "student", "own business", "company", "employer", "see resume", "see cv"}
# Given names and short forms of them; those made by cutting and a y, ie, o or a need no entry.
GIVEN = {"alexander": "alex sasha alec xander sandy", "andrew": "andy drew", "anthony": "tony", "barbara": "barb babs", "charles": "chuck chas charlie", "christopher": "chris kit", "deborah": "deb debbie", "dorothy": "dot dottie", "edward": "ed eddie ted ned", "eleanor": "nell nora ellie", "elizabeth": "beth liz lizzie betty eliza lisa", "francis": "frank", "george": "geordie", "harold": "hal harry", "henry": "hank harry", "james": "jim jimmy jamie", "john": "jack johnny", "joseph": "joe joey", "katherine": "kate kathy katie katy kat kitty catherine", "lawrence": "larry", "leonard": "len lenny", "margaret": "peg peggy maggie meg greta marge", "mary": "molly polly", "michael": "mike mick mickey", "nicholas": "nick klaus", "patricia": "pat patty trish", "rebecca": "becky", "richard": "rick dick richie rich", "robert": "rob bob bobby robbie bert", "sarah": "sally", "susannah": "sue suzie suze susie susan susanna suzanne", "theodore": "ted theo teddy", "thomas": "tom tommy", "walter": "walt wally", "william": "will bill billy willy liam"}
NICK = {n: full for full, short in GIVEN.items() for n in [full, *short.split()]}
ENDINGS = ("", "y", "ie", "i", "ey", "o", "a", "s")

# Kinds of errors and the logarithms of their rates before the corpus has been looked at.
RATES = {"typo": -5.0, "initial": -2.0, "lost": -4.0, "untold": -2.0, "abbreviated": -2.0, "nicknamed": -3.0, "reordered": -3.0}
PRIOR = 1_000  # names whose worth these rates are, and tenfold in letters the information of one
LETTER = 2.3  # information of a letter in nats
WORLD = 10_000  # organisations at least among which a name may lie near another by chance
EXCESS = 3.0  # power by which an origin suffers that isn't commoner than its errors
SEEN, ALONE = 64, 100  # frequencies told apart; forms whose worth is the default that all organisations are rare
COMMON = 20  # forms that make a word a common one, at least
LONG = 12  # consonants of a word above which two or three of them aren't keys any more, but single ones
NEAR = -5.0  # cost of reading a word through a typo
SMALL = {"of", "and", "the", "by", "for", "de", "und", "et"}


def one_error(a: str, b: str) -> int | None:
    """0 if equal, 1 if one letter was inserted, lost, changed or two neighbours swapped, else None."""
    if a == b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return None
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(a) < len(b):
        return 1 if a[i:] == b[i + 1 :] else None
    if a[i + 1 :] == b[i + 1 :]:
        return 1
    return 1 if a[i + 2 :] == b[i + 2 :] and a[i] == b[i + 1] and a[i + 1] == b[i] else None


def _short_for(a: str, word: str) -> bool:
    """Whether ``a`` abbreviates ``word``: a head of it, or its letters in order with few vowels."""
    if a[0] != word[0] or len(a) >= len(word):
        return False
    if len(a) >= 3 and word.startswith(a):
        return True
    rest = iter(word)
    return all(c in rest for c in a) and 3 * sum(c in "aeiou" for c in a) <= len(a) + (len(a) < 3)


@lru_cache(maxsize=200_000)
def meanings(token: str, of: bool, loose: bool) -> tuple[tuple[str, ...], float]:
    """Words of the lexicon that a token may stand for, and the likelihood of its form."""
    words = (*INSTITUTIONS, *TRADES, *DECORATION) if of else (*TRADES, *INSTITUTIONS, *DECORATION)
    if token in words:
        return (token,), 0.0
    if len(token) < 2:
        return (), 0.0
    short = tuple(w for w in words if len(token) >= 3 and w.startswith(token)) or tuple(w for w in words if _short_for(token, w))
    if short:
        return short, -1.0
    if len(token) >= 4:
        near = tuple(w for w in words if one_error(token, w))
        if near:
            return near, NEAR
    if len(token) >= 4:
        near = tuple(w for w in words if loose and any(one_error(token, w[:n]) for n in range(max(3, len(token) - 1), len(token) + 2)))
        if not near and 3 * sum(c in "aeiou" for c in token) <= len(token):
            shapes = {token[:i] + token[i + 1 :] for i in range(1, len(token))} | {token[:i] + token[i + 1] + token[i] + token[i + 2 :] for i in range(1, len(token) - 1)}
            near = tuple(w for w in words if any(_short_for(s, w) and s[-1] not in "aeiou" for s in shapes))
        if near:
            return near, NEAR - 1.0
    return (), 0.0


def _legal(t: str) -> bool:
    return t in LEGAL or len(t) >= 6 and any(one_error(t, w) for w in ("incorporated", "corporation", "limited", "company"))


def _given(t: str) -> str | None:
    if t in NICK:
        return NICK[t]
    # short names lie near each other by chance
    return next((NICK[g] for g in NICK if min(len(t), len(g)) >= 4 and one_error(t, g) and (len(g) > 5 or t[0] == g[0] and len(t) + len(g) > 9)), None)


def read(name: str) -> dict | None:
    """Proper words, initial, given name and trades of a spelling; None if it names no organisation."""
    text = unicodedata.normalize("NFKC", name).casefold()
    text = "".join(c for c in text if unicodedata.category(c) not in ("Cf", "Mn"))
    plain = re.sub(r"[^\w]+", " ", text).strip()
    if plain in NOBODY:
        return None
    text = re.sub("['’`]", "", text)
    text = re.sub(r"\b(?:[^\W\d_]\.)+[^\W\d_]\b\.?", lambda m: m[0].replace(".", ""), text)
    for _ in range(2):
        m = re.search(r"(?:[(\[]\s*([^()\[\]]*?)\s*[)\]]|(?:\s[-–—/|]|[,;])\s*([^-–—/|,;()]*?))\s*$", text)
        if m and re.sub(r"[^\w]+", " ", m[1] or m[2] or "").strip() in PLACES:
            text = text[: m.start()]
    given, by = None, False
    if m := re.fullmatch(r"\s*([^\W\d_]+)\s*,\s*([^\W\d_]+)\.?\s*[-–—]\s*(.+)", text):
        if _given(m[2]) or len(m[2]) == 1:
            given, text, by = m[2], f"{m[1]} {m[3]}", True
    tokens = re.findall(r"[^\W_]+", text)
    if not by and "by" in tokens[1:-1] and (i := tokens.index("by", 1)) and len(tokens) - i in (2, 3):
        tail = tokens[i + 1 :]
        if len(tail) == 2:
            given, tail, by = tail[0], tail[1:], True
        tokens = [*tail, *tokens[:i]]
    of = "of" in tokens
    if tokens[:1] == ["the"] and len(tokens) > 1:
        tokens = tokens[1:]
    while len(tokens) > 1 and _legal(tokens[-1]):
        tokens = tokens[:-1]
    whole = " ".join([given, *tokens] if given else tokens) or plain
    if not by and len(tokens) > 1 and (_given(tokens[0]) or len(tokens[0]) == 1) and not of:
        given, tokens = tokens[0], tokens[1:]
    words = [t for t in tokens if t not in SMALL and one_error(t, "studio") is None]
    if of and len(words[0]) == 1 and len(words) > 1:  # "U. of" something
        words[0] = next((w for w in INSTITUTIONS if w[0] == words[0]), words[0])
    enough = len(words) > 2 - bool(given)
    found = [meanings(t, of, loose=i > 0 and enough) for i, t in enumerate(words)]
    if enough and not any(w not in DECORATION for got, _ in found for w in got):
        found = [meanings(t, of, loose=True) for t in words]  # a garbled trade may come first, too
    tells = [tuple(w for w in got if w not in DECORATION) for got, _ in found]
    if of:
        tells = [tuple(w for w in got if w in INSTITUTIONS) or got for got in tells]
    # the word that is the likeliest to tell the trade; of equal ones the last
    best = max((i for i, got in enumerate(tells) if got and (len(words) > 1 or given)), key=lambda i: (found[i][1], i), default=None)
    trades = tells[best] if best is not None else ()
    proper: list[str] = []
    initial = ""
    for i, t in enumerate(words):
        got, c = found[i]
        adorns = i > 0 and any(w in DECORATION for w in got) and (c > NEAR - 1.0 or best is not None and i > best)
        adorns = adorns or (best is not None and i > best or i > 1) and any(one_error(t, w) for w in ADORNS_SHORT)
        if i == best or adorns:
            continue
        if len(t) == 1 and proper and not initial:
            initial = t
        else:
            proper.append(t)
    if not proper:
        if not given or len(given) == 1:
            return {"proper": [], "initial": "", "given": "", "trades": [], "raw": whole, "words": []} if plain else None
        proper, given, words = [given], None, [given, *words]
    full = (_given(given) or given) if given else ""
    # a trade read through a typo may be another, unlisted word, so the words are kept as they are
    plainly = words if best is not None and found[best][1] <= NEAR and not initial else []
    return {"proper": proper, "initial": initial, "given": full, "trades": sorted(trades), "raw": "", "words": plainly}


def form_key(r: dict) -> str:
    return "|".join((r["raw"], "".join(r["proper"]), r["initial"], r["given"], "/".join(r["trades"])))


def _less(t: str) -> set[str]:
    return {t} | {t[:i] + t[i + 1 :] for i in range(len(t))}


def _expansions(w: str) -> set[str]:
    """Keys of all that ``_short_for`` takes for ``w``, of heads of it too; ``_shortened`` has those of an abbreviation."""
    out = {f"p{w[:k]}" for k in range(3, len(w))} | {f"u{w[0]}{x}" for x in set(w[1:])}
    firm = [x for x in w[1:] if x not in "aeiou"]
    if len(firm) > LONG:
        return out | {f"l{w[0]}{x}" for x in set(firm)}
    return out | {f"t{w[0]}{''.join(x)}" for n in (2, 3) for x in combinations(firm, n)}


def _shortened(a: str) -> Iterator[str]:
    if len(a) >= 3:
        yield f"p{a}"
    if len(a) > 1 and 3 * sum(c in "aeiou" for c in a) <= len(a) + (len(a) < 3):
        firm = [x for x in a[1:] if x not in "aeiou"]
        if len(firm) > 1:
            yield f"t{a[0]}{''.join(firm[:3])}"
            yield f"l{a[0]}{firm[0]}"
        else:
            yield f"u{a[0]}{(firm or a[1:])[0]}"


def _stems(w: str) -> set[str]:
    """What ``nickname`` looks for at the head of a full name."""
    out = {w[: len(w) - len(e)] for e in ENDINGS if w.endswith(e)}
    return {x for x in out | {x[:-1] for x in out if x[-2:-1] == x[-1:]} if len(x) >= 3}


def _keys(r: dict) -> Iterator[tuple[str, int]]:
    """Keys that survive one error, with the roles in which a form has them: 1 origin, 2 variant, 3 both.

    Whatever ``errors`` accepts has a key in common. Keys that aren't narrow by themselves have a trade; for variants that tell none, origins have them without.
    """
    for x in _less(r["raw"]) if r["raw"] else ():
        yield f"R{x}", 3
    if r["raw"]:
        return
    proper, joined, trades = r["proper"], "".join(r["proper"]), r["trades"]

    def traded(key: str, role: int) -> Iterator[tuple[str, int]]:
        for t in trades:
            yield f"{key}|{t}", role
        if role & 1 or not trades:
            yield f"{key}|", role & 1 if trades else role

    for x in _less(joined):
        yield f"J{x}", 3
    head = _less(proper[0])
    if len(proper) > 1:
        for x in head:
            yield f"I{x}|{proper[1][0]}", 1
            for t in trades:
                yield f"D{x}|{t}", 1
            yield f"N{x}", 1
        yield from traded(f"O{'|'.join(sorted(proper))}", 3)
        yield f"L{''.join(proper[:-1])}", 1
        yield f"L{joined}", 2
        rest = "|".join(proper[1:])
        if proper[0] in NICK:
            yield from traded(f"K{rest}|{NICK[proper[0]]}", 3)
        for x in _stems(proper[0]):
            yield from traded(f"W*|{rest}|p{x}", 2)
            yield from traded(f"Q{rest}|{x}", 1)
        for k in range(3, len(proper[0]) - 1):
            yield from traded(f"Q{rest}|{proper[0][:k]}", 2)
    else:
        for x in head:
            if r["initial"]:
                yield f"I{x}|{r['initial']}", 2
            for t in trades:
                yield f"D{x}|{t}", 2
            if not trades:
                yield f"N{x}", 2
    for i, w in enumerate(proper):
        rest = "|".join([*proper[:i], "*", *proper[i + 1 :]])
        for k in _expansions(w):
            yield from traded(f"W{rest}|{k}", 1)
        for k in _shortened(w):
            yield from traded(f"W{rest}|{k}", 2)
    for i, w in enumerate(r["words"]):
        rest = "|".join([*r["words"][:i], "*", *r["words"][i + 1 :]])
        for k in _shortened(w):
            yield f"W{rest}|{k}|", 2


def nickname(a: str, b: str) -> bool:
    """Whether one of two given names is a short form of the other or of the same name: listed, or cut and given an ending."""
    if NICK.get(a, a) == NICK.get(b, b):
        return True
    short, full = sorted((a, b), key=len)
    return any(short.endswith(e) and len(stem := short[: len(short) - len(e)]) >= 3 and (full.startswith(stem) or stem[-1] == stem[-2] and full.startswith(stem[:-1]) and len(stem) > 3) and len(full) > len(stem) + 1 for e in ENDINGS)


def errors(v: dict, c: dict) -> dict[str, int] | None:
    """Errors by which ``v`` may have come out of ``c``, None if it can't have. Words get lost, they aren't added."""
    out: dict[str, int] = {}

    def add(kind: str, n: int = 1) -> None:
        if n:
            out[kind] = out.get(kind, 0) + n

    if v["raw"] or c["raw"]:
        short = [[w for w in x["raw"].split() if len(w) == 1] for x in (v, c)]  # initials are no typos of each other
        d = one_error(v["raw"], c["raw"]) if v["raw"] and c["raw"] and short[0] == short[1] else None
        add("typo", d or 0)
        return None if d is None else out
    if v["words"] and not c["trades"] and v["given"] == c["given"] and len(v["words"]) == len(c["proper"]):
        odd = [(p, q) for p, q in zip(v["words"], c["proper"]) if p != q]
        if len(odd) == 1 and len(odd[0][0]) > 1 and _short_for(*odd[0]):
            return {"abbreviated": 1}
    if v["trades"]:
        if not set(v["trades"]) & set(c["trades"]):
            return None
    elif c["trades"]:
        add("untold")
    a, b = v["given"], c["given"]
    if a and b:
        if a != b:
            if len(a) == 1 and b[0] == a:
                add("initial")
            elif min(len(a), len(b)) > 1 and nickname(a, b):
                add("nicknamed")
            else:
                return None
    elif b and not v["initial"]:
        add("lost")
    elif a:
        return None
    x, y = v["proper"], c["proper"]
    if v["initial"] and v["initial"] != c["initial"]:
        if len(x) != 1 or len(y) < 2 or y[1][0] != v["initial"] or (d := one_error(x[0], y[0])) is None:
            return None
        add("initial")
        add("typo", d)
        return out
    if c["initial"] and not v["initial"]:
        add("lost")
    if (d := one_error("".join(x), "".join(y))) is not None:
        add("typo", d)
    elif sorted(x) == sorted(y):
        add("reordered")
    elif len(x) == len(y) and len(odd := [i for i, (p, q) in enumerate(zip(x, y)) if p != q]) == 1:
        p, q = x[odd[0]], y[odd[0]]
        if len(p) > 1 and _short_for(p, q):
            add("abbreviated")
        elif odd[0] == 0 and not a and len(x) > 1 and min(len(p), len(q)) > 1 and nickname(p, q):
            add("nicknamed")
        else:
            return None
    elif len(x) == 1 and len(y) > 1 and (d := one_error(x[0], y[0])) is not None:
        add("lost")
        add("typo", d)
    elif len(x) > 1 and y[:-1] == x and not v["trades"]:
        add("lost")
    else:
        return None
    return out


def coincidence(v: dict, c: dict, found: Mapping[str, int], common: Mapping[str, int], forms: int, letter: float) -> float:
    """Logarithm of the number of organisations other than ``c`` that by chance have what ``v`` has of it, at most 1/2 unless it is a single abbreviated word."""
    told = lambda w: min(letter * len(w), math.log(forms / common[w]) if w in common else math.inf)
    names = v["proper"] or [v["raw"]]
    out = math.log(max(WORLD, forms)) - sum(map(told, names)) - letter * len(v["initial"])
    if v["trades"] and c["trades"]:
        out -= min(told(t) for t in set(v["trades"]) & set(c["trades"]))
    if v["given"] and c["given"]:
        out -= told(v["given"])
    if found.get("typo"):
        out += math.log(54 * sum(map(len, names)))  # names within one error of a name
    if found.get("abbreviated") and len(v["proper"]) == len(c["proper"]) == 1:
        # a short word by itself is short for many, a head in one way, consonants in as many as they can be chosen
        p, q = v["proper"][0], c["proper"][0]
        kept, of = (sum(x not in "aeiou" for x in w[1:]) for w in (p, q))
        return out + (0.0 if q.startswith(p) else math.log(math.comb(of, kept)))
    return min(out, math.log(0.5))


_FORM = "struct<proper:array<string>,initial:string,given:string,trades:array<string>,raw:string,words:array<string>>"
_TYPE = pa.struct([("proper", pa.list_(pa.string())), ("initial", pa.string()), ("given", pa.string()), ("trades", pa.list_(pa.string())), ("raw", pa.string()), ("words", pa.list_(pa.string()))])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, counts, keys, forms, n = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [], [], []
        kept = []
        for name, count in zip(names, counts):
            r = read(name)
            if r:
                kept.append(name)
                n.append(count)
                keys.append(form_key(r))
                forms.append(r)
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(keys, pa.string()), pa.array(forms, _TYPE)], ["name", "n", "form", "body"])


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        forms, hashes, roles = [], [], []
        for form, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held: dict[str, int] = {}
            for k, role in _keys(body):
                held[k] = held.get(k, 0) | role
            forms.extend([form] * len(held))
            hashes.extend(int.from_bytes(hashlib.blake2b(k.encode(), digest_size=8).digest(), "big", signed=True) for k in held)
            roles.extend(held.values())
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(roles, pa.int8()), pa.array(forms, pa.string())], ["key", "role", "form"])


_ERRORS = pa.list_(pa.int32())


def _compare(common: Mapping[str, int], n_forms: int, letter: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, kinds, chance = [], [], []
            for i, (v, c, nv, nc, bv, bc) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(6)))):
                found = errors(bv, bc)
                # what is wrong in either direction can only have come out of the commoner one
                if found is None or not set(found) - {"typo", "reordered", "nicknamed"} and (len(bc["trades"]) > len(bv["trades"]) or len(bc["trades"]) == len(bv["trades"]) and (nc, c) <= (nv, v)):
                    continue
                at.append(i)
                kinds.append([found.get(k, 0) for k in RATES])
                chance.append(coincidence(bv, bc, found, common, n_forms, letter))
            kept = batch.select(["v", "c", "nv", "nc"]).take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(kinds, _ERRORS), pa.array(chance, pa.float64())], ["v", "c", "nv", "nc", "errors", "chance"])

    return run


def _learned(forms: DataFrame) -> tuple[dict[str, int], int, float]:
    """Common words with the number of their forms, the number of all forms, and the information of a letter.

    A common word is in COMMON forms and in a thousandth of all, so there are at most a thousand times as many as a form has words.
    """
    n = forms.count()
    words = forms.select(F.explode(F.array_distinct(F.concat("body.proper", "body.trades", F.array("body.given")))).alias("w")).where("w <> ''")
    common = {r.w: r.n for r in words.groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= max(COMMON, n / 1_000)).collect()}
    text = F.array_join("body.proper", "")
    two = forms.select(text.alias("t")).where("length(t) > 1").select(F.explode(F.expr("transform(sequence(1, length(t) - 1), i -> substring(t, i, 2))")).alias("b"))
    two = two.groupBy("b").agg(F.count("*").cast("double").alias("n")).groupBy(F.substring("b", 1, 1)).agg(F.sum("n").alias("n"), F.sum(F.expr("n * ln(n)")).alias("s"))
    got = two.agg(F.sum(F.expr("n * ln(n) - s")).alias("h"), F.sum("n").alias("n")).first()
    return common, n, ((got.h or 0.0) + LETTER * PRIOR * 10) / ((got.n or 0.0) + PRIOR * 10)


def _rarity(forms: DataFrame, scored: DataFrame) -> list[float]:
    """Logarithms of how often an organisation's own form occurs at most 1, 2 ... SEEN times, learned from forms near no other."""
    alone = forms.join(scored.select(F.col("v").alias("form")).distinct(), "form", "left_anti")
    seen = {r.n: r.k for r in alone.groupBy(F.least("n", F.lit(SEEN)).alias("n")).agg(F.count("*").alias("k")).collect()}  # SEEN rows at most
    upto, out, total = ALONE, [], ALONE + sum(seen.values())
    for n in range(1, SEEN + 1):
        upto += seen.get(n, 0)
        out.append(math.log(upto / total))
    return out


def _attached(scored: DataFrame, rates: Mapping[str, float], rarity: list[float]) -> DataFrame:
    """(a, b, n, errors): forms attached to another one, which has the greatest posterior of all and beats the form itself."""
    likely = sum((F.col("errors")[i] * F.lit(r) for i, r in enumerate(rates.values())), F.lit(0.0))
    score = F.ln("nc") + likely + EXCESS * F.ln(F.col("nc") / (F.col("nc") + F.col("nv")))
    better = scored.withColumn("score", score).where(F.col("score") > F.ln("nv") + F.col("chance") + F.array(*[F.lit(x) for x in rarity])[F.least("nv", F.lit(SEEN)).cast("int") - 1])
    best = better.groupBy("v").agg(F.min(F.struct((-F.col("score")).alias("s"), "c", "errors", "nv")).alias("best"))
    return best.select(F.col("v").alias("a"), F.col("best.c").alias("b"), F.col("best.nv").alias("n"), F.col("best.errors").alias("errors"))


def channel(scored: DataFrame, total: int, rarity: list[float], rounds: int = 2) -> dict[str, float]:
    """Logarithms of the rates of errors among all names, learned by attaching forms with those of the round before."""
    rates = dict(RATES)
    for _ in range(rounds):
        seen = _attached(scored, rates, rarity).agg(*[F.coalesce(F.sum((F.col("errors")[i] > 0).cast("long") * F.col("n")), F.lit(0)).alias(k) for i, k in enumerate(RATES)]).first()
        rates = {k: math.log((seen[k] + PRIOR * math.exp(r)) / (total + PRIOR)) for k, r in RATES.items()}
    return rates


def organisations(names: DataFrame, name: str = "name") -> DataFrame:
    """(name, organisation): every distinct spelling with the form it is attributed to.

    Spellings are compared exactly as stored. Nulls, blanks and entries that name no organisation are left out;
    frequencies are counts over all rows. An organisation is called by its commonest form; ties go to the first form by
    order. Empty tables give no rows.
    """
    ship(names.sparkSession)
    counts = names.select(F.col(f"`{name}`").cast("string").alias("name")).where("name is not null").groupBy("name").agg(F.count("*").alias("n"))
    spelled = written(counts.mapInArrow(_read, f"name string, n bigint, form string, body {_FORM}"), "spellings")
    forms = written(spelled.groupBy("form").agg(F.sum("n").alias("n"), F.max_by("body", F.struct(F.size("body.proper"), "name")).alias("body")), "forms")
    common, n_forms, letter = _learned(forms)
    keys = written(forms.select("form", "body").mapInArrow(_emit, "key bigint, role byte, form string"), "keys")
    variant = keys.where("role > 1").select("key", F.col("form").alias("v"))
    origin = keys.where("role % 2 = 1").select("key", F.col("form").alias("c"))
    pairs = variant.join(origin, "key").where("v <> c").select("v", "c").distinct()
    of = lambda x: forms.select(F.col("form").alias(x), F.col("n").alias(f"n{x}"), F.col("body").alias(f"b{x}"))
    compared = pairs.join(of("v"), "v").join(of("c"), "c").select("v", "c", "nv", "nc", "bv", "bc")
    scored = written(compared.mapInArrow(_compare(common, n_forms, letter), "v string, c string, nv bigint, nc bigint, errors array<int>, chance double"), "scored")
    total = forms.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rarity = _rarity(forms, scored)
    best = _attached(scored, channel(scored, total, rarity), rarity).select("a", "b")
    members = connected(best)
    called = members.join(forms.select(F.col("form").alias("node"), "n"), "node").groupBy("root").agg(F.min(F.struct((-F.col("n")).alias("n"), "node")).alias("top"))
    called = members.join(called, "root").select("node", F.col("top.node").alias("top"))
    return spelled.join(called, spelled.form == called.node, "left").select("name", F.coalesce("top", "form").alias("organisation"))


def spelling_pairs(names: DataFrame, name: str = "name") -> DataFrame:
    """(name_a, name_b), name_a < name_b: all pairs of spellings of one organisation."""
    members = written(organisations(names, name), "members")
    other = members.select("organisation", F.col("name").alias("name_b"))
    return members.select("organisation", F.col("name").alias("name_a")).join(other, "organisation").where("name_a < name_b").select("name_a", "name_b")
