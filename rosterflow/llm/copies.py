"""Duplicates hidden by formatting: recursive radix partitioning of canonical bytes, counting tries.

1. A record's field becomes canonical bytes (for addresses: ``mail_address``), written once.
2. Radix partitioning: buckets are byte prefixes. A bucket with more than LIMIT records is split by further bytes, past
   the prefix that all its values share, and so on until each fits, whatever the size of the table. Only records
   of oversized buckets are read again; the list of those buckets is a table, too, and never on the driver.
3. A single value with more records than fit in a bucket can't be split by bytes; its records are spread by
   a hash of the record id and the partial counters are added up.
4. Every bucket is read into a trie whose terminal counters hold the number of records of a value and the least id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.runtime import ship, width, written

LIMIT = 50_000  # records that fit in a bucket
STEP = 2  # bytes by which a bucket is split
STRIDE = 4  # bytes between two nodes of a trie

# Characters of full width and their plain forms, made by rule.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　｡。"
_PLAIN = "".join(chr(c) for c in range(0x21, 0x7F)) + " .."
_INVISIBLE = r"[\p{Cf}\x{034F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{3164}\x{FFA0}\x{FE00}-\x{FE0F}\x00-\x08\x0E-\x1B\x7F-\x84\x86-\x9F]+"
_SPACE = r"[\s\x1C-\x1F\x85\p{Z}]+"
_LABEL = r"[\p{L}\p{N}](?:[\p{L}\p{N}-]*[\p{L}\p{N}])?"
_ADDRESS = rf"[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}._%+\p{{Mn}}-]*@{_LABEL}(?: ?\. ?{_LABEL})*(?: ?\. ?\p{{L}}[\p{{L}}\p{{N}}-]*[\p{{L}}\p{{N}}])"


def mail_address(raw: Column) -> Column:
    """The first complete mail address in a freely written field, in canonical form, else null.

    Case, width, white space and invisible characters are folded; what stands around the address
    (labels, ``mailto:``, a query, names, brackets, marks) is no part of it.
    """
    text = F.translate(raw, _WIDE, _PLAIN)
    text = F.regexp_replace(F.regexp_replace(text, _INVISIBLE, ""), _SPACE, " ")
    text = F.regexp_replace(F.lower(text), " ?@ ?", "@")
    found = F.regexp_extract(text, _ADDRESS, 0)
    return F.nullif(F.replace(found, F.lit(" "), F.lit("")), F.lit(""))


class Trie:
    """Counts byte strings; a node is a dict from the next STRIDE bytes to a node, None to its counter (the ids, each once)."""

    def __init__(self) -> None:
        self.root: dict = {}

    def counter(self, key: bytes) -> set:
        node = self.root
        for i in range(0, len(key), STRIDE):
            part = key[i : i + STRIDE]
            below = node.get(part)
            if below is None:
                below = node[part] = {}
            node = below
        if None not in node:
            node[None] = set()
        return node[None]

    def terminals(self) -> Iterator[tuple[bytes, set]]:
        stack = [(b"", self.root)]
        while stack:
            key, node = stack.pop()
            for part, below in node.items():
                if part is None:
                    yield key, below
                else:
                    stack.append((key + part, below))


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, set, bool, str | None]]:
    """Terminals of one trie after another: value, ids, whether it is spread over several, its least id if so."""
    now, trie, first = None, Trie(), None
    for batch in batches:
        for bucket, salt, value, i, least in zip(*(c.to_pylist() for c in batch.columns)):
            if (bucket, salt) != now:
                for key, ids in trie.terminals():
                    yield key, ids, first is not None, first
                now, trie, first = (bucket, salt), Trie(), least
            trie.counter(value).add(i)
    for key, ids in trie.terminals():
        yield key, ids, first is not None, first


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cols: tuple[list, list, list] = ([], [], [])

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())], ["value", "id", "kept_id"])
        for x in cols:
            x.clear()
        return out

    for value, ids, _, first in _tries(batches):
        kept = first if first is not None else min(ids)
        cols[0].extend([value] * len(ids))
        cols[1].extend(ids)
        cols[2].extend([kept] * len(ids))
        if len(cols[0]) >= 20_000:
            yield flush()
    yield flush()


def _counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []

    def flush() -> pa.RecordBatch:
        part = list(zip(*rows)) or [(), (), (), ()]
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(part, (pa.binary(), pa.string(), pa.int64(), pa.bool_()))], ["value", "kept_id", "n_records", "spread"])

    for value, ids, spread, first in _tries(batches):
        rows.append((value, first if spread else min(ids), len(ids), spread))
        if len(rows) >= 20_000:
            yield flush()
    yield flush()


_SHARED = "aggregate(sequence(0, least(length(lo), length(hi))), 0, (n, i) -> if(n = i - 1 and substring(lo, i, 1) = substring(hi, i, 1), i, n))"


def _buckets(records: DataFrame, limit: int) -> DataFrame:
    """(bucket, salt, value, id, first), each (bucket, salt) in one task and sorted; ``first`` is the least id of a spread value."""
    spark = records.sparkSession
    ship(spark)
    # written before nulls are left out, as a filter on the value would compute it twice
    now = written(records.select("id", "value"), "canonical").where("id is not null and value is not null").withColumn("bucket", F.substring("value", 1, 0))
    fit = None
    while True:
        seen = now.groupBy("bucket").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.min("id").alias("first")).where(F.col("n") > limit)
        one = F.col("lo") == F.col("hi")
        # where a bucket goes on: past its shared prefix, or, if it holds one value, spread over so many parts
        over = written(seen.select("bucket", F.when(~one, F.expr(_SHARED) + STEP).alias("upto"), F.when(one, F.ceil(F.col("n") / limit)).alias("salts"), F.when(one, F.col("first")).alias("first")), "oversized")
        marked = now.join(over, "bucket", "left")
        salt = F.coalesce(F.pmod(F.xxhash64("id"), "salts"), F.lit(0)).cast("int").alias("salt")
        part = marked.where("upto is null").select("bucket", salt, "value", "id", "first")
        fit = part if fit is None else fit.unionByName(part)
        if over.where("upto is not null").isEmpty():
            return fit.repartition(width(spark), "bucket", "salt").sortWithinPartitions("bucket", "salt")
        now = written(marked.where("upto is not null").select("id", "value", F.expr("substring(value, 1, upto)").alias("bucket")), "split")


def collapse(records: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(value, id, kept_id) for records (id string, value binary): kept_id is the least id of the value.

    Records with a null id or value count for nothing; a record that comes twice counts once; an empty
    table gives an empty result. Values of any length and any number of copies are whole.
    """
    return _buckets(records, limit).mapInArrow(_members, "value binary, id string, kept_id string")


def counted(records: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(value, kept_id, n_records): one row for each value with the counter of its records; see ``collapse``."""
    got = _buckets(records, limit).mapInArrow(_counters, "value binary, kept_id string, n_records bigint, spread boolean")
    got = written(got, "counters")
    # partial counters exist of spread values only
    whole = got.where("spread").groupBy("value").agg(F.min("kept_id").alias("kept_id"), F.sum("n_records").alias("n_records"))
    return got.where("not spread").drop("spread").unionByName(whole)
