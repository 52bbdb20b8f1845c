"""Encoding of whole texts with a public tokenizer by overlapping chunks.

A long text is cut into overlapping chunks, each pre-tokenised on its own from an arbitrary start. The
pre-tokeniser looks ahead only, so from a position on which two passes agree they stay in step: a chunk is
stitched to the next at the first boundary both have within the overlap. A stitch never follows white space, for whose tokens
the end of a text would matter. The pieces between the stitches are then encoded one by one. Ids of piece after piece are
those of the whole text; decoding concatenates the raw bytes of the ids.

Texts of more than ROWS characters become rows: one for each chunk, pre-tokenised by whatever task gets it, then one for each
piece, so that one text keeps many tasks busy; where two chunks have no common boundary, what follows is one piece. In shorter
texts chunks are handled one after another within a task (``pieces``), and where there is no boundary a chunk is joined with the next.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.runtime import ship, width, written

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokeniser's pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNK, OVERLAP = 4_096, 256  # characters
ROWS = 262_144  # characters from which chunks are rows
BATCH = 256  # texts encoded before their ids are sent on

_token = regex.compile(PATTERN)
_space = regex.compile(r"[\s\x1c-\x1f\x85\p{Cn}]")


def pieces(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[str]:
    """Parts of ``text`` that can be encoded apart: all cuts are pre-token boundaries of the whole."""
    n, start = len(text), 0
    while n - start > chunk + overlap:
        own = (m.end() for m in _token.finditer(text, start))  # the pass that is in step
        near, at, cut = start + chunk, start, None
        while cut is None and near + overlap < n:
            ends = set()
            while at <= near + overlap:
                if at > near:
                    ends.add(at)
                at = next(own)
            # the next chunk's pass starts at a character of no meaning; the first common end is the stitch
            for m in _token.finditer(text, near, near + 2 * overlap):
                if m.end() in ends and m.end() < near + 2 * overlap and not _space.match(text, m.end() - 1):
                    cut = m.end()
                    break
                if m.end() > near + overlap:
                    break
            near = max(near + chunk, at)
        if cut is None:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


@lru_cache(maxsize=4)
def _encoding(data: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str | None, encoding) -> list[int]:
    if not text:
        return []
    if "\ud800" <= max(text) and regex.search("[\ud800-\udfff]", text):
        text = text.encode("utf-8", "replace").decode()
    out: list[int] = []
    for p in pieces(text):
        out += encoding.encode_ordinary(p)
    return out


def boundaries(part: str, last: bool) -> tuple[list[int], list[int]]:
    """Ends of pre-tokens in a chunk with its overlap, pre-tokenised from its start: those within the first OVERLAP
    characters and those after CHUNK. What touches the end of a chunk that isn't the last is unknown."""
    ends = [m.end() for m in _token.finditer(part) if (last or m.end() < len(part)) and not _space.match(part, m.end() - 1)]
    return [e for e in ends if e <= OVERLAP], [e - CHUNK for e in ends if e > CHUNK]


def stitched(heads: list[list[int]], tails: list[list[int]]) -> list[int]:
    """Starts of the pieces of a text from the boundaries of its chunks; at the first pair without a common one the rest is one piece."""
    cuts = [0]
    for i in range(1, len(heads)):
        common = set(tails[i - 1]) & set(heads[i])
        if not common:
            break
        cuts.append(i * CHUNK + min(common))
    return cuts


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            starts = list(range(0, len(text), CHUNK))
            for lo in range(0, len(starts), BATCH):
                some = starts[lo : lo + BATCH]
                yield pa.RecordBatch.from_arrays([pa.array([uid] * len(some)), pa.array([s // CHUNK for s in some], pa.int32()), pa.array([s == starts[-1] for s in some]), pa.array([text[s : s + CHUNK + OVERLAP + 1] for s in some], pa.string())], ["uid", "i", "last", "part"])


def _bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [boundaries(part, last) for last, part in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([h for h, _ in got], pa.list_(pa.int32())), pa.array([t for _, t in got], pa.list_(pa.int32()))], ["uid", "i", "head", "tail"])


def _piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uid, text, chunks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            cuts = [*stitched([c["head"] for c in chunks], [c["tail"] for c in chunks]), len(text)]
            for lo in range(0, len(cuts) - 1, BATCH):
                some = range(lo, min(lo + BATCH, len(cuts) - 1))
                yield pa.RecordBatch.from_arrays([pa.array([uid] * len(some)), pa.array(list(some), pa.int32()), pa.array([text[cuts[n] : cuts[n + 1]] for n in some], pa.string())], ["uid", "i", "piece"])


def encode_texts(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY, count_only: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """key and ids (array<int>), or n_tokens (bigint), of every row's whole ``text``.

    No special tokens; their strings are ordinary text. Null and empty texts have an empty list (0 tokens).
    Repeated rows stay; other columns but those in ``carry`` are not read. No shuffle but of texts over ROWS characters, which
    are looked for first. The vocabulary (under 1 MB) is read on the driver and sent with the tasks, so executors need no copy of the file.
    """
    spark = df.sparkSession
    ship(spark)
    with open(vocabulary, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(data.value)
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), BATCH):
                batch = whole.slice(at, BATCH)
                ids = [encode(t, encoding) for t in batch.column(batch.num_columns - 1).to_pylist()]
                last = pa.array([len(x) for x in ids], pa.int64()) if count_only else pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], last], [*batch.schema.names[:-1], "n_tokens" if count_only else "ids"])

    kept = [key, *carry]
    out, kind = ("n_tokens", "bigint") if count_only else ("ids", "array<int>")
    rows = df.select(*[F.col(f"`{k}`") for k in kept], F.col(f"`{text}`").cast("string").alias("text_to_encode"))
    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in kept) + f", {out} {kind}"
    long = F.length("text_to_encode") > ROWS
    short = rows.where(~F.coalesce(long, F.lit(False))).mapInArrow(run, schema)
    if rows.where(long).isEmpty():
        return short
    texts = written(rows.where(long).withColumn("uid", F.uuid()), "long_texts")
    n = width(spark)
    chunks = texts.select("uid", "text_to_encode").mapInArrow(_chunk_rows, "uid string, i int, last boolean, part string").repartition(n, "uid", "i")
    bounds = chunks.mapInArrow(_bound, "uid string, i int, head array<int>, tail array<int>").groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("i", "head", "tail"))).alias("chunks"))
    pieces_ = texts.select("uid", "text_to_encode").join(bounds, "uid").mapInArrow(_piece_rows, "uid string, i int, piece string").repartition(n, "uid", "i")
    coded = pieces_.mapInArrow(run, f"uid string, i int, {out} {kind}").groupBy("uid")
    coded = coded.agg(F.sum(out).alias(out)) if count_only else coded.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("i", out))), lambda x: x[out])).alias(out))
    return short.unionByName(texts.drop("text_to_encode").join(coded, "uid").select(*[F.col(f"`{k}`") for k in kept], out))


def decode_ids(ids: list[int], vocabulary: str = VOCABULARY) -> bytes:
    """Raw bytes of a list of ids."""
    with open(vocabulary, "rb") as f:
        return _encoding(f.read()).decode_bytes(ids)
