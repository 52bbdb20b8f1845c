"""Vector retrieval, keyword funnels, feedback and ensemble ranking over chunks and candidates."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.runtime import ship, written

c = F.col
# Job to reference weights by number of references.
WEIGHTS = ((0, 1.0, 0.0), (1, 0.6, 0.4), (3, 0.4, 0.6), (None, 0.25, 0.75))
# Defaults of ours: how much evidence of a source counts.
SOURCE_WEIGHTS = {"linkedin_profile": 1.0, "resume": 1.1, "recruiter_note_raw": 0.8, "recruiter_note_summary": 1.05, "transcript_summary": 1.0, "manual_profile_note": 0.9}
QUERY_BLOCK = 4_096  # query vectors that go along with every task


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays inside the JVM; for few pairs. Zero vectors have none."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def scores(queries: DataFrame, vectors: DataFrame, query_id: str, vector_id: str, vector: str, threshold: float, k: int | None) -> DataFrame:
    """(query_id, vector_id, score) of all vectors at or above ``threshold``, best ``k`` a query.

    The queries are a stated set: they are read in blocks of at most QUERY_BLOCK vectors that go along with the
    tasks, and every vector is compared with each; a task keeps its own best k, so little is shuffled. Ties go to
    the smaller id. Null vectors and vectors of norm 0 have no score.
    """
    spark = vectors.sparkSession
    ship(spark)
    wanted = queries.select(query_id, vector).where(c(vector).isNotNull()).orderBy(query_id)
    kinds = f"query_id {queries.schema[query_id].dataType.simpleString()}, vector_id {vectors.schema[vector_id].dataType.simpleString()}, score double"
    rows = vectors.select(c(vector_id).alias("i"), c(vector).alias("v")).where("v is not null")
    out, held = None, []

    def part(block: list) -> DataFrame:
        ids = [r[0] for r in block]
        q = np.array([r[1] for r in block], np.float64)
        sent = spark.sparkContext.broadcast((ids, q / np.linalg.norm(q, axis=1, keepdims=True)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, unit = sent.value
            for batch in batches:
                v = np.array(batch.column(1).to_pylist(), np.float64)
                if not len(v):
                    continue
                with np.errstate(all="ignore"):
                    s = (v / np.linalg.norm(v, axis=1, keepdims=True)) @ unit.T
                at, of = np.nonzero(np.round(s, 9) >= threshold)
                if k is not None and len(at) > k * len(names):
                    order = np.lexsort((at, -s[at, of], of))
                    rank = np.arange(len(order)) - np.searchsorted(of[order], of[order])
                    # equal scores at the edge stay, so that the final order decides among them
                    edge = s[at, of][order][np.minimum(np.searchsorted(of[order], of[order]) + k - 1, len(order) - 1)]
                    keep = order[(rank < k) | (s[at, of][order] >= edge)]
                    at, of = at[keep], of[keep]
                yield pa.RecordBatch.from_arrays([pa.array([names[j] for j in of]), batch.column(0).take(pa.array(at)), pa.array(s[at, of])], ["query_id", "vector_id", "score"])

        return rows.mapInArrow(run, kinds)

    for r in wanted.toLocalIterator():
        held.append((r[0], r[1]))
        if len(held) == QUERY_BLOCK:
            out, held = part(held) if out is None else out.union(part(held)), []
    if held or out is None:
        if not held:
            return spark.createDataFrame([], kinds)
        out = part(held) if out is None else out.union(part(held))
    out = out.withColumn("score", F.round("score", 6))
    if k is None:
        return out
    w = Window.partitionBy("query_id").orderBy(c("score").desc(), "vector_id")
    return out.withColumn("rank", F.row_number().over(w)).where(c("rank") <= k)


def collapse(hits: DataFrame, by: Sequence[str]) -> DataFrame:
    """Best evidence of each group: highest score, then smallest query and vector."""
    best = F.min(F.struct((-c("score")).alias("s"), "query_id", "vector_id")).alias("best")
    return hits.groupBy(*by).agg(best, F.count("*").alias("n_hits")).select(*by, (-c("best.s")).alias("score"), c("best.query_id").alias("best_query"), c("best.vector_id").alias("best_vector"), "n_hits")


def funnel(texts: DataFrame, key: str, text: str, required: Sequence[str], main: Sequence[str], broad: Sequence[str], enough: int) -> DataFrame:
    """Level of each text: 1 all required words, 2 any main one, 3 any broad one; wider levels only while there is
    less than ``enough``. With the words found and the share of required words."""
    lists = {"required": required, "main": main, "broad": broad}
    wanted = "|".join(re.escape(x) for x in sorted({*required, *main, *broad}, key=lambda x: (-len(x), x)))
    edge = r"[\p{L}\p{N}+#]"
    words = F.array_distinct(F.regexp_extract_all(F.lower(c(text)), F.lit(f"(?<!{edge})(?:{wanted})(?!{edge})"), F.lit(0)))
    got = texts.where(c(text).isNotNull()).select(c(key).alias("key"), words.alias("w")).where("size(w) > 0")
    got = got.select("key", *[F.array_sort(F.array_intersect("w", F.array(*[F.lit(x) for x in v]))).alias(n) for n, v in lists.items()])
    level = F.when(F.size("required") == len(required), 1).when(F.size("main") > 0, 2).when(F.size("broad") > 0, 3)
    got = written(got.withColumn("level", level).where("level is not null"), "funnel")  # texts are read once
    seen = got.groupBy("level").agg(F.count("*").alias("n"))
    # three rows at most
    before = F.broadcast(seen.alias("a").join(seen.alias("b"), c("b.level") < c("a.level"), "left").groupBy(c("a.level").alias("level")).agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before")))
    kept = got.join(before, "level").where(c("before") < enough)
    return kept.select("key", "level", F.array_join(F.array_sort(F.array_distinct(F.concat("required", "main", "broad"))), "|").alias("evidence"), F.round(F.size("required") / F.lit(max(1, len(required))), 6).alias("coverage"))


def weight(n_references: Column, side: int) -> Column:
    """Weight of the job's (1) or the references' (2) score for a number of references."""
    out = F.lit(WEIGHTS[-1][side])
    for upto, *w in reversed(WEIGHTS[:-1]):
        out = F.when(n_references <= upto, F.lit(w[side - 1])).otherwise(out)
    return out


def ensemble(pool: DataFrame, n_references: Column) -> DataFrame:
    """Final score of candidates with ``job_score``, ``reference_score`` and ``source_weight``; the job always counts."""
    zero = lambda x: F.coalesce(c(x), F.lit(0.0))
    score = (weight(n_references, 1) * zero("job_score") + weight(n_references, 2) * zero("reference_score")) * F.coalesce("source_weight", F.lit(1.0))
    return pool.withColumn("final_score", score)


def outcome(*tests: tuple[str, Column]) -> tuple[Column, Column]:
    """pass, fail or needs_screening of three-valued tests, and the names of the unknown ones."""
    fails = F.lit(False)
    for _, t in tests:
        fails = fails | F.coalesce(~t, F.lit(False))
    unknown = F.array_compact(F.array(*[F.when(t.isNull(), F.lit(n)) for n, t in tests]))
    return F.when(fails, "fail").when(F.size(unknown) > 0, "needs_screening").otherwise("pass"), F.array_join(unknown, "|")
