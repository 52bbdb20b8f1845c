"""Connected components of an edge list by alternating large-star and small-star steps.

Each step is one partial aggregation (the least neighbour) and one join; no component, link list or
label map ever reaches the driver. Between rounds the edges are written to the shared folder, and those of the round
before are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.runtime import discard, written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (a, b) with a > b: every neighbour is hung on the least one."""
    both = edges.union(edges.select(F.col("b"), F.col("a"))) if large else edges
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, both.a == least.u)
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    hung = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def connected(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) from undirected edges (a, b); root is the least node of the component.

    Rows with a null end and self-links are ignored; repeated edges change nothing; nodes without a
    link to another node aren't returned. Every node but the root has a row, the root too.
    """
    now = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    now = written(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = mark(now)
    for _ in range(max_rounds):
        last, now = now, written(_stars(_stars(now, True), False), "edges")
        discard(last)
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.union(members.select("root", "root").distinct())
