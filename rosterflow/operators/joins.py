"""Joins that stay balanced: key lookups with nulls spread, disjunctions as unions of equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, key: str, table: DataFrame, table_key: str, row: str) -> DataFrame:
    """Left join of ``df`` to a table that is unique in its key.

    Rows whose key is null can't match; their join key is made of ``row`` instead, so they are spread over
    all tasks and not sent to one. Keys with very many rows are split by AQE, as the other side is unique.
    """
    spread = F.coalesce(F.concat(F.lit("k"), F.col(key)), F.concat(F.lit("n"), F.xxhash64(row).cast("string")))
    right = table.where(F.col(table_key).isNotNull()).withColumn("_k", F.concat(F.lit("k"), F.col(table_key))).drop(table_key)
    return df.withColumn("_k", spread).join(right, "_k", "left").drop("_k")


def any_key(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], left_id: str, right_id: str) -> DataFrame:
    """(left_id, right_id) of all rows that share any of ``keys``; one equi-join for each key, not a nested loop."""
    out = None
    for a, b in keys:
        got = left.where(F.col(a).isNotNull()).select(left_id, F.col(a).alias("_k")).join(right.where(F.col(b).isNotNull()).select(right_id, F.col(b).alias("_k")), "_k").select(left_id, right_id)
        out = got if out is None else out.union(got)
    return out.distinct()


def winners(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows that are the first by ``order`` for each of their keys, so that every key is unique among them.

    All keys are ranked by one aggregation over (kind, key); no window holds a key's rows together.
    """
    pairs = F.inline(F.filter(F.array(*[F.struct(F.lit(k).alias("_kind"), F.col(k).alias("_key")) for k in keys]), lambda x: x["_key"].isNotNull()))
    held = df.select(F.col(order).alias("_at"), pairs)
    first = held.groupBy("_kind", "_key").agg(F.min("_at").alias("_first"))
    beaten = held.join(first, ["_kind", "_key"]).where("_at <> _first").select("_at").distinct()
    return df.join(beaten, F.col(order) == F.col("_at"), "left_anti")
