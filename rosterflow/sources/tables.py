"""Readers: parquet tables of a folder, missing columns, keyset slices, manifests, inline rows."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def project(df: DataFrame, wanted: Mapping[str, str | tuple[str, Sequence[str]]]) -> DataFrame:
    """Project ``df`` to ``wanted``: name -> type, or name -> (type, names to try in order).

    A column that ``df`` lacks becomes a typed null; of several names the first that exists is taken.
    """
    have = set(df.columns)
    out = []
    for name, spec in wanted.items():
        kind, tries = (spec, [name]) if isinstance(spec, str) else spec
        found = next((t for t in tries if t in have), None)
        out.append((F.col(f"`{found}`") if found else F.lit(None)).cast(kind).alias(name))
    return df.select(*out)


def keyset_page(df: DataFrame, keys: Sequence[str], after: Sequence | None, size: int) -> DataFrame:
    """The next ``size`` rows after the key ``after`` in order of ``keys`` (planned as a top-k)."""
    if after is not None:
        df = df.where(F.struct(*[F.col(k) for k in keys]) > F.struct(*[F.lit(a).cast(df.schema[k].dataType).alias(k) for k, a in zip(keys, after)]))
    return df.orderBy(*keys).limit(size)


def by_manifest(df: DataFrame, manifest: DataFrame, key: str, ordinal: str = "ordinality") -> DataFrame:
    """Rows of ``df`` that ``manifest`` (key, ordinal) names, in its order. An id named twice comes twice."""
    return manifest.join(df, key, "inner").orderBy(ordinal)


def by_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in ``ids``; the planner picks the join strategy by size."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def from_json_array(df: DataFrame, col: str, schema: str) -> DataFrame:
    """One row per element of the JSON array in ``col``, typed by ``schema`` (a DDL struct)."""
    return df.select(F.inline(F.from_json(F.col(col), f"array<struct<{schema}>>")))


def shard(df: DataFrame, key: Column, count: int, index: int) -> DataFrame:
    """Rows of one of ``count`` stable shards by ``key``; null keys belong to shard 0."""
    return df.where(F.coalesce(F.pmod(F.xxhash64(key), F.lit(count)), F.lit(0)) == index) if count > 1 else df


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``df``, or ValueError naming the columns it lacks."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def candidate_map(spark: SparkSession, path: str) -> DataFrame:
    """A candidate map artifact: a JSON object keyed by source id -> one row per id."""
    schema = "map<string,struct<match_action:string,match_basis:string,resolved_candidate_id:string,candidate_skip_reason:string>>"
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("m"))
    return raw.select(F.explode("m").alias("source_candidate_id", "entry")).select("source_candidate_id", "entry.*")


def write_candidate_map(rows: DataFrame, path: str) -> None:
    """Write resolved candidates (source id, action, basis, resolved id, skip reason) as parquet."""
    require(rows, ["source_candidate_id", "match_action", "match_basis", "resolved_candidate_id", "candidate_skip_reason"]).write.mode("overwrite").parquet(path)


def write_report(rows: DataFrame, path: str) -> None:
    """A small aggregated report as one JSON file on the driver; refuses more than 10,000 rows."""
    got = rows.limit(10_001).collect()
    if len(got) > 10_000:
        raise ValueError("a report holds aggregates; this one has over 10,000 rows")
    with open(path, "w") as f:
        json.dump([r.asDict(recursive=True) for r in got], f, default=str, indent=1)
