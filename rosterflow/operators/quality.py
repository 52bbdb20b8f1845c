"""Data-quality checks: rows that come out are findings; no rows mean all is well."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Keys of ``child`` that ``parent`` lacks, with their rows; null keys are no orphans."""
    keys = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti").groupBy(child_key).agg(F.count("*").alias("n"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def out_of_vocabulary(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*allowed)).groupBy(column).agg(F.count("*").alias("n"))


def schema_diff(spark: SparkSession, df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Columns that are missing, extra or of another type."""
    have = dict(df.dtypes)
    rows = [(n, expected.get(n), have.get(n)) for n in sorted({*expected, *have}) if expected.get(n) != have.get(n)]
    return spark.createDataFrame(rows, "column_name string, expected string, actual string")


def diff(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys whose rows differ between two read paths, and how: added, removed or changed."""
    a = old.select(F.col(key), F.struct(*columns).alias("_a"))
    b = new.select(F.col(key), F.struct(*columns).alias("_b"))
    how = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return a.join(b, key, "full").select(key, how.alias("change")).where("change is not null")


def missing_columns(spark: SparkSession, frames: Mapping[str, DataFrame], wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Columns that tables should have and lack."""
    rows = [(t, x, "missing") for t, cols in wanted.items() for x in cols if x not in frames[t].columns]
    return spark.createDataFrame(rows, "table_name string, column_name string, finding string")


def vector_columns(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of tables that hold lists of numbers, as vectors do."""
    rows = [(t, x, "vector") for t, df in frames.items() for x, kind in df.dtypes if kind in ("array<float>", "array<double>")]
    return spark.createDataFrame(rows, "table_name string, column_name string, finding string")
