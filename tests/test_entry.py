import importlib

import pytest

import __spark_entry__ as entry
from conftest import compare
from rosterflow.plans import entities, functions, problems, retrieval, upkeep

D = "/root/testdata/sf0.001"
CORE = {k: f for part in (problems, functions, entities, retrieval, upkeep) for k, f in part.QUERIES.items()}


SQL = {k: s for part in (problems, functions, entities, retrieval, upkeep) for k, s in part.SQL.items()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    got, want = compare(spark, CORE[name], SQL[name], D)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(CORE) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert CORE[name](spark, D).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_needs_no_subpackage():
    importlib.reload(importlib.import_module("rosterflow.plans.problems"))


def test_resumed_ingest_finds_nothing_new(spark, tmp_path):
    from rosterflow.streaming import ingest

    df = spark.range(100).selectExpr("id % 60 as k", "id as v")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    args = (spark, str(tmp_path / "in"), "k long, v long", "k", str(tmp_path / "out"), str(tmp_path / "state"))
    ingest.ingest(*args)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60
    ingest.ingest(*args)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60
    more = spark.range(100).selectExpr("id as k", "id as v")
    more.repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
    ingest.ingest(*args)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100
    ingest.guard(spark, str(tmp_path / "g"), {"shards": 2})
    ingest.guard(spark, str(tmp_path / "g"), {"shards": 2})
    with pytest.raises(ValueError):
        ingest.guard(spark, str(tmp_path / "g"), {"shards": 3})


def test_checkpoint(spark, tmp_path):
    from rosterflow.sources.tables import keyset_page
    from rosterflow.streaming.checkpoint import Checkpoint, run_batches

    df = spark.range(10).toDF("id")
    at = str(tmp_path / "job.json")
    seen: list[int] = []

    def pages(cursor):
        while rows := keyset_page(df, ["id"], None if cursor is None else (cursor,), 4).collect():
            cursor = rows[-1].id
            yield cursor, df.where(f"id > {cursor - 4} and id <= {cursor}")

    def apply(number, rows, stop=None):
        if number == stop:
            raise KeyError("lost")
        seen.extend(r.id for r in rows.collect())
        return {"rows": rows.count()}

    with pytest.raises(KeyError):
        run_batches(Checkpoint(spark, at), pages, lambda n, r: apply(n, r, 1))
    state = run_batches(Checkpoint(spark, at), pages, apply)
    assert sorted(set(seen)) == list(range(10)) and state["attempts"] == 2 and state["batches"] == 3
    assert run_batches(Checkpoint(spark, at), pages, apply) == state
    assert run_batches(Checkpoint(spark, at), pages, apply, force=True)["attempts"] == 3
