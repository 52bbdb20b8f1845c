import random
from datetime import date, timedelta

from hypothesis import given, settings, strategies as st

from rosterflow.operators import intervals as iv


def brute(spans):
    """Periods and gaps by days."""
    days = sorted({d for lo, hi in spans for d in range(lo, hi + 1)})
    periods = []
    for d in days:
        if periods and periods[-1][1] == d - 1:
            periods[-1][1] = d
        else:
            periods.append([d, d])
    return [tuple(p) for p in periods], [(a[1] + 1, b[0] - 1) for a, b in zip(periods, periods[1:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 12)), max_size=25))
def test_map_against_days(spans):
    m, n = iv.IntervalMap(), 0
    for lo, length in spans:
        n += m.insert(lo, lo + length)
    periods, gaps = brute([(a, a + b) for a, b in spans])
    assert list(zip(m.lo, m.hi)) == periods and list(m.gaps()) == gaps and n == len(periods)


def test_table_with_a_hot_entity(spark, monkeypatch):
    monkeypatch.setattr(iv, "COMBINE", 50)
    rng, rows = random.Random(3), []
    for i in range(3000):
        who = "hot" if i % 3 == 0 else f"c{rng.randrange(300)}"
        lo = rng.randrange(4000)
        rows.append((who, lo, lo + rng.randrange(-2, 40)))
    rows += rows[:100] + [(None, 1, 2), ("n", None, 2), ("n", 1, None)]
    df = spark.createDataFrame(rows, "entity string, lo int, hi int").repartition(5)
    got = {}
    for r in iv.merge_intervals(df).collect():
        got.setdefault(r.entity, {"period": [], "gap": []})[r.kind].append((r.lo, r.hi))
    by = {}
    for who, lo, hi in rows:
        if None not in (who, lo, hi) and hi >= lo:
            by.setdefault(who, []).append((lo, hi))
    assert set(got) == set(by)
    for who, spans in by.items():
        periods, gaps = brute(spans)
        assert sorted(got[who]["period"]) == periods and sorted(got[who]["gap"]) == gaps


def test_dates(spark):
    d = date(2020, 1, 1)
    rows = [("a", d, d + timedelta(9), None), ("a", d + timedelta(10), d + timedelta(12), False), ("a", d + timedelta(20), None, True), ("a", d + timedelta(25), d, True), ("a", None, d, True), ("b", d, None, False), ("b", d, d - timedelta(1), None), (None, d, d, None)]
    df = spark.createDataFrame([(*r, "x", 1, "k") for r in rows], "c string, s date, e date, now boolean, entity string, lo int, kind string")
    got = sorted(tuple(r) for r in iv.continuous_periods(df, "c", "s", "e", "now").collect())
    assert got == [("a", "gap", "2020-01-14", "2020-01-20"), ("a", "period", "2020-01-01", "2020-01-13"), ("a", "period", "2020-01-21", "open")]
    assert iv.continuous_periods(df.limit(0), "c", "s", "e", "now").count() == 0


def test_stream_gives_the_same(spark, tmp_path):
    from rosterflow.streaming.ingest import merged_intervals

    rng = random.Random(5)
    rows = [(f"c{rng.randrange(20)}", lo := rng.randrange(300), lo + rng.randrange(9)) for _ in range(400)]
    df = spark.createDataFrame(rows, "who string, lo long, hi long")
    for i in range(3):
        df.where(f"lo % 3 = {i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    seen = {}

    def keep(batch, n):
        part = {}
        for r in batch.collect():
            part.setdefault(r.who, []).append((r.lo, r.hi))
        seen.update(part)

    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = merged_intervals(src, "who", "lo", "hi").writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    by = {}
    for who, lo, hi in rows:
        by.setdefault(who, []).append((lo, hi))
    assert {w: sorted(x) for w, x in seen.items()} == {w: brute(x)[0] for w, x in by.items()}
