"""Overlapping and gapped intervals: an ordered map of disjoint intervals per entity in keyed state.

Days are integers. Each insertion finds the overlapped or touching neighbours by binary search,
replaces them by their union and so updates the gaps. The map is kept twice: in each input partition
as a combiner, then once per entity. An entity's map can't outgrow half the days of the calendar
in use, so an entity with a third of all rows sends a bounded number of intervals per partition.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.runtime import ship, width

OPEN = 2**31 - 1  # the last day of an interval without end
COMBINE = 200_000  # intervals that a combiner holds before it sends them on


class IntervalMap:
    """Disjoint intervals [lo, hi] in order, both ends included; touching ones are one."""

    __slots__ = ("lo", "hi")

    def __init__(self) -> None:
        self.lo: list[int] = []
        self.hi: list[int] = []

    def insert(self, lo: int, hi: int) -> int:
        """Add [lo, hi]; returns by how many the number of intervals changed."""
        a = bisect_left(self.hi, lo - 1)
        b = bisect_right(self.lo, hi + 1)
        if a < b:
            lo, hi = min(lo, self.lo[a]), max(hi, self.hi[b - 1])
        self.lo[a:b] = [lo]
        self.hi[a:b] = [hi]
        return 1 - (b - a)

    def gaps(self) -> Iterator[tuple[int, int]]:
        for hi, lo in zip(self.hi, self.lo[1:]):
            yield hi + 1, lo - 1


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state: dict[str, IntervalMap] = {}
    held = 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([k for k, m in state.items() for _ in m.lo], pa.string()),
            pa.array([x for m in state.values() for x in m.lo], pa.int32()),
            pa.array([x for m in state.values() for x in m.hi], pa.int32()),
        ], ["entity", "lo", "hi"])

    for batch in batches:
        for k, lo, hi in zip(*(c.to_pylist() for c in batch.columns)):
            m = state.get(k)
            if m is None:
                m = state[k] = IntervalMap()
            held += m.insert(lo, hi)
        if held > COMBINE:
            yield flush()
            state, held = {}, 0
    if state:
        yield flush()


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input is sorted by entity; the state of one entity is held at a time."""
    entities: list[str] = []
    kinds: list[str] = []
    los: list[int] = []
    his: list[int] = []

    def close(entity: str, m: IntervalMap) -> None:
        for lo, hi in zip(m.lo, m.hi):
            entities.append(entity)
            kinds.append("period")
            los.append(lo)
            his.append(hi)
        for lo, hi in m.gaps():
            entities.append(entity)
            kinds.append("gap")
            los.append(lo)
            his.append(hi)

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(entities, pa.string()), pa.array(kinds, pa.string()), pa.array(los, pa.int32()), pa.array(his, pa.int32())], ["entity", "kind", "lo", "hi"])
        for x in (entities, kinds, los, his):
            x.clear()
        return out

    now, m = None, IntervalMap()
    for batch in batches:
        for k, lo, hi in zip(*(c.to_pylist() for c in batch.columns)):
            if k != now:
                if now is not None:
                    close(now, m)
                now, m = k, IntervalMap()
            m.insert(lo, hi)
        if len(entities) >= 20_000:
            yield flush()
    if now is not None:
        close(now, m)
    yield flush()


def day(date: Column) -> Column:
    return F.unix_date(date.cast("date"))


def interval_days(df: DataFrame, entity: str, start: str, end: str, current: str) -> DataFrame:
    """entity, lo, hi of the rows that count: with a start, and current or with an end not before it."""
    c = lambda x: F.col(f"`{x}`")
    now = F.coalesce(c(current).cast("boolean"), F.lit(False))
    rows = df.select(c(entity).cast("string").alias("entity"), day(c(start)).alias("lo"), F.when(now, F.lit(OPEN)).otherwise(day(c(end))).alias("hi"))
    return rows.where("entity is not null and lo is not null and hi >= lo")


def merge_intervals(rows: DataFrame) -> DataFrame:
    """entity, kind (period or gap), lo, hi from rows (entity string, lo int, hi int).

    Rows with a null in any of the three or with hi < lo count for nothing; repeated rows change
    nothing; an empty table gives an empty result.
    """
    ship(rows.sparkSession)
    rows = rows.select("entity", "lo", "hi").where("entity is not null and lo is not null and hi >= lo")
    some = rows.mapInArrow(_combine, "entity string, lo int, hi int")
    sorted_ = some.repartition(width(rows.sparkSession), "entity").sortWithinPartitions("entity", "lo")
    return sorted_.mapInArrow(_finish, "entity string, kind string, lo int, hi int")


def continuous_periods(df: DataFrame, entity: str, start: str, end: str, current: str) -> DataFrame:
    """Periods of days without a free day, and the gaps between them, as yyyy-mm-dd strings.

    A row runs from start through end; with ``current`` true it has no end (end_date ``open``).
    """
    text = lambda x: F.date_from_unix_date(F.col(x)).cast("string")
    out = merge_intervals(interval_days(df, entity, start, end, current))
    return out.select(F.col("entity").alias(entity), "kind", text("lo").alias("start_date"), F.when(F.col("hi") == OPEN, F.lit("open")).otherwise(text("hi")).alias("end_date"))
