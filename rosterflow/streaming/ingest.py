"""Resumable ingestion: files are read as a stream, keys seen before are left out."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.operators.intervals import IntervalMap
from rosterflow.runtime import ship
from rosterflow.streaming.checkpoint import read_json, write_json


def guard(spark: SparkSession, folder: str, settings: dict) -> None:
    """Refuse to resume with other settings than those the output was begun with. ``folder`` may be on any shared store."""
    at = f"{folder}/settings.json"
    held = read_json(spark, at)
    if held is None:
        write_json(spark, at, settings)
    elif held != settings:
        raise ValueError("the output was begun with other settings")


def ingest(spark: SparkSession, source: str, schema: str, key: str, target: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, files_per_batch: int = 1) -> None:
    """Take in all files of ``source`` not taken in yet, then stop.

    State advances only after a batch is durable. A batch that is run again writes to the same path
    (``batch=N``), so a replay changes nothing. Keys seen before are held in the stream's own state, by key over all
    tasks, so a batch costs what it brings and not what is there already. Of rows with one key any one is taken.
    """

    def write(batch: DataFrame, n: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(f"{target}/batch={n}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source).dropDuplicates([key])
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_counts(events: DataFrame, time: str, kind: str, length: str = "7 days", late: str = "1 day") -> DataFrame:
    """Events by kind and window with a watermark; the same plan over a table or a stream."""
    return events.withWatermark(time, late).groupBy(F.window(time, length), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("week"), kind, "n")


def latest_by_key(stream: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """Last value of each key so far; in update mode the state holds one row a key."""
    return stream.groupBy(key).agg(F.max_by(value, time).alias(value), F.max(time).alias(time))


def merged_intervals(stream: DataFrame, entity: str, lo: str, hi: str) -> DataFrame:
    """Continuous periods of each entity so far, from a stream of day intervals (integers).

    Keyed state holds the entity's interval map; every batch inserts its rows and emits the periods.
    """
    ship(stream.sparkSession)

    def step(key, batches, state):
        m = IntervalMap()
        if state.exists:
            m.lo, m.hi = (list(x) for x in state.get)
        for pdf in batches:
            for a, b in zip(pdf[lo].tolist(), pdf[hi].tolist()):
                m.insert(int(a), int(b))
        state.update((m.lo, m.hi))
        yield pd.DataFrame({entity: [key[0]] * len(m.lo), "lo": m.lo, "hi": m.hi})

    kind = stream.schema[entity].dataType.simpleString()
    return stream.groupBy(entity).applyInPandasWithState(step, f"{entity} {kind}, lo bigint, hi bigint", "lo array<bigint>, hi array<bigint>", "update", "NoTimeout")
