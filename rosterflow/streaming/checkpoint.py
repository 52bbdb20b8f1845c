"""Checkpoints of batch jobs as small JSON documents on a shared store, replaced as a whole."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def read_json(spark: SparkSession, path: str) -> dict | None:
    """The document at ``path``, None if there is none."""
    fs, at = _files(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, document: dict) -> None:
    """Replace the document: written beside it and made durable, then renamed onto it."""
    fs, at = _files(spark, path)
    beside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(json.dumps(document, sort_keys=True).encode()))
        stream.hsync()
    finally:
        stream.close()
    if fs.exists(at):
        fs.delete(at, False)
    fs.rename(beside, at)


class Checkpoint:
    """State of one batch job: ``begin``, ``record`` after each durable batch, ``complete``.

    A job that is completed begins no more unless forced, which starts over but keeps the number of attempts. Counters add up
    over batches; a batch that was recorded already is not counted again.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.state = read_json(spark, path) or {"status": "new", "attempts": 0, "batches": 0, "cursor": None, "counters": {}}

    def _save(self) -> None:
        write_json(self.spark, self.path, self.state)

    def begin(self, force: bool = False) -> bool:
        """Whether there is something to do."""
        if self.state["status"] == "completed" and not force:
            return False
        if force:
            self.state.update(batches=0, cursor=None, counters={})
        self.state.update(status="running", attempts=self.state["attempts"] + 1)
        self._save()
        return True

    def record(self, number: int, cursor, counters: dict[str, int]) -> None:
        if number < self.state["batches"]:
            return
        held = self.state["counters"]
        self.state.update(batches=number + 1, cursor=cursor, counters={k: held.get(k, 0) + counters.get(k, 0) for k in {*held, *counters}})
        self._save()

    def complete(self) -> None:
        self.state["status"] = "completed"
        self._save()


def run_batches(checkpoint: Checkpoint, pages: Callable[[object], Iterable[tuple[object, DataFrame]]], apply: Callable[[int, DataFrame], dict[str, int]], force: bool = False) -> dict:
    """The skeleton of a batch job: pages after the cursor are applied one by one, each recorded once it is durable.

    ``pages`` gives (cursor, rows) after a cursor; ``apply`` writes the rows of a batch so that a repetition changes nothing.
    """
    if checkpoint.begin(force):
        for cursor, rows in pages(checkpoint.state["cursor"]):
            number = checkpoint.state["batches"]
            checkpoint.record(number, cursor, apply(number, rows))
        checkpoint.complete()
    return checkpoint.state
