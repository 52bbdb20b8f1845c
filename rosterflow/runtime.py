"""Session helpers shared by every operator: the shared folder, cut lineage, package shipping."""

from __future__ import annotations

import atexit
import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where it is unset (tests on one machine) a folder of our own is made and set.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = Path(tempfile.mkdtemp(prefix="rosterflow-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", at)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends there.

    Unlike local checkpoints the files outlive executors. They are removed at exit or by ``release``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/rosterflow/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session has ended; nothing can be reached any more
        pass


def discard(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing reads any more, neither itself nor a DataFrame made from it."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        for spark, at in [w for w in _written if path.endswith(w[1].rsplit("/", 1)[1])]:
            _written.remove((spark, at))
            _delete(spark, at)


def release() -> None:
    """Delete every table made by ``written`` so far; their DataFrames can't be read any more."""
    while _written:
        _delete(*_written.pop())


atexit.register(release)


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the workers once per application, wherever it was imported from."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    at = os.path.join(tempfile.mkdtemp(), "rosterflow_modules.zip")
    Path(at).write_bytes(data.getvalue())
    sc.addPyFile(at)  # the driver serves it to every executor, also to those that come later


def width(spark: SparkSession) -> int:
    """Number of shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
