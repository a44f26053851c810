"""Stages written once to the folder that all executors share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_base(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session (tests) gets a temporary one; on a
    cluster that is an error, because other machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortwise-llm-"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"


class Scratch:
    """Stages that only the steps of a ``with`` block read; they go at its end.

    What the block leaves behind must be written by then: nothing lazy may
    still read a scratch stage. If the block fails, they go all the same.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self._paths:
            remove(self._spark, path)
        self._paths.clear()

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """``stage``, until the block ends."""
        path = new_path(self._spark, name)
        self._paths.append(path)
        return _written(df, path)

    def release(self) -> None:
        """Let the cluster drop the shuffle files of finished queries now.

        Spark's cleaner drops them once the driver has collected the plans
        that own them, which may be long after the last use.
        """
        gc.collect()
        self._spark._jvm.java.lang.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a stage's folder from whatever store holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Later steps read the written rows, so a lost executor costs the tasks it
    ran, not the whole lineage. The files stay until the folder's retention
    removes them, as checkpoints do.
    """
    return _written(df, new_path(df.sparkSession, name))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Functions that run in tasks live in modules of this package, which an
    executor need not have on its path.
    """
    context = spark.sparkContext
    if getattr(context, "_cohortwise_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="cohortwise-")) / "cohortwise_tasks.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(str(archive))
    context._cohortwise_shipped = True


#: Bytes of rows that go to a task's Python at a time, about (one row at least).
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def _tidy() -> None:
    """Give what this worker's allocators hold free back to the machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def _tidied(task):
    def run(batches):
        try:
            yield from task(batches)
        finally:  # workers serve many tasks of many stages
            _tidy()

    return run


def map_arrow(df: DataFrame, task, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the tasks.

    Batches are bounded by bytes (the session's bound is lowered to
    ``BATCH_BYTES``), since texts may be long, and a worker keeps no memory
    from one task to the next.
    """
    spark = df.sparkSession
    ship(spark)
    bound = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_SETTING))
    if bound > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")
    return df.mapInArrow(_tidied(task), schema)
