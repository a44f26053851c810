"""Size-checked broadcast of lookup tables and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Lookups (codelists, dictionaries, area maps) are bounded by the size of a
# clinical vocabulary, not by the event data. Above this many rows a lookup
# is joined with a regular shuffle join instead of being broadcast.
BROADCAST_MAX_ROWS = 200_000


def small_side(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when ``df`` provably has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows, so it stays cheap even when
    the side turns out to be large; in that case the plan keeps a shuffle join
    (and AQE may still switch to a broadcast from measured sizes).
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names a folder every executor can reach; it is
    read from the session. Where it is unset, a local session (tests) gets a
    temporary one; on a cluster that is an error, as other machines could not
    read a local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="cohortwise-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


# Shuffled bytes that one written file holds, about.
FILE_BYTES = 256 << 20
# Shuffle partitions that a balanced write deals its values to: enough that a
# small value seldom shares one, and thus its cuts, with a large one.
SLOTS = 1024
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Within the block, the session has these settings."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def advisory_bytes(spark: SparkSession, size: int):
    """Within the block, adaptive execution aims at shuffle partitions of ``size`` bytes."""
    return _settings(spark, {_ADVISORY: f"{size}b"})


# Rows that one task of a person-wise step takes, about; each may turn into several matches.
TASK_ROWS = 100_000
# Shuffled bytes that a task of a stage takes, about: sorted or hashed rows need many times that.
STAGE_BYTES = 16 << 20


def partitions_for(spark: SparkSession, rows: int, task_rows: int = TASK_ROWS) -> int:
    """Partitions that hold about ``task_rows`` of ``rows`` each, at least the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // task_rows))


def dealt(
    df: DataFrame, key: str, hot: DataFrame | None = None, task_rows: int = TASK_ROWS, like: DataFrame | None = None
) -> DataFrame:
    """The written table ``df`` dealt by ``key`` to as many partitions as its rows ask for.

    ``like``: to as many as the rows of this written table ask for, so that the
    two can be joined where they lie.

    Where there are ``hot`` keys the rows stay as they lie, lest one task gets
    all rows of a key; each later step then deals them by its own keys.
    """
    if hot is not None and not hot.isEmpty():
        return df
    rows = (df if like is None else like).count()
    return df.repartition(partitions_for(df.sparkSession, rows, task_rows), key)


def stage_settings(spark: SparkSession, rows: int):
    """Settings under which a stage over ``rows`` input rows is written.

    Shuffles get partitions in proportion to the input, so that no task's
    memory grows with it, and rows that already lie by some of a join's keys
    are not dealt again by all of them.
    """
    return _settings(spark, {
        "spark.sql.shuffle.partitions": str(partitions_for(spark, rows, 2 * TASK_ROWS)),
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        _ADVISORY: f"{STAGE_BYTES}b",
    })


def write_balanced(
    df: DataFrame, path: str, by: Sequence[str], file_bytes: int = FILE_BYTES, fmt: str = "parquet", dynamic: bool = False
) -> None:
    """Write ``df`` partitioned by ``by``, with files per partition value bounded by bytes.

    A ``REBALANCE`` deals the rows by ``by``; adaptive execution then cuts a
    value that holds more than ``file_bytes`` into several tasks and joins small
    ones, so the number of files follows the data and not tasks x values.
    ``dynamic`` replaces only the values that ``df`` holds.
    """
    slots = max(SLOTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    writer = df.hint("rebalance", slots, *by).write.mode("overwrite").format(fmt).partitionBy(*by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with advisory_bytes(df.sparkSession, file_bytes):
        writer.save(path)
