"""Small files in whatever store holds a path: ledgers, pointers, code lists.

They say which written folders count, and are put in place by one rename, so a
reader sees the old one or the new one and never a part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write ``path`` if it does not exist yet; an existing file is an error."""
    where, store = _store(spark, path)
    half = spark._jvm.org.apache.hadoop.fs.Path(f"{where.getParent()}/.{where.getName()}-{uuid.uuid4().hex}")
    out = store.create(half, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if store.exists(where) or not store.rename(half, where):
        store.delete(half, False)
        raise FileExistsError(path)


def get(spark: SparkSession, path: str) -> str:
    where, store = _store(spark, path)
    stream = store.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files put into ``folder``, sorted; none if it does not exist."""
    where, store = _store(spark, folder)
    if not store.exists(where):
        return []
    return sorted(n for n in (s.getPath().getName() for s in store.listStatus(where)) if not n.startswith((".", "_")))


def move(spark: SparkSession, old: str, new: str) -> None:
    """Rename ``old`` to ``new``, which goes first if it exists."""
    source, store = _store(spark, old)
    target, _ = _store(spark, new)
    if store.exists(target):
        store.delete(target, False)
    if not store.rename(source, target):
        raise OSError(f"cannot rename {old} to {new}")


def drop(spark: SparkSession, folder: str) -> None:
    where, store = _store(spark, folder)
    store.delete(where, True)
