"""Shard placement by a permutation-filled lookup table.

Each shard has its own permutation of the slots of a table of prime size
(an offset and a step, from hashes of its name). In turns, every shard claims
the first free slot in its order until the table is full. A key's hash gives
its slot, the table its shard: placement takes constant time, shares differ by
little, and when a shard comes or goes most keys stay where they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.store import new_path

SLOTS = 65537
MOST_SLOTS = 1 << 20  # bound of what is broadcast
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8, key=salt.encode()).digest(), "big")


def lookup_table(shards: tuple[str, ...], slots: int = SLOTS, weights: tuple[int, ...] | None = None) -> np.ndarray:
    """The shard (its index) of each slot; a shard of weight w claims w slots a turn."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if not len(shards) <= slots <= MOST_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    table = np.full(slots, -1, np.int32)
    step = [_hash(s, "step") % (slots - 1) + 1 if slots > 1 else 0 for s in shards]
    at = [_hash(s, "offset") % slots for s in shards]
    left = slots
    while left:
        for j in range(len(shards)):
            for _ in range(weights[j] if weights else 1):
                if not left:
                    break
                while table[at[j]] >= 0:
                    at[j] = (at[j] + step[j]) % slots
                table[at[j]] = j
                left -= 1
    return table


def placed(docs: DataFrame, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS, weights: tuple[int, ...] | None = None) -> DataFrame:
    """``docs`` with two more columns, ``slot`` (int) and ``shard`` (string).

    Equal keys share a shard; a null key has one too. Existing columns of
    these names, in any case, give way. The table has ``slots`` rows, at most
    ``MOST_SLOTS``, and is broadcast; the documents are not shuffled.
    """
    table = lookup_table(shards, slots, weights)
    rows = docs.sparkSession.createDataFrame([(i, shards[j]) for i, j in enumerate(table.tolist())], "slot int, shard string")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("slot", "shard")]
    keyed = docs.select(*kept, F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(slots)).cast("int").alias("slot"))
    return keyed.join(F.broadcast(rows), "slot", "left").select(*kept, "slot", "shard")


def write_shards(docs: DataFrame, path: str, file_bytes: int = 256 << 20, **options) -> DataFrame:
    """Write ``docs`` in one folder per shard, in files of about ``file_bytes``.

    The rows are dealt by shard and rebalanced: Spark's adaptive execution cuts
    what a shard holds into tasks of at most that many shuffled bytes, so files
    and tasks follow the data, not the number of shards, and a hot shard is
    split. Returns the rows as they are read back, with ``slot`` and ``shard``.
    All columns of ``docs`` but two of those names are kept, whatever they are
    called; null, empty and repeated rows are written like others, and an empty
    table leaves an empty folder.
    """
    own = placed(docs, **options)
    hint = f"{file_bytes}b"
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark = docs.sparkSession
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, hint)
    try:
        own.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
    return spark.read.schema(own.schema).parquet(path).select(*[F.col(f"`{c}`") for c in own.columns])


def op4_maglev_sharding(spark, sf_dir: str) -> DataFrame:
    """The shard of every row of ``documents``, whose whole rows are written to the shards' folders."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return write_shards(docs, new_path(spark, "shards")).select("doc_id", "slot", "shard")
