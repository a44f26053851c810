"""Best-fit packing into bins of several permitted lengths.

Documents go longest first into the open bin with the least room that still
takes them. If none does, a bin opens at the permitted length with the least
cost for each unit that remains to be packed; at the end every bin shrinks to
the shortest permitted length that holds its contents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm import tokens as T
from cohortwise.llm.store import map_arrow, ship, stage

CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 16  # cost of a bin beside its length
BLOCK = 4096  # documents that are packed together, on average
WORD = r"[^\x20\x09-\x0D]+"


def pack(lengths: np.ndarray, capacities: tuple[int, ...], overhead: int = OVERHEAD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pack pieces of at most the largest capacity.

    Returns (bin of each piece, offset of each piece in its bin, capacity of
    each bin). Ties in length keep the given order.
    """
    sizes = sorted(capacities)
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    fill: list[int] = []
    opened: list[int] = []
    rooms = 0  # bit r is set if an open bin has r units of room
    by_room: dict[int, list[int]] = {}
    left = int(lengths.sum())
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        above = rooms >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room = min((c for c in sizes if c >= size), key=lambda c: ((c + overhead) / min(c, left), c))
            b = len(fill)
            fill.append(0)
            opened.append(room)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        left -= size
        room -= size
        held = by_room.setdefault(room, [])
        if not held:
            rooms |= 1 << room
        held.append(b)
    closed = np.array(sizes)[np.searchsorted(sizes, fill)] if fill else np.zeros(0, np.int64)
    return bins, offsets, closed


def _packed(table: pa.Table, capacities: tuple[int, ...], overhead: int) -> pa.Table:
    """One block: a row per piece, with its bin."""
    block = table.column("block")[0].as_py()
    order = table.sort_by([("length", "descending"), ("doc_id", "ascending")])
    lengths = order.column("length").to_numpy()
    top = max(capacities)
    pieces = -(-lengths // top)
    doc = np.repeat(np.arange(len(lengths)), pieces)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    size = np.minimum(lengths[doc] - piece * top, top)
    bins, offsets, closed = pack(size, capacities, overhead)
    return pa.table(
        {
            "doc_id": order.column("doc_id").take(pa.array(doc)),
            "piece": pa.array(piece.astype(np.int32)),
            "piece_start": pa.array(piece * top),
            "length": pa.array(size),
            "bin_id": pa.array((block << 32) + bins),
            "bin_offset": pa.array(offsets),
            "bin_capacity": pa.array(closed[bins]),
        }
    )


def best_fit_bins(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, block: int = BLOCK) -> DataFrame:
    """Pack all documents of ``docs(doc_id, text)``; one row per piece.

    A document's length is its number of words and one end mark, so a null or
    empty text has length 1. One that exceeds the largest capacity is split
    into pieces without loss; nothing is cut off. Returns ``doc_id``,
    ``piece``, ``piece_start`` (unit of the document), ``length``, ``bin_id``,
    ``bin_offset`` and ``bin_capacity``. Repeated rows and null ids are packed
    like any other; other columns are ignored, whatever their names.

    Documents are dealt into blocks of about ``block`` rows by a hash of the
    row, so no block grows with the table or with a key; each is packed by
    one task, and only its last bins can be less than full.
    """
    units = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long") + 1
    lengths = docs.select(F.col("doc_id").cast("long").alias("doc_id"), units.alias("length"))
    return _bins(stage(lengths, "packing-lengths"), capacities, overhead, block)


def _bins(lengths: DataFrame, capacities: tuple[int, ...], overhead: int, block: int) -> DataFrame:
    """Bins of written ``lengths(doc_id, length)``."""
    blocks = max(1, -(-lengths.count() // block))
    row = F.monotonically_increasing_id()  # repeated rows must not meet in one block
    dealt = lengths.withColumn("block", F.pmod(F.xxhash64("doc_id", "length", row), F.lit(blocks)))
    ship(lengths.sparkSession)
    return dealt.groupBy("block").applyInArrow(
        lambda table: _packed(table, capacities, overhead),
        "doc_id long, piece int, piece_start long, length long, bin_id long, bin_offset long, bin_capacity long",
    )


def _pieces_of(batches, ranks: bytes, settings: T.Settings, top: int) -> Iterator[pa.RecordBatch]:
    """Each text's token ids, a row per ``top`` of them; ``key`` tells the texts apart."""
    encoder, made = T.Encoder(ranks, settings.piece), 0
    task = TaskContext.get().partitionId()
    for batch in batches:
        texts, docs = batch.column("text"), batch.column("doc_id")
        for start, stop in T._slices(texts, settings.slice_bytes):
            ids, offsets = encoder.encode(texts.slice(start, stop - start), settings.end)
            pieces = -(-np.diff(offsets) // top)
            doc = np.repeat(np.arange(stop - start), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            cuts = np.append(offsets[doc] + piece * top, offsets[-1]).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array((task << 33) + made + doc),
                    "doc_id": docs.slice(start, stop - start).take(pa.array(doc)),
                    "piece": pa.array(piece.astype(np.int32)),
                    "ids": pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids)),
                }
            )
            made += stop - start


def packed_sequences(
    docs: DataFrame,
    vocabulary: str = T.VOCABULARY,
    capacities: tuple[int, ...] = CAPACITIES,
    overhead: int = OVERHEAD,
    block: int = BLOCK,
    settings: T.Settings = T.Settings(),
) -> DataFrame:
    """Packed token sequences of all whole texts of ``docs(doc_id, text)``, one row per bin.

    Lengths are numbers of tokens, ``settings.end`` closes every text, and bins
    are chosen as by ``best_fit_bins``. Returns ``bin_id``, ``bin_capacity``,
    ``n_tokens``, ``ids`` (without padding), ``cu_seqlens`` (0 and the end of
    each segment) and, by segment, ``doc_ids`` and ``doc_starts`` (its first
    token in its document). A text longer than the largest capacity is split
    without loss; a null or empty one is its end token alone. Repeated rows
    and null ids are packed like any other, other columns are ignored, and an
    empty table gives no rows.

    Texts are encoded once, into written rows of at most the largest capacity;
    a bin's rows, which its capacity bounds, meet in one aggregate.
    """
    top = max(capacities)
    with open(vocabulary, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    texts = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    pieces = map_arrow(
        texts, lambda batches: _pieces_of(batches, ranks.value, settings, top), "key long, doc_id long, piece int, ids array<int>"
    )
    pieces = stage(pieces, "packing-pieces")
    lengths = pieces.groupBy(F.col("key").alias("doc_id")).agg(F.sum(F.size("ids")).alias("length"))
    bins = _bins(stage(lengths, "packing-lengths"), capacities, overhead, block).withColumnRenamed("doc_id", "key")
    segment = F.struct("bin_offset", "doc_id", "piece_start", "length", "ids")
    held = bins.join(pieces, ["key", "piece"]).groupBy("bin_id", "bin_capacity").agg(F.array_sort(F.collect_list(segment)).alias("s"))
    ends = F.transform("s", lambda x: (x["bin_offset"] + x["length"]).cast("int"))
    return held.select(
        "bin_id",
        "bin_capacity",
        F.aggregate("s", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("n_tokens"),
        F.flatten(F.col("s.ids")).alias("ids"),
        F.concat(F.array(F.lit(0)), ends).alias("cu_seqlens"),
        F.col("s.doc_id").alias("doc_ids"),
        F.col("s.piece_start").alias("doc_starts"),
    )


def op6_flexible_packing(spark, sf_dir: str) -> DataFrame:
    """Bins for the whole ``documents`` table."""
    return best_fit_bins(spark.read.parquet(f"{sf_dir}/documents.parquet"))
