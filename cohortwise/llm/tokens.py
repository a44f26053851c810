"""Token ids in packed fixed-length rows.

Texts become token ids of a public byte-level BPE. Documents longer than a row
are split without loss, and the pieces of a slice of text go longest first
into the fullest row that takes them; a segment tree over the free room finds
it. Each row holds its ids, the cumulative lengths of its segments and the
positions, which start again at every segment.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cohortwise.llm import words as W
from cohortwise.llm.store import map_arrow

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that this vocabulary splits texts by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = re.compile(r"\S(?=[ \t-\r])")  # a word's end before plain white space


@dataclass(frozen=True)
class Settings:
    row: int = 2048  # tokens
    end: int = 50256  # closes every document and pads rows
    slice_bytes: int = 8 << 20  # of text that is packed together
    piece: int = 1 << 18  # characters that are encoded at once, about


class RoomTree:
    """Rows by free room: a segment tree of counts over the values 0..most."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def add(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        self._change(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove the row with the least room of at least ``size``."""
        node = size + self.leaves
        while not self.count[node]:  # climb until a right sibling has a row
            while node & 1:
                node >>= 1
                if not node:
                    return None
            node += 1
        while node < self.leaves:
            node *= 2
            node += not self.count[node]
        room = node - self.leaves
        self._change(room, -1)
        return room, self.rows[room].pop()

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1


def best_fit_decreasing(lengths: np.ndarray, row: int) -> list[list[int]]:
    """Indices of the pieces in each row; no piece is longer than a row."""
    tree, rows = RoomTree(row), []
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        found = tree.take(size)
        if found is None:
            rows.append([])
            found = row, len(rows) - 1
        room, at = found
        rows[at].append(int(i))
        tree.add(room - size, at)
    return rows


class Encoder:
    """Token ids of whole texts, encoded in pieces of about ``piece`` characters.

    Tokens never span from a word into the white space after it, so a text's
    ids are those of pieces cut there; one without such a place is one piece.
    """

    def __init__(self, ranks: bytes, piece: int = Settings.piece):
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        self.piece = piece
        self.bpe = tiktoken.Encoding(
            "public", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={}
        )

    def _pieces(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > self.piece and (found := _CUT.search(text, at + self.piece)):
            yield text[at : found.end()]
            at = found.end()
        yield text[at:]

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets by text); ``end`` closes each text."""
        parts, sizes = [], np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts.to_pylist(), 1):
            for piece in self._pieces(text or ""):
                parts.append(np.array(self.bpe.encode_ordinary(piece), np.int32))
                sizes[i] += len(parts[-1])
            parts.append(np.array([end], np.int32))
            sizes[i] += 1
        return np.concatenate(parts or [np.zeros(0, np.int32)]), np.cumsum(sizes)


def _slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield start, stop
        start = stop


def _rows_of(batches, ranks: bytes, settings: Settings) -> Iterator[pa.RecordBatch]:
    encoder, made = Encoder(ranks, settings.piece), 0
    task = TaskContext.get().partitionId()
    for batch in batches:
        texts, docs = batch.column("text"), batch.column("doc_id")
        for start, stop in _slices(texts, settings.slice_bytes):
            ids, offsets = encoder.encode(texts.slice(start, stop - start), settings.end)
            out = _packed(ids, offsets, docs.slice(start, stop - start), settings)
            rows = len(out["n_tokens"])
            out["row_id"] = (task << 32) + made + np.arange(rows)
            made += rows
            names = ["row_id", "n_tokens", "ids", "positions", "cu_seqlens", "doc_ids", "doc_starts"]
            yield pa.RecordBatch.from_pydict({n: out[n] for n in names})


def _packed(ids: np.ndarray, offsets: np.ndarray, docs: pa.Array, settings: Settings) -> dict:
    lengths = np.diff(offsets)
    pieces = -(-lengths // settings.row)
    doc = np.repeat(np.arange(len(lengths)), pieces)
    begin = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * settings.row
    size = np.minimum(lengths[doc] - begin, settings.row)
    rows = best_fit_decreasing(size, settings.row)
    out: dict = {n: [] for n in ("n_tokens", "ids", "positions", "cu_seqlens", "doc_ids", "doc_starts")}
    for members in rows:
        at = np.array(members)
        sizes = size[at]
        total = int(sizes.sum())
        line = np.full(settings.row, settings.end, np.int32)
        line[:total] = ids[W.ranges(offsets[doc[at]] + begin[at], sizes)]
        places = np.zeros(settings.row, np.int32)
        places[:total] = W.ranges(np.zeros(len(at), np.int64), sizes)
        out["n_tokens"].append(total)
        out["ids"].append(line.astype("<i4").tobytes())
        out["positions"].append(places.astype("<i4").tobytes())
        out["cu_seqlens"].append(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        out["doc_ids"].append(docs.take(pa.array(doc[at])))
        out["doc_starts"].append(begin[at])
    for name, kind in (("cu_seqlens", pa.int32()), ("doc_starts", pa.int64())):
        out[name] = pa.array(out[name], pa.list_(kind))
    out["doc_ids"] = pa.array([x.to_pylist() for x in out["doc_ids"]], pa.list_(pa.int64()))
    return out


def packed_rows(docs: DataFrame, vocabulary: str = VOCABULARY, settings: Settings = Settings()) -> DataFrame:
    """Packed rows of all whole texts of ``docs(doc_id, text)``.

    Every row has ``row`` ids as little-endian int32 (``ids``), padded with
    the end token after ``n_tokens``; ``positions`` in the same form, from 0
    in each segment; ``cu_seqlens`` (0 and the end of each segment); and, by
    segment, ``doc_ids`` and ``doc_starts`` (the segment's first token in its
    document). Every document closes with the end token, so a null or empty
    text is that token alone. Repeated rows and null ids are packed like any
    other; other columns are ignored, whatever their names.

    Rows are packed within slices of ``slice_bytes`` of text (one text at
    least), so a task's memory does not follow its partition.
    """
    with open(vocabulary, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    return map_arrow(
        docs.selectExpr("cast(doc_id as long) as doc_id", "text"),
        lambda batches: _rows_of(batches, ranks.value, settings),
        "row_id long, n_tokens long, ids binary, positions binary, cu_seqlens array<int>, doc_ids array<long>, doc_starts array<long>",
    )


def op5_token_rows(spark, sf_dir: str) -> DataFrame:
    """Packed token rows of the whole ``documents`` table."""
    return packed_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
