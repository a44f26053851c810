"""Words and word windows of whole texts, as numpy arrays over Arrow buffers.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return (``[^\\x20\\x09-\\x0D]+``; in UTF-8 these are the same
runs as of code points). Texts are taken in slices of about ``CHUNK`` bytes
(one text at least), so memory follows the slice, not the batch.

Words are known by a 64-bit hash: the sum of a pseudo-random value for each
(byte, place in the word), mixed. It is computed for ``PIECE`` bytes at a time,
so a text or word of any length costs no more memory than that. Windows of
words combine these. Equal windows have equal hashes; two given different ones
agree with a chance of about 2**-60.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
PIECE = 1 << 16
U = np.uint64

_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_STEP = 0x9E3779B97F4A7C15  # odd


@functools.cache
def byte_values(fold: bool, seed: int) -> np.ndarray:
    """A random 64-bit value for each byte; with ``fold`` a-z and A-Z agree."""
    values = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=U)
    if fold:
        values[65:91] = values[97:123]
    return values


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x = x * U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@dataclass
class Chunk:
    """Consecutive texts of a batch: rows ``row .. row + n``.

    ``starts``/``ends`` are the words' byte positions in ``data``; text i has
    words ``first[i] .. first[i + 1]`` and bytes ``offsets[i] .. offsets[i + 1]``.
    """

    row: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, fold: bool, seed: int = 1) -> np.ndarray:
        """A 64-bit hash of each word."""
        out = np.zeros(len(self.starts), U)
        values = byte_values(fold, seed)
        for at in range(0, len(self.data), PIECE):
            stop = min(at + PIECE, len(self.data))
            of = slice(int(np.searchsorted(self.ends, at, "right")), int(np.searchsorted(self.starts, stop, "left")))
            starts = self.starts[of]
            begin = np.maximum(starts, at)
            sizes = np.minimum(self.ends[of], stop) - begin
            where = ranges(begin, sizes)
            with np.errstate(over="ignore"):
                place = (where - np.repeat(starts, sizes)).astype(U) * U(_STEP)
                sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(values[self.data[where]] + place))])
                ends = np.cumsum(sizes)
                out[of] += sums[ends] - sums[ends - sizes]
        return mix(out)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def chunks(column: pa.Array) -> Iterator[Chunk]:
    """The texts of an Arrow string column, a slice at a time; null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield _chunk(row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row])
        row = stop


def _chunk(row: int, data: np.ndarray, offsets: np.ndarray) -> Chunk:
    inside = _IS_WORD[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    full = np.flatnonzero(offsets[1:] > offsets[:-1])  # a text's edge also ends a word
    edge = offsets[:-1][full]
    begin[edge] = inside[edge]
    edge = offsets[1:][full] - 1
    end[edge] = inside[edge]
    starts = np.flatnonzero(begin)
    return Chunk(row, data, offsets, starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets))


def windows(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words that lie in one text.

    Returns (hashes, wfirst): text i has windows ``wfirst[i] .. wfirst[i + 1]``.
    """
    counts = np.maximum(np.diff(first) - size + 1, 0)
    wfirst = np.concatenate([[0], np.cumsum(counts)])
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U), wfirst
    with np.errstate(over="ignore"):
        total = np.zeros(n, U)
        for j in range(size):
            total *= U(_STEP)
            total += words[j : j + n]
        total = mix(total + U(size))
    # Drop the windows that cross into the next text.
    keep = np.zeros(n + 1, np.int64)
    some = counts > 0
    np.add.at(keep, first[:-1][some], 1)
    np.add.at(keep, first[:-1][some] + counts[some], -1)
    return total[np.cumsum(keep[:-1]) > 0], wfirst


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenation of ``start .. start + count`` for each pair."""
    total = int(counts.sum())
    out = np.ones(total, np.int64)
    if not total:
        return out
    some = counts > 0
    starts, counts = starts[some], counts[some]
    out[0] = starts[0]
    at = np.cumsum(counts)[:-1]
    out[at] = starts[1:] - (starts[:-1] + counts[:-1] - 1)
    return np.cumsum(out)
