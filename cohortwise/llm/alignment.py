"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Texts are shuffled by their full text, so that each distinct one is tokenised
and aligned once; its copies count by their number. Byte offsets where tokens
of both end cut the tokens into groups; tokens whose byte ranges overlap are
linked. How many documents link a pair of ids is summed over the corpus, and
the measures of a text that follow from these counts are joined to the
documents by the text's SHA-256.

Both tokenizers start anew at a plain space that follows anything but white
space, so a text's tokens are those of its chunks between such places. A task
keeps what it found for the chunks it has seen, up to a bound.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm import words as W
from cohortwise.llm.store import map_arrow, stage

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
# A place where both tokenizers start anew: a space after no white space, not at the end.
_CUT = re.compile(r"(?<=\S) (?!\Z)")
SPACE = "▁"  # stands for a space in the pieces of vocabulary B


@dataclass(frozen=True)
class Settings:
    byte_bpe: str = BYTE_BPE
    piece_bpe: str = PIECE_BPE
    piece: int = 1 << 18  # characters that are aligned at once, about
    chunks: int = 400_000  # that a task keeps, some 300 bytes each
    kept_bytes: int = 64 << 20  # of kept chunks, links and group names
    count_rows: int = 2_000_000  # pair counts (17 bytes each) in one broadcast


def _byte_alphabet() -> dict[str, int]:
    """The characters that byte-level BPE writes bytes as: printable ones as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokenizers:
    """Vocabularies A (byte-level BPE) and B (pieces with byte fallback) and their tokens' bytes."""

    def __init__(self, byte_bpe: str, piece_bpe: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        alphabet = _byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in alphabet for c in token):
                self.a_bytes[i] = bytes(alphabet[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        # Pieces that go on after a space would make texts inseparable there.
        self.separable = not any(SPACE in p.lstrip(SPACE) for p in pieces)


class _Spelling:
    """The bytes of a vocabulary's tokens, to be put together for many at once."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def spells(self, ids: np.ndarray, text: bytes) -> bool:
        return self.data[W.ranges(self.at[ids], self.size[ids])].tobytes() == text


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | b


@dataclass
class Aligned:
    """Alignment of many chunks: counts by chunk, group text, and links from ``first[i]`` to ``first[i + 1]``."""

    sound: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: list[str]
    first: np.ndarray
    links: np.ndarray


class Aligner:
    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.a, self.b = _Spelling(tokenizers.a_bytes), _Spelling(tokenizers.b_bytes)
        self.a_names = [np.array([f"{i}{end}" for i in range(len(self.a.size))], object) for end in (",", "|")]
        self.b_names = [np.array([f"{i}{end}" for i in range(len(self.b.size))], object) for end in (",", ";")]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of consecutive texts and how many each has, by A and by B; no ids where they do not spell the text."""
        whole = " ".join(texts)
        raw = f" {whole}".encode()
        ends = np.cumsum([len(t.encode()) + 1 for t in texts])
        spaced = self.tokenizers.a.encode_batch_fast([f" {whole}"], add_special_tokens=False)[0].ids
        out, sound = [], True
        for ids, by in ((spaced, self.a), (self.tokenizers.b.encode(whole), self.b)):
            ids = np.array(ids, np.int64)
            stops = np.cumsum(by.size[ids])
            at = np.searchsorted(stops, ends)
            sound = sound and by.spells(ids, raw) and bool((stops[at] == ends).all())
            out.append((ids, np.diff(at + 1, prepend=0)))
        if sound:
            return out
        if len(texts) == 1:
            return [(np.zeros(0, np.int64), np.zeros(1, np.int64))] * 2
        alone = [self.encode([t]) for t in texts]
        return [tuple(np.concatenate([one[side][k] for one in alone]) for k in (0, 1)) for side in (0, 1)]

    def align(self, texts: list[str]) -> Aligned:
        """Tokens, groups and links of non-empty texts; an unsound one has none.

        Texts that end in no white space are encoded in one go, joined by the
        space at which both tokenizers start anew.
        """
        joined = [i for i, t in enumerate(texts) if SPACE not in t and not t[-1].isspace()] if self.tokenizers.separable else []
        alone = set(range(len(texts))).difference(joined)
        runs = ([joined] if joined else []) + [[i] for i in sorted(alone)]
        found = [self.encode([texts[i] for i in run]) for run in runs]
        order = np.argsort(np.concatenate([np.array(run, np.int64) for run in runs]))
        (a, a_count), (b, b_count) = (tuple(np.concatenate([f[side][k] for f in found]) for k in (0, 1)) for side in (0, 1))
        # Back into the order of the texts.
        a, b = (x[W.ranges((np.cumsum(n) - n)[order], n[order])] for x, n in ((a, a_count), (b, b_count)))
        a_first, b_first = (np.concatenate([[0], np.cumsum(n[order])]) for n in (a_count, b_count))
        sound = a_count[order] > 0
        # All texts in one row: ends that both have, the last of each text included.
        a_end, b_end = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        last_a, last_b = np.searchsorted(a_end, common), np.searchsorted(b_end, common)
        # Between two neighbouring ends, of either, lies one token of each: a link.
        ends = np.union1d(a_end, b_end)
        at_a, at_b = np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)
        groups = self._groups(a, b, last_a, last_b, a_first, b_first)
        return Aligned(
            sound,
            np.diff(a_first),
            np.diff(b_first),
            np.diff(np.searchsorted(last_a, a_first)),
            groups,
            np.searchsorted(at_a, a_first),
            pair_key(a[at_a], b[at_b]),
        )

    def _groups(self, a, b, last_a, last_b, a_first, b_first) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2``, ids in decimal."""
        last = np.zeros(len(a), bool)
        last[last_a] = True
        names_a = np.where(last, self.a_names[1][a], self.a_names[0][a]) if len(a) else np.zeros(0, object)
        last = np.zeros(len(b), bool)
        last[last_b] = True
        names_b = np.where(last, self.b_names[1][b], self.b_names[0][b]) if len(b) else np.zeros(0, object)
        group_a = np.searchsorted(last_a, np.arange(len(a)))
        group_b = np.searchsorted(last_b, np.arange(len(b)))
        line = np.empty(len(a) + len(b), object)
        # A token follows the B tokens of the groups before its own, or the A tokens up to it.
        line[np.arange(len(a)) + np.concatenate([[0], last_b + 1])[group_a]] = names_a
        line[np.arange(len(b)) + (last_a + 1)[group_b]] = names_b
        first = (a_first + b_first).tolist()
        line = line.tolist()
        return ["".join(line[x:y])[:-1] for x, y in zip(first, first[1:], strict=False)]


class Chunks:
    """What is known of the chunks seen, in arrays that grow by doubling; emptied when full."""

    def __init__(self, aligner: Aligner, most: int, most_bytes: int):
        self.aligner, self.most, self.most_bytes = aligner, most, most_bytes
        self._empty()

    def _empty(self) -> None:
        self.at: dict[str, int] = {}
        self.bytes = 0
        self.groups: list[str] = []
        self.counts = np.zeros((1 << 10, 4), np.int64)  # sound, n_a, n_b, n_groups
        self.first, self.links = np.zeros(1 << 10, np.int64), np.zeros(1 << 12, np.int64)

    def learn(self, texts: set[str]) -> None:
        """Align the chunks not known yet; afterwards all of ``texts`` are known."""
        if len(self.at) + len(texts) > self.most or self.bytes > self.most_bytes:
            self._empty()
        new = [t for t in texts if t not in self.at]
        if not new:
            return
        found = self.aligner.align(new)
        n = len(self.at)
        size = self.first[n]
        self.counts = _grown(self.counts, n + len(new))
        self.first = _grown(self.first, n + len(new) + 1)
        self.links = _grown(self.links, size + len(found.links))
        self.counts[n : n + len(new)] = np.column_stack([found.sound, found.n_a, found.n_b, found.n_groups])
        self.first[n + 1 : n + len(new) + 1] = size + found.first[1:]
        self.links[size : size + len(found.links)] = found.links
        self.groups += found.groups
        self.at.update(zip(new, range(n, n + len(new)), strict=True))
        self.bytes += found.links.nbytes + sum(map(len, found.groups)) + 2 * sum(map(len, new))


def _grown(values: np.ndarray, size: int) -> np.ndarray:
    """``values`` with room for at least ``size`` rows."""
    if size <= len(values):
        return values
    return np.concatenate([values, np.zeros((max(size, 2 * len(values)) - len(values), *values.shape[1:]), values.dtype)])


@dataclass
class _Text:
    """What is known of a text, piece by piece."""

    sound: bool = True
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0

    def __post_init__(self):
        self.sha, self.line = hashlib.sha256(), []
        self.keys, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, chunks: Chunks, parts: list[str], with_groups: bool) -> None:
        at = np.array(list(map(chunks.at.__getitem__, parts)))
        sound, n_a, n_b, n_groups = chunks.counts[at].sum(axis=0).tolist()
        self.sound &= sound == len(parts)
        if not self.sound:
            return  # such a text has no tokens, whatever else it holds
        groups = ";".join(map(chunks.groups.__getitem__, at.tolist()))
        self.sha.update(((";" if self.n_a else "") + groups).encode())
        if with_groups:
            self.line.append(groups)
        self.n_a, self.n_b, self.n_groups = self.n_a + n_a, self.n_b + n_b, self.n_groups + n_groups
        keys, times = np.unique(chunks.links[W.ranges(chunks.first[at], chunks.first[at + 1] - chunks.first[at])], return_counts=True)
        if len(self.keys):
            both = np.concatenate([self.keys, keys])
            keys, back = np.unique(both, return_inverse=True)
            times = np.bincount(back, np.concatenate([self.times, times])).astype(np.int64)
        self.keys, self.times = keys, times

    def row(self, with_groups: bool) -> dict:
        if not self.sound:
            self.__init__()
        out = {"n_a": self.n_a, "n_b": self.n_b, "n_groups": self.n_groups, "n_links": int(self.times.sum())}
        out["groups_sha256"] = self.sha.hexdigest() if self.n_a else ""
        out["pairs"], out["times"] = self.keys, self.times.astype(np.int32)
        if with_groups:
            out["groups"] = ";".join(self.line)
        return out


def _pieces(text: str, piece: int) -> Iterator[str]:
    at = 0
    while len(text) - at > piece and (cut := _CUT.search(text, at + piece)):
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


_ALIGNED = [
    ("key", pa.string()), ("copies", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32())),
]
_DDL = "key string, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
_LOT = 1 << 20  # characters whose chunks are learned together, about
_FLUSH = 1 << 20  # pairs in an output batch, about


def _pieces_of(batches, piece: int) -> Iterator[tuple[str, int, str, bool]]:
    """(key, copies, piece, whether it is the text's last); bytes that are no text give one piece, U+2581."""
    for batch in batches:
        for i in range(len(batch)):
            key, copies = batch.column("key")[i].as_py(), batch.column("copies")[i].as_py()
            try:
                text = batch.column("text")[i].as_buffer().to_pybytes().decode()
            except UnicodeDecodeError:
                text = SPACE  # like it, no tokens spell them
            held = None
            for part in _pieces(text, piece):
                if held is not None:
                    yield key, copies, held, False
                held = part
            yield key, copies, held, True


def _lots(pieces, most: int) -> Iterator[list]:
    lot, size = [], 0
    for item in pieces:
        lot.append(item)
        size += len(item[2]) + 100
        if size >= most:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def _aligned_of(batches, settings: Settings, with_groups: bool) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    names = [SparkFiles.get(path.rsplit("/", 1)[-1]) for path in (settings.byte_bpe, settings.piece_bpe)]
    tokenizers = Tokenizers(*names)
    chunks = Chunks(Aligner(tokenizers), settings.chunks, settings.kept_bytes)
    schema = pa.schema(_ALIGNED + ([("groups", pa.string())] if with_groups else []))
    out: list[dict] = []
    held, found = 0, _Text()
    for lot in _lots(_pieces_of(batches, settings.piece), min(_LOT, settings.piece)):
        parts = [_CUT.split(piece) if tokenizers.separable else [piece] for _, _, piece, _ in lot]
        chunks.learn(set().union(*parts))
        for (key, copies, _, last), of in zip(lot, parts, strict=True):
            found.add(chunks, of, with_groups)
            if last:
                out.append({"key": key, "copies": copies} | found.row(with_groups))
                held += len(out[-1]["pairs"]) + 64
                found = _Text()
            if held >= _FLUSH:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, held = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def aligned_texts(texts: DataFrame, settings: Settings = Settings(), with_groups: bool = True) -> DataFrame:
    """One row per distinct non-empty text of ``texts(text)``.

    ``key`` (SHA-256 of the text) and ``copies``; ``n_a``, ``n_b`` tokens,
    ``n_groups``, ``n_links``; ``pairs`` (ids a and b as ``a << 32 | b``) that
    are linked, ``times`` each; ``groups`` as ``a1,a2|b1;a3|b2`` (if asked
    for) and their SHA-256. A text that its tokens do not spell has none: zeros,
    no pairs and ''. Nulls and empty texts are left out. A text is taken a piece
    at a time, so one of any length needs memory for a piece and its distinct
    pairs; a text without a space is one piece.
    """
    context = texts.sparkSession.sparkContext
    for path in (settings.byte_bpe, settings.piece_bpe):
        if not any(file.endswith("/" + path.rsplit("/", 1)[-1]) for file in context.listFiles):
            context.addFile(path)
    some = texts.where("text is not null and text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    some = some.select(F.sha2("text", 256).alias("key"), "copies", F.col("text").cast("binary").alias("text"))
    schema = _DDL + (", groups string" if with_groups else "")
    return map_arrow(some, lambda batches: _aligned_of(batches, settings, with_groups), schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n, best)``: documents that link a pair of ids; ``best`` if no pair of its A id has more."""
    counts = aligned.select(F.explode("pairs").alias("pair"), "copies").groupBy("pair").agg(F.sum("copies").alias("n"))
    counts = stage(counts, "alignment-counts")
    a = F.shiftright("pair", 32)
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return counts.join(most, a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _sums_of(batches, table) -> Iterator[pa.RecordBatch]:
    """Links that have the best count of their A id, and the sum of counts, by text."""
    pairs, n, best = table.value
    for batch in batches:
        lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy(zero_copy_only=False)
        of = np.repeat(np.arange(len(batch)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        keys = lists.flatten().to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(pairs, keys), max(len(pairs) - 1, 0))
        known = pairs[at] == keys if len(pairs) else np.zeros(len(keys), bool)
        of, at, times = of[known], at[known], times[known].astype(np.int64)
        sums = np.zeros((2, len(batch)), np.int64)
        np.add.at(sums[0], of, times * best[at])
        np.add.at(sums[1], of, times * n[at])
        yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "n_best": sums[0], "count_sum": sums[1]})


def link_sums(aligned: DataFrame, counts: DataFrame, count_rows: int = Settings.count_rows) -> DataFrame:
    """``(key, n_best, count_sum)`` of every aligned text.

    At most ``count_rows`` pair counts are broadcast at a time. Where there are
    more, they are dealt by pair into as many tables as it takes, and a text's
    sums over them, each written before the next table is made, are added up.
    """
    context = aligned.sparkSession.sparkContext
    counts = stage(counts, "alignment-ranked")
    size = counts.count()
    deals = max(1, -(-size * 5 // (count_rows * 4))) if size > count_rows else 1
    dealt = counts.withColumn("deal", F.pmod(F.xxhash64("pair"), F.lit(deals)))
    sums = []
    for i in range(deals):
        part = dealt.where(F.col("deal") == i).select("pair", "n", "best").orderBy("pair").toArrow()
        table = context.broadcast(tuple(part.column(c).to_numpy() for c in ("pair", "n", "best")))
        found = map_arrow(aligned.select("key", "pairs", "times"), lambda b, t=table: _sums_of(b, t), "key string, n_best long, count_sum long")
        if deals == 1:
            return found
        sums.append(stage(found, "alignment-sums"))
        table.unpersist()
    every = sums[0]
    for more in sums[1:]:
        every = every.unionByName(more)
    return every.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def alignment_measures(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id``, ``MEASURES`` and ``groups_sha256``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored,
    whatever their names. Null and empty texts, and those that their tokens do
    not spell, have zeros and ''. Repeated rows return repeated rows, and
    each counts as a document; a null ``doc_id`` keeps its row. An empty table
    gives an empty result.
    """
    aligned = stage(aligned_texts(docs.select("text"), settings, with_groups=False), "alignment-texts")
    sums = link_sums(aligned, pair_counts(aligned), settings.count_rows)
    measures = aligned.drop("pairs", "times", "copies").join(sums, "key")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2("text", 256).alias("key"))
    rows = rows.join(measures, "key", "left")
    return rows.select(
        "doc_id", *[F.coalesce(m, F.lit(0).cast("long")).alias(m) for m in MEASURES], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")
    )


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    """Alignment measures of the whole ``documents`` table."""
    return alignment_measures(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
