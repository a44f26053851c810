"""Benchmark decontamination: BM25 over test items, block-max WAND, verification.

The test items form an inverted index: for each term the items that hold it
and their BM25 impact, here as a share of the item's own full score, so one
threshold serves all items. Items lie in blocks; a term's largest impact in a
block bounds what it can add to any item there. Every passage of every text is
a query. Its terms stand in the order of their largest impact anywhere, weakest
first: the pivot is the first at which the impacts summed so far reach the
threshold, so only blocks that the pivot or a stronger term names are looked
at. There the block's bounds of the weaker terms are added, strongest first,
until what is left can no longer reach the threshold; a block that passes them
all is opened. Terms that most items share are not looked up for that, their
largest sum per block counts in full. The items of opened blocks are scored
exactly, and a hit is verified by the word n-grams of its question and answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm import words as W
from cohortwise.llm.store import Scratch, map_arrow, stage

U = np.uint64
K1, B = 1.2, 0.75
SLACK = 2e-9  # for rounding in sums of bounds
DENSE = 64  # pairs of passage and block for each named one from which on they are sorted, not laid out
CELLS = 1 << 20  # pairs of passage and block that a task looks at together
#: Marks trimmed from both ends of a word before it is compared.
TRIM = np.zeros(256, bool)
TRIM[list(b".,;:!?\"'()[]{}|*#$%&<>-")] = True


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.6  # share of an item's full BM25 score
    question: float = 0.6  # share of the question's n-grams
    answer: float = 0.6
    gram: int = 4
    least_stride: int = 64  # words; doubled until it holds the item
    block: int = 8  # items
    shared: float = 0.05  # terms in a larger share of the items count in full
    shard_bytes: int = 32 << 20  # of item text that one index holds


def trimmed(chunk: W.Chunk) -> np.ndarray:
    """Case-folded hashes of the words without marks at their ends."""
    starts, ends = chunk.starts.copy(), chunk.ends.copy()
    for _ in range(4):
        ends -= TRIM[chunk.data[ends - 1]] & (ends - starts > 1)
        starts += TRIM[chunk.data[starts]] & (ends - starts > 1)
    return W.Chunk(chunk.row, chunk.data, chunk.offsets, starts, ends, chunk.first).hashes(fold=True, seed=3)


def split_item(text: str) -> int:
    """Words of the question: all before the last sentence or line.

    An item of one sentence splits at two thirds.
    """
    count = len(text.encode().split())
    body = text.rstrip().rstrip(".!?")
    cut = max(body.rfind(mark) for mark in (".", "?", "!", "\n"))
    head = len(body[: cut + 1].encode().split())
    return head if 0 < head < count else max(1, count * 2 // 3)


def stride_of(size: int, settings: Settings) -> int:
    """Stride of the passages that an item of ``size`` words is searched in."""
    stride = settings.least_stride
    while stride < size:
        stride *= 2
    return stride


@dataclass(frozen=True)
class Corpus:
    """What BM25 takes from all items: their number, mean length and terms (sorted)."""

    count: int
    mean: float
    terms: np.ndarray
    df: np.ndarray


@dataclass
class Index:
    """Places of items, in ``order`` of what shared terms add to them, ``block`` of them a block.

    ``key`` are the (term, block) pairs with a bound as term x blocks + block,
    those of term t from ``block_at[t]`` to ``block_at[t + 1]``. The terms and
    impacts of the item at place j stand from ``item_at[j]`` to ``item_at[j + 1]``.
    """

    items: np.ndarray
    order: np.ndarray
    terms: np.ndarray
    filter: np.ndarray
    block_at: np.ndarray
    key: np.ndarray
    bound: np.ndarray
    most: np.ndarray  # a term's largest bound
    rest: np.ndarray  # per block: the most that shared terms can add
    common: np.ndarray
    item_at: np.ndarray
    item_term: np.ndarray
    impact: np.ndarray
    question: list[np.ndarray]
    answer: list[np.ndarray]
    gram: list[tuple[int, int]]
    stride: int


def item_words(texts: list[str | None]) -> list[np.ndarray | None]:
    """The hashes of each item's words; None if it has none."""
    out: list[np.ndarray | None] = [None] * len(texts)
    for chunk in W.chunks(pa.array(texts, pa.string())):
        h = trimmed(chunk)
        for i in range(chunk.n):
            text = texts[chunk.row + i]
            if text and text.split():
                out[chunk.row + i] = h[chunk.first[i] : chunk.first[i + 1]].copy()
    return out


def build_indexes(items: list[tuple[int, str]], settings: Settings, corpus: Corpus | None = None) -> list[Index]:
    """The indexes of test items, one for each stride, scored as in one index.

    ``corpus`` describes the whole benchmark if ``items`` are only part of it.
    """
    known = _known(items)
    if corpus is None and known:
        corpus = _corpus([h for *_, h in known])
    classes: dict[int, list[tuple[int, str, np.ndarray]]] = {}
    for i, text, h in known:
        classes.setdefault(stride_of(len(h), settings), []).append((i, text, h))
    return [_index(own, settings, corpus) for _, own in sorted(classes.items())]


def build_index(items: list[tuple[int, str]], settings: Settings, corpus: Corpus | None = None) -> Index | None:
    """One index of test items of any length; None if no item has a word."""
    known = _known(items)
    return _index(known, settings, corpus or _corpus([h for *_, h in known])) if known else None


def _known(items: list[tuple[int, str]]) -> list[tuple[int, str, np.ndarray]]:
    """(id, text, words) of the items that have an id and a word."""
    hashes = item_words([text for _, text in items])
    return [(i, text, h) for (i, text), h in zip(items, hashes, strict=True) if i is not None and h is not None]


def _corpus(hashes: list[np.ndarray]) -> Corpus:
    terms, df = np.unique(np.concatenate([np.unique(h) for h in hashes]), return_counts=True)
    return Corpus(len(hashes), sum(len(h) for h in hashes) / len(hashes), terms, df)


def _index(items: list[tuple[int, str, np.ndarray]], settings: Settings, corpus: Corpus) -> Index:
    """One index of test items with words, its stride that of the longest."""
    count = len(items)
    sizes = np.array([len(h) for *_, h in items])
    pairs = [np.unique(h, return_counts=True) for *_, h in items]
    held = np.array([len(t) for t, _ in pairs])
    terms, term = np.unique(np.concatenate([t for t, _ in pairs]), return_inverse=True)
    tf, item = np.concatenate([n for _, n in pairs]), np.repeat(np.arange(count), held)
    df = corpus.df[np.searchsorted(corpus.terms, terms)]
    idf = np.log1p((corpus.count - df + 0.5) / (df + 0.5))
    norm = K1 * (1 - B + B * sizes[item] / corpus.mean)
    impact = idf[term] * tf * (K1 + 1) / (tf + norm)
    impact = impact / np.bincount(item, weights=impact, minlength=count)[item]
    common = np.bincount(term, minlength=len(terms)) > max(2, settings.shared * count)
    # Items to which shared terms add alike share blocks, which keeps ``rest`` close.
    by_item = np.bincount(item, weights=impact * common[term], minlength=count)
    order = np.argsort(by_item, kind="stable")
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    sort = np.argsort(place[item], kind="stable")
    item, term, impact = place[item][sort], term[sort], impact[sort]
    blocks = -(-count // settings.block)
    rest = np.maximum.reduceat(by_item[order], np.arange(0, count, settings.block))
    # Largest impact of each rare term in each of its blocks.
    rare = ~common[term]
    key = term[rare] * blocks + item[rare] // settings.block
    by_key = np.argsort(key, kind="stable")
    some, first = np.unique(key[by_key], return_index=True)
    bound = np.maximum.reduceat(impact[rare][by_key], first) if len(some) else np.zeros(0)
    most = np.zeros(len(terms))
    np.maximum.at(most, some // blocks, bound)
    seen = np.zeros(1 << min(24, max(18, (8 * len(terms)).bit_length())), bool)
    seen[_slots(terms[~common], seen)] = True
    questions, answers, grams = [], [], []
    for _, text, h in items:
        head = split_item(text)
        parts = []
        for part in (h[:head], h[head:]):
            n = max(1, min(settings.gram, len(part)))
            parts.append((n, np.unique(W.windows(part, np.array([0, len(part)]), n)[0])))
        questions.append(parts[0][1])
        answers.append(parts[1][1])
        grams.append((parts[0][0], parts[1][0]))
    return Index(
        np.array([i for i, *_ in items], np.int64), order, terms, seen, np.searchsorted(some // blocks, np.arange(len(terms) + 1)),
        some, bound, most, rest, common, np.concatenate([[0], np.cumsum(held[order])]), term, impact,
        questions, answers, grams, stride_of(int(sizes.max()), settings),
    )


def _slots(hashes: np.ndarray, seen: np.ndarray) -> np.ndarray:
    return (hashes & U(len(seen) - 1)).astype(np.int64)


def _search(chunk: W.Chunk, h: np.ndarray, index: Index, settings: Settings) -> Iterator[tuple]:
    """(text, item position, passage's first word, score, overlaps) of all hits."""
    counts = chunk.counts()
    cells = -(-counts // index.stride)
    passages = np.maximum(cells - 1, (counts > 0).astype(np.int64))  # each spans two cells
    pfirst = np.concatenate([[0], np.cumsum(passages)])
    # Rare terms of each passage.
    maybe = np.flatnonzero(index.filter[_slots(h, index.filter)])
    term = np.searchsorted(index.terms, h[maybe])
    term[term == len(index.terms)] = 0
    hit = (index.terms[term] == h[maybe]) & ~index.common[term]
    maybe, term = maybe[hit], term[hit]
    text = np.searchsorted(chunk.first, maybe, "right") - 1
    cell = (maybe - chunk.first[text]) // index.stride
    pairs = []
    for step in (0, -1):
        p = cell + step
        ok = (p >= 0) & (p < passages[text])
        pairs.append((pfirst[text[ok]] + p[ok]) * len(index.terms) + term[ok])
    pairs = np.unique(np.concatenate(pairs))
    named: dict[int, np.ndarray] = {}
    for passage, block in _opened(pairs // len(index.terms), pairs % len(index.terms), index, settings.threshold):
        own, at = np.unique(passage, return_index=True)
        named.update(zip(own.tolist(), np.split(block, at[1:]), strict=False))
    always = np.flatnonzero(index.rest >= settings.threshold - SLACK)  # blocks that need no rare term
    for p in range(int(pfirst[-1])) if len(always) else named:
        blocks = np.concatenate([always, named.get(p, always[:0])])
        yield from _scored(chunk, h, pfirst, p, blocks, index, settings)


def _opened(passage: np.ndarray, term: np.ndarray, index: Index, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(passages, blocks) that the rare terms of each passage open, in order; blocks that need none are left out.

    ``passage`` is sorted. Passages go in groups of at most ``CELLS`` named blocks (one at least).
    """
    if not len(term):
        return
    need = threshold - SLACK
    floor = np.where(index.rest < need, need - index.rest, np.inf)  # what rare terms must add in each block
    reach = floor.min()
    order = np.lexsort((index.most[term], passage))
    passage, term = passage[order], term[order]
    most = index.most[term]
    starts = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    sums = np.cumsum(most)
    group = np.cumsum(np.append(False, passage[1:] != passage[:-1]))
    below = sums - (sums[starts] - most[starts])[group]  # a term's and all weaker ones' most
    strong = below >= reach  # the pivot and the terms after it
    weak = np.bincount(group[~strong], minlength=len(starts))  # weaker terms come first in a group
    left = np.where(weak > 0, below[starts + np.maximum(weak, 1) - 1], 0.0)
    sizes = np.where(strong, index.block_at[term + 1] - index.block_at[term], 0)
    total = np.concatenate([[0], np.cumsum(np.add.reduceat(sizes, starts))])
    ends = np.append(starts[1:], len(term))
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(total, total[low] + CELLS, "right")) - 1)
        own = slice(starts[low], ends[high - 1])
        posting = W.ranges(index.block_at[term[own]], sizes[own])
        block = index.key[posting] % len(index.rest)
        pair = np.repeat(group[own] - low, sizes[own]) * len(index.rest) + block
        if (high - low) * len(index.rest) <= DENSE * len(pair):
            bound = np.bincount(pair, weights=index.bound[posting], minlength=(high - low) * len(index.rest))
            pair = np.flatnonzero((bound.reshape(high - low, -1) + left[low:high, None] >= floor) & (bound.reshape(high - low, -1) > 0))
            bound = bound[pair]
        else:
            pair, back = np.unique(pair, return_inverse=True)
            bound = np.bincount(back, weights=index.bound[posting], minlength=len(pair))
        at, block = pair // len(index.rest) + low, pair % len(index.rest)
        live = bound + left[at] >= floor[block]
        at, block, bound = at[live], block[live], bound[live]
        step = weak[at]  # weaker terms that are still to be looked up
        while (todo := np.flatnonzero(step > 0)).size:
            place = starts[at[todo]] + step[todo] - 1
            key = term[place] * len(index.rest) + block[todo]
            hit = np.minimum(np.searchsorted(index.key, key), len(index.key) - 1)
            bound[todo] += np.where(index.key[hit] == key, index.bound[hit], 0.0)
            step[todo] -= 1
            rest = np.where(step > 0, below[starts[at] + np.maximum(step, 1) - 1], 0.0)
            live = bound + rest >= floor[block]
            at, block, bound, step = at[live], block[live], bound[live], step[live]
        yield passage[starts[at]], block
        low = high


def _scored(chunk: W.Chunk, h: np.ndarray, pfirst: np.ndarray, p: int, blocks: np.ndarray, index: Index, settings: Settings) -> Iterator[tuple]:
    """The verified hits of passage ``p`` among the items of its opened blocks."""
    i = int(np.searchsorted(pfirst, p, "right")) - 1
    start = int(chunk.first[i] + (p - pfirst[i]) * index.stride)
    words = h[start : min(start + 2 * index.stride, int(chunk.first[i + 1]))]
    own = np.unique(words)
    t = np.searchsorted(index.terms, own)
    t[t == len(index.terms)] = 0
    t = t[index.terms[t] == own]
    begin = blocks * settings.block
    items = W.ranges(begin, np.minimum(settings.block, len(index.items) - begin))
    sizes = index.item_at[items + 1] - index.item_at[items]
    posting = W.ranges(index.item_at[items], sizes)
    there = np.isin(index.item_term[posting], t)
    scores = np.bincount(np.repeat(np.arange(len(items)), sizes)[there], weights=index.impact[posting[there]], minlength=len(items))
    for at in np.flatnonzero(scores >= settings.threshold):
        j, found = int(index.order[items[at]]), []
        for grams, n in ((index.question[j], index.gram[j][0]), (index.answer[j], index.gram[j][1])):
            there, _ = W.windows(words, np.array([0, len(words)]), n)
            found.append(float(np.isin(grams, there).mean()) if len(grams) else 1.0)
        if found[0] >= settings.question and found[1] >= settings.answer:
            yield i, j, start - int(chunk.first[i]), float(scores[at]), found[0], found[1]


def _hits_of(batches, indexes: list[Index], settings: Settings):
    for batch in batches:
        docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
        rows = []
        for chunk in W.chunks(batch.column("text")):
            h = trimmed(chunk)
            for index in indexes:
                for i, j, start, score, question, answer in _search(chunk, h, index, settings):
                    rows.append((int(docs[chunk.row + i]), int(index.items[j]), start, score, question, answer))
        names = ("doc_id", "item_id", "passage_word", "score", "question_overlap", "answer_overlap")
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))


PAIRS = "doc_id long, item_id long, passage_word long, score double, question_overlap double, answer_overlap double"


def _terms_of(batches):
    for batch in batches:
        shards, texts = (batch.column(c).to_pylist() for c in ("shard", "text"))
        found = [(shard, h) for shard, h in zip(shards, item_words(texts), strict=True) if h is not None]
        terms = pa.array([np.unique(h).view(np.int64) for _, h in found], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([k for k, _ in found], pa.int32()), "words": pa.array([len(h) for _, h in found], pa.int64()), "terms": terms}
        )


def _shards(docs: DataFrame, items: DataFrame, settings: Settings) -> Iterator:
    """Broadcast indexes that together hold all items, those sent at once of bounded size."""
    spark = docs.sparkSession
    tests = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(-(-size // settings.shard_bytes)) or 1
    tests = tests.distinct().withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int"))
    with Scratch(spark) as scratch:
        if shards > 1:  # a single shard holds what its scores take from all items
            known = map_arrow(tests.select("shard", "text"), _terms_of, "shard int, words long, terms array<long>")
            known = scratch.stage(known, "benchmark-words")
            count, words = known.agg(F.count("*"), F.sum("words")).first()
            held = known.select("shard", F.explode("terms").alias("term")).groupBy("term", "shard").agg(F.count("*").alias("n"))
            df = held.groupBy("term").agg(F.sum("n").alias("df"))
            terms = scratch.stage(held.join(df, "term").select("shard", "term", "df"), "benchmark-terms")
        for shard in range(shards):
            corpus = None
            if shards > 1:
                own = terms.where(F.col("shard") == shard).select("term", "df").toArrow()
                term, df = own.column("term").to_numpy().view(U), own.column("df").to_numpy()
                order = np.argsort(term)
                corpus = Corpus(count, words / max(1, count), term[order], df[order])
            rows = tests.where(F.col("shard") == shard).collect()
            indexes = build_indexes(sorted((r.item_id, r.text) for r in rows), settings, corpus)
            if indexes:
                yield spark.sparkContext.broadcast(indexes)


def contaminated(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Pairs of documents and test items that they hold.

    ``docs(doc_id, text)``, ``items(item_id, text)``; other columns are
    ignored, whatever their names. Every passage of every whole text queries
    the index; all items at or above the threshold are retrieved, and kept if
    enough of both question and answer stands in the passage. Returns the best
    passage of each pair: ``doc_id``, ``item_id``, ``passage_word`` (its first
    word), ``score``, ``question_overlap``, ``answer_overlap``; ties go to the
    first passage. Null or empty texts and rows without an id match nothing;
    repeated rows count once; an empty table on either side gives no pairs.

    At most ``shard_bytes`` of item text are indexed at once. Larger benchmarks
    are cut into shards by a hash of the item, each with its own pass over the
    documents, so no task or driver holds more than one shard. All shards score
    with the document frequencies, number and mean length of all items, and
    the width of an item's passages follows from its own length alone, so the
    result does not depend on the shards.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    found = docs.sparkSession.createDataFrame([], PAIRS)
    for sent in _shards(docs, items, settings):
        found = found.unionByName(map_arrow(texts, lambda batches, sent=sent: _hits_of(batches, sent.value, settings), PAIRS))
    rank = F.struct((-F.col("score")).alias("minus"), "passage_word", "question_overlap", "answer_overlap")
    best = found.groupBy("doc_id", "item_id").agg(F.min(rank).alias("b"))
    return best.select(
        "doc_id", "item_id", "b.passage_word", (-F.col("b.minus")).alias("score"), "b.question_overlap", "b.answer_overlap"
    )


def _clean_of(batches, indexes: list[Index], settings: Settings):
    for batch in batches:
        keep = np.ones(len(batch), bool)
        for chunk in W.chunks(batch.column("text")):
            h = trimmed(chunk)
            for index in indexes:
                for i, *_ in _search(chunk, h, index, settings):
                    keep[chunk.row + i] = False
        yield batch.filter(pa.array(keep))


def clean_documents(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no test item.

    Null and empty texts hold none and stay, repeated rows stay or go
    together, whatever their ids; an empty benchmark takes nothing. Where the
    benchmark needs several shards, the rows that one leaves are written
    before the next searches them, so a task has one shard's index at a time.
    """
    waiting = None
    for sent in _shards(docs, items, settings):
        if waiting is not None:
            docs = stage(docs, "clean-documents")
            waiting.unpersist()
        docs = map_arrow(docs, lambda batches, sent=sent: _clean_of(batches, sent.value, settings), docs.schema)
        waiting = sent
    return docs


def op10_bm25_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Test items found in the whole ``documents`` table."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
