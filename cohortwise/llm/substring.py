"""Substring deduplication on a compacted de Bruijn graph of word windows.

An edge of the graph is a window of ``WINDOW`` words, found by its 64-bit hash, that
starts in at least two documents; its source is its first place (smallest
document, then position). Two edges that follow each other belong to one path when neither
branches: every occurrence of the first is followed by the second, and every
occurrence of the second preceded by the first. All edges of a path then have
the same occurrences, one word apart, so a path is stored once, by its first
edge and length, and found again in a document by its first edge alone.

Only windows that can repeat become edges. The smallest hash among the
``ANCHOR``-word grams inside a window is its anchor; equal windows have equal
anchors, so a window whose anchor lies in one document only is left out.

Hashes only find the spans. The words that stand at a span's place and those
at its source are then read again and compared by a 128-bit digest of the
words themselves: only places that agree in it count as one passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortwise.llm import words as W
from cohortwise.llm.store import Scratch, map_arrow, stage

U = np.uint64
WINDOW = 13
ANCHOR = 4
BUFFER = 1 << 20  # windows or anchors that a task groups before it sends them


def _window_anchors(hashes: np.ndarray, first: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of every window: (values, offsets by text)."""
    grams, gfirst = W.windows(hashes, first, anchor)
    span = window - anchor + 1
    counts = np.maximum(np.diff(gfirst) - span + 1, 0)
    n = len(grams) - span + 1
    offsets = np.concatenate([[0], np.cumsum(counts)])
    if n <= 0:
        return np.zeros(0, U), offsets
    least = grams[:n].copy()
    for j in range(1, span):
        np.minimum(least, grams[j : j + n], out=least)
    return least[W.ranges(gfirst[:-1], counts)], offsets


def _grouped(keys: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """One row per anchor: the smallest id, and the others if any."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    keys, ids = keys[new], ids[new]
    head = np.ones(len(keys), bool)
    head[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(head)
    last = np.append(at[1:], len(keys)) - 1
    rest = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(last - at)]).astype(np.int32)), pa.array(ids[~head]), mask=pa.array(last == at)
    )
    return pa.RecordBatch.from_pydict({"anchor": keys[at].view(np.int64), "lo": ids[at], "rest": rest})


def _anchors_of(batches, window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    keys, ids, held = [], [], 0
    for batch in batches:
        docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for chunk in W.chunks(batch.column("text")):
            least, offsets = _window_anchors(chunk.hashes(fold=False), chunk.first, window, anchor)
            if not len(least):
                continue
            owner = np.repeat(docs[chunk.row : chunk.row + chunk.n], np.diff(offsets))
            new = np.ones(len(least), bool)  # neighbouring windows often share their anchor
            new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
            keys.append(least[new])
            ids.append(owner[new].astype(np.int64))
            held += len(keys[-1])
            if held >= BUFFER:
                yield _grouped(np.concatenate(keys), np.concatenate(ids))
                keys, ids, held = [], [], 0
    if keys:
        yield _grouped(np.concatenate(keys), np.concatenate(ids))


_PLACE = pa.struct([("doc_id", pa.int64()), ("part", pa.int32()), ("pos", pa.int32())])


def _run_rows(runs: dict[bytes, list[tuple[int, int, int]]]) -> pa.RecordBatch:
    """One row per run of edges with one anchor: its first place, and the others if any.

    A run's key holds the anchor, the edge before it and the one after it (0
    if there is none) and its own edges.
    """
    heads = np.array([np.frombuffer(key, np.int64, 3) for key in runs]).reshape(-1, 3)
    edges = [np.frombuffer(key, np.int64)[3:] for key in runs]
    places = [sorted(p) for p in runs.values()]
    first = np.array([p[0] for p in places], np.int64).reshape(-1, 3)
    others = [tuple(zip(*p[1:], strict=True)) or ((), (), ()) for p in places]
    flat = [np.array([v for o in others for v in o[c]], np.int64) for c in range(3)]
    members = pa.StructArray.from_arrays(
        [pa.array(flat[0]), pa.array(flat[1].astype(np.int32)), pa.array(flat[2].astype(np.int32))], fields=list(_PLACE)
    )
    more = np.array([len(p) - 1 for p in places])
    rest = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(more)]).astype(np.int32)), members, mask=pa.array(more == 0))
    return pa.RecordBatch.from_pydict(
        {
            "anchor": heads[:, 0],
            "doc_id": first[:, 0],
            "part": first[:, 1].astype(np.int32),
            "pos": first[:, 2].astype(np.int32),
            "before": pa.array(heads[:, 1], mask=heads[:, 1] == 0),
            "after": pa.array(heads[:, 2], mask=heads[:, 2] == 0),
            "edges": pa.array(edges, pa.list_(pa.int64())),
            "rest": rest,
        }
    )


_RUN = (
    "anchor long, doc_id long, part int, pos int, before long, after long, edges array<long>,"
    " rest array<struct<doc_id: long, part: int, pos: int>>"
)


def _runs_of(batches, window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    runs: dict[bytes, list[tuple[int, int, int]]] = {}
    held = 0
    for batch in batches:
        docs = batch.column("doc_id").to_numpy()
        parts = batch.column("part").to_numpy()
        lists = batch.column("anchors")
        bounds = lists.offsets.to_numpy()
        values = lists.values.to_numpy().view(U)
        for chunk in W.chunks(batch.column("text")):
            hashes = chunk.hashes(fold=False)
            least, offsets = _window_anchors(hashes, chunk.first, window, anchor)
            if not len(least):
                continue
            able = np.zeros(len(least), bool)
            for i in range(chunk.n):
                a, b = offsets[i], offsets[i + 1]
                if a < b:
                    able[a:b] = np.isin(least[a:b], values[bounds[chunk.row + i] : bounds[chunk.row + i + 1]])
            if not able.any():
                continue
            edges = W.windows(hashes, chunk.first, window)[0].view(np.int64)
            near = np.zeros(len(edges) + 2, np.int64)  # the edge at each place, 0 where none can repeat
            near[1:-1] = np.where(able, edges, 0)
            row = np.repeat(np.arange(chunk.n), np.diff(offsets))
            new = np.ones(len(able), bool)
            new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
            begin = np.flatnonzero(new & able)
            ends = np.append(np.flatnonzero(new), len(able))
            end = ends[np.searchsorted(ends, begin, "right")]
            of = row[begin]
            before = np.where(begin > offsets[of], near[begin], 0)
            after = np.where(end < offsets[of + 1], near[end + 1], 0)
            heads = np.column_stack([least[begin].view(np.int64), before, after])
            doc, part, pos = docs[chunk.row + of].tolist(), parts[chunk.row + of].tolist(), (begin - offsets[of]).tolist()
            for j, (a, b) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
                runs.setdefault(heads[j].tobytes() + edges[a:b].tobytes(), []).append((doc[j], part[j], pos[j]))
            held += len(begin)
            if held >= BUFFER >> 2:
                yield _run_rows(runs)
                runs, held = {}, 0
    if runs:
        yield _run_rows(runs)


def _kept_of(batches, window: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("spans")
        some = ~lists.is_null().to_numpy(zero_copy_only=False)
        bounds = lists.offsets.to_numpy()
        begin, length = (x.to_numpy(zero_copy_only=False) for x in lists.values.flatten())
        for chunk in W.chunks(batch.column("text")):
            counts = chunk.counts()
            removed = np.zeros(chunk.n, np.int64)
            prints, texts = [], []
            for i in range(chunk.n):
                text, row = chunk.text(i), chunk.row + i
                if not some[row]:
                    prints.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
                    if with_text:
                        texts.append(text)
                    continue
                step = np.zeros(counts[i] + 1, np.int64)
                at = slice(bounds[row], bounds[row + 1])
                np.add.at(step, begin[at], 1)
                np.add.at(step, begin[at] + length[at] + window - 1, -1)
                gone = np.cumsum(step[:-1]) > 0
                removed[i] = gone.sum()
                prints.append(hashlib.sha256(b" ".join(w for w, g in zip(text.split(), gone, strict=True) if not g)).hexdigest())
                if with_text:
                    texts.append(_without(chunk, i, gone))
            out = {
                "doc_id": batch.column("doc_id").slice(chunk.row, chunk.n),
                "part": batch.column("part").slice(chunk.row, chunk.n),
                "n_words": counts,
                "n_removed": removed,
                "kept_sha256": prints,
            }
            if with_text:
                known = batch.column("text").slice(chunk.row, chunk.n).is_valid()
                out["kept_text"] = pa.array([t.decode() if k else None for t, k in zip(texts, known.to_pylist(), strict=True)], pa.string())
                out["rest"] = batch.column("rest").slice(chunk.row, chunk.n)
            yield pa.RecordBatch.from_pydict(out)


def _without(chunk: W.Chunk, i: int, gone: np.ndarray) -> bytes:
    """Text i without the words ``gone`` and the white space after each."""
    base, words = chunk.offsets[i], slice(chunk.first[i], chunk.first[i + 1])
    starts = np.append(chunk.starts[words] - base, chunk.offsets[i + 1] - base)
    text = chunk.text(i)
    cuts = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    pieces, at = [], 0
    for a, b in zip(cuts[::2], cuts[1::2], strict=True):
        pieces.append(text[at : starts[a]])
        at = starts[b]
    return b"".join([*pieces, text[at:]])


def repeated_paths(
    texts: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, write: Callable[[DataFrame, str], DataFrame] = stage
) -> DataFrame:
    """Occurrences of repeated spans, one row per compacted path and place.

    ``texts(doc_id, part, text)``: ``part`` (int) tells rows of one document
    apart. Returns ``(doc_id, part, pos, length, src_doc, src_part, src_pos)``:
    the ``length`` windows of a document from word ``pos`` on are those of the
    path that starts in the source at ``src_pos``. Each window that starts in
    two or more documents lies in exactly one path of each of its places.
    ``write`` keeps the segments that the result reads.
    """
    texts = texts.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    anchors = map_arrow(
        texts.select("doc_id", "text"), lambda batches: _anchors_of(batches, window, anchor), "anchor long, lo long, rest array<long>"
    )
    of = Window.partitionBy("anchor")
    most = F.coalesce(F.element_at("rest", -1), "lo")
    shared = anchors.withColumns({"least": F.min("lo").over(of), "most": F.max(most).over(of)}).where("least <> most")
    none = F.array().cast("array<long>")
    shared = shared.select("anchor", F.explode(F.concat(F.array("lo"), F.coalesce("rest", none))).alias("doc_id"))
    lists = shared.groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    runs = map_arrow(texts.join(lists, "doc_id"), lambda batches: _runs_of(batches, window, anchor), _RUN)

    # Equal windows have equal anchors, so one shuffle brings all occurrences
    # of every edge together.
    runs = runs.repartition("anchor").withColumn("run", F.monotonically_increasing_id())
    edges = runs.select("*", F.posexplode("edges").alias("j", "edge"))
    edges = edges.withColumns(
        {
            "prv": F.when(F.col("j") > 0, F.get("edges", F.col("j") - 1)).otherwise(F.col("before")),
            "nxt": F.when(F.col("j") < F.size("edges") - 1, F.get("edges", F.col("j") + 1)).otherwise(F.col("after")),
            "most": F.coalesce(F.element_at("rest", -1)["doc_id"], "doc_id"),
        }
    ).drop("edges", "before", "after")
    of = Window.partitionBy("anchor", "edge")
    n = F.count("*").over(of)
    edges = edges.withColumns(
        {
            "src": F.min(F.struct("doc_id", "part", (F.col("pos") + F.col("j")).alias("pos"))).over(of),
            "last": F.max("most").over(of),
            "fwd": (F.count("nxt").over(of) == n) & (F.min("nxt").over(of) == F.max("nxt").over(of)),
            "back": (F.count("prv").over(of) == n) & (F.min("prv").over(of) == F.max("prv").over(of)),
        }
    ).where("src.doc_id <> last")
    # Compaction inside a run: edges that follow each other without a branch.
    along = Window.partitionBy("anchor", "run").orderBy("j")
    follows = (F.lag("j").over(along) == F.col("j") - 1) & F.lag("fwd").over(along) & F.col("back")
    edges = edges.withColumn("head", ~F.coalesce(follows, F.lit(False)))
    edges = edges.withColumn("seg", F.sum(F.col("head").cast("int")).over(along))
    segments = edges.groupBy("anchor", "run", "seg").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "part", "pos", "rest")],
        F.min(F.struct("j", "src", "back")).alias("a"),
        F.max(F.struct("j", "fwd")).alias("b"),
    )
    segments = segments.select(
        "doc_id", "part", "pos", "rest", F.col("a.j").alias("j"), (F.col("b.j") - F.col("a.j") + 1).alias("length"), "a.src", "a.back", "b.fwd"
    )
    segments = write(segments, "substring-segments")

    # Compaction of whole paths: each segment joins the one that follows it in
    # its source, if neither branches there.
    owned = segments.where("src.doc_id = doc_id and src.part = part and src.pos = pos + j")
    owned = owned.select("src", "length", "back", "fwd").distinct()  # a repeated row has the same ones
    ends = owned.where("fwd").select(F.struct("src.doc_id", "src.part", (F.col("src.pos") + F.col("length")).alias("pos")).alias("src"), F.lit(True).alias("led"))
    owned = owned.join(ends, "src", "left").withColumn("head", ~(F.coalesce("led", F.lit(False)) & F.col("back")))
    along = Window.partitionBy("src.doc_id", "src.part").orderBy("src.pos")
    owned = owned.withColumn("path", F.sum(F.col("head").cast("int")).over(along))
    paths = owned.groupBy("src.doc_id", "src.part", "path").agg(F.min("src").alias("src"), F.sum("length").cast("int").alias("whole"))

    # A path's places are those of its first segment.
    places = segments.join(paths.select("src", "whole"), "src")
    none = F.array().cast("array<struct<doc_id: long, part: int, pos: int>>")
    at = F.explode(F.concat(F.array(F.struct("doc_id", "part", "pos")), F.coalesce("rest", none)))
    places = places.select(at.alias("at"), "j", "whole", "src")
    return places.select(
        "at.doc_id",
        "at.part",
        (F.col("at.pos") + F.col("j")).alias("pos"),
        F.col("whole").alias("length"),
        F.col("src.doc_id").alias("src_doc"),
        F.col("src.part").alias("src_part"),
        F.col("src.pos").alias("src_pos"),
    )


_SPAN = "doc_id long, part int, pos int, length int, src_doc long, src_part int, src_pos int"


def _words_at(batches, window: int) -> Iterator[pa.RecordBatch]:
    """The places of each text's spans, with a digest of the words that stand there."""
    names = [field.split()[0] for field in _SPAN.split(", ")][2:]
    for batch in batches:
        places = batch.column("places")
        bounds = places.offsets.to_numpy()
        fields = dict(zip(names, (x.to_numpy(zero_copy_only=False) for x in places.values.flatten()), strict=True))
        for chunk in W.chunks(batch.column("text")):
            rows, digests = [], []
            for i in range(chunk.n):
                row = chunk.row + i
                text, base, of = memoryview(chunk.data)[chunk.offsets[i] : chunk.offsets[i + 1]], chunk.offsets[i], chunk.first[i]
                for at in range(bounds[row], bounds[row + 1]):
                    begin = of + fields["pos"][at]
                    end = begin + fields["length"][at] + window - 1
                    span = text[chunk.starts[begin] - base : chunk.ends[end - 1] - base].tobytes()
                    digests.append(hashlib.blake2b(b" ".join(span.split()), digest_size=16).digest())
                    rows.append(at)
            counts = np.diff(bounds)[chunk.row : chunk.row + chunk.n]
            owner = pa.array(np.repeat(np.arange(chunk.row, chunk.row + chunk.n), counts))
            out = {name: batch.column(name).take(owner) for name in ("doc_id", "part")}
            out |= {name: pa.array(values[rows].astype(np.int64 if name == "src_doc" else np.int32)) for name, values in fields.items()}
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            out |= {"words1": pa.array(halves[:, 0]), "words2": pa.array(halves[:, 1])}
            yield pa.RecordBatch.from_pydict(out)


def verified_places(texts: DataFrame, places: DataFrame, window: int = WINDOW) -> DataFrame:
    """``places`` with ``first``: the smallest document that has the same words at a place of the same path.

    ``places`` are those of ``repeated_paths`` over ``texts``. The words at
    each place and at its source are read from the texts and compared by a
    128-bit digest, summed up by path: where all places of a path agree, its
    source is the first. Only paths on which they differ, spans that agree in
    their hashes alone, are taken apart by their words.
    """
    span = F.struct("pos", "length", "src_doc", "src_part", "src_pos")
    lists = places.groupBy("doc_id", "part").agg(F.collect_set(span).alias("places"))
    found = map_arrow(texts.join(lists, ["doc_id", "part"]), lambda b: _words_at(b, window), _SPAN + ", words1 long, words2 long")
    found = stage(found, "substring-words")
    source, words = ["src_doc", "src_part", "src_pos"], ["words1", "words2"]
    ends = [f(w).alias(f"{w}_{name}") for w in words for name, f in (("lo", F.min), ("hi", F.max))]
    apart = found.groupBy(*source).agg(*ends).where("words1_lo <> words1_hi or words2_lo <> words2_hi").select(*source)
    apart = stage(apart, "substring-apart")
    if apart.isEmpty():
        return found.withColumn("first", F.col("src_doc"))
    agreed = found.join(apart, source, "left_anti").withColumn("first", F.col("src_doc"))
    others = found.join(apart, source, "left_semi")
    first = others.groupBy(*source, *words).agg(F.min("doc_id").alias("first"))
    return agreed.unionByName(others.join(first, source + words).select(*agreed.columns))


def _spans(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """By row of ``texts``, the spans that an earlier document has."""
    with Scratch(texts.sparkSession) as scratch:
        places = scratch.stage(repeated_paths(texts, window, anchor, scratch.stage), "substring-places")
        scratch.release()
        spans = verified_places(texts, places, window).where("first < doc_id")
        return stage(
            spans.groupBy("doc_id", "part").agg(F.collect_set(F.struct("pos", "length")).alias("spans")), "substring-spans"
        )


_DIGEST = "doc_id long, part int, n_words long, n_removed long, kept_sha256 string"


def repeat_digests(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """What is left of each text without the words that earlier documents have.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored.
    Every word covered by a window that also starts in a document with a
    smaller id goes. Returns one row per input row: ``doc_id``, ``part`` (a
    hash of the text), ``n_words``, ``n_removed`` and ``kept_sha256`` (of the
    kept words joined by one space). A null or empty text has no words.
    Documents compare by ``doc_id``, so repeated rows of one id keep all their
    words, and a null id neither loses words nor is a source.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash("text").alias("part"), "text")
    spans = _spans(texts, window, anchor)
    return map_arrow(texts.join(spans, ["doc_id", "part"], "left"), lambda b: _kept_of(b, window, False), _DIGEST)


def drop_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``docs``, with all its columns, but ``text`` without the repeated words.

    The words that ``repeat_digests`` removes go, with the white space after
    each; the rest of a text stays as it is, and a null text stays null.
    """
    names = docs.columns
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.hash("text").alias("part"),
        "text",
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names) if c != "text"], F.lit(0).alias("none")).alias("rest"),
    )
    spans = _spans(texts.drop("rest"), window, anchor)
    schema = StructType.fromDDL(_DIGEST + ", kept_text string").add("rest", texts.schema["rest"].dataType)
    kept = map_arrow(texts.join(spans, ["doc_id", "part"], "left"), lambda b: _kept_of(b, window, True), schema)
    return kept.select(*[(F.col("kept_text") if c == "text" else F.col(f"rest.c{i}")).alias(c) for i, c in enumerate(names)])


def op9_debruijn_dedup(spark, sf_dir: str) -> DataFrame:
    """Substring deduplication of the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return repeat_digests(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
