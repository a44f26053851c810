"""N-gram Jaccard join by PartEnum signatures, and near-duplicate components.

A text's set holds its distinct word shingles. Sets fall into size bands whose
bounds grow by the inverse of the similarity, so a similar pair lies in one
band or in two neighbouring ones. For the pairs of a band group, similarity
bounds how many elements can differ (k). The element domain is cut into
partitions by a hash; k differing elements touch at most k of them, so with n
partitions at least n - k agree exactly. A signature is a hash of the set's
elements in an enumerated subset of the partitions (PartEnum): similar sets
share at least one, and every similar pair therefore meets in a bucket.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.llm import words as W
from cohortwise.llm.components import components
from cohortwise.llm.store import Scratch, map_arrow, stage

U = np.uint64
SHINGLE = 5
PERCENT = 80  # two texts link when 100 * intersection >= PERCENT * union
EXTRA = 0.15  # partitions beyond the k + 1 that the pigeonhole needs, as a share of k


@dataclass(frozen=True)
class Plan:
    """Signature scheme of one band group: ``parts`` partitions, subsets of ``take``."""

    k: int
    parts: int
    subsets: tuple[tuple[int, ...], ...]

    @property
    def single(self) -> bool:
        return len(self.subsets[0]) == 1


@functools.cache
def band_tops(percent: int, count: int = 160) -> np.ndarray:
    """Largest set size of each band; a similar larger set is at most one band up."""
    tops = [1]
    while len(tops) < count and tops[-1] < 1 << 40:
        tops.append(max(tops[-1] + 1, tops[-1] * 100 // percent))
    return np.array(tops, np.int64)


@functools.cache
def plan(group: int, percent: int) -> Plan:
    """Scheme for band group ``group``: bands 2g, 2g + 1 and, above them, 2g + 2.

    Pairs inside the top band belong to the next group, so the smaller set of a
    pair has at most ``top`` elements here. Two sets of sizes a and b that link
    differ in at most (a + b)(100 - p) / (100 + p) elements.
    """
    top = int(band_tops(percent)[2 * group + 1])
    k = (top + top * 100 // percent) * (100 - percent) // (100 + percent)
    if k <= 3:  # small sets: subsets of two partitions of k + 2 (one of one if k = 0)
        parts, take = (k + 2, 2) if k else (1, 1)
    else:
        parts, take = k + 1 + max(2, int(np.ceil(EXTRA * k))), 1
    return Plan(k, parts, tuple(itertools.combinations(range(parts), take)))


def shingle_sets(chunk: W.Chunk, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text of a chunk, with offsets.

    A text of fewer than ``size`` words, but some, has its whole word sequence
    as the only element; one without words has none.
    """
    hashes = chunk.hashes(fold=True)
    grams, first = W.windows(hashes, chunk.first, size)
    counts = chunk.counts()
    keep = np.ones(len(grams), bool)
    for i in range(chunk.n):
        a, b = first[i], first[i + 1]
        if b - a > 1:
            part = grams[a:b]
            part.sort()
            np.not_equal(part[1:], part[:-1], out=keep[a + 1 : b])
    short = np.flatnonzero((counts > 0) & (counts < size))
    kept = np.concatenate([[0], np.cumsum(keep)])[first]
    grams = grams[keep]
    if len(short):
        whole = np.zeros(len(short), U)
        with np.errstate(over="ignore"):
            for n in range(1, size):
                at = counts[short] == n
                for j in range(n):
                    whole[at] = whole[at] * U(W._STEP) + hashes[chunk.first[short[at]] + j]
                whole[at] = W.mix(whole[at] + U(n))
        grams = np.insert(grams, kept[short], whole)
        more = np.zeros(chunk.n + 1, np.int64)
        more[short + 1] = 1
        kept = kept + np.cumsum(more)
    return grams, kept


def set_prints(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each set; equal sets have equal ones."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, U), np.cumsum(W.mix(sets ^ U(0xA5A5A5A5A5A5A5A5)))])
        return W.mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(U) * U(W._STEP)).view(np.int64)


def signatures(sets: np.ndarray, first: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """PartEnum signatures of many sets: (signature, set index, need).

    ``need`` is the least number of signatures that a set shares with any
    partner in this band group: n - k agreeing partitions, less those of its
    own that are empty and therefore not emitted. A set with so many empty
    partitions that this bound would vanish emits the empty ones too, and its
    bound is 1: a partner that hides its empty partitions has fewer than n - k
    of them, so one that agrees is not empty.
    """
    sizes = np.diff(first)
    band = np.searchsorted(band_tops(percent), sizes)
    groups = [np.where(sizes > 0, band // 2, -1)]
    groups.append(np.where((sizes > 0) & (band % 2 == 0), band // 2 - 1, -1))
    for of in groups:
        for group in np.unique(of[of >= 0]):
            scheme = plan(int(group), percent)
            rows = np.flatnonzero(of == group)
            elements = sets[W.ranges(first[rows], sizes[rows])]
            owner = np.repeat(np.arange(len(rows)), sizes[rows])
            with np.errstate(over="ignore"):
                spread = W.mix(elements + U(group + 1))
                cell = ((spread >> U(32)) * U(scheme.parts)) >> U(32)
                cells = np.zeros(len(rows) * scheme.parts, U)
                np.add.at(cells, owner * scheme.parts + cell.astype(np.int64), W.mix(spread + U(7)))
                cells = cells.reshape(len(rows), scheme.parts)
                tag = W.mix(np.arange(len(scheme.subsets), dtype=U) + (U(group + 1) << U(32)))
                if scheme.single:
                    made = W.mix(cells + tag)
                    empty = cells == 0
                    spare = scheme.parts - scheme.k - empty.sum(axis=1)
                    emit = ~empty | (spare < 1)[:, None]
                    need = np.maximum(spare, 1)
                else:
                    made = np.empty((len(rows), len(scheme.subsets)), U)
                    for j, subset in enumerate(scheme.subsets):
                        total = np.zeros(len(rows), U)
                        for part in subset:
                            total = W.mix(total + cells[:, part] + U(part + 1))
                        made[:, j] = W.mix(total + tag[j])
                    emit = np.ones(made.shape, bool)
                    need = np.ones(len(rows), np.int64)
            row, _ = np.nonzero(emit)
            yield made[emit].view(np.int64), rows[row], need[row].astype(np.int32) + (np.int32(group) << 20)


def _prints_of(batches, size: int):
    for batch in batches:
        for chunk in W.chunks(batch.column("text")):
            sets, first = shingle_sets(chunk, size)
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id").slice(chunk.row, chunk.n), "n_shingles": np.diff(first), "print": set_prints(sets, first)}
            )


def _signatures_of(batches, size: int, percent: int):
    for batch in batches:
        for chunk in W.chunks(batch.column("text")):
            sets, first = shingle_sets(chunk, size)
            prints = set_prints(sets, first)
            _, one = np.unique(prints, return_index=True)  # one of equal sets is enough
            one = one[np.diff(first)[one] > 0]
            sizes = np.diff(first)[one]
            own = np.concatenate([[0], np.cumsum(sizes)])
            for signature, row, need in signatures(sets[W.ranges(first[one], sizes)], own, percent):
                yield pa.RecordBatch.from_pydict({"signature": signature, "print": prints[one][row], "need": need})


def _sets_of(batches, size: int):
    for batch in batches:
        for chunk in W.chunks(batch.column("text")):
            sets, first = shingle_sets(chunk, size)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(sets.view(np.int64)))
            yield pa.RecordBatch.from_pydict({"print": set_prints(sets, first), "elements": lists})


def jaccard_links(texts: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets, and links that connect the similar ones.

    ``texts(id, text)``; ids are long, texts may be null, empty or repeated.
    Returns ``members(id, n_shingles, print, rep)``: each row's class (``rep``
    is the smallest id with an equal set), and ``links(a, b)``: pairs of class
    fingerprints that link. The links hold a pair for each class that links to
    a centre of its buckets, and all further links between classes that these
    do not connect already, so their components are those of all links.
    Copies and members of one component are not expanded into pairs.
    """
    members = map_arrow(texts, lambda batches: _prints_of(batches, size), "id long, n_shingles long, print long")
    members = stage(members, "jaccard-members")
    reps = members.groupBy("print").agg(F.min("id").alias("rep"), F.first("n_shingles").alias("m"))

    with Scratch(texts.sparkSession) as scratch:
        # Buckets: the signatures that two classes share.
        rows = map_arrow(texts, lambda batches: _signatures_of(batches, size, percent), "signature long, print long, need int")
        bucket = Window.partitionBy("signature")
        shared = rows.withColumns({"lo": F.min("print").over(bucket), "hi": F.max("print").over(bucket)}).where("lo <> hi")
        shared = scratch.stage(shared.select("signature", "print", "need"), "jaccard-buckets")
        # A class that shares fewer signatures than any partner would is out.
        able = (
            shared.groupBy("print", "need")
            .agg(F.count_distinct("signature").alias("n"))
            .where("n >= need & 1048575")
            .select("print")
            .distinct()
        )
        able = scratch.stage(able, "jaccard-able")
        ids = able.join(reps, "print").select(F.col("rep").alias("id"), F.lit(True).alias("take")).distinct()
        sets = map_arrow(
            texts.join(ids, "id").select("id", "text"), lambda batches: _sets_of(batches, size), "print long, elements array<long>"
        )
        # An id may stand on several texts, and a text on several rows.
        sets = scratch.stage(sets.join(able, "print", "left_semi").dropDuplicates(["print"]), "jaccard-sets")

        # Elements that no other candidate holds can be in no intersection.
        held = sets.select("print", F.explode("elements").alias("element"))
        common = held.groupBy("element").agg(F.count("*").alias("n")).where("n > 1").select("element")
        part = held.join(common, "element").groupBy("print").agg(F.count("*").alias("s"))
        info = sets.select("print", F.size("elements").alias("m")).join(part, "print").where(F.expr(f"100 * s >= {percent} * m"))
        info = scratch.stage(info, "jaccard-info")

        # First each class against the best connected one of each of its buckets.
        live = shared.select("signature", "print").distinct().join(info, "print")
        rank = F.struct((F.col("s") / F.col("m")).alias("share"), (-F.col("print")).alias("p"))
        best = Window.partitionBy("signature")
        live = live.withColumn("top", F.max(rank).over(best)).withColumn("center", -F.col("top.p"))
        star = live.where("center <> print").select(F.col("center").alias("c"), "print").distinct()
        arms = scratch.stage(_arms(star, sets, percent), "jaccard-arms")
        linked = arms.where("linked").select(F.col("c").alias("a"), F.col("print").alias("b"))

        # Then what these links leave apart.
        labels = scratch.stage(components(linked), "jaccard-labels")
        rest = _verified(_remaining(arms, labels, percent, scratch), sets, percent)
        links = stage(linked.unionByName(rest), "jaccard-links")
    return members.join(reps.select("print", "rep"), "print"), links


def _arms(star: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each class against its centre: sizes, the elements only one has, and if they link."""
    own = sets.select("print", F.col("elements").alias("e"))
    center = sets.select(F.col("print").alias("c"), F.col("elements").alias("ec"))
    differ = F.concat(F.array_except("e", "ec"), F.array_except("ec", "e"))
    arms = star.join(own, "print").join(center, "c")
    arms = arms.select("c", "print", F.size("e").alias("m"), F.size("ec").alias("mc"), differ.alias("differ"))
    arms = arms.withColumn("d", F.size("differ"))
    return arms.withColumn("linked", F.expr(f"{100 + percent} * d <= {100 - percent} * (m + mc)"))


def _remaining(arms: DataFrame, labels: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Candidate links ``(a, b)`` between classes that the first links leave apart.

    Every candidate pair of a bucket has the bucket's centre c in common. With
    D(x) the elements that only one of x and c has, x and y differ in
    ``|D(x)| + |D(y)| - 2 |D(x) and D(y)|`` elements, so a link needs
    ``overlap >= (|D(x)| + |D(y)| - k) / 2`` with ``k = (100 - p)(m(x) + m(y)) /
    (100 + p)``. That is at least 1 unless both link to c. It is an overlap
    join of the D sets, which prefix filtering solves: in order of frequency,
    rarest first, the first ``|D| - overlap + 1`` elements of both must meet.
    The rows that are joined take the least overlap with any partner, and the
    join holds the places of the common element against that of the pair.
    """
    share = F.lit((100 - percent) / (100 + percent))
    of = labels.select(F.col("node").alias("print"), "label")
    rows = arms.join(of, "print", "left").withColumn("label", F.coalesce("label", "print"))
    centers = labels.select(F.col("node").alias("c"), F.col("label").alias("lc"))
    rows = rows.join(centers, "c", "left").withColumn("lc", F.coalesce("lc", "c"))
    mixed = rows.groupBy("c").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.first("lc").alias("lc"))
    mixed = mixed.where("lo <> hi").select("c")
    # The least overlap with any partner: one that links to c can only lack a
    # link to a class that does not; otherwise |D(y)| >= |D(x)| - k, and y has
    # at most m(x) * 100 / p elements.
    most = F.floor(share * F.col("m") * (1 + 100 / percent) + 1e-9)
    near = F.floor((F.col("d") - share * (F.col("m") - F.col("mc"))) / 2)
    need = F.greatest(F.lit(1), F.when(F.col("linked"), near).otherwise(F.col("d") - most))
    rows = rows.join(mixed, "c", "left_semi").withColumn("take", (F.col("d") - need + 1).cast("int")).where("take > 0")
    rows = scratch.stage(rows.select("c", "print", "label", "m", "d", "take", "differ"), "jaccard-apart")

    held = rows.select("c", "print", F.explode("differ").alias("e"))
    often = held.groupBy("c", "e").agg(F.count("*").alias("n")).where("n > 1")
    sorted_ = held.join(often, ["c", "e"]).groupBy("c", "print").agg(F.sort_array(F.collect_list(F.struct("n", "e"))).alias("es"))
    # Elements that one class alone has come first in the order and meet nothing.
    left = F.col("take") - (F.col("d") - F.size("es"))
    prefix = rows.drop("differ").join(sorted_, ["c", "print"])
    prefix = prefix.withColumns({"single": F.col("d") - F.size("es"), "es": F.slice("es", 1, F.greatest(left, F.lit(0)))})
    prefix = prefix.select("c", "print", "label", "m", "d", "single", F.posexplode("es.e").alias("i", "e"))
    prefix = prefix.withColumn("left", F.expr("d - single - i")).drop("single", "i")  # elements from this one on
    prefix = scratch.stage(prefix, "jaccard-prefix")
    x, y = prefix.alias("x"), prefix.alias("y")
    fits = F.expr(
        "x.c = y.c and x.e = y.e and x.label < y.label"
        f" and 100 * least(x.m, y.m) >= {percent} * greatest(x.m, y.m)"
        f" and {100 + percent} * (x.d + y.d) - {100 - percent} * (x.m + y.m) <= {2 * (100 + percent)} * least(x.left, y.left)"
    )
    return x.join(y, fits).select(F.col("x.print").alias("a"), F.col("y.print").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets really are similar, by exact intersection."""
    left = sets.select(F.col("print").alias("a"), F.col("elements").alias("ea"))
    right = sets.select(F.col("print").alias("b"), F.col("elements").alias("eb"))
    both = F.size(F.array_intersect("ea", "eb"))
    either = F.size("ea") + F.size("eb") - both
    return pairs.join(right, "b").join(left, "a").where(100 * both >= percent * either).select("a", "b")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored,
    whatever their names. Null, empty or blank texts have no shingles, link
    with nothing and are their own component. Repeated rows return repeated
    rows; rows that share a ``doc_id`` but not the text share no component
    unless they link. A null ``doc_id`` keeps its row, with a null component
    if nothing with an id is in it. An empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    members, links = jaccard_links(texts, size, percent)
    members = stage(members, "jaccard-classes")
    labels = components(links).withColumnRenamed("node", "print")
    lone = F.col("n_shingles") == 0
    # The smallest document of each component, over the classes it joins.
    classes = members.where(~lone).groupBy("print").agg(F.min("rep").alias("rep")).join(labels, "print", "left")
    classes = classes.withColumn("label", F.coalesce("label", "print"))
    least = classes.groupBy("label").agg(F.min("rep").alias("component_id"))
    of = classes.join(least, "label").select("print", "component_id")
    with_words = members.where(~lone).join(of, "print").select("id", "n_shingles", "component_id")
    without = members.where(lone).select("id", "n_shingles", F.col("id").alias("component_id"))
    return with_words.unionByName(without).withColumnRenamed("id", "doc_id")


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, of one document a group.

    The smallest ``doc_id`` of each component stays; repeated rows of one id
    and text count as one document. Rows without words, or without an id, are
    in no group and stay. Other columns may have any name.
    """
    kept = near_duplicates(docs, size, percent).where("doc_id = component_id").select(F.col("doc_id").alias("id")).distinct()
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("print"), whole.alias("row"))
    rows = rows.where("id is not null").join(kept, "id", "left_semi").dropDuplicates(["id", "print"])
    rows = rows.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
    return rows.unionByName(docs.where("doc_id is null"))


def op3_jaccard_components(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of the whole ``documents`` table."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
