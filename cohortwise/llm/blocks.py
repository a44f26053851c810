"""Vector codes: codebooks of vector parts, learned on Hilbert-sorted blocks.

Vectors become integers and are cut into parts. The part vectors of each
position are sorted along a Hilbert curve and stored in flat blocks, each with
the box of its members (least and greatest component) and their sum. In every
round the distance of a codebook entry to a block lies between its distance to
the nearest and to the farthest point of the box; entries whose least distance
exceeds another one's greatest cannot win, and the rest is the block's
shortlist. A block with one entry on its list gives its stored sum without a
look at its members; the others compare members and shortlist exactly, on
integers. Sums of the parts by entry are all that leaves a task, and the
codebooks (``parts`` x ``entries`` rows) all that reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.store import Scratch, map_arrow, stage

LIMIT = 1 << 27  # components of at least this size could overflow sums of squares
EXACT = 1 << 53  # integers below this are exact as doubles


@dataclass(frozen=True)
class Settings:
    scale: int = 1024  # a component x becomes floor(scale * x)
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    block: int = 128  # part vectors in a block


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of ``points`` (rows of integers below ``2**bits``) on a Hilbert curve.

    The transposed form of the curve (Skilling, 2004): undo the turns of each
    level from the top bit down, Gray-encode, then interleave the bits.
    """
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(len(x)):
            turned = (x[i] & bit) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = x[0] ^ np.where(turned, low, swap)
            x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros(len(points), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> level) & 1, (1 << level) - 1, 0)
    key = np.zeros(len(points), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ flip) >> level) & 1)
    return key


def shortlists(lo: np.ndarray, hi: np.ndarray, book: np.ndarray) -> np.ndarray:
    """For each box (rows of ``lo``, ``hi``), which rows of ``book`` can be nearest to a point in it."""
    below, above = lo[:, None] - book[None], book[None] - hi[:, None]
    least = np.square(np.maximum(np.maximum(below, above), 0)).sum(2)
    most = np.square(np.maximum(np.abs(below), np.abs(above))).sum(2)
    return least <= most.min(1, keepdims=True)


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``book``, squared distance) nearest to each point, ties to the lower row; exact."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.float64 if 4 * most * most * max(1, points.shape[1]) < EXACT else np.int64
    p, b = points.astype(kind), book.astype(kind)
    distance = np.square(b).sum(1)[None] - 2 * (p @ b.T)
    best = distance.argmin(1)
    return best, (distance[np.arange(len(p)), best] + np.square(p).sum(1)).astype(np.int64)


@dataclass
class Blocks:
    """Blocks of one Arrow batch: members ``first[i] .. first[i + 1]`` belong to block i."""

    part: np.ndarray
    first: np.ndarray
    rows: np.ndarray
    values: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    sums: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, width: int) -> Blocks:
        def flat(name):
            return batch.column(name).flatten().to_numpy(zero_copy_only=False)

        first = np.concatenate([[0], np.cumsum(batch.column("n").to_numpy())])
        boxes = [flat(name).reshape(-1, width).astype(np.int64) for name in ("lo", "hi", "sums")]
        return cls(batch.column("part").to_numpy(), first, flat("members"), flat("parts_").reshape(-1, width), *boxes)

    def assigned(self, books: np.ndarray, unopened: bool) -> Iterator[tuple[int, int | np.ndarray, np.ndarray | None]]:
        """(block, entry or entries of its members, distances).

        With ``unopened`` a block whose shortlist has one entry yields that
        entry alone, and its members stay unread.
        """
        for part in np.unique(self.part):
            of = np.flatnonzero(self.part == part)
            for some in np.array_split(of, -(-len(of) // 32)):  # boxes x entries x width at a time
                able = shortlists(self.lo[some], self.hi[some], books[part])
                for i, can in zip(some.tolist(), able, strict=True):
                    entries = np.flatnonzero(can)
                    if unopened and len(entries) == 1:
                        yield i, int(entries[0]), None
                        continue
                    at, distance = nearest(self.values[self.first[i] : self.first[i + 1]], books[part][entries])
                    yield i, entries[at], distance


def _keyed(batches, parts: int, center: float, spread: float):
    """Rows (row, vec_id, label, vector) as one row a part, with its Hilbert key."""
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        vectors = batch.column("vector").flatten().to_numpy().reshape(n, -1)
        width = vectors.shape[1] // parts
        bits = max(1, 62 // width)
        levels = np.clip((vectors - center) / spread * (1 << bits) + (1 << (bits - 1)), 0, (1 << bits) - 1).astype(np.int64)
        for part in range(parts):
            at = slice(part * width, (part + 1) * width)
            flat = pa.array(np.ascontiguousarray(vectors[:, at]).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.full(n, part, np.int32)),
                    "key": hilbert_keys(levels[:, at][:, : min(width, 62)], bits),
                    "row": batch.column("row"),
                    "vector": lists,
                }
            )


def _blocked(batches, width: int, size: int):
    """Blocks of at most ``size`` neighbouring part vectors of one position."""
    for batch in batches:
        part = batch.column("part").to_numpy()
        rows = batch.column("row").to_numpy()
        vectors = batch.column("vector").flatten().to_numpy().reshape(-1, width)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        starts = [s for a, b in zip(cuts, cuts[1:], strict=False) for s in range(a, b, size)]
        if not starts:
            continue
        bounds = np.array([*starts, len(part)])
        wide = vectors.astype(np.int64)
        made = {"lo": np.minimum.reduceat(wide, starts), "hi": np.maximum.reduceat(wide, starts), "sums": np.add.reduceat(wide, starts)}
        out = {
            "part": part[starts],
            "n": np.diff(bounds).astype(np.int64),
            "members": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(rows)),
            "parts_": pa.ListArray.from_arrays(pa.array((bounds * width).astype(np.int32)), pa.array(vectors.ravel())),
        }
        for name, values in made.items():
            ends = np.arange(0, values.size + 1, width, dtype=np.int32)
            out[name] = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))
        yield pa.RecordBatch.from_pydict(out)


_BLOCK = "part int, n long, members array<long>, parts_ array<int>, lo array<long>, hi array<long>, sums array<long>"


def _sums_of(batches, books: np.ndarray):
    """Count and component sums of the members of each entry, one row an entry in use."""
    parts, entries, width = books.shape
    count, total = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
    for batch in batches:
        blocks = Blocks.of(batch, width)
        for i, entry, distance in blocks.assigned(books, unopened=True):
            part, first, end = blocks.part[i], blocks.first[i], blocks.first[i + 1]
            if distance is None:
                count[part, entry] += end - first
                total[part, entry] += blocks.sums[i]
            else:
                np.add.at(count[part], entry, 1)
                np.add.at(total[part], entry, blocks.values[first:end])
    part, entry = np.nonzero(count)
    rows = {"part": part.astype(np.int32), "entry": entry.astype(np.int32), "n": count[part, entry]}
    rows["sums"] = pa.array(list(total[part, entry]), pa.list_(pa.int64()))
    yield pa.RecordBatch.from_pydict(rows)


def _codes_of(batches, books: np.ndarray):
    for batch in batches:
        blocks = Blocks.of(batch, books.shape[2])
        rows, part, entries, distances = [], [], [], []
        for i, entry, distance in blocks.assigned(books, unopened=False):
            at = slice(blocks.first[i], blocks.first[i + 1])
            rows.append(blocks.rows[at])
            part.append(np.full(len(rows[-1]), blocks.part[i], np.int32))
            entries.append(entry)
            distances.append(distance)
        if rows:
            out = {"row": rows, "part": part, "entry": entries, "error": distances}
            out = {name: np.concatenate(values) for name, values in out.items()}
            out["entry"] = out["entry"].astype(np.int32)
            yield pa.RecordBatch.from_pydict(out)


def integer_vectors(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(row, vec_id, label, vector)`` of the usable rows of ``vectors(vec_id, embedding, label)``.

    ``vector`` holds ``floor(scale * x)`` as int, filled up with zeros to a
    multiple of ``parts``; ``row`` tells rows apart. Left out are null and
    empty vectors, those with a null or non-finite component or one whose
    integer has 2**27 or more, and those whose length is not that of the row
    with the smallest ``vec_id`` (nulls last, then the vector itself).
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    known = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), x.alias("x")).where("size(x) > 0")
    top = LIMIT / settings.scale
    sound = F.forall("x", lambda v: (v < top) & (v >= 1 / settings.scale - top))  # NaN is above every number, null is neither
    known = known.where(F.coalesce(sound, F.lit(False)))
    whole = F.transform("x", lambda v: F.floor(v * settings.scale).cast("int"))
    first = known.orderBy(F.col("vec_id").asc_nulls_last(), "x").select(F.size("x").alias("size")).first()
    size = first.size if first else settings.parts
    fill = -size % settings.parts
    if fill:
        whole = F.concat(whole, F.array_repeat(F.lit(0), fill))
    same = known.where(F.size("x") == size)
    return stage(same.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", whole.alias("vector")), "vector-integers")


def _first_books(kept: DataFrame, settings: Settings) -> np.ndarray:
    least = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(settings.entries).select("vector").collect()
    if not least:
        return np.zeros((settings.parts, 0, 0), np.int64)
    return np.array([r.vector for r in least], np.int64).reshape(len(least), settings.parts, -1).transpose(1, 0, 2)


def vector_blocks(kept: DataFrame, width: int, settings: Settings = Settings()) -> DataFrame:
    """Hilbert-sorted blocks of the parts of ``kept(row, vector)``.

    Equal keys are told apart by the row, so copies of one vector spread over
    as many partitions as they need.
    """
    flat = kept.select(F.explode("vector").alias("v")).agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd")).first()
    center, spread = flat.mean or 0.0, max(4.0 * (flat.sd or 0.0), 1.0)
    keyed = map_arrow(
        kept.select("row", "vector"), lambda b: _keyed(b, settings.parts, center, spread), "part int, key long, row long, vector array<int>"
    )
    sorted_ = keyed.repartitionByRange("part", "key", "row").sortWithinPartitions("part", "key", "row")
    return map_arrow(sorted_.drop("key"), lambda b: _blocked(b, width, settings.block), _BLOCK)


def learned_codes(kept: DataFrame, settings: Settings = Settings()) -> tuple[np.ndarray, DataFrame]:
    """Codebooks ``[part, entry, position]`` and ``(row, part, entry, error)`` of ``kept``.

    Each codebook starts as its part of the ``entries`` smallest ``vec_id``
    (fewer, if there are fewer rows; ties by the vector). ``rounds`` times
    every part goes to the nearest entry, ties to the lower index, and every
    entry that has parts becomes the floor of their mean by component. The
    codes are those of one more assignment.
    """
    context = kept.sparkSession.sparkContext
    books = _first_books(kept, settings)
    if not books.shape[1]:
        return books, kept.sparkSession.createDataFrame([], "row long, part int, entry int, error long")
    width = books.shape[2]
    with Scratch(kept.sparkSession) as scratch:
        blocks = scratch.stage(vector_blocks(kept, width, settings), "vector-blocks")
        for _ in range(settings.rounds):
            shared = context.broadcast(books)  # parts x entries x width, whatever the input
            sums = map_arrow(blocks, lambda b, s=shared: _sums_of(b, s.value), "part int, entry int, n long, sums array<long>")
            total = F.array(*[F.sum(F.col("sums")[i]) for i in range(width)])
            books = books.copy()
            for r in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), total.alias("sums")).collect():
                books[r.part, r.entry] = np.array(r.sums, np.int64) // r.n
            shared.unpersist()
        shared = context.broadcast(books)
        codes = map_arrow(blocks, lambda b: _codes_of(b, shared.value), "row long, part int, entry int, error long")
        return books, stage(codes, "vector-codes")


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per usable vector: ``vec_id``, ``code``, ``error``, ``label_error``, ``codebooks_sha256``.

    ``vectors`` needs ``vec_id``, ``embedding`` (numbers) and ``label``; other
    columns are ignored, whatever their names. ``code`` has two hexadecimal
    digits a part, ``error`` is the squared distance to the coded vector,
    ``label_error`` its sum over equal labels (nulls are one group). Which rows
    are usable, ``integer_vectors`` states. Repeated rows return repeated
    rows and count each; a null ``vec_id`` is coded like any other and comes
    last in the starting order; an empty table gives an empty result.
    """
    kept = integer_vectors(vectors, settings)
    books, codes = learned_codes(kept, settings)
    digits = [F.max(F.when(F.col("part") == p, F.lower(F.lpad(F.hex("entry"), 2, "0")))) for p in range(settings.parts)]
    by_row = codes.groupBy("row").agg(F.concat(*digits).alias("code"), F.sum("error").alias("error"))
    rows = stage(kept.select("row", "vec_id", "label").join(by_row, "row"), "vector-rows")
    by_label = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Codes of the whole ``embeddings`` table."""
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _oracle(settings: Settings = Settings()) -> str:
    """The rounds as one SQL statement, a pair of tables (assignment, codebook) each."""
    steps = [
        f"""e as (
  select row_number() over (order by vec_id nulls last, v) as k, vec_id, label, v
  from (
    select vec_id, label, list_transform(embedding, lambda x: cast(floor(cast(x as double) * {settings.scale}) as bigint)) as v
    from embeddings
    where len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding))),
p as (
  select k, part, v[part * (len(v) // {settings.parts}) + 1 : (part + 1) * (len(v) // {settings.parts})] as x
  from e, range({settings.parts}) as r(part)),
b0 as (select part, k - 1 as entry, x as c from p where k <= {settings.entries})"""
    ]
    for i in range(settings.rounds + 1):
        steps.append(
            f"""d{i} as materialized (
  select k, part, min(list_value(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), entry)) as best
  from p join b{i} using (part) group by k, part)"""
        )
        if i < settings.rounds:
            steps.append(
                f"""b{i + 1} as materialized (
  select part, entry, coalesce(any_value(fresh.c), any_value(b{i}.c)) as c
  from b{i} left join (
    select part, entry, list(cast(m as bigint) order by j) as c
    from (
      select part, best[2] as entry, j, floor(sum(x[j]) / count(*)) as m
      from d{i} join p using (k, part), range(1, 1025) as r(j) where j <= len(x) group by all)
    group by all) fresh using (part, entry) group by all)"""
            )
    last = settings.rounds
    return f"""with {", ".join(steps)},
h as (
  select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) as codebooks_sha256 from b{last}),
c as (
  select k, string_agg(printf('%02x', best[2]), '' order by part) as code, cast(sum(best[1]) as bigint) as error
  from d{last} group by k)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from e join c using (k), h"""


ORACLE_SQL = _oracle()
