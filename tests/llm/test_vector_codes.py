"""Vector codes against plain rounds over all pairs of parts and entries."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from cohortwise.llm import blocks

SCHEMA = "vec_id long, embedding array<float>, label int, row int, part int, code string"


def plain(rows, settings):
    """(vec_id, code, error, label_error, digest) in whole numbers, without blocks."""
    usable = []
    for vec_id, vector, label, *_ in rows:
        if vector and all(v is not None and math.isfinite(v) and abs(math.floor(v * settings.scale)) < blocks.LIMIT for v in vector):
            usable.append((vec_id, [math.floor(np.float32(v).item() * settings.scale) for v in vector], label))
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not usable:
        return []
    size = len(usable[0][1])
    usable = [(i, v + [0] * (-size % settings.parts), label) for i, v, label in usable if len(v) == size]
    width = len(usable[0][1]) // settings.parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for _, v, _ in usable] for p in range(settings.parts)]
    books = [part[: settings.entries] for part in cut]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(settings.rounds):
        for p, part in enumerate(cut):
            of = defaultdict(list)
            for x in part:
                of[nearest(x, books[p])[1]].append(x)
            books[p] = [tuple(sum(c) // len(of[e]) for c in zip(*of[e], strict=True)) if e in of else c for e, c in enumerate(books[p])]
    best = [[nearest(x, books[p]) for x in part] for p, part in enumerate(cut)]
    digest = hashlib.sha256(",".join(str(v) for book in books for c in book for v in c).encode()).hexdigest()
    error = [sum(best[p][i][0] for p in range(settings.parts)) for i in range(len(usable))]
    by_label = defaultdict(int)
    for (_, _, label), e in zip(usable, error, strict=True):
        by_label[label] += e
    return [
        (vec_id, "".join(f"{best[p][i][1]:02x}" for p in range(settings.parts)), error[i], by_label[label], digest)
        for i, (vec_id, _, label) in enumerate(usable)
    ]


def table(n, dims, seed, scale=0.2):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, scale) for _ in range(dims)] for _ in range(5)]
    rows = []
    for i in range(n):
        center = rng.choice(centers)
        rows.append((i * 3, [c + rng.gauss(0, scale / 4) for c in center], rng.choice([0, 1, 2, None]), 1, 2, "c"))
    return rows


def held(spark, rows, settings):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = [tuple(r) for r in blocks.vector_codes(frame, settings).collect()]
    return sorted(found, key=str), sorted(plain(rows, settings), key=str)


ODD = [
    (None, [0.1] * 16, 1),
    (2, None, 1),
    (4, [], 1),
    (5, [0.1] * 15 + [None], 1),
    (7, [0.1] * 15 + [float("nan")], 1),
    (8, [0.1] * 15 + [float("-inf")], 1),
    (10, [0.1] * 15 + [3e38], 1),
    (11, [0.1] * 12, 1),
    (13, [-0.0004882] * 16, None),
]


@pytest.mark.parametrize("entries,block", [(8, 4), (16, 128), (256, 3)])
def test_against_plain_rounds(spark, entries, block):
    """Clustered vectors, a third of them one vector, ties, repeated rows and unusable ones."""
    rows = table(150, 16, entries) + [(1000 + i, [0.25] * 16, 3, 0, 0, "") for i in range(70)]
    rows += [(*r, 1, 2, "c") for r in ODD] + rows[:5]
    found, want = held(spark, rows, blocks.Settings(entries=entries, block=block))
    assert found == want


def test_large_components_stay_exact(spark):
    rows = [(i, [x * 40_000 for x in v], label, 0, 0, "") for i, v, label, *_ in table(80, 8, 1, 0.9)]
    found, want = held(spark, rows, blocks.Settings(entries=6, block=5))
    assert found == want
    most = max(abs(x) * 1024 for _, v, *_ in rows for x in v)
    assert 4 * most * most * 2 > blocks.EXACT  # more than doubles hold


def test_widths_that_parts_do_not_divide(spark):
    found, want = held(spark, table(60, 6, 2), blocks.Settings(entries=5, block=7))
    assert found == want


def test_fewer_rows_than_entries_and_none(spark):
    found, want = held(spark, table(7, 64, 3), blocks.Settings())
    assert found == want and all(r[2] == 0 for r in found)
    assert blocks.vector_codes(spark.createDataFrame([], SCHEMA)).collect() == []
    assert blocks.vector_codes(spark.createDataFrame([(1, None, 1, 1, 1, "")], SCHEMA)).collect() == []


def test_shortlists_keep_every_nearest_entry():
    rng = np.random.default_rng(4)
    points, book = rng.integers(-50, 50, (40, 5)), rng.integers(-50, 50, (30, 5))
    points = points // 8 + np.repeat(rng.integers(-50, 50, (8, 5)), 5, axis=0)  # five near each other
    lo, hi = points.reshape(8, 5, 5).min(1), points.reshape(8, 5, 5).max(1)
    able = blocks.shortlists(lo, hi, book)
    best, distance = blocks.nearest(points, book)
    assert able[np.arange(40) // 5, best].all() and not able.all()
    assert (distance == np.square(points - book[best]).sum(1)).all()


def test_hilbert_neighbours_touch():
    """All cells of a small cube come once, each next to the one before."""
    points = np.array(list(np.ndindex(8, 8, 8)))
    keys = blocks.hilbert_keys(points, 3)
    assert sorted(keys) == list(range(512))
    steps = np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()
