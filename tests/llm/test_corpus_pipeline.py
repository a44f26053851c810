"""The corpus pipeline's stages, and the queries' SQL at the smallest size."""

import collections
import math
import os
import random
import re

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cohortwise.llm import decontaminate, quality, registry

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^ \t-\r]+")
MARKS = ".,;:!?\"'()[]{}|*#$%&<>-"


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def trimmed(text):
    out = []
    for w in WORD.findall(folded(text)):
        for _ in range(4):
            w = w[:-1] if len(w) > 1 and w[-1] in MARKS else w
            w = w[1:] if len(w) > 1 and w[0] in MARKS else w
        out.append(w)
    return out


def grams(w, n):
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def exhaustive_hits(texts, items):
    """Every passage against every item, without an index: {(text, item): (passage, score, overlaps)}."""
    items = [(j, t, trimmed(t)) for j, t in items if t and t.split()]
    mean = sum(len(w) for *_, w in items) / len(items)
    df = collections.Counter(t for *_, w in items for t in set(w))
    out = {}
    for j, text, w in items:
        impact = {}
        for t, tf in collections.Counter(w).items():
            idf = math.log1p((len(items) - df[t] + 0.5) / (df[t] + 0.5))
            impact[t] = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
        full, head = math.fsum(impact.values()), decontaminate.split_item(text)
        parts = [(p, max(1, min(4, len(p)))) for p in (w[:head], w[head:])]
        stride = 64
        while stride < len(w):
            stride *= 2
        for i, words in texts:
            for start in range(0, max(1, len(words) - stride), stride):
                passage = words[start : start + 2 * stride]
                score = math.fsum(impact.get(t, 0) for t in set(passage)) / full
                if score < 0.6:
                    continue
                over = [len(grams(p, n) & grams(passage, n)) / len(grams(p, n)) if p else 1.0 for p, n in parts]
                if min(over) >= 0.6 and (score > out.get((i, j), (0, 0))[1] + 1e-9):
                    out[i, j] = (start, score, *over)
    return out


def test_contaminated_is_exhaustive_bm25(spark):
    """Items of many lengths, whole and in part, so that scores and overlaps lie on both sides of 0.6."""
    rng = random.Random(41)

    def sentence(n):
        return " ".join(f"w{min(rng.randrange(300), rng.randrange(300))}" for _ in range(n))

    items = [(i, sentence(rng.choice([8, 15, 30, 55, 90, 200])) + f"? Answer {sentence(8)}.") for i in range(70)] + [(90, None), (91, "one")]
    texts = []
    for i in range(240):
        w = items[i % 70][1].split()
        share = rng.uniform(0.4, 1)
        kept = [x for x in w if rng.random() < share] if i % 3 else w[: int(len(w) * share)] + w[-8:]
        texts.append((i, sentence(rng.randrange(0, 500)) + " " + " ".join(kept).upper() + " " + sentence(rng.randrange(0, 200))))
    want = exhaustive_hits([(i, trimmed(t)) for i, t in texts], items)
    assert 30 < len(want) and min(x[1] for x in want.values()) < 0.9 and min(min(x[2:]) for x in want.values()) < 0.7
    docs, tests = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for settings in (decontaminate.Settings(), decontaminate.Settings(shard_bytes=5000)):
        got = {(r.doc_id, r.item_id): tuple(r)[2:] for r in decontaminate.contaminated(docs, tests, settings).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_run_is_the_chain_of_its_stages_by_hand(spark, monkeypatch):
    """Each written stage and the packed lengths, but for the model's scores in plain Python."""
    written = {}

    def kept(df, name, stage=corpus_pipeline.stage):
        written[name] = stage(df, name)
        return written[name]

    monkeypatch.setattr(corpus_pipeline, "stage", kept)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    packed = corpus_pipeline.run(spark, SMALL).collect()
    score = {r.doc_id: r.score for r in quality.op7_quality_classifier(spark, SMALL).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(texts) == docs.count()

    def same(name):
        got = sorted((r.doc_id, r.text) for r in written[f"pipeline-{name}"].collect())
        assert got == sorted(texts.items()), name

    texts = {i: t for i, t in texts.items() if score[i] >= 0.7}
    same("quality")
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(folded(t))
        sets[i] = grams(w, min(5, max(1, len(w))))
    ids = sorted(sets)
    group = {i: i for i in ids}
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {i: new if g == old else g for i, g in group.items()}
    texts = {i: t for i, t in texts.items() if group[i] == i}
    assert len(texts) < len(ids)
    same("near_duplicates")
    first = {}
    for i in sorted(texts):
        for g in grams(WORD.findall(texts[i]), 13):
            first.setdefault(g, i)
    before = dict(texts)
    for i, t in before.items():
        found = list(WORD.finditer(t))
        w = [m.group() for m in found]
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        starts = [m.start() for m in found] + [len(t)]
        texts[i] = t[: starts[0]] + "".join(t[starts[k] : starts[k + 1]] for k in range(len(w)) if k not in gone)
    same("substrings")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    hit = {i for i, _ in exhaustive_hits([(i, trimmed(t)) for i, t in texts.items()], items)}
    texts = {i: t for i, t in texts.items() if i not in hit}
    same("decontamination")
    sizes = collections.Counter()
    for r in packed:
        sizes[r.doc_id] += r.length
    assert sizes == {i: len(WORD.findall(t)) + 1 for i, t in texts.items()}


CLASHING = ("_file", "Slot", "_print", "_kept", "print", "part", "rest", "block", "row", "h", "x", "label")


def test_stages_take_rows_of_every_kind(spark):
    """Nulls in every column, empty and blank texts, repeated rows, a long text, clashing names, empty tables."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    odd = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, " \n\t"), (10**6 + 3, text), (10**6 + 3, text), (None, text), (None, None), (10**6 + 4, "word " * 200_000)]
    extra = spark.createDataFrame(odd, "doc_id long, text string")
    for c in docs.columns[2:]:
        extra = extra.withColumn(c, F.lit(None).cast(docs.schema[c].dataType))
    docs = docs.unionByName(extra.select(docs.columns)).withColumns({c: F.col("doc_id") % 7 for c in CLASHING})

    def ids(df):
        return collections.Counter(r.doc_id for r in df.select("doc_id").collect())

    every = ids(docs)
    for name, step in corpus_pipeline.STAGES[:-1]:
        got, none = step(spark, docs, SMALL), step(spark, docs.limit(0), SMALL)
        assert got.columns == docs.columns == none.columns, name
        assert none.count() == 0, name
        assert got.where("doc_id IS NOT NULL AND NOT (_file <=> doc_id % 7 AND `label` <=> doc_id % 7)").count() == 0, name
        kept = ids(got)
        assert not kept - every, name
        if name == "near_duplicates":
            assert all(kept[i] == 1 for i in range(10**6, 10**6 + 5)) and kept[None] == 2
        elif name == "substrings":
            assert kept == every
        elif name == "decontamination":
            assert all(kept[i] == every[i] for i in (None, *range(10**6, 10**6 + 5)))
    packed = ids(corpus_pipeline.packing(spark, docs, SMALL))
    assert set(packed) == set(every) and all(packed[i] >= n for i, n in every.items())
    assert corpus_pipeline.packing(spark, docs.limit(0), SMALL).count() == 0


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    at = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, at, SMALL).cache()
        assert out.columns == docs.columns, name
        left = {r.doc_id for r in out.select("doc_id").collect()}
        gone = {r.doc_id for r in at.select("doc_id").collect()} - left
        if name == "quality":
            assert sum(labels.get(i, 0) for i in gone) <= 0.05 * len(ids)
        if name == "near_duplicates":
            assert gone
        if name == "substrings":
            assert not gone
        at = out
    last = corpus_pipeline.STAGES[-1][1](spark, at, SMALL)
    assert {r.doc_id for r in last.collect()} == {r.doc_id for r in at.select("doc_id").collect()}


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"create view {table} as select * from read_parquet('{SMALL}/{table}.parquet')")
    got = entry.queries()[name](spark, SMALL)
    columns = sorted(got.columns)
    want = con.sql(entry.oracle_sql()[name])
    at = [want.columns.index(c) for c in columns]
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(tuple(r[i] for i in at) for r in want.fetchall()) or name == "op8_warc_round_trip"
    if name == "op8_warc_round_trip":
        assert {tuple(r[c] for c in columns) for r in got.collect()} == {tuple(r[i] for i in at) for r in want.fetchall()}


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert os.path.exists(corpus_pipeline.__file__)
