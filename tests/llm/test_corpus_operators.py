"""Corpus operators against brute force, on small tables with odd rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortwise.llm import decontaminate, hosts, jaccard, language, packing, quality, sharding, store, substring, tokens, warc
from cohortwise.llm.components import components

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^ \t-\r]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, rep string, print int, spans string"


def words(text):
    return WORD.findall(text or "")


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Texts with copies, near copies, shared passages, nulls, ties and a long one."""
    rng = random.Random(5)
    base = sentence(rng, 120)
    passage = sentence(rng, 40)
    out = [base, base, base.upper(), None, "", " \t\n ", "one", "one two", "ONE", passage]
    for _ in range(25):
        w = base.split()
        for _ in range(rng.randrange(1, 7)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(30)}"
        out.append(" ".join(w))
    for _ in range(15):
        w = base.split()
        for _ in range(rng.randrange(1, 6)):
            del w[rng.randrange(len(w))]
        out.append("\n".join(w))
    for _ in range(12):
        out.append(sentence(rng, rng.randrange(1, 30)) + "\x0b" + passage + "\r\n" + sentence(rng, rng.randrange(0, 20)))
    out += [sentence(rng, n) for n in (4, 5, 13, 14, 60)] + [sentence(rng, 30_000, 5_000), "no no " * 300, "é ü 漢字 🙂 " * 20]
    out = [(i, t, "en", f"s{i % 3}", 0, "r", 1, "z") for i, t in enumerate(out)]
    return out + [out[0], out[9], (None, base, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 3), (2, 1), (9, 8), (8, 7), (7, 6), (6, 5), (30, 31)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 5, 8: 5, 7: 5, 6: 5, 5: 5, 30: 30, 31: 30}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_are_all_links(docs, rows, none):
    texts = {(i, t) for i, t, *_ in rows}
    sets = {(i, t): shingles(t) for i, t in texts}
    keys = list(texts)
    parent = {k: k for k in keys}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in keys:
        for b in keys:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for k in keys:
        groups[find(k)].append(k[0])
    want = collections.Counter((i, len(sets[i, t]), min((d for d in groups[find((i, t))] if d is not None), default=None)) for i, t, *_ in rows)
    got = collections.Counter(map(tuple, jaccard.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == want
    assert jaccard.near_duplicates(none).count() == 0


def test_signatures_meet_for_every_similar_pair():
    rng = np.random.default_rng(3)
    for size in [*range(1, 40), 60, 111, 257, 600]:
        for _ in range(4):
            a = np.unique(rng.integers(0, 1 << 62, size, dtype=np.uint64))
            drop = rng.integers(0, max(1, len(a) // 9) + 1)
            add = rng.integers(0, max(1, len(a) // 9) + 1)
            b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 1 << 62, add, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if not len(b) or 100 * both < 80 * (len(a) + len(b) - both):
                continue
            first = np.array([0, len(a), len(a) + len(b)])
            seen = [set(), set()]
            for signature, row, _ in jaccard.signatures(np.concatenate([a, b]), first, 80):
                for s, r in zip(signature.tolist(), row.tolist(), strict=True):
                    seen[r].add(s)
            assert seen[0] & seen[1], (len(a), len(b), both)


def emitted(sets, first):
    """By set and band group: what the set needs, and its signatures."""
    out = collections.defaultdict(dict)
    for signature, row, need in jaccard.signatures(sets, first, 80):
        for s, r, least in zip(signature.tolist(), row.tolist(), need.tolist(), strict=True):
            out[r].setdefault(least >> 20, (least & 1048575, set()))[1].add(s)
    return out


@pytest.mark.parametrize("size", [*range(12, 51, 3), 16, 17, 19, 20])
def test_similar_sets_share_as_many_signatures_as_they_need(size):
    """Both members, also where only one of them emits its empty partitions."""
    rng = np.random.default_rng(size)
    pairs, differ = 4000, size // 9
    base = rng.integers(0, 1 << 62, (pairs, size + differ)).astype(np.uint64)
    sets = np.concatenate([np.sort(base[:, :size], axis=1), np.sort(base[:, differ:], axis=1)], axis=1).ravel()
    made = emitted(sets, np.arange(2 * pairs + 1) * size)
    for i in range(pairs):
        a, b = made[2 * i], made[2 * i + 1]
        for me, other in ((a, b), (b, a)):
            assert all(len(me[g][1] & other[g][1]) >= me[g][0] for g in me), (size, i)


def test_a_short_pair_links_where_one_hides_its_empty_partitions(spark):
    """No other candidates are there to fill up what the sparse set needs."""
    pairs = []
    for seed in range(4000):
        w = [f"a{seed}x{i}" for i in range(22)]  # 18 shingles, 2 removed and 2 added: 7 partitions, 4 may differ
        pairs.append((" ".join(w), " ".join([*w[2:], f"b{seed}", f"c{seed}"])))
    hard = []
    for pair in pairs:
        made = emitted(*jaccard.shingle_sets(next(tokens.W.chunks(pa.array(pair)))))
        (a,), (b,) = ([s for _, s in made[i].values()] for i in range(2))
        if max(len(a), len(b)) == 7 and len(a & b) < 3:
            hard.append(pair)
    assert hard
    got = jaccard.near_duplicates(spark.createDataFrame(list(enumerate(hard[0])), "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 2


def test_one_of_each(docs, rows):
    kept = jaccard.one_of_each(docs).collect()
    assert set(kept[0].asDict()) == {c.split()[0] for c in DOCS.split(", ")}
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and 0 in ids and 1 not in ids and {3, 4, 5} <= set(ids)


def removed(rows):
    first = {}
    for i, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - 12):
            g = tuple(w[k : k + 13])
            if i is not None:
                first[g] = min(first.get(g, i), i)
    out = []
    for i, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return collections.Counter(out)


def test_substrings(docs, rows, none):
    got = substring.repeat_digests(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert collections.Counter(map(tuple, got.collect())) == removed(rows)
    assert substring.repeat_digests(none).count() == 0


def test_substrings_keep_columns_and_other_text(docs, rows):
    kept = substring.drop_repeats(docs)
    assert kept.columns == docs.columns
    want = collections.Counter({(i, p): n for (i, _, _, p), n in removed(rows).items()})
    got = collections.Counter((r.doc_id, hashlib.sha256(" ".join(words(r.text)).encode()).hexdigest()) for r in kept.collect())
    assert got == want
    assert {r.text for r in kept.collect() if r.doc_id == 3} == {None}


def test_paths_are_compacted(spark):
    rng = random.Random(1)
    shared = sentence(rng, 60, 10_000)
    table = spark.createDataFrame([(1, shared), (2, "a b " + shared), (3, shared + " c")], "doc_id long, text string")
    from pyspark.sql import functions as F

    got = substring.repeated_paths(table.withColumn("part", F.lit(0))).collect()
    assert sorted((r.doc_id, r.pos, r.length, r.src_doc, r.src_pos) for r in got) == [(1, 0, 48, 1, 0), (2, 2, 48, 1, 0), (3, 0, 48, 1, 0)]


def test_host_rules(docs, rows, none):
    def one(i, t):
        w = words(t)
        n = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + j for k in range(len(w) - 2) if n[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        symbols = sum((t or "").count(c) for c in "#*$%&|<>")
        bad = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        return i, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), bad

    got = [tuple(r) for r in hosts.rule_verdicts(docs).collect()]
    assert collections.Counter(r[:7] for r in got) == collections.Counter(one(i, t) for i, t, *_ in rows)
    assert all(not r[7] for r in got if r[6])
    assert hosts.rule_verdicts(none).count() == 0


def test_a_bad_host_takes_its_documents(spark):
    rng = random.Random(2)
    good = [(i, sentence(rng, 80), f"good{i % 4}") for i in range(80)]
    bad = [(100 + i, "same old words " * 30 if i else sentence(rng, 80), "bad") for i in range(20)]
    got = {r.doc_id: r.kept for r in hosts.rule_verdicts(spark.createDataFrame(good + bad, "doc_id long, text string, source string")).collect()}
    assert all(got[i] for i in range(80)) and not any(got[100 + i] for i in range(20))


def test_a_host_prior_takes_no_chance_for_spread(spark):
    rng = random.Random(12)
    fine = [(i, sentence(rng, 80), f"h{i}") for i in range(30)]
    short = [(100 + i, sentence(rng, 10), f"s{i}") for i in range(10)]  # one document a host: no evidence on any host
    rows = hosts.with_rules(spark.createDataFrame(fine + short, "doc_id long, text string, source string"))
    assert {r.host_kept for r in hosts.host_verdicts(rows).collect()} == {True}
    counts = {"a": (40, 1), "b": (60, 4), "c": (30, 27), "d": (1, 1)}  # documents and short ones
    table = [(0, sentence(rng, 10 if i < k else 80), h) for h, (n, k) in counts.items() for i in range(n)]
    rows = hosts.with_rules(spark.createDataFrame(table, "doc_id long, text string, source string"))
    rate, one = [k * 10**6 // n / 1e6 for n, k in counts.values()], [10**6 // n / 1e6 for n, _ in counts.values()]
    m, v, h = np.mean(rate), np.var(rate), np.mean(one)
    rho = (v / (m * (1 - m)) - h) / (1 - h)
    w = min(max(1 / rho - 1, 1), sum(n for n, _ in counts.values()))
    for limit in (0.2, 0.4, 0.6, 0.8):
        got = {r.host: r.host_kept for r in hosts.host_verdicts(rows, limit).collect()}
        assert got == {host: (k + m * w) / (n + w) <= limit for host, (n, k) in counts.items()}


def test_languages(spark, none):
    rng = random.Random(4)
    sounds = {"a": ["ka", "lo", "mi"], "b": ["sch", "ung", "tz"], "c": ["eau", "oi", "que"]}
    table = [(i, " ".join("".join(rng.choices(sounds[x], k=3)) for _ in range(rng.randrange(2, 60))), x) for i, x in enumerate("abc" * 40)]
    table += [(500, None, "a"), (501, "", "b"), (502, "123 !?", "c"), (503, "kalomi " * 20_000, None), (504, "é", "a"), (None, "schungtz", "b")]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.languages(docs).collect()}
    assert len(got) == len(table)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(120))
    assert sum(got[i].lang_pred == x for i, _, x in table[:120]) >= 117
    assert [got[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3 and got[503].lang_pred == "a"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.languages(none).count() == 0


def test_languages_are_those_of_plain_kernel_ridge(spark):
    """With every row a landmark, the scores of a dense solve over the n-gram sets themselves."""
    import pyarrow as pa

    from cohortwise.llm import words as W

    rng = random.Random(9)
    sounds = {"a": "abc ", "b": "bcd ", "c": "cde "}
    table = [(i, " ".join("".join(rng.choices(sounds[x], k=4)) for _ in range(rng.randrange(2, 9))), x) for i, x in enumerate("abc" * 9 + "aab")]
    settings = language.Settings(features=1 << 18, landmarks=100)
    model = language.fit(spark.createDataFrame(table, "doc_id long, text string, lang string"), settings)
    assert model.languages == ["a", "b", "c"] and model.landmarks.shape[1] == len(table)
    sets = [{t[i : i + n] for n in settings.grams for i in range(len(t) - n + 1)} for _, t, _ in table]
    k = np.array([[len(p & q) / np.sqrt(len(p) * len(q)) for q in sets] for p in sets])
    y = np.array([[1.0 if x == c else -1.0 for c in "abc"] for *_, x in table])
    w = np.array([1 / sum(x == z for *_, z in table) for *_, x in table])
    left = np.block([[w[:, None] * k + settings.ridge * np.eye(len(k)), w[:, None]], [w @ k, np.array([[w.sum()]])]])
    solved = np.linalg.solve(left, np.vstack([w[:, None] * y, w @ y]))
    (chunk,) = W.chunks(pa.array([t for _, t, _ in table]))
    got = model.scores(language.presence(chunk, 0, chunk.n, settings))
    assert np.allclose(got, k @ solved[:-1] + solved[-1], atol=2e-3)


def test_quality(spark, none):
    rng = random.Random(6)
    table = [(i, sentence(rng, rng.randrange(20, 90)) if i % 3 else "BUY### NOW$$$ " * rng.randrange(10, 40)) for i in range(200)]
    table += [(900, None), (901, ""), (None, "some words")]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(200)] + [(5, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(200))
    assert all(got[i].predicted == int(i % 3 > 0) for i in range(200))
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == len(table)
    assert {r.doc_id for r in quality.good_documents(docs, labels).collect()} >= {i for i in range(200) if i % 3}
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.good_documents(docs, labels.limit(0)).count() == len(table)
    assert quality.quality_scores(none, labels).count() == 0


def test_quality_fit_is_the_dense_solution(spark):
    """Weights by a plain solve of all rows; the curve by scores of the other folds."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, quality.N_STATS))
    y = (x[:, 0] + 0.5 * rng.normal(size=300) > 0).astype(float)
    settings = quality.Settings(features=16, bins=40)
    table = spark.createDataFrame([(r.tolist(), float(t)) for r, t in zip(x, y)], "x array<double>, y double").repartition(7)
    model = quality.fit(table, settings)
    folds = {tuple(r.x): r.k for r in table.select("x", F.pmod(F.xxhash64("x"), F.lit(settings.folds)).alias("k")).collect()}
    fold = np.array([folds[tuple(r)] for r in x.tolist()])
    assert len(set(fold)) == settings.folds

    def solve(rows):
        f = model.features(x[rows])
        penalty = np.diag([settings.ridge * rows.sum() / 17] * 16 + [1e-9])
        return np.linalg.solve(f.T @ f + penalty, f.T @ y[rows])

    assert np.allclose(model.weights, solve(np.ones(300, bool)), atol=1e-6)
    raw = np.zeros(300)
    for k in range(settings.folds):
        raw[fold == k] = model.features(x[fold == k]) @ solve(fold != k)
    at = np.clip(np.floor((raw + 0.5) / 2 * settings.bins), 0, settings.bins - 1).astype(int)
    bins = sorted((raw[at == b].mean(), y[at == b].mean(), (at == b).sum()) for b in set(at))
    assert np.allclose(model.knots, [b[0] for b in bins], atol=1e-6)
    assert np.allclose(model.values, quality.isotonic(np.array([b[1] for b in bins]), np.array([float(b[2]) for b in bins])), atol=1e-6)
    same = spark.createDataFrame([([1.0] * quality.N_STATS, 1.0)] * 5, "x array<double>, y double")  # one fold alone
    assert np.allclose(quality.fit(same, settings).score(np.ones((1, quality.N_STATS))), 1, atol=1e-3)


def test_isotonic():
    rng = np.random.default_rng(0)
    y, w = rng.random(200), rng.integers(1, 9, 200).astype(float)
    fit = quality.isotonic(y, w)
    assert (np.diff(fit) >= -1e-12).all() and abs((fit * w).sum() - (y * w).sum()) < 1e-9
    best = [max(min(np.average(y[a : b + 1], weights=w[a : b + 1]) for b in range(i, 200)) for a in range(i + 1)) for i in range(0, 200, 37)]
    assert np.allclose(fit[::37], best)


def test_decontamination(spark, docs, none):
    rng = random.Random(8)
    items = [(i, sentence(rng, 25) + f". Answer {sentence(rng, 12)}.") for i in range(30)] + [(90, None), (91, ""), (92, "short")]
    table = [(i, sentence(rng, rng.randrange(5, 300))) for i in range(60)]
    table += [(100 + i, sentence(rng, 70 * i) + " " + items[i][1].upper() + " " + sentence(rng, 9)) for i in range(10)]
    table += [(300, items[3][1].split(".")[0]), (301, None), (302, ""), (None, items[4][1]), (303, sentence(rng, 20_000, 9_000) + " " + items[7][1])]
    texts = spark.createDataFrame(table, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    want = {(100 + i, i) for i in range(10)} | {(303, 7)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(texts, tests).collect()} == want
    few = decontaminate.Settings(shard_bytes=1500)  # more than one index
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(texts, tests, few).collect()} == want
    clean = {r.doc_id for r in decontaminate.clean_documents(texts, tests).collect()}
    assert clean == {i for i, _ in table} - {d for d, _ in want} - {None}
    assert decontaminate.contaminated(texts, tests.limit(0)).count() == 0
    assert decontaminate.contaminated(none, tests).count() == 0


def test_shards_and_other_items_change_no_score(spark):
    """Items whose score is near the threshold, in one index and in many."""
    rng = random.Random(31)
    items = [(i, sentence(rng, rng.randrange(12, 30), 150) + f". Answer {sentence(rng, 8, 150)}.") for i in range(60)]
    texts = []
    for i in range(60):  # a share of the item's words, in order
        w = items[i][1].split()
        texts.append((i, " ".join(x for j, x in enumerate(w) if j < len(w) * (0.2 + i % 10 * 0.05) or j > len(w) - 9)))
    texts, tests = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    some = {"question": 0.1, "answer": 0.3}

    def found(**more):
        rows = decontaminate.contaminated(texts, tests, decontaminate.Settings(**some, **more)).collect()
        return {(r.doc_id, r.item_id): tuple(r)[2:] for r in rows}

    whole = found()
    assert 10 < len(whole) < 60 and min(x[1] for x in whole.values()) < 0.7
    assert found(shard_bytes=900) == whole
    for size in (900, 32 << 20):
        clean = decontaminate.clean_documents(texts, tests, decontaminate.Settings(**some, shard_bytes=size))
        assert {r.doc_id for r in clean.collect()} == set(range(60)) - {d for d, _ in whole}


def test_a_long_item_widens_no_other_items_passages(spark):
    rng = random.Random(32)
    question, far = sentence(rng, 20, 4000), sentence(rng, 600, 4000)
    items = [(1, f"{question}. answerword"), (2, sentence(rng, 2000, 4000) + ". Answer long one.")]
    table = [(1, f"{question} {far} answerword"), (2, f"{far} {question} answerword"), (3, f"{far} {items[1][1]} {far}")]
    texts = spark.createDataFrame(table, "doc_id long, text string")
    for few in (items[:1], items):
        tests = spark.createDataFrame(few, "item_id long, text string")
        got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(texts, tests).collect()}
        assert got == {(2, 1), (3, 2)} & {(2, 1), *((3, i) for i, _ in few)}
        clean = {r.doc_id for r in decontaminate.clean_documents(texts, tests).collect()}
        assert clean == {1, 2, 3} - {d for d, _ in got}


def test_passages_are_searched_in_groups(monkeypatch):
    import pyarrow as pa

    rng = random.Random(9)
    items = [(i, sentence(rng, 25) + f". Answer {sentence(rng, 12)}.") for i in range(40)]
    texts = pa.array([sentence(rng, 90 * i) + " " + items[i][1] for i in range(12)] + [None, ""])
    index = decontaminate.build_index(items, decontaminate.Settings())

    def hits():
        for chunk in decontaminate.W.chunks(texts):
            yield from decontaminate._search(chunk, decontaminate.trimmed(chunk), index, decontaminate.Settings())

    want = list(hits())
    monkeypatch.setattr(decontaminate, "CELLS", 7)
    assert list(hits()) == want and {(i, j) for i, j, *_ in want} >= {(i, i) for i in range(12)}


def test_flexible_packing(docs, rows, none):
    got = packing.best_fit_bins(docs, capacities=(16, 64, 256), block=20).collect()
    fill, sizes = collections.Counter(), collections.Counter()
    for r in got:
        fill[r.bin_id, r.bin_capacity] += r.length
        sizes[r.doc_id] += r.length
    assert all(n <= c and (c == 16 or n > {64: 16, 256: 64}[c]) for (_, c), n in fill.items())
    want = collections.Counter()
    for i, t, *_ in rows:
        want[i] += len(words(t)) + 1
    assert sizes == want
    places = sorted((r.bin_id, r.bin_offset, r.length) for r in got)
    assert all(a[0] != b[0] or a[1] + a[2] == b[1] for a, b in zip(places, places[1:]))
    assert packing.best_fit_bins(none).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_flexible_bins_are_those_of_a_plain_search(seed):
    """Which bin each piece goes to, which length is opened and what each bin shrinks to."""
    rng = np.random.default_rng(seed)
    sizes, overhead = (16, 40, 100), (0, 3, 16, 60)[seed]
    lengths = np.minimum(rng.geometric(0.05, 400), 100)
    bins, offsets, closed = packing.pack(lengths, sizes[::-1], overhead)
    opened, fill, touched, plain = [], [], [], {}
    left = int(lengths.sum())
    for turn, i in enumerate(sorted(range(400), key=lambda i: (-lengths[i], i))):
        n = int(lengths[i])
        fits = [b for b in range(len(fill)) if opened[b] - fill[b] >= n]
        if fits:  # the least room; of equal ones the bin that was touched last
            b = min(fits, key=lambda b: (opened[b] - fill[b], -touched[b]))
        else:
            b = len(fill)
            opened.append(min((c for c in sizes if c >= n), key=lambda c: ((c + overhead) / min(c, left), c)))
            fill.append(0)
            touched.append(0)
        plain[i] = b, fill[b]
        fill[b] += n
        touched[b] = turn
        left -= n
    assert [plain[i] for i in range(400)] == list(zip(bins.tolist(), offsets.tolist()))
    assert closed.tolist() == [min(c for c in sizes if c >= f) for f in fill]


def test_best_fit_takes_the_least_room():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 101, 500)
    rows = tokens.best_fit_decreasing(lengths, 100)
    rooms, plain = [], [[]]
    for i in np.argsort(-lengths, kind="stable"):
        fits = [r for r in rooms if r >= lengths[i]]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else 100) - lengths[i])
    assert sorted(100 - sum(lengths[r]) for r in rows) == sorted(rooms)
    assert sorted(i for r in rows for i in r) == list(range(500))


def test_token_rows_hold_every_token(docs, rows, none):
    settings = tokens.Settings(row=64, slice_bytes=4000)
    got = tokens.packed_rows(docs, settings=settings).collect()
    pieces = collections.defaultdict(list)
    for r in got:
        ids, places = np.frombuffer(r.ids, "<i4"), np.frombuffer(r.positions, "<i4")
        assert len(ids) == 64 and (ids[r.n_tokens :] == 50256).all() and r.cu_seqlens[-1] == r.n_tokens
        for d, s, a, b in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert (places[a:b] == np.arange(b - a)).all()
            pieces[d].append((s, tuple(ids[a:b].tolist())))
    bpe = tokens.Encoder(open(tokens.VOCABULARY, "rb").read()).bpe
    once = {i: t for i, t, *_ in rows if [r[0] for r in rows].count(i) == 1}
    for i, t in once.items():
        assert [x for _, p in sorted(pieces[i]) for x in p] == [*bpe.encode_ordinary(t or ""), 50256]
    assert len({r.row_id for r in got}) == len(got)
    assert tokens.packed_rows(none).count() == 0


def test_texts_are_encoded_in_pieces(rows):
    import pyarrow as pa

    texts = [t for _, t, *_ in rows] + ["a\u00a0\n b \u2003 c\x85 \t d " * 50, "x" * 3000, " " * 3000, "\n a" * 700]
    whole = tokens.Encoder(open(tokens.VOCABULARY, "rb").read())
    parts = tokens.Encoder(open(tokens.VOCABULARY, "rb").read(), piece=100)
    ids, offsets = parts.encode(pa.array(texts), 50256)
    for t, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
        assert ids[a:b].tolist() == [*whole.bpe.encode_ordinary(t or ""), 50256]


def test_lookup_table():
    names = tuple(f"s{i}" for i in range(7))
    table = sharding.lookup_table(names, 101)
    at, want = {n: [] for n in names}, np.full(101, -1)
    for n in names:
        step, offset = sharding._hash(n, "step") % 100 + 1, sharding._hash(n, "offset") % 101
        at[n] = [(offset + j * step) % 101 for j in range(101)]
    turn = 0
    while (want < 0).any():
        want[next(s for s in at[names[turn % 7]] if want[s] < 0)] = turn % 7
        turn += 1
    assert (table == want).all()
    fewer = sharding.lookup_table(names[:-1], 101)
    assert (fewer[table < 6] == table[table < 6]).mean() > 0.6
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 100)


def test_sharding(docs, none):
    got = sharding.placed(docs).collect()
    assert len(got) == docs.count() and all(r.shard == sharding.SHARDS[sharding.lookup_table(sharding.SHARDS)[r.slot]] for r in got)
    assert sharding.placed(none).count() == 0


def test_whole_rows_reach_their_shards(spark, docs, none, tmp_path):
    """Every column of every row, repeated and null ones too, is in the folder of its shard and no other."""
    def found(df):
        return collections.Counter(tuple(r) for r in df.select(*docs.columns).collect())

    names = ("7", "08", "b c")  # numbers in folder names stay strings
    path = str(tmp_path / "shards")
    back = sharding.write_shards(docs, path, shards=names, slots=101)
    assert back.columns == [*docs.columns, "slot", "shard"] and found(back) == found(docs)
    want = collections.Counter(tuple(r) for r in sharding.placed(docs, shards=names, slots=101).collect())
    assert collections.Counter(tuple(r) for r in back.collect()) == want
    for name in names:
        folder = sharding.placed(docs, shards=names, slots=101).where(F.col("shard") == name)
        assert found(spark.read.parquet(f"{path}/shard={name}")) == found(folder)
    assert sharding.write_shards(none, str(tmp_path / "none")).count() == 0


def test_shard_files_follow_bytes_not_tasks(spark, tmp_path):
    """Many input partitions leave one small file a shard; small files of a hot shard are cut."""
    rows = spark.range(4000, numPartitions=40).selectExpr("id as doc_id", "concat_ws('', transform(sequence(1, 20), i -> sha2(string(id * 100 + i), 256))) as text")
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    assert sharding.write_shards(rows, few, shards=("a", "b"), slots=101).count() == 4000
    assert sharding.write_shards(rows, many, file_bytes=64 << 10, shards=("a", "b"), slots=101).count() == 4000
    files = {path: len(list((tmp_path / path).rglob("*.parquet"))) for path in ("few", "many")}
    assert files["few"] <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) < files["many"]


def test_clashing_names_stay(spark, tmp_path):
    """Columns called like those that operators make, in any case, keep their values."""
    names = ["doc_id", "text", "_file", "_print", "_kept", "id", "print", "row", "part", "rest", "block", "spans", "c0", "Words"]
    same = "the same words stand here once more and they are more than thirteen of them"
    data = [(i, t, *[f"{n}{i}" for n in names[2:]]) for i, t in enumerate([same, same, "other words", None, ""])]
    docs = spark.createDataFrame(data, f"doc_id long, text string, {', '.join(f'`{n}` string' for n in names[2:])}")

    def found(df):
        assert df.columns[: len(names)] == names
        return sorted([tuple(r)[: len(names)] for r in df.collect()])

    assert found(sharding.write_shards(docs, str(tmp_path / "shards"))) == data
    assert found(jaccard.one_of_each(docs)) == [data[0], *data[2:]]
    kept = [(d[0], "" if d[0] == 1 else d[1], *d[2:]) for d in data]
    assert found(substring.drop_repeats(docs)) == kept
    upper = docs.withColumnsRenamed({"c0": "Slot", "rest": "SHARD"})
    assert sharding.placed(upper).columns == [c for c in upper.columns if c not in ("Slot", "SHARD")] + ["slot", "shard"]


def doubling(n, a, b):
    """A word of ``2 ** n`` letters whose swap of letters has the same sums under many hashes."""
    return "".join(b if i.bit_count() % 2 else a for i in range(1 << n))


@pytest.fixture(scope="module")
def lookalikes(spark):
    pairs = [doubling(10, "a", "b"), doubling(10, "b", "a")]
    ends = [" ".join(f"{x}{i}" for i in range(6)) for x in "pq"]
    return spark.createDataFrame([(i, f"{ends[0]} {w} {ends[1]}") for i, w in enumerate(pairs)], "doc_id long, text string")


def test_words_that_look_alike_stay_apart(spark, lookalikes):
    """Long words that differ in many letters, and hash to one value under a polynomial modulo 2**64."""
    assert [r.component_id for r in jaccard.near_duplicates(lookalikes).orderBy("doc_id").collect()] == [0, 1]
    assert [r.n_removed for r in substring.repeat_digests(lookalikes).orderBy("doc_id").collect()] == [0, 0]
    items = lookalikes.where("doc_id = 0").select(F.col("doc_id").alias("item_id"), "text")
    scores = {r.doc_id: r.score for r in decontaminate.contaminated(lookalikes, items).collect()}
    assert scores[0] > scores.get(1, 0)  # the rare word counts for one document alone


def test_word_hashes_do_not_depend_on_the_slices(monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab \n") for _ in range(300)), "x" * 500, "", "ab"]
    whole = [c.hashes(False) for c in tokens.W.chunks(pa.array(texts))]
    monkeypatch.setattr(tokens.W, "PIECE", 7)
    pieces = [c.hashes(False) for c in tokens.W.chunks(pa.array(texts))]
    assert all((x == y).all() for x, y in zip(whole, pieces, strict=True))
    found = collections.defaultdict(set)
    for word, value in zip([w for t in texts for w in words(t)], np.concatenate(whole), strict=True):
        found[word].add(int(value))
    assert all(len(v) == 1 for v in found.values()) and len(set.union(*found.values())) == len(found)


def test_spans_are_verified_by_their_words(spark):
    """Places that hashes put on one path count only with documents that have the same words there."""
    same = " ".join(f"w{i}" for i in range(20))
    other = same.replace("w7", "v7")
    texts = spark.createDataFrame([(1, 0, "x " + same), (2, 0, other.replace(" ", "\n")), (3, 0, other + " y"), (4, 0, same)], "doc_id long, part int, text string")
    places = [(1, 0, 1), (2, 0, 0), (3, 0, 0), (4, 0, 0)]
    frame = spark.createDataFrame([(d, p, at, 8, 1, 0, 1) for d, p, at in places], substring._SPAN)
    found = substring.verified_places(texts, frame)
    assert {r.doc_id: r.first for r in found.collect()} == {1: 1, 2: 2, 3: 2, 4: 1}


def test_sharding_query_writes_the_documents(spark, monkeypatch):
    written = []
    monkeypatch.setattr(sharding, "new_path", lambda spark, name: written.append(store.new_path(spark, name)) or written[-1], raising=False)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {tuple(r) for r in sharding.op4_maglev_sharding(spark, SMALL).collect()}
    assert written and got == {tuple(r) for r in sharding.placed(docs.select("doc_id")).collect()}
    back = spark.read.parquet(written[0]).select(*docs.columns)
    assert back.exceptAll(docs).isEmpty() and docs.exceptAll(back).isEmpty()


def test_warc_round_trip(spark):
    long = "<p>" + "é" * 700
    pages = [(i, f"http://x/{i}", long if i in (2, 5, 9) else f"<html>{i}" * (400 if i % 2 else 1)) for i in range(12)]
    pages += [(20, None, None), (21, "u", ""), (22, "u", "a\r\n\r\nWARC/1.1\r\n" * 200), (23, "u", "x" * 300_000)]
    table = spark.createDataFrame([(*p, "e") for p in pages], "page_id long, url string, html string, payload string")
    got = {r.page_id: r for r in warc.round_trip(table).collect()}
    for i, _, html in pages:
        raw = (html or "").encode()
        kind, to = ("revisit", 9) if i in (2, 5) else ("response", None)
        r = got[i]
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(raw), hashlib.sha1(raw).hexdigest(), kind, to)
    assert warc.round_trip(table.limit(0)).count() == 0


def test_warc_filters_skip_payloads(spark, tmp_path):
    import gzip

    import pyarrow as pa

    rows = [
        {"record_id": f"urn:x-page:{i}", "warc_type": "response", "target_uri": f"http://x/{i}", "date": None,
         "payload_digest": hashlib.sha1(b"p" * i).hexdigest(), "refers_to": None, "payload_bytes": i, "payload": b"p" * i}
        for i in (0, 5, 70_000)
    ]
    data = [warc._record(r) for r in rows]
    (tmp_path / "a.warc").write_bytes(b"".join(data))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(d) for d in data))
    warc.register(spark)
    read = spark.read.format("warc").load(str(tmp_path))
    assert [len(r.payload) for r in read.orderBy("payload_bytes").collect()] == [0, 0, 5, 5, 70_000, 70_000]
    assert read.where("target_uri = 'http://x/5'").count() == 2
    assert {r.payload for r in spark.read.format("warc").option("payload", "false").load(str(tmp_path)).collect()} == {None}

    class Counting:
        def __init__(self, raw):
            self.raw, self.bytes = raw, 0

        def read_at(self, n, at):
            data = self.raw[at : at + n]
            self.bytes += len(data)
            return data

    big = b"".join(warc._record(r | {"payload": b"q" * 10_000_000}) for r in rows)
    file = Counting(big)
    assert len(list(warc.records(warc.PlainFile(file), [], False))) == 3 and file.bytes < 1_000_000
    assert pa.__version__

    noise = np.random.default_rng(1)
    parts = [r | {"payload": noise.bytes(3_000_000), "payload_bytes": 3_000_000} for r in rows]
    packed = b"".join(warc._member(warc._record(r)) for r in parts)
    file = Counting(packed)
    assert [r["record_id"] for r in warc.records(warc.GzipFile(file), [], False)] == [r["record_id"] for r in rows]
    assert file.bytes < 1_000_000
    assert [r["payload"] for r in warc.records(warc.GzipFile(Counting(packed)), [], True)] == [r["payload"] for r in parts]
    assert gzip.decompress(packed) == b"".join(warc._record(r) for r in parts)


def test_scratch_stages_go_and_results_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "shared_base", lambda _: tmp_path.as_uri())
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "other words only")], "doc_id long, text string")
    near = jaccard.near_duplicates(docs)
    cut = substring.repeat_digests(docs)
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
    assert {"jaccard-links", "substring-spans"} <= left
    assert not left & {"jaccard-buckets", "jaccard-sets", "jaccard-arms", "jaccard-prefix", "substring-segments"}
    assert sorted((r.doc_id, r.component_id) for r in near.collect()) == [(1, 1), (2, 1), (3, 3)]
    assert sorted((r.doc_id, r.n_removed) for r in cut.collect()) == [(1, 0), (2, 60), (3, 0)]
    with pytest.raises(RuntimeError), store.Scratch(spark) as scratch:
        scratch.stage(docs, "failed-block")
        raise RuntimeError
    assert not list(tmp_path.glob("failed-block*"))
