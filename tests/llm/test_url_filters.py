"""URL filters against a plain search over all rules."""

import random
import re

import pytest

from cohortwise.llm import urls

UPPER = str.maketrans(urls.UPPER, urls.LOWER)


def plain(url, rules, default="allow"):
    """(host, path, rule, verdict) by trying every rule."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = host.translate(UPPER)
    fit = []
    for h, p, action in rules:
        if h is None or p is None or action not in ("allow", "block"):
            continue
        h = h.translate(UPPER)
        if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p):
            fit.append((len(h.split(".")) if h else 0, len(p), action, h + p))
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else default


URLS = [
    None,
    "",
    "no scheme/org/",
    "http://",
    "http:///x",
    "http://org",
    "http://org/",
    "HTTP://WWW.Example.ORG/es/1?a=/fr/#x",
    "https://example.org/es",
    "https://example.org/en/1",
    "https://example.org/en/12/3",
    "https://a.b.example.org/en/2",
    "https://badexample.org/es/",
    "https://x.com/fr/",
    "https://x.com/fr",
    "https://x.com?/de/",
    "https://x.com#/de/",
    "https://com/de/://y.org/",
    "https://x.com:8080/de/",
    "https://u@x.com/de/\n/fr/",
    "https://É.com/de/ü",
    "https://x.net/" + "a/" * 50_000,
    "https://" + "a." * 20_000 + "org/",
    "a://b://c.org/",
    "https://..org/",
    "https://x.com//de/",
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, i, "r", "h", "b") for i, u in enumerate(URLS)] + [(0, None, 0, "r", "h", "b"), (None, URLS[7], None, None, None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, row int, Rule string, c0 string, best string")


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def expected(rows, rules, default="allow"):
    return sorted([(r.page_id, *plain(r.url, rules, default)) for r in rows], key=str)


def judged(pages, rules, **more):
    return urls.url_verdicts(pages, rules, **more).select("page_id", "host", "path", "rule", "verdict")


@pytest.mark.parametrize("default", ["allow", "block"])
def test_entries_of_the_query(spark, pages, default):
    rules = spark.createDataFrame(urls.ENTRIES, urls.RULE)
    assert rows_of(judged(pages, rules, default=default)) == expected(pages.collect(), urls.ENTRIES, default)


@pytest.fixture(scope="module")
def many():
    rng = random.Random(3)
    labels = ["a", "b", "ab", "org", "com", ""]
    rules = [(None, "/", "allow"), ("org", None, "block"), ("org", "/", "drop"), ("ORG", "/b", "allow"), ("org", "/b", "block"), ("", "/zz", "block")]
    for _ in range(300):
        host = ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 4)))
        path = "/".join(rng.choice(["", "a", "b", "ab", "abc"]) for _ in range(rng.randrange(1, 4)))
        rules.append((host, rng.choice(["", "/"]) + path, rng.choice(["allow", "block"])))
    found = [
        "x://" + ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5))) + "/" + "/".join(rng.choice(["", "a", "b", "ab", "abcd"]) for _ in range(3))
        for _ in range(600)
    ]
    return rules, found


@pytest.mark.parametrize("trie_bytes", [urls.TRIE_BYTES, 40_000])
def test_random_rules(spark, many, trie_bytes):
    """Ties, repeated rules and nulls; one trie or several."""
    rules, found = many
    pages = spark.createDataFrame(list(enumerate([*found, *found[:50], None])), "page_id long, url string")
    frame = spark.createDataFrame(rules + rules[:20], urls.RULE)
    assert rows_of(judged(pages, frame, trie_bytes=trie_bytes)) == expected(pages.collect(), rules)


def test_columns_stay(spark, pages):
    rules = spark.createDataFrame(urls.ENTRIES, urls.RULE)
    out = urls.url_verdicts(pages, rules)
    assert out.columns == ["page_id", "url", "row", "c0", "best", "host", "path", "rule", "verdict"]
    kept = urls.allowed_pages(pages, rules)
    assert kept.schema == pages.schema
    allow = [r for r in pages.collect() if plain(r.url, urls.ENTRIES)[3] == "allow"]
    assert rows_of(kept) == sorted([tuple(r) for r in allow], key=str)


def test_empty_tables(spark, pages):
    none = spark.createDataFrame([], urls.RULE)
    assert rows_of(judged(pages, none, default="block")) == expected(pages.collect(), [], "block")
    assert urls.url_verdicts(pages.limit(0), spark.createDataFrame(urls.ENTRIES, urls.RULE)).collect() == []
