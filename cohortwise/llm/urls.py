"""URL filters: a trie over reversed host labels and path segments.

A rule is a host, a path prefix and an action. It fits its host and all its
subdomains, where the path of the URL starts with the rule's. Of the rules
that fit, the one with the most host labels wins, then the one with the longest
path; of an allow and a block entry that are equal, block wins. The trie walks
a host from its last label on, then the path segment by segment.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.store import ship, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE = "host string, path string, action string"
BEST = "struct<labels: int, length: int, rule: string, action: string>"
TRIE_BYTES = 32 << 20  # of rules in one broadcast, counted as below
ENTRY_BYTES = 400  # that a rule takes in the trie besides its text, about


@dataclass
class PathNode:
    """Segments below a path; ``ends`` are rules that end in a part of the next segment."""

    below: dict[str, PathNode] = field(default_factory=dict)
    ends: dict[str, str] = field(default_factory=dict)
    sizes: list[int] = field(default_factory=list)  # lengths of the keys of ``ends``, longest first


@dataclass
class HostNode:
    below: dict[str, HostNode] = field(default_factory=dict)
    path: PathNode | None = None


class Trie:
    """Rules ``(host, path, action)``; the longest that fits a host and path."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root = HostNode()
        for host, path, action in rules:
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node.below.setdefault(label, HostNode())
            node.path = at = node.path or PathNode()
            *segments, end = path.split("/")
            for segment in segments:
                at = at.below.setdefault(segment, PathNode())
            if at.ends.get(end) != "block":
                at.ends[end] = action
            at.sizes = sorted({len(e) for e in at.ends}, reverse=True)

    def hosts(self, host: str) -> list[tuple[int, PathNode]]:
        """The path tries of a host and its parents, most labels first."""
        node, found = self.root, [(0, self.root.path)] if self.root.path else []
        for depth, label in enumerate(reversed(host.split(".")) if host else (), 1):
            node = node.below.get(label)
            if node is None:
                break
            if node.path:
                found.append((depth, node.path))
        return found[::-1]

    @staticmethod
    def longest(node: PathNode, path: str) -> tuple[int, str] | None:
        """(length, action) of the longest path below ``node`` that starts ``path``."""
        best, at = None, 0
        while node is not None:
            stop = path.find("/", at)
            segment = path[at:] if stop < 0 else path[at:stop]
            for size in node.sizes:
                if size <= len(segment) and (action := node.ends.get(segment[:size])):
                    best = at + size, action
                    break
            if stop < 0:
                break
            node, at = node.below.get(segment), stop + 1
        return best

    def find(self, hosts: Iterable[str], paths: Iterable[str]) -> list[dict | None]:
        known: dict[str, list[tuple[int, PathNode]]] = {}
        out = []
        for host, path in zip(hosts, paths, strict=True):
            if host not in known:
                known[host] = self.hosts(host)
            out.append(None)
            for depth, node in known[host]:
                if hit := self.longest(node, path):
                    name = ".".join(host.split(".")[-depth:]) if depth else ""
                    out[-1] = {"labels": depth, "length": hit[0], "rule": name + path[: hit[0]], "action": hit[1]}
                    break
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    parts = r"^([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(rest, parts, 1), UPPER, LOWER), F.regexp_extract(rest, parts, 2)


def _finder(trie):
    """A column of the best rule per (host, path), by a broadcast trie."""
    fields = pa.struct([("labels", pa.int32()), ("length", pa.int32()), ("rule", pa.string()), ("action", pa.string())])

    @F.arrow_udf(BEST)
    def find(host: pa.Array, path: pa.Array) -> pa.Array:
        return pa.array(trie.value.find(host.to_pylist(), path.to_pylist()), fields)

    return find


def _clean(rules: DataFrame) -> DataFrame:
    host = F.translate("host", UPPER, LOWER)
    known = "host is not null and path is not null and action in ('allow', 'block')"
    return rules.where(known).groupBy(host.alias("host"), "path").agg(F.max("action").alias("action"))


def _broadcast(spark, rules: DataFrame):
    return spark.sparkContext.broadcast(Trie((r.host, r.path, r.action) for r in rules.toLocalIterator()))


def matched(pages: DataFrame, rules: DataFrame, url: str = "url", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """``pages`` in one struct ``row``, with ``host``, ``path`` and ``best`` (null where no rule fits).

    A trie of at most ``trie_bytes`` is broadcast at a time. Where the rules
    need more, they are dealt by hash into as many tries as it takes; each is
    held against the distinct (host, path) pairs, its finds are written before
    the next one is built, and the best of a pair's finds is joined back.
    """
    spark = pages.sparkSession
    ship(spark)
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = pages.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(pages.columns)]).alias("row"), host.alias("host"), path.alias("path"))
    rules = _clean(rules)
    size = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + ENTRY_BYTES)).first()[0] or 0
    tries = max(1, -(-size // trie_bytes))
    if tries == 1:
        return rows.withColumn("best", _finder(_broadcast(spark, rules))("host", "path"))
    pairs = stage(rows.select("host", "path").distinct(), "url-pairs")
    dealt = stage(rules.withColumn("deal", F.pmod(F.xxhash64("host", "path"), F.lit(tries))), "url-rules")
    finds = []
    for i in range(tries):
        trie = _broadcast(spark, dealt.where(F.col("deal") == i))
        found = pairs.withColumn("best", _finder(trie)("host", "path")).where("best is not null")
        finds.append(stage(found, "url-finds"))
        trie.unpersist()
    every = finds[0]
    for more in finds[1:]:
        every = every.unionByName(more)
    best = every.groupBy("host", "path").agg(F.max("best").alias("best"))
    return rows.join(best, ["host", "path"], "left")


def url_verdicts(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", trie_bytes: int = TRIE_BYTES
) -> DataFrame:
    """One row per page: its columns, then ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules(host, path, action)``, with the action ``allow`` or ``block``; a
    rule with a null in one of these or another action is left out, repeated
    ones count once, and an empty host fits every host. ``verdict`` is that
    of the winning rule, and ``default`` where ``rule`` is null. A null URL and
    one without ``://`` have an empty host and path. Repeated pages return
    repeated rows, empty tables empty results (without rules every page gets
    ``default``). Columns of ``pages`` that have the name of one of the four
    results, in any case, give way to it. URLs may have any length.
    """
    made = ("host", "path", "rule", "verdict")
    kept = [F.col(f"row.c{i}").alias(c) for i, c in enumerate(pages.columns) if c.lower() not in made]
    return matched(pages, rules, url, trie_bytes).select(
        *kept, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict")
    )


def allowed_pages(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", trie_bytes: int = TRIE_BYTES
) -> DataFrame:
    """The rows of ``pages`` whose verdict is ``allow``, with all their columns and no other."""
    rows = matched(pages, rules, url, trie_bytes).where(F.coalesce("best.action", F.lit(default)) == "allow")
    return rows.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(pages.columns)])


#: The entries that the query applies.
ENTRIES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op11_url_filters(spark, sf_dir: str) -> DataFrame:
    """Verdicts on the URLs of the whole ``pages`` table."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_verdicts(pages, spark.createDataFrame(ENTRIES, RULE)).drop("url")


_VALUES = ", ".join(f"('{host}', '{path}', '{action}')" for host, path, action in ENTRIES)

ORACLE_SQL = rf"""
with r(rule_host, rule_path, action) as (values {_VALUES}),
p as (
  select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest
  from pages),
q as (
  select page_id, row_number() over () as k,
         translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') as host,
         regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) as path
  from p),
fit as (
  select k, rule_host || rule_path as rule, action,
         row_number() over (
           partition by k order by len(string_split(rule_host, '.')) desc, length(rule_path) desc, action desc) as place
  from q join r on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select page_id, host, path, rule, coalesce(action, 'allow') as verdict
from (select page_id, k, coalesce(host, '') as host, coalesce(path, '') as path from q) q left join (select * from fit where place = 1) using (k)"""
