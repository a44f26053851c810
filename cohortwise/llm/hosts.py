"""Quality rules by document and by host, in DataFrame functions only.

Rules fail single documents. Their failures are also counted by host (the
``source`` column) and rule; a beta prior fitted to the rates of all hosts
shrinks each host's rate, the more the fewer documents it has. A host whose
shrunken rate of a rule passes the limit is out, and so are its documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.store import stage

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"
MIN_WORDS = 50
MAX_REPEAT = 50  # per cent of the words
MAX_SYMBOLS = 10  # per 100 words
MAX_DUP_LINES = 30  # per cent of the lines
HOST_LIMIT = 0.5
RULES = ("short", "repeats", "symbols", "dup_lines")
MILLION = 1_000_000


def with_rules(docs: DataFrame) -> DataFrame:
    """Counts and failed rules of each document of ``docs(doc_id, text, source)``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("host"),
        text.alias("text"),
    )
    rows = rows.withColumn("words", F.filter(F.split("text", SPACE), lambda w: w != ""))
    lines = F.filter(F.split("text", "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    n_words = F.size("words")
    w = F.col("words")
    threes = F.slice(
        F.arrays_zip(w.alias("a"), F.slice(w, 2, n_words).alias("b"), F.slice(w, 3, n_words).alias("c")), 1, F.greatest(n_words - 2, F.lit(0))
    )
    keyed = F.array_sort(F.transform(threes, lambda x, i: F.struct(F.concat_ws(" ", x["a"], x["b"], x["c"]).alias("k"), i.alias("i"))))
    rows = rows.select(
        "doc_id",
        "host",
        n_words.cast("long").alias("n_words"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.array_distinct(lines)).cast("long").alias("n_distinct_lines"),
        keyed.alias("s"),
    )
    size = F.size("s")
    beside = F.arrays_zip(
        F.col("s"), F.concat(F.array(F.lit(None).cast("string")), F.slice(F.col("s.k"), 1, F.greatest(size - 1, F.lit(0)))).alias("before"),
        F.slice(F.col("s.k"), 2, F.greatest(size, F.lit(1))).alias("after"),
    )
    again = F.filter(beside, lambda x: (x["s"]["k"] == x["before"]) | (x["s"]["k"] == x["after"]))
    places = F.array_sort(F.transform(again, lambda x: x["s"]["i"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        places, start, lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")), lambda acc: acc["n"]
    )
    rows = rows.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", (F.col("n_lines") - F.col("n_distinct_lines")).alias("n_dup_lines"),
        covered.alias("n_repeat_words"), "n_lines",
    )
    return rows.select(
        "*",
        (F.col("n_words") < MIN_WORDS).alias("short"),
        (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")).alias("repeats"),
        (100 * F.col("n_symbols") > MAX_SYMBOLS * F.col("n_words")).alias("symbols"),
        (100 * F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines")).alias("dup_lines"),
    )


def host_verdicts(rows: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """``(host, host_kept)`` of every host named in ``rows`` (of ``with_rules``).

    For each rule, the mean and variance of the host rates give a beta prior
    by beta-binomial moments: of the variance ``v`` around the mean ``m``, the
    share ``h`` (mean of 1/documents) of ``m (1 - m)`` is what chance alone
    gives, and only what is beyond counts as spread between hosts, ``rho = (v
    / (m (1 - m)) - h) / (1 - h)``. The prior's strength is ``1 / rho - 1``
    documents, at least 1 and at most all documents. Without spread beyond
    chance (one host, one document a host, equal rates) it is all documents,
    so hosts share one rate. A host is kept if its shrunken rate is at most
    ``limit`` for every rule. Rates and ``1/documents`` enter as whole
    millionths, so sums do not depend on their order.
    """
    flags = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("failed")) for r in RULES])
    tall = rows.where("host is not null").select("host", F.explode(flags).alias("f"))
    counts = tall.groupBy("host", "f.rule").agg(F.count("*").alias("n"), F.count_if("f.failed").alias("k"))
    counts = stage(counts, "host-counts")
    rate = F.expr(f"k * {MILLION} div n").cast("decimal(38,0)")
    one = F.expr(f"{MILLION} div n").cast("decimal(38,0)")
    moments = counts.groupBy("rule").agg(
        F.count("*").alias("hosts"), F.sum("n").alias("total"), F.sum(rate).alias("s1"), F.sum(rate * rate).alias("s2"), F.sum(one).alias("s3")
    )
    mean = F.expr(f"cast(s1 as double) / hosts / {MILLION}")
    variance = F.expr("(cast(s2 as double) - cast(s1 as double) * cast(s1 as double) / hosts) / hosts / 1e12")
    chance = F.expr(f"cast(s3 as double) / hosts / {MILLION}")
    moments = moments.select("rule", "total", mean.alias("m"), variance.alias("v"), chance.alias("h"))
    rho = F.expr("case when m > 0 and m < 1 and h < 1 then (v / (m * (1 - m)) - h) / (1 - h) end")
    strength = F.expr("case when rho > 0 then greatest(1d, least(total, 1 / rho - 1)) else cast(total as double) end")
    moments = moments.withColumn("rho", rho).withColumn("w", strength)
    prior = moments.select("rule", "m", "w")
    shrunken = counts.join(F.broadcast(prior), "rule").withColumn("rate", F.expr("(k + m * w) / (n + w)"))
    return shrunken.groupBy("host").agg((F.max("rate") <= limit).alias("host_kept"))


def rule_verdicts(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """One row per row of ``docs(doc_id, text, source)``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text; a null text has none.
    Returns ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words`` (all long), ``base_failed`` (fewer
    than 50 words, or more than half of them in repeated 3-word windows) and
    ``kept``: not failed, and the host kept. A null source is no host, so only
    the document counts. Repeated rows count and return as often as they
    stand; other columns are ignored, whatever their names. A hot host is
    summed map-side and its verdict joined as the unique side.
    """
    rows = stage(with_rules(docs), "host-rules")
    verdicts = host_verdicts(rows, limit)
    failed = F.col("short") | F.col("repeats")
    return rows.join(verdicts, "host", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & F.coalesce("host_kept", F.lit(True))).alias("kept"),
    )


def op1_host_rules(spark, sf_dir: str) -> DataFrame:
    """Rule counts and verdicts of the whole ``documents`` table."""
    return rule_verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
