"""A corpus pipeline of five stages over the documents of one directory.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last return the columns of ``documents``, and any further ones, whatever
their names. ``run`` writes what a stage
returns as Parquet in the shared folder and gives that to the next.

* quality: documents that the classifier rejects go.
* near_duplicates: one document of each group of similar ones stays.
* substrings: words of passages that an earlier document has are removed.
* decontamination: documents that hold a benchmark item go.
* packing: the rest is packed into bins of permitted lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm.decontaminate import clean_documents
from cohortwise.llm.jaccard import one_of_each
from cohortwise.llm.packing import best_fit_bins
from cohortwise.llm.quality import good_documents
from cohortwise.llm.store import stage
from cohortwise.llm.substring import drop_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a calibrated quality of at least 0.7.

    A null text scores as an empty one; repeated rows and ties share a score,
    so they stay or go together; a null id is scored too. Without any label
    that can be learned from, and on an empty table, no row goes.
    """
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group linked by similarity 0.8.

    Null, empty and blank texts are in no group and stay, as do rows without
    an id. Repeated rows of one id and text become one. An empty table stays
    empty.
    """
    return one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 13 words that earlier ones have.

    Every row stays, if need be with an empty text; rows that share an id
    count as one place in the order, so they take nothing from each other, and
    rows without an id neither lose nor take words. Null texts stay null. An
    empty table stays empty.
    """
    kept = drop_repeats(docs)
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item.

    Null and empty texts hold none and stay; repeated rows stay or go
    together, with or without an id. An empty benchmark takes nothing; an
    empty table stays empty.
    """
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece of the remaining documents.

    A null or empty text is a piece of length 1; repeated rows and rows
    without an id are packed like others; ties in length go by id. An empty
    table gives no rows.
    """
    return best_fit_bins(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The classifier is not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
