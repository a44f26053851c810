"""Codelists: versioning, change detection, sensitivity flags and validated
lookups against the Read v2 and ICD-10 dictionaries.

All concepts live in one table with ``concept`` (and ``version``) as columns,
so every operator is one set-oriented plan instead of a loop over concepts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.plans.sizing import small_side


def version_key(col: str = "version"):
    """'2_2_10' -> [2, 2, 10] so that versions compare numerically."""
    return F.transform(F.split(F.col(col), "_"), lambda x: x.cast("int"))


def latest_version(versioned: DataFrame, concept: str = "concept", version: str = "version") -> DataFrame:
    """Rows of each concept's highest version (2_2_10 > 2_2_9)."""
    latest = versioned.groupBy(concept).agg(F.max(version_key(version)).alias("_vkey"))
    return (
        versioned.withColumn("_vkey", version_key(version))
        .join(latest, [concept, "_vkey"], "left_semi")
        .drop("_vkey")
    )


def codelist_diff(new: DataFrame, published: DataFrame, keys: Sequence[str] = ("concept", "code", "concept_type")) -> DataFrame:
    """Per concept: 'new' (not published before), 'not updated' (published, not
    re-imported), 'unchanged' (re-imported with identical rows), 'updated'.
    Rows are compared as multisets; n_added / n_removed count row copies."""
    keys = list(keys)
    n = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_new"))
    p = published.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_pub"))
    both = n.join(p, keys, "full_outer").select(
        *keys,
        F.coalesce("n_new", F.lit(0)).alias("n_new"),
        F.coalesce("n_pub", F.lit(0)).alias("n_pub"),
    )
    per = both.groupBy("concept").agg(
        F.sum("n_new").alias("rows_new"),
        F.sum("n_pub").alias("rows_pub"),
        F.sum(F.greatest(F.col("n_new") - F.col("n_pub"), F.lit(0))).alias("n_added"),
        F.sum(F.greatest(F.col("n_pub") - F.col("n_new"), F.lit(0))).alias("n_removed"),
    )
    status = (
        F.when(F.col("rows_pub") == 0, "new")
        .when(F.col("rows_new") == 0, "not updated")
        .when((F.col("n_added") == 0) & (F.col("n_removed") == 0), "unchanged")
        .otherwise("updated")
    )
    return per.select(
        "concept", status.alias("status"), F.col("n_added").cast("bigint").alias("n_added"),
        F.col("n_removed").cast("bigint").alias("n_removed"),
    )


def codelist_build(new: DataFrame, published: DataFrame, keys: Sequence[str] = ("concept", "code", "concept_type")) -> DataFrame:
    """The code list to build from: concepts that ``codelist_diff`` calls new or
    updated with their new rows, all others with their published ones."""
    keys = list(keys)
    changed = codelist_diff(new, published, keys).where("status IN ('new', 'updated')").select("concept")
    return new.select(*keys).join(changed, "concept", "left_semi").unionByName(
        published.select(*keys).join(changed, "concept", "left_anti")
    )


def flag_sensitive(codes: DataFrame, sensitive_codes: DataFrame, sensitive_concepts: Sequence[str]) -> DataFrame:
    """Add ``sensitive`` = 1 for every code of a sensitive concept, else 1 when
    the code is on the sensitive-code list, else 0."""
    listed = sensitive_codes.select(F.rtrim("code").alias("code")).distinct().withColumn("_listed", F.lit(1))
    j = codes.join(small_side(listed), "code", "left")
    flag = F.when(F.col("concept").isin(list(sensitive_concepts)), 1).when(F.col("_listed") == 1, 1).otherwise(0)
    return j.select(*codes.columns, flag.alias("sensitive"))


def _current(df: DataFrame) -> DataFrame:
    return df.where(F.col("effective_to").isNull())


def read_lookup(codes: DataFrame, read_dict: DataFrame) -> DataFrame:
    """Codes present in the current Read dictionary with the longest available
    preferred term -> (code, description, sensitive, concept, concept_type)."""
    d = _current(read_dict).select(
        F.col("read_code").alias("code"), F.coalesce("term_198", "term_60", "term_30").alias("description")
    )
    return (
        codes.join(d, "code")
        .select("code", "description", F.col("sensitive").cast("int").alias("sensitive"), "concept", "concept_type")
        .distinct()
    )


def medication_lookup(codes: DataFrame, read_dict: DataFrame) -> DataFrame:
    """Medication codelist variant with alternative code and drug category."""
    d = _current(read_dict).select(
        F.col("read_code").alias("code"), F.coalesce("term_198", "term_60", "term_30").alias("description")
    )
    return (
        codes.join(d, "code")
        .select(
            "code", "description", "alt_code", "drug_category", "concept_type",
            F.col("sensitive").cast("int").alias("sensitive"), "concept",
        )
        .distinct()
    )


def icd10_lookup(codes: DataFrame, icd_dict: DataFrame) -> DataFrame:
    """Validated ICD-10 lookup.

    Codes of four or more characters match the dictionary's alternative
    (undotted) code and take the title of their three-character parent; three
    character codes match the dictionary code and use their own title twice.
    Only current dictionary entries count. A parent with several current
    titles takes the smallest, so the result stays one row per code.
    """
    cur = _current(icd_dict)
    c = codes.select(
        "code", "concept", "concept_type", F.col("sensitive").cast("int").alias("sensitive"),
        F.substring("code", 1, 3).alias("code3"), F.length(F.rtrim("code")).cast("int").alias("code_length"),
    )
    titles = cur.groupBy(F.col("code").alias("code3")).agg(F.min("description").alias("title3"))
    long_codes = (
        c.where(F.col("code_length") >= 4)
        .join(cur.select(F.col("alt_code").alias("code"), "description"), "code")
        .join(titles, "code3", "left")
    )
    short_codes = (
        c.where(F.col("code_length") == 3)
        .join(cur.select("code", "description"), "code")
        .withColumn("title3", F.col("description"))
    )
    cols = ["code", "description", "code3", "title3", "code_length", "sensitive", "concept", "concept_type"]
    return long_codes.select(*cols).unionByName(short_codes.select(*cols)).distinct()
