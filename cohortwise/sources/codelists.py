"""Codelist CSV source and sink.

A codelist directory holds one CSV per concept. Headers are not trusted
(two of them differ only by letter case, one has a trailing blank), so files
are read with a positional schema. Codes stay strings: values such as
``5136.`` or ``7E253`` must never be inferred as numbers.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.plans.sizing import small_side
from cohortwise.sources import smallfiles

# Column order of the published codelist files.
READ_V2_HEADER = ["code", "DESCRIPTION_EXTERNAL ", "concept", "description", "DESCRIPTION", "CONCEPT TYPE"]
ICD10_HEADER = ["code", "description", "concept", "DESCRIPTION", "CONCEPT TYPE"]

_HEADERS = {"readv2": READ_V2_HEADER, "icd10": ICD10_HEADER}
_POSITIONAL = {
    "readv2": ["code", "description_external", "concept_col", "description_a", "description_b", "concept_type"],
    "icd10": ["code", "description_a", "concept_col", "description_b", "concept_type"],
}


def codelist_schema(vocab: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in _POSITIONAL[vocab]])


def read_codelists(
    spark: SparkSession, path: str, vocab: str, version: str, concept_from: str = "file"
) -> DataFrame:
    """All codelist CSVs under ``path`` -> (concept, version, code, concept_type).

    ``concept_from="file"`` takes the concept from the file name (``TIA.csv``
    -> ``TIA``), ``"column"`` from the concept column inside the file.
    Codes are right-trimmed, since fixed-width sources pad them with blanks.
    """
    raw = (
        spark.read.schema(codelist_schema(vocab))
        .option("header", True)
        .option("enforceSchema", True)
        .option("recursiveFileLookup", True)
        .csv(path)
    )
    if concept_from == "file":
        concept = F.regexp_extract(F.input_file_name(), r"([^/]+)\.csv$", 1)
    elif concept_from == "column":
        concept = F.col("concept_col")
    else:
        raise ValueError(concept_from)
    return raw.select(
        concept.alias("concept"),
        F.lit(version).alias("version"),
        F.rtrim("code").alias("code"),
        F.col("concept_type"),
    )


def write_codelists(df: DataFrame, path: str, vocab: str = "readv2") -> None:
    """Write (concept, code, concept_type[, description]) rows as codelist CSVs
    in the published column order, one directory per concept.

    Spark refuses column names that differ only by case, so the second
    description column is written as ``DESCRIPTION_2``; readers are
    positional and ignore header names."""
    desc = F.col("description") if "description" in df.columns else F.lit(None).cast("string")
    header = [h if h != "DESCRIPTION" else "DESCRIPTION_2" for h in (READ_V2_HEADER if vocab == "readv2" else ICD10_HEADER)]
    if vocab == "readv2":
        cols = [F.col("code"), desc, F.col("concept"), desc, desc, F.col("concept_type")]
    else:
        cols = [F.col("code"), desc, F.col("concept"), desc, F.col("concept_type")]
    out = df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)], F.col("concept").alias("concept_dir"))
    out = out.toDF(*header, "concept_dir")
    out.write.mode("overwrite").option("header", True).partitionBy("concept_dir").csv(path)


def read_code_list(spark: SparkSession, path: str, column: str = "code") -> DataFrame:
    """A plain list of codes (for example the sensitive-code list) from CSV
    files with a header: only ``column`` is kept, as a string, right-trimmed."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return raw.select(F.rtrim(F.col(f"`{column}`")).alias("code")).where(F.col("code").isNotNull())


def scan_codelists(spark: SparkSession, path: str, vocab: str, version: str) -> DataFrame:
    """All lines of the ``<concept>.csv`` files under ``path``, checked.

    Returns ``concept`` (the file's name), ``version``, ``code`` (right-trimmed),
    ``concept_type``, ``problem`` and ``line``. Good rows have a null problem and
    line. The others are set aside, not dropped: code and type are null, ``line``
    is the raw text and ``problem`` the first that applies of

    * ``layout``: the file lacks the header of this vocabulary (names compared
      without blanks around them), so none of its lines can be trusted;
    * ``columns``: not the header's number of fields;
    * ``no code``: the code is missing or blank;
    * ``concept``: the concept column is missing or names another concept.

    Blank lines and header lines are no rows; an empty file or folder gives
    none. Repeated lines return as often as they stand. A line is a record, so
    a quoted line break splits one into two with ``columns``.
    """
    names = _POSITIONAL[vocab]
    name = F.regexp_replace(F.regexp_extract("_metadata.file_path", r"([^/]+)\.csv$", 1), r"\+", "%2B")
    value = F.regexp_replace("value", "^\ufeff", "")
    lines = (
        spark.read.schema("value string")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .text(path)
        .select(F.url_decode(name).alias("concept"), F.col("_metadata.file_path").alias("file"), value.alias("line"))
        .where(F.trim("line") != "")
    )
    schema = ", ".join(f"{n} string" for n in [*names, "unread"])
    parsed = lines.withColumn("r", F.from_csv("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "unread"}))
    is_header = F.col("r.unread").isNull()
    for n, title in zip(names, _HEADERS[vocab], strict=True):
        is_header &= F.coalesce(F.trim(f"r.{n}") == title.strip(), F.lit(False))
    parsed = parsed.withColumn("is_header", is_header)
    files = parsed.groupBy("file").agg(F.bool_or("is_header").alias("known"))
    problem = (
        F.when(~F.col("known"), "layout")
        .when(F.col("r.unread").isNotNull(), "columns")
        .when(F.coalesce(F.trim("r.code"), F.lit("")) == "", "no code")
        .when(~F.trim("r.concept_col").eqNullSafe(F.col("concept")), "concept")
    )
    rows = parsed.where("NOT is_header").join(small_side(files), "file").withColumn("problem", problem)
    good = F.col("problem").isNull()
    return rows.select(
        "concept",
        F.lit(version).alias("version"),
        F.when(good, F.rtrim("r.code")).alias("code"),
        F.when(good, F.col("r.concept_type")).alias("concept_type"),
        "problem",
        F.when(~good, F.col("line")).alias("line"),
    )


def codelist_lines(df: DataFrame, vocab: str, file: str = "concept") -> DataFrame:
    """Rows ``(concept, code, concept_type, description)`` as lines of the
    published layout: ``file`` (from the column of that name), ``place`` (0 for
    each file's header, else 1) and ``line``. Nulls become empty fields."""
    desc = F.col("description")
    if vocab == "readv2":
        cols = [F.col("code"), desc, F.col("concept"), desc, desc, F.col("concept_type")]
    else:
        cols = [F.col("code"), desc, F.col("concept"), desc, F.col("concept_type")]
    rows = df.select(
        F.col(file).alias("file"), F.lit(1).alias("place"), F.to_csv(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)])).alias("line"), "code"
    )
    heads = rows.select("file").distinct().select("file", F.lit(0).alias("place"), F.lit(",".join(_HEADERS[vocab])).alias("line"), F.lit(None).alias("code"))
    return heads.unionByName(rows)


def write_codelist_files(lines: DataFrame, path: str) -> None:
    """Write ``lines(file, place, line)`` as one ``<file>.csv`` each in ``path``.

    A file's lines are sorted by place and text, in one task: a code list is a
    file of a dictionary's size by nature, whatever the data it is used on. The
    files are written beside and renamed one by one, so a reader never sees a
    part of one; a file of the same name is replaced, others stay.
    """
    spark = lines.sparkSession
    beside = f"{path}/_parts-{uuid.uuid4().hex}"
    placed = lines.select(F.col("file").alias("concept_dir"), "place", "line")
    placed = placed.repartition("concept_dir").sortWithinPartitions("concept_dir", "place", "line")
    placed.select("concept_dir", F.col("line").alias("value")).write.partitionBy("concept_dir").text(beside)
    for folder in smallfiles.names(spark, beside):
        (part,) = smallfiles.names(spark, f"{beside}/{folder}")
        name = unquote(folder.partition("=")[2])
        if "/" in name:
            raise ValueError(f"{name!r} cannot name a file")
        smallfiles.move(spark, f"{beside}/{folder}/{part}", f"{path}/{name}.csv")
    smallfiles.drop(spark, beside)
