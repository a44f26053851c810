"""Cohort-restricted extracts of event sources.

The restriction to the cohort is an early join (or semi join) on the person,
and date bounds are plain filters, so Catalyst pushes them into the Parquet
scan. Writing an extract is one partitioned write (by year) with dynamic
partition overwrite; where the source comes in chunks, ``load_range`` appends
one half-open date range at a time and can be started again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.operators.counts import persons_by_tag
from cohortwise.operators.linkage import _in_range
from cohortwise.plans.sizing import FILE_BYTES, advisory_bytes, write_balanced
from cohortwise.sources import smallfiles


def extract_by_person(
    source: DataFrame,
    cohort: DataFrame,
    attach: Sequence[str] = (),
    date_col: str | None = None,
    lo: dt.date | None = None,
    hi: dt.date | None = None,
    closed: bool = True,
    where: str | None = None,
) -> DataFrame:
    """Rows of cohort members within [lo, hi] (or [lo, hi) with
    ``closed=False``) with cohort columns attached. As in a plain inner join,
    a person with several cohort rows yields each source row once per row."""
    rows = source
    if where:
        rows = rows.where(where)
    if date_col is not None:
        rows = rows.where(_in_range(date_col, lo, hi, closed))
    return rows.join(cohort.select("person_id", *attach), "person_id").select(
        *[F.col(c) for c in source.columns], *[F.col(c) for c in attach]
    )


def extract_by_spell(
    child: DataFrame,
    spells: DataFrame,
    date_col: str | None = None,
    lo: dt.date | None = None,
    hi: dt.date | None = None,
    closed: bool = False,
    keys: Sequence[str] = ("provider_cd", "spell_id"),
    attach: Sequence[str] = ("person_id", "birth_dt"),
) -> DataFrame:
    """Child records (episodes, diagnoses, operations) of already extracted
    spells, with the spell's person and birth date attached."""
    rows = child if date_col is None else child.where(_in_range(date_col, lo, hi, closed))
    return rows.join(spells.select(*keys, *attach), list(keys))


def extract_semi(source: DataFrame, cohort: DataFrame) -> DataFrame:
    """Rows of cohort members, source columns only."""
    return source.join(cohort.select("person_id"), "person_id", "left_semi")


def extract_via_parent(
    child: DataFrame,
    parent: DataFrame,
    keys: Sequence[str],
    cohort: DataFrame,
    date_col: str,
    lo: dt.date | None = None,
    hi: dt.date | None = None,
) -> DataFrame:
    """Child rows with the person id of the parent row with the same keys
    (repeated parents repeat the child), cohort members only, child date in
    [lo, hi]."""
    rows = child.join(parent.select(*keys, "person_id"), list(keys))
    rows = rows.join(cohort.select("person_id"), "person_id", "left_semi")
    return rows.where(_in_range(date_col, lo, hi)).select(*child.columns, "person_id")


def extract_checks(extracts: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct persons per extract -> (extract, n)."""
    return persons_by_tag(extracts, "extract")


def write_extract(
    df: DataFrame, path: str, date_col: str, partition_by: str = "year", fmt: str = "parquet", file_bytes: int = FILE_BYTES
) -> None:
    """Persist an extract partitioned by year of ``date_col``.

    Dynamic partition overwrite replaces only the years present in ``df``, so
    re-running one year leaves the others untouched. The rows are rebalanced by
    year: a year is written in files of about ``file_bytes`` shuffled bytes, a
    hot year by several tasks, several small years by one.
    """
    write_balanced(df.withColumn(partition_by, F.year(date_col)), path, [partition_by], file_bytes, fmt, dynamic=True)


def _range_name(lo: dt.date, hi: dt.date) -> str:
    return f"{lo.isoformat()}_{hi.isoformat()}"


def loaded_ranges(spark: SparkSession, path: str) -> list[tuple[dt.date, dt.date]]:
    """The half-open date ranges that the ledger of a chunked load lists, in order."""
    names = smallfiles.names(spark, f"{path}/ledger")
    return sorted(tuple(dt.date.fromisoformat(x) for x in name.split("_")) for name in names)


def load_range(df: DataFrame, path: str, date_col: str, lo: dt.date, hi: dt.date, file_bytes: int = FILE_BYTES) -> bool:
    """Append the rows of ``df`` with ``lo <= date_col < hi`` to a chunked load, once.

    A chunk is a folder of its own, named after its range, and counts when the
    ledger lists the range, which is written last. So a load that broke off is
    done again from the start, over what it left; a range that the ledger lists
    is skipped (returns False); one that overlaps a listed range, without being
    it, is refused. Rows without a date belong to no chunk.
    """
    spark = df.sparkSession
    if lo >= hi:
        raise ValueError(f"empty range {lo} .. {hi}")
    for a, b in loaded_ranges(spark, path):
        if (a, b) == (lo, hi):
            return False
        if lo < b and a < hi:
            raise ValueError(f"{lo} .. {hi} overlaps the loaded range {a} .. {b}")
    rows = df.where(_in_range(date_col, lo, hi, closed=False)).hint("rebalance")
    with advisory_bytes(spark, file_bytes):
        rows.write.mode("overwrite").parquet(f"{path}/chunks/{_range_name(lo, hi)}")
    smallfiles.put(spark, f"{path}/ledger/{_range_name(lo, hi)}", "")
    return True


def read_loaded(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of the listed chunks of a chunked load (None before the first one)."""
    folders = [f"{path}/chunks/{_range_name(lo, hi)}" for lo, hi in loaded_ranges(spark, path)]
    return spark.read.parquet(*folders) if folders else None
