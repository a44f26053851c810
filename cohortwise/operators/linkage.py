"""Which data sources hold records for each cohort member.

Each source contributes the person ids of its records inside a date range.
All sources are tagged and unioned, so the per-person flags come from a
single aggregation over one shuffle by person (combined map-side, which also
removes repeated ids), and one left join from the cohort's persons supplies
the zeros.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.operators.counts import person_bits


def _in_range(col: str, lo: dt.date | None, hi: dt.date | None, closed: bool = True):
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) >= F.lit(lo))
    if hi is not None:
        cond = cond & ((F.col(col) <= F.lit(hi)) if closed else (F.col(col) < F.lit(hi)))
    return cond


def record_keys(
    source: DataFrame, date_col: str | None = None, lo: dt.date | None = None, hi: dt.date | None = None,
    person: str = "person_id",
) -> DataFrame:
    """Person ids of records whose date lies in [lo, hi] (one per record;
    ``source_flag`` and ``linkage_table`` de-duplicate while aggregating, so
    no separate shuffle is spent on it here)."""
    rows = source if date_col is None else source.where(_in_range(date_col, lo, hi))
    return rows.select(F.col(person).alias("person_id"))


def record_keys_via_parent(
    child: DataFrame, parent: DataFrame, keys: Sequence[str], date_col: str,
    lo: dt.date | None = None, hi: dt.date | None = None,
) -> DataFrame:
    """Persons of child records that carry no person id themselves: the id
    comes from the parent record with the same keys; the date is the child's."""
    c = child.where(_in_range(date_col, lo, hi)).select(*keys)
    return c.join(parent.select(*keys, "person_id"), list(keys)).select("person_id")


def registry_keys(cohort: DataFrame, registry: DataFrame, cohort_date_col: str, hi: dt.date) -> DataFrame:
    """Cohort persons whose own registry-derived date is on or before ``hi``
    and who appear in the registry."""
    c = cohort.where(F.col(cohort_date_col) <= F.lit(hi)).select("person_id")
    return c.join(registry.select("person_id"), "person_id", "left_semi")


def source_flag(cohort: DataFrame, keys: DataFrame, name: str = "flag") -> DataFrame:
    """0/1 per distinct cohort person: present in ``keys``."""
    persons = cohort.select("person_id").distinct()
    hit = keys.select("person_id").distinct().withColumn(name, F.lit(1))
    return persons.join(hit, "person_id", "left").select("person_id", F.coalesce(F.col(name), F.lit(0)).alias(name))


def source_flags_long(cohort: DataFrame, keys_by_source: Mapping[str, DataFrame]) -> DataFrame:
    """(person_id, source, flag) for every cohort person and source."""
    wide = linkage_table(cohort, keys_by_source, {})
    stacked = F.stack(
        F.lit(len(keys_by_source)),
        *[x for name in keys_by_source for x in (F.lit(name), F.col(name))],
    ).alias("source", "flag")
    return wide.select("person_id", stacked)


def linkage_table(
    cohort: DataFrame, keys_by_source: Mapping[str, DataFrame], groups: Mapping[str, Sequence[str]]
) -> DataFrame:
    """One row per cohort person with a 0/1 column per source and per group
    (a group flag is 1 when any member flag is 1)."""
    names = list(keys_by_source)
    tagged = None
    for name, keys in keys_by_source.items():
        part = keys.select("person_id", F.lit(name).alias("source"))
        tagged = part if tagged is None else tagged.unionByName(part)
    per_person = tagged.groupBy("person_id").agg(
        *[F.max(F.when(F.col("source") == n, 1).otherwise(0)).alias(n) for n in names]
    )
    persons = cohort.select("person_id").distinct()
    out = persons.join(per_person, "person_id", "left").select(
        "person_id", *[F.coalesce(F.col(n), F.lit(0)).cast("int").alias(n) for n in names]
    )
    for group, members in groups.items():
        out = out.withColumn(group, F.greatest(*[F.col(m) for m in members]).cast("int"))
    return out


def linkage_check(cohort: DataFrame, linkage: DataFrame) -> DataFrame:
    """Distinct persons before and after flagging (must be equal)."""
    bits = person_bits({"n_cohort": cohort, "n_linked": linkage})
    return bits.agg(*[F.count_if(F.getbit("bits", F.lit(i)) == 1).alias(name) for i, name in enumerate(("n_cohort", "n_linked"))])
