"""Distinct persons of many tables in one shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_TABLES = 63  # bits of a long, less the sign


def person_bits(tables: Mapping[str, DataFrame], person: str = "person_id") -> DataFrame:
    """``(person, bits)``: bit i is set where table i holds the person.

    Rows are or-ed by person before the one shuffle, so neither repeated rows
    nor a person with a large share of them cost more than one row a task.
    """
    if not 0 < len(tables) <= MOST_TABLES:
        raise ValueError(f"one to {MOST_TABLES} tables")
    tagged = None
    for i, df in enumerate(tables.values()):
        part = df.select(F.col(person).alias("person"), F.lit(1 << i).cast("long").alias("bit"))
        tagged = part if tagged is None else tagged.unionAll(part)
    return tagged.where("person is not null").groupBy("person").agg(F.bit_or("bit").alias("bits"))


def persons_by_tag(
    tables: Mapping[str, DataFrame], tag: str, person: str = "person_id", number: str | None = None
) -> DataFrame:
    """Distinct persons of each table -> ``(tag, n)``, a row a table in their order; null persons do not count.

    ``number`` names a column that counts the tables from 1.
    """
    bits = person_bits(tables, person)
    sums = bits.agg(*[F.coalesce(F.sum(F.getbit("bits", F.lit(i)).cast("long")), F.lit(0).cast("long")).alias(f"n{i}") for i in range(len(tables))])
    rows = []
    for i, name in enumerate(tables):
        lead = [F.lit(i + 1).alias(number)] if number else []
        rows.append(F.struct(*lead, F.lit(name).alias(tag), F.col(f"n{i}").alias("n")))
    return sums.select(F.inline(F.array(*rows)))
