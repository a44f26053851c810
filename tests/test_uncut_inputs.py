"""Columns, null groups and wide counts that must not be lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortwise import StudyWindow
from cohortwise.operators import cohort as C
from cohortwise.operators import codelists as K
from cohortwise.operators import report as R
from cohortwise.operators.spells import merge_spells

W = StudyWindow(start=dt.date(2000, 1, 1), end=dt.date(2010, 12, 31), events_from=dt.date(1990, 1, 1))


def test_attributes_of_any_name_are_carried(spark):
    rows = spark.sql(
        "select 1 person_id, date'1970-01-01' birth_dt, cast(null as date) death_dt, '1' sex_cd, 30 age_at_start,"
        " 'x' ethnicity_code, 7 `second group`, 'a' area_cd, 'p' practice_id, date'1999-01-01' active_from, date'2005-01-01' active_to"
    )
    areas = spark.sql("select 'a' area_cd, 1 dep1_quintile, 2 dep2_quintile")
    lookup = [c for c in ("dep_score",) if c not in areas.columns]
    areas = areas.withColumns({c: F.lit(1) for c in lookup})
    out = C.deprivation_map(rows, areas, W)
    assert out.select("ethnicity_code", "`second group`").first() == ("x", 7)
    assert len(out.columns) == len(set(out.columns))


@pytest.mark.parametrize("rule", ["pairwise", "running_max"])
def test_null_person_is_a_group(spark, rule):
    d = dt.date
    table = [
        (None, d(2000, 1, 1), d(2001, 1, 1)),
        (None, d(2003, 1, 1), d(2004, 1, 1)),
        (1, d(2000, 1, 1), d(2001, 1, 1)),
        (1, d(2001, 1, 1), d(2002, 1, 1)),
        (1, d(2005, 1, 1), d(2006, 1, 1)),
    ]
    spells = spark.createDataFrame(table, "person_id long, active_from date, active_to date")
    got = merge_spells(spells, W, rule).collect()
    assert len(got) == 4 and sum(r.person_id is None for r in got) == 2


def test_counts_beyond_64_bits(spark):
    big = spark.range(3).select(F.lit("c").alias("concept"), F.col("id").alias("person_id"))
    got = R.records_per_person(big, "gp").first()
    assert (got.n_persons, got.mean_records, got.sd_records) == (3, 1.0, 0.0)


def test_three_character_code_with_a_blank(spark):
    codes = spark.createDataFrame([("A01 ", "c", "condition", 0)], "code string, concept string, concept_type string, sensitive int")
    names = spark.createDataFrame(
        [("A01 ", "A01 ", "title", None)], "code string, alt_code string, description string, effective_to date"
    )
    assert [r.code_length for r in K.icd10_lookup(codes, names).collect()] == [3]
