"""Whole-study invariants on the smallest test tables."""

import os

import pytest
from pyspark.sql import functions as F

from cohortwise.operators import extract as E
from cohortwise.operators import report as R
from cohortwise.plans.study import LINKAGE_GROUPS, Study

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def study(spark):
    return Study(spark, SF)


def test_group_flags_are_max_of_members(study):
    link = study.linkage
    for group, members in LINKAGE_GROUPS.items():
        bad = link.where(F.col(group) != F.greatest(*[F.col(m) for m in members])).count()
        assert bad == 0


def test_linkage_keeps_every_cohort_person(study):
    assert study.linkage.count() == study.cohort.select("person_id").distinct().count()


def test_incident_plus_prevalent_is_total(study):
    rows = R.incident_prevalent(study.gp_enriched, study.hosp_enriched, study.w).collect()
    assert rows
    for r in rows:
        if r.gp_total is not None:
            assert r.gp_incident + r.gp_prevalent == r.gp_total
        if r.hosp_total is not None:
            assert r.hosp_incident + r.hosp_prevalent == r.hosp_total


def test_men_plus_women_at_most_persons(study):
    for r in R.person_counts(study.gp_enriched, study.hosp_enriched).collect():
        for src in ("gp", "hosp", "any"):
            n = getattr(r, f"n_persons_{src}")
            if n is not None:
                assert getattr(r, f"n_male_{src}") + getattr(r, f"n_female_{src}") <= n  # people without a sex code count in neither


def test_extracts_are_subsets_of_sources(study):
    gp = study.gp_extract.select("person_id", "local_id", "event_cd", "event_dt")
    src = study.fx.gp_event.select("person_id", "local_id", "event_cd", "event_dt")
    assert gp.join(src, gp.columns, "left_anti").count() == 0
    cohort = study.cohort.select("person_id")
    for name, df in study.extracts().items():
        assert df.join(cohort, "person_id", "left_anti").count() == 0, name


def test_rewriting_one_year_leaves_other_years(spark, study, tmp_path):
    path = str(tmp_path / "gp")
    ext = study.gp_extract
    E.write_extract(ext, path, "event_dt")
    before = {r.year: r.n for r in spark.read.parquet(path).groupBy("year").agg(F.count("*").alias("n")).collect()}
    one = ext.where(F.year("event_dt") == 1998).limit(3)
    E.write_extract(one, path, "event_dt")
    after = {r.year: r.n for r in spark.read.parquet(path).groupBy("year").agg(F.count("*").alias("n")).collect()}
    assert after[1998] == 3
    assert {y: n for y, n in after.items() if y != 1998} == {y: n for y, n in before.items() if y != 1998}


def test_report_csv(spark, study, tmp_path):
    rep = R.concept_report(study.gp_enriched, study.hosp_enriched, ["ECONOMY"])
    path = str(tmp_path / "report")
    R.write_report_csv(rep, path)
    back = spark.read.option("header", True).csv(path)
    assert back.count() == rep.count() and len(back.columns) == 87
