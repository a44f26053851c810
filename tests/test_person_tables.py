"""Stages kept as tables bucketed by person: same rows, fewer shuffles."""

import re
from collections import Counter

import pytest

from cohortwise.plans.study import Study

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def studies(spark):
    """Studies with plain and with bucketed stages, planned without broadcasts of measured sides."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    made = {kind: Study(spark, SF_DIR, materialize=kind) for kind in ("parquet", "bucketed")}
    yield made
    for key, value in before.items():
        spark.conf.set(key, value)


def shuffles_by_person(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning\(person_id#", plan))


def rows(df):
    return Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


def test_bucketed_tables_hold_the_same_rows(studies):
    plain, bucketed = studies["parquet"], studies["bucketed"]
    assert rows(bucketed.cohort) == rows(plain.cohort) and bucketed.cohort.count() > 0
    assert rows(bucketed.cohort_uniqueness()) == rows(plain.cohort_uniqueness())
    assert rows(bucketed.islands) == rows(plain.islands)


@pytest.mark.parametrize("name", ["linkage", "history", "evolution", "breaks", "gp_extract"])
def test_person_joins_spare_a_shuffle(studies, name):
    plain, bucketed = (getattr(studies[kind], name) for kind in ("parquet", "bucketed"))
    assert rows(bucketed) == rows(plain)
    if name not in ("history", "gp_extract"):  # written stages: their plan is a scan
        assert shuffles_by_person(bucketed) < shuffles_by_person(plain)


def test_a_person_table_needs_no_shuffle_for_its_persons(studies):
    cohort = studies["bucketed"].cohort
    persons = cohort.select("person_id").distinct()
    assert shuffles_by_person(persons) == 0
    joined = cohort.join(studies["bucketed"].islands.groupBy("person_id").count(), "person_id")
    assert shuffles_by_person(joined) == 0
    assert shuffles_by_person(studies["parquet"].cohort.select("person_id").distinct()) == 1
