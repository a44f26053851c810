"""Cohort selection edge cases: registries, start flags, exit reason."""

from conftest import d

from cohortwise.functions.study import StudyWindow
from cohortwise.operators import cohort as C

W = StudyWindow(start=d("2000-01-01"), end=d("2000-12-31"), events_from=d("1990-01-01"))
SPELL = "person_id long, birth_dt date, death_dt date, sex_cd string, area_cd string, practice_id long, active_from date, active_to date"
BIRTH = "person_id long, birth_dt date, neonate_sex_cd string, birth_valid string"
DEATH = "person_id long, death_dt date, death_valid string"


def test_registry_agreement(spark):
    spells = spark.createDataFrame(
        [
            (1, d("1950-01-01"), None, "1", "A", 1, d("1999-01-01"), None),  # equal birth, no deaths
            (2, d("1950-01-01"), None, "1", "A", 1, d("1999-01-01"), None),  # birth differs
            (3, None, None, "1", "A", 1, d("1999-01-01"), None),  # birth only in registry
            (4, None, None, "1", "A", 1, d("1999-01-01"), None),  # birth nowhere
            (5, d("1950-01-01"), d("2001-01-01"), "1", "A", 1, d("1999-01-01"), None),  # death differs
        ],
        SPELL,
    )
    births = spark.createDataFrame(
        [(1, d("1950-01-01"), "1", "Valid"), (2, d("1951-01-01"), "1", "Valid"), (3, d("1952-01-01"), "2", "Invalid"),
         (5, d("1950-01-01"), "1", "Valid")],
        BIRTH,
    )
    deaths = spark.createDataFrame([(5, d("2002-01-01"), "Valid")], DEATH)
    valid = {r.person_id for r in C.valid_registry_people(spells, births, deaths).collect()}
    assert valid == {1, 3}


def test_reconcile_prefers_valid_registry_values(spark):
    spells = spark.createDataFrame(
        [
            (1, d("1950-01-01"), None, None, "A", 1, d("1999-01-01"), None),
            (2, d("1950-01-01"), d("2003-01-01"), "2", "A", 1, d("1999-01-01"), d("2000-05-01")),
            (2, d("1951-01-01"), d("2003-01-01"), "2", "A", 1, d("1999-01-01"), d("2000-05-01")),
        ],
        SPELL,
    )
    births = spark.createDataFrame(
        [(1, d("1949-01-01"), "1", "Invalid"), (2, d("1951-01-01"), "1", "Valid")], BIRTH
    )
    deaths = spark.createDataFrame([(2, d("2004-01-01"), "Valid")], DEATH)
    valid = spark.createDataFrame([(1,), (2,)], "person_id long")
    rows = {(r.person_id, r.birth_dt, r.death_dt, r.sex_cd, r.active_to) for r in
            C.reconcile_demographics(spells, births, deaths, valid).collect()}
    assert rows == {
        (1, d("1950-01-01"), None, "1", d("9999-01-01")),  # Invalid registry birth keeps own; sex from registry
        (2, d("1951-01-01"), d("2004-01-01"), "2", d("2000-05-01")),  # both rows become the registry value
    }


def test_start_flag_counts_covering_spells(spark):
    rows = spark.createDataFrame(
        [(1, d("1999-01-01"), d("2000-06-01")), (1, d("1999-06-01"), d("2000-02-01")), (2, d("2000-03-01"), d("2000-04-01"))],
        "person_id long, active_from date, active_to date",
    )
    out = {(r.person_id, r.active_from): (r.flag_start, r.later_dt, r.covers_start) for r in
           C.cohort_start_flags(rows, W).collect()}
    assert out[(1, d("1999-01-01"))] == (2, None, 1)
    assert out[(2, d("2000-03-01"))] == (0, d("2000-03-01"), 0)


def _reason(spark, death, end, flag_fu=0):
    rows = spark.createDataFrame([(1, death)], "person_id long, death_dt date")
    isl = spark.createDataFrame([(1, d("2000-01-01"), end, 1)], "person_id long, entry_dt date, exit_dt date, rw_seq int")
    brk = spark.createDataFrame([(1, flag_fu)], "person_id long, flag_fu int")
    return C.exit_reason(rows, isl, brk, W).collect()[0].exit_reason


def test_exit_reason_grace_period(spark):
    end = d("2000-06-01")
    assert _reason(spark, d("2000-06-01"), end) == "DEATH"
    assert _reason(spark, d("2000-06-08"), end) == "DEATH"
    assert _reason(spark, d("2000-06-09"), end) == "LOST TO FOLLOW UP"
    assert _reason(spark, None, end) == "LOST TO FOLLOW UP"
    assert _reason(spark, None, end, flag_fu=1) == "LOST TO FOLLOW UP BREAK"
    assert _reason(spark, None, d("9999-01-01")) is None
    # death after the window with an open end still counts as death
    assert _reason(spark, d("2005-01-01"), d("9999-01-01")) == "DEATH"


def test_deprivation_second_label_from_raw_value(spark):
    areas = spark.createDataFrame([("A", 1, 1), ("B", 5, 4)], "area_cd string, dep1_quintile int, dep2_quintile int")
    out = {r.area_cd: r for r in C.deprivation_lookup(areas).collect()}
    assert (out["A"].dep2_quintile, out["A"].dep2_desc) == (5, "5. Least Deprived")
    assert (out["B"].dep2_quintile, out["B"].dep2_desc) == (2, "2.")
    assert out["B"].dep1_desc == "5. Least Deprived"


def test_consort_flow_counts_distinct_persons(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "person_id long")
    b = spark.createDataFrame([(2,)], "person_id long")
    out = [(r.step_no, r.step, r.n) for r in C.consort_flow([("all", a), ("kept", b)]).orderBy("step_no").collect()]
    assert out == [(1, "all", 2), (2, "kept", 1)]
