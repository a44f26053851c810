"""Linkage flags and extracts: date bounds, parent lookups, fan-out."""

import pytest
from conftest import d
from pyspark.sql import functions as F

from cohortwise.operators import extract as E
from cohortwise.operators import linkage as L
from cohortwise.operators import outcomes as O

KEYS = ("provider_cd", "case_id", "attend_dt", "att_id")
PARENT = "person_id long, provider_cd string, case_id long, attend_dt date, att_id long"
CHILD = "provider_cd string, case_id long, attend_dt date, att_id long, diag_cd string"


def test_parent_fan_out_repeats_child(spark):
    parent = spark.createDataFrame(
        [(1, "P", 5, d("2000-01-01"), 9), (1, "P", 5, d("2000-01-01"), 9), (2, "P", 6, d("2000-01-01"), 9)], PARENT
    )
    child = spark.createDataFrame([("P", 5, d("2000-01-01"), 9, "X01"), ("P", 6, d("1980-01-01"), 9, "X02")], CHILD)
    cohort = spark.createDataFrame([(1,), (2,)], "person_id long")
    out = E.extract_via_parent(child, parent, KEYS, cohort, "attend_dt", d("1990-01-01"), d("2000-12-31")).collect()
    assert [(r.person_id, r.diag_cd) for r in out] == [(1, "X01"), (1, "X01")]


def test_linkage_flags_bounds_and_groups(spark):
    cohort = spark.createDataFrame([(1,), (2,), (3,)], "person_id long")
    gp = spark.createDataFrame([(1, d("2000-12-31")), (2, d("2001-01-01")), (9, d("2000-01-01"))], "person_id long, event_dt date")
    adm = spark.createDataFrame([(2, d("1989-12-31")), (3, d("1990-01-01"))], "person_id long, start_date date")
    keys = {
        "flag_gp_events": L.record_keys(gp, "event_dt", d("1990-01-01"), d("2000-12-31")),
        "flag_hosp_adm": L.record_keys(adm, "start_date", d("1990-01-01"), d("2000-12-31")),
    }
    out = {r.person_id: (r.flag_gp_events, r.flag_hosp_adm, r.any_flag)
           for r in L.linkage_table(cohort, keys, {"any_flag": ["flag_gp_events", "flag_hosp_adm"]}).collect()}
    assert out == {1: (1, 0, 1), 2: (0, 0, 0), 3: (0, 1, 1)}
    flag = {r.person_id: r.flag for r in L.source_flag(cohort, keys["flag_gp_events"]).collect()}
    assert flag == {1: 1, 2: 0, 3: 0}


def test_half_open_and_closed_extract_bounds(spark):
    src = spark.createDataFrame([(1, d("2000-12-31")), (1, d("2000-12-30"))], "person_id long, end_date date")
    cohort = spark.createDataFrame([(1, d("1950-01-01"))], "person_id long, birth_dt date")
    closed = E.extract_by_person(src, cohort, ["birth_dt"], "end_date", d("1990-01-01"), d("2000-12-31"), closed=True)
    half = E.extract_by_person(src, cohort, ["birth_dt"], "end_date", d("1990-01-01"), d("2000-12-31"), closed=False)
    assert closed.count() == 2 and half.count() == 1


DIAG = "provider_cd string, spell_id long, epi_num string, diag_num int, diag_cd string, diag_cd_123 string, diag_cd_1234 string"
LOOK = "code string, description string, code3 string, title3 string, code_length int, sensitive int, concept string, concept_type string"


def _hospital(spark, lookup_rows, dict_rows):
    diag = spark.createDataFrame([("P", 1, "01", 1, "A011", "A01", "A011")], DIAG)
    epi = spark.createDataFrame([("P", 1, "01", d("2000-01-01"), d("2000-01-02"))],
                                "provider_cd string, spell_id long, epi_num string, epi_str_dt date, epi_end_dt date")
    spl = spark.createDataFrame([(7, "P", 1, d("2000-01-01"), d("2000-01-05"))],
                                "person_id long, provider_cd string, spell_id long, admis_dt date, disch_dt date")
    lk = spark.createDataFrame(lookup_rows, LOOK)
    dic = spark.createDataFrame(dict_rows, "code string, alt_code string, description string, effective_to date")
    return O.hospital_outcomes(diag, epi, spl, lk, dic).collect()


def test_diagnosis_matched_by_both_branches(spark):
    look = [("A01", "t3", "A01", "t3", 3, 0, "C", "c"), ("A011", "t4", "A01", "t3", 4, 0, "C", "c")]
    same = _hospital(spark, look, [("A01.1", "A011", "t4", None)])
    assert len(same) == 1  # equal descriptions collapse
    other = _hospital(spark, look, [("A01.1", "A011", "other text", None)])
    assert sorted(r.diag_cd_1234_desc for r in other) == ["other text", "t4"]


def test_five_character_codes_never_match(spark):
    look = [("A0112", "t5", "A01", "t3", 5, 0, "C", "c")]
    assert _hospital(spark, look, []) == []


def _events(spark, n=4000, parts=40):
    return spark.range(n, numPartitions=parts).selectExpr(
        "id % 50 as person_id", "date_add(date'2000-01-01', int(id * 37 % 3650)) as event_dt", "sha2(string(id), 256) as code"
    )


def test_files_of_a_year_follow_its_bytes(spark, tmp_path):
    """Many input partitions leave few files a year; a year beyond the bound is cut."""
    rows = _events(spark)
    few, cut = str(tmp_path / "few"), str(tmp_path / "cut")
    E.write_extract(rows, few, "event_dt")
    E.write_extract(rows, cut, "event_dt", file_bytes=8 << 10)

    def files(path):
        return {y.name: len(list(y.glob("*.parquet"))) for y in (tmp_path / path).glob("year=*")}

    assert len(files("few")) == 10 and all(n <= 2 for n in files("few").values())
    assert sum(files("cut").values()) > sum(files("few").values())
    for path in (few, cut):
        back = spark.read.parquet(path)
        assert back.where("year <> year(event_dt)").count() == 0
        assert back.drop("year").exceptAll(rows).count() == 0 and back.count() == 4000


def test_a_hot_year_is_written_by_several_tasks(spark, tmp_path):
    rows = _events(spark).selectExpr("person_id", "if(person_id < 40, date'2001-05-05', event_dt) as event_dt", "code")
    E.write_extract(rows, str(tmp_path / "hot"), "event_dt", file_bytes=16 << 10)
    sizes = {y.name: len(list(y.glob("*.parquet"))) for y in (tmp_path / "hot").glob("year=*")}
    assert sizes["year=2001"] >= 4 and max(n for y, n in sizes.items() if y != "year=2001") <= 2


def test_one_year_again_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "years")
    E.write_extract(_events(spark), path, "event_dt")
    before = {f for f in (tmp_path / "years").rglob("*.parquet") if "year=2003" not in str(f)}
    E.write_extract(_events(spark).where("year(event_dt) = 2003").limit(5), path, "event_dt")
    assert before <= set((tmp_path / "years").rglob("*.parquet"))
    assert spark.read.parquet(path).where("year = 2003").count() == 5


RANGES = [(d("1999-01-01"), d("2001-01-01")), (d("2001-01-01"), d("2001-01-02")), (d("2001-01-02"), d("2005-06-01")), (d("2005-06-01"), d("2012-01-01"))]


def test_ranges_load_once(spark, tmp_path):
    path = str(tmp_path / "load")
    rows = _events(spark).unionByName(spark.createDataFrame([(1, None, "x")], "person_id long, event_dt date, code string"))
    assert E.read_loaded(spark, path) is None
    assert [E.load_range(rows, path, "event_dt", lo, hi) for lo, hi in [*RANGES, RANGES[0], RANGES[2]]] == [True] * 4 + [False] * 2
    back = E.read_loaded(spark, path)
    assert back.count() == 4000 and back.exceptAll(rows).count() == 0
    assert E.loaded_ranges(spark, path) == RANGES
    for lo, hi in ((d("2000-12-31"), d("2001-01-01")), (d("2001-01-01"), d("2001-01-03")), (d("2011-12-31"), d("2013-01-01"))):
        with pytest.raises(ValueError):
            E.load_range(rows, path, "event_dt", lo, hi)
    with pytest.raises(ValueError):
        E.load_range(rows, path, "event_dt", d("2020-01-01"), d("2020-01-01"))


def test_a_load_that_broke_off_is_done_again(spark, tmp_path, monkeypatch):
    """Rows written without an entry in the ledger do not count, and are replaced."""
    path = str(tmp_path / "load")
    rows = _events(spark)
    E.load_range(rows, path, "event_dt", *RANGES[0])
    seen = E.read_loaded(spark, path).count()

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(E.smallfiles, "put", broken)
        with pytest.raises(OSError):
            E.load_range(rows, path, "event_dt", *RANGES[2])
    assert (tmp_path / "load" / "chunks" / "2001-01-02_2005-06-01").exists()
    assert E.read_loaded(spark, path).count() == seen
    assert E.load_range(rows, path, "event_dt", *RANGES[2])
    lo, hi = RANGES[2]
    want = seen + rows.where((F.col("event_dt") >= F.lit(lo)) & (F.col("event_dt") < F.lit(hi))).count()
    assert E.read_loaded(spark, path).count() == want


def test_persons_of_many_tables_take_one_shuffle(spark):
    from cohortwise.operators.counts import persons_by_tag

    tables = {f"t{i}": spark.range(i * 3).selectExpr("id % 7 as person_id").unionAll(spark.sql("select null")) for i in range(20)}
    counts = persons_by_tag(tables, "name")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange SinglePartition") == 1
    assert [(r.name, r.n) for r in counts.collect()] == [(f"t{i}", min(i * 3, 7)) for i in range(20)]
    with pytest.raises(ValueError):
        persons_by_tag({str(i): tables["t1"] for i in range(64)}, "name")


def test_extract_checks_write_no_extract(spark):
    """The check counts persons of plans that read little more than the person; a written extract is taken as it is."""
    from cohortwise.operators.extract import extract_checks
    from cohortwise.plans.study import Study

    study = Study(spark, "/root/testdata/sf0.001")
    counted = {r["extract"]: r.n for r in extract_checks(study.extracts()).collect()}
    assert {n for n in study.__dict__ if n.endswith("_extract")} == {"spell_extract"}
    written = {name: getattr(study, name) for name in ("gp_extract", "diag_extract", "outpatient_diag_extract")}
    assert study.extracts()["gp_events"] is written["gp_extract"]
    want = {name: df.where("person_id IS NOT NULL").select("person_id").distinct().count() for name, df in study.extracts().items()}
    assert counted == want and min(want[n] for n in ("gp_events", "hospital_diagnoses")) > 0
