"""Codelist source, versions, change detection and lookups."""

import os

import pytest
from conftest import d
from pyspark.sql import functions as F

from cohortwise.operators import codelists as K
from cohortwise.plans.study import Study
from cohortwise.sources.codelists import ICD10_HEADER, READ_V2_HEADER, codelist_lines, read_codelists, scan_codelists, write_codelist_files
from cohortwise.sources.versions import LookupStore

CODES = "concept string, code string, concept_type string"


def test_csv_reader_positional_schema_and_file_concept(spark, tmp_path):
    header = ",".join(f'"{h}"' for h in READ_V2_HEADER)
    (tmp_path / "TIA.csv").write_text(header + "\n5136.,x,TIA,a,b,condition\n7E253,y,TIA,a,b,condition\n")
    (tmp_path / "ASTHMA.csv").write_text(header + "\nG33a.,x,ASTHMA,a,b,condition\nG33A.,y,ASTHMA,a,b,condition\n")
    df = read_codelists(spark, str(tmp_path), "readv2", "2_2_3")
    rows = sorted((r.concept, r.code) for r in df.collect())
    # codes are never inferred as numbers and case is preserved
    assert rows == [("ASTHMA", "G33A."), ("ASTHMA", "G33a."), ("TIA", "5136."), ("TIA", "7E253")]
    assert dict(df.dtypes)["code"] == "string"


def test_scan_sets_faulty_lines_aside(spark, tmp_path):
    read, icd = ",".join(READ_V2_HEADER), ",".join(ICD10_HEADER)
    files = {
        "TIA": [read, "5136.,x,TIA,a,b,condition", "7E253 ,y,TIA,a,b,condition", '"G4,5",z,TIA,a,b,condition', "", "7E254,y,TIA,a,b,condition,more", "7E255,y"],
        "HEART FAILURE+": [read, " ,x,HEART FAILURE+,a,b,condition", "G58..,x,TIA,a,b,condition", "G58..,x,HEART FAILURE+,a,b,condition", "G58..,x,HEART FAILURE+,a,b,condition", "G5,x,,a,b,c"],
        "OTHER": [icd, "I50,x,OTHER,a,condition"],
        "HEADLESS": ["G1,x,HEADLESS,a,b,condition"],
        "EMPTY": [],
    }
    for name, lines in files.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(lines))
    (tmp_path / "notes.txt").write_text("not a code list")
    (tmp_path / "BOM.csv").write_text("\ufeff" + read + "\r\nB1,x,BOM,a,b,\r\n", encoding="utf-8")
    got = scan_codelists(spark, str(tmp_path), "readv2", "2_2_3")
    good = sorted((r.concept, r.code, r.concept_type or "") for r in got.where("problem IS NULL").collect())
    assert good == [("BOM", "B1", "")] + [("HEART FAILURE+", "G58..", "condition")] * 2 + [("TIA", c, "condition") for c in ("5136.", "7E253", "G4,5")]
    bad = sorted((r.concept, r.problem, r.line) for r in got.where("problem IS NOT NULL").collect())
    assert bad == sorted(
        [("TIA", "columns", files["TIA"][5]), ("TIA", "columns", "7E255,y")]
        + [("HEART FAILURE+", p, files["HEART FAILURE+"][i]) for p, i in (("no code", 1), ("concept", 2), ("concept", 5))]
        + [("OTHER", "layout", icd), ("OTHER", "layout", files["OTHER"][1]), ("HEADLESS", "layout", files["HEADLESS"][0])]
    )
    assert got.where("problem IS NOT NULL AND (code IS NOT NULL OR concept_type IS NOT NULL)").count() == 0
    assert got.select("code").where("code IS NOT NULL").count() == 6  # whatever columns are read


@pytest.mark.parametrize("vocab", ["readv2", "icd10"])
def test_codelist_files_round_trip(spark, tmp_path, vocab):
    rows = [(c, f"{c[0]}{i:03d}", "condition", "about, it") for c in ("TIA", "HEART FAILURE+", "50%") for i in range(40)] + [("TIA", "T001", None, None)]
    df = spark.createDataFrame(rows, "concept string, code string, concept_type string, description string").repartition(9)
    for _ in range(2):  # the second write replaces the files
        write_codelist_files(codelist_lines(df, vocab), str(tmp_path))
    assert sorted(os.listdir(tmp_path)) == sorted(["TIA.csv", "HEART FAILURE+.csv", "50%.csv"] + [f for f in os.listdir(tmp_path) if f.endswith(".crc")])
    back = scan_codelists(spark, str(tmp_path), vocab, "1").collect()
    assert all(r.problem is None for r in back)
    assert sorted((r.concept, r.code, r.concept_type or "") for r in back) == sorted((c, k, t or "") for c, k, t, _ in rows)


def test_latest_version_compares_numerically(spark):
    v = spark.createDataFrame(
        [("A", "2_2_3", "x"), ("A", "2_2_10", "y"), ("A", "2_2_9", "z"), ("B", "2_2_9", "w")],
        "concept string, version string, code string",
    )
    assert sorted((r.concept, r.code) for r in K.latest_version(v).collect()) == [("A", "y"), ("B", "w")]


def test_codelist_diff_statuses(spark):
    new = spark.createDataFrame(
        [("SAME", "a", "c"), ("CHG", "a", "c"), ("CHG", "b", "c"), ("NEW", "a", "c")], CODES
    )
    old = spark.createDataFrame([("SAME", "a", "c"), ("CHG", "a", "c"), ("CHG", "z", "c"), ("OLD", "a", "c")], CODES)
    out = {r.concept: (r.status, r.n_added, r.n_removed) for r in K.codelist_diff(new, old).collect()}
    assert out == {
        "SAME": ("unchanged", 0, 0),
        "CHG": ("updated", 1, 1),
        "NEW": ("new", 1, 0),
        "OLD": ("not updated", 0, 1),
    }


def test_new_and_updated_concepts_are_built_from_the_new_version(spark):
    old = [("KEPT", "a", "c"), ("SAME", "b", "c"), ("CHANGED", "d", "c"), ("CHANGED", "e", "c")]
    new = [("SAME", "b", "c"), ("CHANGED", "d", "c"), ("CHANGED", "f", "c"), ("FRESH", "g", "c")]
    got = K.codelist_build(spark.createDataFrame(new, CODES), spark.createDataFrame(old, CODES)).collect()
    want = [("KEPT", "a"), ("SAME", "b"), ("CHANGED", "d"), ("CHANGED", "f"), ("FRESH", "g")]
    assert sorted((r.concept, r.code) for r in got) == sorted(want)


def test_the_study_builds_the_lookup_from_the_diff(spark):
    """Every current code of the version that each concept is built from, by hand."""
    study = Study(spark, "/root/testdata/sf0.001")
    status = {r.concept: r.status for r in study.codelist_changes().collect()}
    assert {"new", "updated", "not updated"} <= set(status.values())
    current = {r.read_code for r in study.fx.read_dict.collect() if r.effective_to is None}
    last = {"new": "2_2_10", "updated": "2_2_10"}  # the others: the last one published before
    want = {
        (r.concept, r.code)
        for r in study.fx.codelist_versions.collect()
        if r.version == last.get(status[r.concept], "2_2_9") and r.code in current
    }
    assert {(r.concept, r.code) for r in study.updated_read_lookup().collect()} == want


def test_flag_sensitive(spark):
    codes = spark.createDataFrame([("HIV", "a", "c"), ("X", "b", "c"), ("X", "c", "c")], CODES)
    sens = spark.createDataFrame([("b",)], "code string")
    out = {(r.concept, r.code): r.sensitive for r in K.flag_sensitive(codes, sens, ["HIV"]).collect()}
    assert out == {("HIV", "a"): 1, ("X", "b"): 1, ("X", "c"): 0}


def test_read_lookup_current_entries_and_longest_term(spark):
    codes = spark.createDataFrame([("C", "a", "t", 0), ("C", "b", "t", 0), ("D", "a", "t", 1)],
                                  "concept string, code string, concept_type string, sensitive int")
    rd = spark.createDataFrame(
        [("a", None, "mid", "short", None), ("b", "long", "mid", "short", d("1999-01-01"))],
        "read_code string, term_198 string, term_60 string, term_30 string, effective_to date",
    )
    out = sorted((r.concept, r.code, r.description, r.sensitive) for r in K.read_lookup(codes, rd).collect())
    assert out == [("C", "a", "mid", 0), ("D", "a", "mid", 1)]


def test_icd10_lookup_branches(spark):
    codes = spark.createDataFrame(
        [("C", "A01", "t", 0), ("C", "A011", "t", 0), ("C", "A0123", "t", 0)],
        "concept string, code string, concept_type string, sensitive int",
    )
    dic = spark.createDataFrame(
        [("A01", "A01", "title A01", None), ("A01.1", "A011", "title A01.1", None), ("A01.2", "A012", "old", d("1999-01-01"))],
        "code string, alt_code string, description string, effective_to date",
    )
    out = {r.code: (r.description, r.title3, r.code_length) for r in K.icd10_lookup(codes, dic).collect()}
    assert out == {"A01": ("title A01", "title A01", 3), "A011": ("title A01.1", "title A01", 4)}


def test_read_code_list_keeps_codes_as_text(spark, tmp_path):
    (tmp_path / "sensitive.csv").write_text("code,description\n5136.,x\n7E253 ,y\n0012.,z\n")
    from cohortwise.sources.codelists import read_code_list

    assert sorted(r.code for r in read_code_list(spark, str(tmp_path)).collect()) == ["0012.", "5136.", "7E253"]


LOOKUP = "concept string, code string"


def test_versioned_store_and_latest_view(spark, tmp_path):
    store = LookupStore(spark, str(tmp_path / "lookups"))
    with pytest.raises(LookupError):
        store.current()
    store.publish(spark.createDataFrame([("A", "a"), ("B", "b"), (None, "n")], LOOKUP), "2_2_9")
    store.publish(spark.createDataFrame([("A", "a2")], LOOKUP), "2_2_10")
    store.register_view("lookup_latest")
    rows = sorted((r.concept, r.code, r.version) for r in spark.table("lookup_latest").collect())
    assert rows == [("A", "a2", "2_2_10"), ("B", "b", "2_2_9")]
    # re-publishing a version replaces only that version
    store.publish(spark.createDataFrame([("A", "a3")], LOOKUP), "2_2_10")
    assert store.versions() == ["2_2_9", "2_2_10"]
    assert [r.code for r in store.version("2_2_10").collect()] == ["a3"]
    assert sorted(r.code for r in store.version("2_2_9").collect()) == ["a", "b"]
    # an older version is kept, but the view goes on showing the newer rows
    store.publish(spark.createDataFrame([("A", "a0"), ("C 1/x", "c")], LOOKUP), "2_2_3")
    rows = sorted((r.concept, r.code, r.version) for r in store.current().collect())
    assert rows == [("A", "a3", "2_2_10"), ("B", "b", "2_2_9"), ("C 1/x", "c", "2_2_3")]
    with pytest.raises(ValueError):
        store.publish(spark.createDataFrame([("A", 1)], "concept string, code int"), "2_2_11")


def test_a_publish_that_broke_off_leaves_the_old_view(spark, tmp_path, monkeypatch):
    store = LookupStore(spark, str(tmp_path / "lookups"))
    store.publish(spark.createDataFrame([("A", "old")], LOOKUP), "1_0_0")

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr("cohortwise.sources.versions.smallfiles.put", broken)
        with pytest.raises(OSError):
            store.publish(spark.createDataFrame([("A", "new")], LOOKUP), "1_0_1")
    assert len(list((tmp_path / "lookups" / "data").iterdir())) == 2  # written, but no manifest names it
    assert [r.code for r in store.current().collect()] == ["old"] and store.versions() == ["1_0_0"]
    store.publish(spark.createDataFrame([("A", "new")], LOOKUP), "1_0_1")
    assert [r.code for r in store.current().collect()] == ["new"]


def test_two_publishes_at_once_cannot_both_win(spark, tmp_path):
    from cohortwise.sources import smallfiles

    path = str(tmp_path / "p" / "1")
    smallfiles.put(spark, path, "one é")
    with pytest.raises(FileExistsError):
        smallfiles.put(spark, path, "two")
    assert smallfiles.get(spark, path) == "one é" and smallfiles.names(spark, str(tmp_path / "p")) == ["1"]


def test_a_rebuild_rewrites_the_changed_concepts_alone(spark, tmp_path):
    """The files of concepts that the diff does not call new or updated keep their names."""
    study = Study(spark, "/root/testdata/sf0.001")
    store = LookupStore(spark, str(tmp_path / "lookups"))
    study.publish_read_lookup(store)

    def files():
        return {r.file for r in store.current().select(F.input_file_name().alias("file")).distinct().collect()}

    before = files()
    status = {r.concept: r.status for r in study.codelist_changes().collect()}
    changed = {c for c, s in status.items() if s in ("new", "updated")}
    study.republish_changed(store)
    after = files()

    def concepts(files):
        return {f.split("concept=")[1].split("/")[0] for f in files}

    assert concepts(after - before) == changed and concepts(before & after) == set(status) - changed
    assert {v: store.version(v).select("concept").distinct().count() for v in store.versions()}["2_2_10"] == len(changed)
    want = study.updated_read_lookup()
    got = store.current().drop("version").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_icd10_layout_reads_five_columns(spark, tmp_path):
    from cohortwise.sources.codelists import ICD10_HEADER

    header = ",".join(ICD10_HEADER)
    (tmp_path / "TIA.csv").write_text(header + "\nG45,t,TIA,T,condition\nG459,u,TIA,U,condition\n")
    df = read_codelists(spark, str(tmp_path), "icd10", "2_2_3")
    assert sorted((r.concept, r.code, r.concept_type) for r in df.collect()) == [
        ("TIA", "G45", "condition"), ("TIA", "G459", "condition")]
