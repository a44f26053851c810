"""Island rule edge cases (continuous follow-up)."""

import datetime as dt
import random

import pytest
from conftest import d

from cohortwise.functions.study import StudyWindow
from cohortwise.operators.spells import merge_spells

W = StudyWindow(start=d("2000-01-01"), end=d("2000-12-31"), events_from=d("1990-01-01"))
WIDE = StudyWindow(start=d("1900-01-01"), end=d("9998-12-31"), events_from=d("1900-01-01"))


def islands(spark, spells, window=WIDE, rule="pairwise"):
    rows = [(1, d(a), d(b)) for a, b in spells]
    df = spark.createDataFrame(rows, "person_id long, active_from date, active_to date")
    out = merge_spells(df, window, rule=rule).orderBy("rw_seq").collect()
    return [(r.entry_dt.isoformat(), r.exit_dt.isoformat(), r.rw_seq) for r in out]


def test_gap_of_one_day_merges_two_days_split(spark):
    assert islands(spark, [("2000-01-01", "2000-01-10"), ("2000-01-11", "2000-01-20")]) == [
        ("2000-01-01", "2000-01-20", 1)
    ]
    assert islands(spark, [("2000-01-01", "2000-01-10"), ("2000-01-12", "2000-01-20")]) == [
        ("2000-01-01", "2000-01-10", 1),
        ("2000-01-12", "2000-01-20", 2),
    ]


def test_nested_spell_pairwise_vs_running_max(spark):
    spells = [("2000-01-01", "2000-12-31"), ("2000-02-01", "2000-03-01"), ("2000-06-01", "2000-07-01")]
    assert islands(spark, spells) == [("2000-01-01", "2000-03-01", 1), ("2000-06-01", "2000-07-01", 2)]
    assert islands(spark, spells, rule="running_max") == [("2000-01-01", "2000-12-31", 1)]


def test_duplicate_spells_form_one_island(spark):
    assert islands(spark, [("2000-01-01", "2000-02-01"), ("2000-01-01", "2000-02-01")]) == [
        ("2000-01-01", "2000-02-01", 1)
    ]


def test_clamping_to_window_and_open_end(spark):
    out = islands(spark, [("1999-05-01", "2001-03-01")], window=W)
    assert out == [("2000-01-01", "9999-01-01", 1)]
    out = islands(spark, [("1999-05-01", "9999-01-01")], window=W)
    assert out == [("2000-01-01", "9999-01-01", 1)]


def test_numbering_uses_unclamped_dates(spark):
    # Both islands start before the window: clamped starts tie, numbering
    # still follows the real start dates.
    out = islands(spark, [("1999-01-01", "1999-02-01"), ("1999-06-01", "2000-03-01")], window=W)
    assert out == [("2000-01-01", "1999-02-01", 1), ("2000-01-01", "2000-03-01", 2)]


def _brute_running_max(spells, gap=2):
    spells = sorted(spells)
    out, cur = [], None
    for s, e in spells:
        if cur is None or (s - cur[1]).days >= gap:
            if cur:
                out.append(cur)
            cur = [s, e]
        else:
            cur[1] = max(cur[1], e)
    out.append(cur)
    return [tuple(x) for x in out]


def test_running_max_islands_are_apart_and_cover_same_days(spark):
    rng = random.Random(7)
    rows = []
    for p in range(40):
        for _ in range(rng.randint(1, 6)):
            s = dt.date(2000, 1, 1) + dt.timedelta(days=rng.randint(0, 300))
            rows.append((p, s, s + dt.timedelta(days=rng.randint(0, 40))))
    df = spark.createDataFrame(rows, "person_id long, active_from date, active_to date")
    got = merge_spells(df, WIDE, rule="running_max").collect()
    by_person = {}
    for r in got:
        by_person.setdefault(r.person_id, []).append((r.entry_dt, r.exit_dt))
    for p in range(40):
        expect = _brute_running_max([(s, e) for q, s, e in rows if q == p])
        assert sorted(by_person[p]) == expect
        isl = sorted(by_person[p])
        assert all((b[0] - a[1]).days >= 2 for a, b in zip(isl, isl[1:]))


def test_unknown_rule_rejected(spark):
    df = spark.createDataFrame([(1, d("2000-01-01"), d("2000-01-02"))], "person_id long, active_from date, active_to date")
    with pytest.raises(ValueError):
        merge_spells(df, W, rule="other")


def _brute_pairwise(spells, gap=2):
    rows = sorted(spells)  # duplicates kept, as in the row-by-row rule
    out, start = [], None
    for i, (s, e) in enumerate(rows):
        if i == 0 or (s - rows[i - 1][1]).days >= gap:
            if start is not None:
                out.append((start, rows[i - 1][1]))
            start = s
    out.append((start, rows[-1][1]))
    return sorted(set(out))


def test_pairwise_matches_brute_force_with_duplicates_and_malformed_spells(spark):
    rng = random.Random(11)
    rows = []
    for p in range(60):
        for _ in range(rng.randint(1, 8)):
            s = dt.date(2000, 1, 1) + dt.timedelta(days=rng.randint(0, 60))
            e = s + dt.timedelta(days=rng.randint(-5, 20))  # some end before they start
            rows.append((p, s, e))
            if rng.random() < 0.2:
                rows.append((p, s, e))
    df = spark.createDataFrame(rows, "person_id long, active_from date, active_to date")
    got = {}
    for r in merge_spells(df, WIDE, rule="pairwise").collect():
        got.setdefault(r.person_id, []).append((r.rw_seq, r.entry_dt, r.exit_dt))
    for p in range(60):
        expect = _brute_pairwise([(s, e) for q, s, e in rows if q == p])
        assert sorted(got[p]) == [(i + 1, s, e) for i, (s, e) in enumerate(expect)]


def test_running_max_matches_brute_force_with_copies_and_malformed_spells(spark):
    rng = random.Random(12)
    rows = []
    for p in range(60):
        for _ in range(rng.randint(1, 8)):
            s = dt.date(2000, 1, 1) + dt.timedelta(days=rng.randint(0, 30))
            rows += [(p, s, s + dt.timedelta(days=rng.randint(-6, 12)))] * rng.randint(1, 4)
    df = spark.createDataFrame(rows, "person_id long, active_from date, active_to date").repartition(5)
    got = {}
    for r in merge_spells(df, WIDE, rule="running_max").collect():
        got.setdefault(r.person_id, set()).add((r.entry_dt, r.exit_dt))
    for p in range(60):
        found, reach = [], None
        for s, e in sorted((s, e) for q, s, e in rows if q == p):
            if reach is None or (s - reach).days >= 2:
                found.append([s, e])
            else:
                found[-1][1] = max(found[-1][1], e)
            reach = e if reach is None else max(reach, e)
        assert got[p] == set(map(tuple, found))


def test_islands_read_their_input_once(spark, tmp_path):
    """One scan, no join, and the same plan for a person with most rows as for any other."""
    path = str(tmp_path / "spells")
    spark.range(100).selectExpr("id % 3 as person_id", "date_add(date'2000-01-01', int(id * 7)) as active_from",
                                "date_add(date'2000-01-01', int(id * 7 + 5)) as active_to").write.parquet(path)
    plan = merge_spells(spark.read.parquet(path), WIDE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_hot_person_many_spells_matches_brute_force(spark):
    # one person holds most rows: the result must not depend on how the
    # per-day chain splits the person's spells over tasks
    rng = random.Random(21)
    rows = []
    for _ in range(3000):
        s = dt.date(1990, 1, 1) + dt.timedelta(days=rng.randint(0, 4000))
        rows.append((1, s, s + dt.timedelta(days=rng.randint(0, 3))))
    rows += [(2, dt.date(2000, 1, 1), dt.date(2000, 2, 1))]
    df = spark.createDataFrame(rows, "person_id long, active_from date, active_to date").repartition(7)
    got = sorted((r.rw_seq, r.entry_dt, r.exit_dt) for r in
                 merge_spells(df, WIDE).where("person_id = 1").collect())
    expect = _brute_pairwise([(s, e) for p, s, e in rows if p == 1])
    assert got == [(i + 1, s, e) for i, (s, e) in enumerate(expect)]
    got_rm = sorted((r.entry_dt, r.exit_dt) for r in
                    merge_spells(df, WIDE, rule="running_max").where("person_id = 1").collect())
    assert got_rm == _brute_running_max([(s, e) for p, s, e in rows if p == 1])
