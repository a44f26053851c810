"""Outcome matching, ranking and report statistics."""

import random
import datetime as dt
from collections import Counter

from conftest import d
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortwise.operators import outcomes as O
from cohortwise.operators import report as R
from cohortwise.operators.ranking import rank_within

EVENTS = "person_id long, practice_id long, local_id long, event_cd string, event_val decimal(31,8), event_dt date"
LOOKUP = "code string, description string, sensitive int, concept string, concept_type string"


def test_code_in_two_concepts_fans_out_and_ranks(spark):
    ev = spark.createDataFrame(
        [(1, 1, 1, "G33a.", None, d("2000-01-01")), (1, 1, 2, "G33a.", None, d("2000-01-01")),
         (1, 1, 3, "G33A.", None, d("2000-02-01")), (1, 1, 3, "G33A.", None, d("2000-02-01"))],
        EVENTS,
    )
    lk = spark.createDataFrame(
        [("G33a.", "lower", 0, "ASTHMA", "c"), ("G33a.", "lower", 0, "COPD", "c"), ("G33A.", "upper", 0, "ASTHMA", "c"),
         ("G33A.", "upper", 1, "COPD", "c")],
        LOOKUP,
    )
    out = sorted((r.concept, r.local_id, r.event_seq) for r in O.primary_care_outcomes(ev, lk).collect())
    assert out == [("ASTHMA", 1, 1), ("ASTHMA", 2, 1), ("ASTHMA", 3, 3), ("COPD", 1, 1), ("COPD", 2, 1)]


def test_rank_within_matches_window_rank(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 3), rng.randint(0, 5), rng.choice([None, 1, 2, 3, 4])) for _ in range(300)]
    df = spark.createDataFrame(rows, "k1 int, k2 int, o int")
    ref = df.withColumn("r", F.rank().over(Window.partitionBy("k1", "k2").orderBy(F.col("o").asc_nulls_first())))
    for threshold in (None, 12, 10_000):  # all two-level, mixed, all one window
        ours = rank_within(df, ["k1", "k2"], ["o"], "r", hot_threshold=threshold)
        assert Counter(map(tuple, ours.collect())) == Counter(map(tuple, ref.collect()))


def _index(spark, ages_sex):
    return spark.createDataFrame(
        [("C", i, s, a) for i, (a, s) in enumerate(ages_sex)], "concept string, person_id long, sex_cd int, age_event int"
    )


def test_median_and_mode_ties(spark):
    idx = _index(spark, [(30, 1), (30, 1), (40, 2), (40, 2)])
    r = R._median_mode(idx).collect()[0]
    assert r.any_mode_age == "30,40"
    assert r.any_median_age == 35.0
    assert r.any_median_age_male == 30.0 and r.any_mode_age_female == "40"


def test_histogram_bands(spark):
    rows = [("C", i, 1, a) for i, a in enumerate([-1, 0, 9, 10, 99, 100, 101])]
    gp = spark.createDataFrame(rows, "concept string, person_id long, sex_cd int, age_event int").withColumns(
        {c: F.lit(None).cast("string") for c in R.GP_ORDER if c not in ("sex_cd", "age_event")}
    )
    hosp = gp.limit(0).select("concept", "person_id", "sex_cd", "age_event", *[
        F.lit(None).cast("string").alias(c) for c in R.HOSP_ORDER if c not in ("sex_cd", "age_event")])
    out = {(r.source, r.band): r.n for r in R.onset_age_histogram(gp, hosp).collect()}
    assert out == {("gp", 0): 2, ("gp", 1): 1, ("gp", 9): 2, ("any", 0): 2, ("any", 1): 1, ("any", 9): 2}


def test_admission_counts_cause_and_not_cause(spark):
    gp = spark.createDataFrame([("C", 1, d("2000-01-01")), ("C", 1, d("2000-01-01"))], "concept string, person_id long, event_dt date")
    hosp = spark.createDataFrame(
        [("C", 10, "01"), ("C", 10, "02"), ("C", 11, "02"), ("C", 12, "03")], "concept string, spell_id long, epi_num string"
    )
    r = R.admission_counts(gp, hosp).collect()[0]
    assert (r.gp_admissions, r.hosp_admissions_cause, r.hosp_admissions_not_cause) == (1, 1, 2)


def test_person_counts_either_source(spark):
    gp = spark.createDataFrame([("C", 1, 1), ("C", 2, 2)], "concept string, person_id long, sex_cd int")
    hosp = spark.createDataFrame([("C", 2, 2), ("C", 3, None), ("D", 4, 1)], "concept string, person_id long, sex_cd int")
    out = {r.concept: r for r in R.person_counts(gp, hosp).collect()}
    c, dd = out["C"], out["D"]
    assert (c.n_persons_gp, c.n_persons_hosp, c.n_persons_any, c.n_male_any, c.n_female_any) == (2, 2, 3, 1, 1)
    assert dd.n_persons_gp is None and dd.n_persons_hosp == 1


def test_row_number_within_matches_window(spark):
    from cohortwise.operators.ranking import row_number_within

    rng = random.Random(5)
    rows = [(rng.randint(0, 2), rng.choice([None, d("2000-01-01"), d("2000-01-02")]), rng.randint(0, 3), i)
            for i in range(200)]
    df = spark.createDataFrame(rows, "k int, day date, x int, uid int")
    order = ["day", "x", "uid"]
    w = Window.partitionBy("k").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    ref = df.withColumn("rn", F.row_number().over(w))
    for threshold in (None, 66, 10_000):  # all two-level, mixed, all one window
        ours = row_number_within(df, ["k"], order, "rn", hot_threshold=threshold)
        assert Counter(map(tuple, ours.collect())) == Counter(map(tuple, ref.collect()))


def test_event_on_shared_spell_boundary_gets_both_quintiles(spark):
    outcomes = spark.createDataFrame(
        [("C", 1, d("2000-03-01"), "X1"), ("C", 1, d("1999-01-01"), "X1")],
        "concept string, person_id long, event_dt date, event_cd string",
    )
    aged = outcomes.withColumns({"sex_cd": F.lit(1), "age_event": F.lit(40)})
    history = spark.createDataFrame(
        [(1, d("2000-01-01"), d("2000-03-01"), 1), (1, d("2000-03-01"), d("9999-01-01"), 4)],
        "person_id long, active_from date, active_to date, dep1_quintile int",
    )
    out = R.enrich_events(aged, outcomes, history, "event_dt", ["event_dt", "event_cd", "area_quintile"])
    got = sorted((r.event_dt.isoformat(), r.area_quintile if r.area_quintile is not None else -1, r.num_event)
                 for r in out.collect())
    assert got == [("1999-01-01", -1, 1), ("2000-03-01", 1, 2), ("2000-03-01", 4, 3)]


def _residences(rng, people=12):
    rows = []
    for p in range(people):
        for _ in range(rng.randint(0, 9)):
            start = dt.date(2000, 1, 1) + dt.timedelta(days=rng.randint(0, 200))
            end = start + dt.timedelta(days=rng.randint(-3, 90))
            rows.append((p, start, dt.date(9999, 1, 1) if rng.random() < 0.1 else end, rng.choice([1, 2, 3, None])))
    return rows + rows[:10] + [(None, dt.date(2000, 1, 1), dt.date(2001, 1, 1), 1)]


def test_quintiles_on_a_day_match_every_containing_spell(spark):
    """Nested, equal, empty and open spells, edges, null persons, days and quintiles; repeated rows."""
    rng = random.Random(31)
    spells = _residences(rng)
    days = [(rng.choice([*range(14), None]), dt.date(2000, 1, 1) + dt.timedelta(days=rng.randint(-20, 320))) for _ in range(400)]
    days += [(p, edge) for p, a, b, _ in spells[:30] for edge in (a, b)] + [(1, None)]
    history = spark.createDataFrame(spells, "person_id long, active_from date, active_to date, dep1_quintile int").repartition(3)
    found = R.quintiles_on(spark.createDataFrame(days, "person_id long, event_dt date"), history, "event_dt")
    want = {(p, x, q) for p, x in days if x and p is not None for o, a, b, q in spells if o == p and a <= x <= b}
    got = [(r.person_id, r.event_dt, r.area_quintile) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)


def test_the_interval_match_lists_no_days(spark):
    history = spark.createDataFrame([], "person_id long, active_from date, active_to date, dep1_quintile int")
    days = spark.createDataFrame([], "person_id long, event_dt date")
    plan = R.quintiles_on(days, history, "event_dt")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_one_person_with_most_spells_and_events(spark):
    """A person's rows in the sweep follow the calendar, not its spells and events."""
    spells = spark.range(20_000).selectExpr(
        "1L as person_id", "date_add(date'2000-01-01', int(id % 50)) as active_from",
        "date_add(date'2000-01-01', int(id % 50 + id % 7)) as active_to", "int(id % 2) as dep1_quintile",
    )
    days = spark.range(20_000).selectExpr("1L as person_id", "date_add(date'2000-01-01', int(id % 70)) as event_dt")
    got = {(r.event_dt, r.area_quintile) for r in R.quintiles_on(days, spells, "event_dt").collect()}
    lived = {(i % 50, i % 50 + i % 7, i % 2) for i in range(20_000)}
    base = dt.date(2000, 1, 1)
    assert got == {(base + dt.timedelta(days=x), q) for x in range(70) for a, b, q in lived if a <= x <= b}


def _stay_tables(spark, n=300):
    """Diagnoses, episodes, spells, lookup and dictionary with repeated rows, null codes and null persons."""
    rng = random.Random(7)
    codes = ["A01", "A02", "B03", None]
    diag = [("P", rng.randint(0, 40), f"0{rng.randint(1, 2)}", 1, "x", c, rng.choice([f"{c}1", f"{c}2", None])) for c in codes for _ in range(n // 4)]
    epi = [("P", s, e, d("2000-01-01") + dt.timedelta(days=s % 9), d("2000-02-01")) for s in range(40) for e in ("01", "02")]
    spl = [(None if s % 13 == 0 else s % 5, "P", s, d("2000-01-01") + dt.timedelta(days=s % 4), d("2000-03-01")) for s in range(38)]
    look = [(c, "t" + c, c[:3], "t" + c[:3], len(c), int(c == "A02"), k, "c") for c in ("A01", "A02", "A011", "A012", "B032") for k in ("C", "D")]
    dic = [(None, c, "t" + c if i else "other", None) for i, c in enumerate(("A011", "A012", "A012", "B031"))]
    return [
        spark.createDataFrame(diag + diag[:20], "provider_cd string, spell_id long, epi_num string, diag_num int, diag_cd string, diag_cd_123 string, diag_cd_1234 string"),
        spark.createDataFrame(epi + epi[:9], "provider_cd string, spell_id long, epi_num string, epi_str_dt date, epi_end_dt date"),
        spark.createDataFrame(spl + spl[:9], "person_id long, provider_cd string, spell_id long, admis_dt date, disch_dt date"),
        spark.createDataFrame(look + look[:3], "code string, description string, code3 string, title3 string, code_length int, sensitive int, concept string, concept_type string"),
        spark.createDataFrame(dic, "code string, alt_code string, description string, effective_to date"),
    ]


def _matched_plainly(tables):
    diag, epi, spl, look, dic = [t.collect() for t in tables]
    out = set()
    for g in diag:
        for e in epi:
            for s in spl:
                if (g.provider_cd, g.spell_id, g.epi_num) != (e.provider_cd, e.spell_id, e.epi_num) or (s.provider_cd, s.spell_id) != (g.provider_cd, g.spell_id):
                    continue
                for k in look:
                    if k.sensitive or k.code != (g.diag_cd_123 if k.code_length == 3 else g.diag_cd_1234):
                        continue
                    titles = [x.description for x in dic if x.alt_code == g.diag_cd_1234 is not None] or [None]
                    for t in titles if k.code_length == 3 else [k.description]:
                        out.add((k.concept, s.person_id, g.provider_cd, g.spell_id, s.admis_dt, s.disch_dt, e.epi_str_dt, e.epi_end_dt, g.epi_num,
                                 g.diag_num, g.diag_cd, g.diag_cd_123, k.title3, g.diag_cd_1234, t))
    return out


def test_hospital_matches_of_written_stays(spark):
    """Whole and in two steps, the matches are those of nested loops; ranks agree whether persons are hot or not."""
    tables = _stay_tables(spark)
    want = _matched_plainly(tables)
    got = O.match_hospital(*tables)
    assert got.columns == O.HOSP_COLUMNS
    assert Counter(map(tuple, got.collect())) == Counter(want) and len(want) > 100
    w = Window.partitionBy("concept", "person_id").orderBy(*[F.col(c).asc_nulls_first() for c in O.HOSP_RANK_ORDER])
    ranked = Counter(map(tuple, got.withColumn("event_seq", F.rank().over(w)).collect()))
    assert Counter(map(tuple, O.hospital_outcomes(*tables).collect())) == ranked
    assert Counter(map(tuple, O.hospital_outcomes(*tables, write=lambda df: df).collect())) == ranked
    hot = spark.createDataFrame([(1,), (3,), (None,)], "person_id long")
    assert Counter(map(tuple, O.rank_events(got, O.HOSP_RANK_ORDER, hot).collect())) == ranked


def test_rows_of_all_concepts_are_not_shuffled(spark):
    """From the stays on, matching, ranking, ages and numbering need no shuffle of the rows of all concepts."""
    diag, epi, spl, look, dic = _stay_tables(spark)
    stays = O.diagnosis_stays(diag, epi, spl, look)
    none = spark.createDataFrame([], "person_id long")
    ranked = O.rank_events(O.match_by_person(stays, look, dic), O.HOSP_RANK_ORDER, none)
    cohort = spark.createDataFrame([(1, 1, d("1950-01-01")), (1, 1, d("1950-01-02"))], "person_id long, sex_cd int, birth_dt date")
    plan = R.age_at_event(ranked, cohort, "admis_dt")._jdf.queryExecution().executedPlan().toString()
    after = plan[: plan.index("HashAggregate")] if "HashAggregate" in plan else plan
    assert "hashpartitioning(concept" not in plan and "hashpartitioning(person_id#" in plan
    assert after.count("Window") == 1


def test_numbering_with_persons_known_to_be_hot(spark):
    rng = random.Random(9)
    rows = [(rng.randint(0, 4), rng.choice("CD"), d("2000-01-01") + dt.timedelta(days=rng.randint(0, 3)), i) for i in range(200)]
    df = spark.createDataFrame(rows, "person_id long, concept string, event_dt date, uid int")
    aged = df.withColumns({"sex_cd": F.lit(1), "age_event": F.lit(40)})
    history = spark.createDataFrame([(1, d("2000-01-01"), d("2000-01-02"), 2)], "person_id long, active_from date, active_to date, dep1_quintile int")
    order = ["event_dt", "uid", "area_quintile"]
    plain = Counter(map(tuple, R.enrich_events(aged, df, history, "event_dt", order).collect()))
    for hot in ([], [(1,), (2,)], [(i,) for i in range(5)]):
        known = spark.createDataFrame(hot, "person_id long")
        assert Counter(map(tuple, R.enrich_events(aged, df, history, "event_dt", order, hot=known).collect())) == plain


def test_partitions_follow_the_rows(spark):
    from cohortwise.plans.sizing import dealt, partitions_for, stage_settings

    assert partitions_for(spark, 10) == 4 and partitions_for(spark, 1_000_001) == 11
    rows = spark.range(0, 1000, 1, 3)
    assert dealt(rows, "id", task_rows=10).rdd.getNumPartitions() == 100
    assert dealt(rows, "id", rows.limit(0), 10).rdd.getNumPartitions() == 100
    assert dealt(rows, "id", rows.limit(1), 10).rdd.getNumPartitions() == 3  # a hot key's rows stay in all tasks
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.requireAllClusterKeysForCoPartition")}
    with stage_settings(spark, 2_000_000):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "10"
    assert {k: spark.conf.get(k, None) for k in before} == before


def _cohort_with_doubles(spark):
    """Persons with several cohort rows of equal and different birth dates and sexes; person 4 is no member."""
    rows = [(0, 1, d("1950-01-05")), (1, 1, d("1950-01-01")), (1, 1, d("1950-01-03")), (1, 2, d("1950-01-01")), (2, None, None),
            (2, 2, d("1960-01-01")), (3, 2, d("1960-01-02")), (3, 2, d("1960-01-02"))]
    return spark.createDataFrame(rows, "person_id long, sex_cd int, birth_dt date")


def _crossing_places(spark):
    spells = [(p, d("2000-01-01"), d("2000-01-02"), 1 + p) for p in range(5)] + [(1, d("2000-01-02"), d("2000-02-01"), None), (3, d("1999-01-01"), d("2001-01-01"), 1)]
    return spark.createDataFrame(spells, "person_id long, active_from date, active_to date, dep1_quintile int")


@pytest.mark.parametrize("members", [False, True])
def test_enriched_by_day_as_row_by_row(spark, members):
    """Ages and places taken by day, and one sort for ranks and numbers, give the rows of the steps one after the other."""
    rng = random.Random(3)
    rows = {(rng.choice(["C", "D", None]), rng.randint(0, 4), d("2000-01-01") + dt.timedelta(days=rng.randint(0, 3)), rng.choice([None, 1, 2, 3])) for _ in range(160)}
    matched = spark.createDataFrame(sorted(rows, key=str), "concept string, person_id long, event_dt date, uid int")
    cohort, history = _cohort_with_doubles(spark), _crossing_places(spark)
    order = ["event_dt", "uid", "event_seq", "sex_cd", "age_event", "area_quintile"]
    none = spark.createDataFrame([], "person_id long")
    aged = R.age_at_event(O.rank_events(matched, ["event_dt"], none), cohort, "event_dt")
    plain = R.enrich_events(aged, matched, history, "event_dt", order, cohort if members else None, hot=none)
    want = Counter(map(tuple, plain.collect()))
    assert sum(want.values()) > len(rows) / 2 and max(want.values()) == 1
    placed = matched.join(R.facts_of_days(matched, cohort, history, "event_dt", members), ["person_id", "event_dt"])
    placed = placed.select(*matched.columns, "facts")
    for hot in ([], [(1,), (3,)], [(i,) for i in range(5)]):
        out = R.enrich_by_day(placed, ["event_dt"], order, spark.createDataFrame(hot, "person_id long"))
        assert sorted(out.columns) == sorted(plain.columns)
        assert Counter(map(tuple, out.select(*plain.columns).collect())) == want


def test_rows_of_all_concepts_are_sorted_once(spark, tmp_path):
    """From the written stays on, one sort by person and concept serves ranks and numbers, and no distinct follows it."""
    diag, epi, spl, look, dic = _stay_tables(spark)
    kept = {"stays": O.diagnosis_stays(diag, epi, spl, look)}
    kept["facts"] = R.facts_of_days(kept["stays"], _cohort_with_doubles(spark), _crossing_places(spark), "admis_dt")
    for name, df in kept.items():
        df.write.parquet(str(tmp_path / name))
        kept[name] = spark.read.parquet(str(tmp_path / name))
    none = spark.createDataFrame([], "person_id long")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = O.match_by_person(kept["stays"], look, dic, none, facts=kept["facts"])
        plan = R.enrich_by_day(rows, O.HOSP_RANK_ORDER, R.HOSP_ORDER, none)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    above = plan[: plan.index("BroadcastHashJoin")]
    assert above.count("Window") == 2 and above.count("Sort [") == 1
    assert "Aggregate" not in above and "Exchange" not in above


def test_report_writes_the_columns_that_it_reads(spark):
    """A report query alone keeps no wide stage; a written one is taken as it is."""
    from cohortwise.plans.study import Study

    study = Study(spark, "/root/testdata/sf0.001")
    gp, hosp = study.reported
    assert "hosp_enriched" not in study.__dict__ and (gp.columns, hosp.columns) == (R.GP_REPORTED, R.HOSP_REPORTED)
    whole = study.hosp_enriched.select(*R.HOSP_REPORTED)
    assert Counter(map(tuple, hosp.collect())) == Counter(map(tuple, whole.collect())) and whole.count() > 0
