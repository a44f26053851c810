"""Cohort selection: registry reconciliation, study-window filters, deprivation,
start flags, exit reason, the cohort table and residence histories.

Inputs follow these column conventions (rename with ``select`` first):

* spells: person_id, birth_dt, death_dt, sex_cd, area_cd, practice_id,
  active_from, active_to (null = open)
* births: person_id, birth_dt, neonate_sex_cd, birth_valid
* deaths: person_id, death_dt, death_valid
* ethnicity: person_id + any attribute columns
* areas: area_cd, dep1_quintile, dep2_quintile (+ any further columns)

Per-person quantities are computed with ``groupBy`` + join rather than with a
window over the person: the aggregate is combined map-side and the join can
be split by AQE when one person holds a large share of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from cohortwise.functions.dates import OPEN_END, days_between, open_end
from cohortwise.functions.study import StudyWindow
from cohortwise.operators.counts import persons_by_tag
from cohortwise.operators.ranking import row_number_within
from cohortwise.plans.sizing import small_side

# Deprivation quintile labels and cohort text labels.
QUINTILE_LABELS = {1: "1. Most Deprived", 2: "2.", 3: "3.", 4: "4.", 5: "5. Least Deprived"}
SEX_LABELS = {1: "Male", 2: "Female"}
# Columns of the spell rows that the cohort steps name themselves; any other
# column is a person attribute and is carried along.
_SPELL_COLUMNS = frozenset(
    ["person_id", "birth_dt", "death_dt", "sex_cd", "age_at_start", "flag_dead", "active_from", "active_to", "area_cd"]
    + ["dep1_quintile", "dep1_desc", "dep2_quintile", "dep2_desc", "practice_id", "flag_start", "later_dt", "covers_start"]
)
START_LABELS = {1: "Joined the cohort on COHORT_ST_DT", 0: "Joined the cohort after COHORT_ST_DT"}
EXIT_DEATH = "DEATH"
EXIT_LOST = "LOST TO FOLLOW UP"
EXIT_LOST_BREAK = "LOST TO FOLLOW UP BREAK"


def _label(col, labels: dict):
    expr = None
    for key, text in labels.items():
        expr = (F.when(col == key, text)) if expr is None else expr.when(col == key, text)
    return expr


def _consistent(own, reg, allow_both_missing: bool):
    """Equal, or known on exactly one side (or, if allowed, on neither)."""
    one_sided = own.isNull() != reg.isNull()
    if allow_both_missing:
        return F.coalesce(own == reg, F.lit(True))
    return F.coalesce(own == reg, one_sided)


def valid_registry_people(spells: DataFrame, births: DataFrame, deaths: DataFrame) -> DataFrame:
    """Persons with at least one spell row whose birth date agrees with the
    birth registry (or is known on one side only) and at least one row whose
    death date agrees (or is one-sided, or absent on both sides)."""
    s = spells.select("person_id", F.col("birth_dt").alias("own_b"), F.col("death_dt").alias("own_d")).where(
        F.col("person_id").isNotNull()
    )
    b = births.select("person_id", F.col("birth_dt").alias("reg_b"))
    d = deaths.select("person_id", F.col("death_dt").alias("reg_d"))
    birth_ok = _consistent(F.col("own_b"), F.col("reg_b"), allow_both_missing=False)
    death_ok = _consistent(F.col("own_d"), F.col("reg_d"), allow_both_missing=True)
    # One pass: the spells meet both registries by the same key, and each
    # person's rows are combined map-side.
    checks = s.join(b, "person_id", "left").join(d, "person_id", "left").groupBy("person_id")
    return checks.agg(F.max(birth_ok).alias("birth_ok"), F.max(death_ok).alias("death_ok")).where("birth_ok AND death_ok").select("person_id")


def reconcile_demographics(
    spells: DataFrame, births: DataFrame, deaths: DataFrame, valid_people: DataFrame
) -> DataFrame:
    """One row per distinct spell with registry-corrected birth, death and sex.

    The registry value replaces the spell's own value when the latter is
    missing, or when they differ and the registry marks its value 'Valid'.
    A missing spell end becomes the open-end sentinel.
    """
    s = spells.where(F.col("person_id").isNotNull()).join(valid_people, "person_id", "left_semi")
    b = births.select(
        "person_id", F.col("birth_dt").alias("reg_b"), F.col("neonate_sex_cd").alias("reg_sex"), "birth_valid"
    )
    d = deaths.select("person_id", F.col("death_dt").alias("reg_d"), "death_valid")
    j = s.join(b, "person_id", "left").join(d, "person_id", "left")
    birth = F.when(
        F.col("birth_dt").isNull() | ((F.col("birth_dt") != F.col("reg_b")) & (F.col("birth_valid") == "Valid")),
        F.col("reg_b"),
    ).otherwise(F.col("birth_dt"))
    death = F.when(
        F.col("death_dt").isNull() | ((F.col("death_dt") != F.col("reg_d")) & (F.col("death_valid") == "Valid")),
        F.col("reg_d"),
    ).otherwise(F.col("death_dt"))
    sex = F.when(F.col("sex_cd").isNull() & F.col("reg_sex").isNotNull(), F.col("reg_sex")).otherwise(F.col("sex_cd"))
    return j.select(
        "person_id",
        birth.alias("birth_dt"),
        death.alias("death_dt"),
        sex.alias("sex_cd"),
        "area_cd",
        "practice_id",
        "active_from",
        open_end("active_to").alias("active_to"),
    ).distinct()


def study_window_filter(rows: DataFrame, ethnicity: DataFrame, window: StudyWindow) -> DataFrame:
    """Spells with area and practice that overlap the window, of persons born
    by its end and alive at its start; adds age in days at the window start
    (null when negative) and the ethnicity attributes."""
    age = days_between(F.lit(window.start), F.col("birth_dt"))
    kept = rows.where(
        F.col("area_cd").isNotNull()
        & F.col("practice_id").isNotNull()
        & (F.col("birth_dt") <= F.lit(window.end))
        & (F.col("death_dt").isNull() | (F.col("death_dt") >= F.lit(window.start)))
        & (F.col("active_to") >= F.lit(window.start))
        & (F.col("active_from") <= F.lit(window.end))
        & ((F.col("death_dt") > F.col("active_from")) | F.col("death_dt").isNull())
    )
    attributes = [c for c in ethnicity.columns if c != "person_id"]
    return kept.join(ethnicity, "person_id", "left").select(
        "person_id",
        "birth_dt",
        "death_dt",
        "sex_cd",
        F.when(age >= 0, age).cast("int").alias("age_at_start"),
        *attributes,
        "area_cd",
        "practice_id",
        "active_from",
        "active_to",
    )


def age_sex_eligibility(rows: DataFrame, window: StudyWindow) -> DataFrame:
    """Age at start below the limit (or unknown) and sex code 1 or 2."""
    return rows.where(
        ((F.col("age_at_start") < window.age_max_days) | F.col("age_at_start").isNull())
        & F.col("sex_cd").isin("1", "2")
    )


def deprivation_lookup(areas: DataFrame) -> DataFrame:
    """Distinct area -> (quintile 1 + label, quintile 2 inverted + label).

    The second label is taken from the raw (not inverted) quintile, so the
    label reads "most deprived" where the raw value is 5."""
    q1, q2 = F.col("dep1_quintile"), F.col("dep2_quintile")
    inverted = F.when(q2.between(1, 5), F.lit(6) - q2)
    raw_label = _label(q2, {5: QUINTILE_LABELS[1], 4: QUINTILE_LABELS[2], 3: QUINTILE_LABELS[3], 2: QUINTILE_LABELS[4], 1: QUINTILE_LABELS[5]})
    return areas.select(
        "area_cd",
        q1.cast("int").alias("dep1_quintile"),
        _label(q1, QUINTILE_LABELS).alias("dep1_desc"),
        inverted.cast("int").alias("dep2_quintile"),
        raw_label.alias("dep2_desc"),
    ).distinct()


def deprivation_map(rows: DataFrame, areas: DataFrame, window: StudyWindow) -> DataFrame:
    """Attach deprivation quintiles by area and a died-by-window-end flag."""
    lookup = small_side(deprivation_lookup(areas))
    attributes = [c for c in rows.columns if c not in _SPELL_COLUMNS]
    return rows.join(lookup, "area_cd", "left").select(
        "person_id",
        "birth_dt",
        "death_dt",
        F.col("sex_cd").cast("int").alias("sex_cd"),
        "age_at_start",
        *attributes,
        F.when(F.col("death_dt") <= F.lit(window.end), 1).otherwise(0).alias("flag_dead"),
        "active_from",
        "active_to",
        "area_cd",
        "dep1_quintile",
        "dep1_desc",
        "dep2_quintile",
        "dep2_desc",
        "practice_id",
    )


def cohort_start_flags(rows: DataFrame, window: StudyWindow) -> DataFrame:
    """Per row: ``covers_start`` = the spell contains the window start.
    Per person: ``flag_start`` = number of rows covering the start (a count,
    so two covering spells give 2) and ``later_dt`` = first spell start when
    it is after the window start. Result is distinct."""
    covers = F.when(F.lit(window.start).between(F.col("active_from"), F.col("active_to")), 1).otherwise(0)
    per_row = rows.withColumn("covers_start", covers)
    per_person = per_row.groupBy("person_id").agg(
        F.sum("covers_start").cast("int").alias("flag_start"), F.min("active_from").alias("first_from")
    )
    per_person = per_person.select(
        "person_id",
        "flag_start",
        F.when(F.col("first_from") <= F.lit(window.start), F.lit(None).cast("date"))
        .otherwise(F.col("first_from"))
        .alias("later_dt"),
    )
    return per_row.join(per_person, "person_id").select(*rows.columns, "flag_start", "later_dt", "covers_start").distinct()


def followup_break_flag(islands: DataFrame) -> DataFrame:
    """1 when a person's follow-up is broken into more than one island."""
    return islands.groupBy("person_id").agg(
        F.when(F.max("rw_seq") > 1, 1).otherwise(0).alias("flag_fu")
    )


def exit_reason(rows: DataFrame, islands: DataFrame, breaks: DataFrame, window: StudyWindow) -> DataFrame:
    """Why follow-up ended, from the first island of each person.

    DEATH when death is on or before the island end or within seven days
    after it; otherwise, if the island ends inside the window, lost to follow
    up (with or without a later re-entry); otherwise null."""
    first = islands.where(F.col("rw_seq") == 1).select("person_id", F.col("exit_dt").alias("end_overlap"))
    j = rows.select("person_id", "death_dt").join(first, "person_id").join(breaks, "person_id")
    died = F.col("death_dt") <= F.date_add(F.col("end_overlap"), 7)  # on or before the end, or within 7 days
    lost = F.col("end_overlap") <= F.lit(window.end)
    reason = F.when(died, EXIT_DEATH).when(lost, F.when(F.col("flag_fu") == 1, EXIT_LOST_BREAK).when(F.col("flag_fu") == 0, EXIT_LOST))
    return j.select("person_id", reason.alias("exit_reason")).distinct()


def baseline_residence(flagged: DataFrame) -> DataFrame:
    """Area, practice and quintiles of the spell covering the window start,
    for persons with exactly one such spell."""
    return (
        flagged.where((F.col("flag_start") == 1) & (F.col("covers_start") == 1))
        .select(
            "person_id",
            F.col("area_cd").alias("area_at_start"),
            F.col("dep1_quintile").alias("dep1_at_start"),
            F.col("dep1_desc").alias("dep1_desc_at_start"),
            F.col("dep2_quintile").alias("dep2_at_start"),
            F.col("dep2_desc").alias("dep2_desc_at_start"),
            F.col("practice_id").alias("practice_at_start"),
        )
        .distinct()
    )


def cohort_table(
    flagged: DataFrame, islands: DataFrame, reasons: DataFrame, baseline: DataFrame, window: StudyWindow
) -> DataFrame:
    """The cohort: demographics, entry/exit of the first island, follow-up
    length in days (an open end counts to the window end), exit reason and
    baseline residence. Conflicting demographics give several rows."""
    first = islands.where(F.col("rw_seq") == 1).select("person_id", "entry_dt", "exit_dt")
    attributes = [c for c in flagged.columns if c not in _SPELL_COLUMNS]
    length = F.when(
        F.col("exit_dt") == F.lit(OPEN_END), days_between(F.lit(window.end), F.col("entry_dt"))
    ).otherwise(days_between(F.col("exit_dt"), F.col("entry_dt")))
    j = flagged.join(first, "person_id").join(reasons, "person_id").join(baseline, "person_id", "left")
    return j.select(
        "person_id",
        "birth_dt",
        "death_dt",
        "sex_cd",
        _label(F.col("sex_cd"), SEX_LABELS).alias("sex_desc"),
        "age_at_start",
        *attributes,
        "flag_start",
        _label(F.col("flag_start"), START_LABELS).alias("flag_start_desc"),
        "later_dt",
        "entry_dt",
        "exit_dt",
        length.cast("int").alias("cohort_length"),
        "exit_reason",
        "area_at_start",
        "dep1_at_start",
        "dep1_desc_at_start",
        "dep2_at_start",
        "dep2_desc_at_start",
        "practice_at_start",
    ).distinct()


#: What can give a person several cohort rows, by the columns that then differ.
UNIQUENESS_CAUSES = {
    "demographics": ("birth_dt", "death_dt", "sex_cd"),
    "ethnicity": ("ethn_ner_code", "ethn_ner_desc", "ethn_ons_code", "ethn_ons_desc"),
    "start": ("flag_start", "later_dt", "entry_dt", "exit_dt"),
    "exit_reason": ("exit_reason",),
    "baseline": ("area_at_start", "practice_at_start"),
}


def observed_uniqueness(
    df: DataFrame, causes: Mapping[str, Sequence[str]], person: str = "person_id"
) -> tuple[DataFrame, Observation]:
    """``df``, and an observation that the next write or action on it fills.

    The observation counts ``rows``, ``persons`` (a null person is none),
    ``several`` (persons with more than one row) and, by cause,
    ``several_<cause>``: persons whose rows differ in one of its columns. The
    counts come from the rows as they pass by, so the check costs no second
    read; a person may have several causes, or none if its rows differ
    elsewhere. A person's rows meet in one window: they are few by nature (the
    combinations of its attributes), and no more than a window by person
    already holds for its numbering.
    """
    w = Window.partitionBy(person)
    one = F.row_number().over(w.orderBy(person)) == 1
    marks = {"_several": F.count(F.lit(1)).over(w) > 1}
    for name, columns in causes.items():
        values = F.struct(*columns)
        marks[f"_{name}"] = ~F.min(values).over(w).eqNullSafe(F.max(values).over(w))
    marked = df.withColumn("_one", one & F.col(person).isNotNull()).withColumns(marks)
    seen = Observation("uniqueness")
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if("_one").alias("persons"), F.count_if(F.col("_one") & F.col("_several")).alias("several")]
    counts += [F.count_if(F.col("_one") & F.col(f"_{name}")).alias(f"several_{name}") for name in causes]
    return marked.observe(seen, *counts).select(*df.columns), seen


def residence_history(spells: DataFrame, cohort: DataFrame, areas_wide: DataFrame, window: StudyWindow) -> DataFrame:
    """Every in-window spell of cohort members with the full area profile.
    A spell that ends after the person's cohort exit is dropped (not clipped).
    Rows repeat once per cohort row of the person, as the cohort may hold
    several rows for one person."""
    area_cols = [c for c in areas_wide.columns if c != "area_cd"]
    fin = (
        spells.where(
            F.col("area_cd").isNotNull()
            & F.col("practice_id").isNotNull()
            & ((F.col("active_to") >= F.lit(window.start)) | F.col("active_to").isNull())
            & (F.col("active_from") <= F.lit(window.end))
        )
        .join(cohort.select("person_id").distinct(), "person_id", "left_semi")
        .join(small_side(areas_wide), "area_cd")
        .select(
            "person_id",
            "active_from",
            open_end("active_to").alias("active_to"),
            "practice_id",
            "area_cd",
            *area_cols,
        )
        .distinct()
    )
    exits = cohort.select("person_id", F.col("exit_dt").alias("max_dt"))
    return fin.join(exits, "person_id").where(F.col("active_to") <= F.col("max_dt")).drop("max_dt")


def cohort_evolution(history: DataFrame, cohort: DataFrame, areas: DataFrame, window: StudyWindow) -> DataFrame:
    """Residence history with cohort entry/exit and quintile; dates after the
    window end become window end + 1 day; spells numbered per person by entry
    and spell start (remaining columns break ties)."""
    nxt = F.lit(window.end_plus_one)
    end_col = F.when(F.col("active_to") > F.lit(window.end), nxt).otherwise(F.col("active_to"))
    exit_col = F.when(F.col("exit_dt") > F.lit(window.end), nxt).otherwise(F.col("exit_dt"))
    base = (
        history.select("person_id", "area_cd", "active_from", "active_to")
        .join(
            cohort.select("person_id", "birth_dt", "death_dt", "sex_cd", "age_at_start", "exit_reason", "entry_dt", "exit_dt"),
            "person_id",
        )
        .join(small_side(areas.select("area_cd", F.col("dep1_quintile").alias("area_quintile"))), "area_cd")
        .select(
            "person_id",
            "birth_dt",
            "death_dt",
            "sex_cd",
            "age_at_start",
            "exit_reason",
            F.col("active_from").alias("area_start_dt"),
            end_col.alias("area_end_dt"),
            "area_quintile",
            "entry_dt",
            exit_col.alias("exit_dt"),
        )
        .distinct()
    )
    tie_break = [
        "entry_dt", "area_start_dt", "area_end_dt", "area_quintile", "exit_dt",
        "birth_dt", "death_dt", "sex_cd", "age_at_start", "exit_reason",
    ]
    return row_number_within(base, ["person_id"], tie_break, "rw_seq", lead=2)


def consort_flow(steps: Sequence[tuple[str, DataFrame]], person: str = "person_id") -> DataFrame:
    """Distinct persons at each selection step -> (step_no, step, n); null persons do not count."""
    return persons_by_tag(dict(steps), "step", person, number="step_no")
