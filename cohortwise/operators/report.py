"""Per-concept descriptive report.

Everything is a ``groupBy("concept")`` over the matched events; only report
rows ever need to leave the cluster. Statistics that usually gather a whole
group (first event, median, mode) are computed from pre-aggregated rows:
the first event per person is a ``min`` over a struct, and median and mode
come from a frequency table of integer ages, which is bounded by the number
of distinct ages rather than by the number of people.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.functions.dates import full_years
from cohortwise.functions.rounding import round_to
from cohortwise.functions.study import StudyWindow
from cohortwise.operators.ranking import HOT_ROWS, rank_and_number, row_number_within

# Report layout.
BANDS = [f"{lo}_{lo + 9}" for lo in range(0, 100, 10)]
SKIPPED_CONCEPT_PARTS = ("ALL_MEDICATIONS", "PAIN_MEDICATIONS")

GP_ORDER = ["event_dt", "practice_id", "local_id", "event_cd", "event_cd_desc", "event_val", "event_seq",
            "sex_cd", "age_event", "area_quintile"]
HOSP_ORDER = ["admis_dt", "disch_dt", "epi_str_dt", "epi_end_dt", "provider_cd", "spell_id", "epi_num",
              "diag_num", "diag_cd", "diag_cd_123", "diag_cd_123_desc", "diag_cd_1234", "diag_cd_1234_desc",
              "event_seq", "sex_cd", "age_event", "area_quintile"]

# Columns of enriched events that the report reads.
GP_REPORTED = ["concept", "person_id", "event_dt", "sex_cd", "age_event", "num_event"]
HOSP_REPORTED = ["concept", "person_id", "spell_id", "epi_num", "admis_dt", "epi_str_dt", "sex_cd", "age_event", "num_event"]


def mean_1dp(total: Column, count: Column) -> Column:
    """``round(total / count, 1)`` half away from zero, computed on integers so
    that every engine returns the same double."""
    half = F.floor((F.abs(total) * 20 + count) / (count * 2))
    return F.when(count > 0, F.signum(total) * half / F.lit(10.0))


def age_at_event(outcomes: DataFrame, cohort: DataFrame, date_col: str) -> DataFrame:
    """Completed years from birth to the event and the person's sex (left join
    to the cohort; one row per matching cohort row)."""
    c = cohort.select("person_id", F.col("sex_cd").alias("_sex"), F.col("birth_dt").alias("_birth"))
    return outcomes.join(c, "person_id", "left").select(
        *outcomes.columns, F.col("_sex").alias("sex_cd"), full_years(date_col, "_birth").alias("age_event")
    )


def quintiles_on(days: DataFrame, history: DataFrame, day: str) -> DataFrame:
    """The deprivation quintiles of the residence spells that contain a person's days.

    ``days(person_id, <day>)`` -> (person_id, <day>, area_quintile), one row per
    distinct quintile; days outside every spell have none. Spells whose start
    lies after their end contain no day.

    A sweep: the spells of a (person, quintile) that start on one day are
    reduced to their furthest end, combined before the shuffle, and lie in one
    order with the person's distinct days. The furthest end of all spells
    that have started then tells whether the quintile still holds. A person has
    at most a row per calendar day and quintile for its spells and its events,
    however many there are of them.
    """
    starts = (
        history.where("active_from <= active_to")
        .groupBy("person_id", F.col("dep1_quintile").alias("area_quintile"), F.col("active_from").alias("_day"))
        .agg(F.max("active_to").alias("_to"))
    )
    lived_in = starts.groupBy("person_id", "area_quintile").agg(F.min("_day").alias("_first"), F.max("_to").alias("_last"))
    asked = days.select("person_id", F.col(day).alias("_day")).distinct()
    asked = asked.join(lived_in, "person_id").where("_day BETWEEN _first AND _last")
    line = starts.unionByName(asked.select("person_id", "area_quintile", "_day", F.lit(None).cast("date").alias("_to")))
    so_far = Window.partitionBy("person_id", "area_quintile").orderBy("_day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    swept = line.withColumn("_reach", F.max("_to").over(so_far)).where("_to IS NULL AND _reach >= _day")
    return swept.select("person_id", F.col("_day").alias(day), "area_quintile")


def enrich_events(
    aged: DataFrame,
    outcomes: DataFrame,
    history: DataFrame,
    date_col: str,
    order: Sequence[str],
    cohort: DataFrame | None = None,
    write: Callable[[DataFrame], DataFrame] | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add the deprivation quintile of the residence spell containing the
    event date (null when none; one row per distinct quintile when several
    spells match) and number each person's events by date.

    The interval match is a sweep over each person's days (``quintiles_on``).
    With ``cohort`` the rows are restricted to (and repeated per row of) the
    cohort, as in a plain inner join. Events are numbered per (concept,
    person) by ``order``. ``write`` keeps the rows as a table before they are
    numbered; groups with a large share of them can then be told apart by a
    count of that table, and all others take one window (see
    ``row_number_within``). ``hot`` names the persons with a large share of the
    rows, where they are known; events that lie by person then take every step
    where they lie. ``outcomes`` supplies the days alone: any table with the
    persons and dates of the events will do.
    """
    quintiles = quintiles_on(outcomes, history, date_col)
    tot = aged.join(quintiles, ["person_id", date_col], "left").select(*aged.columns, "area_quintile").distinct()
    if cohort is not None:
        tot = tot.join(cohort.select("person_id"), "person_id")
    keys = ["person_id", "concept"]
    if write is None:
        return row_number_within(tot, keys, order, "num_event", hot=hot)
    return row_number_within(write(tot), keys, order, "num_event", hot_threshold=HOT_ROWS, hot=hot)


#: What a person's day fixes of an event.
FACTS = ["sex_cd", "age_event", "area_quintile"]


def facts_of_days(
    outcomes: DataFrame, cohort: DataFrame, history: DataFrame, date_col: str, members: bool = False
) -> DataFrame:
    """``(person_id, <day>, facts)``, a row for each day on which a person has
    outcomes: the sorted distinct sexes, ages (``age_at_event``) and quintiles
    (``quintiles_on``) of that day. With ``members``, cohort members only, and
    each fact as often as the person has cohort rows."""
    days = outcomes.select("person_id", date_col).distinct()
    aged = age_at_event(days, cohort, date_col).distinct()
    facts = (
        aged.join(quintiles_on(days, history, date_col), ["person_id", date_col], "left")
        .groupBy("person_id", date_col)
        .agg(F.sort_array(F.collect_list(F.struct(*FACTS))).alias("facts"))
    )
    if not members:
        return facts
    times = cohort.groupBy("person_id").agg(F.count(F.lit(1)).cast("int").alias("_times"))
    repeated = F.flatten(F.transform("facts", lambda fact: F.array_repeat(fact, F.col("_times"))))
    return facts.join(times, "person_id").select("person_id", date_col, repeated.alias("facts"))


def enrich_by_day(
    matched: DataFrame, rank_order: Sequence[str], order: Sequence[str], hot: DataFrame | None = None
) -> DataFrame:
    """Ranked, aged, placed and numbered events, as ``rank_events``,
    ``age_at_event`` and ``enrich_events`` make them one after the other, of
    distinct matched events that carry the ``facts`` of their day.

    Sex, age and quintile follow from the person and the day, so they join the
    rows before those are matched to concepts (``facts_of_days``). The distinct
    facts of distinct events are distinct, and one sort by person and concept
    gives the ranks and the numbers."""
    own = [c for c in order if c not in ("event_seq", *FACTS)]
    return rank_and_number(matched, ["person_id", "concept"], rank_order, own, "event_seq", "num_event", hot=hot)


def first_events(enriched: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first event of each (concept, person) in ``order`` (ties broken by
    the listed columns) -> (concept, person_id, sex_cd, age_event).
    Rows numbered by ``enrich_events`` already carry it as ``num_event == 1``;
    otherwise it is a map-side ``min`` over a struct."""
    if "num_event" in enriched.columns:
        return enriched.where(F.col("num_event") == 1).select("concept", "person_id", "sex_cd", "age_event")
    first = F.min(F.struct(*[F.col(c) for c in order], F.col("age_event").alias("_age"), F.col("sex_cd").alias("_sex")))
    return enriched.groupBy("concept", "person_id").agg(first.alias("_f")).select(
        "concept", "person_id", F.col("_f._sex").alias("sex_cd"), F.col("_f._age").alias("age_event")
    )


def _either_index(gp: DataFrame, hosp: DataFrame) -> DataFrame:
    """Youngest onset age per (concept, person, sex) over both sources; rows
    without sex are left out."""
    both = gp.select("concept", "person_id", "sex_cd", "age_event").unionByName(
        hosp.select("concept", "person_id", "sex_cd", "age_event")
    )
    return both.where(F.col("sex_cd").isNotNull()).groupBy("concept", "person_id", "sex_cd").agg(
        F.min("age_event").alias("age_event")
    )


def person_counts(gp: DataFrame, hosp: DataFrame) -> DataFrame:
    """Distinct persons per concept: per source and either, all/male/female.
    A source without any row for the concept gives nulls."""
    g = gp.select("concept", "person_id", "sex_cd", F.lit(1).alias("g"), F.lit(0).alias("h"))
    h = hosp.select("concept", "person_id", "sex_cd", F.lit(0).alias("g"), F.lit(1).alias("h"))
    male, female = F.col("sex_cd") == 1, F.col("sex_cd") == 2
    flag = lambda cond: F.max(F.when(cond, 1).otherwise(0))
    per = g.unionByName(h).groupBy("concept", "person_id").agg(
        flag(F.col("g") == 1).alias("gp"), flag(F.col("h") == 1).alias("hosp"), F.lit(1).alias("any"),
        flag((F.col("g") == 1) & male).alias("gp_m"), flag((F.col("g") == 1) & female).alias("gp_f"),
        flag((F.col("h") == 1) & male).alias("hosp_m"), flag((F.col("h") == 1) & female).alias("hosp_f"),
        flag(male).alias("any_m"), flag(female).alias("any_f"),
    )
    agg = per.groupBy("concept").agg(
        *[F.sum(c).alias(c) for c in ["gp", "hosp", "any", "gp_m", "gp_f", "hosp_m", "hosp_f", "any_m", "any_f"]]
    )
    out = [F.col("concept")]
    for src in ("gp", "hosp", "any"):
        present = F.col(src) > 0
        out.append(F.when(present, F.col(src)).cast("bigint").alias(f"n_persons_{src}"))
        out.append(F.when(present, F.col(f"{src}_m")).cast("bigint").alias(f"n_male_{src}"))
        out.append(F.when(present, F.col(f"{src}_f")).cast("bigint").alias(f"n_female_{src}"))
    return agg.select(*out)


def admission_counts(gp: DataFrame, hosp: DataFrame) -> DataFrame:
    """GP: distinct (person, date). Hospital: distinct spells with a matching
    first episode ('01', the concept caused the admission) and distinct spells
    without one. Spells are identified by spell number alone."""
    g = gp.select("concept", "person_id", "event_dt").distinct().groupBy("concept").agg(
        F.count(F.lit(1)).alias("gp_admissions")
    )
    per_spell = hosp.where(F.col("spell_id").isNotNull()).groupBy("concept", "spell_id").agg(
        F.max(F.when(F.col("epi_num") == "01", 1).otherwise(0)).alias("cause")
    )
    h = per_spell.groupBy("concept").agg(
        F.sum("cause").cast("bigint").alias("hosp_admissions_cause"),
        F.sum(1 - F.col("cause")).cast("bigint").alias("hosp_admissions_not_cause"),
    )
    return g.join(h, "concept", "full_outer").select(
        "concept", "gp_admissions", "hosp_admissions_cause", "hosp_admissions_not_cause"
    )


def _means(index: DataFrame, prefix: str) -> DataFrame:
    age = F.col("age_event")
    def m(cond):
        sel = age if cond is None else F.when(cond, age)
        return mean_1dp(F.sum(sel), F.count(sel))
    return index.groupBy("concept").agg(
        m(None).alias(f"{prefix}_mean_age"),
        m(F.col("sex_cd") == 1).alias(f"{prefix}_mean_age_male"),
        m(F.col("sex_cd") == 2).alias(f"{prefix}_mean_age_female"),
    )


def _median_mode(index: DataFrame) -> DataFrame:
    groups = F.array(
        F.lit("all"),
        F.when(F.col("sex_cd") == 1, F.lit("male")),
        F.when(F.col("sex_cd") == 2, F.lit("female")),
    )
    freq = (
        index.where(F.col("age_event").isNotNull())
        .select("concept", "age_event", F.explode(groups).alias("grp"))
        .where(F.col("grp").isNotNull())
        .groupBy("concept", "grp", "age_event")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    g = Window.partitionBy("concept", "grp")
    running = g.orderBy("age_event").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    freq = freq.select(
        "*",
        F.sum("n").over(running).alias("cum"),
        F.sum("n").over(g).alias("total"),
        F.max("n").over(g).alias("top"),
    )
    k1 = F.floor((F.col("total") + 1) / 2)
    k2 = F.floor(F.col("total") / 2) + 1
    stats = freq.groupBy("concept", "grp").agg(
        F.min(F.when(F.col("cum") >= k1, F.col("age_event"))).alias("lo"),
        F.min(F.when(F.col("cum") >= k2, F.col("age_event"))).alias("hi"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("n") == F.col("top"), F.col("age_event")))), ",").alias("mode"),
    )
    suffix = {"all": "", "male": "_male", "female": "_female"}
    cols = []
    for grp, sfx in suffix.items():
        cols.append(F.max(F.when(F.col("grp") == grp, (F.col("lo") + F.col("hi")) / F.lit(2.0))).alias(f"any_median_age{sfx}"))
    for grp, sfx in suffix.items():
        cols.append(F.max(F.when(F.col("grp") == grp, F.col("mode"))).alias(f"any_mode_age{sfx}"))
    return stats.groupBy("concept").agg(*cols)


def onset_age_stats(gp: DataFrame, hosp: DataFrame) -> DataFrame:
    """Onset age per concept: mean age at the first event per source and sex;
    over both sources (youngest age per person and sex) mean, median and all
    tied modes (comma-separated, ascending). Means are rounded to 1 decimal."""
    gp_first = first_events(gp, GP_ORDER)
    hosp_first = first_events(hosp, HOSP_ORDER)
    either = _either_index(gp, hosp)
    out = _means(gp_first, "gp").join(_means(hosp_first, "hosp"), "concept", "full_outer")
    out = out.join(_means(either, "any"), "concept", "full_outer")
    return out.join(_median_mode(either), "concept", "left")


def onset_age_histogram(gp: DataFrame, hosp: DataFrame) -> DataFrame:
    """Persons by concept, source (gp, hosp, any), sex and 10-year onset-age
    band 0-9 .. 90-100 (the last band includes 100; other ages are left out)."""
    parts = [
        first_events(gp, GP_ORDER).withColumn("source", F.lit("gp")),
        first_events(hosp, HOSP_ORDER).withColumn("source", F.lit("hosp")),
        _either_index(gp, hosp).withColumn("source", F.lit("any")),
    ]
    rows = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    age = F.col("age_event")
    return (
        rows.where(age.between(0, 100) & F.col("sex_cd").isin(1, 2))
        .withColumn("band", F.least(F.floor(age / 10), F.lit(9)).cast("int"))
        .groupBy("concept", "source", "sex_cd", "band")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def incident_prevalent(gp: DataFrame, hosp: DataFrame, window: StudyWindow) -> DataFrame:
    """Distinct event keys before (prevalent) and on/after (incident) the
    window start. GP keys: (person, date); hospital keys: (person, admission,
    episode start), tested on the admission date."""
    start = F.lit(window.start)

    def counts(df, keys, test, prefix):
        d = df.select("concept", *keys).distinct()
        return d.groupBy("concept").agg(
            F.count(F.lit(1)).alias(f"{prefix}_total"),
            F.count(F.when(F.col(test) >= start, 1)).alias(f"{prefix}_incident"),
            F.count(F.when(F.col(test) < start, 1)).alias(f"{prefix}_prevalent"),
        )

    g = counts(gp, ["person_id", "event_dt"], "event_dt", "gp")
    h = counts(hosp, ["person_id", "admis_dt", "epi_str_dt"], "admis_dt", "hosp")
    return g.join(h, "concept", "full_outer")


def records_per_person(outcomes: DataFrame, source: str) -> DataFrame:
    """Rows per person per concept: persons, mean (1 decimal) and sample
    standard deviation (2 decimals) of the row count."""
    per = outcomes.groupBy("concept", "person_id").agg(F.count(F.lit(1)).alias("k"))
    agg = per.groupBy("concept").agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("s"), F.sum(F.col("k") * F.col("k")).alias("ss")
    )
    n, s, ss = F.col("n"), F.col("s"), F.col("ss")
    wide = [c.cast("decimal(38,0)") for c in (n, s, ss)]  # products of counts pass 64 bits
    spread = (wide[0] * wide[2] - wide[1] * wide[1]).cast("double")
    var = spread / (wide[0] * (wide[0] - 1)).cast("double")
    return agg.select(
        "concept",
        F.lit(source).alias("source"),
        n.cast("bigint").alias("n_persons"),
        mean_1dp(s, n).alias("mean_records"),
        F.when(n > 1, F.round(F.sqrt(var), 2)).alias("sd_records"),
    )


def suppress_counts(df: DataFrame, cols: Sequence[str], base: int = 10) -> DataFrame:
    """Round the given count columns to the nearest ``base`` for publication."""
    cols = set(cols)
    return df.select(*[round_to(c, base).alias(c) if c in cols else F.col(c) for c in df.columns])


def band_columns() -> list[str]:
    return [f"n_{sex}_{band}_{src}" for band in BANDS for src in ("gp", "hosp", "any") for sex in ("male", "female")]


def concept_report(
    gp: DataFrame, hosp: DataFrame, sensitive_concepts: Sequence[str] = (), base: int = 10
) -> DataFrame:
    """One row per reported concept (87 columns): rounded person counts and
    admissions, onset-age means, medians and modes, and rounded counts per
    sex and onset-age band for each source. Medication and sensitive concepts
    are skipped; a source without rows for a concept gives nulls."""
    keep = F.lit(True)
    for part in SKIPPED_CONCEPT_PARTS:
        keep = keep & ~F.col("concept").contains(part)
    if sensitive_concepts:
        keep = keep & ~F.col("concept").isin(list(sensitive_concepts))
    gp, hosp = gp.where(keep), hosp.where(keep)

    counts = person_counts(gp, hosp)
    adm = admission_counts(gp, hosp).select("concept", "gp_admissions", "hosp_admissions_cause")
    ages = onset_age_stats(gp, hosp)
    hist = onset_age_histogram(gp, hosp)
    sex_name = F.when(F.col("sex_cd") == 1, "male").otherwise("female")
    keyed = hist.select("concept", F.concat_ws("_", sex_name, F.col("band").cast("string"), F.col("source")).alias("key"), "n")
    band_aggs = []
    for band_no, band in enumerate(BANDS):
        for src in ("gp", "hosp", "any"):
            for sex in ("male", "female"):
                band_aggs.append(F.sum(F.when(F.col("key") == f"{sex}_{band_no}_{src}", F.col("n"))).alias(f"n_{sex}_{band}_{src}"))
    bands = keyed.groupBy("concept").agg(*band_aggs)

    report = counts.join(adm, "concept", "left").join(ages, "concept", "left").join(bands, "concept", "left")
    count_cols = [c for c in counts.columns if c != "concept"] + ["gp_admissions", "hosp_admissions_cause"]
    present = {src: F.col(f"n_persons_{src}").isNotNull() for src in ("gp", "hosp", "any")}
    out = [F.col("concept")]
    out += [round_to(c, base).alias(c) for c in count_cols]
    out += [F.col(c) for c in ages.columns if c != "concept"]
    for band in BANDS:
        for src in ("gp", "hosp", "any"):
            for sex in ("male", "female"):
                name = f"n_{sex}_{band}_{src}"
                out.append(F.when(present[src], round_to(F.coalesce(F.col(name), F.lit(0)), base)).alias(name))
    return report.select(*out)


def write_report_csv(report: DataFrame, path: str) -> None:
    """Write the report (one row per concept, so bounded by the number of
    concepts) as a single CSV file with a header, sorted by concept."""
    report.orderBy("concept").coalesce(1).write.mode("overwrite").option("header", True).csv(path)
