"""Registered queries: one per operator, each over the whole fixture tables.

Each entry takes (spark, sf_dir) and returns a DataFrame. Column names match
the SQL oracle in ``cohortwise.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.operators import codelists as K
from cohortwise.operators import extract as E
from cohortwise.operators import linkage as L
from cohortwise.operators import outcomes as O
from cohortwise.operators import report as R
from cohortwise.plans.sizing import shared_dir
from cohortwise.plans.study import SENSITIVE_CONCEPTS, Study
from cohortwise.sources.codelists import codelist_lines, read_codelists, scan_codelists, write_codelist_files, write_codelists
from cohortwise.sources.versions import LookupStore

SINGLE_CONCEPT = "PROMO"
OTHER_LAYOUT = "MEDIUM"  # the concept whose file comes in the other vocabulary's layout

Query = Callable[[SparkSession, str], DataFrame]


def _study(spark: SparkSession, sf_dir: str) -> Study:
    return Study.shared(spark, sf_dir)


def q_consort_flow(spark, sf_dir):
    return _study(spark, sf_dir).consort()


def q_valid_registry_people(spark, sf_dir):
    return _study(spark, sf_dir).valid_people


def q_reconcile_demographics(spark, sf_dir):
    return _study(spark, sf_dir).reconciled


def q_study_window_filter(spark, sf_dir):
    return _study(spark, sf_dir).windowed


def q_age_sex_eligibility(spark, sf_dir):
    return _study(spark, sf_dir).eligible


def q_deprivation_map(spark, sf_dir):
    return _study(spark, sf_dir).deprived


def q_baseline_residence(spark, sf_dir):
    return _study(spark, sf_dir).baseline


def q_cohort_start_flags(spark, sf_dir):
    return _study(spark, sf_dir).flagged


def q_merge_spells(spark, sf_dir):
    return _study(spark, sf_dir).islands


def q_followup_break_flag(spark, sf_dir):
    return _study(spark, sf_dir).breaks


def q_exit_reason(spark, sf_dir):
    return _study(spark, sf_dir).reasons


def q_cohort_table(spark, sf_dir):
    return _study(spark, sf_dir).cohort


def q_residence_history(spark, sf_dir):
    return _study(spark, sf_dir).history


def q_cohort_evolution(spark, sf_dir):
    return _study(spark, sf_dir).evolution


def q_source_flag(spark, sf_dir):
    s = _study(spark, sf_dir)
    return L.source_flags_long(s.cohort, s.direct_sources())


def q_source_flag_via_parent(spark, sf_dir):
    s = _study(spark, sf_dir)
    return L.source_flags_long(s.cohort, s.parent_sources())


def q_linkage_table(spark, sf_dir):
    return _study(spark, sf_dir).linkage_written


def q_linkage_check(spark, sf_dir):
    s = _study(spark, sf_dir)
    return L.linkage_check(s.cohort, s.linkage_written)


def q_extract_by_person(spark, sf_dir):
    return _study(spark, sf_dir).gp_extract


def q_extract_by_spell(spark, sf_dir):
    return _study(spark, sf_dir).episode_extract


def q_extract_semi(spark, sf_dir):
    return _study(spark, sf_dir).emergency_extract


def q_extract_via_parent(spark, sf_dir):
    return _study(spark, sf_dir).outpatient_diag_extract


def q_extract_spells(spark, sf_dir):
    return _study(spark, sf_dir).spell_extract


def q_extract_admissions(spark, sf_dir):
    return _study(spark, sf_dir).admissions_extract


def q_extract_outpatients(spark, sf_dir):
    return _study(spark, sf_dir).outpatient_extract


def q_extract_diagnoses(spark, sf_dir):
    return _study(spark, sf_dir).diag_extract


def q_extract_operations(spark, sf_dir):
    return _study(spark, sf_dir).oper_extract


def q_extract_outpatient_operations(spark, sf_dir):
    return _study(spark, sf_dir).outpatient_oper_extract


def q_write_extract(spark, sf_dir):
    s = _study(spark, sf_dir)
    path = shared_dir(spark, "gp-extract")
    E.write_extract(s.gp_extract, path, "event_dt")
    return spark.read.parquet(path)


def q_extract_checks(spark, sf_dir):
    s = _study(spark, sf_dir)
    return s.counted(E.extract_checks(s.extracts()), "extract_checks")


def q_load_codelists(spark, sf_dir):
    s = _study(spark, sf_dir)
    path = shared_dir(spark, "codelists")
    write_codelists(s.fx.codelist_read, path, "readv2")
    return read_codelists(spark, path, "readv2", "2_2_3", concept_from="column")


def _delivered_files(codes: DataFrame, vocab: str, end: str) -> DataFrame:
    """The scan of a delivery of one CSV per concept with faults in it: codes
    that end in 3, 5 and 7 (before ``end``) lack the code, name another concept
    and lack a field; one file has the layout of the other vocabulary."""
    rows = codes.select(
        F.col("concept").alias("file"),
        F.when(F.col("code").endswith("5" + end), "OTHER").otherwise(F.col("concept")).alias("concept"),
        F.when(~F.col("code").endswith("3" + end), F.col("code")).alias("code"),
        "concept_type",
        F.concat(F.lit("about "), "code").alias("description"),
    )
    other = {"readv2": "icd10", "icd10": "readv2"}[vocab]
    odd = F.col("file") == OTHER_LAYOUT
    lines = codelist_lines(rows.where(~odd), vocab, "file").unionByName(codelist_lines(rows.where(odd), other, "file"))
    short = F.coalesce(F.col("code").endswith("7" + end), F.lit(False))
    lines = lines.withColumn("line", F.when(short, F.regexp_replace("line", ",[^,]*$", "")).otherwise(F.col("line")))
    path = shared_dir(codes.sparkSession, f"codelist-files-{vocab}")
    write_codelist_files(lines, path)
    return scan_codelists(codes.sparkSession, path, vocab, "2_2_3")


def q_load_codelist_files(spark, sf_dir):
    return _delivered_files(_study(spark, sf_dir).fx.codelist_read, "readv2", ".")


def q_load_codelist_files_icd10(spark, sf_dir):
    return _delivered_files(_study(spark, sf_dir).fx.codelist_icd10, "icd10", "")


def q_codelist_diff(spark, sf_dir):
    return _study(spark, sf_dir).codelist_changes()


def q_flag_sensitive(spark, sf_dir):
    return _study(spark, sf_dir).read_codes


def q_flag_sensitive_icd10(spark, sf_dir):
    return _study(spark, sf_dir).icd_codes


def q_read_lookup(spark, sf_dir):
    return _study(spark, sf_dir).read_lookup


def q_icd10_lookup(spark, sf_dir):
    return _study(spark, sf_dir).icd_lookup


def q_latest_version(spark, sf_dir):
    return K.latest_version(_study(spark, sf_dir).fx.codelist_versions)


def q_published_lookup(spark, sf_dir):
    """The unversioned view after three versions were published."""
    versions = _study(spark, sf_dir).fx.codelist_versions
    store = LookupStore(spark, shared_dir(spark, "lookups"))
    for version in ("2_2_3", "2_2_9", "2_2_10"):
        store.publish(versions.where(F.col("version") == version).select("concept", "code", "concept_type"), version)
    return store.current()


def q_updated_lookup(spark, sf_dir):
    """The published read lookup after a rebuild of the concepts that the diff names."""
    s = _study(spark, sf_dir)
    store = LookupStore(spark, shared_dir(spark, "lookups"))
    s.publish_read_lookup(store)
    s.republish_changed(store)
    return store.current()


def q_load_extract(spark, sf_dir):
    """The GP extract loaded in five date ranges, one of them twice."""
    s = _study(spark, sf_dir)
    path = shared_dir(spark, "gp-load")
    fifth = (s.w.end_plus_one - s.w.events_from) // 5
    edges = [s.w.events_from + i * fifth for i in range(5)] + [s.w.end_plus_one]
    ranges = list(zip(edges, edges[1:], strict=False))
    for lo, hi in [*ranges, ranges[2]]:
        E.load_range(s.gp_extract, path, "event_dt", lo, hi)
    return E.read_loaded(spark, path)


def q_cohort_uniqueness(spark, sf_dir):
    return _study(spark, sf_dir).cohort_uniqueness()


def q_medication_lookup(spark, sf_dir):
    return _study(spark, sf_dir).medication_lookup


def q_primary_care_outcomes(spark, sf_dir):
    return _study(spark, sf_dir).gp_outcomes


def q_hospital_outcomes(spark, sf_dir):
    return _study(spark, sf_dir).hosp_outcomes


def q_outcome_coverage(spark, sf_dir):
    s = _study(spark, sf_dir)
    return O.outcome_coverage({"read": s.read_lookup, "icd10": s.icd_lookup}, {"read": s.gp_outcomes, "icd10": s.hosp_outcomes})


def q_single_concept_outcomes(spark, sf_dir):
    return _study(spark, sf_dir).single_concept_gp(SINGLE_CONCEPT)


def q_single_concept_hospital(spark, sf_dir):
    return _study(spark, sf_dir).single_concept_hospital(SINGLE_CONCEPT)


def q_age_at_event(spark, sf_dir):
    return _study(spark, sf_dir).gp_aged


def q_age_at_admission(spark, sf_dir):
    return _study(spark, sf_dir).hosp_aged


def q_enrich_admissions(spark, sf_dir):
    return _study(spark, sf_dir).hosp_enriched


def q_enrich_events(spark, sf_dir):
    return _study(spark, sf_dir).gp_enriched


def q_person_counts(spark, sf_dir):
    s = _study(spark, sf_dir)
    return R.person_counts(*s.reported)


def q_admission_counts(spark, sf_dir):
    s = _study(spark, sf_dir)
    return R.admission_counts(*s.reported)


def q_onset_age_stats(spark, sf_dir):
    s = _study(spark, sf_dir)
    return R.onset_age_stats(*s.reported)


def q_onset_age_histogram(spark, sf_dir):
    s = _study(spark, sf_dir)
    return R.onset_age_histogram(*s.reported)


def q_incident_prevalent(spark, sf_dir):
    s = _study(spark, sf_dir)
    return s.counted(R.incident_prevalent(*s.reported, s.w), "incident_prevalent")


def q_records_per_person(spark, sf_dir):
    s = _study(spark, sf_dir)
    gp, hosp = s.reported
    return R.records_per_person(gp, "gp").unionByName(R.records_per_person(hosp, "hosp"))


def q_suppress_counts(spark, sf_dir):
    s = _study(spark, sf_dir)
    counts = R.person_counts(*s.reported)
    return R.suppress_counts(counts, [c for c in counts.columns if c != "concept"])


def q_concept_report(spark, sf_dir):
    s = _study(spark, sf_dir)
    return R.concept_report(*s.reported, SENSITIVE_CONCEPTS)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)
}
