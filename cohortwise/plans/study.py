"""A whole study wired from the operators: cohort -> linkage -> extracts ->
codelists -> outcomes -> report, over one directory of Parquet tables.

Attributes are lazy DataFrames. Stages that later steps reuse several times
(flagged spells, islands, cohort, residence history, matched outcomes and
enriched events) are written once to the shared checkpoint folder, the way
the study materializes tables between steps.
"""

from __future__ import annotations

import os
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.functions.study import DEFAULT_WINDOW, StudyWindow
from cohortwise.operators import cohort as C
from cohortwise.operators import codelists as K
from cohortwise.operators import extract as E
from cohortwise.operators import linkage as L
from cohortwise.operators import outcomes as O
from cohortwise.operators import report as R
from cohortwise.operators.spells import merge_spells
from cohortwise.operators.ranking import hot_groups
from cohortwise.plans.sizing import dealt, shared_dir, small_side, stage_settings
from cohortwise.sources.fixtures import Fixtures
from cohortwise.sources.tables import ParquetTables
from cohortwise.sources.versions import LookupStore

SENSITIVE_CONCEPTS = ("ECONOMY",)
PUBLISHED_VERSION, NEW_VERSION = "2_2_9", "2_2_10"  # of the codelists
OUTPATIENT_KEYS = ("provider_cd", "case_id", "attend_dt", "att_id")
LINKAGE_GROUPS = {
    "flag_hospital": ["flag_hosp_adm", "flag_hosp_diag", "flag_hosp_oper"],
    "flag_outpatient_any": ["flag_outpatient", "flag_outpatient_diag", "flag_outpatient_oper"],
    "flag_gp": ["flag_gp_reg", "flag_gp_events"],
}


#: Stages with few rows a person by nature, so that no bucket of theirs grows with one person.
PERSON_STAGES = frozenset({"cohort", "islands"})

_CATALOG: dict[tuple[str, str], "Study"] = {}


class Study:
    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "Study":
        """The study of ``sf_dir`` for this Spark application.

        Like the tables a study keeps between its scripts, stages materialized
        by one query (cohort, outcomes, ...) are reused by the next one in the
        same application instead of being rebuilt.
        """
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _CATALOG:
            _CATALOG[key] = cls(spark, sf_dir)
        return _CATALOG[key]

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        window: StudyWindow = DEFAULT_WINDOW,
        checkpoint: bool = True,
        materialize: str = "parquet",
        island_rule: str = "pairwise",
        bucketed: frozenset[str] = PERSON_STAGES,
    ):
        self.spark = spark
        self.sf_dir = sf_dir
        self.w = window
        self.fx = Fixtures(ParquetTables(spark, sf_dir))
        self._checkpoint = checkpoint
        self._materialize = materialize
        self._bucketed = bucketed if materialize == "bucketed" else frozenset()
        self.island_rule = island_rule
        self._root = None
        if checkpoint:
            self._root = shared_dir(spark, "study")  # shared folder under spark.checkpoint.dir

    def _cut(self, df: DataFrame, name: str = "stage") -> DataFrame:
        """Materialize a stage that later steps reuse several times.

        The rows are written once to the cluster's shared checkpoint folder,
        by default as a Parquet table (columnar, column-pruned reads, real
        sizes for the planner); ``materialize="checkpoint"`` takes a reliable
        ``checkpoint()`` instead, which keeps the stage's partitioning but is
        read whole. ``materialize="bucketed"`` writes the stages named in
        ``bucketed`` as tables bucketed and sorted by person. Later plans start
        from the written rows instead of re-planning and recomputing the chain,
        and a lost executor does not force a recomputation from the sources.
        """
        if not self._checkpoint:
            return df
        if self._materialize == "checkpoint":
            return df.checkpoint(eager=True)
        path = os.path.join(self._root, f"{name}-{uuid.uuid4().hex[:8]}")
        if name in self._bucketed:
            return self._by_person(df, path)
        with stage_settings(self.spark, self._input_rows):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def counted(self, df: DataFrame, name: str) -> DataFrame:
        """A few rows that are counted from all rows of large tables, written so
        that the shuffles below them have the partitions of a stage."""
        return self._cut(df, name)

    @cached_property
    def _input_rows(self) -> int:
        return max(self.fx.tables[t].count() for t in ("orders", "lineitem", "events"))  # from the files' footers

    def _by_person(self, df: DataFrame, path: str) -> DataFrame:
        """``df`` as a table bucketed and sorted by person, one file a bucket.

        There are as many buckets as shuffle partitions, so a join or an
        aggregate by person takes the table as it lies and shuffles the other
        side alone. The files stay in the study's folder; the session's
        catalog gets a table of the folder's name.
        """
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        table = "study_" + os.path.basename(path).replace("-", "_")
        rows = df.repartition(buckets, "person_id").write.option("path", path)
        rows.bucketBy(buckets, "person_id").sortBy("person_id").saveAsTable(table)
        return self.spark.table(table)

    # ---- cohort -------------------------------------------------------------
    @cached_property
    def valid_people(self) -> DataFrame:
        return C.valid_registry_people(self.fx.residence, self.fx.births, self.fx.deaths)

    @cached_property
    def reconciled(self) -> DataFrame:
        rows = C.reconcile_demographics(self.fx.residence, self.fx.births, self.fx.deaths, self.valid_people)
        return self._cut(rows, "reconciled")  # each selection step and its count start here

    @cached_property
    def windowed(self) -> DataFrame:
        return self._cut(C.study_window_filter(self.reconciled, self.fx.ethnicity, self.w), "windowed")

    @cached_property
    def eligible(self) -> DataFrame:
        return C.age_sex_eligibility(self.windowed, self.w)

    @cached_property
    def deprived(self) -> DataFrame:
        return self._cut(C.deprivation_map(self.eligible, self.fx.areas, self.w), "deprived")

    @cached_property
    def flagged(self) -> DataFrame:
        return self._cut(C.cohort_start_flags(self.deprived, self.w), "flagged")

    @cached_property
    def islands(self) -> DataFrame:
        return self._cut(merge_spells(self.flagged, self.w, rule=self.island_rule), "islands")

    @cached_property
    def breaks(self) -> DataFrame:
        return C.followup_break_flag(self.islands)

    @cached_property
    def reasons(self) -> DataFrame:
        return C.exit_reason(self.flagged, self.islands, self.breaks, self.w)

    @cached_property
    def baseline(self) -> DataFrame:
        return C.baseline_residence(self.flagged)

    @cached_property
    def cohort(self) -> DataFrame:
        rows, self._uniqueness = C.observed_uniqueness(
            C.cohort_table(self.flagged, self.islands, self.reasons, self.baseline, self.w), C.UNIQUENESS_CAUSES
        )
        return self._cut(rows, "cohort")

    def cohort_uniqueness(self) -> DataFrame:
        """Rows and persons of the cohort, and persons with several rows by cause, as counted while it was written."""
        cohort = self.cohort
        if not self._checkpoint:  # nothing was written: a pass over the lazy rows does the counting
            cohort.write.format("noop").mode("overwrite").save()
        found = self._uniqueness.get
        return self.spark.createDataFrame([(k, v or 0) for k, v in found.items()], "measure string, n long")

    @cached_property
    def history(self) -> DataFrame:
        return self._cut(C.residence_history(self.fx.residence, self.cohort, self.fx.areas, self.w), "history")

    @cached_property
    def evolution(self) -> DataFrame:
        return C.cohort_evolution(self.history, self.cohort, self.fx.areas, self.w)

    def consort(self) -> DataFrame:
        return C.consort_flow(
            [
                ("source", self.fx.residence),
                ("valid_registry", self.reconciled),
                ("study_window", self.windowed),
                ("age_sex", self.eligible),
                ("cohort", self.cohort),
            ]
        )

    # ---- linkage ------------------------------------------------------------
    def direct_sources(self) -> dict[str, DataFrame]:
        fx, w = self.fx, self.w
        diag_rows = fx.hospital_diag.join(fx.hospital_spell, ["provider_cd", "spell_id"]).select("person_id", "admis_dt")
        oper_rows = fx.hospital_oper.join(fx.hospital_spell, ["provider_cd", "spell_id"]).select("person_id", "admis_dt")
        return {
            "flag_deaths": L.registry_keys(self.cohort, fx.deaths, "death_dt", w.end),
            "flag_births": L.registry_keys(self.cohort, fx.births, "birth_dt", w.end),
            "flag_gp_reg": L.record_keys(fx.gp_registration, "start_date", None, w.end),
            "flag_gp_events": L.record_keys(fx.gp_event, "event_dt", w.events_from, w.end),
            "flag_area": L.record_keys(fx.residence, "active_from", None, w.end),
            "flag_hosp_adm": L.record_keys(fx.admissions, "start_date", w.events_from, w.end),
            "flag_hosp_diag": L.record_keys(diag_rows, "admis_dt", w.events_from, w.end),
            "flag_hosp_oper": L.record_keys(oper_rows, "admis_dt", w.events_from, w.end),
            "flag_emergency": L.record_keys(fx.emergency, "event_dt", w.events_from, w.end),
            "flag_outpatient": L.record_keys(fx.outpatient, "ref_dt", w.events_from, w.end),
            "flag_pathology": L.record_keys(fx.pathology, "specimen_dt", w.events_from, w.end),
        }

    def parent_sources(self) -> dict[str, DataFrame]:
        fx, w = self.fx, self.w
        return {
            "flag_outpatient_diag": L.record_keys_via_parent(
                fx.outpatient_diag, fx.outpatient, OUTPATIENT_KEYS, "attend_dt", w.events_from, w.end
            ),
            "flag_outpatient_oper": L.record_keys_via_parent(
                fx.outpatient_oper, fx.outpatient, OUTPATIENT_KEYS, "attend_dt", w.events_from, w.end
            ),
        }

    @cached_property
    def linkage(self) -> DataFrame:
        keys = {**self.direct_sources(), **self.parent_sources()}
        return L.linkage_table(self.cohort, keys, LINKAGE_GROUPS)

    @cached_property
    def linkage_written(self) -> DataFrame:
        return self._cut(self.linkage, "linkage")  # a row a person

    # ---- extracts -----------------------------------------------------------
    def gp_rows(self) -> DataFrame:
        return E.extract_by_person(
            self.fx.gp_event, self.cohort, ["sex_cd", "birth_dt", "death_dt"], "event_dt",
            self.w.events_from, self.w.end, closed=True, where="practice_id IS NOT NULL",
        )

    def admissions_rows(self) -> DataFrame:
        return E.extract_by_person(
            self.fx.admissions, self.cohort, ["birth_dt"], "end_date", self.w.events_from, self.w.end, closed=False
        )

    def outpatient_rows(self) -> DataFrame:
        return E.extract_by_person(self.fx.outpatient, self.cohort, [], "ref_dt", self.w.events_from, self.w.end)

    def episode_rows(self) -> DataFrame:
        return E.extract_by_spell(self.fx.hospital_episode, self.spell_extract, "epi_str_dt", self.w.events_from, self.w.end)

    def diag_rows(self) -> DataFrame:
        return E.extract_by_spell(self.fx.hospital_diag, self.spell_extract)

    def oper_rows(self) -> DataFrame:
        return E.extract_by_spell(self.fx.hospital_oper, self.spell_extract, "oper_dt", self.w.events_from, self.w.end)

    def emergency_rows(self) -> DataFrame:
        return E.extract_semi(self.fx.emergency, self.cohort)

    def outpatient_diag_rows(self) -> DataFrame:
        return E.extract_via_parent(
            self.fx.outpatient_diag, self.fx.outpatient, OUTPATIENT_KEYS, self.cohort, "attend_dt",
            self.w.events_from, self.w.end,
        )

    def outpatient_oper_rows(self) -> DataFrame:
        return E.extract_via_parent(
            self.fx.outpatient_oper, self.fx.outpatient, OUTPATIENT_KEYS, self.cohort, "attend_dt",
            self.w.events_from, self.w.end,
        )

    @cached_property
    def spell_extract(self) -> DataFrame:
        rows = E.extract_by_person(
            self.fx.hospital_spell, self.cohort, ["birth_dt"], "admis_dt", self.w.events_from, self.w.end, closed=False
        )
        return self._cut(rows, "spell_extract")  # four extracts join it

    @cached_property
    def gp_extract(self) -> DataFrame:
        return self._cut(self.gp_rows(), "gp_extract")

    @cached_property
    def admissions_extract(self) -> DataFrame:
        return self._cut(self.admissions_rows(), "admissions_extract")

    @cached_property
    def outpatient_extract(self) -> DataFrame:
        return self._cut(self.outpatient_rows(), "outpatient_extract")

    @cached_property
    def episode_extract(self) -> DataFrame:
        return self._cut(self.episode_rows(), "episode_extract")

    @cached_property
    def diag_extract(self) -> DataFrame:
        return self._cut(self.diag_rows(), "diag_extract")

    @cached_property
    def oper_extract(self) -> DataFrame:
        return self._cut(self.oper_rows(), "oper_extract")

    @cached_property
    def emergency_extract(self) -> DataFrame:
        return self._cut(self.emergency_rows(), "emergency_extract")

    @cached_property
    def outpatient_diag_extract(self) -> DataFrame:
        return self._cut(self.outpatient_diag_rows(), "outpatient_diag_extract")

    @cached_property
    def outpatient_oper_extract(self) -> DataFrame:
        return self._cut(self.outpatient_oper_rows(), "outpatient_oper_extract")

    def _rows_of(self, name: str) -> DataFrame:
        """The rows of an extract: as written, or else the plan that would be written."""
        written = f"{name}_extract"
        return getattr(self, written) if written in self.__dict__ else getattr(self, f"{name}_rows")()

    def extracts(self) -> dict[str, DataFrame]:
        """All extracts; those that no query has written stay plans, so that a
        check reads no more of them than the columns it asks for."""
        return {
            "gp_events": self._rows_of("gp"),
            "hospital_spells": self.spell_extract,
            "hospital_admissions": self._rows_of("admissions"),
            "hospital_episodes": self._rows_of("episode"),
            "hospital_diagnoses": self._rows_of("diag"),
            "hospital_operations": self._rows_of("oper"),
            "emergency": self._rows_of("emergency"),
            "outpatients": self._rows_of("outpatient"),
            "outpatient_diagnoses": self._rows_of("outpatient_diag"),
            "outpatient_operations": self._rows_of("outpatient_oper"),
        }

    # ---- codelists ----------------------------------------------------------
    @cached_property
    def read_codes(self) -> DataFrame:
        """Read codelist with sensitivity flags from the sensitive-code list."""
        codes = self.fx.codelist_read.select("concept", "code", "concept_type")
        return K.flag_sensitive(codes, self.fx.sensitive_codes, SENSITIVE_CONCEPTS)

    @cached_property
    def icd_codes(self) -> DataFrame:
        """ICD-10 codelist with sensitivity flags from its own sensitive-code list."""
        codes = self.fx.codelist_icd10.select("concept", "code", "concept_type")
        return K.flag_sensitive(codes, self.fx.sensitive_icd10, SENSITIVE_CONCEPTS)

    @cached_property
    def icd_dict(self) -> DataFrame:
        return self._cut(self.fx.icd10_dict, "icd_dict")

    @cached_property
    def read_lookup(self) -> DataFrame:
        return self._cut(K.read_lookup(self.read_codes, self.fx.read_dict), "read_lookup")

    @cached_property
    def icd_lookup(self) -> DataFrame:
        return self._cut(K.icd10_lookup(self.icd_codes, self.icd_dict), "icd_lookup")

    @cached_property
    def medication_lookup(self) -> DataFrame:
        codes = K.flag_sensitive(
            self.fx.codelist_medication.select("concept", "code", "alt_code", "drug_category", "concept_type"),
            self.fx.sensitive_codes, SENSITIVE_CONCEPTS,
        )
        return K.medication_lookup(codes, self.fx.read_dict)

    def _codelist_sides(self) -> tuple[DataFrame, DataFrame]:
        v = self.fx.codelist_versions
        new = v.where(F.col("version") == NEW_VERSION)
        return new, K.latest_version(v.where(F.col("version") != NEW_VERSION))

    def codelist_changes(self) -> DataFrame:
        return K.codelist_diff(*self._codelist_sides())

    def updated_read_lookup(self) -> DataFrame:
        """The read lookup with the concepts that the diff calls new or updated
        built from the new version, all others from the published one."""
        codes = K.flag_sensitive(K.codelist_build(*self._codelist_sides()), self.fx.sensitive_codes, SENSITIVE_CONCEPTS)
        return K.read_lookup(codes, self.fx.read_dict)

    def publish_read_lookup(self, store: LookupStore) -> None:
        """Publish the read lookup of the codelists published before the new version."""
        _, published = self._codelist_sides()
        codes = K.flag_sensitive(published.drop("version"), self.fx.sensitive_codes, SENSITIVE_CONCEPTS)
        store.publish(K.read_lookup(codes, self.fx.read_dict), PUBLISHED_VERSION)

    def republish_changed(self, store: LookupStore) -> None:
        """Build and publish the concepts that the diff calls new or updated, and no other."""
        new, _ = self._codelist_sides()
        changed = self.codelist_changes().where("status IN ('new', 'updated')").select("concept")
        changed = self._cut(changed, "changed_concepts")  # a row a concept
        rows = new.drop("version").join(small_side(changed), "concept", "left_semi")
        codes = K.flag_sensitive(rows, self.fx.sensitive_codes, SENSITIVE_CONCEPTS)
        store.publish(K.read_lookup(codes, self.fx.read_dict), NEW_VERSION, [r.concept for r in changed.collect()])

    # ---- outcomes -----------------------------------------------------------
    @cached_property
    def cohort_persons(self) -> DataFrame:
        return self.cohort.select("person_id").distinct()

    def outcome_sources(self) -> dict[str, DataFrame]:
        """The extracts that outcomes are matched on, restricted by cohort
        membership only: joined with the cohort's distinct persons, so a
        person with several cohort rows does not multiply rows that the
        matching de-duplicates anyway (same distinct result as the extracts).

        Diagnoses and episodes are not pre-joined with the extracted spells:
        the matching joins them with those spells in any case, so the small
        lookups can filter the diagnoses before any large join."""
        fx, w, persons = self.fx, self.w, self.cohort_persons
        gp = E.extract_by_person(fx.gp_event, persons, [], "event_dt", w.events_from, w.end, where="practice_id IS NOT NULL")
        spells = E.extract_by_person(fx.hospital_spell, persons, [], "admis_dt", w.events_from, w.end, closed=False)
        episodes = fx.hospital_episode.where(
            (F.col("epi_str_dt") >= F.lit(w.events_from)) & (F.col("epi_str_dt") < F.lit(w.end))
        )
        return {"gp": gp, "spells": spells, "episodes": episodes, "diagnoses": fx.hospital_diag}

    @cached_property
    def gp_matched(self) -> DataFrame:
        # as in the study, outcomes are matched on the cohort extract
        return self._cut(O.match_primary_care(self.outcome_sources()["gp"], self.read_lookup), "gp_matched")

    @cached_property
    def gp_hot(self) -> DataFrame:
        return self._cut(hot_groups(self.gp_matched, ["person_id"]), "gp_hot")

    @cached_property
    def gp_outcomes(self) -> DataFrame:
        # ranked on the way, where the matched rows lie by person
        return O.rank_events(dealt(self.gp_matched, "person_id", self.gp_hot), O.GP_RANK_ORDER, self.gp_hot)

    @cached_property
    def hosp_stays(self) -> DataFrame:
        src = self.outcome_sources()
        return self._cut(O.diagnosis_stays(src["diagnoses"], src["episodes"], src["spells"], self.icd_lookup), "hosp_stays")

    @cached_property
    def hosp_hot(self) -> DataFrame:
        return self._cut(hot_groups(self.hosp_stays, ["person_id"]), "hosp_hot")

    @cached_property
    def hosp_codes(self) -> DataFrame:
        return self._cut(O.stay_codes(self.hosp_stays), "hosp_codes")

    @cached_property
    def hosp_matched(self) -> DataFrame:
        """``match_hospital`` in its two steps, with the stays written and dealt by person in between."""
        return O.match_by_person(self.hosp_stays, self.icd_lookup, self.icd_dict, self.hosp_hot, self.hosp_codes)

    @cached_property
    def hosp_outcomes(self) -> DataFrame:
        return O.rank_events(self.hosp_matched, O.HOSP_RANK_ORDER, self.hosp_hot)

    def single_concept_gp(self, concept: str) -> DataFrame:
        return O.single_concept_primary_care(self.outcome_sources()["gp"], self.read_lookup, concept, self.cohort, self._cut)

    def single_concept_hospital(self, concept: str) -> DataFrame:
        """Over all spells with an admission in the window, of cohort members or not."""
        fx, w = self.fx, self.w
        spells = fx.hospital_spell.where((F.col("admis_dt") >= F.lit(w.events_from)) & (F.col("admis_dt") < F.lit(w.end)))
        return O.single_concept_hospital(
            fx.hospital_diag, self.outcome_sources()["episodes"], spells, self.icd_lookup, self.icd_dict, concept,
            self._cut,
        )

    # ---- report -------------------------------------------------------------
    @cached_property
    def gp_aged(self) -> DataFrame:
        return R.age_at_event(self.gp_outcomes, self.cohort, "event_dt")

    @cached_property
    def hosp_aged(self) -> DataFrame:
        return R.age_at_event(self.hosp_outcomes, self.cohort, "admis_dt")

    @cached_property
    def gp_numbered(self) -> DataFrame:
        """``gp_aged`` placed and numbered, of cohort members, with ages and places taken by day."""
        rows = self.gp_matched
        facts = R.facts_of_days(rows, self.cohort, self.history, "event_dt", members=True)
        facts = dealt(self._cut(facts, "gp_facts"), "person_id", self.gp_hot, like=rows)
        placed = dealt(rows, "person_id", self.gp_hot).join(facts, ["person_id", "event_dt"])
        rows = placed.select("person_id", *[c for c in rows.columns if c != "person_id"], "facts")
        return R.enrich_by_day(rows, O.GP_RANK_ORDER, R.GP_ORDER, self.gp_hot)

    @cached_property
    def hosp_numbered(self) -> DataFrame:
        """``hosp_aged`` placed and numbered, with ages and places taken by day."""
        facts = self._cut(R.facts_of_days(self.hosp_stays, self.cohort, self.history, "admis_dt"), "hosp_facts")
        rows = O.match_by_person(self.hosp_stays, self.icd_lookup, self.icd_dict, self.hosp_hot, self.hosp_codes, facts)
        return R.enrich_by_day(rows, O.HOSP_RANK_ORDER, R.HOSP_ORDER, self.hosp_hot)

    @cached_property
    def gp_enriched(self) -> DataFrame:
        return self._cut(self.gp_numbered, "gp_enriched")

    @cached_property
    def hosp_enriched(self) -> DataFrame:
        return self._cut(self.hosp_numbered, "hosp_enriched")

    @cached_property
    def reported(self) -> tuple[DataFrame, DataFrame]:
        """The enriched GP and hospital events, all rows, with the columns that
        the report reads: from the enriched stages where they are written, else
        written with these columns alone."""
        return self._report_rows("gp", R.GP_REPORTED), self._report_rows("hosp", R.HOSP_REPORTED)

    def _report_rows(self, source: str, columns: list[str]) -> DataFrame:
        if f"{source}_enriched" in self.__dict__:
            return getattr(self, f"{source}_enriched").select(*columns)
        return self._cut(getattr(self, f"{source}_numbered").select(*columns), f"{source}_reported")
