"""Events matched to concept codelists.

One pass over the event table matches all concepts at once: the validated
lookup (thousands of rows) is broadcast after a size check, and ``concept``
travels as a column. A code that belongs to several concepts yields one row
per concept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.operators.ranking import hot_groups, rank_within
from cohortwise.plans.sizing import dealt, small_side

Write = Callable[[DataFrame], DataFrame]  # keeps rows as a table and returns it

GP_COLUMNS = ["concept", "person_id", "practice_id", "local_id", "event_cd", "event_cd_desc", "event_val", "event_dt"]
HOSP_COLUMNS = [
    "concept", "person_id", "provider_cd", "spell_id", "admis_dt", "disch_dt", "epi_str_dt", "epi_end_dt",
    "epi_num", "diag_num", "diag_cd", "diag_cd_123", "diag_cd_123_desc", "diag_cd_1234", "diag_cd_1234_desc",
]


GP_RANK_ORDER = ["event_dt"]
HOSP_RANK_ORDER = ["admis_dt", "disch_dt", "epi_str_dt", "epi_end_dt"]


def match_primary_care(events: DataFrame, read_lookup: DataFrame) -> DataFrame:
    """Distinct GP events whose code is a non-sensitive code of a concept."""
    lookup = read_lookup.where(F.col("sensitive") == 0).select(
        F.col("code").alias("event_cd"), F.col("description").alias("event_cd_desc"), "concept"
    )
    return events.join(small_side(lookup), "event_cd").select(*GP_COLUMNS).distinct()


def rank_events(matched: DataFrame, order: list[str], hot: DataFrame | None = None) -> DataFrame:
    """Add ``event_seq``: rank per (concept, person) by ``order`` (ties share a
    rank, gaps follow). ``hot``: the persons with a large share of the rows,
    where they are known. The person leads the keys, so rows that lie by person
    are neither dealt nor, where a later step goes by person, sorted again."""
    return rank_within(matched, ["person_id", "concept"], order, "event_seq", hot=hot)


def primary_care_outcomes(events: DataFrame, read_lookup: DataFrame, write: Write | None = None) -> DataFrame:
    """GP events whose code is a non-sensitive code of a concept, distinct,
    ranked per (concept, person) by event date (ties share a rank). ``write``
    keeps the matched events as a table, which hot persons are counted in."""
    matched = match_primary_care(events, read_lookup)
    if write is None:
        return rank_events(matched, GP_RANK_ORDER)
    matched = write(matched)
    hot = write(hot_groups(matched, ["person_id"]))
    return rank_events(dealt(matched, "person_id", hot), GP_RANK_ORDER, hot)


def hospital_outcomes(
    diag: DataFrame, episodes: DataFrame, spells: DataFrame, icd_lookup: DataFrame, icd_dict: DataFrame, write: Write | None = None
) -> DataFrame:
    """Hospital diagnoses matched to concepts (see ``match_hospital``), ranked
    per (concept, person) by admission, discharge, episode start and end.
    ``write`` keeps the diagnoses with their stays as a table."""
    if write is None:
        return rank_events(match_hospital(diag, episodes, spells, icd_lookup, icd_dict), HOSP_RANK_ORDER)
    stays = write(diagnosis_stays(diag, episodes, spells, icd_lookup))
    hot = write(hot_groups(stays, ["person_id"]))
    return rank_events(match_by_person(stays, icd_lookup, icd_dict, hot), HOSP_RANK_ORDER, hot)


#: A diagnosis with its stay: the hospital columns that no codelist supplies.
STAY_COLUMNS = [c for c in HOSP_COLUMNS if c not in ("concept", "diag_cd_123_desc", "diag_cd_1234_desc")]
_CODES = ["diag_cd_123", "diag_cd_1234"]


def match_hospital(
    diag: DataFrame, episodes: DataFrame, spells: DataFrame, icd_lookup: DataFrame, icd_dict: DataFrame
) -> DataFrame:
    """Diagnoses matched on their 3-character code to 3-character lookup codes
    (4-character text from the dictionary) or on their 4-character code to
    4-character lookup codes, with episode and spell dates; distinct.

    Two steps: ``diagnosis_stays`` takes a row a diagnosis through the joins,
    ``match_stays`` then gives it its concepts. A study writes the table
    between them."""
    stays = diagnosis_stays(diag, episodes, spells, icd_lookup)
    return match_stays(stays, icd_lookup, icd_dict, codes=diag.select(*_CODES).distinct())


def _lookup_keys(icd_lookup: DataFrame) -> DataFrame:
    return icd_lookup.where((F.col("sensitive") == 0) & F.col("code_length").isin(3, 4))


def diagnosis_stays(diag: DataFrame, episodes: DataFrame, spells: DataFrame, icd_lookup: DataFrame) -> DataFrame:
    """The distinct diagnoses with a code of any concept, with episode and
    spell dates. Both lookup lengths filter the diagnoses before the joins."""
    found, known = diag, F.lit(False)
    for length, column in ((3, "diag_cd_123"), (4, "diag_cd_1234")):
        codes = _lookup_keys(icd_lookup).where(F.col("code_length") == length).select(F.col("code").alias(f"_key{length}")).distinct()
        found = found.join(small_side(codes), F.col(column) == F.col(f"_key{length}"), "left")
        known = known | F.col(f"_key{length}").isNotNull()
    dcols = ["provider_cd", "spell_id", "epi_num", "diag_num", "diag_cd", *_CODES]
    epi = episodes.select("provider_cd", "spell_id", "epi_num", "epi_str_dt", "epi_end_dt")
    spl = spells.select("provider_cd", "spell_id", "person_id", "admis_dt", "disch_dt")
    return (
        found.where(known).select(*dcols)
        .join(epi, ["provider_cd", "spell_id", "epi_num"])
        .join(spl, ["provider_cd", "spell_id"])
        .select(*STAY_COLUMNS)
        .distinct()
    )


def match_stays(stays: DataFrame, icd_lookup: DataFrame, icd_dict: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """The concepts of distinct ``stays``, one row each.

    What a diagnosis means depends on its two codes alone. So the distinct pairs
    of codes meet the lookup and the dictionary, their meanings are made
    distinct there, and a broadcast join hands them to the stays: the rows of
    all concepts are never shuffled, and stay with their person where the
    stays lie by person. ``codes``: the pairs, if not taken from ``stays``."""
    lookup = _lookup_keys(icd_lookup).select(
        F.col("code_length").alias("_length"), F.col("code").alias("_key"), "concept",
        F.col("title3").alias("diag_cd_123_desc"), F.col("description").alias("_text"),
    )
    titles4 = icd_dict.select(F.col("alt_code").alias("_title_of"), F.col("description").alias("_title"))
    keys = F.array(
        F.struct(F.lit(3).alias("n"), F.col("diag_cd_123").alias("key")), F.struct(F.lit(4).alias("n"), F.col("diag_cd_1234").alias("key"))
    )
    short = F.col("_length") == 3
    pairs = codes if codes is not None else stays.select(*_CODES).distinct()
    meanings = (
        pairs.withColumn("_k", F.explode(keys))
        .withColumns({"_length": F.col("_k.n"), "_key": F.col("_k.key")})
        .join(lookup, ["_length", "_key"])
        .withColumn("_title_of", F.when(short, F.col("diag_cd_1234")))
        .join(titles4, "_title_of", "left")
        .select(
            F.col("diag_cd_123").alias("_c3"), F.col("diag_cd_1234").alias("_c4"), "concept", "diag_cd_123_desc",
            F.when(short, F.col("_title")).otherwise(F.col("_text")).alias("diag_cd_1234_desc"),
        )
        .distinct()
    )
    same = F.col("diag_cd_123").eqNullSafe(F.col("_c3")) & F.col("diag_cd_1234").eqNullSafe(F.col("_c4"))
    more = [c for c in stays.columns if c not in STAY_COLUMNS]
    return stays.join(small_side(meanings), same).select(*HOSP_COLUMNS, *more)


def stay_codes(stays: DataFrame) -> DataFrame:
    """The distinct pairs of codes of stays."""
    return stays.select(*_CODES).distinct()


def match_by_person(
    stays: DataFrame, icd_lookup: DataFrame, icd_dict: DataFrame, hot: DataFrame | None = None,
    codes: DataFrame | None = None, facts: DataFrame | None = None,
) -> DataFrame:
    """``match_stays`` of a written table of stays, which it deals by person first if none of them is hot.

    ``codes``: their pairs of codes, where written. ``facts``, a written table,
    join the stays of their person and admission day before they are matched."""
    rows = dealt(stays, "person_id", hot)
    if facts is not None:
        rows = rows.join(dealt(facts, "person_id", hot, like=stays), ["person_id", "admis_dt"])
    return match_stays(rows, icd_lookup, icd_dict, stay_codes(stays) if codes is None else codes)


def single_concept_primary_care(
    events: DataFrame, read_lookup: DataFrame, concept: str, cohort: DataFrame | None = None, write: Write | None = None
) -> DataFrame:
    """Primary care outcomes of one concept, optionally of cohort members only.

    The lookup is cut to the concept before any event is matched, and ranks
    count inside the restricted set."""
    if cohort is not None:
        events = events.join(cohort.select("person_id"), "person_id", "left_semi")
    return primary_care_outcomes(events, read_lookup.where(F.col("concept") == concept), write)


def single_concept_hospital(
    diag: DataFrame, episodes: DataFrame, spells: DataFrame, icd_lookup: DataFrame, icd_dict: DataFrame, concept: str,
    write: Write | None = None,
) -> DataFrame:
    """Hospital outcomes of one concept over all given spells; the cohort is
    not asked, as in the study."""
    return hospital_outcomes(diag, episodes, spells, icd_lookup.where(F.col("concept") == concept), icd_dict, write)


def outcome_coverage(lookups: dict[str, DataFrame], outcomes: dict[str, DataFrame]) -> DataFrame:
    """Per vocabulary and concept: has a lookup, has outcome rows, and the
    number of lookup codes and outcome rows."""
    parts = []
    for vocab in lookups:
        lk = lookups[vocab].groupBy("concept").agg(F.count(F.lit(1)).alias("n_codes"))
        oc = outcomes[vocab].groupBy("concept").agg(F.count(F.lit(1)).alias("n_rows"))
        parts.append(
            lk.join(oc, "concept", "full_outer").select(
                F.lit(vocab).alias("vocab"),
                "concept",
                F.when(F.col("n_codes").isNotNull(), 1).otherwise(0).alias("has_lookup"),
                F.when(F.col("n_rows").isNotNull(), 1).otherwise(0).alias("has_outcomes"),
                F.coalesce("n_codes", F.lit(0)).alias("n_codes"),
                F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
