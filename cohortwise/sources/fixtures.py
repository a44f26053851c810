"""Study entities derived from the driver's Parquet tables.

Every entity (residence spells, registries, hospital records, codelists, ...)
is a projection of the TPC-H-like tables. The column expressions are plain SQL
that Spark and DuckDB evaluate identically, so they are declared once here and
used twice: ``Fixtures`` builds Spark DataFrames with ``selectExpr``;
``fixture_cte`` renders the same entity as a SQL CTE for the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.sources.tables import ParquetTables

# Shared code shapes (fixed values of the fixture specification).
# One code per key; keys 2n and 2n + 1 differ only in the letter's case.
_READ_CODE = (
    "concat(CASE WHEN {k} % 2 = 0 THEN chr(CAST(65 + CAST(floor({k} / 2) AS BIGINT) % 26 AS INT)) "
    "ELSE lower(chr(CAST(65 + CAST(floor({k} / 2) AS BIGINT) % 26 AS INT))) END, "
    "CAST(CAST(floor({k} / 2) AS BIGINT) AS STRING), '.')"
)
_PROVIDER = "lpad(CAST(o_orderkey % 20 AS STRING), 3, '0')"
_ICD3 = "concat(chr(CAST(65 + l_partkey % 6 AS INT)), lpad(CAST(l_partkey % 40 AS STRING), 2, '0'))"


@dataclass(frozen=True)
class FixtureDef:
    columns: dict[str, str]
    source_sql: str  # FROM clause (with optional WHERE) for the SQL oracle
    build_source: Callable[[ParquetTables], DataFrame]  # same rows in Spark


def _orders_customer(t: ParquetTables) -> DataFrame:
    return t["orders"].join(t["customer"], F.col("c_custkey") == F.col("o_custkey"))


def _lineitem_orders(t: ParquetTables) -> DataFrame:
    return t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))


def _versions(t: ParquetTables) -> DataFrame:
    # Three literal versions per part row, expanded in place (no cross join).
    v = F.explode(F.array(F.lit("2_2_3"), F.lit("2_2_9"), F.lit("2_2_10"))).alias("version")
    return t["part"].select("*", v).where(
        "p_size <= 25 AND NOT (p_type = 'PROMO' AND version = '2_2_10') "
        "AND NOT (p_type = 'LARGE' AND version <> '2_2_10') "
        "AND NOT (p_type <> 'SMALL' AND version = '2_2_10' AND p_partkey % 9 = 0)"
    )


def _icd_dict_source(t: ParquetTables) -> DataFrame:
    # Distinct (a, b) first, then eleven digits per pair: same set as the
    # distinct of the cross product, with the shuffle on the small side.
    ab = t["lineitem"].selectExpr("l_partkey % 6 AS a", "l_partkey % 40 AS b").distinct()
    return ab.select("a", "b", F.explode(F.sequence(F.lit(-1), F.lit(9))).alias("d"))


FIXTURES: dict[str, FixtureDef] = {
    "residence": FixtureDef(
        {
            "person_id": "o_custkey",
            "birth_dt": "CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE DATE '1885-01-01' + "
            "CAST((c_custkey * 7919) % 42000 + CASE WHEN o_orderkey % 13 = 0 THEN 7 ELSE 0 END AS INT) END",
            "death_dt": "CASE WHEN c_custkey % 5 = 0 THEN DATE '1996-06-01' + CAST((c_custkey * 131) % 2200 AS INT) END",
            "sex_cd": "CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN '9' "
            "ELSE CAST(1 + c_custkey % 2 AS STRING) END",
            "area_cd": "CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE concat('W', lpad(CAST(o_orderkey % 50 AS STRING), 2, '0')) END",
            "practice_id": "CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE o_orderkey % 60 END",
            "active_from": "CAST(o_orderdate AS DATE)",
            "active_to": "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + "
            "CAST((o_orderkey * 37) % 400 AS INT) END",
        },
        "orders o JOIN customer c ON c_custkey = o_custkey",
        _orders_customer,
    ),
    "births": FixtureDef(
        {
            "person_id": "c_custkey",
            "birth_dt": "DATE '1885-01-01' + CAST((c_custkey * 7919) % 42000 + "
            "CASE WHEN c_custkey % 11 = 0 THEN 14 ELSE 0 END AS INT)",
            "neonate_sex_cd": "CAST(1 + c_custkey % 2 AS STRING)",
            "birth_valid": "CASE WHEN c_custkey % 2 = 0 THEN 'Valid' ELSE 'Invalid' END",
        },
        "customer WHERE c_custkey % 3 <> 0",
        lambda t: t["customer"].where("c_custkey % 3 <> 0"),
    ),
    "deaths": FixtureDef(
        {
            "person_id": "c_custkey",
            "death_dt": "DATE '1996-06-01' + CAST((c_custkey * 131) % 2200 + "
            "CASE WHEN c_custkey % 35 = 0 THEN 3 ELSE 0 END AS INT)",
            "death_valid": "CASE WHEN c_custkey % 4 = 0 THEN 'Valid' ELSE 'Invalid' END",
        },
        "customer WHERE c_custkey % 10 = 0 OR c_custkey % 33 = 0",
        lambda t: t["customer"].where("c_custkey % 10 = 0 OR c_custkey % 33 = 0"),
    ),
    "ethnicity": FixtureDef(
        {
            "person_id": "c_custkey",
            "ethn_ner_code": "CAST(c_nationkey % 6 AS INT)",
            "ethn_ner_desc": "concat('group ', CAST(c_nationkey % 6 AS STRING))",
            "ethn_ons_code": "CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_nationkey % 5 AS INT) END",
            "ethn_ons_desc": "CASE WHEN c_custkey % 11 <> 0 THEN concat('census ', CAST(c_nationkey % 5 AS STRING)) END",
        },
        "customer WHERE c_custkey % 8 <> 0",
        lambda t: t["customer"].where("c_custkey % 8 <> 0"),
    ),
    "areas": FixtureDef(
        {
            "area_cd": "concat('W', lpad(CAST(p_size - 1 AS STRING), 2, '0'))",
            "dep1_quintile": "CAST(1 + p_size % 5 AS INT)",
            "dep2_quintile": "CAST(1 + (p_size * 3) % 5 AS INT)",
            "dep_score": "CAST(p_size * 1.25 AS DECIMAL(15,9))",
            "area_desc": "concat('Area ', CAST(p_size AS STRING))",
            "area_ons_desc": "concat('District ', lpad(CAST(p_size - 1 AS STRING), 3, '0'))",
            "area_name": "concat('Place ', CAST(p_size % 12 AS STRING))",
            "local_address": "CAST(p_size % 2 AS INT)",
            "dep0_score": "CAST(p_size * 0.75 AS DECIMAL(15,9))",
            "dep0_rank": "CAST(51 - p_size AS INT)",
            "dep0_quintile": "CAST(1 + floor((50 - p_size) / 10.0) AS INT)",
            "dep0_quintile_desc": "concat(CAST(CAST(1 + floor((50 - p_size) / 10.0) AS INT) AS STRING), '. of 5')",
            "dep0_decile": "CAST(1 + floor(((51 - p_size) - 1) * 10 / 50.0) AS INT)",
            "dep0_decile_desc": "concat(CAST(CAST(1 + floor(((51 - p_size) - 1) * 10 / 50.0) AS INT) AS STRING), '. of 10')",
            "dep0_quartile": "CAST(1 + floor(((51 - p_size) - 1) * 4 / 50.0) AS INT)",
            "dep0_quartile_desc": "concat(CAST(CAST(1 + floor(((51 - p_size) - 1) * 4 / 50.0) AS INT) AS STRING), '. of 4')",
            "dep1_rank": "CAST(p_size AS INT)",
            "dep1_quintile_desc": "concat(CAST(1 + p_size % 5 AS STRING), '. of 5')",
            "dep1_decile": "CAST(1 + floor((p_size - 1) * 10 / 50.0) AS INT)",
            "dep1_decile_desc": "concat(CAST(CAST(1 + floor((p_size - 1) * 10 / 50.0) AS INT) AS STRING), '. of 10')",
            "dep1_quartile": "CAST(1 + floor((p_size - 1) * 4 / 50.0) AS INT)",
            "dep1_quartile_desc": "concat(CAST(CAST(1 + floor((p_size - 1) * 4 / 50.0) AS INT) AS STRING), '. of 4')",
            "dep2_quintile_desc": "concat(CAST(1 + (p_size * 3) % 5 AS STRING), '. of 5')",
        },
        "(SELECT DISTINCT p_size FROM part) p",
        lambda t: t["part"].select("p_size").distinct(),
    ),
    "gp_event": FixtureDef(
        {
            "person_id": "o_custkey",
            "practice_id": "CASE WHEN l_suppkey % 37 = 0 THEN NULL ELSE l_suppkey END",
            "local_id": "l_orderkey",
            "event_cd": _READ_CODE.format(k="l_partkey"),
            "event_val": "CAST(l_quantity AS DECIMAL(31,8))",
            "event_dt": "CAST(l_shipdate AS DATE)",
        },
        "lineitem l JOIN orders o ON l_orderkey = o_orderkey",
        _lineitem_orders,
    ),
    "hospital_spell": FixtureDef(
        {
            "person_id": "o_custkey",
            "provider_cd": _PROVIDER,
            "spell_id": "o_orderkey",
            "admis_dt": "CAST(o_orderdate AS DATE)",
            "disch_dt": "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 15 AS INT)",
        },
        "orders o",
        lambda t: t["orders"],
    ),
    "hospital_episode": FixtureDef(
        {
            "provider_cd": _PROVIDER,
            "spell_id": "o_orderkey",
            "epi_num": "lpad(CAST(l_linenumber AS STRING), 2, '0')",
            "epi_str_dt": "CAST(o_orderdate AS DATE) + CAST(l_linenumber - 1 AS INT)",
            "epi_end_dt": "CAST(o_orderdate AS DATE) + CAST(l_linenumber AS INT)",
        },
        "(SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) l JOIN orders o ON l_orderkey = o_orderkey",
        lambda t: t["lineitem"]
        .select("l_orderkey", "l_linenumber")
        .distinct()
        .join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")),
    ),
    "hospital_diag": FixtureDef(
        {
            "provider_cd": _PROVIDER,
            "spell_id": "o_orderkey",
            "epi_num": "lpad(CAST(l_linenumber AS STRING), 2, '0')",
            "diag_num": "CAST(1 + l_partkey % 14 AS INT)",
            "diag_cd_123": _ICD3,
            "diag_cd_1234": f"concat({_ICD3}, CAST(l_suppkey % 10 AS STRING))",
            "diag_cd": f"concat({_ICD3}, CAST(l_suppkey % 10 AS STRING))",
        },
        "lineitem l JOIN orders o ON l_orderkey = o_orderkey",
        _lineitem_orders,
    ),
    "outpatient": FixtureDef(
        {
            "person_id": "o_custkey",
            "provider_cd": _PROVIDER,
            "case_id": "o_orderkey % 5000",
            "attend_dt": "CAST(o_orderdate AS DATE)",
            "att_id": "o_orderkey",
            "ref_dt": "CAST(o_orderdate AS DATE) - 10",
        },
        "orders o WHERE o_orderstatus = 'O'",
        lambda t: t["orders"].where("o_orderstatus = 'O'"),
    ),
    "outpatient_diag": FixtureDef(
        {
            "provider_cd": _PROVIDER,
            "case_id": "o_orderkey % 5000",
            "attend_dt": "CAST(o_orderdate AS DATE)",
            "att_id": "o_orderkey",
            "diag_cd": "concat('X', lpad(CAST(l_partkey % 100 AS STRING), 2, '0'))",
        },
        "lineitem l JOIN orders o ON l_orderkey = o_orderkey WHERE o_orderkey % 2 = 0",
        lambda t: _lineitem_orders(t).where("o_orderkey % 2 = 0"),
    ),
    "outpatient_oper": FixtureDef(
        {
            "provider_cd": _PROVIDER,
            "case_id": "o_orderkey % 5000",
            "attend_dt": "CAST(o_orderdate AS DATE)",
            "att_id": "o_orderkey",
        },
        "lineitem l JOIN orders o ON l_orderkey = o_orderkey WHERE o_orderkey % 2 = 1",
        lambda t: _lineitem_orders(t).where("o_orderkey % 2 = 1"),
    ),
    "emergency": FixtureDef(
        {"person_id": "user_id", "event_dt": "CAST(ts AS DATE) - 9000"},
        "events",
        lambda t: t["events"],
    ),
    "pathology": FixtureDef(
        {"person_id": "user_id", "specimen_dt": "CAST(ts AS DATE) - 8500"},
        "events WHERE event_type = 'error'",
        lambda t: t["events"].where("event_type = 'error'"),
    ),
    "hospital_oper": FixtureDef(
        {"provider_cd": _PROVIDER, "spell_id": "o_orderkey", "oper_dt": "CAST(l_shipdate AS DATE)"},
        "lineitem l JOIN orders o ON l_orderkey = o_orderkey WHERE l_quantity > 25",
        lambda t: _lineitem_orders(t).where("l_quantity > 25"),
    ),
    "gp_registration": FixtureDef(
        {"person_id": "o_custkey", "start_date": "CAST(o_orderdate AS DATE)"},
        "orders o WHERE o_orderkey % 3 <> 0",
        lambda t: t["orders"].where("o_orderkey % 3 <> 0"),
    ),
    "admissions": FixtureDef(
        {
            "person_id": "o_custkey",
            "start_date": "CAST(o_orderdate AS DATE)",
            "end_date": "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 15 AS INT)",
        },
        "orders o WHERE o_orderpriority = '1-URGENT'",
        lambda t: t["orders"].where("o_orderpriority = '1-URGENT'"),
    ),
    "codelist_read": FixtureDef(
        {
            "concept": "p_type",
            "code": _READ_CODE.format(k="p_partkey"),
            "concept_type": "'condition'",
            "sensitive": "CASE WHEN p_size % 7 = 0 THEN 1 ELSE 0 END",
        },
        "part WHERE p_size <= 25",
        lambda t: t["part"].where("p_size <= 25"),
    ),
    "codelist_versions": FixtureDef(
        {
            "concept": "p_type",
            "version": "version",
            "code": _READ_CODE.format(k="p_partkey"),
            "concept_type": "'condition'",
        },
        "part CROSS JOIN (VALUES ('2_2_3'), ('2_2_9'), ('2_2_10')) v(version) WHERE p_size <= 25 "
        "AND NOT (p_type = 'PROMO' AND version = '2_2_10') AND NOT (p_type = 'LARGE' AND version <> '2_2_10') "
        "AND NOT (p_type <> 'SMALL' AND version = '2_2_10' AND p_partkey % 9 = 0)",
        _versions,
    ),
    "codelist_medication": FixtureDef(
        {
            "concept": "'ALL_MEDICATIONS'",
            "code": _READ_CODE.format(k="p_partkey"),
            "alt_code": "concat(lower(chr(CAST(65 + p_partkey % 26 AS INT))), lpad(CAST(p_partkey % 1000 AS STRING), 3, '0'), 'z')",
            "drug_category": "p_brand",
            "concept_type": "'medication'",
        },
        "part WHERE p_size > 40",
        lambda t: t["part"].where("p_size > 40"),
    ),
    "sensitive_codes": FixtureDef(
        {"code": _READ_CODE.format(k="p_partkey")},
        "part WHERE p_partkey % 17 = 0",
        lambda t: t["part"].where("p_partkey % 17 = 0"),
    ),
    "read_dict": FixtureDef(
        {
            "read_code": _READ_CODE.format(k="p_partkey"),
            "term_198": "CASE WHEN p_partkey % 3 = 0 THEN concat(p_name, ' long') END",
            "term_60": "CASE WHEN p_partkey % 3 < 2 THEN concat(p_name, ' mid') END",
            "term_30": "p_name",
            "effective_to": "CASE WHEN p_partkey % 19 = 0 THEN DATE '1999-12-31' END",
        },
        "part",
        lambda t: t["part"],
    ),
    "codelist_icd10": FixtureDef(
        {
            "concept": "p_type",
            "code": "concat(chr(CAST(65 + p_partkey % 6 AS INT)), lpad(CAST(p_partkey % 40 AS STRING), 2, '0'), "
            "CASE WHEN p_partkey % 7 < 2 THEN '' ELSE CAST(p_size % 10 AS STRING) END)",
            "concept_type": "'condition'",
            "sensitive": "CASE WHEN p_size % 7 = 0 THEN 1 ELSE 0 END",
        },
        "part",
        lambda t: t["part"],
    ),
    "sensitive_icd10": FixtureDef(
        {"code": "concat(chr(CAST(65 + p_partkey % 6 AS INT)), lpad(CAST(p_partkey % 40 AS STRING), 2, '0'), CAST(p_size % 10 AS STRING))"},
        "part WHERE p_partkey % 120 = 5",
        lambda t: t["part"].where("p_partkey % 120 = 5"),
    ),
    "icd10_dict": FixtureDef(
        {
            "code": "concat(chr(CAST(65 + a AS INT)), lpad(CAST(b AS STRING), 2, '0'), "
            "CASE WHEN d < 0 THEN '' ELSE concat('.', CAST(d AS STRING)) END)",
            "alt_code": "concat(chr(CAST(65 + a AS INT)), lpad(CAST(b AS STRING), 2, '0'), "
            "CASE WHEN d < 0 THEN '' ELSE CAST(d AS STRING) END)",
            "description": "concat('title ', CAST(a AS STRING), '/', CAST(b AS STRING), '/', CAST(d AS STRING))",
            "effective_to": "CASE WHEN d = 7 THEN DATE '1999-12-31' END",
        },
        "(SELECT DISTINCT l_partkey % 6 AS a, l_partkey % 40 AS b, d FROM lineitem "
        "CROSS JOIN (VALUES (-1),(0),(1),(2),(3),(4),(5),(6),(7),(8),(9)) v(d)) x",
        _icd_dict_source,
    ),
}


def fixture_cte(name: str) -> str:
    """``name AS (SELECT ... FROM ...)`` for the SQL oracle."""
    fx = FIXTURES[name]
    cols = ",\n    ".join(f"{expr} AS {col}" for col, expr in fx.columns.items())
    return f"{name} AS (\n  SELECT\n    {cols}\n  FROM {fx.source_sql}\n)"


class Fixtures:
    """Lazily built study entities over one directory of Parquet tables."""

    def __init__(self, tables: ParquetTables):
        self.tables = tables
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            fx = FIXTURES[name]
            src = fx.build_source(self.tables)
            self._frames[name] = src.selectExpr(*[f"{e} AS {c}" for c, e in fx.columns.items()])
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in FIXTURES:
            raise AttributeError(name)
        return self[name]
