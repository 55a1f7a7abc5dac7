"""Code lookups and work lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.checks import expected
from cohortloom.checks.inputs import Inputs
from cohortloom.checks.registry import SETTINGS, check
from cohortloom.checks.sql import cases, lower
from cohortloom.checks.table_sql import mapped_ids, own_ids, resolved_ids
from cohortloom.operators import vocabulary, worklist
from cohortloom.plans import entities, loads
from cohortloom.plans.runs import map_rows, spec_for

_CODES = "SELECT DISTINCT code FROM observations WHERE code IS NOT NULL"


def _codes(x: Inputs):
    return vocabulary.used_codes(x["observations"], "code")


@check(
    "concept_standard",
    f"SELECT * FROM direct_ids WHERE concept_code IN ({_CODES})",
)
def concept_standard(x: Inputs):
    return vocabulary.standard_concepts(_codes(x), x["concept"])


@check(
    "concept_maps_to",
    f"""SELECT * FROM ({mapped_ids(expected.OBSERVATION_CODES)})
    WHERE concept_code IN ({_CODES})""",
)
def concept_maps_to(x: Inputs):
    return vocabulary.mapped_concepts(
        _codes(x), x["concept"], x["concept_relationship"], loads.OBSERVATION_CODES
    )


@check(
    "missing_codes",
    f"""SELECT code AS concept_code FROM ({_CODES})
    WHERE code NOT IN (SELECT concept_code FROM direct_ids)""",
)
def missing_codes(x: Inputs):
    codes = _codes(x)
    return vocabulary.missing_codes(codes, vocabulary.standard_concepts(codes, x["concept"]))


@check(
    "concept_resolve",
    f"""SELECT encounter, code, coalesce(concept_id, 0) AS drug_concept_id FROM medications m
    LEFT JOIN ({resolved_ids(expected.DRUG_CODES)}) r ON m.code = r.concept_code""",
)
def concept_resolve(x: Inputs):
    drugs = x["medications"].select("encounter", "code")
    found = vocabulary.resolve_codes(
        vocabulary.used_codes(drugs, "code"),
        x["concept"],
        x["concept_relationship"],
        loads.DRUG_CODES,
    )
    return vocabulary.apply_codes(drugs, "code", found, {"drug_concept_id": "concept_id"})


@check(
    "concept_source",
    f"""SELECT encounter, code, coalesce(concept_id, 0) AS source_concept_id FROM medications m
    LEFT JOIN ({own_ids(expected.DRUG_SOURCES)}) r ON m.code = r.concept_code""",
)
def concept_source(x: Inputs):
    drugs = x["medications"].select("encounter", "code")
    codes = vocabulary.used_codes(drugs, "code")
    found = vocabulary.source_concepts(codes, x["concept"], loads.DRUG_SOURCES)
    return vocabulary.apply_codes(drugs, "code", found, {"source_concept_id": "concept_id"})


# --- work lists --------------------------------------------------------------------------

_DRUG_IDS = "CASE WHEN l_partkey % 5 = 0 THEN 0 ELSE l_partkey END"
_DRUG_SOURCES = "CASE WHEN l_tax = 0.03 THEN NULL ELSE l_partkey % 7 END"
_DRUG_TYPES = "CASE WHEN l_quantity > 45 THEN 0 ELSE 32817 END"
_DRUGS = f"""SELECT CAST({_DRUG_IDS} AS BIGINT) AS drug_concept_id,
    CAST({_DRUG_TYPES} AS BIGINT) AS drug_type_concept_id,
    CAST({_DRUG_SOURCES} AS BIGINT) AS drug_source_concept_id,
    CASE WHEN l_tax = 0.04 THEN NULL ELSE 'Item ' || l_returnflag END AS drug_source_value
    FROM {{0}}"""


def _reported(rows: list[str], slots: list[tuple[str, str]]) -> str:
    union = " UNION ALL ".join(rows)
    names = ", ".join(f"'{t}'" for t, _ in slots)
    fields = ", ".join(f"'{c}'" for _, c in slots)
    return f"""SELECT CAST(0 AS BIGINT) AS concept_id, source_value, source_id,
        [{names}][min(slot)] AS table_name, [{fields}][min(slot)] AS field_type,
        count(*) AS frequency
    FROM ({union}) GROUP BY source_value, source_id"""


_PERSON_SLOTS = [
    ("person", f"{kind}_concept_id") for kind in ("gender", "race", "ethnicity")
]
_DRUG_SLOTS = [("drug_exposure", "drug_concept_id"), ("drug_exposure", "drug_type_concept_id")]
_UNMAPPED = [
    f"""SELECT {kind}_source_value AS source_value, CAST(0 AS BIGINT) AS source_id, {i} AS slot
    FROM m_person WHERE {kind}_concept_id = 0"""
    for i, kind in enumerate(("gender", "race", "ethnicity"), 1)
] + [
    f"""SELECT drug_source_value, coalesce(drug_source_concept_id, 0), {i}
    FROM ({_DRUGS.format("lineitem")}) WHERE {column} = 0"""
    for i, (_, column) in enumerate(_DRUG_SLOTS, 4)
]


@check("unmapped_codes", _reported(_UNMAPPED, _PERSON_SLOTS + _DRUG_SLOTS))
def unmapped_codes(x: Inputs):
    drugs = x.spark.sql(_DRUGS.format("{lineitem}"), lineitem=x.table("lineitem"))
    people = map_rows(spec_for("person"), x["patients"], SETTINGS)
    return worklist.by_frequency(
        worklist.unmapped_codes({"person": people, "drug_exposure": drugs})
    )


_VISITS = f"""SELECT id AS source_value, CAST(0 AS BIGINT) AS source_id, 1 AS slot
    FROM encounters WHERE {cases("encounterclass", expected.VISIT_CLASS, "0")} = 0
    UNION ALL SELECT '', CAST(0 AS BIGINT), 2 FROM observations
    WHERE {cases(lower("category"), expected.OBSERVATION_TYPE, "'0'")} = '0'"""


@check(
    "unmapped_fields",
    _reported(
        [_VISITS],
        [("visit_occurrence", "visit_concept_id"), ("observation", "observation_concept_id")],
    ),
)
def unmapped_fields(x: Inputs):
    """Tables that lack source columns: '' and 0 stand in, unknown tables are skipped."""
    from cohortloom.functions.text import lookup, lookup_or, normalize_lower

    visits = x["encounters"].select(
        F.col("id").alias("visit_source_value"),
        lookup_or(F.col("encounterclass"), entities.VISIT_CLASS, 0).alias("visit_concept_id"),
    )
    known = lookup(normalize_lower(F.col("category")), entities.OBSERVATION_TYPE)
    observed = x["observations"].select(
        F.when(known.isNull(), 0).otherwise(1).alias("observation_concept_id")
    )
    tables = {"visit_occurrence": visits, "payer": visits, "observation": observed}
    return worklist.unmapped_codes(tables)


@check(
    "stcm_new_rows",
    """SELECT source_code, source_concept_id, lower(source_code_description)
        AS source_code_description, target_concept_id
    FROM reviewed_map r WHERE NOT EXISTS (SELECT 1 FROM source_to_concept_map m
        WHERE m.source_concept_id = r.source_concept_id
        AND lower(m.source_code_description) = lower(r.source_code_description))
    QUALIFY row_number() OVER (PARTITION BY source_concept_id, lower(source_code_description)
        ORDER BY target_concept_id) = 1""",
)
def stcm_new_rows(x: Inputs):
    return worklist.new_mappings(
        x["reviewed_map"], x["source_to_concept_map"], ["target_concept_id"]
    )
