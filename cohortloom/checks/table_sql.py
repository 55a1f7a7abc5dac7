"""Checking SQL for the mapped and loaded tables."""

from __future__ import annotations

from cohortloom.checks import expected
from cohortloom.checks.sql import cases, clean, eras, first_by, lower, sid, ts

PARTS: dict[str, str] = {}


def _const(value: int, name: str) -> str:
    return f"CAST({value} AS BIGINT) AS {name}"


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def repaired(extract: str) -> str:
    """Extract with parsed start and stop, repaired."""
    return f"""SELECT * REPLACE (s AS start, greatest(e, s) AS stop) FROM (
        SELECT *, coalesce(a, b) AS s, coalesce(b, a) AS e FROM (
            SELECT *, {ts("start")} AS a, {ts("stop")} AS b FROM {extract}))
        WHERE s IS NOT NULL"""


ZIP = clean("coalesce(zip, '')")
PARTS["repaired"] = repaired("encounters")

# --- mapped ------------------------------------------------------------------------------

PARTS["m_location"] = f"""SELECT {sid(ZIP, "location")} AS location_id, city, state AS county,
    {_const(expected.COUNTRY_CONCEPT, "country_concept_id")},
    '{expected.COUNTRY}' AS country_source_value, {ZIP} AS location_key FROM patients"""

PARTS["m_person"] = f"""SELECT {sid("id", "person")} AS person_id, {clean("id")} AS pk,
    CAST({cases(lower("gender"), expected.GENDER, "0")} AS BIGINT) AS gender_concept_id,
    CAST({cases(lower("race"), expected.RACE, "0")} AS BIGINT) AS race_concept_id,
    CAST({cases(lower("ethnicity"), expected.ETHNICITY, "0")} AS BIGINT) AS ethnicity_concept_id,
    b AS birth_datetime, {sid(ZIP, "location")} AS location_id,
    gender AS gender_source_value, race AS race_source_value,
    ethnicity AS ethnicity_source_value, city
    FROM (SELECT *, {ts("birthdate")} AS b FROM patients) WHERE b IS NOT NULL"""

PARTS["persons"] = """SELECT pk, min(person_id) AS person_id, min(birth_datetime) AS born
    FROM m_person GROUP BY pk"""

PARTS["m_death"] = f"""SELECT {clean("id")} AS pk, died, cause_of_death AS cause, city FROM (
    SELECT *, {ts("deathdate")} AS died, {ts("birthdate")} AS born FROM patients)
    WHERE died IS NOT NULL AND (born IS NULL OR died >= born)"""

PARTS["m_period"] = f"""SELECT {clean("patient")} AS pk,
    {sid("patient", "observation_period")} AS observation_period_id,
    CAST(min(start) AS DATE) AS first_day, CAST(max(stop) AS DATE) AS last_day
    FROM repaired WHERE patient IS NOT NULL GROUP BY patient"""

_ORG = clean("organization")
PARTS["m_site"] = f"""SELECT {sid(_ORG, "care site")} AS care_site_id, {_ORG} AS site_key,
    name AS care_site_name, {ZIP} AS location_key, gender FROM providers"""
PARTS["m_provider"] = f"""SELECT {sid("id", "provider")} AS provider_id, id, name, gender,
    speciality, {_ORG} AS site_key,
    CAST({cases("gender", expected.PROVIDER_GENDER, "0")} AS BIGINT) AS gender_concept_id
    FROM providers"""

PARTS["v_class"] = f"""SELECT *, {clean("patient")} AS pk,
    CAST({cases("encounterclass", expected.VISIT_CLASS, "9201")} AS BIGINT) AS visit_concept_id
    FROM repaired"""
PARTS["v_rank"] = """SELECT *, row_number() OVER (PARTITION BY pk, visit_concept_id
    ORDER BY CAST(start AS DATE), start, stop, id) AS rn FROM v_class WHERE pk IS NOT NULL"""
PARTS["v_lag"] = """SELECT *, lag(stop) OVER (PARTITION BY pk, visit_concept_id ORDER BY rn)
    AS before FROM v_rank"""
PARTS["v_number"] = """SELECT *, sum(CASE WHEN floor((epoch_us(start) - epoch_us(before))
    / 86400000000.0) > 1 THEN 1 ELSE 0 END)
    OVER (PARTITION BY pk, visit_concept_id ORDER BY rn) AS visit FROM v_lag"""
PARTS["kept_visits"] = f"""SELECT pk, visit_concept_id, min(start) AS start, max(stop) AS stop,
    first(id ORDER BY rn) AS id,
    first(provider ORDER BY rn) FILTER (WHERE provider IS NOT NULL) AS provider,
    {clean("first(organization ORDER BY rn) FILTER (WHERE organization IS NOT NULL)")} AS site_key
    FROM v_number GROUP BY pk, visit_concept_id, visit"""

# --- vocabulary --------------------------------------------------------------------------

PARTS["direct_ids"] = """SELECT concept_code, min(concept_id) AS concept_id FROM concept
    WHERE standard_concept = 'S' GROUP BY concept_code"""


def mapped_ids(vocabularies: list[str]) -> str:
    return f"""SELECT c1.concept_code, min(c2.concept_id) AS concept_id
        FROM concept c1 JOIN concept_relationship r ON c1.concept_id = r.concept_id_1
        JOIN concept c2 ON r.concept_id_2 = c2.concept_id
        WHERE c1.vocabulary_id IN ({_quoted(vocabularies)})
        AND r.relationship_id = 'Maps to' AND c2.standard_concept = 'S'
        GROUP BY c1.concept_code"""


def resolved_ids(vocabularies: list[str]) -> str:
    return f"""SELECT coalesce(d.concept_code, m.concept_code) AS concept_code,
        coalesce(d.concept_id, m.concept_id) AS concept_id
        FROM direct_ids d FULL JOIN ({mapped_ids(vocabularies)}) m
        ON d.concept_code = m.concept_code"""


def own_ids(vocabularies: list[str]) -> str:
    return f"""SELECT concept_code, min(concept_id) AS concept_id FROM concept
        WHERE vocabulary_id IN ({_quoted(vocabularies)}) GROUP BY concept_code"""


# --- loaded ------------------------------------------------------------------------------

EMPTY = "false"


def location(prior: str = EMPTY) -> str:
    new = first_by(
        f"(SELECT * FROM m_location WHERE location_id NOT IN "
        f"(SELECT location_id FROM m_location WHERE {prior}))",
        "location_id",
        "city, county, location_key",
    )
    return f"""SELECT location_id, city, substr(county, 1, 20) AS county, country_concept_id,
        country_source_value, location_key AS location_source_value FROM ({new})"""


def person(prior: str = EMPTY) -> str:
    new = first_by(
        f"(SELECT * FROM m_person WHERE pk NOT IN (SELECT pk FROM m_person WHERE {prior}) "
        f"AND person_id NOT IN (SELECT person_id FROM m_person WHERE {prior}))",
        "person_id",
        "birth_datetime, gender_source_value, race_source_value",
    )
    zero = ", ".join(
        _const(0, f"{c}_source_concept_id") for c in ("gender", "race", "ethnicity")
    )
    return f"""SELECT person_id, gender_concept_id, CAST(year(birth_datetime) AS BIGINT)
        AS year_of_birth, CAST(month(birth_datetime) AS BIGINT) AS month_of_birth,
        CAST(day(birth_datetime) AS BIGINT) AS day_of_birth, birth_datetime, race_concept_id,
        ethnicity_concept_id, location_id, CAST(NULL AS BIGINT) AS provider_id,
        CAST(NULL AS BIGINT) AS care_site_id, pk AS person_source_value, gender_source_value,
        race_source_value, ethnicity_source_value, {zero} FROM ({new})"""


def death(prior: str = EMPTY) -> str:
    known = "SELECT d.*, p.person_id FROM m_death d JOIN l_persons p ON d.pk = p.pk"
    new = first_by(
        f"({known} WHERE person_id NOT IN (SELECT person_id FROM ({known}) WHERE {prior}))",
        "person_id",
        "died, cause",
    )
    return f"""SELECT CAST(died AS DATE) AS death_date, died AS death_datetime, person_id,
        {_const(expected.FROM_RECORD, "death_type_concept_id")}, {_const(0, "cause_concept_id")},
        cause AS cause_source_value, {_const(0, "cause_source_concept_id")} FROM ({new})"""


def observation_period(prior: str = EMPTY) -> str:
    known = f"""SELECT m.*, p.person_id, greatest(first_day, CAST(born AS DATE)) AS s
        FROM m_period m JOIN l_persons p ON m.pk = p.pk"""
    new = first_by(
        f"({known} WHERE p.person_id NOT IN (SELECT p.person_id FROM m_period m "
        f"JOIN l_persons p ON m.pk = p.pk WHERE {prior}))",
        "person_id",
        "s, last_day",
    )
    return f"""SELECT person_id, observation_period_id, s AS observation_period_start_date,
        greatest(last_day, s) AS observation_period_end_date,
        {_const(expected.FROM_ENCOUNTERS, "period_type_concept_id")} FROM ({new})"""


def care_site(prior: str = EMPTY) -> str:
    new = first_by(
        f"(SELECT * FROM m_site WHERE care_site_id NOT IN "
        f"(SELECT care_site_id FROM m_site WHERE {prior}))",
        "care_site_id",
        "care_site_name, location_key",
    )
    return f"""SELECT care_site_id, care_site_name,
        {_const(expected.PLACE_OF_SERVICE, "place_of_service_concept_id")},
        site_key AS care_site_source_value, l.location_id
        FROM ({new}) s LEFT JOIN l_places l ON s.location_key = l.location_key"""


def provider(prior: str = EMPTY) -> str:
    new = first_by(
        f"(SELECT * FROM m_provider WHERE provider_id NOT IN "
        f"(SELECT provider_id FROM m_provider WHERE {prior}))",
        "provider_id",
        "id",
    )
    return f"""SELECT provider_id, gender AS gender_source_value,
        speciality AS specialty_source_value, name AS provider_name,
        id AS provider_source_value, {_const(expected.SPECIALTY, "specialty_concept_id")},
        gender_concept_id, s.care_site_id
        FROM ({new}) p LEFT JOIN l_sites s ON p.site_key = s.site_key"""


_VISITS = f"""SELECT v.*, p.person_id, {sid("v.id", "visit occurrence")} AS visit_occurrence_id
    FROM kept_visits v JOIN l_persons p ON v.pk = p.pk"""


def visit_occurrence(prior: str = EMPTY) -> str:
    new = first_by(
        f"(SELECT * FROM ({_VISITS}) WHERE visit_occurrence_id NOT IN "
        f"(SELECT visit_occurrence_id FROM ({_VISITS}) WHERE {prior}))",
        "visit_occurrence_id",
        "start, stop, visit_concept_id, person_id",
    )
    return f"""SELECT visit_occurrence_id, visit_concept_id, person_id,
        CAST(start AS DATE) AS visit_start_date, start AS visit_start_datetime,
        CAST(stop AS DATE) AS visit_end_date, stop AS visit_end_datetime,
        {_const(expected.FROM_ENCOUNTERS, "visit_type_concept_id")},
        v.id AS visit_source_value, d.provider_id, s.care_site_id
        FROM ({new}) v LEFT JOIN l_doctors d ON v.provider = d.id
        LEFT JOIN l_sites s ON v.site_key = s.site_key"""


# Natural keys of the loaded dimensions: a row that lost its id to another one is not there.
PARTS["l_persons"] = """SELECT person_source_value AS pk, min(person_id) AS person_id,
    arg_min(birth_datetime, person_id) AS born FROM t_person GROUP BY 1"""
PARTS["l_places"] = """SELECT location_source_value AS location_key,
    min(location_id) AS location_id FROM t_location GROUP BY 1"""
PARTS["l_sites"] = """SELECT care_site_source_value AS site_key,
    min(care_site_id) AS care_site_id FROM t_site GROUP BY 1"""
PARTS["l_doctors"] = """SELECT provider_source_value AS id,
    min(provider_id) AS provider_id FROM t_provider GROUP BY 1"""
PARTS["l_visits"] = """SELECT visit_source_value,
    min(visit_occurrence_id) AS visit_occurrence_id FROM t_visit GROUP BY 1"""


def _events(mapped: str, key: str, order: str, prior: str) -> str:
    known = f"SELECT m.*, p.person_id FROM ({mapped}) m JOIN l_persons p ON m.pk = p.pk"
    new = first_by(
        f"(SELECT * FROM ({known}) WHERE {key} NOT IN (SELECT {key} FROM ({known}) "
        f"WHERE {prior}))",
        key,
        order,
    )
    return f"""(SELECT e.*, v.visit_occurrence_id FROM ({new}) e
        LEFT JOIN l_visits v ON e.encounter = v.visit_source_value) e"""


_ORDER = "start, stop, code, description, encounter, person_id"


def _coded(
    table: str, stem: str, extract: str, of: str, prior: str, codes: list[str], own: list[str]
) -> str:
    mapped = f"""SELECT {sid(of, table)} AS {table}_id, {clean("patient")} AS pk, start, stop,
        code, description, encounter FROM ({repaired(extract)})"""
    first = "procedure" if stem == "procedure" else f"{stem}_start"
    if stem == "drug":
        first, stem_date = "drug_exposure_start", "drug_exposure"
    else:
        stem_date = stem
    return f"""SELECT {table}_id, person_id, CAST(start AS DATE) AS {first}_date,
        start AS {first}_datetime, CAST(stop AS DATE) AS {stem_date}_end_date,
        stop AS {stem_date}_end_datetime, description AS {stem}_source_value,
        coalesce(o.concept_id, 0) AS {stem}_source_concept_id, visit_occurrence_id,
        {_const(expected.FROM_RECORD, f"{stem}_type_concept_id")},
        coalesce(r.concept_id, 0) AS {stem}_concept_id
        FROM {_events(mapped, f"{table}_id", _ORDER, prior)}
        LEFT JOIN ({resolved_ids(codes)}) r ON e.code = r.concept_code
        LEFT JOIN ({own_ids(own)}) o ON e.code = o.concept_code"""


def condition_occurrence(prior: str = EMPTY) -> str:
    return _coded(
        "condition_occurrence", "condition", "conditions", "patient", prior,
        expected.CONDITION_CODES, expected.CONDITION_CODES,
    )


def procedure_occurrence(prior: str = EMPTY) -> str:
    return _coded(
        "procedure_occurrence", "procedure", "procedures", "encounter", prior,
        expected.PROCEDURE_CODES, expected.PROCEDURE_SOURCES,
    )


def drug_exposure(prior: str = EMPTY) -> str:
    return _coded(
        "drug_exposure", "drug", "medications", "encounter", prior,
        expected.DRUG_CODES, expected.DRUG_SOURCES,
    )


def immunization(prior: str = EMPTY) -> str:
    mapped = f"""SELECT {sid("encounter", "immunization_exposure")} AS drug_exposure_id,
        {clean("patient")} AS pk, {ts("date")} AS given, code, description, encounter
        FROM immunizations"""
    order = "given, code, description, encounter, person_id"
    return f"""SELECT drug_exposure_id, person_id,
        CAST(given AS DATE) AS drug_exposure_start_date, given AS drug_exposure_start_datetime,
        CAST(given AS DATE) AS drug_exposure_end_date,
        CAST(NULL AS TIMESTAMP) AS drug_exposure_end_datetime, description AS drug_source_value,
        coalesce(o.concept_id, 0) AS drug_source_concept_id, visit_occurrence_id,
        {_const(expected.FROM_RECORD, "drug_type_concept_id")},
        coalesce(r.concept_id, 0) AS drug_concept_id
        FROM {_events(mapped, "drug_exposure_id", order, prior)}
        LEFT JOIN ({resolved_ids(expected.DRUG_CODES)}) r ON e.code = r.concept_code
        LEFT JOIN ({own_ids(expected.DRUG_SOURCES)}) o ON e.code = o.concept_code"""


def visit_detail(prior: str = EMPTY) -> str:
    admitted = r"regexp_replace(coalesce(reasoncode, '0'), '\.0$', '')"
    mapped = f"""SELECT {sid("id", "visit_detail")} AS visit_detail_id, id AS encounter, start,
        stop, code, {clean("patient")} AS pk, description, provider, {_ORG} AS site_key,
        {admitted} AS admitted, coalesce(reasondescription, '{expected.NO_REASON}') AS reason
        FROM repaired WHERE id IN (SELECT visit_source_value FROM l_visits)"""
    order = "start, stop, code, person_id"
    return f"""SELECT visit_detail_id, person_id,
        coalesce(c.concept_id, 0) AS visit_detail_concept_id,
        description AS visit_detail_source_value,
        coalesce(o.concept_id, 0) AS visit_detail_source_concept_id,
        CAST(start AS DATE) AS visit_detail_start_date, start AS visit_detail_start_datetime,
        CAST(stop AS DATE) AS visit_detail_end_date, stop AS visit_detail_end_datetime,
        visit_occurrence_id, d.provider_id,
        {_const(expected.FROM_RECORD, "visit_detail_type_concept_id")}, s.care_site_id,
        coalesce(a.concept_id, 0) AS admitted_from_concept_id,
        substr(reason, 1, 50) AS admitted_from_source_value
        FROM {_events(mapped, "visit_detail_id", order, prior)}
        LEFT JOIN ({resolved_ids(expected.DETAIL_CODES)}) c ON e.code = c.concept_code
        LEFT JOIN ({resolved_ids(expected.DETAIL_CODES)}) a ON e.admitted = a.concept_code
        LEFT JOIN ({own_ids(expected.DETAIL_CODES)}) o ON e.code = o.concept_code
        LEFT JOIN l_doctors d ON e.provider = d.id LEFT JOIN l_sites s ON e.site_key = s.site_key"""


def _observed(table: str, prior: str, codes: list[str], measured: bool, own: str) -> str:
    kind = lower("category")
    flag = f"""({kind} IN ('laboratory', 'vital-signs', 'exam')
        OR ({kind} NOT IN ('health indicator', 'survey', 'social-history')
            AND trim(coalesce(units, '')) <> ''))
        AND upper(trim(coalesce(code, ''))) NOT IN ('QOLS', 'QALY', 'DALY')"""
    types = expected.MEASUREMENT_TYPE if measured else expected.OBSERVATION_TYPE
    source_type = "obser_measurement" if measured else "observation"
    mapped = f"""SELECT {sid("encounter", source_type)} AS {table}_id, *, d AS start
        FROM (SELECT {clean("patient")} AS pk, {ts("date")} AS d, code, units, description,
            coalesce(encounter, '{expected.NO_ENCOUNTER}') AS encounter,
            coalesce(TRY_CAST(value AS DOUBLE), 0.0) AS number,
            {cases(lower("category"), types, "'0'")} AS type,
            {cases("code", expected.QUALITY, "code")} AS concept_text
            FROM observations WHERE {"" if measured else "NOT"} ({flag}))
        WHERE d IS NOT NULL"""
    order = "start, code, number, units, type, description, encounter, person_id"
    return f"""SELECT {table}_id, person_id, start AS {table}_datetime,
        CAST(start AS DATE) AS {table}_date,
        coalesce(t.concept_id, 0) AS {table}_type_concept_id,
        description AS {table}_source_value,
        coalesce(o.concept_id, 0) AS {table}_source_concept_id,
        coalesce(c.concept_id, 0) AS {table}_concept_id, number AS value_as_number,
        CAST(number AS VARCHAR) AS value_source_value, visit_occurrence_id,
        units AS unit_source_value
        FROM {_events(mapped, f"{table}_id", order, prior)}
        LEFT JOIN ({resolved_ids(codes)}) t ON e.type = t.concept_code
        LEFT JOIN ({resolved_ids(codes)}) c ON e.concept_text = c.concept_code
        LEFT JOIN ({own}) o ON e.code = o.concept_code"""


def measurement(prior: str = EMPTY) -> str:
    codes = expected.MEASUREMENT_CODES
    return _observed("measurement", prior, codes, True, resolved_ids(codes))


def observation(prior: str = EMPTY) -> str:
    codes = expected.OBSERVATION_CODES
    return _observed("observation", prior, codes, False, own_ids(codes))


# --- a first load of everything ----------------------------------------------------------

PARTS["t_location"] = location()
PARTS["t_person"] = person()
PARTS["t_death"] = death()
PARTS["t_period"] = observation_period()
PARTS["t_site"] = care_site()
PARTS["t_provider"] = provider()
PARTS["t_visit"] = visit_occurrence()
PARTS["t_condition"] = condition_occurrence()
PARTS["t_detail"] = visit_detail()
PARTS["t_procedure"] = procedure_occurrence()
PARTS["t_medication"] = drug_exposure()
PARTS["t_drug"] = f"""SELECT * FROM t_medication UNION ALL BY NAME
    SELECT * FROM ({immunization()})
    WHERE drug_exposure_id NOT IN (SELECT drug_exposure_id FROM t_medication)"""
PARTS["t_measurement"] = measurement()
PARTS["t_observation"] = observation()
PARTS |= eras(
    "x_condition", "t_condition", ["person_id", "condition_concept_id"], "condition",
    person_end=False,
)
_DOSED = "SELECT *, CAST(0 AS BIGINT) AS unit_concept_id, CAST(1 AS DOUBLE) AS dose_value"
for _name, _source in (("x_first", "t_medication"), ("x_both", "t_drug")):
    PARTS |= eras(_name, _source, ["person_id", "drug_concept_id"], "drug_exposure")
    PARTS[f"{_name}_dosed"] = f"{_DOSED} FROM {_source}"
    PARTS |= eras(
        f"{_name}_dose",
        f"{_name}_dosed",
        ["person_id", "drug_concept_id", "unit_concept_id", "dose_value"],
        "drug_exposure",
        dose=True,
    )


def era_loads(kind: str, before: str, earlier: str) -> tuple[str, dict[str, str]]:
    """Eras after an earlier part of an extract and then all of it; superseded eras stay."""
    if kind == "condition":
        table, stem, extract, of = "condition_occurrence", "condition", "conditions", "patient"
        codes = (expected.CONDITION_CODES, expected.CONDITION_CODES)
        stems, keys = "condition", ["person_id", "condition_concept_id"]
    else:
        table, stem, extract, of = "drug_exposure", "drug", "medications", "encounter"
        codes = (expected.DRUG_CODES, expected.DRUG_SOURCES)
        stems, keys = "drug_exposure", ["person_id", "drug_concept_id"]
    dosed = kind == "dose"
    keys = [*keys, "unit_concept_id", "dose_value"] if dosed else keys
    parts = {
        "w_extract": f"SELECT * FROM {extract} WHERE {earlier}",
        "w_first_rows": _coded(table, stem, "w_extract", of, EMPTY, *codes),
        "w_more_rows": _coded(table, stem, extract, of, before, *codes),
        "w_all_rows": "SELECT * FROM w_first_rows UNION ALL BY NAME SELECT * FROM w_more_rows",
    }
    for name, source in (("w_first", "w_first_rows"), ("w_all", "w_all_rows")):
        if dosed:
            parts[f"{name}_dosed"] = f"{_DOSED} FROM {source}"
            source = f"{name}_dosed"
        parts |= eras(name, source, keys, stems, person_end=kind != "condition", dose=dosed)
    key = f"{kind}_era_id"
    sql = f"""SELECT * FROM w_first_eras UNION ALL BY NAME SELECT * FROM w_all_eras
        WHERE {key} NOT IN (SELECT {key} FROM w_first_eras)"""
    return sql, parts
