"""Filters, date repair, joins and first-row-per-key."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.checks.inputs import Inputs
from cohortloom.checks.registry import SETTINGS, check
from cohortloom.checks.sql import clean, first_by, lower, sid, ts
from cohortloom.functions import parse
from cohortloom.functions.keys import pseudonym, reveal
from cohortloom.functions.text import alnum
from cohortloom.operators import joins, rows
from cohortloom.plans import entities
from cohortloom.plans.runs import map_rows, spec_for


@check(
    "drop_null_dates",
    f"SELECT id, {ts('birthdate')} AS birthdate FROM patients WHERE {ts('birthdate')} IS NOT NULL",
)
def drop_null_dates(x: Inputs):
    born = x["patients"].select("id", parse.to_datetime(F.col("birthdate")).alias("birthdate"))
    return born.dropna(subset=["birthdate"])


@check(
    "repair_interval",
    "SELECT id, start, stop FROM repaired",
)
def repair_interval(x: Inputs):
    spans = x["encounters"].select(
        "id", *[parse.to_datetime(F.col(c)).alias(c) for c in ("start", "stop")]
    )
    return rows.repair_interval(spans, "start", "stop")


@check(
    "death_after_birth",
    f"""SELECT id, {ts("deathdate")} AS died FROM patients
    WHERE {ts("deathdate")} IS NOT NULL
    AND ({ts("birthdate")} IS NULL OR {ts("deathdate")} >= {ts("birthdate")})""",
)
def death_after_birth(x: Inputs):
    died, born = parse.to_datetime(F.col("deathdate")), parse.to_datetime(F.col("birthdate"))
    dead = x["patients"].select("id", died.alias("died"), born.alias("born"))
    kept = dead.dropna(subset=["died"]).filter(rows.not_before(F.col("died"), F.col("born")))
    return kept.select("id", "died")


def _measured(value: str) -> str:
    kind = lower("category")
    return f"""(({kind} IN ('laboratory', 'vital-signs', 'exam')
        OR ({kind} NOT IN ('health indicator', 'survey', 'social-history')
            AND {value} IS NOT NULL AND trim(coalesce(units, '')) <> ''))
        AND upper(trim(coalesce(code, ''))) NOT IN ('QOLS', 'QALY', 'DALY'))"""


_KEPT = "encounter, category, code, value, units"


def _classified(x: Inputs):
    value = parse.to_float(F.col("value"))
    flag = rows.is_measurement(F.col("category"), F.col("code"), value, F.col("units"))
    return x["observations"].withColumn("measured", flag)


@check(
    "classify_measurement",
    f"SELECT {_KEPT} FROM observations WHERE {_measured('TRY_CAST(value AS DOUBLE)')}",
)
def classify_measurement(x: Inputs):
    return _classified(x).filter("measured").select(*_KEPT.split(", "))


@check(
    "classify_observation",
    f"SELECT {_KEPT} FROM observations WHERE NOT {_measured('TRY_CAST(value AS DOUBLE)')}",
)
def classify_observation(x: Inputs):
    return _classified(x).filter("NOT measured").select(*_KEPT.split(", "))


@check(
    "split_counts",
    f"""SELECT category, count(*) FILTER (WHERE m) AS measurements,
        count(*) FILTER (WHERE NOT m) AS observations, count(*) AS rows
    FROM (SELECT category, {_measured("TRY_CAST(value AS DOUBLE)")} AS m FROM observations)
    GROUP BY category""",
)
def split_counts(x: Inputs):
    return (
        _classified(x)
        .groupBy("category")
        .agg(
            F.count_if("measured").alias("measurements"),
            F.count_if(~F.col("measured")).alias("observations"),
            F.count("*").alias("rows"),
        )
    )


@check(
    "clamp_period",
    """SELECT row_id, greatest(start, born) AS start, greatest(stop, start, born) AS stop FROM (
        SELECT row_id, start, CASE WHEN row_id % 6 = 0 THEN NULL ELSE stop END AS stop,
            CASE WHEN person_id % 4 = 0 THEN NULL
            ELSE DATE '1996-01-01' + CAST(person_id % 1000 AS INT) END AS born
        FROM order_spans)""",
)
def clamp_period(x: Inputs):
    born = F.expr(
        "CASE WHEN person_id % 4 <> 0 THEN DATE'1996-01-01' + CAST(person_id % 1000 AS INT) END"
    )
    spans = x["order_spans"].withColumn("stop", F.when(F.col("row_id") % 6 != 0, F.col("stop")))
    return rows.clamp_period(spans, "start", "stop", born).select("row_id", "start", "stop")


@check(
    "drug_date_fill",
    """SELECT person_id, drug_concept_id,
        coalesce(drug_exposure_start_date, drug_exposure_end_date) AS drug_exposure_start_date,
        coalesce(drug_exposure_end_date, drug_exposure_start_date) AS drug_exposure_end_date
    FROM open_exposures""",
)
def drug_date_fill(x: Inputs):
    columns = ["drug_exposure_start_date", "drug_exposure_end_date"]
    exposures = x["open_exposures"].select("person_id", "drug_concept_id", *columns)
    return rows.fill_either(exposures, *columns)


# --- joins -------------------------------------------------------------------------------


def _persons(x: Inputs):
    return map_rows(spec_for("person"), x["patients"], SETTINGS)


@check(
    "join_person",
    f"""SELECT m.encounter, m.code, p.person_id FROM medications m
    JOIN persons p ON p.pk = {clean("m.patient")}""",
)
def join_person(x: Inputs):
    people = _persons(x).withColumn(
        "person_source_value", reveal(F.col("person_source_value"), SETTINGS.secret)
    )
    facts = x["medications"].select(
        "encounter", "code", alnum(F.col("patient")).alias("person_source_value")
    )
    return joins.join_person(facts, people).drop("person_source_value")


@check(
    "join_provider_caresite",
    f"""SELECT e.id, p.provider_id, c.care_site_id FROM encounters e
    LEFT JOIN (SELECT id, {sid("id", "provider")} AS provider_id FROM providers) p
        ON e.provider = p.id
    LEFT JOIN (SELECT DISTINCT {clean("organization")} AS k,
        {sid(clean("organization"), "care site")} AS care_site_id FROM providers) c
        ON {clean("e.organization")} = c.k""",
)
def join_provider_caresite(x: Inputs):
    providers = map_rows(spec_for("provider"), x["providers"], SETTINGS)
    sites = map_rows(spec_for("care_site"), x["providers"], SETTINGS)
    facts = x["encounters"].select(
        "id",
        F.col("provider").alias("provider_source_value"),
        pseudonym(alnum(F.col("organization")), SETTINGS.secret).alias("care_site_source_value"),
    )
    facts = joins.join_dimension(facts, providers, "provider_source_value", "provider_id")
    facts = joins.join_dimension(facts, sites, "care_site_source_value", "care_site_id")
    return facts.select("id", "provider_id", "care_site_id")


def _visits(x: Inputs):
    return map_rows(spec_for("visit_occurrence"), x["encounters"], SETTINGS)


_VISIT_IDS = f"""SELECT id AS visit_source_value, {sid("id", "visit occurrence")}
    AS visit_occurrence_id FROM kept_visits"""


@check(
    "join_visit_left",
    """SELECT m.encounter, m.code, v.visit_occurrence_id FROM medications m
    LEFT JOIN visit_ids v ON m.encounter = v.visit_source_value""",
    {"visit_ids": _VISIT_IDS},
)
def join_visit_left(x: Inputs):
    facts = x["medications"].select(F.col("encounter").alias("visit_source_value"), "code")
    joined = joins.join_dimension(facts, _visits(x), "visit_source_value", "visit_occurrence_id")
    return joined.withColumnRenamed("visit_source_value", "encounter")


@check(
    "join_visit_inner",
    """SELECT m.encounter, m.code, v.visit_occurrence_id FROM medications m
    JOIN visit_ids v ON m.encounter = v.visit_source_value""",
    {"visit_ids": _VISIT_IDS},
)
def join_visit_inner(x: Inputs):
    facts = x["medications"].select(F.col("encounter").alias("visit_source_value"), "code")
    joined = joins.join_parent(facts, _visits(x), "visit_source_value", "visit_occurrence_id")
    return joined.withColumnRenamed("visit_source_value", "encounter")


@check(
    "anti_existing",
    f"""SELECT encounter, drug_exposure_id FROM (
        SELECT encounter, start, {sid("encounter", "drug_exposure")} AS drug_exposure_id
        FROM medications)
    WHERE drug_exposure_id NOT IN (SELECT {sid("encounter", "drug_exposure")} FROM medications
        WHERE start < '1997-01-01')""",
)
def anti_existing(x: Inputs):
    drugs = x["medications"].select(
        "encounter",
        "start",
        entities._event_id("drug_exposure", "drug_exposure", "encounter", SETTINGS).alias(
            "drug_exposure_id"
        ),
    )
    earlier = drugs.filter("start < '1997-01-01'")
    return joins.only_new(drugs, earlier, "drug_exposure_id").select(
        "encounter", "drug_exposure_id"
    )


@check(
    "keep_first",
    f"""SELECT patient, encounter, start, stop, code, description FROM (
    {first_by("procedures", "patient", "start, stop, code, description, encounter")})""",
)
def keep_first(x: Inputs):
    columns = ["patient", "encounter", "start", "stop", "code", "description"]
    order = ["start", "stop", "code", "description", "encounter"]
    return joins.keep_first(x["procedures"].select(*columns), "patient", order)


@check(
    "person_periods",
    f"""SELECT p.person_id, p.pk AS person_key, o.start AS observation_period_start_date,
        o.stop AS observation_period_end_date
    FROM persons p JOIN (SELECT {clean("patient")} AS pk, CAST(min(start) AS DATE) AS start,
        CAST(max(stop) AS DATE) AS stop FROM repaired GROUP BY 1) o ON p.pk = o.pk""",
)
def person_periods(x: Inputs):
    periods = map_rows(spec_for("observation_period"), x["encounters"], SETTINGS)
    joined = joins.join_person(periods, _persons(x))
    return joined.select(
        "person_id",
        reveal(F.col("person_source_value"), SETTINGS.secret).alias("person_key"),
        "observation_period_start_date",
        "observation_period_end_date",
    )
