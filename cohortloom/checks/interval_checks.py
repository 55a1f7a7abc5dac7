"""Aggregates, row-level windows, eras and visits."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.checks import expected
from cohortloom.checks.inputs import Inputs
from cohortloom.checks.registry import SETTINGS, check
from cohortloom.checks.sql import cases, eras, sid
from cohortloom.functions.keys import reveal
from cohortloom.operators import intervals, rows
from cohortloom.plans import entities
from cohortloom.plans.runs import map_rows, spec_for


@check(
    "observation_period",
    """SELECT pk AS person_source_value, observation_period_id,
        first_day AS observation_period_start_date, last_day AS observation_period_end_date,
        CAST(32827 AS BIGINT) AS period_type_concept_id FROM m_period""",
)
def observation_period(x: Inputs):
    periods = map_rows(spec_for("observation_period"), x["encounters"], SETTINGS)
    key = reveal(F.col("person_source_value"), SETTINGS.secret)
    return periods.withColumn("person_source_value", key)


@check(
    "visit_span",
    """SELECT person_id, min(start) AS visit_start_date, max(stop) AS visit_end_date
    FROM order_spans GROUP BY person_id""",
)
def visit_span(x: Inputs):
    visits = x["order_spans"].withColumnsRenamed(
        {"start": "visit_start_date", "stop": "visit_end_date"}
    )
    return intervals.group_span(visits, "person_id", "visit_start_date", "visit_end_date")


@check(
    "median_fill",
    """SELECT person_id, drug_concept_id, coalesce(drug_exposure_start_date, m) AS start
    FROM open_exposures, (SELECT DATE '1970-01-01' + CAST(floor(median(date_diff('day',
        DATE '1970-01-01', drug_exposure_start_date))) AS INT) AS m FROM open_exposures)""",
)
def median_fill(x: Inputs):
    exposures = x["open_exposures"]
    middle = intervals.median_day(exposures, "drug_exposure_start_date").scalar()
    filled = F.coalesce(F.col("drug_exposure_start_date"), middle)
    return exposures.select("person_id", "drug_concept_id", filled.alias("start"))


@check(
    "lag_gap",
    """SELECT row_id, pe AS previous_end, start - pe AS gap FROM (
        SELECT *, lag(stop) OVER (PARTITION BY person_id ORDER BY start, stop, row_id) AS pe
        FROM order_spans)""",
)
def lag_gap(x: Inputs):
    spans = intervals.previous_end(x["order_spans"], ["person_id"], "start", "stop", "row_id")
    gap = F.datediff("start", "previous_end").cast("long")
    return spans.select("row_id", "previous_end", gap.alias("gap"))


@check(
    "running_session",
    """SELECT row_id, CAST(sum(CASE WHEN pe IS NULL OR start - pe > 30 THEN 1 ELSE 0 END)
        OVER (PARTITION BY person_id ORDER BY start, stop, row_id ROWS UNBOUNDED PRECEDING)
        AS BIGINT) AS session FROM (
        SELECT *, lag(stop) OVER (PARTITION BY person_id ORDER BY start, stop, row_id) AS pe
        FROM order_spans)""",
)
def running_session(x: Inputs):
    spans = intervals.session_number(x["order_spans"], ["person_id"], "start", "stop", 30)
    return spans.select("row_id", "session")


@check(
    "partition_fill",
    """SELECT e.person_id, drug_concept_id,
        coalesce(drug_exposure_start_date, s) AS drug_exposure_start_date,
        coalesce(drug_exposure_end_date, l) AS drug_exposure_end_date
    FROM open_exposures e LEFT JOIN (SELECT person_id, min(drug_exposure_start_date) AS s,
        max(drug_exposure_end_date) AS l FROM open_exposures GROUP BY person_id) b
    ON e.person_id = b.person_id""",
)
def partition_fill(x: Inputs):
    dates = ["drug_exposure_start_date", "drug_exposure_end_date"]
    exposures = x["open_exposures"].select("person_id", "drug_concept_id", *dates)
    return intervals.fill_from_group(exposures, "person_id", *dates)


_STAY_CLASS = cases("encounterclass", expected.VISIT_CLASS, "9201")


@check(
    "visit_collapse",
    f"""SELECT person_id, visit_concept_id, min(start) AS start, max(stop) AS stop,
        first(event_id ORDER BY rn) AS event_id,
        first(provider ORDER BY rn) FILTER (WHERE provider IS NOT NULL) AS provider
    FROM (SELECT *, sum(CASE WHEN floor((epoch_us(start) - epoch_us(before))
            / 86400000000.0) > 1 THEN 1 ELSE 0 END)
            OVER (PARTITION BY person_id, visit_concept_id ORDER BY rn) AS visit
        FROM (SELECT *, lag(stop) OVER (PARTITION BY person_id, visit_concept_id ORDER BY rn)
                AS before
            FROM (SELECT *, row_number() OVER (PARTITION BY person_id, visit_concept_id
                    ORDER BY CAST(start AS DATE), start, stop, event_id) AS rn
                FROM (SELECT event_id, person_id, start,
                    greatest(start, coalesce(stop, start)) AS stop, provider,
                    CAST({_STAY_CLASS} AS BIGINT) AS visit_concept_id FROM stays))))
    GROUP BY person_id, visit_concept_id, visit""",
)
def visit_collapse(x: Inputs):
    stays = rows.repair_interval(x["stays"], "start", "stop").withColumn(
        "visit_concept_id", entities.visit_class(F.col("encounterclass"))
    )
    keys = ["person_id", "visit_concept_id"]
    return intervals.collapse_visits(stays, keys, "start", "stop", "event_id", ["provider"])


@check(
    "visit_occurrence",
    f"""SELECT {sid("id", "visit occurrence")} AS visit_occurrence_id, visit_concept_id,
        CAST(start AS DATE) AS visit_start_date, start AS visit_start_datetime,
        CAST(stop AS DATE) AS visit_end_date, stop AS visit_end_datetime,
        pk AS person_source_value, CAST(32827 AS BIGINT) AS visit_type_concept_id,
        id AS visit_source_value, provider AS provider_source_value,
        site_key AS care_site_source_value FROM kept_visits""",
)
def visit_occurrence(x: Inputs):
    visits = map_rows(spec_for("visit_occurrence"), x["encounters"], SETTINGS)
    hidden = ["person_source_value", "care_site_source_value"]
    return visits.withColumns({c: reveal(F.col(c), SETTINGS.secret) for c in hidden})


_REPAIRED_EXPOSURES = """SELECT person_id, drug_concept_id, drug_exposure_start_date,
    greatest(drug_exposure_start_date, drug_exposure_end_date) AS drug_exposure_end_date
    FROM exposures"""
_DRUG_KEYS = ["person_id", "drug_concept_id"]


@check(
    "drug_era",
    "SELECT * FROM y_eras",
    {"y_source": _REPAIRED_EXPOSURES}
    | eras("y", "y_source", _DRUG_KEYS, "drug_exposure", fill=False),
)
def drug_era(x: Inputs):
    """Repaired exposures carry both dates, so nothing is left to fill."""
    dates = ["drug_exposure_start_date", "drug_exposure_end_date"]
    exposures = rows.repair_interval(x["exposures"], *dates)
    return intervals.drug_eras(exposures, fill=False)


@check(
    "drug_era_fills",
    "SELECT * FROM z_eras",
    eras("z", "open_exposures", _DRUG_KEYS, "drug_exposure"),
)
def drug_era_fills(x: Inputs):
    return intervals.drug_eras(x["open_exposures"])


@check(
    "condition_era",
    "SELECT * FROM c_eras",
    eras(
        "c", "open_conditions", ["person_id", "condition_concept_id"], "condition",
        person_end=False,
    ),
)
def condition_era(x: Inputs):
    return intervals.condition_eras(x["open_conditions"])


@check(
    "dose_era",
    "SELECT * FROM d_eras",
    {
        "d_source": """SELECT *, coalesce(dose_unit_concept_id, 0) AS unit_concept_id,
            coalesce(TRY_CAST(quantity AS DOUBLE), 1.0) AS dose_value FROM open_exposures"""
    }
    | eras(
        "d", "d_source", [*_DRUG_KEYS, "unit_concept_id", "dose_value"], "drug_exposure",
        dose=True,
    ),
)
def dose_era(x: Inputs):
    return intervals.dose_eras(x["open_exposures"])
