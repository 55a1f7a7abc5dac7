"""Map stage: source extract in, columns of the mapped table out.

Each function takes the extract as text columns and returns a lazy frame; columns of the
target that the source cannot give are added as nulls by the projection that follows. The
natural keys are cleaned but still plain here, see ``plans.runs`` for where they are hidden.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.keys import surrogate_id
from cohortloom.functions.parse import datetime_of, number_of
from cohortloom.functions.text import (
    alnum,
    column_or_null,
    first_present,
    float_text,
    lookup,
    lookup_or,
    lookup_or_keep,
    normalize_lower,
)
from cohortloom.operators.intervals import collapse_visits, group_span
from cohortloom.operators.rows import is_measurement, not_before, once, repair_interval
from cohortloom.plans.settings import Settings
from cohortloom.sources.extracts import INPUT_ORDER

# Concept ids of the code lists.
GENDER = {"m": 8507, "male": 8507, "f": 8532, "female": 8532}
RACE = {
    "white": 8527,
    "black": 8516,
    "african american": 8516,
    "asian": 8515,
    "native": 8657,
    "american indian": 8657,
    "alaska native": 8657,
    "hawaiian": 8557,
    "other": 38003613,
}
ETHNICITY = {
    "hispanic": 38003563,
    "hispanic or latino": 38003563,
    "nonhispanic": 38003564,
    "not hispanic or latino": 38003564,
}
PROVIDER_GENDER = {"M": 8507, "F": 8532}
VISIT_CLASS = {
    "inpatient": 9201,
    "outpatient": 9202,
    "wellness": 9202,
    "ambulatory": 38004207,
    "emergency": 9203,
    "urgentcare": 8782,
}
DEFAULT_VISIT = 9201
MEASUREMENT_TYPE = {
    "laboratory": "LP29693-6",
    "vital-signs": "LP30605-7",
    "exam": "LP7801-6",
}
OBSERVATION_TYPE = {"health indicator": "723111000000104"}
QUALITY = {"QOLS": "LP156440-2", "QALY": "273724008", "DALY": "D000087509"}

# Literals the mapped tables are filled with.
COUNTRY, COUNTRY_CONCEPT = "Ireland", 4330438
PLACE_OF_SERVICE, SPECIALTY = 38004446, 4216158
FROM_RECORD, FROM_ENCOUNTERS = 32817, 32827
NO_ENCOUNTER = "3637e207-a102-5065-71b0-7420e18b1b5f"
NO_REASON = "Unknown"
DEATH_DATES = ["deathdate", "death_date", "death_datetime", "deathdatetime"]
DEATH_CAUSES = [
    "cause_of_death",
    "death_cause",
    "deathcause",
    "cause",
    "cause_source_value",
]


def _zip(df: DataFrame) -> Column:
    return alnum(F.coalesce(column_or_null(df, "zip"), F.lit("")))


def _kept(df: DataFrame) -> list[Column]:
    return [F.col(INPUT_ORDER)] if INPUT_ORDER in df.columns else []


def _event_id(table: str, source_type: str, default: str, settings: Settings) -> Column:
    columns = settings.id_columns.get(table, [default])
    text = F.concat_ws("_", *columns) if len(columns) > 1 else F.col(columns[0])
    return surrogate_id(text, source_type, settings.id_space)


def _parsed(df: DataFrame, settings: Settings, *columns: str) -> DataFrame:
    return df.withColumns({c: once(datetime_of(df, c, settings.date_formats)) for c in columns})


def location(patients: DataFrame, settings: Settings) -> DataFrame:
    postcode = _zip(patients)
    return patients.select(
        surrogate_id(postcode, "location", settings.id_space).alias("location_id"),
        column_or_null(patients, "city").alias("city"),
        column_or_null(patients, "state").alias("county"),
        F.lit(COUNTRY_CONCEPT).cast("long").alias("country_concept_id"),
        F.lit(COUNTRY).alias("country_source_value"),
        postcode.alias("location_source_value"),
        *_kept(patients),
    )


def person(patients: DataFrame, settings: Settings) -> DataFrame:
    born = _parsed(patients, settings, "birthdate").dropna(subset=["birthdate"])
    postcode = _zip(patients)
    birth = F.col("birthdate")

    def concept(name: str, values: dict) -> Column:
        text = normalize_lower(column_or_null(patients, name))
        return lookup_or(text, values, 0).cast("long").alias(f"{name}_concept_id")

    sources = [
        column_or_null(patients, name).alias(f"{name}_source_value")
        for name in ("gender", "race", "ethnicity")
    ]
    unmapped = [
        F.lit(0).cast("long").alias(f"{name}_source_concept_id")
        for name in ("gender", "race", "ethnicity")
    ]
    return born.select(
        surrogate_id(F.col("id"), "person", settings.id_space).alias("person_id"),
        concept("gender", GENDER),
        F.year(birth).cast("long").alias("year_of_birth"),
        F.month(birth).cast("long").alias("month_of_birth"),
        F.day(birth).cast("long").alias("day_of_birth"),
        birth.alias("birth_datetime"),
        concept("race", RACE),
        concept("ethnicity", ETHNICITY),
        surrogate_id(postcode, "location", settings.id_space).alias("location_id"),
        alnum(F.col("id")).alias("person_source_value"),
        *sources,
        *unmapped,
        postcode.alias("location_source_value"),
        *_kept(patients),
    )


def death(patients: DataFrame, settings: Settings) -> DataFrame:
    date_column = first_present(patients, DEATH_DATES)
    cause_column = first_present(patients, DEATH_CAUSES)
    if date_column is None:
        died = F.lit(None).cast("timestamp_ntz")
    else:
        died = datetime_of(patients, date_column, settings.date_formats)
    dates = {"_died": once(died)}
    if "birthdate" in patients.columns:
        dates["_born"] = once(datetime_of(patients, "birthdate", settings.date_formats))
    dead = patients.withColumns(dates).dropna(subset=["_died"])
    if "birthdate" in patients.columns:
        dead = dead.filter(not_before(F.col("_died"), F.col("_born")))
    cause = F.lit(None).cast("string") if cause_column is None else F.col(cause_column)

    def given(name: str) -> Column:
        return F.coalesce(column_or_null(patients, name), F.lit("0")).alias(name)

    return dead.select(
        F.col("_died").cast("date").alias("death_date"),
        F.lit(FROM_RECORD).cast("long").alias("death_type_concept_id"),
        F.col("_died").alias("death_datetime"),
        given("cause_concept_id"),
        cause.alias("cause_source_value"),
        given("cause_source_concept_id"),
        alnum(F.col("id")).alias("person_source_value"),
        *_kept(patients),
    )


def observation_period(encounters: DataFrame, settings: Settings) -> DataFrame:
    """One row per patient; the id is computed after the aggregate."""
    spans = _parsed(encounters, settings, "start", "stop").select("patient", "start", "stop")
    spans = repair_interval(spans, "start", "stop").dropna(subset=["patient"])
    return group_span(spans, "patient", "start", "stop").select(
        once(alnum(F.col("patient"))).alias("person_source_value"),
        surrogate_id(F.col("patient"), "observation_period", settings.id_space).alias(
            "observation_period_id"
        ),
        F.col("start").cast("date").alias("observation_period_start_date"),
        F.col("stop").cast("date").alias("observation_period_end_date"),
        F.lit(FROM_ENCOUNTERS).cast("long").alias("period_type_concept_id"),
    )


def care_site(providers: DataFrame, settings: Settings) -> DataFrame:
    site = alnum(F.col("organization"))
    return providers.select(
        surrogate_id(site, "care site", settings.id_space).alias("care_site_id"),
        F.col("name").alias("care_site_name"),
        F.lit(PLACE_OF_SERVICE).cast("long").alias("place_of_service_concept_id"),
        site.alias("care_site_source_value"),
        _zip(providers).alias("location_source_value"),
        *_kept(providers),
    )


def provider(providers: DataFrame, settings: Settings) -> DataFrame:
    return providers.select(
        surrogate_id(F.col("id"), "provider", settings.id_space).alias("provider_id"),
        F.col("gender").alias("gender_source_value"),
        column_or_null(providers, "speciality").alias("specialty_source_value"),
        F.col("name").alias("provider_name"),
        F.col("id").alias("provider_source_value"),
        F.lit(SPECIALTY).cast("long").alias("specialty_concept_id"),
        lookup(F.col("gender"), PROVIDER_GENDER).cast("long").alias("gender_concept_id"),
        alnum(F.col("organization")).alias("care_site_source_value"),
        *_kept(providers),
    )


def visit_class(c: Column) -> Column:
    return lookup_or(c, VISIT_CLASS, DEFAULT_VISIT).cast("long")


def visit_occurrence(encounters: DataFrame, settings: Settings) -> DataFrame:
    """Encounters merged into visits; ids are computed per merged visit."""
    rows = _parsed(encounters, settings, "start", "stop").select(
        F.col("patient"),
        visit_class(F.col("encounterclass")).alias("visit_concept_id"),
        "start",
        "stop",
        "id",
        "provider",
        "organization",
        *_kept(encounters),
    )
    rows = repair_interval(rows, "start", "stop").withColumn("patient", once(alnum("patient")))
    order = [INPUT_ORDER] if INPUT_ORDER in encounters.columns else None
    visits = collapse_visits(
        rows,
        ["patient", "visit_concept_id"],
        "start",
        "stop",
        "id",
        first_of=["provider", "organization"],
        gap_days=settings.visit_gap,
        order=order,
    )
    return visits.select(
        surrogate_id(F.col("id"), "visit occurrence", settings.id_space).alias(
            "visit_occurrence_id"
        ),
        "visit_concept_id",
        F.col("start").cast("date").alias("visit_start_date"),
        F.col("start").alias("visit_start_datetime"),
        F.col("stop").cast("date").alias("visit_end_date"),
        F.col("stop").alias("visit_end_datetime"),
        F.col("patient").alias("person_source_value"),
        F.lit(FROM_ENCOUNTERS).cast("long").alias("visit_type_concept_id"),
        F.col("id").alias("visit_source_value"),
        F.col("provider").alias("provider_source_value"),
        alnum(F.col("organization")).alias("care_site_source_value"),
    )


def _dated(df: DataFrame, settings: Settings, stem: str) -> tuple[DataFrame, list[Column]]:
    """Repaired interval rows and the four date columns made of them."""
    rows = repair_interval(_parsed(df, settings, "start", "stop"), "start", "stop")
    start, stop = F.col("start"), F.col("stop")
    first = stem if stem == "procedure" else f"{stem}_start"
    return rows, [
        start.cast("date").alias(f"{first}_date"),
        start.alias(f"{first}_datetime"),
        stop.cast("date").alias(f"{stem}_end_date"),
        stop.alias(f"{stem}_end_datetime"),
    ]


def _event_columns(df: DataFrame, stem: str) -> list[Column]:
    """Columns conditions, procedures and drugs have in common."""
    return [
        once(alnum(F.col("patient"))).alias("person_source_value"),
        F.col("description").alias(f"{stem}_source_value"),
        F.col("code").alias(f"{stem}_source_concept_id"),
        F.col("encounter").alias("visit_source_value"),
        F.lit(FROM_RECORD).cast("long").alias(f"{stem}_type_concept_id"),
        *_kept(df),
    ]


def condition_occurrence(conditions: DataFrame, settings: Settings) -> DataFrame:
    rows, dates = _dated(conditions, settings, "condition")
    table = "condition_occurrence"
    event_id = _event_id(table, table, "patient", settings)
    return rows.select(
        event_id.alias(f"{table}_id"),
        *dates,
        *_event_columns(conditions, "condition"),
    )


def procedure_occurrence(procedures: DataFrame, settings: Settings) -> DataFrame:
    rows, dates = _dated(procedures, settings, "procedure")
    table = "procedure_occurrence"
    event_id = _event_id(table, table, "encounter", settings)
    return rows.select(
        event_id.alias(f"{table}_id"),
        *dates,
        *_event_columns(procedures, "procedure"),
    )


def drug_exposure(medications: DataFrame, settings: Settings) -> DataFrame:
    rows, dates = _dated(medications, settings, "drug_exposure")
    event_id = _event_id("drug_exposure", "drug_exposure", "encounter", settings)
    return rows.select(
        event_id.alias("drug_exposure_id"),
        *dates,
        *_event_columns(medications, "drug"),
    )


def immunization(immunizations: DataFrame, settings: Settings) -> DataFrame:
    """Single date, open end; a row without a date is kept."""
    given = datetime_of(immunizations, "date", settings.date_formats)
    event_id = _event_id("immunization", "immunization_exposure", "encounter", settings)
    return immunizations.select(
        event_id.alias("drug_exposure_id"),
        given.cast("date").alias("drug_exposure_start_date"),
        given.alias("drug_exposure_start_datetime"),
        F.lit(None).cast("date").alias("drug_exposure_end_date"),
        F.lit(None).cast("timestamp_ntz").alias("drug_exposure_end_datetime"),
        *_event_columns(immunizations, "drug"),
    )


def visit_detail(encounters: DataFrame, settings: Settings) -> DataFrame:
    rows, dates = _dated(encounters, settings, "visit_detail")
    return rows.select(
        _event_id("visit_detail", "visit_detail", "id", settings).alias("visit_detail_id"),
        once(alnum(F.col("patient"))).alias("person_source_value"),
        column_or_null(encounters, "code").alias("visit_detail_concept_id"),
        column_or_null(encounters, "description").alias("visit_detail_source_value"),
        column_or_null(encounters, "code").alias("visit_detail_source_concept_id"),
        *dates,
        F.col("id").alias("visit_source_value"),
        F.col("provider").alias("provider_source_value"),
        F.lit(FROM_RECORD).cast("long").alias("visit_detail_type_concept_id"),
        alnum(F.col("organization")).alias("care_site_source_value"),
        column_or_null(encounters, "reasoncode").alias("admitted_from_concept_id"),
        F.coalesce(column_or_null(encounters, "reasondescription"), F.lit(NO_REASON)).alias(
            "admitted_from_source_value"
        ),
        *_kept(encounters),
    )


def _observed(
    observations: DataFrame, settings: Settings, measurements: bool, stem: str, types: dict
) -> DataFrame:
    """Measurement or observation rows of the one extract that holds both."""
    value = F.col("_value")
    rows = observations.withColumns(
        {
            "_value": once(F.coalesce(number_of(observations, "value"), F.lit(0.0))),
            "encounter": F.coalesce("encounter", F.lit(NO_ENCOUNTER)),
            "date": once(datetime_of(observations, "date", settings.date_formats)),
        }
    )
    chosen = is_measurement(F.col("category"), F.col("code"), value, F.col("units"))
    rows = rows.filter(chosen if measurements else ~chosen).dropna(subset=["date"])
    source_type = "obser_measurement" if measurements else "observation"
    return rows.select(
        _event_id(stem, source_type, "encounter", settings).alias(f"{stem}_id"),
        once(alnum(F.col("patient"))).alias("person_source_value"),
        F.col("date").alias(f"{stem}_datetime"),
        F.col("date").cast("date").alias(f"{stem}_date"),
        lookup_or(normalize_lower(F.col("category")), types, "0").alias(
            f"{stem}_type_concept_id"
        ),
        F.col("description").alias(f"{stem}_source_value"),
        F.col("code").alias(f"{stem}_source_concept_id"),
        lookup_or_keep(F.col("code"), QUALITY).alias(f"{stem}_concept_id"),
        value.alias("value_as_number"),
        float_text(value).alias("value_source_value"),
        F.col("encounter").alias("visit_source_value"),
        F.col("units").alias("unit_source_value"),
        *_kept(observations),
    )


def measurement(observations: DataFrame, settings: Settings) -> DataFrame:
    return _observed(observations, settings, True, "measurement", MEASUREMENT_TYPE)


def observation(observations: DataFrame, settings: Settings) -> DataFrame:
    return _observed(observations, settings, False, "observation", OBSERVATION_TYPE)
