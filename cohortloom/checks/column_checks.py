"""Projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.checks import expected
from cohortloom.checks.inputs import Inputs
from cohortloom.checks.registry import SETTINGS, check
from cohortloom.checks.sql import cases, clean, lower, sid, ts
from cohortloom.functions import keys, parse, text
from cohortloom.operators.joins import own_or_looked_up
from cohortloom.plans import entities
from cohortloom.plans.runs import map_rows, spec_for
from cohortloom.sources.tables import conform_to


@check(
    "project_fields",
    """SELECT id AS visit_source_value, CAST(NULL AS VARCHAR) AS discharged, patient, start
    FROM (SELECT id, patient, start FROM encounters)""",
)
def project_fields(x: Inputs):
    rows = x["encounters"].withColumnRenamed("id", "visit_source_value")
    return parse.project(rows, ["visit_source_value", "discharged", "patient", "start"])


_RAW_MEASUREMENTS = f"""
    SELECT encounter AS measurement_id, code AS measurement_concept_id,
        date AS measurement_datetime, date AS measurement_date, value AS value_as_number,
        description || ' with a text that goes beyond fifty characters' AS measurement_source_value
    FROM observations"""


@check(
    "schema_coerce",
    f"""SELECT TRY_CAST(measurement_id AS BIGINT) AS measurement_id,
        coalesce(CAST(CASE WHEN regexp_full_match(measurement_concept_id, '[0-9]+')
            THEN measurement_concept_id END AS BIGINT), 0) AS measurement_concept_id,
        {ts("measurement_datetime")} AS measurement_datetime,
        CAST({ts("measurement_date")} AS DATE) AS measurement_date,
        TRY_CAST(value_as_number AS DOUBLE) AS value_as_number,
        substr(measurement_source_value, 1, 50) AS measurement_source_value
    FROM ({_RAW_MEASUREMENTS})""",
)
def schema_coerce(x: Inputs):
    rows = x["observations"].select(
        F.col("encounter").alias("measurement_id"),
        F.col("code").alias("measurement_concept_id"),
        F.col("date").alias("measurement_datetime"),
        F.col("date").alias("measurement_date"),
        F.col("value").alias("value_as_number"),
        F.concat("description", F.lit(" with a text that goes beyond fifty characters")).alias(
            "measurement_source_value"
        ),
    )
    return parse.coerce(rows, "measurement")


@check(
    "catalog_coerce",
    """SELECT TRY_CAST(code AS BIGINT) AS code, substr(coalesce(units, ''), 1, 3) AS units,
        TRY_CAST(value AS DOUBLE) AS value, coalesce(category, '') AS category
    FROM (SELECT CASE WHEN regexp_full_match(code, '[0-9]+') THEN code END AS code, units, value,
        category FROM observations)""",
)
def catalog_coerce(x: Inputs):
    target = T.StructType(
        [
            T.StructField("code", T.IntegerType()),
            T.StructField("units", T.VarcharType(3)),
            T.StructField("value", T.DecimalType(18, 4)),
            T.StructField("category", T.StringType()),
            T.StructField("nothing", T.StringType()),
            T.StructField("elsewhere", T.StringType()),
        ]
    )
    rows = x["observations"].withColumn("nothing", F.lit(None).cast("string"))
    return conform_to(rows, target)


@check(
    "strip_length",
    """SELECT id, substr(reasondescription, 1, 50) AS reasondescription FROM encounters""",
)
def strip_length(x: Inputs):
    reason = text.cut(F.col("reasondescription")).alias("reasondescription")
    return x["encounters"].select("id", reason)


@check("alnum_clean", f"SELECT id, {clean('zip')} AS zip FROM patients")
def alnum_clean(x: Inputs):
    return x["patients"].select("id", text.alnum(F.col("zip")).alias("zip"))


@check(
    "normalize_text",
    f"""SELECT encounter, {lower("category")} AS category,
        upper(trim(coalesce(code, ''))) AS code, {lower("units")} AS units FROM observations""",
)
def normalize_text(x: Inputs):
    return x["observations"].select(
        "encounter",
        text.normalize_lower(F.col("category")).alias("category"),
        text.normalize_upper(F.col("code")).alias("code"),
        text.normalize_lower(F.col("units")).alias("units"),
    )


@check(
    "map_gender",
    f"""SELECT id, CAST({cases(lower("gender"), expected.GENDER, "0")} AS BIGINT)
        AS gender_concept_id FROM patients""",
)
def map_gender(x: Inputs):
    gender = text.lookup_or(text.normalize_lower(F.col("gender")), entities.GENDER, 0)
    return x["patients"].select("id", gender.cast("long").alias("gender_concept_id"))


@check(
    "map_race_ethnicity",
    f"""SELECT id, CAST({cases(lower("race"), expected.RACE, "0")} AS BIGINT) AS race_concept_id,
        CAST({cases(lower("ethnicity"), expected.ETHNICITY, "0")} AS BIGINT)
        AS ethnicity_concept_id FROM patients""",
)
def map_race_ethnicity(x: Inputs):
    race = text.lookup_or(text.normalize_lower(F.col("race")), entities.RACE, 0)
    ethnicity = text.lookup_or(text.normalize_lower(F.col("ethnicity")), entities.ETHNICITY, 0)
    return x["patients"].select(
        "id",
        race.cast("long").alias("race_concept_id"),
        ethnicity.cast("long").alias("ethnicity_concept_id"),
    )


@check(
    "map_visit_class",
    f"""SELECT id, CAST({cases("encounterclass", expected.VISIT_CLASS, "9201")} AS BIGINT)
        AS visit_concept_id FROM encounters""",
)
def map_visit_class(x: Inputs):
    concept = entities.visit_class(F.col("encounterclass"))
    return x["encounters"].select("id", concept.alias("visit_concept_id"))


@check(
    "map_provider_gender",
    f"""SELECT id, CAST({cases("gender", expected.PROVIDER_GENDER)} AS BIGINT)
        AS gender_concept_id FROM providers""",
)
def map_provider_gender(x: Inputs):
    gender = text.lookup(F.col("gender"), entities.PROVIDER_GENDER)
    return x["providers"].select("id", gender.cast("long").alias("gender_concept_id"))


@check(
    "map_passthrough",
    f"SELECT encounter, {cases('code', expected.QUALITY, 'code')} AS code FROM observations",
)
def map_passthrough(x: Inputs):
    code = text.lookup_or_keep(F.col("code"), entities.QUALITY)
    return x["observations"].select("encounter", code.alias("code"))


@check(
    "surrogate_id",
    f"""SELECT encounter, {sid("encounter", "drug_exposure")} AS drug_exposure_id,
        {sid("patient", "condition_occurrence")} AS condition_occurrence_id FROM medications""",
)
def surrogate_id(x: Inputs):
    return x["medications"].select(
        "encounter",
        keys.surrogate_id(F.col("encounter"), "drug_exposure").alias("drug_exposure_id"),
        keys.surrogate_id(F.col("patient"), "condition_occurrence").alias(
            "condition_occurrence_id"
        ),
    )


@check(
    "pseudonym_distinct",
    f"""SELECT count(*) AS rows, count(DISTINCT {clean("patient")}) AS pseudonyms
    FROM encounters""",
)
def pseudonym_distinct(x: Inputs):
    hidden = keys.pseudonym(text.alnum(F.col("patient")), SETTINGS.secret)
    counts = x["encounters"].groupBy(hidden.alias("hidden")).agg(F.count("*").alias("n"))
    return counts.agg(F.sum("n").alias("rows"), F.count("hidden").alias("pseudonyms"))


@check("pseudonym_roundtrip", f"SELECT id, {clean('id')} AS revealed FROM encounters")
def pseudonym_roundtrip(x: Inputs):
    hidden = keys.pseudonym(text.alnum(F.col("id")), SETTINGS.secret)
    return x["encounters"].select("id", keys.reveal(hidden, SETTINGS.secret).alias("revealed"))


@check(
    "birth_parts",
    f"""SELECT id, b AS birth_datetime, CAST(year(b) AS BIGINT) AS year_of_birth,
        CAST(month(b) AS BIGINT) AS month_of_birth, CAST(day(b) AS BIGINT) AS day_of_birth
    FROM (SELECT id, {ts("birthdate")} AS b FROM patients)""",
)
def birth_parts(x: Inputs):
    born = x["patients"].select("id", parse.to_datetime(F.col("birthdate")).alias("b"))
    parts = [
        part("b").cast("long").alias(f"{name}_of_birth")
        for name, part in (("year", F.year), ("month", F.month), ("day", F.day))
    ]
    return born.select("id", F.col("b").alias("birth_datetime"), *parts)


@check(
    "numeric_default",
    """SELECT encounter, coalesce(TRY_CAST(value AS DOUBLE), 0.0) AS value_as_number
    FROM observations""",
)
def numeric_default(x: Inputs):
    value = F.coalesce(parse.to_float(F.col("value")), F.lit(0.0))
    return x["observations"].select("encounter", value.alias("value_as_number"))


@check(
    "first_alias",
    f"""SELECT id, {ts("deathdate")} AS died, cause_of_death AS cause FROM patients
    WHERE {ts("deathdate")} IS NOT NULL""",
)
def first_alias(x: Inputs):
    patients = x["patients"]
    died = text.first_present(patients, entities.DEATH_DATES)
    cause = text.first_present(patients, entities.DEATH_CAUSES)
    rows = patients.select(
        "id", parse.datetime_of(patients, died).alias("died"), F.col(cause).alias("cause")
    )
    return rows.dropna(subset=["died"])


@check(
    "era_id",
    f"""SELECT person_id, drug_concept_id, drug_exposure_start_date, drug_exposure_end_date,
        {sid("CAST(person_id AS VARCHAR) || '_' || CAST(drug_concept_id AS VARCHAR) || '_' || "
             "strftime(drug_exposure_start_date, '%Y-%m-%d') || '_' || "
             "strftime(drug_exposure_end_date, '%Y-%m-%d')", "drug era")} AS drug_era_id
    FROM exposures""",
)
def era_id(x: Inputs):
    dates = ["drug_exposure_start_date", "drug_exposure_end_date"]
    days = [F.date_format(d, "yyyy-MM-dd") for d in dates]
    key = keys.joined_key(F.col("person_id"), F.col("drug_concept_id"), *days)
    era = keys.surrogate_id(key, "drug era").alias("drug_era_id")
    return x["exposures"].select("person_id", "drug_concept_id", *dates, era)


@check(
    "literal_fills",
    f"""SELECT CAST({expected.FROM_RECORD} AS BIGINT) AS visit_detail_type_concept_id,
        coalesce(reasondescription, '{expected.NO_REASON}') AS admitted_from_source_value,
        regexp_replace(coalesce(reasoncode, '0'), '\\.0$', '') AS admitted_from
    FROM encounters""",
)
def literal_fills(x: Inputs):
    return x["encounters"].select(
        F.lit(entities.FROM_RECORD).cast("long").alias("visit_detail_type_concept_id"),
        F.coalesce("reasondescription", F.lit(entities.NO_REASON)).alias(
            "admitted_from_source_value"
        ),
        text.whole_number_text(F.col("reasoncode")).alias("admitted_from"),
    )


@check(
    "no_encounter_fill",
    f"""SELECT patient, coalesce(encounter, '{expected.NO_ENCOUNTER}') AS encounter
    FROM observations""",
)
def no_encounter_fill(x: Inputs):
    filled = F.coalesce("encounter", F.lit(entities.NO_ENCOUNTER))
    return x["observations"].select("patient", filled.alias("encounter"))


_PLACES = f"""SELECT {clean("coalesce(zip, '')")} AS k,
    {sid(clean("coalesce(zip, '')"), "location")} AS lid, city FROM patients"""


@check(
    "person_location",
    f"""SELECT p.id, coalesce(CASE WHEN p.city = 'BUILDING' THEN p.lid END, l.lid) AS location_id
    FROM (SELECT id, {clean("coalesce(zip, '')")} AS k, city,
        {sid(clean("coalesce(zip, '')"), "location")} AS lid FROM patients) p
    LEFT JOIN (SELECT k, min(lid) AS lid FROM ({_PLACES}) GROUP BY k) l
    ON p.k = l.k""",
)
def person_location(x: Inputs):
    patients = x["patients"]
    known = map_rows(spec_for("location"), patients, SETTINGS)
    postcode = text.alnum(F.coalesce("zip", F.lit("")))
    own = F.when(F.col("city") == "BUILDING", keys.surrogate_id(postcode, "location"))
    people = patients.select(
        "id",
        keys.pseudonym(postcode, SETTINGS.secret).alias("location_source_value"),
        own.alias("location_id"),
    )
    placed = own_or_looked_up(people, known, "location_source_value", "location_id")
    return placed.select("id", "location_id")
