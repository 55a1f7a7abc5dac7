"""Registry of the mapped and loaded tables (CDM v5.4 subset).

A column's type follows from its name; only the exceptions are written down.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # int, float, date, datetime or str
    default: int | None = None
    max_length: int | None = None


# Lengths that do not follow the 50-character rule for source values.
LENGTHS = {"city": 50, "county": 20, "care_site_name": 255, "provider_name": 255}
NUMBERS = {"value_as_number", "dose_value"}


def field(name: str) -> Field:
    """Type, default and length a column name stands for."""
    if name in NUMBERS:
        return Field(name, "float")
    if name.endswith("_concept_id"):
        return Field(name, "int", default=0)
    if name.endswith("_id") or name.endswith("_of_birth"):
        return Field(name, "int")
    if name.endswith("_datetime"):
        return Field(name, "datetime")
    if name.endswith("_date"):
        return Field(name, "date")
    if name.endswith("_source_value") or name in LENGTHS:
        return Field(name, "str", max_length=LENGTHS.get(name, 50))
    raise ValueError(f"no type rule for column {name!r}")


def _columns(text: str) -> tuple[str, ...]:
    return tuple(text.split())


# Field list of each mapped table, in output order.
MAPPED: dict[str, tuple[str, ...]] = {
    "location": _columns(
        "location_id city county country_concept_id country_source_value location_source_value"
    ),
    "person": _columns(
        "person_id gender_concept_id year_of_birth month_of_birth day_of_birth birth_datetime "
        "race_concept_id ethnicity_concept_id location_id provider_id care_site_id "
        "person_source_value gender_source_value gender_source_concept_id race_source_value "
        "race_source_concept_id ethnicity_source_value ethnicity_source_concept_id "
        "location_source_value"
    ),
    "death": _columns(
        "death_date death_type_concept_id death_datetime cause_concept_id cause_source_value "
        "cause_source_concept_id person_source_value"
    ),
    "observation_period": _columns(
        "person_source_value observation_period_id observation_period_start_date "
        "observation_period_end_date period_type_concept_id"
    ),
    "care_site": _columns(
        "care_site_id care_site_name place_of_service_concept_id care_site_source_value "
        "location_source_value"
    ),
    "provider": _columns(
        "provider_id gender_source_value specialty_source_value provider_name "
        "provider_source_value specialty_concept_id gender_concept_id care_site_source_value"
    ),
    "visit_occurrence": _columns(
        "visit_occurrence_id visit_concept_id visit_start_date visit_start_datetime "
        "visit_end_date visit_end_datetime person_source_value visit_type_concept_id "
        "visit_source_value provider_source_value care_site_source_value"
    ),
    "condition_occurrence": _columns(
        "condition_occurrence_id person_source_value condition_start_date "
        "condition_start_datetime condition_end_date condition_end_datetime "
        "condition_source_value condition_source_concept_id visit_source_value "
        "condition_type_concept_id"
    ),
    "visit_detail": _columns(
        "visit_detail_id person_source_value visit_detail_concept_id visit_detail_source_value "
        "visit_detail_source_concept_id visit_detail_start_date visit_detail_start_datetime "
        "visit_detail_end_date visit_detail_end_datetime visit_source_value "
        "provider_source_value visit_detail_type_concept_id care_site_source_value "
        "admitted_from_concept_id admitted_from_source_value"
    ),
    "procedure_occurrence": _columns(
        "procedure_occurrence_id person_source_value procedure_date procedure_datetime "
        "procedure_end_date procedure_end_datetime procedure_type_concept_id "
        "procedure_source_value procedure_source_concept_id visit_source_value"
    ),
    "drug_exposure": _columns(
        "drug_exposure_id person_source_value drug_exposure_start_date "
        "drug_exposure_start_datetime drug_exposure_end_date drug_exposure_end_datetime "
        "drug_source_value drug_source_concept_id visit_source_value drug_type_concept_id"
    ),
    "measurement": _columns(
        "measurement_id person_source_value measurement_datetime measurement_date "
        "measurement_type_concept_id measurement_source_value measurement_source_concept_id "
        "measurement_concept_id value_as_number value_source_value visit_source_value "
        "unit_source_value"
    ),
    "observation": _columns(
        "observation_id person_source_value observation_datetime observation_date "
        "observation_type_concept_id observation_source_value observation_source_concept_id "
        "observation_concept_id visit_source_value value_as_number value_source_value "
        "unit_source_value"
    ),
}

# Natural keys that are stored as pseudonyms, in whichever table they appear.
HIDDEN_KEYS = ("person_source_value", "care_site_source_value", "location_source_value")

# Columns that hold a source code until the load stage has looked it up.
CODE_COLUMNS: dict[str, tuple[str, ...]] = {
    "condition_occurrence": ("condition_source_concept_id",),
    "procedure_occurrence": ("procedure_source_concept_id",),
    "drug_exposure": ("drug_source_concept_id",),
    "visit_detail": (
        "visit_detail_concept_id",
        "visit_detail_source_concept_id",
        "admitted_from_concept_id",
    ),
    "measurement": (
        "measurement_type_concept_id",
        "measurement_source_concept_id",
        "measurement_concept_id",
    ),
    "observation": (
        "observation_type_concept_id",
        "observation_source_concept_id",
        "observation_concept_id",
    ),
}

# Natural key of the mapped table -> id that replaces it when the row is loaded.
_RESOLVED = {
    "death": {"person_source_value": "person_id"},
    "observation_period": {"person_source_value": "person_id"},
    "care_site": {"location_source_value": "location_id"},
    "provider": {"care_site_source_value": "care_site_id"},
    "visit_occurrence": {
        "person_source_value": "person_id",
        "provider_source_value": "provider_id",
        "care_site_source_value": "care_site_id",
    },
    "visit_detail": {
        "person_source_value": "person_id",
        "visit_source_value": "visit_occurrence_id",
        "provider_source_value": "provider_id",
        "care_site_source_value": "care_site_id",
    },
}
_EVENT = {"person_source_value": "person_id", "visit_source_value": "visit_occurrence_id"}
# Concept column the load stage adds from the resolved source code.
_ADDED = {
    "condition_occurrence": "condition_concept_id",
    "procedure_occurrence": "procedure_concept_id",
    "drug_exposure": "drug_concept_id",
}


def _loaded(table: str) -> tuple[str, ...]:
    replaced = _RESOLVED.get(table, _EVENT if table in CODE_COLUMNS else {})
    names = [replaced.get(c, c) for c in MAPPED[table]]
    if table == "person":
        names.remove("location_source_value")
    if table in _ADDED:
        names.append(_ADDED[table])
    return tuple(names)


# Columns of each stored table.
LOADED: dict[str, tuple[str, ...]] = {table: _loaded(table) for table in MAPPED} | {
    "condition_era": _columns(
        "condition_era_id person_id condition_concept_id condition_era_start_date "
        "condition_era_end_date"
    ),
    "drug_era": _columns(
        "drug_era_id person_id drug_concept_id drug_era_start_date drug_era_end_date"
    ),
    "dose_era": _columns(
        "dose_era_id person_id drug_concept_id unit_concept_id dose_value "
        "dose_era_start_date dose_era_end_date"
    ),
}


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


_ID, _TEXT, _DAY, _REAL = T.LongType(), T.StringType(), T.DateType(), T.DoubleType()
_VALID = (("valid_start_date", _DAY), ("valid_end_date", _DAY), ("invalid_reason", _TEXT))
# Dates in delivered vocabulary files besides the ISO form.
VOCABULARY_DATES = ("yyyyMMdd",)

# The vocabulary tables of the common data model, kept apart from the data tables.
VOCABULARY: dict[str, T.StructType] = {
    "concept": _struct(
        ("concept_id", _ID), ("concept_name", _TEXT), ("domain_id", _TEXT),
        ("vocabulary_id", _TEXT), ("concept_class_id", _TEXT), ("standard_concept", _TEXT),
        ("concept_code", _TEXT), *_VALID,
    ),
    "vocabulary": _struct(
        ("vocabulary_id", _TEXT), ("vocabulary_name", _TEXT), ("vocabulary_reference", _TEXT),
        ("vocabulary_version", _TEXT), ("vocabulary_concept_id", _ID),
    ),
    "domain": _struct(("domain_id", _TEXT), ("domain_name", _TEXT), ("domain_concept_id", _ID)),
    "concept_class": _struct(
        ("concept_class_id", _TEXT), ("concept_class_name", _TEXT),
        ("concept_class_concept_id", _ID),
    ),
    "relationship": _struct(
        ("relationship_id", _TEXT), ("relationship_name", _TEXT), ("is_hierarchical", _TEXT),
        ("defines_ancestry", _TEXT), ("reverse_relationship_id", _TEXT),
        ("relationship_concept_id", _ID),
    ),
    "concept_relationship": _struct(
        ("concept_id_1", _ID), ("concept_id_2", _ID), ("relationship_id", _TEXT), *_VALID
    ),
    "concept_synonym": _struct(
        ("concept_id", _ID), ("concept_synonym_name", _TEXT), ("language_concept_id", _ID)
    ),
    "concept_ancestor": _struct(
        ("ancestor_concept_id", _ID), ("descendant_concept_id", _ID),
        ("min_levels_of_separation", _ID), ("max_levels_of_separation", _ID),
    ),
    "drug_strength": _struct(
        ("drug_concept_id", _ID), ("ingredient_concept_id", _ID), ("amount_value", _REAL),
        ("amount_unit_concept_id", _ID), ("numerator_value", _REAL),
        ("numerator_unit_concept_id", _ID), ("denominator_value", _REAL),
        ("denominator_unit_concept_id", _ID), ("box_size", _ID), *_VALID,
    ),
    "source_to_concept_map": _struct(
        ("source_code", _TEXT), ("source_concept_id", _ID), ("source_vocabulary_id", _TEXT),
        ("source_code_description", _TEXT), ("target_concept_id", _ID),
        ("target_vocabulary_id", _TEXT), *_VALID,
    ),
}

SPARK_TYPES: dict[str, T.DataType] = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "str": T.StringType(),
}


def mapped_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, SPARK_TYPES[field(c).kind]) for c in MAPPED[table]])


def table_schema(table: str) -> T.StructType:
    """Schema of a stored table, vocabulary included."""
    if table in VOCABULARY:
        return VOCABULARY[table]
    return T.StructType([T.StructField(c, SPARK_TYPES[field(c).kind]) for c in LOADED[table]])


def declared_schema(table: str) -> T.StructType:
    """Stored schema with the declared text lengths as VARCHAR(n)."""

    def declared(name: str) -> T.StructField:
        rule = field(name)
        kind = T.VarcharType(rule.max_length) if rule.max_length else SPARK_TYPES[rule.kind]
        return T.StructField(name, kind)

    return T.StructType([declared(c) for c in LOADED[table]])


def key_of(table: str) -> str:
    """The id that a load compares with what is stored already."""
    return "person_id" if table in ("death", "observation_period") else LOADED[table][0]


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], table_schema(table))


def create_statement(table: str, database: str, location: str | None = None) -> str:
    """CREATE TABLE for one table of the registry."""
    if table in VOCABULARY:
        columns = [f"{f.name} {f.dataType.simpleString().upper()}" for f in VOCABULARY[table]]
    else:
        columns = [
            f"{f.name} {f.dataType.simpleString().upper()}" for f in declared_schema(table)
        ]
    where = f" LOCATION '{location}'" if location else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {database}.{table} ({', '.join(columns)}) "
        f"USING parquet{where}"
    )
