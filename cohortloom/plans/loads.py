"""Load stage: mapped table and target state in, rows to append out.

Natural keys arrive and leave in plain text; the pseudonyms of the dimensions are deciphered
for the joins, which takes one cipher call per dimension row instead of one per fact.

Lookups into dimensions are one to one, so the first row of each id can be picked before
them; only joins that drop rows come earlier. The order of the joins keeps the fact table
down to one exchange per key.

What is new is found first and staged; codes, visits, providers and sites are looked up for these
rows alone, so that the extract is read once. A stage gives None where it has found nothing new.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import schema
from cohortloom.functions.keys import reveal
from cohortloom.functions.text import cut, whole_number_text
from cohortloom.operators.joins import (
    join_dimension,
    join_parent,
    join_person,
    keep_first,
    only_new,
    own_or_looked_up,
)
from cohortloom.operators.rows import clamp_period, fill_either
from cohortloom.operators.vocabulary import apply_codes, code_table, used_codes
from cohortloom.plans.settings import Settings
from cohortloom.sources.extracts import INPUT_ORDER
from cohortloom.sources.tables import Tables

# Vocabularies a code is looked for in.
CONDITION_CODES = ["SNOMED", "ICD10CM", "ICD9CM"]
PROCEDURE_CODES, PROCEDURE_SOURCES = ["SNOMED", "CPT4", "HCPCS"], ["SNOMED", "HemOnc", "NAACCR"]
DRUG_CODES = ["RxNorm", "CVX", "RxNorm Extension"]
DRUG_SOURCES = [*DRUG_CODES, "HCPCS", "CPT4", "HemOnc", "NAACCR"]
DETAIL_CODES = ["SNOMED"]
MEASUREMENT_CODES = ["SNOMED", "LOINC"]
OBSERVATION_CODES = ["LOINC", "SNOMED", "MeSH"]

UNREADABLE = "\x00"


def _stored(df: DataFrame, table: str) -> DataFrame:
    """Columns of the stored table, source values cut to their length."""

    def shaped(name: str) -> Column:
        length = schema.field(name).max_length
        if length is None or name in schema.HIDDEN_KEYS:
            return F.col(name)
        return cut(F.col(name), length).alias(name)

    return df.select(*[shaped(c) for c in schema.LOADED[table]])


def _order(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Input order where the scan recorded it, else the declared columns."""
    return [INPUT_ORDER] if INPUT_ORDER in df.columns else list(columns)


def _first_new(df: DataFrame, tables: Tables, table: str, order: Sequence[str]) -> DataFrame:
    """First row of each id that the table does not hold."""
    return tables.only_new(keep_first(df, schema.key_of(table), order), table)


def _dimension(tables: Tables, table: str, settings: Settings, *columns: str) -> DataFrame:
    """Columns of a stored table with its pseudonyms deciphered.

    A null key matches nothing and is left out. A key that this engine did not write becomes
    UNREADABLE, which no cleaned key equals; so the plain key is never null either, else the
    join would test it for null first and decipher it twice.
    """
    hidden = [c for c in schema.HIDDEN_KEYS if c in columns]
    rows = tables.read(table, columns).dropna(subset=hidden)
    plain = {c: F.coalesce(reveal(F.col(c), settings.secret), F.lit(UNREADABLE)) for c in hidden}
    return rows.withColumns(plain)


def _persons(tables: Tables, settings: Settings, *extra: str) -> DataFrame:
    return _dimension(tables, "person", settings, "person_source_value", "person_id", *extra)


def _locations(tables: Tables, settings: Settings) -> DataFrame:
    return _dimension(tables, "location", settings, "location_source_value", "location_id")


def _sites(tables: Tables, settings: Settings) -> DataFrame:
    return _dimension(tables, "care_site", settings, "care_site_source_value", "care_site_id")


def location(mapped: DataFrame, tables: Tables, settings: Settings) -> DataFrame:
    new = _first_new(mapped, tables, "location", _order(mapped, ["city", "county"]))
    return _stored(new, "location")


def person(mapped: DataFrame, tables: Tables, settings: Settings) -> DataFrame | None:
    """New by natural key; a person whose id another one holds already is not stored either."""
    new = tables.stage(only_new(mapped, _persons(tables, settings), "person_source_value"))
    if tables.is_empty(new):
        return None
    placed = own_or_looked_up(
        new, _locations(tables, settings), "location_source_value", "location_id"
    )
    order = _order(mapped, ["birth_datetime", "gender_source_value", "race_source_value"])
    return _stored(_first_new(placed, tables, "person", order), "person")


def death(mapped: DataFrame, tables: Tables, settings: Settings) -> DataFrame:
    dead = join_person(mapped, _persons(tables, settings))
    order = _order(mapped, ["death_datetime", "cause_source_value"])
    return _stored(_first_new(dead, tables, "death", order), "death")


def observation_period(mapped: DataFrame, tables: Tables, settings: Settings) -> DataFrame:
    periods = join_person(
        mapped, _persons(tables, settings, "birth_datetime"), ["birth_datetime"]
    )
    start, end = "observation_period_start_date", "observation_period_end_date"
    periods = clamp_period(periods, start, end, F.col("birth_datetime").cast("date"))
    new = _first_new(periods, tables, "observation_period", _order(mapped, [start, end]))
    return _stored(new, "observation_period")


def care_site(mapped: DataFrame, tables: Tables, settings: Settings) -> DataFrame | None:
    new = tables.stage(_first_new(mapped, tables, "care_site", _order(mapped, ["care_site_name"])))
    if tables.is_empty(new):
        return None
    placed = join_dimension(
        new, _locations(tables, settings), "location_source_value", "location_id"
    )
    return _stored(placed, "care_site")


def provider(mapped: DataFrame, tables: Tables, settings: Settings) -> DataFrame | None:
    new = tables.stage(_first_new(mapped, tables, "provider", _order(mapped, ["provider_source_value"])))
    if tables.is_empty(new):
        return None
    sites = _sites(tables, settings)
    return _stored(
        join_dimension(new, sites, "care_site_source_value", "care_site_id"), "provider"
    )


def _with_provider_and_site(df: DataFrame, tables: Tables, settings: Settings) -> DataFrame:
    sites = _sites(tables, settings)
    df = join_dimension(df, tables.read("provider"), "provider_source_value", "provider_id")
    return join_dimension(df, sites, "care_site_source_value", "care_site_id")


def visit_occurrence(mapped: DataFrame, tables: Tables, settings: Settings) -> DataFrame | None:
    visits = join_person(mapped, _persons(tables, settings)).drop("person_source_value")
    order = ["visit_start_datetime", "visit_end_datetime", "visit_concept_id", "person_id"]
    new = tables.stage(_first_new(visits, tables, "visit_occurrence", order))
    if tables.is_empty(new):
        return None
    return _stored(_with_provider_and_site(new, tables, settings), "visit_occurrence")


def _new_events(
    mapped: DataFrame, tables: Tables, settings: Settings, table: str, order: Sequence[str]
) -> DataFrame:
    """First new row of each id among the known persons, staged."""
    events = join_person(mapped, _persons(tables, settings)).drop("person_source_value")
    return tables.stage(_first_new(events, tables, table, _order(mapped, order)))


def _with_visit(events: DataFrame, tables: Tables) -> DataFrame:
    return join_dimension(
        events, tables.read("visit_occurrence"), "visit_source_value", "visit_occurrence_id"
    )


def _codes(
    events: DataFrame,
    columns: Sequence[str],
    tables: Tables,
    vocabularies: Sequence[str],
    own_vocabularies: Sequence[str] = (),
) -> DataFrame:
    """Ids of the codes that the new rows use.

    Staged, so that the planner knows its size before it plans the joins with the facts: a
    small table is broadcast and the facts stay where they are.
    """
    return tables.stage(
        code_table(
            used_codes(events, *columns),
            tables.read("concept"),
            tables.read("concept_relationship"),
            vocabularies,
            own_vocabularies,
        )
    )


def _coded(
    mapped: DataFrame,
    tables: Tables,
    settings: Settings,
    table: str,
    stem: str,
    dates: Sequence[str],
    vocabularies: Sequence[str],
    sources: Sequence[str],
) -> DataFrame | None:
    """Events with one source code, which gives the concept and the source concept."""
    code = f"{stem}_source_concept_id"
    order = [*dates, code, f"{stem}_source_value", "visit_source_value", "person_id"]
    events = _new_events(mapped, tables, settings, table, order)
    if tables.is_empty(events):
        return None
    ids = _codes(events, [code], tables, vocabularies, sources)
    found = {f"{stem}_concept_id": "concept_id", code: "own_id"}
    return _stored(apply_codes(_with_visit(events, tables), code, ids, found), table)


def condition_occurrence(mapped: DataFrame, tables: Tables, settings: Settings) -> DataFrame | None:
    dates = ["condition_start_datetime", "condition_end_datetime"]
    return _coded(
        mapped, tables, settings, "condition_occurrence", "condition", dates, CONDITION_CODES,
        CONDITION_CODES,
    )


def procedure_occurrence(mapped: DataFrame, tables: Tables, settings: Settings) -> DataFrame | None:
    dates = ["procedure_datetime", "procedure_end_datetime"]
    return _coded(
        mapped, tables, settings, "procedure_occurrence", "procedure", dates, PROCEDURE_CODES,
        PROCEDURE_SOURCES,
    )


def drug_exposure(mapped: DataFrame, tables: Tables, settings: Settings) -> DataFrame | None:
    dates = ["drug_exposure_start_datetime", "drug_exposure_end_datetime"]
    filled = fill_either(mapped, "drug_exposure_start_date", "drug_exposure_end_date")
    return _coded(
        filled, tables, settings, "drug_exposure", "drug", dates, DRUG_CODES, DRUG_SOURCES
    )


def visit_detail(mapped: DataFrame, tables: Tables, settings: Settings) -> DataFrame | None:
    """Details of unknown visits vanish, so that join comes before the first row is picked."""
    concept, source = "visit_detail_concept_id", "visit_detail_source_concept_id"
    admitted = "admitted_from_concept_id"
    mapped = mapped.withColumn(admitted, whole_number_text(F.col(admitted)))
    details = join_person(mapped, _persons(tables, settings)).drop("person_source_value")
    details = join_parent(
        details, tables.read("visit_occurrence"), "visit_source_value", "visit_occurrence_id"
    )
    order = ["visit_detail_start_datetime", "visit_detail_end_datetime", concept, "person_id"]
    details = tables.stage(_first_new(details, tables, "visit_detail", _order(mapped, order)))
    if tables.is_empty(details):
        return None
    columns = [concept, source, admitted]
    ids = _codes(details, columns, tables, DETAIL_CODES, DETAIL_CODES)
    details = apply_codes(details, concept, ids, {concept: "concept_id"})
    details = apply_codes(details, source, ids, {source: "own_id"})
    details = apply_codes(details, admitted, ids, {admitted: "concept_id"})
    return _stored(_with_provider_and_site(details, tables, settings), "visit_detail")


def _observed(
    mapped: DataFrame,
    tables: Tables,
    settings: Settings,
    table: str,
    vocabularies: Sequence[str],
    own_source: bool,
) -> DataFrame | None:
    kind, concept = f"{table}_type_concept_id", f"{table}_concept_id"
    source = f"{table}_source_concept_id"
    order = [
        f"{table}_datetime", source, "value_as_number", "unit_source_value", kind,
        f"{table}_source_value", "visit_source_value", "person_id",
    ]
    events = _new_events(mapped, tables, settings, table, order)
    if tables.is_empty(events):
        return None
    own = vocabularies if own_source else ()
    ids = _codes(events, [kind, concept, source], tables, vocabularies, own)
    events = apply_codes(_with_visit(events, tables), kind, ids, {kind: "concept_id"})
    events = apply_codes(events, concept, ids, {concept: "concept_id"})
    events = apply_codes(events, source, ids, {source: "own_id" if own_source else "concept_id"})
    return _stored(events, table)


def measurement(mapped: DataFrame, tables: Tables, settings: Settings) -> DataFrame | None:
    """All three code columns go through the resolver."""
    return _observed(
        mapped, tables, settings, "measurement", MEASUREMENT_CODES, own_source=False
    )


def observation(mapped: DataFrame, tables: Tables, settings: Settings) -> DataFrame | None:
    """The source code is looked up as it is, the other two go through the resolver."""
    return _observed(
        mapped, tables, settings, "observation", OBSERVATION_CODES, own_source=True
    )
