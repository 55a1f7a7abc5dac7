"""Load stages over a target that an earlier extract has filled, and a whole first load."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom import schema
from cohortloom.checks import table_sql
from cohortloom.checks.inputs import EXTRACTS, Inputs
from cohortloom.checks.registry import SETTINGS, check
from cohortloom.functions.keys import reveal
from cohortloom.functions.parse import coerce_column
from cohortloom.operators import worklist
from cohortloom.plans.runs import SPECS, load_table, new_rows, run_load, spec_for
from cohortloom.session import scratch, shared_folder
from cohortloom.sources import extracts
from cohortloom.sources.tables import ParquetStore

HIDDEN = {
    "location": "location_source_value",
    "person": "person_source_value",
    "care_site": "care_site_source_value",
}


def _vocabulary(x: Inputs) -> dict[str, DataFrame]:
    return {name: x[name] for name in ("concept", "concept_relationship")}


BEFORE_1997 = "coalesce(try_cast(start AS date), try_cast(stop AS date)) < '1997-01-01'"
DIMENSIONS = ("location", "person", "care_site", "provider", "visit_occurrence")
def _dimensions(x: Inputs) -> ParquetStore:
    """A store with the vocabulary and the dimension tables of the data folder loaded."""
    store = ParquetStore(x.spark, shared_folder(x.spark)).create()
    for name, rows in _vocabulary(x).items():
        store.append(name, rows)
    for table in DIMENSIONS:
        spec = spec_for(table)
        store.append(table, new_rows(spec, x[spec.source], store, SETTINGS))
    return store


class _OneTable(ParquetStore):
    """Target tables of their own next to loaded dimensions."""

    def __init__(self, x: Inputs, *targets: str):
        super().__init__(x.spark, shared_folder(x.spark))
        self._targets, self._others = targets, _dimensions(x)
        self.create(targets)

    def read(self, table, columns=None):
        return (super() if table in self._targets else self._others).read(table, columns)


def _second_load(x: Inputs, target: str, source: str, earlier: str) -> DataFrame:
    """New rows of a whole extract, where the target holds its ``earlier`` part already."""
    spec = spec_for(target, source)
    store = _OneTable(x, target)
    store.append(target, new_rows(spec, x[source].filter(earlier), store, SETTINGS))
    rows = new_rows(spec, x[source], store, SETTINGS)
    hidden = HIDDEN.get(target)
    return rows.withColumn(hidden, reveal(F.col(hidden), SETTINGS.secret)) if hidden else rows


@check("load_location", table_sql.location("city = 'BUILDING'"))
def load_location(x: Inputs):
    return _second_load(x, "location", "patients", "city = 'BUILDING'")


@check("load_person", table_sql.person("city = 'BUILDING'"))
def load_person(x: Inputs):
    return _second_load(x, "person", "patients", "city = 'BUILDING'")


@check("load_death", table_sql.death("city = 'BUILDING'"))
def load_death(x: Inputs):
    return _second_load(x, "death", "patients", "city = 'BUILDING'")


@check(
    "load_observation_period",
    table_sql.observation_period("m.pk IN (SELECT pk FROM early_keys)"),
    {
        "early_keys": "SELECT DISTINCT regexp_replace(patient, '[^a-zA-Z0-9]+', '', 'g') AS pk "
        "FROM repaired_early",
        "encounters_early": "SELECT * FROM encounters WHERE start < '1995-06-01'",
        "repaired_early": table_sql.repaired("encounters_early"),
    },
)
def load_observation_period(x: Inputs):
    return _second_load(x, "observation_period", "encounters", "start < '1995-06-01'")


@check("load_care_site", table_sql.care_site("gender = 'M'"))
def load_care_site(x: Inputs):
    return _second_load(x, "care_site", "providers", "gender = 'M'")


@check("load_provider", table_sql.provider("gender = 'M'"))
def load_provider(x: Inputs):
    return _second_load(x, "provider", "providers", "gender = 'M'")


@check("load_visit_occurrence", table_sql.visit_occurrence("visit_concept_id = 9203"))
def load_visit_occurrence(x: Inputs):
    return _second_load(x, "visit_occurrence", "encounters", "encounterclass = 'emergency'")


@check("load_condition", table_sql.condition_occurrence("start < '1995-02-01'"))
def load_condition(x: Inputs):
    earlier = "coalesce(try_cast(start AS date), try_cast(stop AS date)) < '1995-02-01'"
    return _second_load(x, "condition_occurrence", "conditions", earlier)


@check("load_visit_detail", table_sql.visit_detail("start < '1997-01-01'"))
def load_visit_detail(x: Inputs):
    return _second_load(x, "visit_detail", "encounters", BEFORE_1997)


@check("load_procedure", table_sql.procedure_occurrence("start < '1997-01-01'"))
def load_procedure(x: Inputs):
    return _second_load(x, "procedure_occurrence", "procedures", BEFORE_1997)


@check("load_drug", table_sql.drug_exposure("start < '1997-01-01'"))
def load_drug(x: Inputs):
    return _second_load(x, "drug_exposure", "medications", BEFORE_1997)


@check("load_immunization", table_sql.immunization("given < '1997-01-01'"))
def load_immunization(x: Inputs):
    return _second_load(
        x, "drug_exposure", "immunizations", "date < '1997-01-01'"
    )


@check("load_measurement", table_sql.measurement("start < '2024-01-08'"))
def load_measurement(x: Inputs):
    return _second_load(
        x, "measurement", "observations", "date < '2024-01-08'"
    )


@check("load_observation", table_sql.observation("start < '2024-01-08'"))
def load_observation(x: Inputs):
    return _second_load(
        x, "observation", "observations", "date < '2024-01-08'"
    )


# --- eras after a second load ------------------------------------------------------------


def _two_loads(x: Inputs, target: str, source: str, earlier: str, era: str) -> DataFrame:
    """The era table after the earlier part of an extract and then all of it were loaded."""
    store = _OneTable(x, target, era)
    spec = spec_for(target, source)
    spec = dataclasses.replace(spec, eras=(era,))
    for part in (x[source].filter(earlier), x[source], x[source]):
        load_table(spec, part, store, SETTINGS)
    return store.read(era)


_EARLY_CONDITIONS = "coalesce(try_cast(start AS date), try_cast(stop AS date)) < '1995-02-01'"


@check("era_loads_condition", *table_sql.era_loads("condition", "start < '1995-02-01'", _EARLY_CONDITIONS))
def era_loads_condition(x: Inputs):
    return _two_loads(x, "condition_occurrence", "conditions", _EARLY_CONDITIONS, "condition_era")


@check("era_loads_drug", *table_sql.era_loads("drug", "start < '1997-01-01'", BEFORE_1997))
def era_loads_drug(x: Inputs):
    return _two_loads(x, "drug_exposure", "medications", BEFORE_1997, "drug_era")


@check("era_loads_dose", *table_sql.era_loads("dose", "start < '1997-01-01'", BEFORE_1997))
def era_loads_dose(x: Inputs):
    return _two_loads(x, "drug_exposure", "medications", BEFORE_1997, "dose_era")


# --- a first load of everything ------------------------------------------------------------

LOADED_PARTS = {
    "location": "t_location", "person": "t_person", "death": "t_death",
    "observation_period": "t_period", "care_site": "t_site", "provider": "t_provider",
    "visit_occurrence": "t_visit", "condition_occurrence": "t_condition",
    "visit_detail": "t_detail", "procedure_occurrence": "t_procedure",
    "drug_exposure": "t_drug", "measurement": "t_measurement",
    "observation": "t_observation", "condition_era": "x_condition_eras",
    "drug_era": "x_drug_era", "dose_era": "x_dose_era",
}


def _first_load(x: Inputs) -> ParquetStore:
    store = ParquetStore(x.spark, shared_folder(x.spark)).create()
    for name, rows in _vocabulary(x).items():
        store.append(name, rows)
    sources = {spec.source for spec in SPECS}
    with scratch(x.spark):
        run_load(x.together(name for name in EXTRACTS if name in sources), store, SETTINGS)
    return store


_ERA_PARTS = {
    f"x_{prefix}_era": f"""SELECT * FROM x_first{mid}_eras UNION ALL SELECT * FROM x_both{mid}_eras
        WHERE {prefix}_era_id NOT IN (SELECT {prefix}_era_id FROM x_first{mid}_eras)"""
    for prefix, mid in (("drug", ""), ("dose", "_dose"))
}
_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {part}" for t, part in LOADED_PARTS.items()
)


@check("load_counts", _COUNTS, _ERA_PARTS)
def load_counts(x: Inputs):
    """A first load of every extract into stored tables, then the rows of each."""
    store = _first_load(x)
    counts = [
        store.read(table).agg(F.lit(table).alias("table_name"), F.count("*").alias("rows"))
        for table in schema.LOADED
    ]
    total = counts[0]
    for part in counts[1:]:
        total = total.unionByName(part)
    return total


def _row_sql(table: str, part: str, blank_texts: tuple[str, ...] = ()) -> str:
    """One text per row; doubles are compared by a whole number of thousandths.

    ``blank_texts`` are the texts that a file cannot tell from a missing value.
    """
    shown = []
    for c in schema.LOADED[table]:
        kind = schema.field(c).kind
        value = f"CAST(round({c} * 1000) AS HUGEINT)" if kind == "float" else c
        if kind == "datetime":
            value = f"epoch_us({c})"
        elif kind == "str" and blank_texts and c not in schema.HIDDEN_KEYS:
            value = f"CASE WHEN {c} NOT IN ({', '.join(map(repr, blank_texts))}) THEN {c} END"
        shown.append(f"coalesce(CAST({value} AS VARCHAR), '~')")
    return f"SELECT '{table}' AS table_name, {' || chr(31) || '.join(shown)} AS stored FROM {part}"


def _all_rows(*options) -> str:
    rows = " UNION ALL ".join(_row_sql(t, part, *options) for t, part in LOADED_PARTS.items())
    return f"SELECT table_name, stored, count(*) AS times FROM ({rows}) GROUP BY ALL"


def _as_text(frames: dict[str, DataFrame]) -> DataFrame:
    """Every row of every table as one text, pseudonyms revealed, and how often it is there.

    Rows are counted table by table and by their id beside the text. That changes no count, as the id is the first or the last part
    of the text; but a stored table has its buckets by it, so its rows are counted where they are.
    """
    total = None
    for table, df in frames.items():
        shown = []
        for c in schema.LOADED[table]:
            kind = schema.field(c).kind
            value = reveal(F.col(c), SETTINGS.secret) if c in schema.HIDDEN_KEYS else F.col(c)
            if kind == "float":
                value = F.round(value * 1000).cast("decimal(38,0)")
            elif kind == "datetime":
                value = F.unix_micros(value.cast("timestamp"))
            shown.append(F.coalesce(value.cast("string"), F.lit("~")))
        key = schema.key_of(table)
        counted = df.select(key, F.concat_ws("\x1f", *shown).alias("stored")).groupBy(key, "stored").agg(
            F.count("*").alias("times")
        )
        rows = counted.select(F.lit(table).alias("table_name"), "stored", "times")
        total = rows if total is None else total.unionByName(rows)
    return total


@check("load_contents", _all_rows(), _ERA_PARTS)
def load_contents(x: Inputs):
    """A first load of every extract into stored tables, then every row of each as text."""
    store = _first_load(x)
    return _as_text({table: store.read(table) for table in schema.LOADED})


@check("csv_export", _all_rows(extracts.MISSING), _ERA_PARTS)
def csv_export(x: Inputs):
    """All tables of a first load, each written as one file with one header and read back."""
    folder = shared_folder(x.spark)
    paths = extracts.export_tables(_first_load(x), ["", *schema.LOADED], folder, one_file=True)
    frames = {}
    for table, path in zip(schema.LOADED, paths):
        rows = extracts.read_extract(x.spark, path)
        rules = {c: dataclasses.replace(schema.field(c), default=None) for c in rows.columns}
        typed = [F.col(c) if c in schema.HIDDEN_KEYS else coerce_column(F.col(c), r) for c, r in rules.items()]
        frames[table] = rows.select(*[value.alias(c) for value, c in zip(typed, rules)])
    return _as_text(frames)


# --- the work list of a first load -----------------------------------------------------------

_SLOTS = [
    (table, concept, value, source)
    for table in schema.LOADED for concept, (value, source) in worklist.FIELDS.get(table, {}).items()
    if concept in schema.LOADED[table]
]


def _slot_sql(number: int, table: str, concept: str, value: str, source: str) -> str:
    held = schema.LOADED[table]
    return f"""SELECT {f"CAST({value} AS VARCHAR)" if value in held else "''"} AS source_value,
        {f"coalesce({source}, 0)" if source in held else "CAST(0 AS BIGINT)"} AS source_id, {number} AS slot
        FROM {LOADED_PARTS[table]} WHERE {concept} = 0"""


_WORKLIST = f"""SELECT CAST(0 AS BIGINT) AS concept_id,
        CASE WHEN given NOT IN ({", ".join(map(repr, extracts.MISSING))}) THEN given END AS source_value,
        source_id, [{", ".join(repr(s[0]) for s in _SLOTS)}][first_slot] AS table_name,
        [{", ".join(repr(s[1]) for s in _SLOTS)}][first_slot] AS field_type, frequency
    FROM (SELECT source_value AS given, source_id, min(slot) AS first_slot, count(*) AS frequency
        FROM ({" UNION ALL ".join(_slot_sql(i, *s) for i, s in enumerate(_SLOTS, 1))})
        GROUP BY source_value, source_id)"""


@check("worklist_csv", _WORKLIST, _ERA_PARTS)
def worklist_csv(x: Inputs):
    """Codes without a concept in all tables and fields of a first load, as the file a reviewer gets."""
    store, folder = _first_load(x), shared_folder(x.spark)
    report = worklist.unmapped_codes({table: store.read(table) for table in dict.fromkeys(s[0] for s in _SLOTS)})
    extracts.write_worklist(report, folder, "unmapped.csv")
    rows = extracts.read_reviewed(x.spark, folder, "unmapped.csv")
    return rows.withColumns(
        {c: F.col(c).cast("long") for c in ("concept_id", "source_id", "frequency")}
    )
