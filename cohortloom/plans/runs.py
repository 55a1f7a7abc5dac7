"""Table specs and the load run over them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import schema
from cohortloom.functions.keys import id_collisions, pseudonym
from cohortloom.functions.parse import coerce, project
from cohortloom.operators import intervals
from cohortloom.operators.worklist import new_mappings
from cohortloom.plans import entities, loads
from cohortloom.plans.settings import Settings
from cohortloom.session import scratch
from cohortloom.sources.extracts import INPUT_ORDER, read_extract, read_reviewed
from cohortloom.sources.tables import ParquetStore, Tables, conform_vocabulary

MapStage = Callable[[DataFrame, Settings], DataFrame]
LoadStage = Callable[[DataFrame, Tables, Settings], DataFrame | None]


@dataclass(frozen=True)
class EraSpec:
    """A table derived from facts: what it depends on of them, and the eras of that.

    ``spans`` reduces facts to rows (keys, dates, ``_n``) of which those of several loads are together
    those of all facts; ``eras`` takes them with the settings.
    """

    facts: str
    dates: tuple[str, str]
    spans: Callable[[DataFrame], DataFrame]
    eras: Callable[[DataFrame, Settings], DataFrame]


@dataclass(frozen=True)
class TableSpec:
    """One extract into one table; ``eras`` are the tables derived after each load of it.

    ``fields`` defaults to the registry's field list. Any two functions of the given shapes
    make a spec, which is how own tables are added. ``spread`` deals the rows of the extract over
    all cores first: for extracts of few bytes, which are few splits, and much work on each row.
    """

    source: str
    target: str
    map_stage: MapStage
    load_stage: LoadStage
    eras: tuple[str, ...] = ()
    fields: tuple[str, ...] | None = None
    spread: bool = False


ERAS: dict[str, EraSpec] = {
    "condition_era": EraSpec(
        "condition_occurrence", intervals.CONDITION_DATES, intervals.condition_spans,
        lambda spans, settings: intervals.condition_eras(spans, settings.condition_window),
    ),
    "drug_era": EraSpec(
        "drug_exposure", intervals.DRUG_DATES, intervals.drug_spans,
        lambda spans, settings: intervals.drug_eras(spans, settings.drug_window),
    ),
    "dose_era": EraSpec(
        "drug_exposure", intervals.DRUG_DATES, intervals.dose_spans,
        lambda spans, settings: intervals.dose_eras(spans, settings.dose_window),
    ),
}
DRUG_ERAS = ("drug_era", "dose_era")

# In dependency order. One extract may feed several tables and two may feed one.
SPECS: tuple[TableSpec, ...] = (
    TableSpec("patients", "location", entities.location, loads.location, spread=True),
    TableSpec("patients", "person", entities.person, loads.person, spread=True),
    TableSpec("patients", "death", entities.death, loads.death, spread=True),
    TableSpec(
        "encounters", "observation_period", entities.observation_period, loads.observation_period
    ),
    TableSpec("providers", "care_site", entities.care_site, loads.care_site, spread=True),
    TableSpec("providers", "provider", entities.provider, loads.provider, spread=True),
    TableSpec(
        "encounters", "visit_occurrence", entities.visit_occurrence, loads.visit_occurrence
    ),
    TableSpec(
        "conditions",
        "condition_occurrence",
        entities.condition_occurrence,
        loads.condition_occurrence,
        eras=("condition_era",),
    ),
    TableSpec("encounters", "visit_detail", entities.visit_detail, loads.visit_detail),
    TableSpec(
        "procedures",
        "procedure_occurrence",
        entities.procedure_occurrence,
        loads.procedure_occurrence,
    ),
    TableSpec(
        "medications", "drug_exposure", entities.drug_exposure, loads.drug_exposure, DRUG_ERAS
    ),
    TableSpec(
        "immunizations", "drug_exposure", entities.immunization, loads.drug_exposure, DRUG_ERAS
    ),
    TableSpec("observations", "measurement", entities.measurement, loads.measurement),
    TableSpec("observations", "observation", entities.observation, loads.observation),
)


def spec_for(target: str, source: str | None = None) -> TableSpec:
    return next(s for s in SPECS if s.target == target and source in (None, s.source))


def _hide_keys(df: DataFrame, settings: Settings) -> DataFrame:
    keys = [c for c in schema.HIDDEN_KEYS if c in df.columns]
    return df.withColumns({c: pseudonym(F.col(c), settings.secret) for c in keys})


def _plain_rows(spec: TableSpec, extract: DataFrame, settings: Settings) -> DataFrame:
    """Field list in registry types, natural keys still plain.

    Source codes stay text until the load stage has looked them up, unless ``coerce_first``.
    Keys are not cut to a length: a cut pseudonym could not be deciphered again.
    """
    fields = spec.fields or schema.MAPPED[spec.target]
    rows = project(spec.map_stage(extract, settings), fields, keep=(INPUT_ORDER,))
    codes = () if settings.coerce_first else schema.CODE_COLUMNS.get(spec.target, ())
    return coerce(rows, spec.target, skip=[*codes, *schema.HIDDEN_KEYS])


def map_rows(spec: TableSpec, extract: DataFrame, settings: Settings) -> DataFrame:
    """The mapped table, with pseudonyms for the natural keys."""
    return _hide_keys(_plain_rows(spec, extract, settings), settings)


def _new_rows(
    spec: TableSpec, extract: DataFrame, tables: Tables, settings: Settings
) -> DataFrame | None:
    if spec.spread:
        extract = extract.repartition(tables.spark.sparkContext.defaultParallelism)
    found = spec.load_stage(_plain_rows(spec, extract, settings), tables, settings)
    return None if found is None else _hide_keys(found, settings)


def new_rows(
    spec: TableSpec, extract: DataFrame, tables: Tables, settings: Settings
) -> DataFrame:
    """Rows of the extract the target does not hold yet, in the stored shape.

    Facts are joined on plain keys and the much smaller dimensions are deciphered for it;
    what is stored is enciphered last, when only the new rows are left.
    """
    found = _new_rows(spec, extract, tables, settings)
    return schema.empty_table(tables.spark, spec.target) if found is None else found


def _span_columns(table: str, store: ParquetStore) -> T.StructType:
    spec = ERAS[table]
    return spec.spans(schema.empty_table(store.spark, spec.facts)).schema


def _spans_of(table: str, store: ParquetStore, persons: DataFrame) -> DataFrame:
    """Spans that the eras of the given persons depend on.

    Those of the persons, except where some person has no start at all and a fact without any
    date: it takes the median of all starts, so all spans are needed.
    """
    start, end = ERAS[table].dates
    columns = _span_columns(table, store)
    spans = store.spans(table, columns)
    dateless = spans.filter(F.col(start).isNull() & F.col(end).isNull()).select("person_id").distinct()
    if not dateless.isEmpty():
        with_start = spans.filter(F.col(start).isNotNull()).select("person_id")
        if not dateless.dropna().join(with_start, "person_id", "left_anti").isEmpty():
            return spans
    return store.spans(table, columns, persons)


def update_eras(table: str, store: ParquetStore, settings: Settings, load: str, rows: DataFrame) -> None:
    """Bring an era table up to date with the ``rows`` that a load adds to its facts.

    The state of the table gets the spans of these rows; from there on only the state of
    the persons in question is read, not the facts.
    """
    spec = ERAS[table]
    store.put_spans(table, load, spec.spans(rows))
    if settings.rebuild_eras:
        store.replace(table, spec.eras(store.spans(table, _span_columns(table, store)), settings))
        return
    persons = store.stage(rows.select("person_id").dropna().distinct())
    eras = spec.eras(_spans_of(table, store, persons), settings)
    store.append(table, store.only_new(eras, table))


def _begin_state(table: str, store: ParquetStore) -> None:
    """The state of an era table whose facts were stored before there was one."""
    if not store.has_spans(table):
        spec = ERAS[table]
        store.put_spans(table, "first", spec.spans(store.read(spec.facts)))


def _carry_out(spec: TableSpec, store: ParquetStore, settings: Settings, load: str, again: bool = False) -> None:
    """Store the rows of a load that was written down, and what is derived from them.

    Each step may be repeated: rows that are stored already are left out (if this is done
    ``again``), a load's part of a state replaces itself, and eras are compared by id.
    """
    rows = store.logged(spec.target, load)
    store.append(spec.target, store.only_new(rows, spec.target) if again else rows)
    for era in spec.eras:
        update_eras(era, store, settings, load, rows)
    store.finish(spec.target, load)


def load_table(
    spec: TableSpec, extract: DataFrame, store: ParquetStore, settings: Settings
) -> None:
    """Append the new rows of one extract, then bring its era tables up to date.

    Where eras hang on them, new rows are written down first and a load that was interrupted is
    carried out before the next one begins, so a run can simply be repeated: what it has written
    already is no longer new. What was staged meanwhile is removed.
    """
    with scratch(store.spark):
        if spec.eras:
            for load in store.loads_under_way(spec.target):
                _carry_out(spec, store, settings, load, again=True)
            for era in spec.eras:
                _begin_state(era, store)
        rows = _new_rows(spec, extract, store, settings)
        if rows is None and not (spec.eras and settings.rebuild_eras):
            return
        if not spec.eras:
            store.append(spec.target, rows)
            return
        if rows is None:
            rows = schema.empty_table(store.spark, spec.target)
        _carry_out(spec, store, settings, store.log(spec.target, rows))


def run_load(
    extracts: Mapping[str, DataFrame],
    store: ParquetStore,
    settings: Settings,
    specs: Sequence[TableSpec] = SPECS,
) -> None:
    """Load every spec whose extract is given, in order."""
    for spec in specs:
        if spec.source in extracts:
            load_table(spec, extracts[spec.source], store, settings)


def read_extracts(
    spark: SparkSession,
    folder: str,
    specs: Sequence[TableSpec] = SPECS,
    files: Mapping[str, str] | None = None,
    sep: str = ",",
    multi_line: bool = False,
    by_splits: bool = False,
) -> dict[str, DataFrame]:
    """The extract of every spec, with the input order for ``keep_first``.

    An extract is ``<source>.csv`` unless ``files`` names its file; with ``files`` only the
    sources named there are read.
    """
    names = files or {spec.source: f"{spec.source}.csv" for spec in specs}
    return {
        source: read_extract(
            spark, f"{folder.rstrip('/')}/{name}", sep=sep, multi_line=multi_line, input_order=True,
            by_splits=by_splits,
        )
        for source, name in names.items()
    }


def append_reviewed(
    store: ParquetStore, folder: str, file_name: str, sep: str = ","
) -> None:
    """Store the mappings of a reviewed list that are not stored yet, all its columns with them.

    Of rows with the same source concept and description the first in the file counts.
    """
    reviewed = read_reviewed(store.spark, folder, file_name, sep=sep, input_order=True)
    stored = store.read("source_to_concept_map")
    rows = new_mappings(reviewed, stored, [INPUT_ORDER])
    store.append("source_to_concept_map", conform_vocabulary(rows.drop(INPUT_ORDER), "source_to_concept_map"))


def colliding_ids(
    spec: TableSpec, extract: DataFrame, id_column: str, source_column: str, settings: Settings
) -> DataFrame:
    """Surrogate ids of an extract that stand for several source values: what keep-first drops."""
    mapped = spec.map_stage(extract, settings)
    return id_collisions(mapped, id_column, source_column)
