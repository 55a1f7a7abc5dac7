"""Load runs from CSV extracts into stored tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortloom import schema
from cohortloom.checks import table_checks
from cohortloom.functions.keys import pseudonym, surrogate_id
from cohortloom.plans.runs import SPECS, TableSpec, load_table, new_rows, read_extracts, run_load, spec_for
from cohortloom.plans.settings import Settings
from cohortloom.sources.extracts import read_extract
from cohortloom.sources.tables import ParquetStore, Tables

PATIENTS = """Id,BIRTHDATE,DEATHDATE,GENDER,RACE,ETHNICITY,CITY,STATE,ZIP
p-1,1980-01-02,,M,white,hispanic,Cork,Munster,T12
p-2,1990-05-06,2021-03-04,f,Asian,NA,"Dublin, North",Leinster,01234
p-3,never,,M,white,hispanic,Cork,Munster,T12
"""
PROVIDERS = """Id,ORGANIZATION,NAME,GENDER,SPECIALITY,ZIP
d-1,org-1,Dr One,M,GP,T12
d-2,org-1,Dr Two,X,GP,T12
"""
ENCOUNTERS = """Id,START,STOP,PATIENT,ORGANIZATION,PROVIDER,ENCOUNTERCLASS,CODE,DESCRIPTION,REASONCODE,REASONDESCRIPTION
e-1,2020-01-01T08:00:00Z,2020-01-01T09:00:00Z,p-1,org-1,d-1,outpatient,185,Check-up,,
e-2,2020-01-02T08:00:00Z,2020-01-02T09:00:00Z,p-1,org-1,d-2,outpatient,185,Check-up,999.0,Cough
e-3,2020-03-01T08:00:00Z,,p-1,org-9,d-9,unheard,185,Check-up,,
e-4,2020-03-01T08:00:00Z,2020-03-01T07:00:00Z,p-2,org-1,d-1,inpatient,185,Admission,,
e-5,2020-03-01T08:00:00Z,2020-03-01T07:00:00Z,p-3,org-1,d-1,inpatient,185,Admission,,
"""
EVENTS = """START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION
2020-01-01,2020-01-10,p-1,e-1,11,First
2020-01-15,2020-01-20,p-1,e-2,11,Second
2020-03-01,2020-03-10,p-2,e-4,22,Third
2020-03-01,2020-03-10,p-3,e-5,22,Nobody
"""
IMMUNIZATIONS = """DATE,PATIENT,ENCOUNTER,CODE,DESCRIPTION
2020-02-01T00:00:00Z,p-1,e-1,33,Flu
,p-2,e-4,33,Flu
"""
OBSERVATIONS = """DATE,PATIENT,ENCOUNTER,CATEGORY,CODE,DESCRIPTION,VALUE,UNITS
2020-01-01T08:00:00Z,p-1,e-1,laboratory,L1,Glucose,5.5,mg
2020-01-01T08:00:00Z,p-1,,survey,S1,Mood,good,
2020-01-01T08:00:00Z,p-2,e-4,procedure,QOLS,Quality,1,score
,p-2,e-4,laboratory,L1,Glucose,5,mg
"""
CONCEPTS = [
    (1, "11", "SNOMED", "S"), (2, "22", "SNOMED", None), (3, "std", "LOINC", "S"),
    (4, "L1", "LOINC", "S"), (5, "33", "CVX", "S"), (6, "185", "SNOMED", "S"),
    (7, "LP29693-6", "LOINC", "S"), (8, "999", "SNOMED", "S"), (9, "22", "RxNorm", None),
]
LINKS = [(2, 3, "Maps to"), (9, 1, "Maps to"), (2, 1, "Is a")]


@pytest.fixture(scope="module")
def extracts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("extracts")
    texts = {
        "patients": PATIENTS, "providers": PROVIDERS, "encounters": ENCOUNTERS,
        "conditions": EVENTS, "procedures": EVENTS, "medications": EVENTS,
        "immunizations": IMMUNIZATIONS, "observations": OBSERVATIONS,
    }
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    return read_extracts(spark, str(folder))


@pytest.fixture(scope="module")
def loaded(spark, settings, extracts, tmp_path_factory):
    store = ParquetStore(
        spark, str(tmp_path_factory.mktemp("tables")), str(tmp_path_factory.mktemp("vocabulary"))
    ).create()
    concept = "concept_id long, concept_code string, vocabulary_id string, standard_concept string"
    store.append("concept", spark.createDataFrame(CONCEPTS, concept))
    link = "concept_id_1 long, concept_id_2 long, relationship_id string"
    store.append("concept_relationship", spark.createDataFrame(LINKS, link))
    run_load(extracts, store, settings)
    return store


def rows(store, table, *columns):
    return sorted(map(tuple, store.read(table, columns).collect()), key=str)


def key(spark, value, kind):
    return spark.range(1).select(surrogate_id(F.lit(value), kind)).first()[0]


def test_row_counts(loaded):
    counts = {t: loaded.read(t).count() for t in schema.LOADED}
    assert counts == {
        "location": 2, "person": 2, "death": 1, "observation_period": 2, "care_site": 1,
        "provider": 2, "visit_occurrence": 3, "condition_occurrence": 2, "visit_detail": 3,
        "procedure_occurrence": 3, "drug_exposure": 5, "measurement": 1, "observation": 2,
        "condition_era": 2, "drug_era": 4, "dose_era": 4,
    }


def test_keep_first_follows_the_file(loaded):
    """Both providers share a site: the first line gives its name."""
    assert rows(loaded, "care_site", "care_site_name") == [("Dr One",)]
    assert rows(loaded, "location", "city", "county") == [
        ("Cork", "Munster"), ("Dublin, North", "Leinster"),
    ]


def test_person(loaded, spark, settings):
    people = loaded.read("person").orderBy("birth_datetime").collect()
    assert [p.gender_concept_id for p in people] == [8507, 8532]
    assert [p.ethnicity_source_value for p in people] == ["hispanic", None]
    hidden = spark.range(1).select(pseudonym(F.lit("p1"), settings.secret)).first()[0]
    assert people[0].person_source_value == hidden
    assert people[1].location_id == key(spark, "01234", "location")


def test_visits_are_merged(loaded, spark):
    visits = loaded.read("visit_occurrence").orderBy("visit_source_value").collect()
    assert [v.visit_source_value for v in visits] == ["e-1", "e-3", "e-4"]
    assert visits[0].visit_end_datetime == dt.datetime(2020, 1, 2, 9)
    assert visits[0].provider_id == key(spark, "d-1", "provider")
    assert (visits[1].provider_id, visits[1].care_site_id) == (None, None)
    assert visits[2].visit_start_datetime == visits[2].visit_end_datetime


def test_codes(loaded):
    found = rows(
        loaded, "condition_occurrence", "condition_concept_id", "condition_source_concept_id"
    )
    assert found == [(1, 1), (3, 2)]
    assert rows(loaded, "procedure_occurrence", "procedure_concept_id") == [(1,), (1,), (3,)]
    drugs = rows(loaded, "drug_exposure", "drug_concept_id", "drug_source_concept_id")
    assert drugs == [(1, 0), (1, 0), (1, 9), (5, 5), (5, 5)]
    assert rows(
        loaded, "measurement", "measurement_concept_id", "measurement_type_concept_id"
    ) == [(4, 7)]
    assert rows(loaded, "visit_detail", "admitted_from_concept_id", "admitted_from_source_value") == [
        (0, "Unknown")
    ] * 3


def test_absorbed_encounters(loaded, spark):
    """e-2 was merged into e-1: its facts lose their visit, its detail vanishes."""
    drugs = loaded.read("drug_exposure").filter("drug_source_value = 'Second'").first()
    assert drugs.visit_occurrence_id is None
    details = rows(loaded, "visit_detail", "visit_detail_id")
    assert (key(spark, "e-2", "visit_detail"),) not in details


def test_immunization_dates(loaded):
    flu = rows(
        loaded, "drug_exposure", "drug_source_value", "drug_exposure_start_date",
        "drug_exposure_end_date",
    )[1:3]
    assert flu == [("Flu", None, None), ("Flu", dt.date(2020, 2, 1), dt.date(2020, 2, 1))]


def test_second_load_appends_nothing(loaded, extracts, settings):
    before = {t: loaded.read(t).count() for t in schema.LOADED}
    run_load(extracts, loaded, settings)
    assert {t: loaded.read(t).count() for t in schema.LOADED} == before


def test_unknown_persons_have_no_facts(loaded):
    assert loaded.read("drug_exposure").filter("drug_source_value = 'Nobody'").count() == 0


def test_row_grain_ids(spark, extracts, loaded):
    columns = ["patient", "code", "start"]
    fine = Settings(secret="test_key", id_columns={"condition_occurrence": columns})
    spec = spec_for("condition_occurrence")
    tables = Tables(spark, {t: loaded.read(t) for t in ("person", "visit_occurrence")})
    assert new_rows(spec, extracts["conditions"], tables, fine).count() == 3


def test_coerce_first_loses_text_codes(spark, extracts, loaded):
    typed = Settings(secret="test_key", coerce_first=True)
    names = ("person", "visit_occurrence", "concept", "concept_relationship")
    tables = Tables(spark, {t: loaded.read(t) for t in names})
    row = new_rows(spec_for("measurement"), extracts["observations"], tables, typed).first()
    assert (row.measurement_concept_id, row.measurement_type_concept_id) == (0, 0)


def test_rebuild_eras(spark, extracts, loaded):
    settings = Settings(secret="test_key", rebuild_eras=True, drug_window=400)
    load_table(spec_for("drug_exposure"), extracts["medications"], loaded, settings)
    assert loaded.read("drug_era").count() == 4
    assert loaded.read("dose_era").count() == 4


def test_own_spec(spark, extracts, settings, tmp_path):
    """Users add a table by giving two functions and a field list."""
    spec = TableSpec(
        "providers",
        "provider",
        lambda df, _: df.select(F.lit(1).alias("provider_id"), F.col("name").alias("provider_name")),
        lambda mapped, tables, _: mapped.join(
            tables.read("provider", ["provider_id"]), "provider_id", "left_anti"
        ),
        fields=("provider_id", "provider_name"),
    )
    out = new_rows(spec, extracts["providers"], Tables(spark), settings)
    assert out.columns == ["provider_id", "provider_name"] and out.count() == 2


def test_every_source_has_a_spec():
    assert [s.target for s in SPECS][:3] == ["location", "person", "death"]
    assert {s.source for s in SPECS if s.target == "drug_exposure"} == {
        "medications", "immunizations",
    }


def test_settings_from_environment(monkeypatch):
    monkeypatch.setenv("ENCRYPT_KEY", "k")
    monkeypatch.setenv("DRUG_WINDOW", "45")
    monkeypatch.setenv("DOSE_WINDOW", "soon")
    found = Settings.from_environment()
    assert (found.secret, found.drug_window, found.dose_window) == ("k", 45, 30)
    monkeypatch.delenv("ENCRYPT_KEY")
    with pytest.raises(ValueError):
        Settings.from_environment()


def test_missing_extract_fails(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_extract(spark, "/tmp/no/such/extract.csv")


def test_unchanged_extracts_compute_no_eras(loaded, extracts, settings, monkeypatch):
    def fail(*_):
        raise AssertionError("eras were computed")

    monkeypatch.setattr("cohortloom.plans.runs.ERAS", dict.fromkeys(("condition_era", "drug_era", "dose_era"), fail))
    run_load(extracts, loaded, settings)


def test_interrupted_loads_make_up_for_their_eras(spark, settings, extracts, loaded, tmp_path, monkeypatch):
    store = ParquetStore(spark, str(tmp_path)).create()
    for table in ("person", "visit_occurrence", "concept", "concept_relationship"):
        store.append(table, loaded.read(table))
    spec = spec_for("condition_occurrence")
    with monkeypatch.context() as broken:
        broken.setattr("cohortloom.plans.runs.update_eras", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_table(spec, extracts["conditions"], store, settings)
    assert store.read("condition_era").count() == 0
    load_table(spec, extracts["conditions"], store, settings)
    assert rows(store, "condition_era") == rows(loaded, "condition_era")


FACTS_FROM = ("person", "visit_occurrence", "concept", "concept_relationship")


def store_beside(spark, loaded, path, buckets=None):
    """An empty store but for the dimensions and the vocabulary."""
    store = ParquetStore(spark, str(path), buckets=buckets).create()
    for table in FACTS_FROM:
        store.append(table, loaded.read(table))
    return store


@pytest.mark.parametrize("broken", ["append", "put_spans", "finish"])
def test_a_load_that_broke_off_is_carried_out(spark, settings, extracts, loaded, tmp_path, monkeypatch, broken):
    """Wherever it stops, the next run ends with the rows of an uninterrupted one, and nothing twice."""
    store, spec = store_beside(spark, loaded, tmp_path), spec_for("drug_exposure", "medications")
    done = getattr(store, broken)
    with monkeypatch.context() as patch:
        def stop(table, *rest):
            if broken != "append" or table == "drug_era":
                raise ZeroDivisionError
            return done(table, *rest)

        patch.setattr(store, broken, stop)
        if broken == "put_spans":
            patch.setattr("cohortloom.plans.runs._begin_state", lambda *_: None)
        with pytest.raises(ZeroDivisionError):
            load_table(spec, extracts["medications"], store, settings)
    assert store.loads_under_way("drug_exposure") and store.read("drug_exposure").count() == 3
    load_table(spec, extracts["medications"], store, settings)
    whole = store_beside(spark, loaded, tmp_path / "whole")
    load_table(spec, extracts["medications"], whole, settings)
    for table in ("drug_exposure", "drug_era", "dose_era"):
        assert rows(store, table) == rows(whole, table)
    assert store.loads_under_way("drug_exposure") == []


def test_a_half_written_log_is_dropped(spark, settings, extracts, loaded, tmp_path):
    store = store_beside(spark, loaded, tmp_path)
    load = store.log("condition_occurrence", loaded.read("condition_occurrence"))
    (tmp_path / "condition_occurrence-pending" / load / "_SUCCESS").unlink()
    load_table(spec_for("condition_occurrence"), extracts["conditions"], store, settings)
    assert rows(store, "condition_era") == rows(loaded, "condition_era")


def counted(spark, df):
    """The frame, and an accumulator of the rows it hands out over all scans."""
    total = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            total.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), total


@pytest.mark.parametrize("source, target", [
    ("conditions", "condition_occurrence"), ("medications", "drug_exposure"), ("encounters", "visit_detail"),
    ("observations", "measurement"), ("encounters", "visit_occurrence"),
])
def test_a_load_reads_its_extract_once(spark, settings, extracts, loaded, tmp_path, source, target):
    store, spec = store_beside(spark, loaded, tmp_path), spec_for(target, source)
    for table in ("care_site", "provider"):
        store.append(table, loaded.read(table))
    if target == "visit_occurrence":
        store.replace(target, schema.empty_table(spark, target))
    for _ in range(2):
        extract, total = counted(spark, extracts[source])
        load_table(spec, extract, store, settings)
        assert total.value == extracts[source].count()
    assert store.read(target).count() > 0


def ways_to_scans(node, above=()):
    """The operators from the top of a plan to each scan."""
    way = [*above, node.simpleString(1000)]
    nodes = [node.children().apply(i) for i in range(node.children().size())]
    return [w for n in nodes for w in ways_to_scans(n, way)] if nodes else [way]


def test_stored_ids_are_not_moved(spark, settings, extracts, loaded):
    """The anti join reads the buckets of the target in place, whatever the number of shuffle partitions."""

    class Lazy(ParquetStore):
        def stage(self, df):
            return df

        def is_empty(self, df):
            return False

    store = Lazy(spark, loaded._root, loaded._vocabulary)
    before = {n: spark.conf.get(n, None) for n in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for target, partitions in (("death", "3"), ("drug_exposure", "50"), ("visit_detail", "50"), ("measurement", "3")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spec = spec_for(target)
            plan = new_rows(spec, extracts[spec.source], store, settings)._jdf.queryExecution().executedPlan()
            ways = [way for way in ways_to_scans(plan.initialPlan()) if f".{target}_" in way[-1]]
            assert ways
            for way in ways:  # several, as nothing is staged here
                names = [line.split()[0] for line in way]
                join = max(i for i, name in enumerate(names) if name == "SortMergeJoin")
                assert f"{target}_id" in way[join] or "person_id" in way[join]
                assert "Bucketed: true" in way[-1] and "Exchange" not in names[join:]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_eras_read_no_facts(spark, settings, extracts, loaded, tmp_path, monkeypatch):
    """After the first load only the log and the state are read."""
    store, spec = store_beside(spark, loaded, tmp_path), spec_for("condition_occurrence")
    load_table(spec, extracts["conditions"].filter("code = '11'"), store, settings)
    seen, real = [], store.read
    monkeypatch.setattr(store, "read", lambda table, columns=None: seen.append((table, columns)) or real(table, columns))
    load_table(spec, extracts["conditions"], store, settings)
    assert ("condition_occurrence", ["condition_occurrence_id"]) in seen
    assert {c and tuple(c) for t, c in seen if t == "condition_occurrence"} == {("condition_occurrence_id",)}
    assert rows(store, "condition_era") == rows(loaded, "condition_era")


def test_a_small_load_reads_few_files_of_the_state(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path), buckets=16).create(["drug_era", "drug_exposure"])
    spans = spark.range(1000).select(
        F.col("id").alias("person_id"), F.lit(1).cast("long").alias("drug_concept_id"),
        F.lit("2020-01-01").cast("date").alias("drug_exposure_start_date"),
        F.lit("2020-01-02").cast("date").alias("drug_exposure_end_date"), F.lit(1).cast("long").alias("_n"),
    )
    for load in ("first", "b", "b"):
        store.put_spans("drug_era", load, spans)
    some = spark.range(5, 7).toDF("person_id")
    found = store.spans("drug_era", spans.schema, some)
    assert found.count() == 4 and found.columns == spans.columns
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "part#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(store.spans("drug_era", spans.schema).inputFiles()) == 32


@pytest.mark.parametrize("seed", range(2))
def test_eras_after_random_loads(spark, settings, loaded, tmp_path, seed):
    """An extract loaded in random parts, gaps included, leads to the eras of the whole."""
    rng = random.Random(seed)
    lines = []
    for i in range(120):
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(400))
        start = rng.choice([str(day), str(day), ""])
        stop = rng.choice([str(day + dt.timedelta(days=rng.randrange(40))), ""])
        lines.append((start or None, stop or None, rng.choice(["p-1", "p-2"]), f"e{i}", rng.choice(["11", "22"]), "x"))
    everything = spark.createDataFrame(lines, "start string, stop string, patient string, encounter string, code string, description string")
    final = Settings(secret="test_key", rebuild_eras=True)
    spec = spec_for("drug_exposure", "medications")
    whole, parts = (store_beside(spark, loaded, tmp_path / name) for name in ("whole", "parts"))
    load_table(spec, everything, whole, settings)
    cuts = [rng.randrange(3) for _ in lines]
    for k in range(3):
        part = spark.createDataFrame([r for r, c in zip(lines, cuts) if c == k], everything.schema)
        load_table(spec, part, parts, final)
    load_table(spec, everything, parts, final)
    for table in ("drug_exposure", "drug_era", "dose_era"):
        assert rows(parts, table) == rows(whole, table)


def test_a_store_without_buckets_or_state_goes_on(spark, settings, extracts, loaded, tmp_path):
    """Folders filled by plain writes are read as they are, and their facts become the first state."""
    for table in (*FACTS_FROM, "condition_occurrence", "condition_era"):
        loaded.read(table).write.parquet(str(tmp_path / table))
    store = ParquetStore(spark, str(tmp_path))
    before = rows(store, "condition_era")
    load_table(spec_for("condition_occurrence"), extracts["conditions"], store, settings)
    assert rows(store, "condition_era") == before and store.has_spans("condition_era")


def test_foreign_keys_do_not_stop_a_load(spark, settings, extracts, loaded, tmp_path):
    """A plain key, a cut one and one of another secret match nothing, blank keys included."""
    store = ParquetStore(spark, str(tmp_path)).create()
    for table in ("person", "visit_occurrence", "concept", "concept_relationship"):
        store.append(table, loaded.read(table))
    first = loaded.read("person").first().person_source_value
    other = spark.range(1).select(pseudonym(F.lit("p1"), "another secret")).first()[0]
    strange = store.read("person").limit(1)
    for i, value in enumerate(["legacy-key", first[:10], other, ""]):
        row = strange.withColumns({"person_id": F.lit(900 + i).cast("long"), "person_source_value": F.lit(value)})
        store.append("person", row)
    blank = extracts["conditions"].withColumn("patient", F.when(F.col("code") == "22", "").otherwise(F.col("patient")))
    found = new_rows(spec_for("condition_occurrence"), blank, store, settings).collect()
    assert len(found) == 1 and found[0].person_id < 10**9 and found[0].person_id not in range(900, 904)


def test_stored_rows_are_counted_in_their_buckets(spark, tmp_path):
    """Every row of a stored table as text takes no exchange of these rows."""
    store = ParquetStore(spark, str(tmp_path), buckets=3).create(["death", "drug_era"])
    text = "person_id long, death_date date, cause_source_value string"
    dead = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (1, None, "b\x1f1"), (None, None, "a")], text)
    empty = schema.empty_table(spark, "death")
    store.append("death", empty.unionByName(dead, allowMissingColumns=True))
    eras = spark.createDataFrame([(5, 1, 2, None, None), (5, 1, 2, None, None), (6, 1, 2, None, None)], schema.table_schema("drug_era"))
    store.append("drug_era", eras)
    found = table_checks._as_text({t: store.read(t) for t in ("death", "drug_era")})
    assert sorted((r.table_name, r.times) for r in found.collect()) == [
        ("death", 1), ("death", 1), ("death", 2), ("drug_era", 1), ("drug_era", 2),
    ]
    assert len({r.stored for r in found.collect()}) == 5
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
