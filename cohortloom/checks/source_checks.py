"""Reading and writing: CSV extracts, stored tables, vocabulary."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom import schema
from cohortloom.checks import table_sql
from cohortloom.checks.inputs import Inputs
from cohortloom.checks.registry import SETTINGS, check
from cohortloom.functions import parse
from cohortloom.functions.keys import reveal
from cohortloom.operators.intervals import collapse_visits
from cohortloom.operators.joins import keep_first
from cohortloom.plans.runs import append_reviewed, load_table, map_rows, spec_for
from cohortloom.session import shared_folder
from cohortloom.sources import extracts
from cohortloom.sources.tables import ParquetStore, load_vocabulary


@check(
    "csv_scan",
    """SELECT id, nullif(gender, '') AS gender, race, ethnicity, birthdate,
        nullif(deathdate, 'n/a') AS deathdate, cause_of_death, zip, city, state FROM patients""",
)
def csv_scan(x: Inputs):
    folder = shared_folder(x.spark)
    patients = x["patients"]
    extracts.write_csv(patients.toDF(*[c.upper() for c in patients.columns]), folder)
    return extracts.read_extract(x.spark, folder)


def _shown(df, column: str):
    return df.withColumn(column, reveal(F.col(column), SETTINGS.secret))


@check(
    "append_roundtrip",
    f"""SELECT * FROM ({table_sql.location("city <> 'BUILDING'")}) UNION ALL BY NAME
    SELECT * FROM (WITH m_location AS (SELECT * FROM m_location WHERE city <> 'BUILDING')
        {table_sql.location()})""",
)
def append_roundtrip(x: Inputs):
    """Two loads of growing extracts: the second appends only what the first lacks."""
    store = ParquetStore(x.spark, shared_folder(x.spark)).create(["location"])
    spec = spec_for("location")
    for part in (x["patients"].filter("city <> 'BUILDING'"), x["patients"], x["patients"]):
        load_table(spec, part, store, SETTINGS)
    return _shown(store.read("location"), "location_source_value")


@check(
    "csv_reordered",
    "SELECT id, remark, rank, CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN author END AS author FROM remarks",
)
def csv_reordered(x: Inputs):
    """Two files with their columns in another order, one of them without a column."""
    folder = shared_folder(x.spark)
    even = x["remarks"].filter("CAST(id AS BIGINT) % 2 = 0").select("RANK", "ID", "AUTHOR", "REMARK")
    odd = x["remarks"].filter("CAST(id AS BIGINT) % 2 = 1").select("remark", "id", "rank")
    paths = [f"{folder}/even", f"{folder}/odd"]
    for rows, path in zip((even, odd), paths):
        extracts.write_csv(rows, path)
    rows = extracts.read_extract(x.spark, paths, multi_line=True)
    return rows.select("id", "remark", "rank", "author")


@check("csv_quoted_breaks", "SELECT id, remark, rank, author FROM remarks")
def csv_quoted_breaks(x: Inputs):
    folder = shared_folder(x.spark)
    extracts.write_csv(x["remarks"], folder)
    return extracts.read_extract(x.spark, folder, multi_line=True)


@check("csv_quoted_splits", "SELECT id, remark, rank, author FROM remarks")
def csv_quoted_splits(x: Inputs):
    """The same remarks as one file, which is read in several splits."""
    path = f"{shared_folder(x.spark)}/remarks.csv"
    extracts.write_one_csv(x["remarks"], path)
    return extracts.read_extract(x.spark, path, multi_line=True, by_splits=True)


@check(
    "csv_keep_first",
    """SELECT author, id, rank FROM remarks
    QUALIFY row_number() OVER (PARTITION BY author ORDER BY CAST(rank AS BIGINT), CAST(id AS BIGINT)) = 1""",
)
def csv_keep_first(x: Inputs):
    """The first row of a key by its place in the file, which no column of it gives."""
    folder = shared_folder(x.spark)
    ordered = x["remarks"].orderBy(F.col("rank").cast("long"), F.col("id").cast("long"))
    extracts.write_csv(ordered.select("author", "id", "rank"), folder)
    rows = extracts.read_extract(x.spark, folder, input_order=True)
    first = keep_first(rows, "author", [extracts.INPUT_ORDER])
    return first.drop(extracts.INPUT_ORDER)


@check(
    "csv_visit_ties",
    """SELECT patient, visit_concept_id, min(start) AS start, max(stop) AS stop,
        first(id ORDER BY rn) AS id
    FROM (SELECT *, sum(CASE WHEN floor((epoch_us(start) - epoch_us(before)) / 86400000000.0) > 1
            THEN 1 ELSE 0 END) OVER (PARTITION BY patient, visit_concept_id ORDER BY rn) AS visit
        FROM (SELECT *, lag(stop) OVER (PARTITION BY patient, visit_concept_id ORDER BY rn) AS before
            FROM (SELECT *, row_number() OVER (PARTITION BY patient, visit_concept_id
                    ORDER BY CAST(start AS DATE), place) AS rn FROM day_stays)))
    GROUP BY patient, visit_concept_id, visit""",
    {
        "day_stays": """SELECT event_id AS id, person_id AS patient, CAST(9201 AS BIGINT) AS visit_concept_id,
            date_trunc('day', start) AS start, date_trunc('day', greatest(start, coalesce(stop, start))) AS stop,
            event_id * 7919 % 1000003 AS place
        FROM stays"""
    },
)
def csv_visit_ties(x: Inputs):
    """Visits of stays that begin on the same day: the file says which comes first."""
    folder = shared_folder(x.spark)
    stays = x["stays"].select(
        F.col("event_id").alias("id"),
        F.col("person_id").alias("patient"),
        F.date_trunc("day", "start").cast("timestamp_ntz").alias("start"),
        F.date_trunc("day", F.greatest("start", F.coalesce("stop", "start"))).cast("timestamp_ntz").alias("stop"),
    )
    extracts.write_csv(stays.orderBy(F.col("id") * 7919 % 1000003), folder)
    rows = extracts.read_extract(x.spark, folder, input_order=True)
    typed = rows.select(
        F.col("id").cast("long").alias("id"),
        F.col("patient").cast("long").alias("patient"),
        F.lit(9201).cast("long").alias("visit_concept_id"),
        *[parse.to_datetime(F.col(c)).alias(c) for c in ("start", "stop")],
        extracts.INPUT_ORDER,
    )
    keys = ["patient", "visit_concept_id"]
    return collapse_visits(typed, keys, "start", "stop", "id", order=[extracts.INPUT_ORDER])


# Delivered vocabulary tables as text: every column of every table, dates as they are delivered.
def _delivered(table: str) -> str:
    """The delivered text of one table, made of the given parts."""
    columns = []
    for i, f in enumerate(schema.VOCABULARY[table], 1):
        kind = f.dataType.simpleString()
        if kind == "bigint":
            value = f"CAST(p_partkey * {i} + p_size AS STRING)"
        elif kind == "double":
            value = f"CAST(CAST(p_size AS DOUBLE) / {2 ** (i % 4)} AS STRING)"
        elif kind == "date":
            value = f"replace(CAST(DATE '19{70 + i}-01-01' + p_size AS STRING), '-', '')"
        else:
            value = f"p_brand || '-{i} ' || p_name"
        columns.append(f"CASE WHEN (p_partkey + {i}) % 11 = 0 THEN NULL ELSE {value} END AS {f.name}")
    return f"SELECT {', '.join(columns)}, p_type AS house_column FROM {{part}}"


def _vocabulary_text(table: str) -> str:
    shown = []
    for f in schema.VOCABULARY[table]:
        kind = f.dataType.simpleString()
        value = f.name
        if kind == "double":
            value = f"CAST(CAST({f.name} AS DOUBLE) * 1000 AS BIGINT)"
        elif kind == "date":
            value = f"substr({f.name}, 1, 4) || '-' || substr({f.name}, 5, 2) || '-' || substr({f.name}, 7, 2)"
        shown.append(f"coalesce(CAST({value} AS VARCHAR), '~')")
    source = _delivered(table).replace("{part}", "part")
    return f"""SELECT '{table}' AS table_name, house_column,
        {" || chr(31) || ".join(shown)} AS stored FROM ({source})"""


@check(
    "vocab_load",
    " UNION ALL ".join(map(_vocabulary_text, schema.VOCABULARY))
    + " UNION ALL SELECT 'house_list', p_type, p_name FROM part",
)
def vocab_load(x: Inputs):
    """All vocabulary tables with all columns, further columns and a table of the house's own."""
    folder = shared_folder(x.spark)
    store = ParquetStore(x.spark, f"{folder}/data", f"{folder}/vocabulary")
    store.create(list(schema.VOCABULARY))
    part = x.table("part")
    files = {}
    for table in schema.VOCABULARY:
        files[table] = f"{folder}/{table}.csv"
        extracts.write_csv(x.spark.sql(_delivered(table), part=part), files[table], sep="\t")
    files["house_list"] = f"{folder}/house_list.csv"
    own = part.select(F.col("p_type").alias("house_column"), F.col("p_name").alias("stored"))
    extracts.write_csv(own, files["house_list"], sep="\t")
    load_vocabulary(store, files)
    total = store.read("house_list").select(F.lit("house_list").alias("table_name"), "house_column", "stored")
    for table, columns in schema.VOCABULARY.items():
        shown = []
        for f in columns:
            value = F.col(f.name)
            if f.dataType.simpleString() == "double":
                value = (value * 1000).cast("long")
            shown.append(F.coalesce(value.cast("string"), F.lit("~")))
        rows = store.read(table).select(
            F.lit(table).alias("table_name"), "house_column", F.concat_ws("\x1f", *shown).alias("stored")
        )
        total = total.unionByName(rows)
    return total


@check(
    "stcm_roundtrip",
    """SELECT * FROM fresh
    UNION ALL SELECT * FROM fresh WHERE source_concept_id IS NULL OR source_code_description IS NULL
    UNION ALL SELECT source_code, source_concept_id, source_code_description, target_concept_id, NULL
    FROM source_to_concept_map""",
    {"fresh": """SELECT source_code, source_concept_id, lower(source_code_description) AS source_code_description,
        target_concept_id, note FROM (
        SELECT *, 'note ' || source_code AS note, CAST(source_code AS BIGINT) * 7919 % 2003 AS place
        FROM reviewed_map) r
    WHERE NOT EXISTS (SELECT 1 FROM source_to_concept_map m
        WHERE m.source_concept_id = r.source_concept_id
        AND lower(m.source_code_description) = lower(r.source_code_description))
    QUALIFY row_number() OVER (PARTITION BY source_concept_id, lower(source_code_description)
        ORDER BY place, CAST(source_code AS BIGINT)) = 1"""},
)
def stcm_roundtrip(x: Inputs):
    """A reviewed list as a file, in an order of its own, appended to stored mappings twice.

    The second time nothing is new but the pairs with a null, which equal no stored one.
    """
    folder = shared_folder(x.spark)
    store = ParquetStore(x.spark, f"{folder}/data").create(["source_to_concept_map"])
    store.append("source_to_concept_map", x["source_to_concept_map"])
    number = F.col("source_code").cast("long")
    reviewed = x["reviewed_map"].withColumn("note", F.concat(F.lit("note "), "source_code"))
    extracts.write_csv(reviewed.orderBy(number * 7919 % 2003, number), f"{folder}/reviewed.csv")
    for _ in range(2):
        append_reviewed(store, folder, "reviewed.csv")
    return store.read("source_to_concept_map").select(
        "source_code", "source_concept_id", "source_code_description", "target_concept_id", "note"
    )


@check(
    "target_scan",
    "SELECT person_id, pk AS person_source_value, birth_datetime FROM m_person",
)
def target_scan(x: Inputs):
    store = ParquetStore(x.spark, shared_folder(x.spark)).create(["person"])
    spec = spec_for("person")
    store.append("person", map_rows(spec, x["patients"], SETTINGS))
    people = store.read("person", ["person_id", "person_source_value", "birth_datetime"])
    return _shown(people, "person_source_value")
