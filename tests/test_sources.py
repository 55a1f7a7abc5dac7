import random
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import schema, session
from cohortloom.checks.inputs import Inputs
from cohortloom.plans.runs import load_table, spec_for
from cohortloom.sources import extracts, tables
from cohortloom.streaming.follow import follow_extracts


def test_extract_is_text_in_lower_case(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('Id,Zip,Note\n1,00501,"a ""b"", c"\n2,NA,\n3,"",  x \n')
    rows = extracts.read_extract(spark, str(path), input_order=True).orderBy(extracts.INPUT_ORDER)
    assert rows.columns == ["id", "zip", "note", extracts.INPUT_ORDER]
    assert [tuple(r)[:3] for r in rows.collect()] == [
        ("1", "00501", 'a "b", c'), ("2", None, None), ("3", None, "  x "),
    ]


def test_input_order_over_many_splits(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("n\n" + "".join(f"{i:07d}\n" for i in range(60_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        rows = extracts.read_extract(spark, str(path), input_order=True)
        assert rows.rdd.getNumPartitions() > 3
        values = [int(r.n) for r in rows.orderBy(extracts.INPUT_ORDER).select("n").collect()]
        assert values == list(range(60_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_export_skips_empty_names(spark, tmp_path):
    store = tables.ParquetStore(spark, str(tmp_path / "t")).create(["location"])
    row = [(1, "Cork", "a,b", 2, " x ", "h")]
    store.append("location", spark.createDataFrame(row, schema.table_schema("location")))
    (path,) = extracts.export_tables(store, ["location", ""], str(tmp_path / "out"))
    assert path.endswith("location.csv")
    back = extracts.read_extract(spark, path).first()
    assert (back.county, back.country_source_value) == ("a,b", " x ")


@pytest.mark.parametrize("size", ["64", "333", "20000"])
def test_quoted_breaks_by_splits(spark, tmp_path, size):
    """Splits that begin anywhere, in quotes and between doubled ones, give the records of one split."""
    rng, lines = random.Random(4), []
    bits = ["a", "é", '""', "\n", ",", "\r\n", '""""', "\n\n", " ", "word " * 9]
    for i in range(400):
        note = "".join(rng.choice(bits) for _ in range(rng.randrange(9)))
        lines.append(f'{i},"{note}",{rng.choice(["x", "", "NA"])}')
    lines[200] = '200,"' + "line\n" * 300 + '",x'
    for name, rows in (("a.csv", lines[:250]), ("b.csv", lines[250:])):
        (tmp_path / name).write_bytes(("Id,Note,Rest\n" + "\n".join(rows) + "\n").encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = extracts.read_extract(spark, str(tmp_path), multi_line=True, input_order=True)
    expected = sorted(tuple(r)[:3] for r in whole.collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        rows = extracts.read_extract(spark, str(tmp_path), multi_line=True, input_order=True, by_splits=True)
        assert rows.dtypes == whole.dtypes
        found = rows.orderBy(extracts.INPUT_ORDER).collect()
        lines_read = spark.read.text(str(tmp_path))
        assert size == "20000" or lines_read.rdd.getNumPartitions() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(tuple(r)[:3] for r in found) == expected and len(found) == 400
    assert [int(r.id) for r in found] == list(range(400))


def test_one_file_per_table(spark, tmp_path):
    """One header, the parts in order, nothing left beside the file; an empty table is its header."""
    rows = spark.range(0, 1000, 1, 5).select("id", F.concat(F.lit('a "b", '), "id").alias("t"))
    for df, path in ((rows, tmp_path / "one.csv"), (rows.limit(0), tmp_path / "none.csv")):
        extracts.write_one_csv(df, str(path))
        lines = path.read_text().splitlines()
        assert lines[0] == "id,t" and len(lines) == df.count() + 1
        assert not (tmp_path / f"{path.name}.parts").exists()
    assert [line.split(",")[0] for line in (tmp_path / "one.csv").read_text().splitlines()[1:]] == [str(i) for i in range(1000)]
    back = extracts.read_extract(spark, str(tmp_path / "one.csv"))
    assert back.count() == 1000 and back.filter("id = '7'").first().t == 'a "b", 7'


def test_worklist_name(spark, tmp_path):
    report = spark.createDataFrame([("a", 1, 2), ("b", 1, 5)], "source_value string, source_id int, frequency int")
    with pytest.raises(ValueError):
        extracts.write_worklist(report, str(tmp_path), "report.txt")
    path = extracts.write_worklist(report, str(tmp_path), "report.csv")
    assert [r.source_value for r in spark.read.option("header", True).csv(path).collect()] == ["b", "a"]


def test_conform_to_target(spark):
    target = T.StructType(
        [
            T.StructField("a", T.IntegerType()), T.StructField("b", T.VarcharType(2)),
            T.StructField("c", T.DateType()), T.StructField("d", T.BooleanType()),
            T.StructField("e", T.StringType()), T.StructField("gone", T.StringType()),
        ]
    )
    df = spark.createDataFrame(
        [("1.0", "xyz", "2020-01-01", "true", None, None), ("x", None, "bad", None, "e", None)],
        "a string, b string, c string, d string, e string, gone string",
    ).withColumn("extra", F.lit(1))
    out = tables.conform_to(df, target)
    assert out.columns == ["a", "b", "c", "d", "e"]
    first, second = out.collect()
    assert (first.a, first.b, first.d, first.e) == (1, "xy", True, "")
    assert (second.a, second.b, second.c) == (None, "", None)


def test_vocabulary_lives_apart(spark, tmp_path):
    store = tables.ParquetStore(spark, str(tmp_path / "data"), str(tmp_path / "voc")).create()
    source = tmp_path / "CONCEPT.csv"
    source.write_text("concept_id\tconcept_code\tvocabulary_id\tstandard_concept\tname\n"
                      "7\t0012\tSNOMED\tS\tseven\n8\tx\tLOINC\t\teight\n")  # fmt: skip
    tables.load_vocabulary(store, {"concept": str(source)})
    columns = ["concept_id", "concept_code", "vocabulary_id", "standard_concept", "name"]
    got = sorted(map(tuple, store.read("concept", columns).collect()))
    assert got == [(7, "0012", "SNOMED", "S", "seven"), (8, "x", "LOINC", None, "eight")]
    assert (tmp_path / "voc" / "concept").exists() and not (tmp_path / "data" / "concept").exists()


def test_registry():
    assert schema.field("county").max_length == 20
    assert schema.field("race_concept_id").default == 0
    with pytest.raises(ValueError):
        schema.field("nonsense")
    assert len(schema.MAPPED) == 13 and len(schema.LOADED) == 16
    statement = schema.create_statement("location", "cdm", "/x")
    assert "city VARCHAR(50)" in statement and statement.endswith("LOCATION '/x'")
    assert "birth_datetime TIMESTAMP_NTZ" in schema.create_statement("person", "cdm")


def test_files_are_read_by_column_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,city,zip\n1,Cork,T12\n")
    (tmp_path / "b.csv").write_text("ZIP,ID\nF91,2\n")
    for path in (str(tmp_path), [str(tmp_path / "b.csv"), str(tmp_path / "a.csv")]):
        rows = extracts.read_extract(spark, path, input_order=True)
        got = sorted((r.id, r.city, r.zip) for r in rows.collect())
        assert got == [("1", "Cork", "T12"), ("2", None, "F91")]


def test_columns_that_differ_in_case_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,Zip,ID\n1,2,3\n")
    with pytest.raises(ValueError, match="id,Zip,ID"):
        extracts.read_extract(spark, str(tmp_path / "a.csv"))


def test_line_breaks_in_quotes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,note\n1,"one\ntwo"\n2,x\n')
    rows = extracts.read_extract(spark, str(path), multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("1", "one\ntwo"), ("2", "x")]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        extracts.read_extract(spark, str(path)).collect()


def test_vocabulary_keeps_what_it_is_given(spark, tmp_path):
    store = tables.ParquetStore(spark, str(tmp_path / "t")).create()
    source = tmp_path / "strength.csv"
    source.write_text("drug_concept_id\tamount_value\tvalid_start_date\tvalid_end_date\textra\n"
                      "7\t0.5\t20200131\t2099-12-31\tx\n")  # fmt: skip
    tables.load_vocabulary(store, {"drug_strength": str(source), "own_list": str(source)})
    row = store.read("drug_strength").first()
    assert (row.drug_concept_id, row.amount_value, row.extra, row.box_size) == (7, 0.5, "x", None)
    assert (str(row.valid_start_date), str(row.valid_end_date)) == ("2020-01-31", "2099-12-31")
    assert store.read("own_list").first().amount_value == "0.5"


def test_catalog_has_the_declared_types(spark, tmp_path):
    store = tables.ParquetStore(spark, str(tmp_path / "t"), str(tmp_path / "v")).create()
    store.create_catalog("typed_tables")

    def described(table):
        return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE typed_tables.{table}").collect()}

    try:
        for table in [*schema.LOADED, *schema.VOCABULARY]:
            found = described(table)
            declared = schema.declared_schema(table) if table in schema.LOADED else schema.VOCABULARY[table]
            assert found == {f.name: f.dataType.simpleString() for f in declared}
        found = described("person")
        assert found["person_id"] == "bigint" and found["birth_datetime"] == "timestamp_ntz"
        assert found["gender_source_value"] == "varchar(50)"
    finally:
        spark.sql("DROP DATABASE typed_tables CASCADE")


def test_shared_folders_are_removed(spark):
    import os

    with session.scratch(spark):
        kept = session.staged(spark.range(3))
        folder = os.path.dirname(kept.inputFiles()[0].removeprefix("file://"))
        assert kept.count() == 3 and os.path.isdir(folder)
    assert not os.path.isdir(folder)


def test_follow_stores_what_a_batch_run_stores(spark, settings, tmp_path):
    """The same reader serves both: columns by name, missing-value texts, the order of rows."""
    folder = tmp_path / "in"
    folder.mkdir()
    batch = tables.ParquetStore(spark, str(tmp_path / "b")).create(["location"])
    stream = tables.ParquetStore(spark, str(tmp_path / "s")).create(["location"])
    spec = spec_for("location")

    def follow():
        query = follow_extracts(spark, spec, str(folder), stream, settings, str(tmp_path / "cp"))
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted(map(tuple, stream.read("location").collect()), key=str)

    (folder / "a.csv").write_text("id,zip,city,state\n1,F91,n/a,Sligo\n2,F91,Sligo,Connacht\n3,T12,Cork,Munster\n")
    load_table(spec, extracts.read_extract(spark, str(folder), input_order=True), batch, settings)
    expected = sorted(map(tuple, batch.read("location").collect()), key=str)
    assert follow() == expected and len(expected) == 2
    (folder / "b.csv").write_text("state,city,id,zip\nLeinster,Dublin,4,D01\nMunster,Cork,5,T12\n")
    assert len(follow()) == 3
    assert len(follow()) == 3


def test_parts_are_joined_while_the_next_table_is_written(spark, tmp_path, monkeypatch):
    """The driver copies one file after the other; the tasks do not wait for that."""
    frames = {"a": spark.range(3), "b": spark.range(2), "c": spark.range(0)}
    going_on, real = threading.Event(), extracts._copied
    waited = []

    def copied(spark, path, names, header):
        if path.endswith("a.csv"):
            waited.append(going_on.wait(60))
        real(spark, path, names, header)

    def read(table):
        if table == "c":
            going_on.set()
        return frames[table]

    monkeypatch.setattr(extracts, "_copied", copied)
    store = type("Store", (), {"read": staticmethod(read)})
    paths = extracts.export_tables(store, ["a", "b", "", "c"], str(tmp_path), one_file=True)
    assert waited == [True]
    lines = [(tmp_path / p.split("/")[-1]).read_text().splitlines() for p in paths]
    assert [(found[0], sorted(found[1:])) for found in lines] == [("id", ["0", "1", "2"]), ("id", ["0", "1"]), ("id", [])]
    assert not list(tmp_path.glob("*.parts"))


def test_scratches_may_be_nested(spark):
    with session.scratch(spark):
        with session.scratch(spark):
            pass
        kept = session.staged(spark.range(3))
        assert kept.count() == 3
        path = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert not session.exists(spark, path)


def test_events_are_joined_once_for_all_extracts(spark, tmp_path):
    for name, text in {
        "orders": """SELECT CAST(k AS BIGINT) AS o_orderkey, CAST(k % 3 AS BIGINT) AS o_custkey,
            TIMESTAMP_NTZ '1995-01-01 00:00:00' AS o_orderdate FROM VALUES (1), (2), (3), (NULL) AS t(k)""",
        "lineitem": """SELECT CAST(k AS BIGINT) AS l_orderkey, CAST(q AS BIGINT) AS l_partkey, 1 AS l_linenumber,
            CAST(q AS DOUBLE) AS l_quantity, 'A' AS l_returnflag, IF(q = 5, NULL, 'F') AS l_linestatus,
            TIMESTAMP_NTZ '1995-02-01 00:00:00' AS l_shipdate
            FROM VALUES (1, 7), (1, 9), (1, 9), (2, 11), (2, 5), (NULL, 3), (9, 1) AS t(k, q)""",
    }.items():
        spark.sql(text).write.parquet(str(tmp_path / f"{name}.parquet"))
    x = Inputs(spark, str(tmp_path))
    names = ["conditions", "procedures", "medications", "immunizations"]
    for name, rows in x.together(names).items():
        assert rows.dtypes == x[name].dtypes
        assert sorted(map(str, rows.collect())) == sorted(map(str, x[name].collect()))
        assert len(rows.collect()) == 5
        assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in x.together(["conditions"])["conditions"]._jdf.queryExecution().optimizedPlan().toString()
