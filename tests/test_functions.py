import re
import uuid

import pytest
from hypothesis import HealthCheck, given, settings as hyp, strategies as st
from pyspark.sql import functions as F

from cohortloom.functions import keys, parse, text
from cohortloom.session import tune


def one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    return df.select(expression(F.col("c")).alias("r")).first().r


@pytest.mark.parametrize("source", ["p1", "", "é", "a b-c", "x" * 200])
@pytest.mark.parametrize("modulus", [10**9, 10**18, 97])
def test_surrogate_id_equals_uuid5(spark, source, modulus):
    expected = uuid.uuid5(uuid.uuid5(uuid.NAMESPACE_DNS, "person"), source).int % modulus
    assert one(spark, source, lambda c: keys.surrogate_id(c, "person", modulus)) == expected


def test_reveal_deciphers_once(spark):
    df = spark.sql("SELECT concat('x', id) AS c FROM range(3)")
    plan = df.select(keys.reveal(F.col("c"), "secret").alias("r"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aesDecrypt") == 1


def test_surrogate_id_known_value(spark):
    assert one(spark, "p1", lambda c: keys.surrogate_id(c, "person")) == 42662595
    assert one(spark, None, lambda c: keys.surrogate_id(c, "person")) is None
    with pytest.raises(ValueError):
        keys.surrogate_id(F.lit("x"), "person", 10**19)


def test_pseudonym_known_value(spark):
    assert one(spark, "p1", lambda c: keys.pseudonym(c, "test_key")) == "lNZpXUJFO_M818F3JrY-Ng=="
    assert one(spark, "p-1", lambda c: keys.pseudonym(c, "test_key")) == "lNZpXUJFO_M818F3JrY-Ng=="


@hyp(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("abcXYZ019", max_size=70), min_size=1, max_size=40))
def test_pseudonym_round_trip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    hidden = keys.pseudonym(F.col("c"), "secret")
    rows = df.select("c", hidden.alias("h"), keys.reveal(hidden, "secret").alias("r")).collect()
    assert all(row.c == row.r for row in rows)
    assert len({row.h for row in rows}) == len(set(values))


def test_id_collisions(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "c")], "id long, s string")
    assert [tuple(r) for r in keys.id_collisions(df, "id", "s").collect()] == [(1, 2)]


@pytest.mark.parametrize(
    "value, expected",
    [("12", 12), ("12.0", 12), ("12.7", None), (" 5 ", 5), ("NaN", None), ("inf", None),
     ("x", None), (None, None), ("9223372036854775807", 9223372036854775807)],
)
def test_to_int(spark, value, expected):
    assert one(spark, value, parse.to_int) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2020-01-01", "2020-01-01 00:00:00"),
        ("2020-01-01T10:11:12Z", "2020-01-01 10:11:12"),
        ("2020-01-01T10:11:12+02:00", "2020-01-01 08:11:12"),
        ("2020-01-01 10:11:12.5", "2020-01-01 10:11:12.5"),
        ("31/12/2020", "2020-12-31 00:00:00"),
        ("soon", None),
        (None, None),
    ],
)
def test_to_datetime(spark, value, expected):
    parsed = lambda c: parse.to_datetime(c, ["dd/MM/yyyy"]).cast("string")
    assert one(spark, value, parsed) == expected


def test_coerce_applies_type_default_and_length(spark):
    df = spark.createDataFrame(
        [("7", "x", "c" * 60, "y" * 30, None)],
        "location_id string, country_concept_id string, city string, county string, "
        "location_source_value string",
    )
    row = parse.coerce(df, "location").first()
    assert (row.location_id, row.country_concept_id) == (7, 0)
    assert (len(row.city), len(row.county), row.location_source_value) == (50, 20, None)


def test_project_adds_missing_columns_in_list_order(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    out = parse.project(df, ["z", "x"])
    assert out.columns == ["z", "x"] and tuple(out.first()) == (None, "a")


def test_text_helpers(spark):
    assert one(spark, " \tMale ", lambda c: text.lookup_or(text.normalize_lower(c), {"male": 1}, 0)) == 1
    assert one(spark, "O'Neil-7_x", text.alnum) == "ONeil7x"
    assert one(spark, "zz", lambda c: text.lookup_or_keep(c, {"QOLS": "LP"})) == "zz"
    assert one(spark, "12.0", text.whole_number_text) == "12"
    assert one(spark, None, text.whole_number_text) == "0"
    assert one(spark, 25000000.0, text.float_text, "double") == "25000000.0"
    assert one(spark, 5.0, text.float_text, "double") == "5.0"


@pytest.mark.parametrize("value", [
    0.0, -0.0, 5.0, 0.0005, 0.0001, 0.00001, 1.5e-7, 12345678.5, 25000000.0, 1e15, 9999999999999998.0,
    1e16, 1.25e20, 1e300, -0.00025, -3e7, 0.1, 1234.5678, float("nan"), float("inf"), float("-inf"),
])
def test_float_text_is_that_of_python(spark, value):
    assert one(spark, value, text.float_text, "double") == repr(value)


# Line breaks, a NUL, a supplementary character, letters of other scripts, characters with a meaning in expressions.
ODD_TEXTS = ["pt-12", "a b\tc\r\nd", "x\x00y", "\U0001f600a\u00e9\u00df\u0130Z", "$1\\[]^-%", "---", "", None, "12.0", "12.0\n", "12.0\r\n", "1.0.0", ".0", "nan"]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("value", ODD_TEXTS)
def test_cleaned_texts_equal_those_of_expressions(spark, value):
    cleaned = None if value is None else re.sub("[^a-zA-Z0-9]+", "", value)
    assert one(spark, value, text.alnum) == cleaned
    number = {None: "0", "nan": "0", "12.0": "12", "12.0\n": "12\n", "12.0\r\n": "12\r\n", "1.0.0": "1.0", ".0": ""}.get(value, value)
    assert one(spark, value, text.whole_number_text) == number


def test_keys_are_cleaned_without_regular_expressions(spark):
    df = spark.createDataFrame([("p-1",)], "c string")
    shown = df.select(text.alnum(F.col("c")).alias("a"), text.alnum("c").alias("b"), keys.pseudonym(F.col("c"), "k").alias("h"))
    assert "regexp" not in plan_of(shown)


def test_generated_code_that_is_never_compiled_is_not_used(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, "65535")
    assert tune(spark).conf.get(name) == "8000"
