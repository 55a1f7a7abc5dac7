"""Plans that have to hold when one key carries a large part of the rows."""

import re

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import intervals, joins, vocabulary
from cohortloom.plans.runs import _plain_rows, new_rows, spec_for
from cohortloom.plans.settings import Settings
from cohortloom.sources.tables import Tables

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.files.maxPartitionBytes": "1MB",
}


@pytest.fixture
def skewed(spark):
    before = {name: spark.conf.get(name, None) for name in SKEW}
    for name, value in SKEW.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def facts(spark, rows=120_000):
    """A third of the rows shares one key, and another part has none."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")))
    )
    payload = F.sha2(F.col("id").cast("string"), 256)
    return spark.range(0, rows, 1, 8).select("id", key.alias("key"), payload.alias("payload"))


def dimension(spark):
    ids = spark.range(5000).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.col("id").alias("value")
    )
    return ids.unionByName(spark.sql("SELECT 'hot' AS key, 77L AS value"))


@pytest.mark.parametrize("join", [joins.join_dimension, joins.join_parent])
def test_hot_key_is_split(skewed, join):
    joined = join(facts(skewed), dimension(skewed), "key", "value")
    assert "skew=true" in final_plan(joined)
    expected = 120_000 if join is joins.join_dimension else facts(skewed).dropna().count()
    assert joined.count() == expected


def test_hot_person_is_split(skewed):
    people = dimension(skewed).toDF("person_source_value", "person_id")
    rows = facts(skewed).withColumnRenamed("key", "person_source_value")
    assert "skew=true" in final_plan(joins.join_person(rows, people))


def test_hot_code_is_split(skewed):
    table = dimension(skewed).toDF("concept_code", "concept_id").groupBy("concept_code").agg(
        F.min("concept_id").alias("concept_id")
    )
    coded = vocabulary.apply_codes(facts(skewed), "key", table, {"concept": "concept_id"})
    assert "skew=true" in final_plan(coded)
    assert coded.count() == 120_000


def test_hot_person_with_gaps_is_split(skewed):
    rows = facts(skewed, 240_000).select(
        F.when(F.col("key") == "hot", 1).otherwise(F.col("id")).alias("p"),
        F.when(F.col("id") % 2 == 0, F.date_add(F.lit("2020-01-01"), (F.col("id") % 900).cast("int"))).alias("s"),
        F.date_add(F.lit("2020-01-01"), (F.col("id") % 900).cast("int")).alias("e"),
        "payload",
    )
    filled = intervals.fill_from_group(rows, "p", "s", "e")
    assert "skew=true" in final_plan(filled)


def test_keep_first_reduces_before_the_shuffle(spark):
    plan = joins.keep_first(facts(spark), "key", ["id"])._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan") :]
    assert re.search(r"Exchange hashpartitioning\(key.*partial_min", physical, re.S)
    assert "Window" not in physical


def test_eras_need_no_person_join_for_complete_rows(spark):
    rows = spark.range(10).select(
        F.col("id").alias("person_id"),
        F.lit(1).cast("long").alias("drug_concept_id"),
        F.lit("2020-01-01").cast("date").alias("drug_exposure_start_date"),
        F.lit("2020-01-02").cast("date").alias("drug_exposure_end_date"),
    )
    plan = intervals.drug_eras(rows, fill=False)._jdf.queryExecution().toString()
    assert "Join" not in plan[plan.index("Physical Plan") :]


@pytest.mark.parametrize("partitions", ["1", "37"])
def test_same_eras_under_any_partitioning(spark, partitions):
    rows = spark.range(3000).select(
        (F.col("id") % 11).alias("person_id"),
        (F.col("id") % 3).alias("drug_concept_id"),
        F.date_add(F.lit("2020-01-01"), (F.hash("id") % 1500).cast("int")).alias("drug_exposure_start_date"),
    ).withColumn("drug_exposure_end_date", F.date_add("drug_exposure_start_date", 4))
    expected = sorted(map(tuple, intervals.drug_eras(rows, window=3).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert sorted(map(tuple, intervals.drug_eras(rows, window=3).collect())) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_small_extracts_are_mapped_by_all_cores(spark):
    """A file of few bytes is one split, however much there is to compute of each row."""
    columns = ("zip", "city", "state", "gender", "race", "ethnicity")
    patients = spark.range(0, 40, 1, 1).select(
        F.concat(F.lit("p"), "id").alias("id"), F.lit("1970-01-01").alias("birthdate"),
        *[(F.col("id") % 7).cast("string").alias(c) for c in columns],
    )
    dealt = f"RoundRobinPartitioning({spark.sparkContext.defaultParallelism})"
    for table, rows in (("location", 7), ("person", 40)):
        df = new_rows(spec_for(table), patients, Tables(spark), Settings(secret="s"))
        assert dealt in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == rows


def test_filters_do_not_parse_again(spark):
    """Dates are parsed and keys cleaned once a row, not for a filter as well."""
    text = "patient string, encounter string, code string, description string, start string, stop string"
    columns = text.replace(" string", "").split(", ")
    rows = spark.createDataFrame([("p-1", "e", "c", "d", "2020-01-01", None), ("p-1", "e", "c", "d", "x", None)], text)
    rows = rows.select(*[F.concat(c, F.lit("")).alias(c) for c in columns])
    mapped = _plain_rows(spec_for("condition_occurrence"), rows, Settings(secret="s"))
    kept = mapped.filter(F.col("person_source_value").isNotNull())
    assert [r.condition_end_date.isoformat() for r in kept.collect()] == ["2020-01-01"]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert filters and not [line for line in filters if "translate" in line or "cast" in line]


def test_equal_eras_are_not_multiplied(spark):
    """Many equal facts give one era, so no row for each of them is made on the way."""
    rows = spark.range(50).select(
        F.lit(1).cast("long").alias("person_id"),
        F.lit(1).cast("long").alias("drug_concept_id"),
        F.lit("2020-06-01").cast("date").alias("drug_exposure_start_date"),
        F.lit("2020-01-01").cast("date").alias("drug_exposure_end_date"),
    )
    eras = intervals.drug_eras(rows, window=3)
    assert "sequence(" not in eras._jdf.queryExecution().optimizedPlan().toString()
    assert [r.drug_era_end_date.isoformat() for r in eras.collect()] == ["2020-01-01"]
