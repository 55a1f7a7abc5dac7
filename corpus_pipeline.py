"""A corpus pipeline of the text operators: each stage works on what the one before kept.

A stage gets the documents as a table that was written and reread, and all but the last return
its columns. Rows that are equal in every column count as copies of each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import decontaminate, exact, langid, packing, simhash
from cohortloom.llm.staging import keep_rows, ready, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; texts without letters or far off go."""
    model = langid.train(docs)
    # The whole row goes along under one name, so that no column of it can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("text"))
    return langid.identify(rows, model).where("NOT rejected").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space."""
    found = exact.dedup(docs, F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    return keep_rows(docs, found.where("size > 1"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints."""
    return keep_rows(docs, simhash.near_duplicates(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontaminate.contained(docs, items)
    return keep_rows(docs, found.withColumn("kept", F.lit(False)))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents with their sequences and offsets."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


def _ready(function: Stage) -> Stage:
    return lambda spark, docs, sf_dir: function(ready(spark), docs, sf_dir)


STAGES: list[tuple[str, Stage]] = [
    (f.__name__, _ready(f))
    for f in (language_id, exact_dedup, near_dedup, benchmark_decontamination, best_fit_packing)
]

# Trained models, fingerprints and the tokenizer have no form in SQL; tests compare the stages
# with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder."""
    docs = ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
