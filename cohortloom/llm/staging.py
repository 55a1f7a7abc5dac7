"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import bitmaps
from cohortloom.session import shared_folder  # noqa: F401  (operators take it from here)

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_PER_BATCH = 1000
# Bits of the map of row keys.
MAP_BITS = 1 << 22


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver did, if it is not installed.

    Batches for Python are kept small: whole texts are long rows, and a batch lies in the memory
    of the executor twice.
    """
    if int(spark.conf.get(BATCH_ROWS)) > TEXTS_PER_BATCH:
        spark.conf.set(BATCH_ROWS, str(TEXTS_PER_BATCH))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
    return spark


def stage(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage and gives the planner its size."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_keys(df: DataFrame) -> list[Column]:
    """128 bits over all columns of a row as ``key_a``, ``key_b``: equal rows are interchangeable."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return [
        F.xxhash64(F.lit(1), *columns).alias("key_a"),
        F.xxhash64(F.lit(2), *columns).alias("key_b"),
    ]


def with_row_keys(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with its row keys under names that its own columns do not bear, and these names."""
    names = ["key_a", "key_b"]
    while set(names) & set(df.columns):
        names = [f"_{n}" for n in names]
    keys = [k.alias(n) for k, n in zip(row_keys(df), names)]
    return df.select("*", *keys), names


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``decided`` (key_a, key_b, kept) drops.

    ``decided`` has a row for every row of the groups in question; other rows stay. Of equal
    rows of which one is kept, one stays: only these are grouped by all columns. A bitmap of
    fixed size keeps rows that cannot be in question out of the join.
    """
    marks = decided.groupBy("key_a", "key_b").agg(F.max("kept").alias("stays"), F.count("*").alias("copies"))
    marks = marks.where("NOT stays OR copies > 1").select(
        F.col("key_a").alias("_mark_a"), F.col("key_b").alias("_mark_b"), F.col("stays").alias("_mark")
    )
    marks = stage(marks, "marks")
    keyed, (a, b) = with_row_keys(docs)
    may = bitmaps.passes(bitmaps.build(marks, "_mark_a", MAP_BITS), F.col(a))
    # One plan at every size: the marks grow with the documents.
    marked = keyed.where(may).join(
        marks.hint("merge"), (F.col(a) == F.col("_mark_a")) & (F.col(b) == F.col("_mark_b")), "left"
    )
    others = keyed.where(~may).unionByName(marked.where("_mark IS NULL").select(*keyed.columns))
    once = marked.where("_mark").select(*docs.columns).dropDuplicates()
    return others.select(*docs.columns).unionByName(once)

