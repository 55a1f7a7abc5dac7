"""Registered queries of the operators in this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import balance, decontaminate, exact, langid, ngram, packing, periods, repair, sharding, simhash, suffix, toxicity, warc
from cohortloom.llm.sql import SQL
from cohortloom.llm.staging import ready, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_histogram_sort(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 23 of nearly equal bytes."""
    placed = sharding.histogram_sort(table(spark, folder, "documents"), 24)
    return placed.select(
        "doc_id", "size", F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def hash_rest(divisor: int) -> Column:
    """Remainder of the crc32 of the document id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query
def op2_class_bigrams(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of all documents, learned from six sevenths of them."""
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", F.coalesce(hash_rest(7) == 2, F.lit(False)).alias("held_out")
    )
    return ngram.train_and_score(docs, ["doc_id", "held_out"], "held_out")


@query
def op3_minimum_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as token pieces in as few sequences of 2048 as minimum bin slack finds."""
    placed = packing.pack(table(spark, folder, "documents"))
    return placed.select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def op4_boosted_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from four fifths of the labelled ones."""
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", F.coalesce(hash_rest(5) == 0, F.lit(False)).alias("held_out")
    )
    labels = table(spark, folder, "labels").where(~F.coalesce(hash_rest(5) == 0, F.lit(False)))
    model = toxicity.train(toxicity.labelled_texts(docs, labels, label="toxic"))
    return model.score(docs, ["doc_id", "held_out"])


@query
def op5_nearest_centroid(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = table(spark, folder, "documents").withColumn("held_out", F.coalesce(hash_rest(4) == 2, F.lit(False)))
    model = langid.train(docs.where("NOT held_out"))
    found = langid.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op6_suffix_sort(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the strings of 200 bytes that start anywhere else, too."""
    found = suffix.remove_repeats(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op7_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    archives = f"{shared_folder(spark)}/archives"
    warc.write_archives(table(spark, folder, "pages"), archives)
    return warc.read_archives(spark, archives).drop("url")


@query
def op8_minhash_containment(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items that documents hold at four fifths of their five-word shingles or more."""
    found = decontaminate.contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "n_shared", "n_shingles", "containment")


@query
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Exact groups of all documents; half of them, by a hash of the id, are the snapshot."""
    docs = table(spark, folder, "documents")
    found = exact.dedup(docs, F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", F.col("size").alias("group_size"), "kept",
        F.col("digest").alias("text_sha256"),
    )


@query
def op10_simhash_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and the components they link."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id",
        "links",
    )


@query
def op11_glr_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, damaged by rule, and their repairs of least cost."""
    repaired = repair.repair(repair.damaged(table(spark, folder, "conversations")))
    return repaired.withColumnRenamed("conv", "conv_id")


@query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in all documents, some of which are made to repeat by rule."""
    return periods.runs(periods.damaged(table(spark, folder, "documents"))).withColumnRenamed("id", "doc_id")


@query
def op13_cube_sampling(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, and how many of their words a mix of the sources to target weights takes."""
    mixed = balance.mix(table(spark, folder, "documents"))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"),
        "source",
    )


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    return dict(SQL)
