"""Benchmark items inside documents by size-partitioned MinHash containment search.

Items are partitioned by size (distinct shingles, powers of two). The sketch of an item is its
n - ceil(t n) + 1 least shingle hashes: a document that holds the share t of the n shingles
misses too few to miss the whole sketch, so no document is lost. A document is sketched for each
size class by the hashes up to that class's largest sketch value; a bitmap of fixed size per
class tells which of them can belong to an item. What remains is joined on the hash, and each
candidate pair is verified by counting exact, textual shingles.

Shingles are SHINGLE words of the text in lower case (A-Z); a text of fewer words is one
shingle. Nulls and texts without words hold nothing and are held by nothing. Repeated documents
and items each have their own rows if they differ in any column; equal rows share one. Empty
tables give no rows. Only ids and texts are read besides row keys, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm import bitmaps, tokens
from cohortloom.llm.simhash import shingle_spans
from cohortloom.llm.staging import row_keys, stage

SHINGLE = 5
CONTAINMENT = 0.8
# Bits of the map of one size class; collisions only let more hashes through to the join.
MAP_BITS = 1 << 20


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
    """(row, hash, first word, last word, word starts, word ends) of the shingles of lower-cased rows."""
    starts, ends, rows = tokens.words(data, offsets)
    hashes = tokens.hash_words(data, starts, ends)
    first, last = shingle_spans(rows, size)
    n = last - first + 1
    out = n.astype(np.uint64)
    for k in range(size):
        inside = first + k <= last
        word = hashes[np.minimum(first + k, last)]
        out = np.where(inside, tokens.mix(out * np.uint64(0x9E3779B97F4A7C15) + word), out)
    return (rows[first] if len(first) else first), out, first, last, starts, ends


def _texts(data: np.ndarray, first, last, starts, ends) -> list[str]:
    raw = data.tobytes()
    return [
        b" ".join(raw[starts[w] : ends[w]] for w in range(a, b + 1)).decode() for a, b in zip(first.tolist(), last.tolist())
    ]


SHINGLES = "id {}, key_a long, key_b long, hash long, shingle string"


def _shingle_batches(hits=None):
    """Distinct shingles of each row; with ``hits`` (hash -> bool) those of rows with a hit in the sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, data, offsets in tokens.text_blocks(batch.column("text")):
                data = tokens.lower(data)
                row, hashes, first, last, starts, ends = shingle_hashes(data, offsets)
                if hits is not None:
                    sketched, held = hits(hashes)
                    with_hit = np.zeros(len(offsets), bool)
                    with_hit[row[sketched]] = True
                    keep = held & with_hit[row]
                    row, hashes, first, last = row[keep], hashes[keep], first[keep], last[keep]
                if not len(row):
                    continue
                order = np.lexsort((hashes, row))
                row, hashes, first, last = row[order], hashes[order], first[order], last[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
                row, hashes, first, last = row[new], hashes[new], first[new], last[new]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(x).take(pa.array(a + row)) for x in ("id", "key_a", "key_b")]
                    + [pa.array(hashes.view(np.int64)), pa.array(_texts(data, first, last, starts, ends), pa.string())],
                    ["id", "key_a", "key_b", "hash", "shingle"],
                )

    return run


def _unsigned(hashes):
    """Signed longs in the order of the unsigned hashes."""
    return hashes.bitwiseXOR(F.lit(-(1 << 63)))


def _shingled(df: DataFrame, id_column: str, hits=None) -> DataFrame:
    narrow = df.select(F.col(id_column).alias("id"), *row_keys(df), F.col("text").alias("text"))
    return narrow.mapInArrow(_shingle_batches(hits), SHINGLES.format(dict(narrow.dtypes)["id"]))


def item_sketches(
    items: DataFrame, item_column: str = "item_id", containment: float = CONTAINMENT
) -> tuple[DataFrame, DataFrame]:
    """Shingles of the items (with size and class) and of these the sketches."""
    shingles = _shingled(items, item_column).distinct()
    key = ["key_a", "key_b"]
    sizes = shingles.groupBy(*key).agg(F.count("*").alias("size"))
    shingles = shingles.join(sizes, key).withColumn("class", F.floor(F.log2("size")).cast("int"))
    shingles = shingles.withColumn("needed", F.ceil(F.col("size") * containment - 1e-9))
    ranked = shingles.withColumn(
        "rank", F.row_number().over(Window.partitionBy(*key).orderBy(_unsigned(F.col("hash"))))
    )
    shingles = stage(ranked.withColumn("sketch", F.col("rank") <= F.col("size") - F.col("needed") + 1), "items")
    return shingles, shingles.where("sketch")


def contained(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", item_column: str = "item_id",
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Pairs of documents and items they hold: (id, key_a, key_b, item_id, n_shared, n_shingles, containment)."""
    shingles, sketches = item_sketches(items, item_column, containment)
    largest = {
        r["class"]: np.int64(r["top"]).view(np.uint64) ^ np.uint64(1 << 63)
        for r in sketches.groupBy("class").agg(F.max(_unsigned(F.col("hash"))).alias("top")).collect()
    }
    maps = {c: bitmaps.build(sketches.where(F.col("class") == c), "hash", MAP_BITS) for c in largest}
    everything = bitmaps.build(shingles, "hash", MAP_BITS)

    def hits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sketched = np.zeros(len(hashes), bool)
        for size, bitmap in maps.items():
            sketched |= (hashes <= largest[size]) & bitmaps.holds(bitmap, hashes)
        return sketched, bitmaps.holds(everything, hashes)

    held = _shingled(docs, id_column, hits).select(
        "id", F.col("key_a").alias("doc_a"), F.col("key_b").alias("doc_b"), "hash", "shingle"
    )
    # Joined on hash and text: the count of these rows is the exact intersection.
    both = held.join(shingles.withColumnRenamed("id", "item_id"), ["hash", "shingle"])
    pairs = both.groupBy("doc_a", "doc_b", "key_a", "key_b").agg(
        F.min("id").alias("id"), F.min("item_id").alias("item_id"), F.count_distinct("hash").alias("n_shared"),
        F.max("size").alias("n_shingles"), F.max("needed").alias("needed"), F.max("sketch").alias("candidate"),
    )
    return pairs.where("candidate AND n_shared >= needed").select(
        "id", F.col("doc_a").alias("key_a"), F.col("doc_b").alias("key_b"), "item_id", "n_shared", "n_shingles",
        (F.col("n_shared") / F.col("n_shingles")).alias("containment"),
    )
