"""Histogram sort into shards of nearly equal bytes.

Rows are ordered by a 128-bit key. The driver proposes key boundaries, the tasks count the exact
bytes and rows below each of them over a narrow table of keys and sizes, and the intervals that
still hold a wanted splitter are probed again until every splitter meets the tolerance. Only
then are the rows exchanged, once. A shard is exchanged in several parts of bounded size, so no
task receives a whole shard.

Nulls: a null text has no bytes. Rows are ordered by the hash of the text, then by the hash of
all columns; equal texts stand together and a group of them is split where a shard ends. Rows
equal in every column are interchangeable, and a run of them is not split. Empty tables give no
rows. An input column that bears the name of an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.staging import stage

SIGN = np.uint64(1 << 63)
TOP = 1 << 128
# Boundaries proposed inside an unresolved interval in one round.
FAN = 32
# Bytes of text that one task of the exchange sorts.
PART_BYTES = 64 << 20
# Share of a part by which its bounds may be off at most, however wide the tolerance of a shard.
PART_SLACK = 0.1


def binary_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two signed 64-bit columns as 16 bytes each that sort the same way."""
    out = np.empty((len(a), 2), ">u8")
    out[:, 0] = a.astype(np.int64).view(np.uint64) ^ SIGN
    out[:, 1] = b.astype(np.int64).view(np.uint64) ^ SIGN
    return out.view("S16").ravel()


def boundary_array(bounds: list[int]) -> np.ndarray:
    return np.frombuffer(b"".join(x.to_bytes(16, "big") for x in bounds), "S16")


@dataclass
class Splitters:
    """Boundaries of the parts (part i begins at the boundary before it) and what lies below."""

    bounds: list[int]
    bytes_below: list[int]
    rows_below: list[int]

    def part(self, a: Column, b: Column) -> Column:
        """Number of the part that a row with this key belongs to."""
        bounds = boundary_array(self.bounds)

        @F.pandas_udf("int")
        def of(a: pd.Series, b: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(bounds, binary_keys(a.to_numpy(), b.to_numpy()), side="right"))

        return of(a, b)


def count_below(keys: DataFrame, probes: list[int]) -> tuple[list[int], list[int]]:
    """Exact bytes and rows below each probe; ``keys`` has key_a, key_b, size."""
    bounds = boundary_array(probes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(bounds) + 1, np.int64), np.zeros(len(bounds) + 1, np.int64)
        for batch in batches:
            a, b, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            at = np.searchsorted(bounds, binary_keys(a, b), side="right")
            size += np.bincount(at, n, len(size)).astype(np.int64)
            rows += np.bincount(at, minlength=len(rows))
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(size[some]), pa.array(rows[some])], ["bin", "size", "rows"])

    counted = keys.select("key_a", "key_b", "size").mapInArrow(count, "bin long, size long, rows long")
    size, rows = [0] * (len(probes) + 1), [0] * (len(probes) + 1)
    for r in counted.groupBy("bin").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows")).collect():
        size[r["bin"]], rows[r["bin"]] = r["size"], r["rows"]
    return list(np.cumsum(size[:-1], dtype=object)), list(np.cumsum(rows[:-1], dtype=object))


def split(keys: DataFrame, shards: int, part_bytes: int = PART_BYTES, tolerance: float = 1e-3) -> tuple[Splitters, int]:
    """Splitters of ``shards`` ranges of equal bytes, each in so many equal parts (second value).

    A splitter is final when the bytes below it are within ``tolerance`` of a shard from the
    wanted number, and within PART_SLACK of a part, or when no key lies between it and the next candidate.
    """
    total = keys.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    all_bytes, all_rows = int(total["bytes"] or 0), int(total["rows"])
    per_shard = max(1, -(-all_bytes // (shards * part_bytes)))
    parts = shards * per_shard
    slack = min(tolerance * all_bytes / shards, PART_SLACK * all_bytes / parts)
    known = {0: (0, 0), TOP: (all_bytes, all_rows)}
    wanted = [all_bytes * j / parts for j in range(1, parts)]
    low, high = [0] * len(wanted), [TOP] * len(wanted)

    def open_interval(j: int) -> bool:
        a, b = low[j], high[j]
        near = min(abs(known[a][0] - wanted[j]), abs(known[b][0] - wanted[j]))
        return b - a > 1 and known[b][1] - known[a][1] > 1 and near > slack

    while unresolved := {(low[j], high[j]) for j in range(len(wanted)) if open_interval(j)}:
        probes = sorted({a + (b - a) * i // FAN for a, b in unresolved for i in range(1, FAN)} - known.keys())
        sizes, rows = count_below(keys, probes)
        known |= {p: (s, r) for p, s, r in zip(probes, sizes, rows)}
        ladder = sorted(known)
        below = np.array([known[p][0] for p in ladder], dtype=np.float64)
        for j, want in enumerate(wanted):
            at = min(max(int(np.searchsorted(below, want, side="right")) - 1, 0), len(ladder) - 2)
            low[j], high[j] = ladder[at], ladder[at + 1]
    chosen = [
        min((low[j], high[j]), key=lambda p: (abs(known[p][0] - want), p)) for j, want in enumerate(wanted)
    ]
    chosen = [min(p, TOP - 1) for p in chosen]
    counts = [known.get(p, known[TOP]) for p in chosen]
    return Splitters(chosen, [0, *(c[0] for c in counts)], [0, *(c[1] for c in counts)]), per_shard


def histogram_sort(docs: DataFrame, shards: int, text: str = "text", part_bytes: int = PART_BYTES, tolerance: float = 1e-3) -> DataFrame:
    """All rows with ``shard`` and ``slot`` (gapless place in the shard, in key order) and ``size``."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot", "size")]
    size = (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8).cast("long")
    keys = [F.xxhash64(F.col(text)).alias("key_a"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("key_b")]
    found, per_shard = split(stage(docs.select(*keys, size.alias("size")), "keys"), shards, part_bytes, tolerance)
    start = [found.rows_below[s * per_shard] for s in range(shards)]
    before = [r - start[i // per_shard] for i, r in enumerate(found.rows_below)]
    row = docs.select(F.struct(*others).alias("row"), *keys, size.alias("size"))
    row = row.withColumn("part", found.part(F.col("key_a"), F.col("key_b")))
    place = Window.partitionBy("part").orderBy("key_a", "key_b")
    slot = F.row_number().over(place) - 1 + F.element_at(F.lit(before).cast("array<bigint>"), F.col("part") + 1)
    return row.select(
        "row.*", "size", (F.col("part") / per_shard).cast("int").alias("shard"), slot.alias("slot")
    )
