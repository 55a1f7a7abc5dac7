"""Exact dedup of a batch against an immutable snapshot.

The snapshot's digests are kept in static binary-fuse filters, one per digest range, so that most
digests of a batch are known to be new without touching the snapshot's buckets. What passes a
filter joins the exact buckets and is compared byte by byte; duplicates inside the batch are
grouped by themselves before that.

Nulls: a null text counts as empty, a null id comes last among equals. Repeated rows are members
of their group like any other, exactly one row of a group is kept. An empty table gives no rows.
Only the id and the text are read besides the row key, so further columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import bitmaps
from cohortloom.llm.staging import MAP_BITS, row_keys, stage
from cohortloom.llm.tokens import mix

# Digests of one filter: its table takes 9 bits a digest, building it 100 bytes a digest.
FILTER_DIGESTS = 200_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


@dataclass
class FuseFilter:
    """Three-wise binary-fuse filter with 8-bit fingerprints over 64-bit keys."""

    seed: int
    segment: int
    segments: int
    table: np.ndarray

    @staticmethod
    def _shape(n: int) -> tuple[int, int]:
        segment = 1 << max(2, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        return segment, max(1, int(np.ceil(n * factor / segment)) - 2 + 1)

    @staticmethod
    def _slots(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys + np.uint64(seed))
        first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
        low = np.uint64(segment - 1)
        start = first * np.uint64(segment)
        slots = np.stack([
            start + (h & low),
            start + np.uint64(segment) + ((h >> np.uint64(18)) & low),
            start + np.uint64(2 * segment) + ((mix(h) >> np.uint64(9)) & low),
        ]).astype(np.int64)
        return slots, (mix(h ^ np.uint64(0x5BD1E995)) >> np.uint64(56)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Peel the three-uniform hypergraph in rounds, then fill the table backwards."""
        keys = np.unique(keys.astype(np.uint64))
        segment, segments = cls._shape(len(keys))
        for attempt in range(100):
            seed = 0x9E37 + 7919 * attempt
            slots, prints = cls._slots(keys, seed, segment, segments)
            rounds = cls._peel(slots, (segments + 2) * segment)
            if rounds is not None:
                break
            if attempt % 8 == 7:
                segments += 1 + segments // 8
        else:
            raise ValueError("no filter found for these digests")
        table = np.zeros((segments + 2) * segment, np.uint8)
        for members, cells in reversed(rounds):
            at = slots[:, members]
            others = table[at[0]] ^ table[at[1]] ^ table[at[2]] ^ table[cells]
            table[cells] = prints[members] ^ others
        return cls(seed, segment, segments, table)

    @staticmethod
    def _peel(slots: np.ndarray, size: int):
        n = slots.shape[1]
        count = np.bincount(slots.ravel(), minlength=size)
        which = np.zeros(size, np.int64)
        ids = np.arange(n)
        for row in slots:
            np.bitwise_xor.at(which, row, ids)
        alive, rounds, left = np.ones(n, bool), [], n
        cells = np.flatnonzero(count == 1)
        while len(cells):
            members, at = np.unique(which[cells], return_index=True)
            cells = cells[at]
            rounds.append((members, cells))
            alive[members] = False
            left -= len(members)
            touched = slots[:, members]
            for row in touched:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(which, row, members)
            touched = np.unique(touched)
            cells = touched[count[touched] == 1]
        return rounds if left == 0 else None

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        slots, prints = self._slots(keys.astype(np.uint64), self.seed, self.segment, self.segments)
        return (self.table[slots[0]] ^ self.table[slots[1]] ^ self.table[slots[2]]) == prints


def digest_rows(docs: DataFrame, in_snapshot: Column, id_column: str, text: str) -> DataFrame:
    """One narrow row per document: id, digest of the normalised text, code points, row keys."""
    return docs.select(
        F.col(id_column).alias("id"),
        F.sha2(normalised(F.col(text)), 256).alias("digest"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("points"),
        *row_keys(docs),
        F.coalesce(in_snapshot, F.lit(False)).alias("old"),
        F.monotonically_increasing_id().alias("row"),
    )


def grouped(rows: DataFrame) -> DataFrame:
    """One row per digest: its size and its first row, which has the most code points."""
    order = F.struct(
        (-F.col("points")).alias("points"), F.col("id").isNull().alias("no_id"), "id", "key_a", "key_b", "row"
    )
    return rows.groupBy("digest").agg(F.count("*").alias("size"), F.min(order).alias("best"))


def _shard(parts: int) -> Column:
    return F.pmod(F.xxhash64("digest", F.lit("shard")), F.lit(parts)).cast("int").alias("shard")


def build_filters(snapshot: DataFrame, parts: int) -> DataFrame:
    """Filters over the digests of ``snapshot``: (shard, seed, segment, segments, cells)."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        made = FuseFilter.build(frame["key"].to_numpy().view(np.uint64))
        return pd.DataFrame(
            {"shard": frame["shard"].iloc[:1].to_numpy(), "seed": [made.seed], "segment": [made.segment],
             "segments": [made.segments], "cells": [made.table.tobytes()]}
        )

    return (
        snapshot.select(_shard(parts), F.xxhash64("digest").alias("key"))
        .groupBy("shard")
        .applyInPandas(build, "shard int, seed long, segment long, segments long, cells binary")
    )


def screen(digests: DataFrame, filters: DataFrame, parts: int) -> DataFrame:
    """The digests that the filters do not rule out."""

    def probe(frame: pd.DataFrame, made: pd.DataFrame) -> pd.DataFrame:
        if made.empty or frame.empty:
            return pd.DataFrame({"digest": pd.Series([], dtype=str)})
        one = made.iloc[0]
        found = FuseFilter(int(one.seed), int(one.segment), int(one.segments), np.frombuffer(one.cells, np.uint8))
        return frame.loc[found.may_hold(frame["key"].to_numpy().view(np.uint64)), ["digest"]]

    keyed = digests.select(_shard(parts), "digest", F.xxhash64("digest").alias("key"))
    return (
        keyed.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(probe, "digest string")
    )


def confirmed(docs: DataFrame, pairs: DataFrame, text: str) -> DataFrame:
    """Of (digest, old, new) pairs of row keys the digests whose normalised texts are equal."""
    wanted = pairs.select("digest", F.explode(F.array("old", "new")).alias("at"))
    wanted = wanted.select("digest", F.col("at.key_a").alias("key_a"), F.col("at.key_b").alias("key_b")).distinct()
    wanted = stage(wanted, "wanted")
    may = bitmaps.passes(bitmaps.build(wanted, "key_a", MAP_BITS), F.col("key_a"))
    texts = docs.select(*row_keys(docs), F.col(text).alias("bytes")).where(may)
    texts = texts.select("key_a", "key_b", normalised(F.col("bytes")).alias("bytes"))
    # One plan at every size: the snapshot's buckets cannot be assumed to fit a broadcast.
    found = texts.join(wanted.hint("merge"), ["key_a", "key_b"]).groupBy("digest").agg(
        (F.min(F.col("bytes")) == F.max(F.col("bytes"))).alias("same")
    )
    return found.where("same").select("digest")


def dedup(docs: DataFrame, in_snapshot: Column, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of equal normalised texts over an immutable snapshot and a new batch.

    ``in_snapshot`` tells the rows of the snapshot. Returns a row per document: id, row, key_a,
    key_b, digest, size, keep_id (id of the row that stays) and kept.
    """
    rows = stage(digest_rows(docs, in_snapshot, id_column, text), "rows")
    old = stage(grouped(rows.where("old")), "snapshot")
    new = stage(grouped(rows.where("NOT old")), "batch")
    parts = max(1, -(-old.count() // FILTER_DIGESTS))
    filters = stage(build_filters(old, parts), "filters")
    positive = screen(new, filters, parts)
    pairs = stage(
        positive.join(new.select("digest", F.col("best").alias("new")), "digest").join(
            old.select("digest", F.col("best").alias("old")), "digest"
        ),
        "pairs",
    )
    same = confirmed(docs, pairs, text)
    # A digest that both sides bear and whose bytes differ stays two groups.
    apart = pairs.select("digest").join(same, "digest", "left_anti").withColumn("apart", F.lit(True))
    apart = stage(apart, "apart")
    both = old.withColumn("old", F.lit(True)).unionByName(new.withColumn("old", F.lit(False)))
    both = both.join(apart, "digest", "left").withColumn("side", F.when(F.col("apart"), F.col("old")))
    groups = both.groupBy("digest", "side").agg(F.sum("size").alias("size"), F.min("best").alias("best"))
    groups = stage(groups.where("size > 1"), "groups")
    joined = rows.join(
        groups.select(F.col("digest").alias("_digest"), "side", "size", "best"),
        (F.col("digest") == F.col("_digest")) & (F.col("side").isNull() | (F.col("side") == F.col("old"))),
        "left",
    )
    return joined.select(
        "id", "row", "key_a", "key_b", "digest",
        F.coalesce("size", F.lit(1)).alias("size"),
        F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        (F.col("best").isNull() | (F.col("best.row") == F.col("row"))).alias("kept"),
    )
