"""Bitmaps of fixed size that let the rows through that a later join can match.

A bitmap only ever saves work: what it wrongly lets through the join drops, and one that is full
lets everything through. Its size does not depend on the data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def build(rows: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bits at the low ends of a long column; at most bits / 64 rows come to the driver."""
    bit = F.col(column).bitwiseAND(bits - 1)
    words = rows.select(
        F.shiftright(bit, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, CAST(`{column}` & 63 AS INT))").alias("bit")
    )
    out = np.zeros(bits // 64, np.int64)
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = found.groupBy(F.expr("word div 4096").alias("page")).agg(F.collect_list(F.struct("word", "bits")).alias("words"))
    for r in found.select("words.word", "words.bits").collect():
        out[r["word"]] = r["bits"]
    return out.view(np.uint64)


def holds(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def passes(bitmap: np.ndarray, column: Column) -> Column:
    """Whether a long column may be in the bitmap."""

    @F.pandas_udf("boolean")
    def check(values: pd.Series) -> pd.Series:
        return pd.Series(holds(bitmap, values.to_numpy().view(np.uint64)))

    return check(column)
