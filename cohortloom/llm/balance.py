"""Documents mixed to target weights of their sources by the cube method.

Targets. A source's size is its number of words. Sources in code point order (null last) weigh
WEIGHTS, repeating, and share SHARE times all words; a target stops at REPEATS times its source's
size, and what is over goes to the others by weight. The level that this ends at, words for each
unit of weight, is found by a few sums over the table of sources.

Draw. A source taken at the rate r gives floor(r) whole copies of each document; the rest of r is
the document's chance of one more. The cube method turns chances into a draw that keeps the sums of
words and of documents. Flight: chances of three documents move along the null space of the two
constraints, one way or the other at random and so that nobody's expectation changes, until one of
them is 0 or 1. Documents are dealt into groups of about GROUP by a hash; each group leaves two
chances open at most, which make up the groups of the next round, until a source has one group.
Landing: the last two chances of a source are drawn with the least expected deviation of words.
The largest documents move first, each against all others of its group (the projection of its unit
vector on the null space), then pairs in falling size against the smallest: what stays open is small.

Every document takes part, at every size; nothing but sums over sources reaches the driver.
Random numbers come from the seed, the source's number and the group, so reruns agree.
A null text has size 0, a null source is one of its own, a null id an id like any other. Repeated
rows (equal id, source and size) are drawn as a number of copies and are interchangeable. Very long
texts are counted as wholes. An empty table gives no rows. Only id, source and text are read, so
further columns cannot clash.
"""

from __future__ import annotations

import random
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
# Documents of a source that are flown together; a group leaves two open.
GROUP = 4096
# A document with more than this part of its group's words is large: it moves against all others at once.
LARGE = 1 / 64
# Chances this near to 0 or 1 are there.
NEAR = 1e-9
# Copies that one row stands for when copies become rows again.
COPIES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``number``, their place by code point with null last, without one task for all."""
    order = [F.col("source").isNull(), F.col("source")]
    ranged = sources.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stage(ranged.withColumn("part", F.spark_partition_id()), "sources")
    counts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    numbered = ranged.withColumn("inside", inside).join(before, "part")
    return numbered.withColumn("number", F.col("before") + F.col("inside")).drop("part", "inside", "before")


def targets(
    sources: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: float = REPEATS,
) -> DataFrame:
    """``sources`` (source, source_size) with ``number`` and ``target``, staged."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights)).cast("int") + 1)
    shared = _numbered(sources).withColumns({"weight": weight, "most": F.col("source_size") * F.lit(float(repeats))})
    shared = stage(shared, "shares")
    total = shared.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, None
    while level != before:
        before = level
        full = F.col("most") < level * F.col("weight")
        taken, rest = shared.agg(
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if rest:
            level = max(level, (share * total - taken) / rest)
    target = F.least(F.col("most"), level * F.col("weight"))
    return stage(shared.withColumn("target", target).drop("weight", "most"), "targets")


def _step(chances, way, draw) -> float:
    """How far to go along ``way``: to the first bound on one side or the other, by chance."""
    with np.errstate(divide="ignore", invalid="ignore"):
        forth = np.min(np.where(way > 0, (1 - chances) / way, np.where(way < 0, chances / -way, np.inf)))
        back = np.min(np.where(way > 0, chances / way, np.where(way < 0, (1 - chances) / -way, np.inf)))
    return forth if draw() * (forth + back) < back else -back


def _settled(chances):
    return np.where(chances < NEAR, 0.0, np.where(chances > 1 - NEAR, 1.0, chances))


def _large_first(sizes: np.ndarray, chances: np.ndarray, draw) -> np.ndarray:
    """Flight of the large documents, as long as the others can balance them."""
    out = chances.copy()
    for i in np.argsort(-sizes, kind="stable"):
        if sizes[i] <= LARGE * sizes.sum():
            break
        while 0 < out[i] < 1:
            live = np.flatnonzero((out > 0) & (out < 1))
            kept = np.stack([sizes[live] / sizes[i], np.ones(len(live))])
            unit = (live == i).astype(float)
            way = unit - kept.T @ (np.linalg.pinv(kept @ kept.T) @ (kept @ unit))
            if way[live == i][0] < 1e-6:
                break
            way[np.abs(way) < 1e-12] = 0
            moved = _settled(out[live] + _step(out[live], way, draw) * way)
            if (moved == out[live]).all():
                break
            out[live] = moved
    return out


def flight(sizes: list[int], chances: list[float], draw) -> list[float]:
    """Chances moved to 0 or 1 with their sum and the sum of expected sizes kept; two at most stay between.

    ``draw`` gives random numbers below 1.
    """
    out = _large_first(np.array(sizes, float), np.array(chances, float), draw).tolist()
    order = sorted((i for i, p in enumerate(out) if 0 < p < 1), key=lambda i: (-sizes[i], i))
    waiting = deque(order)
    anchor, pair = None, []
    while True:
        if anchor is None and waiting:
            anchor = waiting.pop()
        while len(pair) < 2 and waiting:
            pair.append(waiting.popleft())
        live = pair + ([anchor] if anchor is not None else [])
        if len(live) == 3:
            x, y, z = (sizes[i] for i in live)
            way = [y - z, z - x, x - y] if x != y or y != z else [1, -1, 0]
        elif len(live) == 2 and sizes[live[0]] == sizes[live[1]]:
            way = [1, -1]
        else:
            return out
        forth = min((1 - out[i]) / u if u > 0 else out[i] / -u for i, u in zip(live, way) if u)
        back = min(out[i] / u if u > 0 else (1 - out[i]) / -u for i, u in zip(live, way) if u)
        step = forth if draw() * (forth + back) < back else -back
        for i, u in zip(live, way):
            moved = out[i] + step * u
            out[i] = 0.0 if moved < NEAR else 1.0 if moved > 1 - NEAR else moved
        pair = [i for i in pair if 0 < out[i] < 1]
        if anchor is not None and not 0 < out[anchor] < 1:
            anchor = None


def landing(sizes: list[int], chances: list[float], draw) -> list[float]:
    """The two chances that flight leaves at most, drawn: both or neither as rarely as chances allow.

    Of all joint draws with these chances that one has the least expected squared deviation.
    """
    out = list(chances)
    left = [i for i, p in enumerate(out) if 0 < p < 1]
    point = draw()
    if len(left) == 1:
        out[left[0]] = float(point < out[left[0]])
    elif left:
        a, b = left
        p, q = out[a], out[b]
        both = max(0.0, p + q - 1)
        out[a] = float(point < p)
        out[b] = float(point < both or p <= point < p + q - both)
    return out


UNIT = "id {}, size long, copies long, number long, bucket long, key long, sure long, whole long, chance double, source_size long, target double"


def _flown(open_: DataFrame, schema: str, level: int, last: bool, seed: int) -> DataFrame:
    """Every group after its flight, and after its landing if it is the ``last`` of its source."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "size"], kind="stable")
        number, bucket = int(group["number"].iloc[0]), int(group["bucket"].iloc[0])
        draw = random.Random(f"{seed}:{level}:{number}:{bucket}").random
        sizes = group["size"].tolist()
        chances = flight(sizes, group["chance"].tolist(), draw)
        group["chance"] = landing(sizes, chances, draw) if last else chances
        return group

    return open_.groupBy("number", "bucket").applyInPandas(run, schema)


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: float = REPEATS,
    group: int = GROUP,
    seed: int = 13,
) -> DataFrame:
    """id, source, size, source_size, target, times (how often the document is taken) of every row."""
    rows = docs.select(
        F.col(source).alias("source"), F.col(id_column).alias("id"), word_count(F.col(text)).alias("size")
    )
    units = stage(rows.groupBy("source", "id", "size").agg(F.count("*").alias("copies")), "units")
    sums = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("n_units")
    )
    goals = targets(sums, weights, share, repeats)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate + NEAR)
    expected = F.col("copies") * F.greatest(rate - whole, F.lit(0.0))
    sure = F.floor(expected + NEAR)
    chance = expected - sure
    key = F.xxhash64(F.lit(seed), "id", "size")
    goals = goals.withColumnRenamed("source", "_source")
    drawn = units.join(goals, F.col("source").eqNullSafe(F.col("_source"))).select(
        "id", "size", "copies", "number", F.pmod(key, F.ceil(F.col("n_units") / group)).alias("bucket"), key.alias("key"),
        sure.alias("sure"), whole.alias("whole"), F.when(chance < NEAR, 0.0).otherwise(chance).alias("chance"),
        "source_size", "target",
    )
    schema = UNIT.format(dict(drawn.dtypes)["id"])
    drawn = stage(drawn, "drawn")
    most = goals.agg(F.max(F.ceil(F.col("n_units") / group))).first()[0] or 0
    between = (F.col("chance") > 0) & (F.col("chance") < 1)
    decided, level = [drawn.where(~between)], 0
    open_ = drawn.where(between)
    while most:
        flown = stage(_flown(open_, schema, level, most == 1, seed), "flown")
        decided.append(flown.where(~between))
        open_ = flown.where(between).withColumn("bucket", F.floor(F.col("bucket") / (group // 2)))
        most, level = (0 if most == 1 else -(-most // (group // 2))), level + 1
    settled = decided[0]
    for more in decided[1:]:
        settled = settled.unionByName(more)
    named = settled.join(goals.select("number", F.col("_source").alias("source")), "number")
    return _per_row(named)


def _per_row(settled: DataFrame) -> DataFrame:
    """One row per copy again: the first ``sure`` copies, and one more if drawn, are taken once more."""
    extra = F.col("sure") + F.col("chance").cast("long")
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))
    dealt = settled.withColumns({"extra": extra, "block": F.explode(blocks)}).repartition("id", "size", "block")
    first = F.col("block") * COPIES + 1
    numbers = F.sequence(first, F.least(F.col("copies"), first + (COPIES - 1)))
    one = dealt.withColumn("nth", F.explode(numbers))
    times = F.col("whole") + (F.col("nth") <= F.col("extra")).cast("long")
    return one.select("id", "source", "size", "source_size", "target", times.alias("times"))
