"""Class-based bigrams: exchange clustering, class transitions and word emissions.

Clustering begins with units: the UNITS most frequent words are units of their own, all others belong
to a unit by their last bytes. Counts of unit pairs come from all training texts. Exchange clustering
moves units between classes: in each round tasks own disjoint units and move them one after the other
to the class that raises the likelihood of the class bigrams most, starting from the same classes (all
rounds work on unit pairs, whose number is bounded by the parameters). Then every other training word,
however rare, leaves its unit: its neighbours in all training texts are counted by class, and it joins
the class where they raise the likelihood of the class bigrams most (what it takes from its unit's class
is left out of that). Only words that no training text has keep the class of their last bytes. The class
bigrams are counted anew with these classes. With n the training count of a word, the probability of a word w
of class c after class p is

    (n(w) + 1) * (L * T(c | p) / (N(c) + V(c) + 1) + (1 - L) / (N + V + C))

where T is smoothed by Witten-Bell, N(c) and V(c) count the tokens and distinct words of a class, C the
classes, and the added one is the share of unseen words. It sums to one at most. The counts and classes
of all words are exact: frequent ones are looked up in a bounded table, the others in a join, after which
they meet their neighbours again, text by text. Words whose hashes agree in 51 bits join the same class.

Nulls: a null text is empty, that is one end token; a row that is neither training nor held out
(null) trains. Repeated rows count and score one by one. Without training texts every probability is
that of an unseen token. Only the given columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import tokens
from cohortloom.llm.staging import stage

UNITS = 2048
ENDINGS = 512
ENDING_BYTES = 3
CLASSES = 64
# Frequent words whose counts every task holds (12 bytes each).
LOOKED_UP = 1 << 18
CLASS_WEIGHT = 0.95
ROUNDS = 8
OWNERS = 4
END_UNIT = UNITS + ENDINGS
# A word that was placed by itself has the unit PLACED + its class.
PLACED = END_UNIT + 1
# Classes before and after a word are the last bits of a key, its hash the others.
SIDE = CLASSES + 1
CODE_BITS = 13
# Different keys that a task holds before it hands them on, and counts whose logarithms are tabulated.
HELD_KEYS, TABLED = 1 << 21, 32
# Words with counts that a task holds before it hands them on, a batch more at most.
HELD_WORDS = 1 << 19
# Leading bits of a hash by which it is looked up, and by which neighbours are shuffled.
FIND_BITS, RANGE_BITS = 20, 12
# Neighbours whose gains are computed together, those of one word more at most.
WEIGHED = 1 << 14


def _ending_units(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Units by the hash that ``tokens.span_hash`` gives the last bytes."""
    starts = np.maximum(starts, ends - ENDING_BYTES)
    size = ends - starts
    tail = size.astype(np.uint64)
    for k in range(ENDING_BYTES):
        some = np.flatnonzero(size > k)
        tail[some] += (data[starts[some] + k].astype(np.uint64) + np.uint64(1)) * tokens.powers(ENDING_BYTES)[0][k]
    return (UNITS + tokens.mix(tail) % np.uint64(ENDINGS)).astype(np.int32)


@dataclass
class Lexicon:
    """Hashes of frequent words in order, with their counts and units (-1: by ending)."""

    hashes: np.ndarray
    counts: np.ndarray
    units: np.ndarray

    @cached_property
    def _ranges(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the hashes with the same leading bits begin, and the hashes with one more that none is above."""
        lead = (self.hashes >> np.uint64(64 - FIND_BITS)).astype(np.int64)
        first = np.cumsum(np.bincount(lead + 1, minlength=1 << FIND_BITS)[: 1 << FIND_BITS])
        return first, np.append(self.hashes, np.uint64(2**64 - 1))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and whether it is there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        first, held = self._ranges
        at = first[(hashes >> np.uint64(64 - FIND_BITS)).astype(np.int64)]
        below = np.flatnonzero(held[at] < hashes)
        while len(below):
            at[below] += 1
            below = below[held[at[below]] < hashes[below]]
        at = np.minimum(at, len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def units_of(self, data, starts, ends, hashes, found=None) -> np.ndarray:
        """Units of words; ``found`` is what ``find`` gave for their hashes, if that is known."""
        at, there = found or self.find(hashes)
        out = np.full(len(hashes), -1, np.int32)
        out[there] = self.units[at[there]]
        rest = np.flatnonzero(out < 0)
        out[rest] = _ending_units(data, starts[rest], ends[rest])
        return out


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Distinct hashes with sums of counts and one word each."""
    hashes, first, which = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
    counts = np.bincount(which, np.concatenate([p[1] for p in parts])).astype(np.int64)
    return hashes, counts, pa.concat_arrays([p[2] for p in parts]).take(pa.array(first))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, held = [], 0

    def counted() -> pa.RecordBatch:
        _, counts, words = _merged(parts)
        return pa.RecordBatch.from_arrays([words, pa.array(counts)], ["word", "n"])

    for batch in batches:
        for _, _, data, offsets in tokens.text_blocks(batch.column("text")):
            data = tokens.lower(data)
            starts, ends, _ = tokens.words(data, offsets)
            hashes = tokens.hash_words(data, starts, ends)
            if len(starts):
                _, first, counts = np.unique(hashes, return_index=True, return_counts=True)
                parts.append((hashes[first], counts, tokens.gather(data, starts[first], ends[first])))
                held += len(first)
        if held > HELD_WORDS:
            yield counted()
            parts, held = [], 0
    if parts:
        yield counted()


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts."""
    counted = texts.select("text").mapInArrow(_count_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _hashes_of(words: pa.Array):
    data, offsets = tokens.text_bytes(words)
    return data, offsets[:-1], offsets[1:], tokens.hash_words(data, offsets[:-1], offsets[1:])


def _hashed_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per batch: hashes and counts of its words."""
    for batch in batches:
        if batch.num_rows:
            hashes = _hashes_of(batch.column("word"))[3].view(np.int64)
            row = [pa.array([x], pa.list_(pa.int64())) for x in (hashes, batch.column("n").to_numpy())]
            yield pa.RecordBatch.from_arrays(row, ["hashes", "counts"])


def frequent_words(vocabulary: DataFrame) -> Lexicon:
    """The most frequent words, LOOKED_UP at most; the first UNITS of them are units of their own.

    A histogram over the logarithm of the counts (sixteen steps for a factor of two) tells from
    which count on words are taken, so nothing is sorted and no more than these are collected. In the
    step where that ends the exact counts tell, and of the words with the last count a share by hash.
    """
    step = F.floor(F.log2("n") * 16)
    steps = vocabulary.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()
    room, taken = LOOKED_UP, F.lit(False)
    for r in sorted(steps, key=lambda r: -r["step"]):
        if r["words"] <= room:
            room, taken = room - r["words"], F.col("n") >= r["least"]
            continue
        inside = vocabulary.where(step == r["step"]).groupBy("n").agg(F.count("*").alias("words")).collect()
        for c in sorted(inside, key=lambda c: -c["n"]):
            if c["words"] > room:
                some = F.pmod(F.xxhash64("word"), F.lit(c["words"])) < room
                taken = taken | (F.col("n") == c["n"]) & some
                break
            room, taken = room - c["words"], F.col("n") >= c["n"]
        break
    found = vocabulary.where(taken).mapInArrow(_hashed_words, "hashes array<long>, counts array<long>").collect()
    if not found:
        return Lexicon(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32))
    hashes = np.concatenate([np.array(r["hashes"], np.int64) for r in found]).view(np.uint64)
    counts = np.concatenate([np.array(r["counts"], np.int64) for r in found])
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    units = np.full(len(hashes), -1, np.int32)
    first = np.argsort(-counts, kind="stable")[:UNITS]
    units[first] = np.arange(len(first))
    return Lexicon(hashes, counts, units)


def _with_ends(rows: np.ndarray, count: int, values: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """Values of words with one more at the end of each row, and where the rows end."""
    per_row = np.bincount(rows, minlength=count) + 1
    stop = np.cumsum(per_row)
    out = np.full(stop[-1] if count else 0, end, values.dtype)
    out[np.arange(len(values)) + rows] = values
    return out, stop


def _count_pairs(lexicon: Lexicon):
    """Counts of unit pairs; a text begins after an end."""
    size = END_UNIT + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for _, _, data, offsets in tokens.text_blocks(batch.column("text")):
                data = tokens.lower(data)
                starts, ends, rows = tokens.words(data, offsets)
                hashes = tokens.hash_words(data, starts, ends)
                units = lexicon.units_of(data, starts, ends, hashes)
                units, _ = _with_ends(rows, len(offsets) - 1, units, END_UNIT)
                codes, n = np.unique(np.append(END_UNIT, units[:-1]).astype(np.int64) * size + units, return_counts=True)
                total[codes] += n
        some = np.flatnonzero(total)
        first = np.flatnonzero(np.diff(some // size, prepend=-1))
        stops = np.append(first, len(some))
        for i in range(0, len(first), 100):
            cuts = stops[i : i + 101]
            at = some[cuts[0] : cuts[-1]]
            lists = [pa.ListArray.from_arrays(pa.array((cuts - cuts[0]).astype(np.int32)), pa.array(x))
                     for x in ((at % size).astype(np.int32), total[at])]
            units = (some[cuts[:-1]] // size).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(units), *lists], ["a", "others", "counts"])

    return run


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list]]:
    """Each ``key`` with the values of its lists, of batches that are sorted by it; the lists are the other columns."""
    held, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        lists = [batch.column(c) for c in batch.schema.names if c != key]
        offsets = lists[0].offsets.to_numpy()
        offsets = offsets - offsets[0]
        values = [x.flatten().to_numpy() for x in lists]
        cuts = np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if parts and keys[a] != held:
                yield held, parts
                parts = []
            held = keys[a]
            parts.append([v[offsets[a] : offsets[b]] for v in values])
    if parts:
        yield held, parts


def _sum_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for unit, parts in _groups(batches, "a"):
        total = np.zeros(END_UNIT + 1, np.int64)
        for others, counts in parts:
            total += np.bincount(others, counts, len(total)).astype(np.int64)
        b = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(b), unit, np.int32)), pa.array(b.astype(np.int32)), pa.array(total[b])], ["a", "b", "n"]
        )


def count_pairs(texts: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(a, b, n) of all pairs of units; what tasks have counted is moved as one row of lists per unit."""
    counted = texts.mapInArrow(_count_pairs(lexicon), "a int, others array<int>, counts array<long>")
    return counted.repartition("a").sortWithinPartitions("a").mapInArrow(_sum_pairs, "a int, b int, n long")


def _neighbours(pairs: DataFrame) -> DataFrame:
    """One row per unit: right neighbours, left neighbours and their counts (UNITS + ENDINGS + 1 at most)."""
    right = pairs.select(F.col("a").alias("unit"), F.lit(True).alias("right"), F.col("b").alias("other"), "n")
    left = pairs.select(F.col("b").alias("unit"), F.lit(False).alias("right"), F.col("a").alias("other"), "n")
    both = right.unionByName(left)
    lists = [
        F.sort_array(F.collect_list(F.when(F.col("right") == side, F.struct("other", "n")))).alias(name)
        for name, side in (("after", True), ("before", False))
    ]
    made = both.groupBy("unit").agg(*lists)
    return made.select(
        "unit", *[F.col(f"{x}.{y}").alias(f"{x}_{y}") for x in ("after", "before") for y in ("other", "n")]
    )


def _x_log_x(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _by_class(others, counts, unit: int, of: np.ndarray, classes: int) -> tuple[np.ndarray, int]:
    """Neighbour counts by class, without the unit itself, and how often it stands by itself."""
    others, counts = np.asarray(others, np.int64), np.asarray(counts, np.float64)
    own = others == unit
    return np.bincount(of[others[~own]], counts[~own], classes), counts[own].sum()


def exchange(frame: pd.DataFrame, of: np.ndarray, joint: np.ndarray) -> pd.DataFrame:
    """Move the units of ``frame`` one after the other; ``joint`` counts class pairs."""
    of, joint = of.copy(), joint.copy()
    classes = len(joint)
    total = joint.sum(axis=1)
    for row in frame.sort_values("unit").itertuples():
        unit, a = row.unit, of[row.unit]
        if unit == END_UNIT:
            continue
        after, itself = _by_class(row.after_other, row.after_n, unit, of, classes)
        before, _ = _by_class(row.before_other, row.before_n, unit, of, classes)
        n = after.sum() + itself
        joint[a, :] -= after
        joint[:, a] -= before
        joint[a, a] -= itself
        total[a] -= n
        plain = _x_log_x(joint)
        rows = _x_log_x(joint + after[None, :]) - plain
        columns = _x_log_x(joint + before[:, None]) - plain
        d = np.arange(classes)
        own = _x_log_x(joint[d, d] + after + before + itself) - plain[d, d]
        gain = rows.sum(axis=1) - rows[d, d] + columns.sum(axis=0) - columns[d, d] + own
        gain -= 2 * (_x_log_x(total + n) - _x_log_x(total))
        gain[classes - 1] = -np.inf  # the end's own class
        b = int(gain.argmax())
        if gain[b] <= gain[a] + 1e-9:
            b = a
        of[unit] = b
        joint[b, :] += after
        joint[:, b] += before
        joint[b, b] += itself
        total[b] += n
    units = frame["unit"].to_numpy()
    return pd.DataFrame({"unit": units, "klass": of[units].astype(np.int32)})


def _mover(of: np.ndarray, joint: np.ndarray):
    return lambda frame: exchange(frame, of, joint)


def _joint(neighbours: DataFrame, of: np.ndarray) -> np.ndarray:
    """Counts of class pairs under a clustering."""
    classes = CLASSES + 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = np.zeros((classes, classes), np.int64)
        for frame in frames:
            for row in frame.itertuples():
                counts = np.asarray(row.after_n, np.float64)
                made[of[row.unit]] += np.bincount(of[np.asarray(row.after_other, np.int64)], counts, classes).astype(np.int64)
        a, b = np.nonzero(made)
        yield pd.DataFrame({"a": a, "b": b, "n": made[a, b]})

    summed = neighbours.select("unit", "after_other", "after_n").mapInPandas(run, "a long, b long, n long")
    out = np.zeros((classes, classes))
    for r in summed.groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        out[r["a"], r["b"]] = r["n"]
    return out


def _likelihood(joint: np.ndarray) -> float:
    return float(_x_log_x(joint).sum() - 2 * _x_log_x(joint.sum(axis=1)).sum())


def cluster(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit and counts of class pairs, after rounds that raise the likelihood."""
    neighbours = stage(_neighbours(pairs), "neighbours")
    of = np.arange(END_UNIT + 1) % CLASSES
    of[END_UNIT] = CLASSES
    joint = _joint(neighbours, of)
    for round_ in range(ROUNDS):
        start, counts = of, joint
        owner = F.pmod(F.xxhash64("unit", F.lit(round_)), F.lit(OWNERS)).alias("owner")
        moved = neighbours.select("*", owner).groupBy("owner")
        moved = moved.applyInPandas(_mover(start, counts), "unit int, klass int").collect()
        of = of.copy()
        for r in moved:
            of[r["unit"]] = r["klass"]
        joint = _joint(neighbours, of)
        if _likelihood(joint) <= _likelihood(counts) * (1 + 1e-5 * (-1 if _likelihood(counts) < 0 else 1)):
            if _likelihood(joint) < _likelihood(counts):
                of, joint = start, counts
            break
    return of, joint


def _summed(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with sums of their counts."""
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")  # the parts are sorted, which this makes use of
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _by_range(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """One row for all keys with the same leading bits; the keys are sorted."""
    lead = (keys >> np.uint64(64 - RANGE_BITS)).astype(np.int32)
    first = np.flatnonzero(np.diff(lead, prepend=-1))
    stops = pa.array(np.append(first, len(keys)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(stops, pa.array(x)) for x in (keys.view(np.int64), counts)]
    return pa.RecordBatch.from_arrays([pa.array(lead[first]), *lists], ["range", "keys", "counts"])


def _count_neighbours(lexicon: Lexicon, of: np.ndarray):
    """Counts of (word, class before it, class after it) for words that are no units of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for batch in batches:
            for _, _, data, offsets in tokens.text_blocks(batch.column("text")):
                data = tokens.lower(data)
                starts, ends, rows = tokens.words(data, offsets)
                hashes = tokens.hash_words(data, starts, ends)
                units = lexicon.units_of(data, starts, ends, hashes)
                classes, _ = _with_ends(rows, len(offsets) - 1, of[units], CLASSES)
                index = np.flatnonzero(units >= UNITS)
                at = index + rows[index]
                before = np.where(at > 0, classes[at - 1], CLASSES)
                base = (hashes[index] >> np.uint64(CODE_BITS)) << np.uint64(CODE_BITS)
                found, n = np.unique(base | (before * SIDE + classes[at + 1]).astype(np.uint64), return_counts=True)
                keys.append(found)
                counts.append(n)
                held += len(found)
                if held > HELD_KEYS:
                    found, n = _summed(keys, counts)
                    keys, counts, held = [found], [n], len(found)
                    if held > HELD_KEYS // 2:
                        yield _by_range(found, n)
                        keys, counts, held = [], [], 0
        if keys:
            yield _by_range(*_summed(keys, counts))

    return run


def gains_of(joint: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of class pairs by code of the neighbour (before, then after), and what small counts there gain."""
    cells = np.concatenate([joint, joint.T])
    plain = _x_log_x(cells)
    return cells, plain, _x_log_x(cells[None] + np.arange(TABLED + 1.0)[:, None, None]) - plain[None]


def best_classes(which: np.ndarray, code: np.ndarray, n: np.ndarray, words: int, joint: np.ndarray, gains) -> np.ndarray:
    """For each of ``words`` words, told by ``which``, the class of ``joint`` that it fits best.

    That is the one where these neighbours raise the likelihood most; ``code`` tells a neighbour's side and class.
    """
    cells, plain, table = gains
    order = np.lexsort((code, which))
    which, code, n = which[order], code[order], n[order]
    first = np.flatnonzero(np.append(True, (which[1:] != which[:-1]) | (code[1:] != code[:-1])))
    which, code, n = which[first], code[first], np.add.reduceat(n, first)
    each = table[np.minimum(n, TABLED), code]
    large = np.flatnonzero(n > TABLED)
    each[large] = _x_log_x(cells[code[large]] + n[large, None]) - plain[code[large]]
    gain = np.add.reduceat(each, np.searchsorted(which, np.arange(words)), axis=0)
    times = np.bincount(which, np.where(code < SIDE, n, 0), words)
    total = joint.sum(axis=1)
    gain -= 2 * (_x_log_x(total[None, :] + times[:, None]) - _x_log_x(total)[None, :])
    return gain[:, :CLASSES].argmax(axis=1)  # the last is the end's own class


def _choose(joint: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = gains_of(joint)
        for _, parts in _groups(batches, "range"):
            # All rows of a word are in one range.
            keys, n = _summed([p[0] for p in parts], [p[1] for p in parts])
            hashes, code = keys >> CODE_BITS, keys & ((1 << CODE_BITS) - 1)
            first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
            stops = np.append(first, len(keys))
            a = 0
            while a < len(first):
                b = max(a + 1, int(np.searchsorted(stops, stops[a] + WEIGHED, side="right")) - 1)
                here = slice(stops[a], stops[b])
                which = np.repeat(np.arange(b - a), np.diff(stops[a : b + 1]))
                sides = np.concatenate([code[here] // SIDE, SIDE + code[here] % SIDE])
                best = best_classes(np.tile(which, 2), sides, np.tile(n[here], 2), b - a, joint, gains)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[first[a:b]]), pa.array(best.astype(np.int32))], ["hash", "klass"]
                )
                a = b

    return run


def place(texts: DataFrame, lexicon: Lexicon, of: np.ndarray, joint: np.ndarray) -> DataFrame:
    """(hash, klass) of all training words that are no units of their own; ``hash`` has 51 bits.

    Tasks hand on what they have counted as one row of lists per range of hashes; a range is summed in one task.
    """
    found = texts.mapInArrow(_count_neighbours(lexicon, of), "range int, keys array<long>, counts array<long>")
    found = found.repartition("range").sortWithinPartitions("range")
    return stage(found.mapInArrow(_choose(joint), "hash long, klass int"), "placed")


def _short(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64) >> CODE_BITS


def _with_placed(lexicon: Lexicon, placed: DataFrame) -> Lexicon:
    """The lexicon with a unit for every word: those that are none of their own get their class's."""
    order = np.argsort(_short(lexicon.hashes), kind="stable")
    short = _short(lexicon.hashes)[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not len(short):
                continue
            hashes = batch.column("hash").to_numpy()
            here = short[np.minimum(np.searchsorted(short, hashes), len(short) - 1)] == hashes
            if here.any():
                row = [pa.array([batch.column(c).to_numpy()[here]], pa.list_(pa.int64())) for c in ("hash", "klass")]
                yield pa.RecordBatch.from_arrays(row, ["hashes", "classes"])

    units = lexicon.units.copy()
    for r in placed.mapInArrow(run, "hashes array<long>, classes array<long>").collect():
        first = np.searchsorted(short, r["hashes"], side="left")
        last = np.searchsorted(short, r["hashes"], side="right")
        for a, b, klass in zip(first, last, r["classes"]):
            at = order[a:b]
            units[at[units[at] < 0]] = PLACED + klass
    return replace(lexicon, units=units)


def _beyond(lexicon: Lexicon):
    """(word, hash) of words that tasks do not hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                hashes = _hashes_of(batch.column("word"))[3]
                rest = np.flatnonzero(~lexicon.find(hashes)[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("word").take(pa.array(rest)), pa.array(_short(hashes[rest]))], ["word", "hash"]
                )

    return run


def _sequences(lexicon: Lexicon, of: np.ndarray, column: pa.Array):
    """For each block its first row, its rows, words found in the lexicon, and classes with ends.

    Words that the lexicon lacks have class -1; they follow with their text, row, place in the
    sequence, the classes beside them and the class of their last bytes.
    """
    for a, b, data, offsets in tokens.text_blocks(column):
        data = tokens.lower(data)
        starts, ends, rows = tokens.words(data, offsets)
        hashes = tokens.hash_words(data, starts, ends)
        at, there = lexicon.find(hashes)
        classes = of[lexicon.units_of(data, starts, ends, hashes, (at, there))]
        held, stop = _with_ends(rows, b - a, np.where(there, classes, -1), CLASSES)
        rare = np.flatnonzero(~there)
        place = rare + rows[rare]
        left = np.where(place > 0, held[place - 1], CLASSES)
        words = tokens.gather(data, starts[rare], ends[rare])
        yield a, b - a, rows, at, there, held, stop, (words, rows[rare], place, left, held[place + 1], classes[rare])


RARE = "word string, at int, left int, right int, ending int"
RARE_NAMES = [x.split()[0] for x in RARE.split(", ")]


def _rare_columns(rare) -> list[pa.Array]:
    words, _, *numbers = rare
    return [words, *(pa.array(x.astype(np.int32)) for x in numbers)]


def _with_classes(rare: DataFrame, words: DataFrame) -> DataFrame:
    """For each row of text its words beyond the lexicon with their classes, and sums over them."""
    klass = F.coalesce("klass", "ending").alias("klass")
    return rare.join(words, "word", "left").groupBy("row").agg(
        F.count("n").alias("more_known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("rare"),
        F.collect_list(F.struct("at", "left", "right", klass)).alias("seen"),
    )


def _rare_moves(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and class pair of every move from or to a word of the lists, each move once."""
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    at, left, right, klass = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in lists.flatten().flatten())
    order = np.lexsort((at, row))
    row, at, left, right, klass = (x[order] for x in (row, at, left, right, klass))
    # A right neighbour that the lexicon lacks, too, is the next of the list.
    after = np.where(right < 0, np.append(klass[1:], 0), right)
    to = left >= 0
    return np.append(row, row[to]), np.append(klass, left[to]), np.append(after, klass[to])


MOVES = pa.list_(pa.int16())
PER_TEXT = "row long, n_tokens long, n_known long, frequent double, moves array<smallint>"


def _encode_batches(lexicon: Lexicon, of: np.ndarray, keep: list[str]):
    """For each text its sums and moves between words of the lexicon with the ``keep`` columns, then its other words."""
    logs = np.log10(lexicon.counts + 1.0)
    names = [*keep, *(x.split()[0] for x in PER_TEXT.split(", ")), *RARE_NAMES]
    kinds = [pa.int64(), pa.int64(), pa.float64(), MOVES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_row").to_numpy(zero_copy_only=False)
            for a, count, rows, at, there, held, stop, rare in _sequences(lexicon, of, batch.column("_text")):
                before = np.append(CLASSES, held[:-1])
                both = (before >= 0) & (held >= 0)
                lists = np.append(0, np.append(0, np.cumsum(both))[stop]).astype(np.int32)
                moves = pa.ListArray.from_arrays(pa.array(lists), pa.array((before * SIDE + held)[both].astype(np.int16)))
                known = np.bincount(rows[there], minlength=count)
                frequent = np.bincount(rows[there], logs[at[there]], count) if len(logs) else np.zeros(count)
                kept = [batch.column(i).slice(a, count) for i in range(len(keep))]
                sums = (np.bincount(rows, minlength=count) + 1, known, frequent, moves)
                none = [pa.nulls(count, k) for k in (pa.string(), *[pa.int32()] * 4)]
                made = [pa.array(x, k) if k != MOVES else x for x, k in zip(sums, kinds)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(ids[a : a + count]), *made, *none], names)
                size = len(rare[0])
                if size:
                    none = [pa.nulls(size, batch.schema.field(i).type) for i in range(len(keep))]
                    sums = [pa.nulls(size, k) for k in kinds]
                    yield pa.RecordBatch.from_arrays(
                        [*none, pa.array(ids[a + rare[1]]), *sums, *_rare_columns(rare)], names
                    )

    return run


def _move_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            row, a, b = _rare_moves(batch.column("seen"))
            order = np.argsort(row, kind="stable")
            stops = np.append(0, np.cumsum(np.bincount(row, minlength=batch.num_rows))).astype(np.int32)
            moves = pa.ListArray.from_arrays(pa.array(stops), pa.array((a * SIDE + b)[order].astype(np.int16)))
            names = ["row", "more_known", "rare"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), moves], [*names, "moves"])


def _encode(docs: DataFrame, lexicon: Lexicon, of: np.ndarray, words: DataFrame, text: str = "text",
            keep: tuple[str, ...] = (), held_out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Each text once: its ``keep`` columns (as _0, _1, ..), sums and moves between classes, staged.

    The second frame has for texts with words beyond the lexicon what these add. Rows of ``held_out``
    texts have odd numbers.
    """
    # Kept columns go under numbers meanwhile, so that they cannot clash.
    inside = [f"_{i}" for i in range(len(keep))]
    kept = [F.col(f"`{c}`").alias(n) for c, n in zip(keep, inside)]
    ddl = ", ".join([*(f"{n} {kind}" for n, kind in docs.select(*kept).dtypes), PER_TEXT, RARE])
    odd = F.coalesce(F.col(held_out), F.lit(False)).cast("long") if held_out else F.lit(0).cast("long")
    row = (F.monotonically_increasing_id() * 2 + odd).alias("_row")
    narrow = docs.select(*kept, row, F.col(text).alias("_text"))
    rows = stage(narrow.mapInArrow(_encode_batches(lexicon, of, inside), ddl), "encoded")
    rare = _with_classes(rows.where("word IS NOT NULL").select("row", *RARE_NAMES), words)
    rare = rare.mapInArrow(_move_lists, "row long, more_known long, rare double, moves array<smallint>")
    return rows.where("word IS NULL").drop(*RARE_NAMES), stage(rare, "beyond")


def _count_moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SIDE * SIDE, np.int64)
    for batch in batches:
        total += np.bincount(batch.column("moves").flatten().to_numpy(zero_copy_only=False), minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["move", "n"])


def _class_pairs(encoded: tuple[DataFrame, DataFrame]) -> np.ndarray:
    """Counts of class pairs over all texts that are not held out."""
    both = encoded[0].select("row", "moves").unionByName(encoded[1].select("row", "moves"))
    counted = both.where("row % 2 = 0").select("moves").mapInArrow(_count_moves, "move long, n long")
    out = np.zeros(SIDE * SIDE)
    for r in counted.groupBy("move").agg(F.sum("n").alias("n")).collect():
        out[r["move"]] = r["n"]
    return out.reshape(SIDE, SIDE)


@dataclass
class ClassModel:
    """All that scoring needs besides the counts of rare words; ``classes`` are theirs (word, klass)."""

    lexicon: Lexicon
    of: np.ndarray
    context: np.ndarray
    tokens: int
    distinct: int
    ends: int
    classes: DataFrame | None


def _learn(texts: DataFrame) -> tuple[Lexicon, np.ndarray, DataFrame, DataFrame]:
    """The lexicon with classes, classes of units, the staged vocabulary, and classes beyond the lexicon."""
    texts = texts.select("text")
    vocabulary = stage(count_words(texts), "vocabulary")
    lexicon = frequent_words(vocabulary)
    of, joint = cluster(stage(count_pairs(texts, lexicon), "pairs"))
    placed = place(texts, lexicon, of, joint)
    of = np.append(of, np.arange(CLASSES))
    beyond = vocabulary.select("word").mapInArrow(_beyond(lexicon), "word string, hash long")
    classes = stage(beyond.join(placed, "hash").select("word", "klass"), "classes")
    return _with_placed(lexicon, placed), of, vocabulary, classes


def _model(lexicon: Lexicon, of: np.ndarray, classes: DataFrame, joint: np.ndarray, class_weight: float) -> ClassModel:
    words = np.bincount(of[lexicon.units], minlength=CLASSES + 1).astype(float)
    for r in classes.groupBy("klass").agg(F.count("*").alias("n")).collect():
        words[r["klass"]] += r["n"]
    in_class = joint.sum(axis=0)
    ends = int(in_class[CLASSES])
    words[CLASSES] = min(ends, 1)
    total, distinct = int(in_class.sum()), int(words.sum())
    # Witten-Bell over the shares of the classes.
    share = (in_class + 1) / (total + len(in_class))
    kinds = np.maximum((joint > 0).sum(axis=1, keepdims=True), 1)
    moves = (joint + kinds * share[None, :]) / (joint.sum(axis=1, keepdims=True) + kinds)
    emission = class_weight * moves / (in_class + words + 1)[None, :]
    context = np.log10(emission + (1 - class_weight) / (total + distinct + CLASSES + 1))
    return ClassModel(lexicon, of, context, total, distinct, ends, classes)


def train(texts: DataFrame, class_weight: float = CLASS_WEIGHT) -> tuple[ClassModel, DataFrame]:
    """The model and the staged vocabulary (word, n) of all ``texts`` (column text)."""
    lexicon, of, vocabulary, classes = _learn(texts)
    encoded = _encode(texts, lexicon, of, vocabulary.join(classes, "word"))
    return _model(lexicon, of, classes, _class_pairs(encoded), class_weight), vocabulary


def _context_sums(context: np.ndarray, kept: list[str]):
    """Log probabilities of the moves of each row in place of the moves."""
    values = context.ravel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = batch.column("moves")
                row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
                sums = np.bincount(row, values[lists.flatten().to_numpy(zero_copy_only=False)], batch.num_rows)
                yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(sums, pa.float64())], [*kept, "context"])

    return run


def _scores(encoded: tuple[DataFrame, DataFrame], model: ClassModel, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and scores of encoded texts."""

    def summed(df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c != "moves"]
        ddl = ", ".join([*(f"{n} {kind}" for n, kind in df.dtypes if n != "moves"), "context double"])
        return df.mapInArrow(_context_sums(model.context, kept), ddl)

    rows, rare = encoded
    joined = summed(rows).join(summed(rare).withColumnRenamed("context", "moved"), "row", "left")
    logs = F.col("frequent") + F.lit(float(np.log10(model.ends + 1.0))) + F.coalesce("rare", F.lit(0.0))
    context = F.col("context") + F.coalesce("moved", F.lit(0.0))
    known = F.col("n_known") + F.lit(int(model.ends > 0)) + F.coalesce("more_known", F.lit(0))
    base = F.log10(F.lit(float(max(1, model.tokens + model.distinct + 1))))
    return joined.select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "n_tokens", known.alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * base).alias("base_score"), (logs + context).alias("score"),
    )


def score(docs: DataFrame, model: ClassModel, vocabulary: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns of every document with n_tokens, n_known, train_tokens, base_score, score."""
    words = vocabulary.join(model.classes, "word")
    return _scores(_encode(docs, model.lexicon, model.of, words, text, tuple(keep)), model, keep)


def train_and_score(docs: DataFrame, keep: list[str], held_out: str, class_weight: float = CLASS_WEIGHT) -> DataFrame:
    """``train`` on the rows that are not ``held_out`` and ``score`` of all, which are encoded once for both."""
    texts = docs.where(~F.coalesce(F.col(held_out), F.lit(False)))
    lexicon, of, vocabulary, classes = _learn(texts)
    encoded = _encode(docs, lexicon, of, vocabulary.join(classes, "word"), "text", tuple(keep), held_out)
    return _scores(encoded, _model(lexicon, of, classes, _class_pairs(encoded), class_weight), keep)
