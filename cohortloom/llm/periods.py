"""Periodic runs of words found by internal pattern matching.

A run is a stretch of consecutive words with smallest period q and at least max(LEAST, EXPONENT q)
words that neither neighbour extends keeping the period. It holds an aligned (dyadic) block of 2^k
words, the largest power of two up to 2q, and the next occurrence of that block on one side or the
other lies exactly q words away: a block of q words or more with smallest period q cannot occur in between.

All documents of a batch get one suffix array, by prefix doubling; words of different documents never
count as equal, so it is the suffix arrays of the documents side by side. After k doublings the
suffixes that begin with the same 2^k words are an interval of it. For each aligned block that is not
alone in its interval, its occurrences in the neighbouring windows of 2^k words are found by range
successor and predecessor in a wavelet tree over the suffix array: how many positions of the interval
are smaller (a rank), and the ones before and after (quantiles). The distance d to either, from
2^(k-1) up to but not including 2^k, starts a progression and is a candidate period. Blocks with the same
distance that touch are joined, and each stretch is extended word by word to both sides, which is
less than two blocks each. What is long enough is a run; of runs with equal ends the smallest period counts.
The wavelet tree is walked from the top bit for all queries together, and no level of it is kept.

A document is worked on in one task; nothing is moved between tasks. Null and empty texts have no
words and no run. A very long text is a batch by itself: about 60 bytes for each of its words. Ties
between runs go by start, then period. Repeated rows each have their row, an empty table has none.
Only id and text are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import tokens
from cohortloom.llm.balance import WORD

# A run has this many words and periods at least.
LEAST = 6
EXPONENT = 4
# Words whose bytes are put together at once.
JOINED = 1 << 17


def damaged(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, text: of ids with h = crc32(id as text) divisible by 10, words from the a-th on repeat the first p of them.

    With n words and g = floor(h / 10): a = g % n, p = 1 + floor((n - a) / (3 + g % 8)). A null id counts
    as an empty text.
    """
    h = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    chosen = F.when(h % 10 == 0, F.filter(words, lambda w: w != ""))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), h.alias("h"), chosen.alias("words"))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    rows = rows.withColumns({"n": n.cast("long"), "g": g}).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))

    def source(i: Column) -> Column:
        a, p = F.col("a"), F.col("p")
        at = F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.element_at("words", (at + 1).cast("int"))

    repeated = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), source), " ")
    return rows.select("id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def _symbols(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, count: int):
    """One number per word, equal for equal words of a document, with a separator before and after each.

    Also the place of each document's first word among them.
    """
    ids = np.empty(len(starts), np.int64)
    if len(starts):
        ids[:] = tokens.gather(data, starts, ends).dictionary_encode().indices.to_numpy()
    kinds = len(starts) + 1
    place = np.arange(len(starts)) + rows + 1
    out = (np.arange(len(starts) + count + 1) + 1) * -1
    out[place] = ids + rows * kinds
    first = np.searchsorted(rows, np.arange(count)) + np.arange(count) + 1
    return out, first


def _groups(keys: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys in slots of the suffix array: the first slot of each one's group, and whether it has others."""
    new = np.ones(len(keys) + 1, bool)
    new[1:-1] = keys[1:] != keys[:-1]
    begin = slots[np.maximum.accumulate(np.where(new[:-1], np.arange(len(keys)), 0))]
    return begin, ~(new[:-1] & new[1:])


def _blocks(symbols: np.ndarray, most: int):
    """The suffix array (as far as blocks of up to ``most`` words need it) and the blocks not alone in it.

    A block is (position, level, first slot, slot after the last) of its interval.
    """
    order = np.argsort(symbols, kind="stable").astype(np.int32)
    slots = np.arange(len(symbols), dtype=np.int32)
    begin, shared = _groups(symbols[order], slots)
    rank = np.empty(len(symbols), np.int32)
    rank[order] = begin
    slots, found, level = slots[shared], [], 0
    while len(slots):
        if level:
            at = order[slots]
            edge = np.flatnonzero(np.append(True, rank[at][1:] != rank[at][:-1]))
            size = np.diff(np.append(edge, len(at)))
            low = np.repeat(slots[edge], size)
            aligned = at & ((1 << level) - 1) == 0
            found.append((at[aligned], np.full(aligned.sum(), level), low[aligned], (low + np.repeat(size, size))[aligned]))
        if 2 << level > most:
            break
        at = order[slots]
        keys = rank[at].astype(np.int64) * len(symbols) + rank[np.minimum(at + (1 << level), len(symbols) - 1)]
        by_key = np.argsort(keys, kind="stable")
        at, keys = at[by_key], keys[by_key]
        begin, shared = _groups(keys, slots)
        order[slots], rank[at] = at, begin
        slots, level = slots[shared], level + 1
    if not found:
        none = np.empty(0, np.int64)
        return order, none, none, none, none
    return order, *(np.concatenate(x).astype(np.int64) for x in zip(*found))


def _levels(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The wavelet tree of ``values`` from the top: each bit, and how many zeros stand before each place."""
    for bit in range(int(len(values) - 1).bit_length() - 1, -1, -1):
        one = (values >> bit) & 1 == 1
        zeros = np.zeros(len(values) + 1, np.int32)
        np.cumsum(~one, out=zeros[1:])
        yield bit, zeros
        values = np.concatenate([values[~one], values[one]])


def _down(zeros, low, high, right):
    """The ranges in the next level, to the zeros or to the ones."""
    low0, high0 = zeros[low], zeros[high]
    total = zeros[-1]
    return np.where(right, total + low - low0, low0), np.where(right, total + high - high0, high0), high0 - low0


def _neighbours(order, low, high, position):
    """Next greater and next smaller position in each range of the suffix array, or -1."""
    smaller, a, b = np.zeros(len(position), np.int64), low, high
    for bit, zeros in _levels(order):
        right = (position >> bit) & 1 == 1
        a, b, inside = _down(zeros, a, b, right)
        smaller += np.where(right, inside, 0)
    nth = np.concatenate([smaller + 1, smaller - 1])
    low, high = np.tile(low, 2), np.tile(high, 2)
    valid = (nth >= 0) & (nth < high - low)
    nth, a, b = np.where(valid, nth, 0), low, high
    value = np.zeros(len(nth), np.int64)
    for bit, zeros in _levels(order):
        inside = zeros[b] - zeros[a]
        right = nth >= inside
        nth = np.where(right, nth - inside, nth)
        value |= right.astype(np.int64) << bit
        a, b, _ = _down(zeros, a, b, right)
    value[~valid] = -1
    return value[: len(position)], value[len(position) :]


def _extended(symbols, at, distance, step: int) -> np.ndarray:
    """How many words further (``step`` 1) or before (-1) each place still equal those ``distance`` later."""
    out, active, width = np.zeros(len(at), np.int64), np.arange(len(at)), 8
    last = len(symbols) - 1
    while len(active):
        here = (at[active] + step * out[active])[:, None] + step * np.arange(width)
        there = here + distance[active][:, None]
        same = symbols[np.clip(here, 0, last)] == symbols[np.clip(there, 0, last)]
        # A separator equals nothing, but a clipped place may be compared with itself.
        same &= (here >= 0) & (there <= last)
        run = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
        out[active] += run
        active = active[run == width]
        width = max(8, min(width * 2, (1 << 20) // max(len(active), 1)))
    return out


def find_runs(symbols: np.ndarray, longest: int, least: int = LEAST, exponent: int = EXPONENT):
    """start, length, period of all runs in ``symbols``, by start, then period.

    ``longest`` is the length of the longest document.
    """
    order, at, level, low, high = _blocks(symbols, longest // 2)
    after, before = _neighbours(order, low, high, at)
    width = np.int64(1) << level
    start, period, size = [], [], []
    for other in (after, before):
        distance = np.abs(other - at)
        near = (other >= 0) & (2 * distance >= width) & (distance < width)
        start.append(np.minimum(at, other)[near])
        period.append(distance[near])
        size.append(width[near])
    start, period, size = map(np.concatenate, (start, period, size))
    by = np.lexsort((start, period))
    start, period, size = start[by], period[by], size[by]
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] > start[:-1] + size[:-1])
    first = np.flatnonzero(new)
    ends = (start + size)[np.append(first[1:], len(start)) - 1] if len(first) else first
    start, period = start[first], period[first]
    ends = ends + _extended(symbols, ends, period, 1) + period
    start = start - _extended(symbols, start - 1, period, -1)
    length = ends - start
    enough = length >= np.maximum(least, exponent * period)
    runs = np.unique(np.stack([start, length, period], axis=1)[enough], axis=0)
    if len(runs):
        runs = runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1))]
    by = np.lexsort((runs[:, 2], runs[:, 0]))
    return runs[by]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """Words with one space after each."""
    lengths = ends - starts + 1
    upto = np.cumsum(lengths)
    out = np.full(int(upto[-1]) if len(upto) else 0, 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[upto - 1] = False
    source = np.arange(len(out)) + np.repeat(starts - (upto - lengths), lengths)
    out[inside] = data[source[inside]]
    return out.tobytes()


def _digests(data: np.ndarray, starts, ends, rows, count: int) -> list[str]:
    """SHA-256 of the words of each row, joined by one space."""
    out = []
    bounds = np.searchsorted(rows, np.arange(count + 1))
    if len(starts) <= JOINED:
        joined = _joined(data, starts, ends)
        places = np.append(0, np.cumsum(ends - starts + 1))[bounds].tolist()
        return [hashlib.sha256(joined[a : max(a, b - 1)]).hexdigest() for a, b in zip(places, places[1:])]
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        digest = hashlib.sha256()
        for c in range(a, b, JOINED):
            d = min(b, c + JOINED)
            part = _joined(data, starts[c:d], ends[c:d])
            digest.update(part if d < b else part[:-1])
        out.append(digest.hexdigest())
    return out


FOUND = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _found(least: int, exponent: int, name: str):
    names = [name, *[x.split()[0] for x in FOUND.split(", ")]]

    def block(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        count = len(offsets) - 1
        starts, ends, rows = tokens.words(data, offsets)
        symbols, first = _symbols(data, starts, ends, rows, count)
        sizes = np.bincount(rows, minlength=count)
        runs = find_runs(symbols, int(sizes.max(initial=0)), least, exponent)
        row = np.searchsorted(first, runs[:, 0], side="right") - 1
        change = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        kept = np.cumsum(change)[np.arange(len(starts)) + rows + 1] == 0
        collapsed = _digests(data, starts[kept], ends[kept], rows[kept], count)
        own = np.stack([runs[:, 0] - first[row], runs[:, 1], runs[:, 2]], axis=1)
        bounds = np.searchsorted(row, np.arange(count + 1)).tolist()
        best = np.lexsort((own[:, 2], own[:, 0], -own[:, 1], row))
        longest, digests = [], []
        for a, b in zip(bounds, bounds[1:]):
            longest.append(own[best[a]].tolist() if b > a else [None] * 3)
            lines = "".join(f"{s},{n},{q}\n" for s, n, q in own[a:b].tolist())
            digests.append(hashlib.sha256(lines.encode()).hexdigest())
        milli = [None if n is None else 1000 * n // q for _, n, q in longest]
        columns = [np.diff(bounds).tolist(), *map(list, zip(*longest)), milli]
        return [pa.array(c, pa.int64()) for c in columns] + [pa.array(digests), pa.array(collapsed)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tokens.text_blocks(batch.column("text")):
                columns = block(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), *columns], names)

    return run


def runs(docs: DataFrame, id_column: str = "id", text: str = "text", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """id, number of runs, the longest one, digests of all runs and of the text without their repeats, per row."""
    narrow = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    return narrow.mapInArrow(_found(least, exponent, "id"), f"id {dict(narrow.dtypes)['id']}, {FOUND}")
