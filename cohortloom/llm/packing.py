"""Best-fit packing by minimum bin slack.

Texts become token ids, ended by END; only texts longer than a sequence are cut. How well
pieces pack depends on their lengths alone, so the driver gets the number of pieces of each length
(CAPACITY rows at most). Bin by bin, the longest length left is completed by the fullest feasible
combination, which a bitset subset-sum over the lengths still available finds; the combination is
removed, as often as it is available, as one pattern. The n-th piece of a length then finds its
sequence and offset by a search in the patterns, without moving the pieces.

Words are encoded once each and told apart by 64-bit hashes in which each byte counts at its place. The tokenizer's special tokens count where
they stand in their exact case, as they do by default.

Nulls: a null text is empty; an empty text is one piece of one id. Repeated rows are packed once
each. Pieces of equal length are interchangeable and are numbered as they were read. Empty
tables give no rows. Input columns that bear the names of output columns are replaced.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortloom.llm import tokens
from cohortloom.llm.staging import stage

CAPACITY = 2048
END = 0
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# Distinct words whose ids a Python worker remembers (about 50 bytes each).
REMEMBERED = 1_000_000
_STOPS = np.zeros(256, bool)
_STOPS[list(b".,;:!?")] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True


def _parts(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray):
    """Words with the stops at their ends apart, where those follow a plain letter or digit.

    The tokenizer parts there, too, so the ids are the same and fewer words are distinct.
    """
    other = np.maximum.accumulate(np.where(_STOPS[low], -1, np.arange(len(low))))
    cut = other[ends - 1] + 1
    apart = (cut > starts) & (cut < ends) & _PLAIN[low[np.maximum(cut - 1, 0)]]
    at = np.arange(len(starts)) + np.cumsum(apart) - apart
    out = [np.empty(len(starts) + apart.sum(), np.int64) for _ in range(3)]
    for made, first, second in zip(out, (starts, np.where(apart, cut, ends), rows), (cut, ends, rows)):
        made[at] = first
        made[at[apart] + 1] = second[apart]
    return out


def _marked(data: np.ndarray, markers: list[bytes], starts, ends, rows):
    """Words with the markers in them apart, and which marker each is (-1: none); they hold no white space."""
    raw = data.tobytes()
    found = [(m.start(), m.end(), markers.index(m.group())) for m in _pattern(markers).finditer(raw)]
    if not found:
        return starts, ends, rows, None
    pieces = []
    inside = np.searchsorted(starts, [a for a, _, _ in found], side="right") - 1
    begin = starts.copy()
    for w, (a, b, which) in zip(inside.tolist(), found):
        if b > ends[w]:  # the end of one text and the beginning of the next
            continue
        if begin[w] < a:
            pieces.append((begin[w], a, rows[w], -1))
        pieces.append((a, b, rows[w], which))
        begin[w] = b
    rest = np.flatnonzero(begin < ends)
    apart = np.array(pieces, np.int64).reshape(-1, 4)
    whole = np.stack([begin[rest], ends[rest], rows[rest], np.full(len(rest), -1)], axis=1)
    both = np.concatenate([apart, whole])
    return both[np.argsort(both[:, 0], kind="stable")].T


def _pattern(markers: list[bytes]):
    return re.compile(b"|".join(re.escape(m) for m in sorted(markers, key=len, reverse=True)))


class WordIds:
    """Token ids of words separated by white space, which the tokenizer drops; each is encoded once.

    The tokenizer works in lower case, so words are told apart by their lower-case form (A-Z).
    """

    _known: dict[str, WordIds] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder()
        self.markers = [t.content.encode() for t in special.values()]
        self.special = np.array(list(special), np.int32)
        # Markers are cut out before; what lower-casing makes look like one is not one.
        self.tokenizer.encode_special_tokens = True
        self._forget()

    @classmethod
    def of(cls, path: str) -> WordIds:
        if path not in cls._known:
            cls._known[path] = cls(path)
        return cls._known[path]

    def _forget(self) -> None:
        """Remember the special tokens alone, in the first places."""
        self.hashes, self.places = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.offsets, self.ids = np.arange(len(self.special) + 1, dtype=np.int64), self.special

    def _places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the ids of each word are remembered."""
        distinct, first, which = np.unique(tokens.hash_words(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.hashes, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.hashes)
        new[inside] = distinct[inside] != self.hashes[at[inside]]
        if new.any():
            words = tokens.gather(data, starts[first[new]], ends[first[new]]).to_pylist()
            made = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            sizes = np.fromiter(map(len, made), np.int64, len(made))
            places = len(self.offsets) - 1 + np.arange(len(made))
            self.ids = np.concatenate([self.ids, np.fromiter((i for x in made for i in x), np.int32, sizes.sum())])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])
            self.hashes = np.insert(self.hashes, at[new], distinct[new])
            self.places = np.insert(self.places, at[new], places)
        return self.places[np.searchsorted(self.hashes, distinct)][which]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of texts, each text ended by END, and the number of ids of each."""
        starts, ends, rows = tokens.words(data, offsets)
        starts, ends, rows, marker = _marked(data, self.markers, starts, ends, rows)
        data = tokens.lower(data)
        if len(starts) and marker is None:
            starts, ends, rows = _parts(data, starts, ends, rows)
        place = self._places(data, starts, ends) if len(starts) else np.empty(0, np.int64)
        if marker is not None:
            place = np.where(marker >= 0, marker, place)
        begin, size = self.offsets[place], self.offsets[place + 1] - self.offsets[place]
        upto = np.cumsum(size)
        count = len(offsets) - 1
        per_row = np.bincount(rows, size, count).astype(np.int64) + 1
        out = np.full(per_row.sum(), END, np.int32)
        if len(size) and upto[-1]:
            source = np.arange(upto[-1]) + np.repeat(begin - (upto - size), size)
            out[np.arange(upto[-1]) + np.repeat(rows, size)] = self.ids[source]
        return out, per_row


PIECE = "piece int, start long, length long, ids_crc32 long, chunk int, nth long"


def pieces(docs: DataFrame, id_column: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
           capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of all texts, with their ids on demand; (chunk, nth) numbers those of a length in a task."""
    narrow = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    schema = f"id {dict(narrow.dtypes)['id']}, {PIECE}" + (", ids array<int>" if keep_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, chunk = WordIds.of(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for a, _, data, offsets in tokens.text_blocks(batch.column("text"), 2 * tokens.BLOCK):
                ids, per_row = encoder.encode(data, offsets)
                count = -(-per_row // capacity)
                row = np.repeat(np.arange(len(per_row)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(per_row[row] - start, capacity)
                begin = (np.cumsum(per_row) - per_row)[row] + start
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * x : 4 * (x + n)]) for x, n in zip(begin.tolist(), length.tolist())]
                order = np.argsort(length, kind="stable")
                new = np.flatnonzero(np.append(True, length[order][1:] != length[order][:-1]))
                within = np.arange(len(order)) - np.repeat(new, np.diff(np.append(new, len(order))))
                nth = np.empty(len(order), np.int64)
                nth[order] = seen[length[order]] + within
                seen += np.bincount(length, minlength=capacity + 1)
                columns = [
                    batch.column("id").take(pa.array(a + row)), pa.array(piece.astype(np.int32)), pa.array(start),
                    pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(row), chunk, np.int32)), pa.array(nth),
                ]
                if keep_ids:
                    bounds = np.append(begin, len(ids)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(columns, names)

    return narrow.mapInArrow(cut, schema)


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """The combination of available lengths (descending) that fills ``room`` best."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in lengths:
        if length > room or not counts[length]:
            continue
        before, left, take = reach, min(counts[length], room // length), 1
        while left:
            now = min(take, left)
            reach |= (reach << (length * now)) & mask
            left, take = left - now, take * 2
        steps.append((length, before))
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        while not before >> total & 1:
            chosen.append(length)
            total -= length
    return chosen


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, how many sequences) until no piece is left."""
    counts = {k: v for k, v in counts.items() if v}
    lengths, made = sorted(counts, reverse=True), []
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        found = [longest, *fullest(lengths, counts, capacity - longest)]
        counts[longest] += 1
        used = {x: found.count(x) for x in set(found)}
        times = min(counts[x] // n for x, n in used.items())
        for x, n in used.items():
            counts[x] -= n * times
        made.append((found, times))
        lengths = [x for x in lengths if counts[x]]
    return made


def _segments(made: list[tuple[list[int], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length and first number, first sequence, offset) of runs of pieces, sorted by the first."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, times in made:
        offset = 0
        for x in lengths:
            rows.append(((x << 48) + used.get(x, 0), sequence, offset))
            used[x] = used.get(x, 0) + times
            offset += x
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` with sequence_id and offset; reads ``cut`` twice, so it should be staged."""
    by_chunk = cut.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("chunk")) - F.col("n")
    numbered = stage(by_chunk.withColumn("before", before), "numbered")
    counts = {r["length"]: r["n"] for r in numbered.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    keys, sequences, offsets = _segments(patterns(counts, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        key = (length.to_numpy() << 48) + number.to_numpy()
        at = np.searchsorted(keys, key, side="right") - 1
        return pd.DataFrame({"sequence_id": sequences[at] + key - keys[at], "offset": offsets[at]})

    joined = cut.join(numbered.select("length", "chunk", "before"), ["length", "chunk"])
    found = joined.withColumn("_place", find("length", F.col("before") + F.col("nth")))
    return found.select(*[c for c in cut.columns if c not in ("chunk", "nth")], "_place.*")


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of placed pieces that carry their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))


def pack(docs: DataFrame, **options) -> DataFrame:
    """All pieces of ``docs`` with their places; see ``pieces`` for the options."""
    capacity = options.get("capacity", CAPACITY)
    return place(stage(pieces(docs, **options), "pieces"), capacity)
