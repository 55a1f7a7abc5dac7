"""Removal of repeated strings of LENGTH bytes by a hash-compared suffix sort.

Strings of LENGTH bytes that are equal have the same least-hashed K-gram at the same place, so
only strings that share it need comparing. Each text is cut into blocks, the runs of starts whose
strings have their least K-gram at the same position: one row instead of dozens. Blocks with a
K-gram that occurs once are done; so are blocks of which an equal one exists. What remains are
the edges of repeats. Their bytes are fetched, and the suffixes at their starts are sorted by
mergesorts, one for each K-gram and distance from it, all advanced together: two suffixes are
compared by a binary search for their common extension over prefix polynomial hashes. Neighbours
with LENGTH bytes in common are verified byte by byte.

Groups of more than LARGE different blocks are not sorted in one task: their strings are grouped
as they are by an aggregate that sums up before the shuffle.

Nulls: a null text is empty. A text shorter than LENGTH keeps all its bytes. Repeated rows and
copies are texts of their own, so all their bytes go from LENGTH bytes on. Removal works on bytes
and may cut a character. Empty tables give no rows. Only the id and the text are read besides the
row key, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import bitmaps, tokens
from cohortloom.llm.staging import row_keys, stage

LENGTH = 200
GRAM = 64
# Bytes of a very long text that are cut into blocks together.
SEGMENT = 4 << 20
# Bytes of blocks that are sorted together, and different blocks of a K-gram that may be.
CHUNK = 2 << 20
LARGE = 20_000
MAP_BITS = 1 << 24
_PLACE_BITS = np.uint64(24)
BLOCK = "key_a long, key_b long, start long, starts int, anchor int, gram long, content long"
_NAMES = [x.split()[0] for x in BLOCK.split(", ")]


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every full window."""
    padded = np.concatenate([values, np.full(-len(values) % width, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def cut_blocks(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, start, starts, anchor, gram hash, content hash) of the blocks of each row."""
    starts = np.arange(max(0, len(data) - gram + 1))
    if len(data) < length:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    prefix = tokens.prefix_hash(data)
    grams = tokens.span_hash(prefix, starts, starts + gram)
    # Of equal hashes the first place wins, which depends on the string only.
    keyed = (grams >> _PLACE_BITS << _PLACE_BITS) | starts.astype(np.uint64)
    least = _window_least(keyed, length - gram + 1)
    place = (least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    start = np.arange(len(place))
    row = np.searchsorted(offsets, start, side="right") - 1
    inside = start + length <= offsets[row + 1]
    start, place, row = start[inside], place[inside], row[inside]
    if not len(start):
        return start, start, start, start, start.astype(np.uint64), start.astype(np.uint64)
    new = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (row[1:] != row[:-1])))
    count = np.diff(np.append(new, len(start)))
    first, at = start[new], place[new]
    content = tokens.span_hash(prefix, first, first + count - 1 + length)
    return row[new], first - offsets[row[new]], count, at - first, grams[at], content


def _segments(column: pa.Array, length: int):
    """Blocks of text of bounded size: a very long row is cut so that no string is lost."""
    for a, b, data, offsets in tokens.text_blocks(column):
        if len(data) <= SEGMENT + length:
            yield a, b, 0, data, offsets
            continue
        for begin in range(0, len(data) - length + 1, SEGMENT):
            part = data[begin : begin + SEGMENT + length - 1]
            yield a, b, begin, part, np.array([0, len(part)])


def block_rows(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """All blocks of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            for a, _, begin, data, offsets in _segments(batch.column(2), length):
                row, start, starts, anchor, grams, content = cut_blocks(data, offsets, length, gram)
                if len(row):
                    columns = [
                        keys[0][a + row], keys[1][a + row], start + begin, starts.astype(np.int32),
                        anchor.astype(np.int32), grams.view(np.int64), content.view(np.int64),
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _NAMES)

    return docs.select(*row_keys(docs), F.col(text)).mapInArrow(run, BLOCK)


class Suffixes:
    """Comparison of the suffixes of a text over its prefix hashes."""

    def __init__(self, text: np.ndarray, length: int):
        self.length = length
        self.text = np.concatenate([text, np.zeros(8, np.uint8)])
        self.prefix = tokens.prefix_hash(text)
        self.down = tokens.powers(len(self.prefix))[1]
        self.words = np.lib.stride_tricks.as_strided(
            np.frombuffer(self.text.tobytes(), np.uint64, 1), (len(text) + 1,), (1,), writeable=False
        )

    def _same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        x = (self.prefix[a + n] - self.prefix[a]) * self.down[a]
        return x == (self.prefix[b + n] - self.prefix[b]) * self.down[b]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that two suffixes have in common, LENGTH at most."""
        low = np.zeros(len(a), np.int64)
        whole = self._same(a, b, np.full(len(a), self.length))
        low[whole] = self.length
        open_ = np.flatnonzero(~whole)
        high = np.full(len(open_), self.length - 1)
        least = np.zeros(len(open_), np.int64)
        a, b = a[open_], b[open_]
        for _ in range(int(self.length - 1).bit_length()):
            middle = (least + high + 1) >> 1
            same = self._same(a, b, middle)
            least = np.where(same, middle, least)
            high = np.where(same, high, middle - 1)
        low[open_] = least
        return low

    def less(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the first suffix is less, and whether both are equal."""
        common = self.common(a, b)
        equal = common == self.length
        return ~equal & (self.text[a + common] < self.text[b + common]), equal

    def equal_bytes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytewise equality over LENGTH bytes, eight at a time."""
        out = np.ones(len(a), bool)
        for n in [*range(0, self.length - 7, 8), self.length - 8]:
            out &= self.words[a + n] == self.words[b + n]
        return out


def merge_sorted(suffixes: Suffixes, places: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sort the suffixes inside each group (first, size of its places); all groups merge together."""
    places = places.copy()
    width = 1
    while len(active := np.flatnonzero(size > width)):
        n = size[active]
        begin = np.repeat(first[active], n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        end = begin + np.repeat(n, n)
        run = within // width
        own = begin + run * width
        pair = begin + (run // 2) * 2 * width
        right = run % 2 == 1
        low = np.where(right, pair, np.minimum(pair + width, end))
        other = low.copy()
        high = np.where(right, pair + width, np.minimum(pair + 2 * width, end))
        at = begin + within
        mine = places[at]
        # Rank in the other run: a right element goes behind equal left ones.
        while len(still := np.flatnonzero(low < high)):
            middle = (low[still] + high[still]) >> 1
            before, equal = suffixes.less(places[middle], mine[still])
            before |= equal & right[still]
            low[still] = np.where(before, middle + 1, low[still])
            high[still] = np.where(before, high[still], middle)
        moved = pair + (at - own) + (low - other)
        places[moved] = mine
        width *= 2
    return places


def repeated_starts(text: np.ndarray, block_first, starts, anchor, group, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(block, start in it) of the strings that another block of the group holds, too."""
    block = np.repeat(np.arange(len(starts)), starts)
    start = np.arange(len(block)) - np.repeat(np.cumsum(starts) - starts, starts)
    distance = anchor[block] - start
    order = np.lexsort((distance, group[block]))
    block, start, distance = block[order], start[order], distance[order]
    new = np.flatnonzero(
        np.append(True, (group[block][1:] != group[block][:-1]) | (distance[1:] != distance[:-1]))
    )
    size = np.diff(np.append(new, len(block)))
    places = block_first[block] + start
    suffixes = Suffixes(text, length)
    # The sort moves places; each belongs to one block and start.
    by_place = np.argsort(places, kind="stable")
    ordered = merge_sorted(suffixes, places, new, size)
    neighbours = np.ones(max(0, len(ordered) - 1), bool)
    neighbours[new[1:] - 1] = False
    at = np.flatnonzero(neighbours)
    same = suffixes._same(ordered[at], ordered[at + 1], np.full(len(at), length))
    at = at[same]
    verified = suffixes.equal_bytes(ordered[at], ordered[at + 1])
    marked = np.zeros(len(ordered), bool)
    marked[at[verified]] = marked[at[verified] + 1] = True
    if not verified.all():
        # Colliding hashes: these groups are compared as they are.
        for g in np.unique(np.searchsorted(new, at[~verified], side="right") - 1):
            seen: dict[bytes, list[int]] = {}
            for k in range(new[g], new[g] + size[g]):
                seen.setdefault(text[ordered[k] : ordered[k] + length].tobytes(), []).append(k)
            for members in seen.values():
                marked[members] = len(members) > 1
    found = by_place[np.searchsorted(places[by_place], ordered[marked])]
    return block[found], start[found]


SPAN = "key_a long, key_b long, first long, last long"


def _spans(keys, begin, block, start, length: int) -> pa.RecordBatch | None:
    """Runs of neighbouring starts as spans of bytes."""
    if not len(block):
        return None
    order = np.lexsort((start, block))
    block, start = block[order], start[order]
    new = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (start[1:] != start[:-1] + 1)))
    last = np.append(new[1:] - 1, len(block) - 1)
    at = block[new]
    columns = [keys[0][at], keys[1][at], begin[at] + start[new], begin[at] + start[last] + length]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key_a", "key_b", "first", "last"])


def _sort_chunks(length: int):
    def work(table: pa.Table) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        column = lambda n: table.column(n).to_numpy()
        bytes_ = table.column("bytes").combine_chunks()
        bytes_ = bytes_.chunk(0) if isinstance(bytes_, pa.ChunkedArray) else bytes_
        bytes_ = bytes_.cast(pa.large_binary())
        offsets = np.frombuffer(bytes_.buffers()[1], np.int64)[bytes_.offset : bytes_.offset + len(bytes_) + 1]
        text = np.frombuffer(bytes_.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        starts, anchor, group = column("starts").astype(np.int64), column("anchor").astype(np.int64), column("gram")
        block, start = repeated_starts(text, offsets[:-1], starts, anchor, group, length)
        single = ~column("several")[block]
        return _spans([column("key_a"), column("key_b")], column("start"), block[single], start[single], length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) < CHUNK:
                continue
            # Up to the last K-gram, of which more blocks may follow.
            table = pa.Table.from_batches(held)
            grams = table.column("gram").to_numpy()
            cut = int(np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))[-1])
            if cut and (made := work(table.slice(0, cut))) is not None:
                yield made
            held = table.slice(cut).combine_chunks().to_batches()
        if held and (made := work(pa.Table.from_batches(held))) is not None:
            yield made

    return run


def _large_groups(rows: DataFrame, length: int) -> DataFrame:
    """Spans of the blocks of very large groups, by grouping their strings as they are."""
    at = F.explode(F.sequence(F.lit(0), F.col("starts") - 1)).alias("at")
    strings = rows.select("key_a", "key_b", "start", "starts", "several", "gram", "anchor", "bytes", at)
    strings = strings.select(
        "key_a", "key_b", (F.col("start") + F.col("at")).alias("first"), "several", "gram",
        (F.col("anchor") - F.col("at")).alias("distance"), F.expr(f"substring(bytes, at + 1, {length})").alias("string"),
    )
    same = ["gram", "distance", "string"]
    repeated = strings.groupBy(*same).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    found = strings.where("NOT several").join(repeated, same)
    return found.select("key_a", "key_b", "first", (F.col("first") + length).alias("last"))


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, large: int = LARGE) -> DataFrame:
    """Spans (key_a, key_b, first, last) that cover the repeated strings of each text."""
    blocks = stage(block_rows(docs, text, length, gram), "blocks")
    shared = stage(
        blocks.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "shared_grams"
    )
    # The bitmap keeps most blocks with a gram of their own out of the join's shuffle.
    likely = blocks.where(bitmaps.passes(bitmaps.build(shared, "gram", MAP_BITS), F.col("gram")))
    blocks = stage(likely.join(shared, "gram", "left_semi"), "shared_blocks")
    place = F.struct("key_a", "key_b", "start", "starts", "anchor")
    variants = stage(
        blocks.groupBy("gram", "content").agg(F.count("*").alias("n"), F.min(place).alias("place")), "variants"
    )
    equal = variants.where("n > 1").select("gram", "content")
    covered = blocks.join(equal, ["gram", "content"], "left_semi").select(
        "key_a", "key_b", F.col("start").alias("first"), (F.col("start") + F.col("starts") - 1 + length).alias("last")
    )
    edges = variants.groupBy("gram").agg(F.count("*").alias("variants")).where("variants > 1")
    edges = stage(
        variants.join(edges, "gram").select("gram", "variants", (F.col("n") > 1).alias("several"), "place.*"), "edges"
    )
    texts = docs.select(*row_keys(docs), F.col(text).cast("binary").alias("data"))
    texts = texts.where(bitmaps.passes(bitmaps.build(edges, "key_a", MAP_BITS), F.col("key_a")))
    # Equal rows hold the same bytes.
    fetched = texts.join(edges, ["key_a", "key_b"]).select(
        "gram", "variants", "several", "key_a", "key_b", "start", "starts", "anchor",
        F.expr(f"substring(data, CAST(start + 1 AS INT), starts - 1 + {length})").alias("bytes"),
    )
    fetched = fetched.dropDuplicates(["gram", "key_a", "key_b", "start"])
    fetched = stage(fetched, "edge_bytes")
    narrow = fetched.where(F.col("variants") <= large).drop("variants")
    sorted_ = narrow.repartition("gram").sortWithinPartitions("gram").mapInArrow(_sort_chunks(length), SPAN)
    wide = _large_groups(fetched.where(F.col("variants") > large), length)
    return stage(covered.unionByName(sorted_).unionByName(wide), "spans")


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every document; ``kept`` are the bytes left."""
    spans = repeated_spans(docs, text, length, gram)
    # Neighbouring blocks give overlapping spans: one row per text, with the spans in order.
    lists = spans.groupBy("key_a", "key_b").agg(
        F.sort_array(F.collect_set(F.struct("first", "last"))).alias("spans")
    ).select("key_a", "key_b", F.col("spans.first").alias("first"), F.col("spans.last").alias("last"))
    texts = docs.select(F.col(id_column).alias("id"), *row_keys(docs), F.col(text).alias("text"))
    joined = texts.join(lists, ["key_a", "key_b"], "left").select("id", "text", "first", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tokens.text_bytes(batch.column("text"))
            removed, runs, kept = [], [], []
            for i, (first, last) in enumerate(zip(batch.column("first"), batch.column("last"))):
                own = data[offsets[i] : offsets[i + 1]]
                if not first.is_valid:
                    removed.append(0), runs.append(0), kept.append(own.tobytes())
                    continue
                change = np.zeros(len(own) + 1, np.int64)
                np.add.at(change, first.values.to_numpy(), 1)
                np.subtract.at(change, last.values.to_numpy(), 1)
                gone = np.cumsum(change[:-1]) > 0
                removed.append(int(gone.sum()))
                runs.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                kept.append(own[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    kind = dict(texts.dtypes)["id"]
    return joined.mapInArrow(run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
