"""Near-duplicates by SimHash: a binary-trie self-join of the distinct fingerprints.

The trie's upper part is a table of nodes: a node with more than LEAF_PRINTS fingerprints has
children four bits further down. Node pairs go down together by equi-joins on the parent, add up
the bits in which their prefixes differ and are dropped once these exceed the budget. The pairs
of leaves that remain are joined inside tasks by the same descent bit by bit, over sorted arrays.
A pair of leaves returns for each fingerprint with a link its least linked one there, not all
pairs, so that the rows stay in proportion to the fingerprints.

Nulls: a null text has no words; documents without words have fingerprint zero and link like any
other. Repeated rows and copies share a fingerprint. A null id is never a component's id unless
all ids of the component are null. Empty tables give no rows. Only the id and the text are read
besides the row key, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import tokens
from cohortloom.llm.components import components
from cohortloom.llm.staging import row_keys, stage

SEED = 42
WORDS = 3
BUDGET = 2
STEP = 4
LEAF_PRINTS = 4096
_BYTE_LANES = np.uint64(0x0101010101010101)
_SINGLE = 64


def shingle_spans(rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of every shingle; a row with fewer words is one shingle."""
    n = len(rows)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    counts = np.diff(np.append(first, n))
    last = np.repeat(first + counts - 1, counts)
    starts = np.arange(n)
    full = starts + size - 1 <= last
    short = np.zeros(n, bool)
    short[first[counts < size]] = True
    starts = starts[full | short]
    return starts, np.minimum(starts + size - 1, last[starts])


def fingerprints(data: np.ndarray, offsets: np.ndarray, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """Fingerprints of the rows of a block of text."""
    rows_n = len(offsets) - 1
    out = np.zeros(rows_n, np.uint64)
    data = tokens.lower(data)
    starts, ends, rows = tokens.words(data, offsets)
    if not len(starts):
        return out
    first, last = shingle_spans(rows, words)
    # Words with one space between them, so that a shingle is a slice.
    space = tokens.is_space(data)
    stays = ~space
    stays[1:] |= space[1:] & ~space[:-1]
    place = np.cumsum(stays) - 1
    joined = np.where(space, np.uint8(32), data)[stays].tobytes()
    begin, end = place[starts[first]].tolist(), (place[ends[last] - 1] + 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(begin, end)), np.uint64, len(begin))
    # Eight counters of eight bits at once, over runs of at most 255 shingles of a row.
    row = rows[first]
    new = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    counts = np.diff(np.append(new, len(row)))
    within = np.arange(len(row)) - np.repeat(new, counts)
    runs = np.flatnonzero(within % 255 == 0)
    run_rows = row[runs]
    first_run = np.flatnonzero(np.concatenate([[True], run_rows[1:] != run_rows[:-1]]))
    majority = np.zeros(len(new), np.uint64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _BYTE_LANES, runs)
        set_bits = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first_run, axis=0)
        for j in range(8):
            majority |= (2 * set_bits[:, j] > counts).astype(np.uint64) << np.uint64(8 * j + k)
    out[row[new]] = majority
    return out


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [fingerprints(data, offsets) for _, _, data, offsets in tokens.text_blocks(batch.column("text"))]
        made = np.concatenate(made) if made else np.empty(0, np.uint64)
        columns = [batch.column("id"), batch.column("key_a"), batch.column("key_b"), pa.array(made.view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["id", "key_a", "key_b", "print"])


def print_rows(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, key_a, key_b, print) of every document."""
    narrow = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), *row_keys(docs))
    kind = dict(narrow.dtypes)["id"]
    return narrow.mapInArrow(_print_batches, f"id {kind}, key_a long, key_b long, print long")


def _prefix(level: int):
    return F.shiftrightunsigned(F.col("print"), 64 - STEP * level)


def trie_nodes(prints: DataFrame, leaf_prints: int = LEAF_PRINTS) -> tuple[list[DataFrame], DataFrame]:
    """Nodes of each level (parent, prefix, leaf) and the leaves (level, prefix, prints)."""
    levels, leaves, pending, level = [], None, prints, 1
    while True:
        nodes = pending.groupBy(_prefix(level).alias("prefix")).agg(F.count("*").alias("size"))
        final = 64 - STEP * level <= 0
        nodes = stage(
            nodes.select(
                F.shiftrightunsigned("prefix", STEP).alias("parent"), "prefix",
                (F.lit(final) | (F.col("size") <= leaf_prints)).alias("leaf"),
            ),
            "nodes",
        )
        levels.append(nodes)
        marked = pending.withColumn("prefix", _prefix(level)).join(nodes.select("prefix", "leaf"), "prefix")
        done = marked.where("leaf").groupBy("prefix").agg(F.sort_array(F.collect_list("print")).alias("prints"))
        done = done.select(F.lit(level).alias("level"), "prefix", "prints")
        leaves = done if leaves is None else leaves.unionByName(done)
        if final or nodes.where("NOT leaf").isEmpty():
            return levels, stage(leaves, "leaves")
        pending = stage(marked.where("NOT leaf").select("print"), "pending")
        level += 1


def leaf_pairs(levels: list[DataFrame], budget: int = BUDGET) -> DataFrame:
    """Pairs of leaves (level_a, a, level_b, b) whose prefixes differ in at most ``budget`` bits."""
    # The pair of the root with itself; staged, so that the first joins are on columns, too.
    pairs = stage(
        levels[0].sparkSession.range(1).selectExpr(
            "0 AS level_a", "id * 0 AS a", "false AS leaf_a", "0 AS level_b", "id * 0 AS b", "false AS leaf_b",
            "0 AS bits",
        ),
        "root",
    )
    done = None
    for level, nodes in enumerate(levels, 1):
        a = nodes.select(F.col("parent").alias("up_a"), F.col("prefix").alias("next_a"), F.col("leaf").alias("is_a"))
        b = nodes.select(F.col("parent").alias("up_b"), F.col("prefix").alias("next_b"), F.col("leaf").alias("is_b"))
        # A pair of which one side is a leaf already keeps it and goes down on the other side only.
        down = pairs.withColumn("up_a", F.when(~F.col("leaf_a"), F.col("a"))).withColumn(
            "up_b", F.when(~F.col("leaf_b"), F.col("b"))
        )
        down = down.join(a, "up_a", "left").join(b, "up_b", "left")
        both = F.col("next_a").isNotNull() & F.col("next_b").isNotNull()
        low = (1 << STEP) - 1
        more = F.when(both, F.bit_count((F.col("next_a").bitwiseXOR(F.col("next_b"))).bitwiseAND(low))).otherwise(0)
        down = down.withColumn("bits", F.col("bits") + more).where(F.col("bits") <= budget)
        # Of the two orders of children of the same node one is enough.
        same = (F.col("a") == F.col("b")) & (F.col("level_a") == F.col("level_b"))
        down = down.where(~(both & same) | (F.col("next_a") <= F.col("next_b")))
        pairs = stage(
            down.select(
                F.when(F.col("next_a").isNull(), F.col("level_a")).otherwise(level).alias("level_a"),
                F.coalesce("next_a", "a").alias("a"), F.coalesce("is_a", "leaf_a").alias("leaf_a"),
                F.when(F.col("next_b").isNull(), F.col("level_b")).otherwise(level).alias("level_b"),
                F.coalesce("next_b", "b").alias("b"), F.coalesce("is_b", "leaf_b").alias("leaf_b"), "bits",
            ),
            "node_pairs",
        )
        ended = pairs.where("leaf_a AND leaf_b")
        done = ended if done is None else done.unionByName(ended)
        pairs = pairs.where("NOT (leaf_a AND leaf_b)")
    return done.select("level_a", "a", "level_b", "b")


def _split(sorted_prints: np.ndarray, depth: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where the bit at ``depth`` turns to one inside ranges that agree on the bits above."""
    ones = np.zeros(len(sorted_prints) + 1, np.int64)
    np.cumsum((sorted_prints >> np.uint64(63 - depth)) & np.uint64(1), out=ones[1:])
    return high - (ones[high] - ones[low])


def trie_join(a: np.ndarray, b: np.ndarray, same: bool, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two sorted arrays whose fingerprints differ in at most ``budget`` bits."""
    one = np.array([0], np.int64)
    a0, a1, b0, b1, bits = one, one + len(a), one, one + len(b), one
    found = []
    for depth in range(65):
        full = (a1 > a0) & (b1 > b0) & (bits <= budget)
        small = full & ((a1 - a0) * (b1 - b0) <= (_SINGLE if depth < 64 else np.iinfo(np.int64).max))
        if small.any():
            n_a, n_b = (a1 - a0)[small], (b1 - b0)[small]
            which = np.repeat(np.arange(len(n_a)), n_a * n_b)
            at = np.arange(len(which)) - np.repeat(np.cumsum(n_a * n_b) - n_a * n_b, n_a * n_b)
            i, j = a0[small][which] + at // n_b[which], b0[small][which] + at % n_b[which]
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if same:
                near &= i < j
            found.append((i[near], j[near]))
        a0, a1, b0, b1, bits = (x[full & ~small] for x in (a0, a1, b0, b1, bits))
        if not len(a0) or depth == 64:
            break
        a_mid, b_mid = _split(a, depth, a0, a1), _split(b, depth, b0, b1)
        cross = np.ones(len(a0), bool) if not same else ~((a0 == b0) & (a1 == b1))
        a0, a1, b0, b1, bits = (
            np.concatenate([a0, a_mid, a0, a_mid[cross]]), np.concatenate([a_mid, a1, a_mid, a1[cross]]),
            np.concatenate([b0, b_mid, b_mid, b0[cross]]), np.concatenate([b_mid, b1, b1, b_mid[cross]]),
            np.concatenate([bits, bits, bits + 1, bits[cross] + 1]),
        )
    if not found:
        return one[:0], one[:0]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def least_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the least node of its component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        np.minimum.at(root, before[i], low)
        np.minimum.at(root, before[j], low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def _join_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x, y, same in zip(batch.column("prints_a"), batch.column("prints_b"), batch.column("same").to_pylist()):
            a = np.sort(x.values.to_numpy().view(np.uint64))
            b = a if same else np.sort(y.values.to_numpy().view(np.uint64))
            i, j = trie_join(a, b, same)
            if not len(i):
                continue
            shift = 0 if same else len(a)
            prints = a if same else np.concatenate([a, b])
            links = np.bincount(i, minlength=len(prints)) + np.bincount(j + shift, minlength=len(prints))
            root = least_linked(len(prints), i, j + shift)
            linked = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[linked].view(np.int64)), pa.array(prints[root[linked]].view(np.int64)),
                 pa.array(links[linked])], ["a", "b", "links"],
            )


def linked_prints(prints: DataFrame, budget: int = BUDGET, leaf_prints: int = LEAF_PRINTS) -> DataFrame:
    """(a, b, links) over distinct fingerprints: edges that span the links, and numbers of links.

    ``links`` of one ``a`` add up to the number of other fingerprints within the budget.
    """
    levels, leaves = trie_nodes(prints, leaf_prints)
    pairs = leaf_pairs(levels, budget)
    side = lambda x: leaves.select(
        F.col("level").alias(f"level_{x}"), F.col("prefix").alias(x), F.col("prints").alias(f"prints_{x}")
    )
    same = (F.col("level_a") == F.col("level_b")) & (F.col("a") == F.col("b"))
    joined = pairs.join(side("a"), ["level_a", "a"]).join(side("b"), ["level_b", "b"])
    joined = joined.select("prints_a", "prints_b", same.alias("same"))
    # Few rows with much work each: deal them out evenly.
    deal = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(joined.repartition(deal).mapInArrow(_join_leaves, "a long, b long, links long"), "links")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, key_a, key_b, print, links, component_id, kept) of every document.

    ``kept`` holds for the rows of the component that come first by id and row key.
    """
    rows = stage(print_rows(docs, id_column, text), "prints")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "key_a", "key_b")
    distinct = stage(rows.groupBy("print").agg(F.min(order).alias("first")), "distinct_prints")
    edges = linked_prints(distinct.select("print"))
    roots = components(edges.select("a", "b"))
    links = edges.groupBy("a").agg(F.sum("links").alias("links"))
    roots = stage(
        roots.join(links, F.col("node") == F.col("a"), "left").select(
            F.col("node").alias("print"), "root", F.coalesce("links", F.lit(0)).alias("links")
        ),
        "roots",
    )
    labelled = distinct.join(roots, "print", "left").select(
        "print", "first", F.coalesce("root", "print").alias("root"), F.coalesce("links", F.lit(0)).alias("links")
    )
    labelled = stage(labelled, "labelled")
    heads = stage(labelled.groupBy("root").agg(F.min("first").alias("head")), "heads")
    labels = stage(labelled.join(heads, "root").select("print", "links", "head"), "labels")
    return rows.join(labels, "print").select(
        "id", "key_a", "key_b", "print", "links", F.col("head.id").alias("component_id"),
        (order == F.col("head")).alias("kept"),
    )
