"""Mixing of sources: targets, the cube method's sums and chances, whole tables."""

import random
import re
from collections import Counter, defaultdict

import pytest

from cohortloom.llm import balance, queries
from tests.llm.conftest import LARGER

SCHEMA = "doc_id long, source string, text string"


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    """Shares by weight, capped and shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s and s.encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in full]
        total = sum(weight[s] for s in free)
        given = {s: left * weight[s] / total for s in free}
        over = [s for s in free if given[s] > repeats * sizes[s]]
        if not over:
            return full | given
        for s in over:
            full[s] = repeats * sizes[s]
            left -= full[s]


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(found, rows, slack):
    """``slack``: words by which a source may miss its target."""
    sizes = defaultdict(int)
    for _, source, text in rows:
        sizes[source] += size(text)
    targets = plain_targets(sizes)
    assert Counter((r["id"], r["source"], r["size"]) for r in found) == Counter((i, s, size(t)) for i, s, t in rows)
    taken = defaultdict(int)
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["times"] <= 2
        taken[r["source"]] += r["size"] * r["times"]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= slack(source), source


@pytest.mark.parametrize("n", [1, 2, 3, 40, 700])
def test_flight_keeps_sums(n):
    rng = random.Random(n)
    for _ in range(20):
        sizes = [rng.choice([0, 1, 5, rng.randrange(1000)]) for _ in range(n)]
        chances = [rng.choice([0.5, rng.random(), 0.0, 1.0]) for _ in range(n)]
        moved = balance.flight(sizes, chances, rng.random)
        assert sum(0 < p < 1 for p in moved) <= 2
        assert sum(moved) == pytest.approx(sum(chances), abs=1e-5)
        assert sum(s * p for s, p in zip(sizes, moved)) == pytest.approx(sum(s * p for s, p in zip(sizes, chances)), rel=1e-4, abs=1e-2)
        assert set(balance.landing(sizes, moved, rng.random)) <= {0.0, 1.0}


def test_chances_are_kept():
    sizes, chances = [9, 1, 4, 4, 30, 2], [0.2, 0.7, 0.5, 0.5, 0.35, 0.9]
    rng, sums, rounds = random.Random(2), [0.0] * 6, 6000
    for _ in range(rounds):
        drawn = balance.landing(sizes, balance.flight(sizes, chances, rng.random), rng.random)
        sums = [a + b for a, b in zip(sums, drawn)]
    assert [s / rounds for s in sums] == pytest.approx(chances, abs=0.03)


def texts(rng, n):
    return [" ".join(["w"] * rng.randrange(1, 60)) for _ in range(n)]


@pytest.mark.parametrize("group", [8, 64, balance.GROUP])
def test_mix(spark, group):
    rng = random.Random(7)
    rows = [(i, rng.choice(["b", "a", "a", "a", "é", "Z", None]), t) for i, t in enumerate(texts(rng, 900))]
    rows += [(5000 + i, "tiny", "one two") for i in range(3)] + [(6000, "empty", None), (6001, "empty", " \n")]
    rows += [(7, "copies", "some words in here")] * 400 + [(None, "copies", "x y")] * 3
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = balance.mix(df, group=group).collect()
    check(found, rows, lambda source: 120)
    again = balance.mix(df.repartition(3, "text"), group=group).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


def test_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(balance, "COPIES", 7)
    rows = [(1, "s", "a b c")] * 100 + [(2, "t", "a b")] * 10
    check(balance.mix(spark.createDataFrame(rows, SCHEMA)).collect(), rows, lambda source: 3)


def test_empty_table_long_text_and_clashing_names(spark):
    assert balance.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    only = spark.createDataFrame([(1, None, None)], SCHEMA)
    assert [tuple(r)[2:] for r in balance.mix(only).collect()] == [(0, 0, 0.0, 0)]
    more = "id string, size string, copies string, number string, bucket string, key string, target string, block string"
    rows = [(i, "s", "word " * (60_000 if i == 3 else 5)) for i in range(50)]
    df = spark.createDataFrame([(*r, *["c"] * 8) for r in rows], f"{SCHEMA}, {more}")
    check(balance.mix(df).collect(), rows, lambda source: 60_000)


@pytest.mark.given
def test_op13(spark):
    found = queries.op13_cube_sampling(spark, LARGER)
    rows = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "source", "text").collect()
    largest = defaultdict(int)
    for _, source, text in rows:
        largest[source] = max(largest[source], size(text))
    got = found.collect()
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    sums = {}
    for r in got:
        target, taken = sums.get(r["source"], (r["target"], 0))
        sums[r["source"]] = (target, taken + r["taken"])
    sizes = defaultdict(int)
    for _, source, text in rows:
        sizes[source] += size(text)
    wanted = plain_targets(sizes)
    for source, (target, taken) in sums.items():
        assert target == pytest.approx(wanted[source])
        assert abs(taken - target) <= largest[source]  # two chances are landed at most
