"""Periodic runs against all periods at all places."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cohortloom.llm import periods, queries, tokens
from tests.llm.conftest import FOLDER

WORD = r"[^\x20\x09-\x0D]+"


def all_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q):
                stretch = w[i : i + length]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out)


def damaged(i, text):
    w = re.findall(WORD, text or "")
    n, h = len(w), zlib.crc32(b"" if i is None else str(i).encode())
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def expected(i, text):
    w = damaged(i, text)
    found, drop = all_runs(w), set()
    for s, n, q in found:
        drop.update(range(s + q, s + n))
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    left = " ".join(x for k, x in enumerate(w) if k not in drop)
    return (
        i, len(found), *((*best, 1000 * best[1] // best[2]) if best else [None] * 4),
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest(),
    )


def words(rng):
    n = rng.randrange(90)
    w = [rng.choice(rng.choice(["ab", "abc", "abcdefgh"])) for _ in range(n)]
    for _ in range(rng.randrange(4) if n > 4 else 0):
        s, p = rng.randrange(n), rng.randrange(1, 12)
        for k in range(s + p, min(s + rng.randrange(n - s + 1), n)):
            w[k] = w[k - p]
    return w


def test_runs_of_many_documents():
    rng = random.Random(5)
    for _ in range(150):
        docs = [words(rng) for _ in range(rng.randrange(1, 12))]
        data, offsets = tokens.text_bytes(pa.array([" ".join(d) for d in docs]))
        symbols, first = periods._symbols(data, *tokens.words(data, offsets), len(docs))
        found = periods.find_runs(symbols, max(map(len, docs)))
        row = np.searchsorted(first, found[:, 0], side="right") - 1
        got = [[] for _ in docs]
        for k, (s, n, q) in zip(row, found.tolist()):
            got[k].append((s - first[k], n, q))
        assert [sorted(g) for g in got] == [all_runs(d) for d in docs]


ODD = [
    (0, None), (1, ""), (2, " \n "), (3, "a"), (4, "a " * 6), (5, "a a\ta a a"), (6, "x\x1cy " * 9), (7, "é ü " * 40),
    (8, "a b " * 50 + "c " + "a b " * 50), (10, None), (None, "a b c d e f g h"), (3, "a"), (None, None),
    (11, "A a A a A a A a"), (12, " ".join(f"w{k % 211}" for k in range(2000))),
]


def test_odd_texts(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    found = periods.runs(periods.damaged(df)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str(expected(*row)) for row in ODD)


def test_very_long_text(monkeypatch):
    monkeypatch.setattr(periods, "JOINED", 1000)
    text = " ".join(["start", *["la"] * 200_000, "end"])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([text, "a b"])], ["id", "text"])
    found = periods._found(periods.LEAST, periods.EXPONENT, "id")(iter([batch]))
    rows = [tuple(r.values()) for b in found for r in b.to_pylist()]
    left = hashlib.sha256(b"start la end").hexdigest()
    assert rows[0] == (1, 1, 1, 200_000, 1, 200_000_000, hashlib.sha256(b"1,200000,1\n").hexdigest(), left)
    assert rows[1][:2] == (2, 0) and rows[1][-1] == hashlib.sha256(b"a b").hexdigest()


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periods.runs(periods.damaged(empty)).collect() == []
    columns = "doc_id long, text string, id string, words string, h string, n string, g string, a string, p string, start string"
    rows = [(i, "so it goes " * 8, *["c"] * 8) for i in range(30)]
    found = periods.runs(periods.damaged(spark.createDataFrame(rows, columns))).collect()
    assert sorted(tuple(r) for r in found) == sorted(expected(i, "so it goes " * 8) for i in range(30))


@pytest.mark.given
def test_op12(spark):
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, FOLDER).collect()}
    assert len(found) == len(texts)
    for i, text in texts:
        if len(text) < 12_000:  # the plain search takes the square of the words
            assert found[i] == expected(i, text)
