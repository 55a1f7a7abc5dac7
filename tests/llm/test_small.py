"""Operators against plain Python on small tables with the awkward cases."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortloom.llm import (
    components,
    decontaminate,
    exact,
    langid,
    ngram,
    packing,
    sharding,
    simhash,
    staging,
    suffix,
    tokens,
    toxicity,
    warc,
)
from tests.llm import brute

ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "Alpha beta  gamma delta epsilon zeta"), (5, "alpha BETA gamma\ndelta epsilon zeta"),
    (6, "Alpha beta gamma delta epsilon zeta"), (6, "Alpha beta gamma delta epsilon zeta"), (7, "one"), (8, "one two"),
    (9, "Ünï ćödé ça va très bien — merci   beaucoup"), (10, "x" * 30000), (11, "word " * 9000), (12, "\x00 \x1c a\x1cb"),
    (13, "don's we're <|endoftext|> it's 'quoted' 123 4.5 ÉCOLE ﬁn é"), (14, None),
]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# Texts as bytes


def test_words_of_rows():
    import pyarrow as pa

    texts = [t for _, t in ODD]
    data, offsets = tokens.text_bytes(pa.array(texts))
    data = tokens.lower(data)
    starts, ends, rows, hashes = tokens.word_hashes(data, offsets)
    found = defaultdict(list)
    by_hash = {}
    for a, b, r, h in zip(starts, ends, rows, hashes):
        word = data[a:b].tobytes().decode()
        found[r].append(word)
        assert by_hash.setdefault(h, word) == word
    assert [found[i] for i in range(len(texts))] == [brute.words(t) for t in texts]
    assert len(set(by_hash.values())) == len(by_hash)


def test_blocks_are_whole_rows(monkeypatch):
    import pyarrow as pa

    column = pa.array(["ab", None, "c" * 50, "", "d"])
    seen = [(a, b, data.tobytes()) for a, b, data, _ in tokens.text_blocks(column, 10)]
    assert b"".join(x[2] for x in seen) == b"ab" + b"c" * 50 + b"d"
    assert [x[:2] for x in seen] == [(0, 2), (2, 3), (3, 5)] or seen[0][0] == 0


# Exact dedup


@pytest.mark.parametrize("snapshot", ["all", "none", "half"])
def test_exact_groups(docs, snapshot):
    rows = [r for i, r in enumerate(ODD) if r not in ODD[:i]]
    rows += [(100 + i, "many copies of one text") for i in range(40)]
    side = {"all": F.lit(True), "none": F.lit(False), "half": F.col("doc_id") % 2 == 0}[snapshot]
    found = exact.dedup(docs(rows), side)
    got = {r["id"]: (r["keep_id"], r["size"], r["kept"], r["digest"]) for r in found.collect()}
    assert got == brute.exact(rows)


def test_exact_keeps_one_of_equal_rows(docs):
    found = exact.dedup(docs(ODD), F.col("doc_id") > 5).where("id = 6").collect()
    assert sorted(r["kept"] for r in found) == [False, False]
    assert {r["keep_id"] for r in found} == {4}
    rows = docs([(1, "same")] * 5 + [(None, "other"), (3, None), (None, None)])
    found = exact.dedup(rows, F.lit(None).cast("boolean"))
    assert Counter(r["kept"] for r in found.collect()) == {True: 3, False: 5}
    assert staging.keep_rows(rows, found.where("size > 1")).count() == 3


def test_exact_of_nothing(docs):
    assert exact.dedup(docs([]), F.lit(True)).count() == 0


def test_fuse_filter():
    random_keys = np.random.default_rng(1).integers(0, 1 << 63, 60000, dtype=np.int64).view(np.uint64)
    for n in (1, 2, 3, 50, 5000, 50000):
        made = exact.FuseFilter.build(random_keys[:n])
        assert made.may_hold(random_keys[:n]).all()
        others = random_keys[50000:]
        assert made.may_hold(others).mean() < 0.02
        assert len(made.table) < 1.4 * n + 200


def test_different_bytes_stay_apart(docs):
    """Equal digests alone do not make a group: the bytes are compared."""
    rows = docs([(1, "a"), (2, "b")])
    keyed = rows.select("doc_id", *staging.row_keys(rows)).collect()
    schema = "digest string, old struct<key_a:long,key_b:long>, new struct<key_a:long,key_b:long>"
    keys = {r["doc_id"]: (r["key_a"], r["key_b"]) for r in keyed}
    pairs = rows.sparkSession.createDataFrame([("x", keys[1], keys[2]), ("y", keys[1], keys[1])], schema)
    assert [r["digest"] for r in exact.confirmed(rows, pairs, "text").collect()] == ["y"]


# Shards


def check_shards(rows, found, shards):
    """Every row once, slots gapless, bytes equal up to the largest row."""
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((i, len((t or "").encode()) + 8) for i, t in rows)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(shards))
    for x in slots.values():
        assert sorted(x) == list(range(len(x)))


def test_shards(docs):
    rng = random.Random(3)
    rows = [(i, "x" * rng.randrange(200)) for i in range(300)] + [(1000 + i, "copy") for i in range(150)] + ODD[:3]
    found = sharding.histogram_sort(docs(rows), 7, part_bytes=700).collect()
    check_shards(rows, found, 7)
    sizes = Counter()
    for r in found:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 3 * 208
    order = [r["doc_id"] for r in sorted(found, key=lambda r: (r["shard"], r["slot"])) if r["doc_id"] >= 1000]
    places = [k for k, r in enumerate(sorted(found, key=lambda r: (r["shard"], r["slot"]))) if r["doc_id"] >= 1000]
    assert places == list(range(places[0], places[0] + len(order)))


def test_shards_of_odd_rows(docs):
    check_shards(ODD, sharding.histogram_sort(docs(ODD), 4).collect(), 4)
    assert sharding.histogram_sort(docs([]), 4).count() == 0
    same = [(1, "equal")] * 50
    check_shards(same, sharding.histogram_sort(docs(same), 4).collect(), 4)
    clash = docs(ODD).withColumn("shard", F.lit("mine")).withColumn("size", F.lit(-1))
    assert dict(sharding.histogram_sort(clash, 3).dtypes)["shard"] == "int"


def test_shards_do_not_depend_on_partitions(docs):
    rows = [(i, f"text {i % 37} " * (i % 11)) for i in range(200)]
    place = lambda df: sorted((r["doc_id"], r["shard"], r["slot"]) for r in sharding.histogram_sort(df, 5).collect())
    assert place(docs(rows)) == place(docs(rows[::-1]).repartition(7))


# Components and fingerprints


@pytest.mark.parametrize("edges", [
    [], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 80)] + [(200, 201), (201, 300)],
    [(5, 5)], [(i, (i * 7) % 90) for i in range(90)],
])
def test_components(spark, edges):
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert dict(rows_of(found)) == {x: root(x) for x in parent}


def test_fingerprints(docs):
    rows = [r for i, r in enumerate(ODD) if r not in ODD[:i]]
    found = simhash.near_duplicates(docs(rows)).collect()
    prints = {i: brute.fingerprint(t) for i, t in rows}
    assert {r["id"]: r["print"] & (1 << 64) - 1 for r in found} == prints
    assert {r["id"]: r["component_id"] for r in found} == brute.components(prints)
    assert simhash.near_duplicates(docs([])).count() == 0


@pytest.mark.parametrize("leaf", [2, 16, 4096])
def test_trie_join(spark, leaf):
    rng = random.Random(leaf)
    values = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        values |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(15)}
    # Many prints that share their upper half.
    values |= {0xABCDEF0123456789 ^ (1 << rng.randrange(20)) ^ (1 << rng.randrange(20)) for _ in range(60)}
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    edges = simhash.linked_prints(spark.createDataFrame(signed, "print long"), leaf_prints=leaf)
    got = defaultdict(int)
    for a, _, n in rows_of(edges):
        got[a & (1 << 64) - 1] += n
    want = {a: n for a in values if (n := sum(0 < (a ^ b).bit_count() <= 2 for b in values))}
    assert got == want
    roots = {a & (1 << 64) - 1: r for a, r in rows_of(components.components(edges.select("a", "b")))}
    classes = brute.components({v: v for v in values})
    assert len(set(roots.values())) == len({classes[v] for v in want})
    assert all((roots[a] == roots[b]) == (classes[a] == classes[b]) for a in want for b in want)


def test_one_row_of_a_component_is_kept(docs):
    rows = docs([(5, "the same few words here"), (3, "the same  few words here"), (3, "the same  few words here"), (9, "else")])
    found = simhash.near_duplicates(rows)
    assert sorted(rows_of(staging.keep_rows(rows, found).select("doc_id"))) == [(3,), (9,)]


# Benchmark passages


def test_containment(docs, spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([3, 5, 9, 20, 60]))) for i in range(30)] + [(30, None), (31, ""), (32, "w1"), (5, "again other text w1 w2")]
    rows = []
    for i in range(120):
        part = items[i % 30][1].split()
        cut = part[: max(1, int(len(part) * rng.choice([0.5, 0.8, 0.85, 0.9, 1.0])))]
        rows.append((i, f"{text(rng.randrange(200))} {'  '.join(cut).upper()} {text(rng.randrange(200))}"))
    rows += [(900, None), (901, ""), (902, "W1"), (903, items[2][1]), (903, items[2][1])]
    found = decontaminate.contained(docs(rows), spark.createDataFrame(items, "item_id long, text string"))

    def shingles(t):
        w = brute.words(t)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    want = set()
    for d, t in rows:
        have = shingles(t)
        for k, u in items:
            need = shingles(u)
            if need and len(need & have) >= 0.8 * len(need) - 1e-9:
                want.add((d, k, len(need & have), len(need)))
    assert set(rows_of(found.select("id", "item_id", "n_shared", "n_shingles"))) == want
    assert any(n < m for _, _, n, m in want)
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contained(docs(rows), nothing).count() == 0
    assert decontaminate.contained(docs([]), spark.createDataFrame(items, "item_id long, text string")).count() == 0


# Packing


def check_packed(rows, found, capacity=2048, tokenizer=packing.TOKENIZER):
    pieces = defaultdict(list)
    for r in found:
        pieces[r["id"], r["start"]].append(r)
    want = []
    for i, t in rows:
        ids = brute.token_ids(t, tokenizer)
        for k, a in enumerate(range(0, len(ids), capacity)):
            want.append((i, k, a, len(ids[a : a + capacity]), brute.ids_crc(ids[a : a + capacity])))
    assert sorted((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == sorted(want)
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r["length"] for r in found) // capacity)


def test_packing(docs):
    rng = random.Random(9)
    rows = [*ODD, *[(100 + i, "some words " * rng.randrange(700)) for i in range(80)]]
    used, least = check_packed(rows, packing.pack(docs(rows)).collect())
    assert used <= least + 1
    assert packing.pack(docs([])).count() == 0


def test_parts_stay_even_at_a_wide_tolerance(spark):
    """A shard of many parts: what a shard may be off by is more than a part holds."""
    keys = spark.range(20_000).select(
        F.xxhash64("id").alias("key_a"), F.lit(0).cast("long").alias("key_b"), F.lit(100).cast("long").alias("size")
    )
    found, per_shard = sharding.split(staging.stage(keys, "keys"), 2, part_bytes=20_000, tolerance=0.5)
    sizes = np.diff([*found.bytes_below, 2_000_000])
    assert per_shard == 50 and len(sizes) == 100 and sizes.min() >= 15_000 and sizes.max() <= 25_000


def test_word_ids_are_those_of_whole_texts(monkeypatch):
    """Ids come word by word; the tokenizer gives the same for a text as a whole."""
    import pyarrow as pa

    monkeypatch.setattr(packing, "REMEMBERED", 3000)
    rng = random.Random(0)
    pieces = [*"aAbZ09.,;:!?'\"()-—éÉ́ſßİıΣς \n\t\x0b\x1c  |<>%#*_ﬁ²½Ⅷ中文🙂", "'s", "'LL", "<|endoftext|>", "n't"]
    pieces += ["<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(60))) for _ in range(3000)] + [None, "", "…?.", "a.b.", "é."]
    encoder, got = packing.WordIds(packing.TOKENIZER), []
    for a, b, data, offsets in tokens.text_blocks(pa.array(texts), 20000):
        ids, per_row = encoder.encode(data, offsets)
        stop = np.append(0, np.cumsum(per_row))
        got += [ids[stop[i] : stop[i + 1]].tolist() for i in range(b - a)]
    whole = Tokenizer.from_file(packing.TOKENIZER).encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert got == [e.ids + [0] for e in whole]


def alike():
    """Two different words whose polynomial hashes modulo 2^64 agree for every odd base."""
    bits = [0]
    while len(bits) < 2048:
        bits += [1 - b for b in bits]
    return ["".join("ab"[b ^ flip] for b in bits) for flip in (0, 1)]


def test_words_made_to_hash_alike(docs, spark):
    import pyarrow as pa

    one, other = alike()
    data, offsets = tokens.text_bytes(pa.array([one, other]))
    assert len(set(tokens.word_hashes(data, offsets)[3])) == 1  # what the polynomial takes for equal
    texts = [(1, one), (2, other), (3, f"{one} {other}"), (4, f"{other} <|endoftext|> {one}")]
    found = {r["id"]: r for r in packing.pack(docs(texts)).where("piece = 0").collect()}
    for i, text in texts:
        assert found[i]["ids_crc32"] == brute.ids_crc(brute.token_ids(text, packing.TOKENIZER)[: packing.CAPACITY])
    counts = {r["word"]: r["n"] for r in ngram.count_words(docs(texts)).collect()}
    assert counts == {one: 3, other: 3, "<|endoftext|>": 1}
    model, vocabulary = ngram.train(docs(texts[:1]))
    scored = {r["doc_id"]: r["n_known"] for r in ngram.score(docs(texts), model, vocabulary, ["doc_id"]).collect()}
    assert scored == {1: 2, 2: 1, 3: 2, 4: 2}
    items = spark.createDataFrame([(7, f"{one} w x y z")], "item_id long, text string")
    held = decontaminate.contained(docs([(1, f"{one} w x y z"), (2, f"{other} w x y z")]), items)
    assert [r["id"] for r in held.collect()] == [1]


def test_lexicon_of_many_equal_counts(spark, monkeypatch):
    monkeypatch.setattr(ngram, "LOOKED_UP", 1000)
    words = spark.range(9000).select(F.concat(F.lit("w"), "id").alias("word"), F.lit(5).cast("long").alias("n"))
    some = ngram.frequent_words(words.union(spark.sql("SELECT 'often', 50L")))
    assert 850 < len(some.hashes) < 1150 and 50 in some.counts
    assert len(ngram.frequent_words(words.limit(800)).hashes) == 800


def test_packed_sequences(docs):
    rows = [(i, "a few words " * (i % 5)) for i in range(30)]
    cut = staging.stage(packing.pieces(docs(rows), capacity=16, keep_ids=True), "pieces")
    placed = packing.place(cut, 16)
    sequences = {r["sequence_id"]: r["ids"] for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        part = sequences[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert part == r["ids"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]


@pytest.mark.parametrize("seed", range(5))
def test_minimum_slack_patterns(seed):
    rng = random.Random(seed)
    counts = Counter(rng.choices(range(1, 40), k=400))
    made = packing.patterns(dict(counts), 50)
    used = Counter()
    for lengths, times in made:
        assert sum(lengths) <= 50 and times > 0
        for x in lengths:
            used[x] += times
    assert used == counts
    assert sum(t for _, t in made) <= -(-sum(k * v for k, v in counts.items()) // 50) + 2


def test_fullest_is_the_best_sum():
    rng = random.Random(2)
    for _ in range(200):
        counts = Counter(rng.choices(range(1, 30), k=rng.randrange(1, 9)))
        room = rng.randrange(60)
        sums = {0}
        for x in counts.elements():
            sums |= {s + x for s in sums}
        found = packing.fullest(sorted(counts, reverse=True), counts, room)
        assert sum(found) == max(s for s in sums if s <= room)
        assert not Counter(found) - counts


# Archives


def test_archives(spark, tmp_path):
    rows = [
        (1, "u1", "<p>a</p>"), (2, "u2", None), (3, None, ""), (4, "u\r\n4", "<p>a</p>"), (5, "u5", "é" * 40000),
        (6, "u6", "\r\n\r\nWARC/1.1\r\n"), (None, "u7", "lonely"), (None, "u8", "<p>a</p>"),
    ] + [(100 + i, f"v{i}", f"page {i % 60} " * (i % 60)) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = str(tmp_path / "a")
    manifest = warc.write_archives(pages, folder, shard_bytes=60000, roll_bytes=4000).collect()
    assert len(manifest) > 5 and all(r["records"] == 1 or r["bytes"] <= 4000 for r in manifest)
    found = warc.read_archives(spark, folder, payloads=True).collect()
    want = brute.warc([(i, h) for i, _, h in rows if i is not None])
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found if r["page_id"] is not None}
    assert got == want and len(found) == len(rows)
    html = {i: (h or "").encode() for i, _, h in rows if i is not None}
    for r in found:
        if r["record_type"] == "response" and r["page_id"] is not None:
            assert bytes(r["payload"]) == html[r["page_id"]]
    none = {r["url"]: (r["record_type"], r["refers_to"]) for r in found if r["page_id"] is None}
    assert none == {"u7": ("response", None), "u8": ("revisit", 4)}
    again = str(tmp_path / "b")
    warc.write_archives(pages.repartition(5), again, shard_bytes=60000, roll_bytes=4000)
    files = sorted(p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith("."))
    assert all((tmp_path / "a" / f).read_bytes() == (tmp_path / "b" / f).read_bytes() for f in files)


def test_archives_of_repeated_rows_and_nothing(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x")] * 4, "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "a"))
    found = Counter(r["record_type"] for r in warc.read_archives(spark, str(tmp_path / "a")).collect())
    assert found == {"response": 1, "revisit": 3}
    warc.write_archives(pages.limit(0), str(tmp_path / "b"))
    assert warc.read_archives(spark, str(tmp_path / "b")).count() == 0


@pytest.mark.parametrize("page", [7, None])
def test_rows_of_one_page_are_many_shards(spark, tmp_path, page):
    rows = [(page, f"u{i}", f"<p>{i}</p>" * 9) for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_archives(pages, str(tmp_path / "a"), shard_bytes=50_000).collect()
    by_shard = Counter()
    for r in manifest:
        by_shard[r["shard"]] += r["records"]
    assert len(by_shard) > 30 and max(by_shard.values()) < 300 and sum(by_shard.values()) >= 3000
    assert warc.read_archives(spark, str(tmp_path / "a")).count() == 3000


def test_a_store_that_arrow_cannot_open_is_named():
    with pytest.raises(ValueError, match="nostore://x/y"):
        warc._opened("nostore://x/y")


def test_damaged_archives_are_refused(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 500)], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, str(tmp_path / "a")).collect()
    file = tmp_path / "a" / manifest[0]["name"]
    file.write_bytes(file.read_bytes()[:-30])
    with pytest.raises(Exception, match="cut off|header"):
        warc.read_archives(spark, str(tmp_path / "a")).count()


# Languages


def test_languages(docs):
    rng = random.Random(1)
    stems = {"en": ["the", "and", "thing"], "fr": ["eau", "tion", "é"], "de": ["sch", "ung", "ü"]}
    text = lambda lang, n: " ".join("".join(rng.choices(stems[lang], k=2)) for _ in range(n))
    rows = [(i, text(lang, rng.randrange(3, 80)), lang) for i, lang in enumerate(rng.choices(sorted(stems), k=300))]
    model = langid.train(docs([*rows, (900, "unlabelled", None), (901, None, "en")]))
    fresh = [(i, text(lang, 12), lang) for i, lang in enumerate(rng.choices(sorted(stems), k=100))]
    extra = [(200, None, "en"), (201, "", "en"), (202, "123 ... !?", "en"), (203, "ḽ", "en")]
    clash = docs(fresh + extra).withColumn("score", F.lit("mine"))
    got = {r["doc_id"]: r for r in langid.identify(clash, model).collect()}
    assert sum(got[i]["lang_pred"] == lang for i, _, lang in fresh) >= 97
    assert not any(got[i]["rejected"] for i, _, _ in fresh)
    assert all(got[i]["lang_pred"] == "und" and got[i]["rejected"] and got[i]["score"] == 0 for i in (200, 201, 202))
    assert got[203]["lang_pred"] in stems
    empty = langid.train(docs([]))
    assert {r["lang_pred"] for r in langid.identify(docs(fresh), empty).collect()} == {"und"}


def test_language_training_does_not_depend_on_partitions(docs):
    rows = [(i, f"the thing {i % 9}" if i % 2 else f"schön über {i % 7}", "en" if i % 2 else "de") for i in range(60)]
    a, b = langid.train(docs(rows)), langid.train(docs(rows[::-1]).repartition(5))
    assert np.array_equal(a.centroids, b.centroids) and np.array_equal(a.least, b.least)


def test_languages_of_many_copies_have_starts(docs, spark):
    # Twenty languages of 2,000 rows each, made of three texts.
    words = [["".join(random.Random(99 * i + j).choices("abcdefghij", k=6)) for j in range(9)] for i in range(20)]
    rows = [(100 * i + j, " ".join(words[i][j : j + 6]), f"l{i}") for i in range(20) for j in range(3)]
    copies = docs(rows).crossJoin(spark.range(667)).drop("id")
    model = langid.train(copies)
    assert model.languages == sorted(f"l{i}" for i in range(20)) and len(model.of) == 60
    assert {r["lang"]: r["lang_pred"] for r in langid.identify(docs(rows), model).collect()} == {x: x for x in model.languages}


def test_unlearned_languages_and_noise_are_rejected(docs):
    rng = random.Random(6)
    stems = {x: ["".join(rng.choices(letters, k=5)) for _ in range(40)]
             for x, letters in (("en", "abcdefghij"), ("fr", "efghijklmnop"), ("de", "ijklmnopqrstu"))}
    text = lambda words, n: " ".join(rng.choices(words, k=n))
    rows = [(i, text(stems[x], rng.randrange(20, 90)), x) for i, x in enumerate(rng.choices(sorted(stems), k=1500))]
    model = langid.train(docs(rows))
    other = ["".join(rng.choices("qrstuvwxyzabc", k=5)) for _ in range(40)]
    fresh = [(i, text(stems[x], rng.randrange(20, 90)), x) for i, x in enumerate(rng.choices(sorted(stems), k=400))]
    far = [(1000 + i, text(other, rng.randrange(20, 90))) for i in range(50)]
    far += [(2000 + i, rng.randbytes(rng.randrange(200, 400)).hex()) for i in range(50)]
    far += [(3000 + i, "".join(rng.choices("абвгдежзиклмнопрст  ", k=200))) for i in range(50)]
    far += [(4000 + i, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz    ", k=200))) for i in range(50)]
    got = {r["doc_id"]: r for r in langid.identify(docs(fresh + far), model).collect()}
    for first in (1000, 2000, 3000, 4000):
        assert sum(got[first + i]["rejected"] for i in range(50)) >= 45
    assert sum(got[i]["rejected"] for i, _, _ in fresh) <= 4
    assert all(got[i]["lang_pred"] == x for i, _, x in fresh)


# Toxicity


def labelled(docs, rows, **options):
    table = docs([(i, t) for i, t, _ in rows])
    labels = table.sparkSession.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, label long")
    return toxicity.labelled_texts(table, labels, **options)


def test_drawn_labels(docs):
    rows = [(i, f"text {i}", i % 2) for i in range(400)]
    assert Counter(labelled(docs, rows).collect()) == Counter((t, y) for _, t, y in rows)
    some = labelled(docs, rows, sample=100).collect()
    assert 60 < len(some) < 140 and set(map(tuple, some)) <= {(t, y) for _, t, y in rows}


def test_toxicity(docs):
    rng = random.Random(4)
    plain = [f"word{i}" for i in range(200)]
    bad = ["awful", "rotten", "nasty", "vile"]

    def text(toxic):
        w = rng.choices(plain, k=rng.randrange(5, 60))
        for _ in range(3 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", "", "***", "."]))
        return " ".join(w)

    rows = [(i, text(i % 5 == 0), int(i % 5 == 0)) for i in range(600)]
    model = toxicity.train(labelled(docs, [*rows, (5000, None, 0), (5001, "", 1), (5002, "x", None)]))
    fresh = [(i, text(i % 2)) for i in range(100)] + [(500, None), (501, ""), (502, "vile " * 20000)]
    scored = model.score(docs(fresh).withColumn("score", F.lit("mine")), ["doc_id"])
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in scored.collect()}
    assert len(got) == 103 and all(0 <= s <= 1 and p == (s >= 0.5) for s, p in got.values())
    assert sum(got[i][1] == i % 2 for i in range(100)) >= 96
    assert got[500] == got[501] and got[502][1] == 1


def test_toxicity_of_one_class_and_nothing(docs):
    one = toxicity.train(labelled(docs, [(i, "text", 0) for i in range(5)]))
    assert rows_of(one.score(docs([(1, "a")]), ["doc_id"])) == [(1, 0.0, 0)]
    none = toxicity.train(labelled(docs, [(1, "text", None)]))
    assert rows_of(none.score(docs([]), ["doc_id"])) == []


def test_features_are_those_of_the_row():
    import pyarrow as pa

    lexicon = toxicity.Lexicon()
    texts = ["You SHOUT!", "", "a*b c3d looong", "plain words"]
    alone = [toxicity.features(*tokens.text_bytes(pa.array([t])), lexicon)[0] for t in texts]
    assert np.allclose(toxicity.features(*tokens.text_bytes(pa.array(texts)), lexicon), alone)
    assert not alone[1].any()


# Class bigrams


def test_class_bigrams(docs, spark):
    rng = random.Random(6)
    groups = [[f"{g}{i}" for i in range(30)] for g in "abc"]
    text = lambda: " ".join(rng.choice(groups[(k + s) % 3]) for s in [rng.randrange(3)] for k in range(rng.randrange(1, 30)))
    rows = [(i, text()) for i in range(300)] + ODD
    training = [r for r in rows if r[0] is not None and r[0] % 7]
    model, vocabulary = ngram.train(docs(training))
    got = rows_of(ngram.score(docs(rows), model, vocabulary, ["doc_id"]).select(
        "doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"))
    counts = Counter(w for _, t in training for w in brute.words(t))
    counts["</end>"] = len(training)
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        w = [*brute.words(t), "</end>"]
        base = sum(np.log10((counts[x] + 1) / (total + distinct + 1)) for x in w)
        want.append((i, len(w), sum(counts[x] > 0 for x in w), total, base))
    assert [r[:4] for r in sorted(got)] == [r[:4] for r in sorted(want)]
    assert np.allclose([r[4] for r in sorted(got)], [r[4] for r in sorted(want)])
    held = [r for r in got if r[0] % 7 == 0 and r[0] > 20]
    assert sum(r[5] for r in held) > 0.8 * sum(r[4] for r in held)  # log probabilities are negative


def test_counts_move_as_lists_and_keep_their_sums(docs, monkeypatch):
    """Tasks hand on one row per unit or range of hashes, however many counts there are."""
    words = [f"w{i % 61}x{i * i % 37}" for i in range(3000)]
    texts = [(i, " ".join(words[i * 30 : i * 30 + 30]) + " " + "q" * (60 + i)) for i in range(100)]
    lexicon = ngram.frequent_words(ngram.count_words(docs(texts)))
    import pyarrow as pa

    wanted = Counter()
    for _, text in texts:
        data, offsets = tokens.text_bytes(pa.array([text]))
        units = lexicon.units_of(data, *(found := tokens.words(data, offsets))[:2], tokens.hash_words(data, *found[:2]))
        row = [ngram.END_UNIT, *units.tolist(), ngram.END_UNIT]
        wanted.update(zip(row, row[1:]))
    counted = docs(texts).select("text").mapInArrow(
        ngram._count_pairs(lexicon), "a int, others array<int>, counts array<long>"
    ).collect()
    assert len(counted) <= docs(texts).rdd.getNumPartitions() * len({a for a, _ in wanted})
    pairs = {(r["a"], r["b"]): r["n"] for r in ngram.count_pairs(docs(texts).select("text"), lexicon).collect()}
    assert pairs == dict(wanted)
    rng = np.random.default_rng(5)
    keys, n = np.unique(rng.integers(0, 2**64, 9000, np.uint64)), np.ones(9000, np.int64)
    rows = ngram._by_range(keys, n[: len(keys)])
    assert rows.num_rows <= 1 << ngram.RANGE_BITS and rows.column("keys").flatten().to_numpy().view(np.uint64).tolist() == keys.tolist()
    held = ngram.Lexicon(keys[::2], n, n.astype(np.int32))
    at, there = held.find(keys)
    assert there.tolist() == [i % 2 == 0 for i in range(len(keys))]
    assert at.tolist() == np.minimum(np.searchsorted(keys[::2], keys), len(keys[::2]) - 1).tolist()


def test_probabilities_sum_to_one_at_most(docs):
    rows = [(i, f"a{i % 5} b{i % 3} c") for i in range(50)]
    model, vocabulary = ngram.train(docs(rows))
    known = rows_of(vocabulary) + [("</end>", model.ends)]
    import pyarrow as pa

    units = model.lexicon.units_of(*ngram._hashes_of(pa.array([w for w, _ in known[:-1]])))
    classes = np.append(model.of[units], ngram.CLASSES)
    counts = np.array([n for _, n in known])
    for previous in range(ngram.CLASSES + 1):
        inside = ((counts + 1) * 10 ** model.context[previous, classes]).sum()
        unseen = (10 ** model.context[previous]).sum()
        assert inside <= 1 + 1e-9 and inside + unseen <= 1.02


def test_every_training_word_is_classed_by_its_neighbours(spark, docs, monkeypatch):
    """Rare words beyond the units, and beyond the words that tasks hold, and pairs of such words."""
    import pyarrow as pa

    monkeypatch.setattr(ngram, "LOOKED_UP", ngram.UNITS + 40)
    rng = random.Random(4)
    frequent = [f"f{i}q{i % 7}" for i in range(ngram.UNITS)]
    # Equal last bytes, other company: ends of sentences here, starts there.
    heads, tails = [f"h{i}xyz" for i in range(60)], [f"t{i}xyz" for i in range(60)]
    rows = [(i, " ".join(rng.choice(frequent[:40]) + " " + rng.choice(frequent[40:80]) for _ in range(8))) for i in range(150)]
    rows += [(1000 + i, " ".join(frequent[i::32] * 6)) for i in range(32)]
    rows += [(2000 + i, f"{heads[i % 60]} {' '.join(rng.choices(frequent[40:80], k=3))}") for i in range(180)]
    rows += [(2500 + i, f"{rng.choice(frequent[:40])} {tails[i]}") for i in range(60)]
    rows += [(3000, "h1xyz h2xyz h2xyz t3xyz"), (3001, "t1xyz"), (3002, None)]
    rows += [(3003, "f0q0 t5xyz t6xyz f1q1")] * 2
    model, vocabulary = ngram.train(docs(rows))
    assert model.classes.count() >= 60  # not held by tasks
    klass = {r["word"]: r["klass"] for r in model.classes.collect()}
    words = [r["word"] for r in vocabulary.collect()]
    held = model.lexicon.units_of(*ngram._hashes_of(pa.array(words)))
    klass |= {w: int(model.of[u]) for w, u in zip(words, held) if w not in klass}
    assert {klass[w] for w in tails} - {klass[w] for w in heads}  # the last bytes would give all the same
    pairs = Counter()
    for _, t in rows:
        seen = [ngram.CLASSES, *(klass[w] for w in brute.words(t)), ngram.CLASSES]
        pairs.update(zip(seen, seen[1:]))
    classed = vocabulary.join(model.classes, "word")
    joint = ngram._class_pairs(ngram._encode(docs(rows), model.lexicon, model.of, classed))
    assert {(a, b): joint[a, b] for a, b in zip(*np.nonzero(joint))} == pairs
    assert model.tokens == sum(pairs.values()) and model.distinct == len(words) + 1
    counts = {r["word"]: r["n"] for r in vocabulary.collect()}
    asked = [*rows, (4000, "never1xyz h1xyz h1xyz never2 t3xyz never1xyz"), (4001, "never1xyz")]
    for r in ngram.score(docs(asked), model, vocabulary, ["doc_id", "text"]).collect():
        seen, want = ngram.CLASSES, 0.0
        for w in brute.words(r["text"]):
            if w not in klass:
                klass[w] = int(model.of[ngram._ending_units(*ngram._hashes_of(pa.array([w]))[:3])[0]])
            want += np.log10(counts.get(w, 0) + 1) + model.context[seen, klass[w]]
            seen = klass[w]
        want += np.log10(model.ends + 1) + model.context[seen, ngram.CLASSES]
        assert np.isclose(r["score"], want)


def test_best_class_is_the_best_of_all():
    rng = np.random.default_rng(3)
    joint = rng.integers(1000, 9000, (ngram.SIDE, ngram.SIDE)).astype(float)
    seen = [[(int(c), int(n)) for c, n in zip(rng.choice(2 * ngram.SIDE, 5, False), rng.choice([1, 2, 40], 5))] for _ in range(20)]
    flat = [(i, c, n) for i, s in enumerate(seen) for c, n in s]
    flat += flat[:3]  # counts of one neighbour in two rows
    seen[0] += seen[0][:3]
    found = ngram.best_classes(*np.array(flat).T, len(seen), joint, ngram.gains_of(joint))
    x = lambda v: v * np.log(v)
    for i, s in enumerate(seen):
        gains = []
        for b in range(ngram.CLASSES):
            counts = Counter()
            for c, n in s:
                counts[(c, b) if c < ngram.SIDE else (b, c - ngram.SIDE), c < ngram.SIDE] += n
            gain = sum(x(joint[cell] + n) - x(joint[cell]) for (cell, _), n in counts.items())
            times = sum(n for c, n in s if c < ngram.SIDE)
            gains.append(gain - 2 * (x(joint[b].sum() + times) - x(joint[b].sum())))
        assert np.isclose(gains[found[i]], max(gains))


def test_trained_and_scored_at_once(docs):
    rows = [(i, " ".join(f"w{(i * k) % 37}" for k in range(i % 9))) for i in range(60)] + ODD
    marked = docs(rows).withColumn("odd", F.col("doc_id") % 5 == 0)
    model, vocabulary = ngram.train(marked.where("NOT odd"))
    want = rows_of(ngram.score(marked, model, vocabulary, ["doc_id", "odd"]))
    got = rows_of(ngram.train_and_score(marked, ["doc_id", "odd"], "odd"))
    assert [r[:5] for r in sorted(got)] == [r[:5] for r in sorted(want)]
    assert np.allclose([r[5:] for r in sorted(got)], [r[5:] for r in sorted(want)])


def test_class_bigrams_without_training(docs):
    model, vocabulary = ngram.train(docs([]))
    scored = ngram.score(docs(ODD), model, vocabulary, ["doc_id", "lang"]).collect()
    assert len(scored) == len(ODD) and all(np.isfinite(r["score"]) and r["n_known"] == 0 for r in scored)


def test_exchange_raises_the_likelihood(spark):
    rng = random.Random(8)
    pairs = Counter()
    for _ in range(5000):
        a = rng.randrange(40)
        pairs[a, (a + 1) % 2 + 2 * rng.randrange(20)] += 1
    size = ngram.END_UNIT
    pairs[size, 0] += 1
    df = spark.createDataFrame([(a, b, n) for (a, b), n in pairs.items()], "a int, b int, n long")
    of, joint = ngram.cluster(df)
    start = np.arange(size + 1) % ngram.CLASSES
    start[size] = ngram.CLASSES
    first = ngram._joint(ngram._neighbours(df), start)
    assert ngram._likelihood(joint) >= ngram._likelihood(first)
    assert of[size] == ngram.CLASSES and joint.sum() == first.sum()


# Repeated strings


def check_removed(rows, found, length):
    flags = brute.repeated_bytes(dict(rows), length)
    import hashlib

    got = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in found}
    assert got == {i: brute.removal(t, flags[i]) for i, t in rows}
    return sum(v[1] for v in got.values())


@pytest.mark.parametrize("large", [1, suffix.LARGE])
@pytest.mark.parametrize("length,gram", [(40, 12), (200, 64)])
def test_repeated_strings(docs, length, gram, large, monkeypatch):
    monkeypatch.setattr(suffix, "LARGE", large)
    monkeypatch.setattr(suffix.repeated_spans, "__defaults__", ("text", suffix.LENGTH, suffix.GRAM, large))
    monkeypatch.setattr(suffix, "CHUNK", 3000)
    rng = random.Random(length)
    noise = lambda n: "".join(rng.choices("abcdé ", k=n))
    passages = [noise(n) for n in (length // 2, length - 1, length, length + 1, length + 7, 2 * length, 5 * length)]
    rows = []
    for i in range(150):
        text = noise(rng.randrange(3 * length))
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 3 + 1) if rng.random() < 0.5 else 0
            text += p[a:] + noise(rng.randrange(length))
        rows.append((i, text))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, ""), (204, "ab" * 3 * length), (205, "z" * (length + 1)), (206, "q" * length)]
    rows += [(207, passages[-1] + noise(5) + passages[-1])]
    found = suffix.remove_repeats(docs(rows), length=length, gram=gram).collect()
    assert check_removed(rows, found, length) > 20 * length


def test_long_texts_are_cut_without_loss(docs, monkeypatch):
    monkeypatch.setattr(suffix, "SEGMENT", 300)
    monkeypatch.setattr(tokens, "BLOCK", 500)
    rng = random.Random(0)
    text = lambda n: "".join(rng.choices("abcdefgh", k=n))
    shared = text(900)
    rows = [(1, text(1000) + shared + text(700)), (2, text(10) + shared), (3, text(2000))]
    found = suffix.remove_repeats(docs(rows), length=40, gram=12).collect()
    assert check_removed(rows, found, 40) == 1800


def test_repeats_of_equal_rows_and_nothing(docs):
    rows = docs([(1, "y" * 50 + "x" * 200)] * 2 + [(2, "short")] * 2)
    found = Counter((r["id"], r["n_removed"], len(r["kept"])) for r in suffix.remove_repeats(rows).collect())
    assert found == {(1, 250, 0): 2, (2, 0, 5): 2}
    assert suffix.remove_repeats(docs([])).count() == 0


def test_suffix_mergesort():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 99, 4000).astype(np.uint8)
    text[2000:2600] = text[100:700]
    first = np.array([0, 1000, 1001, 1003])
    size = np.array([1000, 1, 2, 1500])
    places = np.concatenate([rng.permutation(3900)[:1000], [5], [7, 2007], rng.permutation(3900)[:1500]])
    sorted_ = suffix.merge_sorted(suffix.Suffixes(text, 30), places, first, size)
    raw = text.tobytes()
    for a, n in zip(first, size):
        got = [raw[p : p + 30] for p in sorted_[a : a + n]]
        assert got == sorted(raw[p : p + 30] for p in places[a : a + n])


def test_colliding_hashes_are_verified(monkeypatch):
    """With hashes that tell nothing apart the bytes still decide."""
    monkeypatch.setattr(suffix.Suffixes, "_same", lambda self, a, b, n: np.ones(len(a), bool))
    text = np.frombuffer(b"abcdefghijABCDEFGHIJabcdefghij", np.uint8)
    block, start = suffix.repeated_starts(
        text, np.array([0, 10, 20]), np.array([1, 1, 1]), np.array([0, 0, 0]), np.array([7, 7, 7]), 10
    )
    assert sorted(zip(block.tolist(), start.tolist())) == [(0, 0), (2, 0)]
