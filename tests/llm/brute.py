"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text) -> list[str]:
    return WORD.findall(lower(text or ""))


def components(prints: dict, budget: int = 2) -> dict:
    """Least id reachable for every id -> fingerprint."""
    by_print = defaultdict(list)
    for i, p in prints.items():
        by_print[p].append(i)
    values, parent = list(by_print), {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= budget:
                parent[root(values[a])] = root(values[b])
    least = {}
    for p, ids in by_print.items():
        r = root(p)
        least[r] = min([*ids, *([least[r]] if r in least else [])])
    return {i: least[root(p)] for i, p in prints.items()}


def fingerprint(text, size: int = 3) -> int:
    w = words(text)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def exact(rows: list[tuple]) -> dict:
    """(id, text) -> id: (keep id, size, kept, digest)."""
    groups = defaultdict(list)
    for i, text in rows:
        text = text or ""
        groups[re.sub(r"[\x20\x09-\x0D]", "", text)].append((-len(text), i))
    out = {}
    for norm, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            out[i] = (keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest())
    return out


def token_ids(text, path: str) -> list[int]:
    tokenizer = Tokenizer.from_file(path)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def ids_crc(ids) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def warc(rows: list[tuple]) -> dict:
    """(page id, html) -> page id: (bytes, digest, type, refers to)."""
    largest = {}
    for i, html in rows:
        largest[html or ""] = max(largest.get(html or "", i), i)
    return {
        i: (
            len((html or "").encode()),
            base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode(),
            "response" if largest[html or ""] == i else "revisit",
            None if largest[html or ""] == i else largest[html or ""],
        )
        for i, html in rows
    }


def repeated_bytes(texts: dict, size: int) -> dict:
    """Bytes covered by a string of ``size`` bytes that also starts elsewhere: id -> list of flags."""
    seen = defaultdict(list)
    for i, text in texts.items():
        data = (text or "").encode()
        for a in range(len(data) - size + 1):
            seen[data[a : a + size]].append((i, a))
    flags = {i: [False] * len((t or "").encode()) for i, t in texts.items()}
    for places in seen.values():
        if len(places) > 1:
            for i, a in places:
                flags[i][a : a + size] = [True] * size
    return flags


def removal(text, flags) -> tuple:
    data = (text or "").encode()
    spans = sum(1 for k, f in enumerate(flags) if f and (k == 0 or not flags[k - 1]))
    rest = bytes(b for b, f in zip(data, flags) if not f)
    return len(data), sum(flags), spans, hashlib.sha256(rest).hexdigest()
