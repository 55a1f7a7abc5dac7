"""Vectorised bytes, words and hashes of whole texts inside Arrow batches.

White space is ``[\\x20\\x09-\\x0D]`` and lower-casing touches A-Z only, so both work on UTF-8
bytes. Hashes are polynomial over the bytes (modulo 2^64, with an odd base, so every power has
an inverse) and mixed with the length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))
# Bytes of text that are worked on together; one longer text is taken alone.
BLOCK = 1 << 19
# Places in a word for which the mixed values of all bytes are tabulated.
PLACES = 64


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i below ``n`` at least."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        up = np.full(size, BASE, np.uint64)
        down = np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _mixed(code: np.ndarray) -> np.ndarray:
    """Mixed values of places and bytes, the byte in the last eight bits."""
    return mix(code + np.uint64(0x51ED270B9F2D4A7B))


_MIXED = _mixed(np.arange(PLACES << 8, dtype=np.uint64)).reshape(PLACES, 256)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (BLOCK without one), or of one longer row."""
    limit = limit or BLOCK
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def text_blocks(column: pa.Array, limit: int | None = None):
    """(first row, row after the last, bytes, offsets) of each block of a string column."""
    data, offsets = text_bytes(column)
    for a, b in blocks(offsets, limit):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; no word crosses a row."""
    if not len(data):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    space = _SPACE[data]
    first, last = np.empty(len(data), bool), np.empty(len(data), bool)
    first[0] = last[-1] = True
    first[1:], last[:-1] = space[:-1], space[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner], last[inner - 1] = True, True
    starts, ends = np.flatnonzero(first & ~space), np.flatnonzero(last & ~space) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes, the empty one first."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start to each end, wherever they stand."""
    down = powers(len(prefix))[1]
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """Start, end, row and hash of the words of lower-cased ``data``."""
    starts, ends, rows = words(data, offsets)
    return starts, ends, rows, span_hash(prefix_hash(data), starts, ends)


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as an Arrow string column."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[index]))
    ).cast(pa.string())


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span in which every byte counts by itself at its place in the span.

    Unlike in a polynomial, no arrangement of the same bytes cancels out.
    """
    lengths = ends - starts
    total = lengths.astype(np.uint64)
    at, rest = starts, np.arange(len(starts))
    for place in range(PLACES):
        some = np.flatnonzero(lengths[rest] > place) if place else np.flatnonzero(lengths)
        rest, at = (rest, at) if len(some) == len(rest) else (rest[some], at[some])
        if not len(rest):
            return mix(total)
        each = _MIXED[place][data[at + place]]
        if len(rest) == len(total):
            total += each
        else:
            total[rest] += each
    # What is longer is taken byte by byte.
    sizes = np.maximum(lengths[rest] - PLACES, 0)
    upto = np.cumsum(sizes)
    place = np.arange(upto[-1]) - np.repeat(upto - sizes, sizes) + PLACES
    byte = data[place + np.repeat(at, sizes)]
    sums = np.zeros(len(place) + 1, np.uint64)
    np.cumsum(_mixed((place.astype(np.uint64) << np.uint64(8)) + byte), out=sums[1:])
    total[rest] += sums[upto] - sums[upto - sizes]
    return mix(total)


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]
