"""Vectorised 64-bit hashes of the words of many texts, straight from Arrow's UTF-8 buffers.

A word is a maximal run of bytes other than space and 0x09-0x0D. The hash of a
word is a polynomial over random byte codes modulo 2**64, taken from prefix
sums, then mixed; two different words share one with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20  # bytes hashed at once
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FOLDED = _CODES.copy()
_FOLDED[65:91] = _CODES[97:123]
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; kept between calls up to one piece."""
    if _POWERS and len(_POWERS[0]) >= n:
        return _POWERS[0][:n], _POWERS[1][:n]
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(max(n, PIECE), np.uint64(base & (2**64 - 1)))
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    if n <= PIECE:
        _POWERS[:] = out
    return out[0][:n], out[1][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(offsets) == 0:
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words, and the number of words before each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SEPARATOR[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(data)]
    begins[edges] = inside[edges]  # a text's first byte starts a word of its own
    starts = np.flatnonzero(begins)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = edges[edges > 0] - 1
    last[cut] = inside[cut]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
    """The hash of each byte span; spans are in order and do not overlap. ``fold`` takes A-Z as a-z."""
    codes = _FOLDED if fold else _CODES
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + PIECE, "right")))
        power, inverse = _powers(int(ends[to - 1] - base))
        total = np.empty(int(ends[to - 1] - base) + 1, np.uint64)
        total[0] = 0
        np.cumsum(codes[data[base:ends[to - 1]]] * power, out=total[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        at = to
    return out


def word_hashes(column: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the words of all texts one after the other; text i has hashes[first[i]:first[i + 1]]."""
    data, offsets = utf8(column)
    starts, ends, first = word_spans(data, offsets)
    return hash_spans(data, starts, ends, fold), first


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words, by its first word; runs over the end are left out."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total += hashes[j:j + n] * np.uint64((_BASE * (2 * j + 3) ** 7 | 1) & (2**64 - 1))
    return mix(total)


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, owner text) of every text; a text with 1 to width - 1 words has one shingle, all its words."""
    counts = np.diff(first)
    win = windows(hashes, width)
    own = owners(first)
    whole = own[:len(win)] == own[width - 1:] if len(win) else np.zeros(0, bool)
    values, texts = [win[whole]], [own[:len(win)][whole]]
    for n in range(1, width):
        short = np.flatnonzero(counts == n)
        if len(short):
            rows = hashes[first[short][:, None] + np.arange(n)]
            value = np.zeros(len(short), np.uint64)
            for j in range(n):
                value = mix(value + rows[:, j] + np.uint64(n))
            values.append(value)
            texts.append(short)
    return np.concatenate(values), np.concatenate(texts)


def small_batches(batches: Iterator[pa.RecordBatch], text: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text, so that arrays over words stay small."""
    for b in batches:
        if not b.num_rows:
            continue
        _, offsets = utf8(b.column(text))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield b.slice(at, to - at)
            at = to
