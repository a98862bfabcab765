"""Vectorised words and word shingles over Arrow string batches.

Texts are handled as the UTF-8 bytes Arrow already holds.  A-Z are lowered,
a byte table says which bytes belong to words, and each word gets a 64-bit
hash from prefix sums, so the cost is a few numpy passes per byte and no
Python object per word.  Work goes in blocks of about ``BLOCK`` bytes, so
memory is bounded by the longest single text, not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
U64 = np.uint64


def _mix_int(x: int) -> int:
    x = int(x) & ((1 << 64) - 1)
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & ((1 << 64) - 1)
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & ((1 << 64) - 1)
    return x ^ (x >> 31)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, one output per input (a bijection)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of letters and digits: 0-9, a-z (after lowering) and every byte beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Words between white space: anything but space and tab to carriage return.
NONSPACE = np.ones(256, dtype=bool)
NONSPACE[[0x20, *range(0x09, 0x0E)]] = False

BASE = 0x9E3779B97F4A7C15 | 1
BYTE_VALUE = np.array([_mix_int(i + 1) for i in range(256)], dtype=U64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 2 * BLOCK)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            p = np.full(size, base, dtype=U64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


@dataclass
class Words:
    """The words of some texts: ``doc`` is the text's place in the block; ``first`` (one longer
    than the texts) says where each text's words start; ``data`` the lowered bytes."""

    rows: range
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def of(self, i: int) -> slice:
        return slice(self.first[i], self.first[i + 1])

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    o = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d, o.astype(np.int64)


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[range]:
    """Runs of texts of about ``size`` bytes; a longer text is a run of its own."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield range(i, j)
        i = j


def find_words(data: np.ndarray, offsets: np.ndarray, rows: range, table: np.ndarray) -> Words:
    lo, hi = offsets[rows.start], offsets[rows.stop]
    low = LOWER[data[lo:hi]]
    at = offsets[rows.start:rows.stop + 1] - lo
    inside = table[low]
    before = np.zeros(len(low), dtype=bool)
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < len(low)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(low), dtype=bool)
    after[:-1] = inside[1:]
    after[at[1:][at[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    up, down = _powers(len(low) + 1)
    sums = np.zeros(len(low) + 1, dtype=U64)
    np.cumsum(BYTE_VALUE[low] * up[:-1], out=sums[1:])
    h = mix((sums[end] - sums[start]) * down[start])
    first = np.searchsorted(start, at)
    doc = np.repeat(np.arange(len(rows)), np.diff(first))
    return Words(rows, low, start, end, doc, first, h)


def each_block(column: pa.Array, table: np.ndarray) -> Iterator[Words]:
    data, offsets = string_buffers(column)
    for rows in blocks(offsets):
        yield find_words(data, offsets, rows, table)


_STEP = [U64(_mix_int(1000 + t) | 1) for t in range(64)]


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``width`` consecutive word hashes, by first word (the caller drops windows that
    leave a text); the width is part of the hash."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = np.full(n, _mix_int(width), dtype=U64)
    for t in range(width):
        out += h[t:t + n] * _STEP[t]
    return mix(out)


def shingle_sets(words: Words, width: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes; a text of fewer words has one shingle,
    a text without words none."""
    grams = windows(words.hash, width)
    for i in range(len(words.rows)):
        a, b = words.first[i], words.first[i + 1]
        if b - a >= width:
            yield np.unique(grams[a:b - width + 1])
        elif b > a:
            yield windows(words.hash[a:b], b - a)
        else:
            yield np.zeros(0, dtype=U64)
