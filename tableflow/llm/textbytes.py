"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

An Arrow column of texts is cut into slices of about ``SLICE`` bytes (one text at least, never part
of a text). In a slice, every word is known by its byte range and a 64-bit hash, so counting, rolling
windows and look-ups need no Python loop over words. A byte of a separator is never part of a
longer UTF-8 character, since separators are ASCII.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
PIECE = 1 << 17

_BASE = 0x9E3779B97F4A7C15 | 1


def _table(members: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: Bytes that belong to a word: all but space and 0x09-0x0D.
SPACED = ~_table([0x20, *range(0x09, 0x0E)])
#: Bytes that belong to a word: digits, letters and all beyond ASCII.
ALPHANUMERIC = _table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: As SPACED, but ASCII letters (1) and other ASCII signs (2) beside each other are words of their
#: own; an apostrophe and all beyond ASCII (3) stay with what they touch.
LETTER_RUNS = SPACED * np.uint8(2)
LETTER_RUNS[[0x27, *range(0x80, 0x100)]] = 3
LETTER_RUNS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1

#: Whether a word starts (ends) between bytes of two kinds.
_STARTS = np.zeros((4, 4), dtype=bool)
_STARTS[0, 1:] = _STARTS[1, 2] = _STARTS[2, 1] = True
_ENDS = _STARTS.T

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for offsets in a piece."""
    def grow(factor: int) -> np.ndarray:
        out = np.full(2 * PIECE + 1, factor, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    return grow(_BASE), grow(pow(_BASE, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def unmix(h: np.ndarray) -> np.ndarray:
    """What ``mix`` has spread."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(pow(0xC4CEB9FE1A85EC53, -1, 1 << 64))
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(pow(0xFF51AFD7ED558CCD, -1, 1 << 64))
    return h ^ (h >> np.uint64(33))


def hash_bytes(text: bytes) -> int:
    """The hash that a word of these bytes has."""
    value = 0
    for at, byte in enumerate(text):
        value += int(_BYTE[byte]) * pow(_BASE, at, 1 << 64)
    return int(mix(np.array([value % (1 << 64)], dtype=np.uint64))[0])


@dataclass
class Slice:
    """Words of the texts ``low`` to ``high`` - 1 of a column."""

    low: int
    high: int
    data: np.ndarray     # bytes, one line feed after each text
    bounds: np.ndarray   # offsets of the texts in data, one more than texts
    starts: np.ndarray   # of words in data
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray    # number of the first word of each text, one more than texts

    def texts(self) -> Iterator[tuple[int, int, int]]:
        """(row, first word, end of words) of each text."""
        for i in range(self.high - self.low):
            yield self.low + i, int(self.first[i]), int(self.first[i + 1])

    def owner(self) -> np.ndarray:
        """Row in the slice of every word."""
        return np.repeat(np.arange(self.high - self.low), np.diff(self.first))


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the byte ranges, piece by piece so that sums stay in cache."""
    out = np.empty(len(starts), dtype=np.uint64)
    up, down = _powers()
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(int(np.searchsorted(ends, base + PIECE, side="right")), at + 1)
        length = int(ends[to - 1] - base)
        if length > 2 * PIECE:  # one very long word
            out[at] = _long_hash(data[base:ends[at]])
            at += 1
            continue
        sums = np.zeros(length + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data[base:base + length]] * up[:length], out=sums[1:])
        s = starts[at:to] - base
        out[at:to] = (sums[ends[at:to] - base] - sums[s]) * down[s]
        at = to
    return mix(out)


def _long_hash(data: np.ndarray) -> np.uint64:
    up, _ = _powers()
    total, shift = 0, 1
    for at in range(0, len(data), PIECE):
        part = data[at:at + PIECE]
        total += shift * int((_BYTE[part] * up[:len(part)]).sum(dtype=np.uint64))
        shift = shift * pow(_BASE, len(part), 1 << 64) % (1 << 64)
    return np.uint64(total % (1 << 64))


def text_column(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The texts as large binary, null as empty, in one chunk."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def slices(column: pa.Array | pa.ChunkedArray, word: np.ndarray = SPACED, lower: bool = True,
           hashed: bool = True) -> Iterator[Slice]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    low, done = 0, 0
    while low < len(column):
        high = max(int(np.searchsorted(sizes, done + SLICE, side="right")), low + 1)
        part = pc.binary_join_element_wise(text_column(column.slice(low, high - low)),
                                           pa.scalar(b"\n", pa.large_binary()),
                                           pa.scalar(b"", pa.large_binary()))
        _, offsets, values = part.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[part.offset:part.offset + high - low + 1]
        data = np.frombuffer(values, dtype=np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        yield _slice(low, high, _LOWER[data] if lower else data, bounds, word, hashed)
        done, low = int(sizes[high - 1]), high


def _slice(low: int, high: int, data: np.ndarray, bounds: np.ndarray, word: np.ndarray,
           hashed: bool) -> Slice:
    kind = np.zeros(len(data) + 1, dtype=word.dtype)
    kind[1:] = word[data]
    if word.dtype == bool:  # words start and end in turn; data ends with a line feed, so every word ends
        edges = np.flatnonzero(kind[1:] != kind[:-1])
        starts, ends = edges[::2].copy(), edges[1::2].copy()
    else:
        pair = kind[:-1] * np.uint8(4) + kind[1:]
        starts = np.flatnonzero(_STARTS.ravel()[pair])
        ends = np.flatnonzero(_ENDS.ravel()[pair])
    hashes = hash_ranges(data, starts, ends) if hashed else np.empty(0, dtype=np.uint64)
    return Slice(low, high, data, bounds, starts, ends, hashes, np.searchsorted(starts, bounds))


class Rolling:
    """Running Karp-Rabin hashes of a sequence of words: sums of their hashes times powers of a base,
    from which windows of any length take one pass."""

    def __init__(self, hashes: np.ndarray):
        def powers(factor: int) -> np.ndarray:
            out = np.full(len(hashes) + 1, factor, dtype=np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        self.down = powers(pow(_BASE, -1, 1 << 64))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers(_BASE)[:-1], dtype=np.uint64)])

    def windows(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; the order of the words matters."""
        if k >= len(self.sums):
            return np.empty(0, dtype=np.uint64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[:len(self.sums) - k])


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    return Rolling(hashes).windows(k)


def shingles(part: Slice, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row in the slice, hash) of all windows of k words inside one text; a text with fewer words
    has one window, the whole of it; a text without words has none."""
    counts = np.diff(part.first)
    owner = part.owner()
    whole = windows(part.hashes, k)
    fits = owner[:len(whole)] == owner[k - 1:k - 1 + len(whole)] if len(whole) else np.empty(0, bool)
    rows, found = [owner[:len(whole)][fits]], [whole[fits]]
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        rows.append(np.array([i]))
        found.append(windows(part.hashes[part.first[i]:part.first[i + 1]], int(counts[i])))
    rows, found = np.concatenate(rows), np.concatenate(found)
    order = np.argsort(rows, kind="stable")
    return rows[order], found[order]


def distinct_by_row(rows: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, one row after another, and the n + 1 row bounds."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    rows, values = rows[new], values[new]
    return values, np.searchsorted(rows, np.arange(n + 1))

