"""Word hashing for the text operators: Arrow string columns to numpy arrays of 64-bit word hashes.

A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D``. All work is numpy over small slices
of whole documents, so memory per task is bounded by the slice size (or by one very long text).
Null texts count as empty. Hashes are equal on every machine and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_WINDOW_BASE = 0xD1342543DE82EF95 | 1


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), so that equal values stay equal and others spread evenly."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(29))
    h = h * _U(0xA0761D6478BD642F)
    return h ^ (h >> _U(32))


_RANDOM = mix(np.arange(1, 257, dtype=_U) * _U(0x2545F4914F6CDD1D))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
BYTE_VALUES = {False: _RANDOM, True: _RANDOM[_LOWER]}
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


@lru_cache(maxsize=8)
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    n = 1 << bits
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, _U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(base, max(10, int(n).bit_length()))


@dataclass
class Words:
    """The words of consecutive documents: hash, owner (index of the document in its batch), byte range."""

    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    first: int          # documents first..last-1 of the batch
    last: int
    text_start: np.ndarray      # byte range of each of these documents
    text_end: np.ndarray
    sums: np.ndarray            # running sums of the bytes, for hashes of other ranges

    def bounds(self) -> np.ndarray:
        """Offsets of each document's words, one more than there are documents."""
        return np.searchsorted(self.doc, np.arange(self.first, self.last + 1))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return off, (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))


def byte_sums(data: np.ndarray, lower: bool) -> np.ndarray:
    """Running polynomial sums of bytes, from which any range's hash follows."""
    power, _ = powers(_BASE, len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(BYTE_VALUES[lower][data] * power[:len(data)], out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end)."""
    _, inverse = powers(_BASE, len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(_U))


def hash_words(off: np.ndarray, data: np.ndarray, first: int, last: int, lower: bool) -> Words:
    """Words of documents first..last-1."""
    base = int(off[first])
    b = data[base:int(off[last])]
    n = len(b)
    word = ~IS_SPACE[b]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    cut = off[first:last] - base
    cut = cut[cut < n]
    starts[cut] |= word[cut]
    cut = cut[cut > 0] - 1
    ends[cut] |= word[cut]
    s = np.flatnonzero(starts)
    e = np.flatnonzero(ends) + 1
    sums = byte_sums(b, lower)
    h = range_hashes(sums, s, e)
    doc = np.searchsorted(off[first:last + 1] - base, s, side="right") - 1 + first
    cuts = off[first:last + 1] - base
    return Words(h, doc, s, e, b, first, last, cuts[:-1], cuts[1:], sums)


def slices(column: pa.Array, lower: bool, limit: int = SLICE_BYTES) -> Iterator[Words]:
    """Word hashes of a string column, a few documents at a time (at least one)."""
    off, data = text_buffers(column)
    first, n = 0, len(off) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(off, off[first] + limit, side="right")) - 1)
        yield hash_words(off, data, first, min(last, n), lower)
        first = min(last, n)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive values; one value per start 0..len-size (across documents too)."""
    n = len(h)
    if n < size:
        return np.zeros(0, _U)
    power, inverse = powers(_WINDOW_BASE, n + 1)
    prefix = np.zeros(n + 1, _U)
    np.cumsum(h * power[:n], out=prefix[1:])
    return mix((prefix[size:] - prefix[:-size]) * inverse[:n - size + 1])


def word_hash(word: str, lower: bool = False) -> int:
    """Hash of one word, for fixed words and tests."""
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(hash_words(np.array([0, len(raw)]), raw, 0, 1, lower).hash[0])
