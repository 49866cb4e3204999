"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased. All bytes of a non-ASCII
character are word bytes, so bytes give the same words as characters.
Hashes are 64-bit: a random value for each byte, times a power of an odd base that its place gives, summed; the sum of
any stretch is then the difference of two running sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over the whole value."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)) * np.uint64(_BASE))


@lru_cache(1)
def _fold() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[np.r_[0:48, 58:65, 91:97, 123:128]] = 0
    return table


@lru_cache(1)
def _values() -> np.ndarray:
    table = seeds(256)
    table[0] = 0
    return table


@lru_cache(2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(1 << bits, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses modulo 2^64, n of each at least."""
    return _powers(max(20, int(n).bit_length()))


def running(x: np.ndarray) -> np.ndarray:
    """Running sums with a leading 0."""
    out = np.zeros(len(x) + 1, dtype=x.dtype)
    np.cumsum(x, out=out[1:])
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every stretch, one stretch after the other."""
    total = running(lengths.astype(np.int64))
    return np.arange(total[-1]) + np.repeat(starts - total[:-1], lengths)


def string_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string array and the offsets of its rows; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None and len(texts) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text makes a range of its own."""
    _, offsets = string_buffers(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(to, len(texts))
        at = to


@dataclass
class Words:
    """starts, ends: byte places of every word; first: index of each row's first word, and the count; packed: the
    words' folded bytes without gaps; place: where each word begins in packed, and its length; hashes: of the words."""

    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    packed: np.ndarray
    place: np.ndarray
    hashes: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        """The row of every word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    folded = _fold()[data]
    inside = folded != 0
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    start[heads] = inside[heads]
    end[tails] = inside[tails]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    lengths = ends - starts
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # a few megabytes of words at a time, however long a text is
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE_BYTES, "right")))
        low, high = starts[at], ends[to - 1]
        up, down = powers(int(high - low) + 1)
        sums = running(_values()[folded[low:high]] * up[: high - low])
        a, b = starts[at:to] - low, ends[at:to] - low
        hashes[at:to] = (sums[b] - sums[a]) * down[a]
        at = to
    return Words(offsets, starts, ends, np.searchsorted(starts, offsets), folded[inside], running(lengths), mix(hashes + lengths.astype(np.uint64)))


def windows(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every n consecutive words of one row."""
    k = np.arange(max(0, len(w.hashes) - n + 1))
    up, down = powers(len(w.hashes) + 1)
    sums = running(w.hashes * up[: len(w.hashes)])
    rows = w.rows
    k = k[rows[k] == rows[k + n - 1]] if len(k) else k
    return k, mix((sums[k + n] - sums[k]) * down[k] + np.uint64(n))


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct run of n words, sorted by both; a row of fewer words, but not none, has one run of all."""
    counts = np.diff(w.first)
    rows, hashes = [], []
    for m in sorted(set(np.minimum(counts, n).tolist()) - {0}):
        k, h = windows(w, m)
        r = w.rows[k]
        keep = np.minimum(counts[r], n) == m
        rows.append(r[keep])
        hashes.append(h[keep])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    row, value = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]
