"""Vectorised word scan over the UTF-8 bytes of a batch of texts.

The separators of every contract here are ASCII, so words can be found and
hashed on bytes, eight at a time.  For longer ranges a prefix sum of
``T[byte] * P**position`` modulo 2**64 gives any hash by one subtraction and one
multiplication.  A batch is handled in slices of about a MB, whatever the number or
length of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_RNG = np.random.default_rng(20240131)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: x20 and x09-x0D, the white space of every contract.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: White space and ASCII punctuation.
PUNCT = SPACE.copy()
PUNCT[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True


def through(table: np.ndarray, data: np.ndarray) -> np.ndarray:
    """``table[data]`` of bytes; quicker than indexing."""
    return np.frombuffer(data.tobytes().translate(table.astype(np.uint8).tobytes()), table.dtype)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _P, np.uint64), np.full(n, _P_INV, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Slice(NamedTuple):
    """Rows ``lo`` to ``hi`` of a batch: their bytes and the rows' bounds."""

    lo: int
    hi: int
    data: np.ndarray
    bounds: np.ndarray


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray  # row within the slice
    hash: np.ndarray
    first: np.ndarray  # of each row, the number of words before it (n + 1 entries)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The column's texts (null: empty) in slices of about ``limit`` bytes, whole rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield Slice(lo, hi, raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo])
        lo = hi


class Hasher:
    """Hashes of byte ranges of one slice; the prefix sums are made when first asked for."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.sums = self.down = None

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if self.sums is None:
            up, self.down = _powers(1 << max(21, int(len(self.data)).bit_length()))
            self.sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE[self.data] * up[: len(self.data)], out=self.sums[1:])
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(raw + (end - start).astype(np.uint64))


#: Words up to this many bytes are hashed eight bytes at a time, longer ones by prefix sums.
_EIGHTS = 64
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, hasher: Hasher) -> np.ndarray:
    """A hash of each word's bytes and length."""
    size = end - start
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # the eight bytes from each place on
    out = mix((eight[start] & _MASK[np.minimum(size, 8)]) + size.astype(np.uint64) * np.uint64(_P))
    left = np.flatnonzero(size > 8)
    long = left[size[left] > _EIGHTS]
    left = left[size[left] <= _EIGHTS]
    at = 8
    while len(left):
        more = eight[start[left] + at] & _MASK[np.minimum(size[left] - at, 8)]
        out[left] = mix((out[left] ^ more) * np.uint64(_P) + np.uint64(at))
        at += 8
        left = left[size[left] > at]
    if len(long):
        out[long] = hasher(start[long], end[long])
    return out


def words(part: Slice, *, lower: bool = False, sep: np.ndarray = SPACE, cut: np.ndarray | None = None) -> tuple[Words, Hasher, np.ndarray]:
    """Maximal runs of bytes outside ``sep``; a row never shares a word with the next.

    ``cut`` replaces the rows' bounds, for example by the lines' bounds.
    """
    data = through(_LOWER, part.data) if lower else part.data
    bounds = part.bounds if cut is None else cut
    n = len(data)
    inside = np.zeros(n + 2, bool)
    np.logical_not(through(sep, data), out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])  # starts and ends by turns
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    inner = inner[inside[inner] & inside[inner + 1]]
    if len(inner):  # a word that runs over a bound is two
        inner = np.unique(inner)
        edges = np.sort(np.concatenate([edges, inner, inner]))
    start, end = np.ascontiguousarray(edges[::2]), np.ascontiguousarray(edges[1::2])
    first = np.searchsorted(start, bounds)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    hasher = Hasher(data)
    return Words(start, end, doc, _word_hashes(data, start, end, hasher), first), hasher, data


def runs(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each ``size``-word run that lies in one row, and the word it begins at."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += w.hash[k : n + k] * _STEP[k]
    at = np.flatnonzero(w.doc[:n] == w.doc[size - 1 :])
    return mix(total[at]), at


def shingle_sets(w: Words, size: int = 5) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its ``size``-word runs.

    A row with fewer words, but one at least, gives its whole sequence as one.
    """
    hashes, at = runs(w, size)
    edge = np.searchsorted(at, w.first)
    out = []
    for k in range(len(w.first) - 1):
        lo, hi = w.first[k], w.first[k + 1]
        if hi - lo >= size:
            out.append(np.unique(hashes[edge[k] : edge[k + 1]]))
        elif hi > lo:
            short = (w.hash[lo:hi] * _STEP[: hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
