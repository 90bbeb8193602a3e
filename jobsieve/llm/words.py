"""Vectorised word hashing over Arrow string columns.

Texts are never turned into Python strings: the UTF-8 buffer of an Arrow column is classified byte by byte
with numpy, and each word gets a 64-bit hash of its bytes (A-Z folded to a-z) from prefix sums of a polynomial
hash.  Whole texts are read; the working set is bounded by ``SPAN`` bytes whatever the length of a text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPAN = 1 << 20
_U = np.uint64


def _splitmix(n: int, seed: int) -> np.ndarray:
    z = _U(seed) + np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)
    return mix(z)


def mix(z: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    with np.errstate(over="ignore"):
        z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
        return z ^ (z >> _U(31))


_FOLD = np.arange(256)
_FOLD[65:91] += 32
_BYTE = _splitmix(256, 11)[_FOLD]
_BASE = 0x2545F4914F6CDD1D | 1
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(SPAN, 1 << (n - 1).bit_length())
    if size not in _tables:
        _tables.clear()
        with np.errstate(over="ignore"):
            up = np.full(size, _BASE, _U)
            down = np.full(size, pow(_BASE, -1, 1 << 64), _U)
            up[0] = down[0] = 1
            _tables[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _tables[size]


def _lut(inside) -> np.ndarray:
    return np.array([bool(inside(b)) for b in range(256)])


#: Words between white space: any byte but \x20 and \x09-\x0D.
SPACED = _lut(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Runs of ASCII letters and digits and of all non-ASCII bytes.
ALNUM = _lut(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)


def _hash_span(buf: np.ndarray, word: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of buf; cuts: positions where a new text begins."""
    n = len(buf)
    inside = word[buf]
    first = np.zeros(n + 1, bool)
    first[cuts] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    up, down = _powers(n)
    with np.errstate(over="ignore"):
        x = _BYTE[buf]
        x *= up[:n]
        np.cumsum(x, out=x)
        h = x[ends - 1]
        later = starts > 0
        h[later] -= x[starts[later] - 1]
        h *= down[starts]
        h += (ends - starts).astype(_U) * _U(0x9E3779B97F4A7C15)
    return mix(h), starts, ends


@lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library
        return lambda _: 0


def tidy() -> None:
    """Gives freed memory back: workers live for many tasks, and two of them share an executor with its JVM."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


class Chunk:
    """Consecutive texts of a column: rows lo to hi; words of row i: h[at[i - lo]:at[i - lo + 1]]; sizes in bytes."""

    __slots__ = ("lo", "hi", "h", "at", "starts", "ends", "buf", "sizes")

    def __init__(self, lo, hi, h, at, starts, ends, buf, sizes=None):
        self.lo, self.hi, self.h, self.at, self.starts, self.ends, self.buf, self.sizes = lo, hi, h, at, starts, ends, buf, sizes


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and len + 1 offsets."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(column: pa.Array, word: np.ndarray, span: int = SPAN, rows: int = 1 << 16) -> Iterator[Chunk]:
    """The hashed words of all texts, some whole texts at a time (at most rows, about span bytes, or one longer text)."""
    if not len(column):
        return
    buf, off = text_buffer(column)
    lo = 0
    while lo < len(off) - 1:
        hi = max(lo + 1, min(lo + rows, int(np.searchsorted(off, off[lo] + span, "right")) - 1))
        part, cuts = buf[off[lo] : off[hi]], off[lo:hi] - off[lo]
        if len(part) <= 2 * span:
            h, starts, ends = _hash_span(part, word, cuts) if len(part) else (np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64))
        else:  # one long text, in spans that end between words
            got, at = [], 0
            while at < len(part):
                to = min(len(part), at + span)
                while to < len(part):
                    gap = np.flatnonzero(~word[part[at:to]])
                    if len(gap):
                        to = at + int(gap[-1]) + 1
                        break
                    to = min(len(part), to + span)
                h, starts, ends = _hash_span(part[at:to], word, np.zeros(1, np.int64))
                got.append((h, starts + at, ends + at))
                at = to
            h, starts, ends = (np.concatenate(x) for x in zip(*got))
        yield Chunk(lo, hi, h, np.searchsorted(starts, off[lo : hi + 1] - off[lo]), starts, ends, part, np.diff(off[lo : hi + 1]))
        lo = hi
    tidy()


_C = _splitmix(64, 23) | _U(1)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive words: len(h) - k + 1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        out = h[:n] * _C[0]
        for j in range(1, k):
            out += h[j : j + n] * _C[j]
        out += _U(k)
    return mix(out)


def shingle_sets(chunk: Chunk, k: int = 5) -> Iterator[np.ndarray]:
    """For each text of the chunk its sorted distinct k-word shingles; with fewer words, the whole sequence as one."""
    every = grams(chunk.h, k)
    for a, b in zip(chunk.at[:-1].tolist(), chunk.at[1:].tolist()):
        if b - a >= k:
            s = np.sort(every[a : b - k + 1])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        else:
            yield grams(chunk.h[a:b], b - a) if b > a else np.zeros(0, _U)
