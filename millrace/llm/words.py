"""Words of many texts at once, as positions and hashes in numpy arrays.

Texts are taken as the UTF-8 bytes of an Arrow column, so no Python string is made for a word. A
word's hash chains its bytes, eight at a time, through two non-linear lanes, so that no two words
collide by their form (a polynomial over bytes modulo 2**64 would); long words are hashed by blake2b.
A run's hash is a polynomial over its words' hashes, from prefix sums, however many runs overlap; runs
are short, so that no such polynomial vanishes by its form.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

_M = (1 << 64) - 1


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Well-mixed 64-bit hashes of 64-bit integers (the finaliser of SplitMix64)."""
    x = np.asarray(x, np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & _M)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE, _STEP = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_BYTE = mix(np.arange(256), 7)


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


_cache: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    if base not in _cache or len(_cache[base]) < n:
        _cache[base] = _powers(base, max(n, 1 << 16))
    return _cache[base][:n]


def forget() -> None:
    _cache.clear()


def sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums modulo 2**64 with a leading 0."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, dtype=np.uint64, out=out[1:])
    return out


def word_table(inverse: bytes) -> np.ndarray:
    """True for the bytes that words are made of: all but ``inverse``."""
    table = np.ones(256, bool)
    table[list(inverse)] = False
    return table


def spans(buf: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts; ``bounds`` are the texts' edges in ``buf``."""
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = table[buf]
    begins = inside[1:] & ~inside[:-1]
    stops = inside[:-1] & ~inside[1:]
    edge = bounds[(bounds > 0) & (bounds < len(buf))]
    both = edge[inside[edge] & inside[edge + 1]]  # a word's byte on either side of a text's edge
    begins[both] = True
    stops[both] = True
    return np.flatnonzero(begins), np.flatnonzero(stops)


class Texts:
    """A slice of a column of texts: bytes, and the words of each text with their hashes."""

    def __init__(self, column: pa.Array, table: np.ndarray, lower: bool = False):
        column = column.fill_null("").cast(pa.large_string())
        edges = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        data = column.buffers()[2]
        self.n = len(column)
        self.buf = np.frombuffer(data, np.uint8, int(edges[-1] - edges[0]), int(edges[0])) if data is not None and edges[-1] > edges[0] else np.zeros(0, np.uint8)
        if lower:
            self.buf = self.buf + ((self.buf >= 65) & (self.buf <= 90)).astype(np.uint8) * np.uint8(32)
        self.bounds = edges - edges[0]
        self.starts, self.ends = spans(self.buf, self.bounds, table)
        #: Word numbers at which each text begins, and their total.
        self.first = np.searchsorted(self.starts, self.bounds)
        self.counts = np.diff(self.first)

    def word_hashes(self, long: int = 128) -> np.ndarray:
        size = self.ends - self.starts
        padded = np.concatenate([self.buf, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(padded) - 7, "<u8", padded, 0, (1,))  # the eight bytes from each place on
        one, two = mix(size, 1), mix(size, 5)
        at, left, todo = self.starts, size, np.flatnonzero(size <= long)
        at, left = at[todo], left[todo]
        while len(todo):
            x = eight[at]
            short = np.flatnonzero(left < 8)
            x[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
            one[todo] = mix(one[todo] ^ x, 6)
            two[todo] = mix(two[todo] + x * np.uint64(_STEP), 8)
            on = np.flatnonzero(left > 8)
            todo, at, left = todo[on], at[on] + 8, left[on] - 8
        out = mix(one + (two ^ (two >> np.uint64(29))), 9)
        for i in np.flatnonzero(size > long).tolist():
            out[i] = int.from_bytes(blake2b(self.buf[self.starts[i] : self.ends[i]].tobytes(), digest_size=8).digest(), "little")
        return out

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.counts)


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the run of k words that begins at each word (also across texts: mask those)."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    p = sums(words * powers(_STEP, len(words)))
    inverse = powers(pow(_STEP, -1, 1 << 64), len(words) + 1)
    n = len(words) - k + 1
    return mix((p[k:] - p[:n]) * inverse[:n], 2)


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbours."""
    out, span = values, 1
    while span < w:
        step = min(span, w - span)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        span += step
    return out


def sliding_argmin(values: np.ndarray, w: int) -> np.ndarray:
    """Place of the least of each w neighbours, the leftmost of equals."""
    at, span = np.arange(len(values)), 1
    while span < w:
        step = min(span, w - span)
        if len(at) <= step:
            return at[:0]
        a, b = at[:-step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        span += step
    return at


def slices(column: pa.Array, most: int = 1_500_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text, one row at least."""
    sizes = column.cast(pa.large_binary()).fill_null(b"")
    edges = np.frombuffer(sizes.buffers()[1], np.int64, len(sizes) + 1, sizes.offset * 8)
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + most, "right")) - 1)
        yield at, to
        at = to
