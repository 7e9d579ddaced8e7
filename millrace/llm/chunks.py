"""Encoding by memo: texts are cut where the split pattern of byte-level BPE must cut, and each distinct chunk is encoded once.

Three kinds of place begin a new pre-token whatever surrounds them: a blank between two visible
characters, a single line feed between two visible characters (and what follows it), and a border
between a letter and a sign that is no apostrophe. So the ids of a text are the ids of its chunks in
a row. Only characters that every regex engine holds to be visible or letters count (printable
ASCII and the Latin letters up to U+024F); elsewhere no cut is made.

The work is done on the bytes of whole Arrow columns: numpy finds the cuts, Arrow names the distinct
chunks, and only these meet Python's dictionary; the ids of all texts are then one take.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

_SEEN = "[!-~¡-¬®-ɏ]"
#: The blanks at which a Python string can be cut.
BLANK_CUT = re.compile(f"(?<={_SEEN})(?= {_SEEN})")

_LETTER, _SIGN, _OTHER, _BLANK, _FEED = 1, 2, 3, 4, 5


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """The kind of each byte of ASCII, and of each two-byte character by its bytes as one number; 0 where nothing is known."""
    one = np.zeros(256, np.uint8)
    one[33:127] = _SIGN
    one[[*range(65, 91), *range(97, 123)]] = _LETTER
    one[ord("'")], one[32], one[10] = _OTHER, _BLANK, _FEED
    two = np.zeros(1 << 16, np.uint8)
    for code in range(0xA1, 0x250):
        if code != 0xAD:
            a, b = chr(code).encode()
            two[a << 8 | b] = _LETTER if code >= 0xC0 and code not in (0xD7, 0xF7) else _OTHER
    return one, two


_ONE, _TWO = _kinds()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes in a row and the edges of the texts in them; null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    edges = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    size = int(edges[-1] - edges[0])
    data = np.frombuffer(column.buffers()[2], np.uint8, size, int(edges[0])) if size else np.zeros(0, np.uint8)
    return data, edges - edges[0]


def cuts(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Ascending places at which chunks begin, with the end of ``data``; ``edges`` are the texts' edges."""
    n = len(data)
    kind = np.zeros(n + 2, np.uint8)
    kind[1:-1] = _ONE[data]
    lead = np.flatnonzero((data[:-1] >= 0xC2) & (data[:-1] <= 0xC9))
    pair = _TWO[(data[lead].astype(np.int32) << 8) | data[lead + 1]]
    kind[lead + 1] = pair
    kind[lead + 2] = pair
    edge = np.zeros(n + 1, bool)
    edge[edges] = True
    begin = edge.copy()
    here, last = kind[1:-1], kind[:-2]
    begin[:-1] |= (last ^ here) == (_LETTER ^ _SIGN)  # 1 and 2 are the only kinds that give 3, but for 3 beside 0
    begin[:-1] &= (last != 0) & (here != 0) | edge[:-1]
    gap = np.flatnonzero((here == _BLANK) | (here == _FEED))
    seen = lambda k: (k >= _LETTER) & (k <= _OTHER)
    gap = gap[seen(kind[gap]) & seen(kind[gap + 2]) & ~edge[gap] & ~edge[gap + 1]]
    begin[gap] = True
    begin[gap[data[gap] == 10] + 1] = True
    begin[n] = True
    return np.flatnonzero(begin)


def windows(data: np.ndarray, edges: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """(start, cuts in it) of pieces of ``data`` of about ``most`` bytes that begin and end at cuts."""
    at, size = 0, most
    while at < len(data):
        to = min(at + size, len(data))
        inside = edges[np.searchsorted(edges, at) : np.searchsorted(edges, to, "right")] - at
        found = cuts(data[at:to], np.r_[0, inside])
        if to < len(data) and to - at not in inside[-1:]:  # the last chunk may go on, and so may the decision before it
            found = found[found <= to - at - 4]
            if len(found) < 2:
                size *= 2
                continue
        yield at, found
        at, size = at + int(found[-1]), most


class ChunkMemo:
    """Ids of texts as bytes, by a memo of the chunks seen last.

    The memo has two generations of ``most`` chunks: when the young one is full it becomes the old one,
    and what is asked for again moves back. Chunks over ``longest`` bytes are not kept.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], most: int = 700_000, longest: int = 64, window: int = 4_000_000):
        self.encode, self.most, self.longest, self.window = encode, most, longest, window
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def __call__(self, column: pa.Array) -> pa.Array:
        """One binary value a text."""
        data, edges = text_bytes(column)
        starts, sizes, parts = [], [], []
        for at, found in windows(data, edges, self.window):
            chunks = pa.Array.from_buffers(pa.binary(), len(found) - 1, [None, pa.py_buffer(found.astype(np.int32)), pa.py_buffer(data[at : at + int(found[-1])])])
            coded = chunks.dictionary_encode()
            each = pa.array(self._look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.binary())
            ids = each.take(coded.indices)
            places = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1)
            starts.append(found[:-1] + at)
            sizes.append(np.diff(places))
            parts.append(np.frombuffer(ids.buffers()[2], np.uint8, int(places[-1])))
        starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        before = np.concatenate([[0], np.cumsum(np.concatenate(sizes, dtype=np.int64))]) if sizes else np.zeros(1, np.int64)
        out = before[np.searchsorted(starts, edges)]
        joined = parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint8), *parts])
        return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(out), pa.py_buffer(joined)])

    def _look_up(self, chunks: list[bytes]) -> list[bytes]:
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        out = list(map(young.get, chunks))
        todo = [i for i, x in enumerate(out) if x is None]
        if old:
            rest = []
            for i in todo:
                if (x := old.get(chunks[i])) is None:
                    rest.append(i)
                else:
                    out[i] = young[chunks[i]] = x
            todo = rest
        new = [chunks[i] for i in todo]
        for i, c, x in zip(todo, new, self.encode(new), strict=True):
            out[i] = x
            if len(c) <= self.longest:
                young[c] = x
        return out
