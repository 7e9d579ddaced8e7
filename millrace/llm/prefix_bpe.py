"""Byte-level BPE encoding and decoding by prefix dynamic programming.

Of all tokens that can end a byte prefix of a piece, exactly one belongs to the prefix's valid
encoding. Storing that token for each prefix gives every encoding by walking back, lets text be
appended exactly (the stored prefixes stay true), and lets an edit re-encode its surroundings alone.
Two neighbours are valid together when no merge across their border comes before those that make them.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.chunks import BLANK_CUT, ChunkMemo
from millrace.llm.words import slices
from millrace.llm.worker import only

#: One word of letters, with the blank before it: one piece under the pattern, unless an apostrophe stands before.
WORD = re.compile(rb" ?(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF]|[\xC4-\xC8][\x80-\xBF]|\xC9[\x80-\x8F])+")

class PrefixBpe:
    """Encoder over a table of ranks; ``pattern`` splits a text into pieces that never merge."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.split = ranks, regex.compile(pattern)
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.size_of = {v: len(k) for k, v in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.edges: dict[int, list[tuple[bytes, int]]] = {}
        self.automaton = self._automaton()
        self.packed = {v: v.to_bytes(4, "little") for v in ranks.values()}
        self.table = pa.array([self.bytes_of.get(i) for i in range(max(self.bytes_of) + 1)], pa.large_binary())
        self.pieces: dict[str, bytes] = {}
        self.memo = ChunkMemo(self._packed_chunks, most=300_000)

    @classmethod
    def from_file(cls, path: str, pattern: str) -> PrefixBpe:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def merged(self, data: bytes) -> list[int]:
        """Merging by rank from single bytes, the plain way; only used on the bytes of single tokens and in tests."""
        return [self.ranks[p] for p in self._merge(data, 1)]

    def _merge(self, data: bytes, least: int) -> list[bytes]:
        """Parts of ``data`` after merging by rank until nothing merges or ``least`` parts are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > least:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _automaton(self):
        """Finds, at each byte, the tokens that end there and that merging can make; learns each one's last merge."""
        import ahocorasick

        out = ahocorasick.Automaton()
        for data, token in self.ranks.items():
            parts = self._merge(data, 2)
            if len(data) == 1 or len(parts) == 2:
                out.add_word(data.decode("latin-1"), (token, len(data)))
                if len(data) > 1:
                    self.halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]])
        out.make_automaton()
        return out

    def edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """What stands at the token's left (0) or right (1) end while it is being made, each with the rank at which that is merged away."""
        key = token << 1 | side
        if (known := self.edges.get(key)) is None:
            known, until = [], 1 << 60
            while True:
                known.append((self.bytes_of[token], until))
                if token not in self.halves:
                    break
                token, until = self.halves[token][side], token
            self.edges[key] = known = known[::-1]
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens can stand side by side: no merge across their border comes before those that make them.

        Of merges with one rank, the leftmost comes first.
        """
        key = left << 32 | right
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) > 500_000:
                self.pairs.clear()
            known, a, b, i, j, end = True, self.edge(left, 1), self.edge(right, 0), 0, 0, 1 << 60
            while True:
                (x, till_x), (y, till_y) = a[i], b[j]
                across = self.ranks.get(x + y, end)
                if across < till_x and across <= till_y and across < end:
                    known = False
                    break
                if till_x == till_y == end:
                    break
                if till_x <= till_y:
                    i += 1
                else:
                    j += 1
            self.pairs[key] = known
        return known

    def extend(self, piece: bytes, last: list[int]) -> None:
        """Complete ``last``, which holds the last token of each prefix (index: its length), to the whole piece.

        The automaton names, at each position, the tokens that end there; only those that merging can make are in it.
        """
        pairs, fits, done = self.pairs, self.fits, len(last)
        back = max(0, done - self.longest)
        for end, (token, size) in self.automaton.iter(piece[back:].decode("latin-1")):
            end += back + 1
            if end == done:
                start = end - size
                if not start or (pairs.get(last[start] << 32 | token) if last[start] << 32 | token in pairs else fits(last[start], token)):
                    last.append(token)
                    done += 1
        if done != len(piece) + 1:
            raise ValueError("the ranks lack a single byte")

    def walk_back(self, last: list[int]) -> list[int]:
        at, out = len(last) - 1, []
        while at:
            out.append(last[at])
            at -= self.size_of[last[at]]
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        if (token := self.ranks.get(piece)) is not None:
            return [token]
        last = [-1]
        self.extend(piece, last)
        return self.walk_back(last)

    def encode_chunk(self, text: str) -> list[int]:
        return [t for m in self.split.findall(text) for t in self.encode_piece(m.encode("utf-8", "replace"))]

    def _packed_chunks(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each chunk, its pieces found by the pattern where it is not one piece by its form."""
        if len(self.pieces) > 150_000:
            self.pieces.clear()
        known, split, word, packed, out = self.pieces, self.split.findall, WORD.fullmatch, self.packed, []
        for c in chunks:
            if word(c):
                out.append(b"".join([packed[t] for t in self.encode_piece(c)]))
                continue
            parts = []
            for m in split(c.decode()):
                if (ids := known.get(m)) is None:
                    ids = b"".join([packed[t] for t in self.encode_piece(m.encode())])
                    if len(m) <= 64:
                        known[m] = ids
                parts.append(ids)
            out.append(b"".join(parts))
        return out

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.memo(pa.array(texts, pa.large_string())).to_pylist()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode_column(self, ids: pa.Array) -> pa.Array:
        """The bytes of each value of ids, by one take from the table of tokens; null gives empty bytes."""
        ids = ids.fill_null(b"").cast(pa.large_binary())
        edges = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, ids.offset * 8) if len(ids) else np.zeros(1, np.int64)
        every = np.frombuffer(ids.buffers()[2], "<u4", int(edges[-1] - edges[0]) // 4, int(edges[0])) if edges[-1] > edges[0] else np.zeros(0, "<u4")
        if len(every) and int(every.max()) >= len(self.table):
            raise KeyError(f"no token has the id {int(every.max())}")
        out = self.table.take(pa.array(every))
        places = np.frombuffer(out.buffers()[1], np.int64, len(out) + 1) if len(out) else np.zeros(1, np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(places[(edges - edges[0]) // 4]), out.buffers()[2]])


class EditableEncoding:
    """A text and its ids that follow appends and edits exactly, encoding anew only from cut to cut."""

    def __init__(self, codec: PrefixBpe, text: str = ""):
        self.codec, self.parts = codec, []
        self.replace(0, 0, text)

    @property
    def text(self) -> str:
        return "".join(t for t, _ in self.parts)

    @property
    def ids(self) -> list[int]:
        return [i for _, ids in self.parts for i in ids]

    def append(self, text: str) -> int:
        n = sum(len(t) for t, _ in self.parts)
        return self.replace(n, n, text)

    def replace(self, start: int, end: int, new: str) -> int:
        """Put ``new`` in place of the characters from start to end; returns how many characters were encoded anew."""
        at, lo = 0, 0
        while lo < len(self.parts) and at + len(self.parts[lo][0]) <= start:
            at += len(self.parts[lo][0])
            lo += 1
        if lo and lo == len(self.parts):
            lo -= 1
            at -= len(self.parts[lo][0])
        elif lo and at == start:  # an edit at a cut may undo the cut
            lo -= 1
            at -= len(self.parts[lo][0])
        hi, to = lo, at
        while hi < len(self.parts) and to <= end:
            to += len(self.parts[hi][0])
            hi += 1
        old = "".join(t for t, _ in self.parts[lo:hi])
        text = old[: start - at] + new + old[end - at :]
        while hi < len(self.parts) and not BLANK_CUT.search(text[-1:] + self.parts[hi][0][:2]):
            text += self.parts[hi][0]
            hi += 1
        self.parts[lo:hi] = [(t, self.codec.encode_chunk(t)) for t in BLANK_CUT.split(text) if t]
        return len(text)


class PieceTable:
    """The prefix table of one piece: bytes are appended exactly, and the ids of every prefix are at hand."""

    def __init__(self, codec: PrefixBpe, piece: bytes = b""):
        self.codec, self.piece, self.last = codec, b"", [-1]
        self.append(piece)

    def append(self, more: bytes) -> None:
        self.piece += more
        self.codec.extend(self.piece, self.last)

    def ids(self, length: int | None = None) -> list[int]:
        return self.codec.walk_back(self.last[: (len(self.piece) if length is None else length) + 1])


def codec(path: str, pattern: str) -> PrefixBpe:
    """One codec a worker process."""
    return only(f"bpe {path} {pattern}", lambda: PrefixBpe.from_file(path, pattern))


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id", decoded: bool = False) -> DataFrame:
    """(key, ids binary[, decoded binary]) of every row; ids are little-endian unsigned 32-bit integers.

    ``path`` names the rank file on every executor. A null text counts as empty and has no ids; repeated
    rows and null keys stay as they are; other columns are not read, so their names cannot clash. The
    work is one pass without a shuffle, and only a bounded memo of chunks stays in a worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            for at, to in slices(b.column(1), 4_000_000):
                ids = c.memo(b.column(1).slice(at, to - at))
                out = [b.column(0).slice(at, to - at), ids.cast(pa.binary())]
                if decoded:
                    out.append(c.decode_column(ids).cast(pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=["key", "ids", "decoded"][: len(out)])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, ids binary" + ", decoded binary" * decoded)
    return out.withColumnRenamed("key", key)


def decode_documents(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """(key, decoded binary) of every row of ids; null ids give empty bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), c.decode_column(b.column(1)).cast(pa.binary())], names=["key", "decoded"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(run, f"key {kind}, decoded binary").withColumnRenamed("key", key)
