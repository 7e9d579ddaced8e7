"""Token ids in binary shard files with constant-time access by document key.

A shard holds the ids of a range of documents in ascending key order, as raw little-endian integers
of 2 bytes (vocabularies up to 65,536) or 4, then an index: a minimal perfect hash over its keys and,
by slot, a fingerprint of the key, the offset and the number of ids. Layout of a file:

    payload | level bits | level ranks | left-over hashes | fingerprints u4 | offsets u8 | counts u8 | JSON header | header length u4 | magic

A key is (document id, how many rows with this id stand before): repeated ids stay apart. The hash
is a cascade of bit arrays: a key whose position no other key of its level has takes that bit, the
others go to the next level; the rank of a bit is the slot. Keys that no level parts, even by equal
64-bit hashes, are kept in a sorted list.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.chunks import ChunkMemo
from millrace.llm.prefix_bpe import WORD
from millrace.llm.shared import dealt, partitions, range_number, work_path
from millrace.llm.words import mix, slices
from millrace.llm.worker import only

MAGIC = b"MRTOKENS"


def key_hashes(ids: np.ndarray, absent: np.ndarray, ordinals: np.ndarray) -> np.ndarray:
    return mix(mix(ids.astype(np.int64).view(np.uint64), 1) ^ (ordinals.astype(np.uint64) * np.uint64(2) + absent.astype(np.uint64)), 2)


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit hashes; ``left`` are those that no level took."""

    def __init__(self, sizes: list[int], words: np.ndarray, left: np.ndarray):
        self.sizes, self.words, self.left = sizes, words, left
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    @classmethod
    def build(cls, hashes: np.ndarray, gamma: float = 2.0, levels: int = 24) -> PerfectHash:
        sizes, words, rest = [], [], np.asarray(hashes, np.uint64)
        while len(rest) and len(sizes) < levels:
            m = -(-max(64, int(gamma * len(rest))) // 64) * 64
            at = (mix(rest, len(sizes)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            sizes.append(m)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            rest = rest[~alone[at]]
        return cls(sizes, np.concatenate(words) if words else np.zeros(0, "<u8"), np.sort(rest))

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash; hashes outside the set get any slot or -1."""
        out, todo, base = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
        for level, m in enumerate(self.sizes):
            at = (mix(hashes[todo], level) % np.uint64(m)).astype(np.int64) + base
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            w = self.words[word]
            hit = (w >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(w & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[todo[hit]] = (self.before[word] + below)[hit]
            todo, base = todo[~hit], base + m
        if len(todo) and len(self.left):
            at = np.searchsorted(self.left, hashes[todo])
            hit = (at < len(self.left)) & (self.left[np.minimum(at, len(self.left) - 1)] == hashes[todo])
            out[todo[hit]] = self.before[-1] + at[hit]
        return out


class ShardWriter:
    """Streams documents into one file; only the index (24 bytes a document) is held."""

    def __init__(self, uri: str, width: int):
        fs, path = FileSystem.from_uri(uri)
        self.uri, self.width, self.n = uri, width, 0
        self.out = fs.open_output_stream(path)
        self.ids: list[np.ndarray] = []
        self.absent: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, ids: np.ndarray, absent: np.ndarray, payloads: list[bytes]) -> None:
        self.ids.append(ids)
        self.absent.append(absent)
        self.counts.append(np.fromiter(map(len, payloads), np.int64, len(payloads)) // self.width)
        self.out.write(b"".join(payloads))

    def close(self) -> tuple[int, int]:
        ids, absent, counts = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (self.ids, self.absent, self.counts))
        hashes = key_hashes(ids, absent, ordinals(ids, absent))
        ph = PerfectHash.build(hashes)
        slots = ph.slots(hashes)
        if len(ph.left) and (again := ph.left[1:] == ph.left[:-1]).any():  # equal hashes: in order of appearance
            for h in np.unique(ph.left[1:][again]):
                same = np.flatnonzero(hashes == h)
                slots[same] = slots[same[0]] + np.arange(len(same))
        arrays = [np.zeros(len(ids), t) for t in ("<u4", "<u8", "<u8")]
        arrays[0][slots] = fingerprints(ids, absent)
        arrays[1][slots] = np.cumsum(counts) - counts
        arrays[2][slots] = counts
        tail = [ph.words.astype("<u8"), ph.left.astype("<u8"), *arrays]
        head = json.dumps({"width": self.width, "docs": len(ids), "tokens": int(counts.sum()), "sizes": ph.sizes, "left": len(ph.left)}).encode()
        for x in (*(a.tobytes() for a in tail), head, len(head).to_bytes(4, "little"), MAGIC):
            self.out.write(x)
        self.out.close()
        return len(ids), int(counts.sum())


def ordinals(ids: np.ndarray, absent: np.ndarray) -> np.ndarray:
    """How many of the rows before have the same key; equal keys stand together."""
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (absent[1:] != absent[:-1])
    at = np.arange(len(ids))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def fingerprints(ids: np.ndarray, absent: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64), 3 + 0) ^ absent.astype(np.uint64)).astype("<u4")


class ShardReader:
    """Keyed access to one file: the index is read once, payloads by offset."""

    def __init__(self, uri: str):
        fs, path = FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        end = self.file.read_at(12, size - 12)
        if end[4:] != MAGIC:
            raise ValueError(f"{uri} is not a token shard")
        n = int.from_bytes(end[:4], "little")
        self.head = h = json.loads(self.file.read_at(n, size - 12 - n))
        words, docs = sum(h["sizes"]) // 64, h["docs"]
        start = h["tokens"] * h["width"]
        raw = self.file.read_at(size - 12 - n - start, start)
        parts, at = [], 0
        for kind, count in (("<u8", words), ("<u8", h["left"]), ("<u4", docs), ("<u8", docs), ("<u8", docs)):
            parts.append(np.frombuffer(raw, kind, count, at))
            at += parts[-1].nbytes
        self.hash = PerfectHash(h["sizes"], parts[0], parts[1])
        self.prints, self.offsets, self.counts = parts[2:]

    def find(self, ids: np.ndarray, absent: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offset, count) of each key; -1 where the shard lacks it (but for one key in 2**32)."""
        slots = self.hash.slots(key_hashes(ids, absent, which))
        known = (slots >= 0) & (self.prints[np.maximum(slots, 0)] == fingerprints(ids, absent)) if len(self.prints) else np.zeros(len(ids), bool)
        return tuple(np.where(known, x[np.maximum(slots, 0)].astype(np.int64), -1) if len(x) else np.full(len(ids), -1) for x in (self.offsets, self.counts))

    def read(self, offset: int, count: int) -> np.ndarray:
        w = self.head["width"]
        return np.frombuffer(self.file.read_at(int(count) * w, int(offset) * w), f"<u{w}").astype("<u4")

    def read_many(self, offsets: np.ndarray, counts: np.ndarray) -> list[np.ndarray | None]:
        """The ids at each offset, None where it is -1; one read if most of what lies between is asked for."""
        some = offsets >= 0
        if not some.any():
            return [None] * len(offsets)
        lo, hi = int(offsets[some].min()), int((offsets + counts)[some].max())
        if hi - lo > 4 * int(counts[some].sum()) + 1024:
            return [self.read(o, n) if o >= 0 else None for o, n in zip(offsets, counts, strict=True)]
        ids = self.read(lo, hi - lo)
        return [ids[o : o + n] if o >= 0 else None for o, n in zip((offsets - lo * some).tolist(), counts.tolist(), strict=True)]

    def close(self) -> None:
        self.file.close()


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: visible Latin-1 itself, the others from 256 on in order."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}


class LibraryIds:
    """Ids as the tokenizers library gives them; with ``plain_specials`` strings of special tokens are ordinary text.

    Texts that hold such a string, where it counts, go through the library as a whole. Of all others, a chunk that is one
    word of letters is one pre-token, so the library's model takes it as it is; the other chunks go through the whole library.
    """

    def __init__(self, path: str, width: int, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain_specials
        self.specials = [] if plain_specials else [t.content for t in self.library.get_added_tokens_decoder().values()]
        first = self.library.pre_tokenizer
        if self.library.normalizer is not None or type(first).__name__ != "ByteLevel" or first.add_prefix_space or not first.use_regex:
            raise ValueError(f"{path} is no byte-level vocabulary that splits by pattern and leaves texts as they are")
        self.model, self.letters = self.library.model, byte_letters()
        self.packed = [i.to_bytes(width, "little") for i in range(min(self.library.get_vocab_size(), 1 << 8 * width))]
        self.memo = ChunkMemo(self.encode)

    def encode(self, chunks: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(chunks)
        rest, packed, word, tokens = [], self.packed, WORD.fullmatch, self.model.tokenize
        for i, c in enumerate(chunks):
            if word(c):
                out[i] = b"".join([packed[t.id] for t in tokens(c.decode("latin-1").translate(self.letters))])
            else:
                rest.append(i)
        for at in range(0, len(rest), 1000):
            some = rest[at : at + 1000]
            for i, e in zip(some, self.library.encode_batch_fast([chunks[i].decode() for i in some], add_special_tokens=False), strict=True):
                out[i] = b"".join([packed[t] for t in e.ids])
        return out


    def ids(self, column: pa.Array) -> list[bytes]:
        """One value a text."""
        out = self.memo(column).to_numpy(zero_copy_only=False).tolist()
        if self.specials:
            held = pc.match_substring_regex(column, "|".join(map(re.escape, self.specials)))
            for i in np.flatnonzero(held.fill_null(False).to_numpy(zero_copy_only=False)).tolist():
                out[i] = b"".join([self.packed[t] for t in self.library.encode(column[i].as_py(), add_special_tokens=False).ids])
        return out


def library_ids(path: str, width: int, plain_specials: bool = False) -> LibraryIds:
    """One a worker process."""
    return only(f"library {path} {width} {plain_specials}", lambda: LibraryIds(path, width, plain_specials))


def _keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    absent = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), absent


def write_tokens(docs: DataFrame, path: str, end_id: int, vocabulary: int, folder: str | None = None, text: str = "text", key: str = "doc_id", plain_specials: bool = False) -> list[dict]:
    """Encode all texts as the library does (with ``plain_specials``, strings of special tokens as ordinary text), append ``end_id`` to each, and write shards of ascending keys; returns the manifest.

    The manifest has one row a shard: number, file, documents, ids, ids of all shards before, least key.
    One shuffle by key ranges, whose borders come from the keys alone and which are dealt to tasks by their bytes, the
    largest first; a task streams each range to one file, whose
    name is new in each attempt, so that a lost or doubled attempt leaves an unlisted file at most. A null text counts as empty; null keys
    come first; rows that share a key stand in the order of their texts; other columns are not read. An
    empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    folder = folder or work_path(spark, "tokens")
    FileSystem.from_uri(folder)[0].create_dir(FileSystem.from_uri(folder)[1], recursive=True)
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    end = end_id.to_bytes(width, "little")

    kinds = pa.schema([("shard", pa.int64()), ("file", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("first", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, number, first = None, -1, None

        def row() -> pa.RecordBatch:
            n, tokens = writer.close()
            return pa.RecordBatch.from_pylist([{"shard": number, "file": writer.uri, "docs": n, "tokens": tokens, "first": first}], schema=kinds)

        for b in batches:
            encoder = library_ids(path, width, plain_specials)
            ids, absent = _keys(b.column(1))
            for lo, hi in runs(b.column(0).to_numpy(), b.num_rows):
                if number != b.column(0)[lo].as_py():
                    if writer is not None:
                        yield row()
                    number = b.column(0)[lo].as_py()
                    writer = ShardWriter(f"{folder}/shard-{number:06d}-{os.urandom(6).hex()}.tok", width)
                    first = None if absent[lo] else int(ids[lo])
                for at, to in slices(texts := b.column(2).slice(lo, hi - lo), 16_000_000):
                    writer.add(ids[lo + at : lo + to], absent[lo + at : lo + to], [x + end for x in encoder.ids(texts.slice(at, to - at))])
        if writer is not None:
            yield row()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    n = partitions(spark)
    cuts = docs.select(F.percentile_approx(F.col(key).cast("long"), [i / (3 * n) for i in range(1, 3 * n)], 10_000)).first()[0] if n > 1 else None
    rows = rows.select(range_number(F.col("key"), sorted(set(cuts or []))).alias("shard"), "key", "text")
    sizes = {r.shard: r.size for r in rows.groupBy("shard").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(16).cast("long")).alias("size")).collect()}
    rows = rows.repartitionById(n, dealt(F.col("shard"), sizes, n)).sortWithinPartitions("shard", F.col("key").asc_nulls_first(), F.coalesce("text", F.lit("")))
    manifest = [r.asDict() for r in rows.mapInArrow(run, "shard long, file string, docs long, tokens long, first long").collect()]
    manifest.sort(key=lambda r: r["shard"])
    before = 0
    for r in manifest:
        r["before"] = before
        before += r["tokens"]
    return manifest


def read_tokens(spark: SparkSession, manifest: list[dict], keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, shard, start, ids) for each row of ``keys``, by the index of the shard whose range holds the key.

    start counts the ids of all documents before; ids are little-endian unsigned 32-bit integers. A key that
    no shard has gives nulls. The n-th row of ``keys`` with one key gives the n-th document with that key.
    """
    if not manifest:
        return keys.select(key, F.lit(None).cast("int").alias("shard"), F.lit(None).cast("long").alias("start"), F.lit(None).cast("binary").alias("ids"))
    places = [(r["file"], r["before"]) for r in manifest]
    cuts = [r["first"] for r in manifest[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held, last, nth = None, None, None, 0
        for b in batches:
            shards = b.column(0).to_numpy()
            ids, absent = _keys(b.column(1))
            which = ordinals(ids, absent)
            if len(ids):  # a key may go on from the batch before
                same = np.cumprod((ids == ids[0]) & (absent == absent[0])).astype(bool)
                if last == (shards[0], ids[0], absent[0]):
                    which[same] += nth
                last, nth = (shards[-1], ids[-1], absent[-1]), int(which[-1]) + 1
            for at, to in runs(shards, 500):
                if held != shards[at]:
                    if reader is not None:
                        reader.close()
                    held, reader = shards[at], ShardReader(places[shards[at]][0])
                offsets, counts = reader.find(ids[at:to], absent[at:to], which[at:to])
                there = offsets >= 0
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(1).slice(at, to - at),
                        pa.array(np.full(to - at, held), pa.int32()),
                        pa.array(offsets + places[held][1], pa.int64(), mask=~there),
                        pa.array([x if x is None else x.tobytes() for x in reader.read_many(offsets, counts)], pa.binary()),
                    ],
                    names=["key", "shard", "start", "ids"],
                )

    rows = keys.select(range_number(F.col(key).cast("long"), cuts).alias("shard"), F.col(key).cast("long").alias("key"))
    n = partitions(spark)
    sizes = {i: r["tokens"] + r["docs"] for i, r in enumerate(manifest)}
    rows = rows.repartitionById(n, dealt(F.col("shard"), sizes, n)).sortWithinPartitions("shard", F.col("key").asc_nulls_first())
    return rows.mapInArrow(run, "key long, shard int, start long, ids binary").withColumnRenamed("key", key)


def runs(values: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of equal values, of ``most`` rows at most."""
    edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)] if len(values) else []
    for a, b in zip(edges, edges[1:], strict=False):
        for at in range(a, b, most):
            yield at, min(b, at + most)
