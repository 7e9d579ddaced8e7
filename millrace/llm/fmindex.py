"""Benchmark decontamination by full-text indexes over shards of training text.

A shard's words are numbered by the test vocabulary; words that no test item holds, and text edges,
are separators that no phrase can cross. Its suffixes are sorted (separators in order of place, so
that a comparison ends at one), the Burrows-Wheeler transform goes into a wavelet matrix with ranks,
and every phrase is searched backwards, all phrases in step. Found rows are located by walking back
to a sampled suffix: each 16th, and each that follows a separator, so that no walk meets one.

Shards are slices of a task's rows, so the whole work is one pass without a shuffle. Phrases are kept
in files of bounded size in the shared folder; a shard is searched for one file at a time, so
neither side has to fit into memory.
"""

from __future__ import annotations

import os
import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import work_path
from millrace.llm.words import Texts, slices, word_table
from millrace.llm.worker import only

#: Bytes that are not part of a word, after A-Z have been lower-cased.
OTHER_BYTES = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TABLE = word_table(OTHER_BYTES)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes; symbol 0 is a separator and stands last; separators compare by place."""
    n = len(symbols)
    sep = symbols == 0
    rank = np.where(sep, np.cumsum(sep) - 1, sep.sum() + symbols.astype(np.int64))
    order = np.argsort(rank, kind="stable")
    keys = rank[order]
    first = np.r_[True, keys[1:] != keys[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    slots = np.flatnonzero(~(first & np.r_[first[1:], True]))
    step = 1
    while len(slots):
        at = order[slots]
        group, second = rank[at], rank[at + step]
        o = np.lexsort((second, group))
        at, group, second = at[o], group[o], second[o]
        order[slots] = at
        first = np.r_[True, (group[1:] != group[:-1]) | (second[1:] != second[:-1])]
        rank[at] = slots[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        slots = slots[~(first & np.r_[first[1:], True])]
        step *= 2
    return order


class BitRank:
    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        w = i >> 6
        return self.before[w] + np.bitwise_count(self.words[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, top: int):
        self.levels, now = [], symbols
        for bit in reversed(range(max(1, int(top).bit_length()))):
            ones = (now >> bit) & 1 == 1
            self.levels.append((bit, BitRank(ones), len(now) - int(ones.sum())))
            now = np.concatenate([now[~ones], now[ones]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each c is among the first i symbols."""
        lo, hi = np.zeros_like(i), i
        for bit, ranks, zeros in self.levels:
            one = (c >> bit) & 1 == 1
            a, b = ranks.rank(lo), ranks.rank(hi)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return hi - lo

    def access(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        for bit, ranks, zeros in self.levels:
            one = ranks.at(i)
            r = ranks.rank(i)
            out |= one.astype(np.int64) << bit
            i = np.where(one, zeros + r, i - r)
        return out


class FmIndex:
    """Index over symbols; 0 separates and stands last, others are 1..top."""

    def __init__(self, symbols: np.ndarray, top: int, sample: int = 16):
        order = suffix_array(symbols)
        self.n, self.bwt = len(symbols), WaveletMatrix(symbols[order - 1], top)
        self.less = np.r_[0, np.cumsum(np.bincount(symbols, minlength=top + 1))]
        kept = (order % sample == 0) | (symbols[order - 1] == 0)
        self.kept, self.samples = BitRank(kept), order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of the suffixes that begin with each phrase (one a line, all of one length)."""
        c = phrases[:, -1]
        lo, hi = self.less[c].copy(), self.less[c + 1].copy()
        for k in range(phrases.shape[1] - 2, -1, -1):
            on = np.flatnonzero(lo < hi)
            if not len(on):
                break
            c = phrases[on, k]
            lo[on] = self.less[c] + self.bwt.rank(c, lo[on])
            hi[on] = self.less[c] + self.bwt.rank(c, hi[on])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Place in the text of each row's suffix."""
        out, todo, steps, at = np.empty(len(rows), np.int64), np.arange(len(rows)), 0, rows
        while len(todo):
            done = self.kept.at(at)
            out[todo[done]] = self.samples[self.kept.rank(at[done])] + steps
            todo, at = todo[~done], at[~done]
            c = self.bwt.access(at)
            at = self.less[c] + self.bwt.rank(c, at)
            steps += 1
        return out


class Phrases:
    """A block of test phrases: vocabulary, phrases by length as symbol rows, and the items of each."""

    def __init__(self, items: list[tuple[str, np.ndarray]], width: int):
        """items: (id, word hashes); items without words have no phrase."""
        self.words = np.unique(np.concatenate([w for _, w in items])) if items else np.zeros(0, np.uint64)
        found: dict[bytes, set[str]] = defaultdict(set)
        for name, w in items:
            s = (np.searchsorted(self.words, w) + 1).astype(np.int32)
            for i in range(max(1, len(s) - width + 1) if len(s) else 0):
                found[s[i : i + width].tobytes()].add(name)
        by_length: dict[int, list] = defaultdict(list)
        for phrase, names in found.items():
            by_length[len(phrase) // 4].append((phrase, sorted(names)))
        self.groups = [(np.frombuffer(b"".join(p for p, _ in x), np.int32).reshape(-1, n).astype(np.int64), [names for _, names in x]) for n, x in sorted(by_length.items())]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.words >> np.uint64(44)).astype(np.int64)] = True

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """1.. for words of the vocabulary, 0 for others."""
        out = np.zeros(len(hashes), np.int64)
        if len(self.words):
            some = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.words, hashes[some]), len(self.words) - 1)
            out[some] = np.where(self.words[at] == hashes[some], at + 1, 0)
        return out


def phrase_files(items: DataFrame, width: int, block_bytes: int, text: str, key: str) -> list[str]:
    """Write the items' phrases to files, each of items with ``block_bytes`` of text at most (or of one item)."""
    spark = items.sparkSession
    folder = work_path(spark, "phrases")
    fs, path = FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, np.ndarray]] = []
        size = 0

        def save() -> pa.RecordBatch:
            file = f"{folder}/block-{os.urandom(8).hex()}.phrases"
            fs, path = FileSystem.from_uri(file)
            with fs.open_output_stream(path) as f:
                f.write(pickle.dumps(Phrases(held, width)))
            return pa.RecordBatch.from_arrays([pa.array([file])], names=["file"])

        for b in batches:
            for at, to in slices(b.column(1)):
                x = Texts(b.column(1).slice(at, to - at), _TABLE, lower=True)
                words = x.word_hashes()
                for i, name in enumerate(b.column(0).slice(at, to - at).to_pylist()):
                    w = words[x.first[i] : x.first[i + 1]]
                    if held and size + len(w) * 8 > block_bytes:
                        yield save()
                        held, size = [], 0
                    if len(w):
                        held.append((name, w))
                        size += len(w) * 8
        if held:
            yield save()

    total = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    rows = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text"))
    return sorted(r.file for r in rows.repartition(max(1, int(total // block_bytes))).mapInArrow(run, "file string").collect())


def _phrases(file: str, keep: bool) -> Phrases:
    def load() -> Phrases:
        fs, path = FileSystem.from_uri(file)
        with fs.open_input_file(path) as f:
            return pickle.loads(f.read())

    return only(f"phrases {file}", load) if keep else load()


def find_spans(x: Texts, hashes: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, list[tuple[int, str]]]:
    """Word spans (starts, stops) of all occurrences in the shard, and (text number, item) pairs."""
    s = phrases.symbols(hashes)
    doc = x.doc_of_word()
    known = np.flatnonzero(s)
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), []
    gap = np.r_[False, (np.diff(known) > 1) | (doc[known[1:]] != doc[known[:-1]])]
    place = np.arange(len(known)) + np.cumsum(gap)
    symbols = np.zeros(place[-1] + 2, np.int64)
    symbols[place] = s[known]
    origin = np.full(len(symbols), -1)
    origin[place] = known
    index = FmIndex(symbols, len(phrases.words))
    starts, stops, pairs = [], [], set()
    for rows, names in phrases.groups:
        lo, hi = index.search(rows)
        hit = np.flatnonzero(lo < hi)
        if not len(hit):
            continue
        size = hi[hit] - lo[hit]
        which = np.repeat(hit, size)
        at = origin[index.locate(np.repeat(lo[hit], size) + np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size))]
        starts.append(at)
        stops.append(at + rows.shape[1])
        for d, w in {*zip(doc[at].tolist(), which.tolist(), strict=True)}:
            pairs.update((d, name) for name in names[w])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), []
    return np.concatenate(starts), np.concatenate(stops), sorted(pairs)


def contamination(docs: DataFrame, items: DataFrame, width: int = 13, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", keep: list[str] | None = None, block_bytes: int = 16 << 20) -> DataFrame:
    """(key[, keep columns], n_words, n_hit, spans, items) of every row.

    Words are runs of 0-9, a-z and bytes from 0x80, after A-Z are lower-cased. An item's phrases are its
    runs of ``width`` words, or all its words where it has fewer. spans are the merged word spans
    [start, stop) that occurrences cover, n_hit the words in them, items the ids (as strings, sorted,
    without repeats) of items with an occurrence. A null or empty text has no words; an item without
    words has no phrase; items that share an id count as one; a null item id is the empty string. Without
    items nothing is hit. Other columns are neither read nor in the way.
    """
    files = phrase_files(items, width, block_bytes, item_text, item_key)
    with_text = text in (keep or [])
    keep = [c for c in keep or [] if c not in (key, text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in slices(batch.column(1)):
                b = batch.slice(at, to - at)
                x = Texts(b.column(1), _TABLE, lower=True)
                hashes = x.word_hashes()
                change, pairs = np.zeros(len(hashes) + 1, np.int64), []
                for file in files:
                    starts, stops, more = find_spans(x, hashes, _phrases(file, len(files) == 1))
                    np.add.at(change, starts, 1)
                    np.add.at(change, stops, -1)
                    pairs += more
                hit = np.cumsum(change)[:-1] > 0
                total = np.r_[0, np.cumsum(hit)]
                items_of: dict[int, set[str]] = defaultdict(set)
                for d, name in pairs:
                    items_of[d].add(name)
                doc = x.doc_of_word()
                edge = np.r_[True, doc[1:] != doc[:-1]] if len(doc) else np.zeros(0, bool)
                begin = np.flatnonzero(hit & (edge | ~np.r_[False, hit[:-1]]))
                end = np.flatnonzero(hit & (np.r_[edge[1:], True] | ~np.r_[hit[1:], False])) + 1
                spans: list[list] = [[] for _ in range(x.n)]
                for d, s, e in zip(doc[begin].tolist(), begin.tolist(), end.tolist(), strict=True):
                    spans[d].append({"start": s - int(x.first[d]), "stop": e - int(x.first[d])})
                yield pa.RecordBatch.from_arrays(
                    [
                        *(b.column(i) for i in range(b.num_columns)),
                        pa.array(x.counts, pa.int64()),
                        pa.array(np.diff(total[x.first]), pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                        pa.array([sorted(items_of.get(d, ())) for d in range(x.n)], pa.list_(pa.string())),
                    ],
                    names=[f"c{i}" for i in range(b.num_columns + 4)],
                )

    columns = [key, text, *keep]
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)))
    fields = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(rows.schema)]
    fields += [f"c{len(columns) + i} {t}" for i, t in enumerate(("long", "long", "array<struct<start:int,stop:int>>", "array<string>"))]
    out = rows.mapInArrow(run, ", ".join(fields))
    names = [*columns, "n_words", "n_hit", "spans", "items"]
    return out.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names) if i != 1 or with_text))


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """At least a twentieth of the words are hit."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * 20 >= F.col(n_words))


def brute_force(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], width: int = 13) -> dict[int, tuple[int, int, list[str]]]:
    """{key: (n_words, n_hit, items)} by a plain dictionary of phrases, for tests."""
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    blank = bytes(32 if b in OTHER_BYTES else b for b in range(256))
    words = lambda t: (t or "").encode().translate(lower).translate(blank).split(b" ")
    phrases: dict[tuple, set[str]] = defaultdict(set)
    for name, t in items:
        w = [x for x in words(t) if x]
        for i in range(max(1, len(w) - width + 1) if w else 0):
            phrases[tuple(w[i : i + width])].add("" if name is None else str(name))
    sizes = {len(p) for p in phrases}
    out = {}
    for key, t in docs:
        w = [x for x in words(t) if x]
        hit, names = [False] * len(w), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (p := tuple(w[i : i + n])) in phrases:
                    hit[i : i + n] = [True] * n
                    names |= phrases[p]
        out[key] = (len(w), sum(hit), sorted(names))
    return out
