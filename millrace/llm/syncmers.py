"""Document fingerprints from closed syncmers.

A k-byte run is a closed syncmer if, among its s-byte runs, the least by hash is the first or the last.
That depends on the run alone, not on its surroundings, so equal passages have equal anchors wherever
they stand and whatever was edited next to them. A document's fingerprint holds the ``size`` anchors of
least hash with their places: 8 hexadecimal digits of hash and 8 of place each, in the order of
places. A text with no anchor (shorter than k bytes, or none chosen) has one for itself as a whole.

Two fingerprints are likened by place: of the anchors that are among the least of both together, those
that both have and whose places go up together count, as a share of all.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import partitions, range_number
from millrace.llm.words import _BASE, _BYTE, mix, powers, sliding_min, sums


def anchors(buf: np.ndarray, bounds: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place in bytes, 32-bit hash) of the closed syncmers of texts that stand in ``buf`` at ``bounds``."""
    n = len(buf) - k + 1
    none = np.zeros(0, np.int64)
    if n < 1:
        return none, none, none.astype(np.uint32)
    p = sums(_BYTE[buf] * powers(_BASE, len(buf)))
    inverse = powers(pow(_BASE, -1, 1 << 64), len(buf) + 1)
    inner = mix((p[s:] - p[:-s]) * inverse[: len(buf) - s + 1], 3)
    w = k - s + 1
    least = sliding_min(inner, w)
    chosen = np.flatnonzero((inner[:n] == least) | (inner[w - 1 :] == least))
    text = np.searchsorted(bounds, chosen, "right") - 1
    inside = chosen + k <= bounds[text + 1]
    chosen, text = chosen[inside], text[inside]
    hashes = mix((p[chosen + k] - p[chosen]) * inverse[chosen], 4)
    return text, chosen - bounds[text], (hashes >> np.uint64(32)).astype(np.uint32)


def fingerprints(texts: list[bytes], k: int = 24, s: int = 8, size: int = 64) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, places) of each text's fingerprint, in the order of places."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    bounds = np.r_[0, np.cumsum(sizes)]
    buf = np.frombuffer(b"".join(texts), np.uint8)
    text, place, hashes = anchors(buf, bounds, k, s)
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    out = []
    for i, t in enumerate(texts):
        h, at = hashes[first[i] : first[i + 1]], place[first[i] : first[i + 1]]
        if not len(h):
            if t:
                h = np.frombuffer(sha256(t).digest()[:4], "<u4")
                out.append((h, np.zeros(1, np.int64)))
            else:
                out.append((np.zeros(0, np.uint32), np.zeros(0, np.int64)))
            continue
        if len(h) > 4 * size:  # most can't be among the least; equal hashes stay together
            some = np.flatnonzero(h <= np.partition(h, 2 * size)[2 * size])
            u, where = np.unique(h[some], return_index=True)
            if len(u) < size:
                u, where = np.unique(h, return_index=True)
            else:
                where = some[where]
        else:
            u, where = np.unique(h, return_index=True)
        where = np.sort(where[:size])
        out.append((h[where], at[where]))
    return out


def as_text(f: tuple[np.ndarray, np.ndarray]) -> str:
    return np.column_stack([f[0], f[1]]).astype(">u4").tobytes().hex()


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], size: int = 64) -> float:
    """0 to 1; 1 for equal fingerprints, two empty ones included; 0 if one is empty or nothing is shared in order."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    places = dict(zip(b[0].tolist(), b[1].tolist(), strict=True))
    shared = [(at, places[h], h) for h, at in zip(a[0].tolist(), a[1].tolist(), strict=True) if h in places]
    if not shared:
        return 0.0
    union = np.union1d(a[0], b[0])[:size]
    last = int(union[-1])
    ends: list[int] = []  # least last place in b of a rising chain, by its length
    for _, to, h in shared:
        if h <= last:
            i = bisect_left(ends, to)
            ends[i : i + 1] = [to]
    return len(ends) / len(union)


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) characters replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_pairs(docs: DataFrame, k: int = 24, s: int = 8, size: int = 64, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Each text's fingerprint, that of its edited form, and likenesses to the edited form and the next text.

    Columns: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The next
    text is the one of the next key in ascending order; after the last comes the first. Null keys come
    first; rows that share a key are in the order of their texts. A null text counts as empty, and an
    empty text's fingerprint is the empty string. An empty table gives no rows. Other columns are not read.

    One shuffle by ranges of keys: each range is also sent the row that follows it, so no order over all
    rows is made in one place; only the least key of each range is known to the driver.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).cast("long").alias("o"), F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = docs.select(F.col(key).cast("long").alias("o"))
    n = partitions(spark) * 4
    found = ids.agg(F.percentile_approx("o", [i / n for i in range(1, n)], 10_000).alias("cuts"), F.count(F.lit(1)).alias("all"), F.count("o").alias("known")).first()
    cuts = sorted(set(found.cuts or []))
    part = range_number(F.col("o"), cuts)
    firsts = {r.part: r.first for r in ids.where("o is not null").groupBy(part.alias("part")).agg(F.min("o").alias("first")).collect()}
    if found.known < found.all:
        firsts[0] = None
    order = sorted(firsts)
    before = {firsts[p]: order[i - 1] for i, p in enumerate(order)}  # the range that a first row also goes to; the last, for the first of all
    wrapped = F.lit(order[-1] if order else 0)
    ghosts = [x for x in before if x is not None]
    also = F.when(F.col("o").isin(ghosts) if ghosts else F.lit(False), F.try_element_at(F.from_json(F.lit("{" + ",".join(f'"{x}":{before[x]}' for x in ghosts) + "}"), "map<string,int>"), F.col("o").cast("string")))
    if None in before:
        also = F.when(F.col("o").isNull(), wrapped).otherwise(also)
    dealt = rows.withColumn("part", part).withColumn("also", also)
    real = dealt.withColumn("to", F.explode(F.when(F.col("also").isNull(), F.array(F.struct(F.col("part"), F.lit(False).alias("ghost")))).otherwise(F.array(F.struct(F.col("part"), F.lit(False).alias("ghost")), F.struct(F.col("also").alias("part"), F.lit(True).alias("ghost"))))))
    real = real.select(F.col("to.part").alias("p"), F.col("to.ghost").alias("ghost"), "key", "text", "o")
    real = real.repartition(partitions(spark), "p").sortWithinPartitions("p", "ghost", F.col("o").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(rows: list, nexts: list[str]) -> pa.RecordBatch:
            texts = [r[3] for r in rows]
            other = [edited(t, x) for t, x in zip(texts, nexts, strict=True)]
            e = [x.encode("utf-8", "replace") for x in other]
            raw = [t.encode("utf-8", "replace") for t in [*texts, nexts[-1]]]
            prints = fingerprints([*raw, *e], k, s, size)
            mine, after, theirs = prints[: len(rows)], prints[1 : len(rows) + 1], prints[len(rows) + 1 :]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[2] for r in rows], keys),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([sha256(x).hexdigest() for x in e]),
                    pa.array([as_text(f) for f in mine]),
                    pa.array([as_text(f) for f in theirs]),
                    pa.array([likeness(a, b, size) for a, b in zip(mine, theirs, strict=True)]),
                    pa.array([likeness(a, b, size) for a, b in zip(mine, after, strict=True)]),
                ],
                names=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        held: list = []  # rows of one range that wait for their next row
        chars, keys, ended = 0, None, False
        for b in batches:
            keys = b.schema.field(2).type
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and held[-1][0] != r[0]:  # a range without a row after it can't be
                    raise AssertionError("a range has no following row")
                if r[1]:
                    if held:
                        yield told(held, [*(x[3] for x in held[1:]), r[3]])
                    held, chars = [], 0
                    continue
                held.append(r)
                chars += len(r[3])
                if chars > 1_500_000 and len(held) > 1:
                    yield told(held[:-1], [x[3] for x in held[1:]])
                    held = held[-1:]
                    chars = len(held[0][3])

    return real.select("p", "ghost", "key", "text").mapInArrow(run, f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double").withColumnRenamed("key", key)
