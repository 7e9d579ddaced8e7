"""Exact Jaccard self-join of documents' shingle sets, with answers shared among related sets.

A document's set is its distinct ``k``-word shingles, as 64-bit hashes. Equal sets form a class, which
is joined once. Two different sets with similarity ``percent`` or more must share two of their first
n - ceil(percent*n/100) + 2 shingles in any common order, so these prefixes alone are indexed. The
order is by a sketch of document counts over all texts, rare first: frequent passages stay out, and
asking for two shared shingles leaves out most sets that meet by chance.

Relations between sets then replace most comparisons:

* skipping by position: a list's entry knows where its shingle stands in its set, which bounds the
  overlap that can still follow, and entries that cannot reach the threshold are passed over;
* deriving answers: each list is led by its most central set. All members are compared with the
  leader once. What a member lacks of the leader and has beyond it bounds its overlap with every other
  member, so only pairs that these bounds leave open, in different components, are compared at last.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.shared import SPACE_BYTES, Stored, checkpointed, partitions, release, work_path
from millrace.llm.words import Texts, mix, run_hashes, slices, word_table
from millrace.llm.worker import only

_TABLE = word_table(SPACE_BYTES)
_BLOCK = 1 << 16
_TOP = (1 << 16) - 1


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer than k words has one, of all its words."""
    x = Texts(column, _TABLE, lower=True)
    words = x.word_hashes()
    runs = run_hashes(words, k)
    for i in range(x.n):
        a, b = int(x.first[i]), int(x.first[i + 1])
        if b - a >= k:
            yield np.unique(runs[a : b - k + 1])
        elif b > a:
            yield mix(run_hashes(words[a:b], b - a), 100 + b - a)
        else:
            yield np.zeros(0, np.uint64)


def class_of(s: np.ndarray) -> bytes:
    return blake2b(s.tobytes(), digest_size=16).digest()


class Once:
    """Whether a class is new in this task, so that a hot class leaves a task once; forgets after ``most`` classes."""

    def __init__(self, most: int = 500_000):
        self.seen: set[bytes] = set()
        self.most = most

    def __call__(self, c: bytes) -> bool:
        if c in self.seen:
            return False
        if len(self.seen) >= self.most:
            self.seen.clear()
        self.seen.add(c)
        return True


def summed(rows: DataFrame, join: str) -> dict[int, bytes]:
    """(block, data) rows put together block by block, as 16-bit counts that stop at the top ("add") or as bits ("or").

    Parts of the rows are put together where they are, then in a few parts a block, then as a whole, so that no task
    reads more than a share of what many tasks made. The result has a fixed size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if join == "or":
                    x = np.frombuffer(data, np.uint8)
                    held[k] = held[k] | x if k in held else x
                else:
                    x = np.frombuffer(data, "<u2").astype(np.uint32)
                    held[k] = np.minimum(held[k] + x, _TOP) if k in held else x
        if held:
            kind = np.uint8 if join == "or" else "<u2"
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.astype(kind).tobytes() for v in held.values()], pa.binary())], names=["block", "data"])

    one = rows.mapInArrow(run, "block int, data binary").withColumn("part", F.spark_partition_id() % 32)
    few = one.repartition("block", "part").select("block", "data").mapInArrow(run, "block int, data binary")
    return {r.block: r.data for r in few.repartition("block").mapInArrow(run, "block int, data binary").collect()}


def _blocks(counts: np.ndarray) -> tuple[list[int], list[bytes]]:
    parts = np.minimum(counts, _TOP).astype("<u2").reshape(-1, _BLOCK)
    there = np.flatnonzero(parts.any(axis=1))
    return there.tolist(), [parts[i].tobytes() for i in there]


def describe(docs: DataFrame, k: int, bits: int, text: str, key: str) -> tuple[DataFrame, np.ndarray]:
    """(key, n, c) of each row with its set's size and class, and the sketch of shingle counts (those over 65,535 are alike)."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("sets")
        counts = np.zeros(1 << bits, np.int64)
        arrow = None
        for batch in batches:
            arrow = batch.schema.field(0).type
            for at, to in slices(batch.column(1)):
                sets = list(shingle_sets(batch.column(1).slice(at, to - at), k))
                counts += np.bincount((np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
                m = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, m), pa.array([len(s) for s in sets], pa.int32()), pa.array([class_of(s) for s in sets], pa.binary()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())],
                    names=["key", "n", "c", "block", "counts"],
                )
        if arrow is not None and counts.any():
            at, data = _blocks(counts)
            m = len(at)
            yield pa.RecordBatch.from_arrays([pa.nulls(m, arrow), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), pa.array(at, pa.int32()), pa.array(data, pa.binary())], names=["key", "n", "c", "block", "counts"])

    at = work_path(spark, "sets")
    docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, n int, c binary, block int, counts binary").write.parquet(at)
    got = spark.read.parquet(at)
    full = np.zeros(1 << bits, "<u2")
    for k, data in summed(got.where("block is not null").select("block", "counts"), "add").items():
        full[k * _BLOCK : (k + 1) * _BLOCK] = np.frombuffer(data, "<u2")
    return got.where("block is null").select("key", "n", "c"), full


def needed(percent: int) -> int:
    """Shingles that two different sets share at least if they link: two over 50 percent, where a set of one links with its equals only."""
    return 2 if percent > 50 else 1


def prefixes(docs: DataFrame, k: int, percent: int, sketch: np.ndarray, text: str, hot: int = 5_000) -> DataFrame:
    """The index: (t, c, n, p, part) for the shingle t at place p of the prefix of class c of size n.

    Lists of shingles that the sketch counts ``hot`` times or more are dealt in parts, by class; part is 0 for others.
    """
    bits, least = len(sketch).bit_length() - 1, needed(percent)
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("sets")
        counts, once = shared.value, Once()
        for batch in batches:
            for at, to in slices(batch.column(0)):
                ts, cs, ns, ps, parts = [], [], [], [], []
                for s in shingle_sets(batch.column(0).slice(at, to - at), k):
                    if (n := len(s)) < least or not once(c := class_of(s)):
                        continue
                    size = min(n, n - -(-percent * n // 100) + least)
                    often = counts[(s >> np.uint64(64 - bits)).astype(np.int64)]
                    order = np.lexsort((s, often))[:size]
                    ts.append(s[order])
                    cs += [c] * size
                    ns.append(np.full(size, n, np.int32))
                    ps.append(np.arange(size, dtype=np.int32))
                    parts.append(np.where(often[order] >= hot, c[0] + 1, 0).astype(np.int16))
                if ts:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ts).view(np.int64)), pa.array(cs, pa.binary()), *(pa.array(np.concatenate(x)) for x in (ns, ps, parts))], names=["t", "c", "n", "p", "part"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "t long, c binary, n int, p int, part short")


def shared_lists(index: DataFrame) -> DataFrame:
    """The index without the lists of one class only, and each class once a list; one shuffle, streamed in order.

    A list in parts is a long one: whatever is in its parts stays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, out = None, False  # the last row so far, which waits for its successor, and whether it has been given out
        for b in batches:
            if not b.num_rows:
                continue
            b = b if last is None else pa.concat_batches([last, b])
            t = b.column(0).to_numpy()
            c = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u8").reshape(-1, 2)
            new = np.r_[True, (c[1:] != c[:-1]).any(axis=1) | (t[1:] != t[:-1])]
            b, t = b.filter(pa.array(new)), t[new]
            same = t[1:] == t[:-1]
            give = np.r_[False, same] | np.r_[same, False] | (b.column(4).to_numpy() > 0)
            had = last is not None and out
            out = bool(give[-1]) or (had and len(t) == 1)
            if had:
                give[0] = False
            last = b.slice(len(t) - 1, 1)
            yield b.filter(pa.array(give))

    dealt = index.repartition(partitions(index.sparkSession), "t", "part").sortWithinPartitions("t", "part", "c")
    return dealt.mapInArrow(run, index.schema).drop("part")


def sets_of(docs: DataFrame, classes: DataFrame, k: int, text: str) -> DataFrame:
    """(c, s) of the classes asked for. A bit map, sized by their number within bounds, keeps most other sets on their executor; the join is exact."""
    spark = docs.sparkSession
    bits = min(27, max(19, (8 * classes.count()).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, bool)
        for b in batches:
            if b.num_rows:
                seen[_place(b.column(0).to_pylist(), bits)] = True
        for i in np.flatnonzero(seen.reshape(-1, _BLOCK * 8).any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([np.packbits(seen[i * _BLOCK * 8 : (i + 1) * _BLOCK * 8]).tobytes()], pa.binary())], names=["block", "data"])

    whole = np.zeros((1 << bits) // 8, np.uint8)
    for i, data in summed(classes.mapInArrow(mark, "block int, data binary"), "or").items():
        whole[i * _BLOCK : (i + 1) * _BLOCK] = np.frombuffer(data, np.uint8)
    shared = spark.sparkContext.broadcast(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("sets")
        wanted, once = shared.value, Once()
        for batch in batches:
            for at, to in slices(batch.column(0)):
                sets = list(shingle_sets(batch.column(0).slice(at, to - at), k))
                cs = [class_of(s) for s in sets]
                place = _place(cs, bits)
                hit = [i for i in np.flatnonzero(wanted[place >> 3] & (128 >> (place & 7))).tolist() if once(cs[i])]
                yield pa.RecordBatch.from_arrays([pa.array([cs[i] for i in hit], pa.binary()), pa.array([sets[i].tobytes() for i in hit], pa.binary())], names=["c", "s"])

    got = docs.select(F.col(text).alias("text")).mapInArrow(run, "c binary, s binary")
    return got.join(classes, "c", "left_semi").groupBy("c").agg(F.first("s").alias("s"))


def _place(cs: list[bytes], bits: int) -> np.ndarray:
    return (np.frombuffer(b"".join(cs), "<u8")[::2] >> np.uint64(64 - bits)).astype(np.int64)


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, na, b, nb) with o, the size of the intersection of the two sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            o = [len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True)) for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(o, pa.int32())], names=["a", "na", "b", "nb", "o"])

    both = pairs.join(sets.select(F.col("c").alias("b"), F.col("s").alias("sb")), "b").join(sets.select(F.col("c").alias("a"), F.col("s").alias("sa")), "a")
    return both.select("a", "na", "b", "nb", "sa", "sb").mapInArrow(run, "a binary, na int, b binary, nb int, o int")


def _reach(na: Column, pa_: Column, nb: Column, pb: Column, percent: int) -> Column:
    """Whether sizes and places allow the threshold, this shingle being the first or second that the two share."""
    return _enough(F.lit(needed(percent)) + F.least(na - pa_ - 1, nb - pb - 1), na, nb, percent)


def _enough(o: Column, na: Column, nb: Column, percent: int) -> Column:
    return o.cast("long") * 100 >= (na + nb - o).cast("long") * percent


def band(n: Column, percent: int) -> Column:
    """Number of the size band: sets that can link are in one band or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / max(1.01 * log(100 / percent), 1e-3))


def links(docs: DataFrame, k: int = 4, percent: int = 85, bits: int | None = None, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """((key, n, c) of all rows, (c, label) of all classes that have links).

    Two classes have one label when links of the given similarity join them, directly or in steps. The sketch has
    2**bits counters: if not given, 64 a row, within 2**16 and 2**21. Pairs are asked for as many shared shingles as they
    ``needed`` have before they are compared.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must lie between 1 and 100")
    spark, least = docs.sparkSession, needed(percent)
    bits = bits or min(21, max(16, (64 * docs.count()).bit_length()))
    rows, sketch = describe(docs, k, bits, text, key)
    entries = Stored(shared_lists(prefixes(docs, k, percent, sketch, text)), "lists")
    release(spark)
    sizes = entries.df.groupBy("t").agg(F.count(F.lit(1)).alias("m"))
    degree = entries.df.join(sizes, "t").groupBy("c").agg(F.sum("m").alias("degree"), F.count(F.lit(1)).alias("lists")).where(F.col("lists") >= least).drop("lists")
    ranked = entries.df.join(degree, "c")
    leaders = ranked.groupBy("t").agg(F.max(F.struct("degree", F.struct("c", "n", "p").alias("l"))).alias("top")).select("t", F.col("top.l.c").alias("lc"), F.col("top.l.n").alias("ln"), F.col("top.l.p").alias("lp"))
    led = Stored(ranked.join(leaders, "t").select("t", "c", "n", "p", "lc", "ln", "lp"), "led").df
    entries.drop()
    release(spark)
    stars = led.where(F.col("c") != F.col("lc")).where(_reach(F.col("n"), F.col("p"), F.col("ln"), F.col("lp"), percent))
    first = checkpointed(_met(least, stars.select(F.col("lc").alias("a"), F.col("ln").alias("na"), F.col("c").alias("b"), F.col("n").alias("nb"))))
    known = _compare(docs, first, k, text)
    linked = known.where(_enough(F.col("o"), F.col("na"), F.col("nb"), percent)).select("a", "b")
    label = components(linked)
    release(spark)
    # Lists whose members are in one component are settled.
    m = led.join(label.withColumnRenamed("node", "c"), "c", "left").withColumn("label", F.coalesce("label", "c"))
    open_lists = m.groupBy("t").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("t")
    o = known.select(F.col("a").alias("x"), F.col("b").alias("y"), "o")
    o = o.unionAll(o.select(F.col("y").alias("x"), F.col("x").alias("y"), "o"))
    m = m.join(open_lists, "t", "left_semi").join(o.withColumnRenamed("x", "c").withColumnRenamed("y", "lc"), ["c", "lc"], "left").withColumn("o", F.when(F.col("c") == F.col("lc"), F.col("n")).otherwise(F.col("o")))
    m = m.join(label.select(F.col("node").alias("lc"), F.col("label").alias("led_by")), "lc", "left").withColumn("out", F.col("label") != F.coalesce("led_by", "lc"))
    m = checkpointed(m.select("t", "c", "n", "p", "label", "o", "out"))
    m = m.withColumn("band", band(F.col("n"), percent))
    a, b = m.where("out").withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))).alias("a"), m.alias("b")
    ca, cb = F.col("a.c"), F.col("b.c")
    na, nb, oa, ob = F.col("a.n"), F.col("b.n"), F.col("a.o"), F.col("b.o")
    most = F.least(oa, ob) + F.least(na - oa, nb - ob)
    pairs = a.join(
        b,
        (F.col("a.t") == F.col("b.t"))
        & (F.col("a.band") == F.col("b.band"))
        & (F.col("a.label") != F.col("b.label"))
        & (~F.col("b.out") | (ca < cb))
        & _reach(na, F.col("a.p"), nb, F.col("b.p"), percent)
        & F.coalesce(_enough(most, na, nb, percent), F.lit(True)),
    )
    pairs = _met(least, pairs.select(ca.alias("a"), na.alias("na"), cb.alias("b"), nb.alias("nb"))).join(known.select("a", "b"), ["a", "b"], "left_anti")
    last = checkpointed(pairs)
    if not last.isEmpty():
        more = _compare(docs, last, k, text).where(_enough(F.col("o"), F.col("na"), F.col("nb"), percent)).select("a", "b")
        label = components(linked.unionAll(checkpointed(more)))
    return rows, label.withColumnRenamed("node", "c")


def _met(least: int, pairs: DataFrame) -> DataFrame:
    """The pairs that are there for so many shingles or more, a before b."""
    swap = F.col("a") > F.col("b")
    ordered = pairs.select(*(F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("na", "nb"), ("b", "a"), ("nb", "na"))))
    return ordered.groupBy("a", "na", "b", "nb").count().where(F.col("count") >= least).drop("count")


def _compare(docs: DataFrame, pairs: DataFrame, k: int, text: str) -> DataFrame:
    classes = pairs.select(F.col("a").alias("c")).unionAll(pairs.select(F.col("b").alias("c"))).distinct()
    sets = Stored(sets_of(docs, checkpointed(classes), k, text), "sets")
    out = checkpointed(overlaps(pairs, sets.df))
    sets.drop()
    release(docs.sparkSession)
    return out


def similar_groups(docs: DataFrame, k: int = 4, percent: int = 85, bits: int | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id) of every row; component_id is the least key reachable by links.

    Words are runs of bytes other than white space, with A-Z lower-cased. Two rows link when
    100 * intersection >= percent * union of their shingle sets; ``percent`` lies between 1 and 100. A row without words (null, empty or
    blank text) has no shingles and links with nothing, so its component_id is its key. Rows with equal
    sets always link. Null keys take part but are never a component's name, unless all its keys are null.
    Columns other than ``key`` and ``text`` are not read.
    """
    rows, labels = links(docs, k, percent, bits, text, key)
    classes = rows.where("n > 0").groupBy("c").agg(F.min("key").alias("least"))
    named = classes.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(least, "label").select("c", "component_id")
    full = rows.where("n > 0").join(named, "c").select("key", "n", "component_id")
    empty = rows.where("n = 0").select("key", "n", F.col("key").alias("component_id"))
    return full.unionByName(empty).select(F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"), "component_id")


def brute_force(rows: list[tuple[int, str | None]], k: int = 4, percent: int = 85) -> dict[int, tuple[int, int]]:
    """{key: (n_shingles, component_id)} by comparing all pairs, for tests."""
    sets = {}
    for key, text in rows:
        w = bytes((text or ""), "utf-8").lower().split() if text else []
        sets[key] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {key: key for key in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {key: (len(sets[key]), find(key)) for key in keys}
