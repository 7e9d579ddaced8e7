"""Near-duplicate groups by SimHash fingerprints that meet at anchor points of a covering code.

A fingerprint bit is 1 if it is set in more than half of the hashes (XXH64, seed 42) of the text's word
shingles. Fingerprints link when at most three bits differ.

Anchors: each 32-bit half of a fingerprint is seen as 31 bits and one more. The words of the perfect Hamming code of
31 bits, with either last bit, are the half's 2**27 anchors; every half is within radius 1 of one of them, its home. Of
three differing bits at most one lies in one of the halves, so two linked fingerprints have a half that differs by
at most 1, and the one is within 1 + 1 of the other's home. Every fingerprint is replicated to all anchors within that
distance, 17 a half, and each anchor compares the fingerprints at home there with all that came.

Only different fingerprints take part, so exact copies cost one. An anchor hands on a forest of links, never all pairs
of a group. Where many meet, its rows are dealt over a grid of tasks: those at home by columns, those that
came by rows; each pair meets in one cell, and a task holds one cell's column and streams the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from millrace.llm.components import components
from millrace.llm.shared import SPACE_BYTES, Stored, partitions
from millrace.llm.words import Texts, slices, word_table

_TABLE = word_table(SPACE_BYTES)
#: Bits of the code's parity checks: bit k of a place's number 1..31.
CHECKS = [sum(1 << (i - 1) for i in range(1, 32) if i >> k & 1) for k in range(5)]


def simhashes(column: pa.Array, k: int = 3, seed: int = 42, at_once: int = 200_000) -> np.ndarray:
    """The fingerprints of texts as unsigned 64-bit integers; without words 0."""
    texts = Texts(column, _TABLE, lower=True)
    # The words of all texts one after another, each followed by one blank.
    size = texts.ends - texts.starts
    ends = np.cumsum(size + 1) - 1
    packed = np.full(int(ends[-1] + 1) if len(ends) else 0, 32, np.uint8)
    inside = np.ones(len(packed), bool)
    inside[ends] = False
    packed[inside] = texts.buf[_TABLE[texts.buf]]
    data, starts = memoryview(packed), ends - size
    out = np.zeros(texts.n, np.uint64)
    runs = np.where(texts.counts >= k, texts.counts - k + 1, np.minimum(texts.counts, 1))
    ones, held, total = np.zeros((texts.n, 64), np.int64), [], 0

    def put() -> None:
        """Add the held texts' hashes, bit by bit."""
        if not held:
            return
        text = np.repeat([t for t, _ in held], [len(h) for _, h in held])
        bits = np.unpackbits(np.concatenate([h for _, h in held]).view(np.uint8), bitorder="little").reshape(-1, 64)
        first = np.flatnonzero(np.diff(text, prepend=-1))
        ones[text[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        held.clear()

    for t in np.flatnonzero(runs).tolist():
        a, n = int(texts.first[t]), int(runs[t])
        last = a + min(k, int(texts.counts[t])) - 1
        for low in range(0, n, at_once):
            high = min(n, low + at_once)
            pairs = zip(starts[a + low : a + high].tolist(), ends[last + low : last + high].tolist(), strict=True)
            held.append((t, np.fromiter((xxh64_intdigest(data[x:y], seed) for x, y in pairs), np.uint64, high - low)))
            total += high - low
            if total >= at_once:
                put()
                total = 0
    put()
    most = (2 * ones > runs[:, None]).astype(np.uint8)
    return np.packbits(most, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64) if texts.n else out


def fingerprinted(docs: DataFrame, k: int = 3, seed: int = 42, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a signed 64-bit integer; whole texts, null is empty."""
    keep = ["doc_id"] if keep is None else keep
    if "fp" in keep:
        raise ValueError("fp is a column of the result")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text)
            found = [simhashes(column.slice(at, to - at), k, seed) for at, to in slices(column)]
            fp = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(fp)], names=[*keep, "fp"])

    fields = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "fp long"])
    return docs.select(*keep, *([text] if text not in keep else [])).mapInArrow(run, fields)


def syndrome(half: Column) -> Column:
    """Place 1..31 of the bit that separates the low 31 bits of ``half`` from the code's nearest word; 0 within the code."""
    return sum((F.bit_count(half.bitwiseAND(F.lit(c))) % 2 * (1 << b) for b, c in enumerate(CHECKS)), F.lit(0))


def bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place - 1)


def home(half: Column, s: Column) -> Column:
    """The anchor within 1."""
    return F.when(s == 0, half).otherwise(half.bitwiseXOR(bit(s)))


def others(half: Column, s: Column) -> Column:
    """The further anchors within 2: two of the 31 bits differ, or the last bit and one of them at most."""
    two = F.transform(F.filter(F.sequence(F.lit(1), F.lit(31)), lambda i: (i < i.bitwiseXOR(s)) & (i.bitwiseXOR(s) != 0) & (i != s)), lambda i: half.bitwiseXOR(bit(i)).bitwiseXOR(bit(i.bitwiseXOR(s))))
    return F.concat(two, F.array(home(half, s).bitwiseXOR(F.lit(1 << 31))))


#: Anchors are counted in so many bins; a bin's rows decide over how many tasks its anchors are dealt.
BINS = 1 << 20


def forest(home_fps: np.ndarray, came: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links between fingerprints (home with home or came) that differ in at most ``most`` bits, enough of them to connect
    all that such links connect.
    """
    every = np.concatenate([home_fps, came])
    label = np.arange(len(every))
    out: list[tuple[int, int]] = []
    for i in range(len(home_fps)):
        rest = np.flatnonzero(label != label[i])
        if not len(rest):
            break  # all that met are connected
        near = rest[np.bitwise_count(every[rest] ^ every[i]) <= most]
        if len(near):
            joined, first = np.unique(label[near], return_index=True)
            out += [(int(every[i]), int(every[j])) for j in near[first]]
            label[np.isin(label, joined)] = label[i]
    return out


def links(fps: DataFrame, most: int = 3, column: int = 2_000, row: int = 8_000) -> Stored:
    """A table (a, b): links between the different fingerprints ``fp`` that connect all within ``most`` (3 at most) bits of each other.

    Anchors are counted by bins first: where a bin has more than ``column`` at home, or more than ``row`` that came (or four
    times the mean bin, where that is more), its anchors are dealt over a grid of tasks. That changes where pairs meet
    and nothing else. Fewer than BINS / 4 bins can be so full in either way, which bounds what is broadcast.
    """
    if not 0 <= most <= 3:
        raise ValueError("more than 3 differing bits need anchors further apart")
    low = lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))
    halves = F.array(F.struct(F.lit(0).alias("side"), low("fp").alias("half")), F.struct(F.lit(1).alias("side"), F.shiftrightunsigned("fp", 32).alias("half")))
    h = fps.select("fp", F.explode(halves).alias("h")).select("fp", "h.side", "h.half").withColumn("s", syndrome(F.col("half")))
    own, far = F.struct(home(F.col("half"), F.col("s")).alias("at"), F.lit(True).alias("lives")), F.transform(others(F.col("half"), F.col("s")), lambda x: F.struct(x.alias("at"), F.lit(False).alias("lives")))
    met = h.select("fp", "side", F.explode(F.concat(F.array(own), far)).alias("m")).select("fp", (F.col("m.at") * 2 + F.col("side")).alias("at"), "m.lives")
    met = met.withColumn("bin", F.pmod(F.xxhash64("at"), F.lit(BINS)).cast("int"))
    counted = Stored(met.groupBy("bin").agg(F.count_if("lives").alias("home"), F.count(F.lit(1)).alias("came")), "bins")
    total = counted.df.agg(F.sum("home").alias("home"), F.sum("came").alias("came")).first()
    cells = lambda c, limit: F.ceil(F.col(c) / max(limit, 4 * (total[c] or 0) / BINS)).cast("int")
    grid = counted.df.select("bin", cells("home", column).alias("columns"), cells("came", row).alias("rows")).where("columns > 1 or rows > 1")
    met = met.join(F.broadcast(grid), "bin", "left")
    part = lambda seed, n: F.pmod(F.xxhash64("fp", F.lit(seed)), F.col(n)).cast("int")
    span = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cell = lambda c, r, lives: F.struct((c * F.col("rows") + r).alias("cell"), F.lit(lives).alias("lives"))
    as_home = F.when(F.col("lives"), F.transform(span("rows"), lambda r: cell(part(1, "columns"), r, True))).otherwise(F.array())
    # One that lives here comes to the other columns; its own has it already.
    as_came = F.transform(F.filter(span("columns"), lambda c: ~F.col("lives") | (c != part(1, "columns"))), lambda c: cell(c, part(2, "rows"), False))
    alone = F.array(F.struct(F.lit(0).alias("cell"), F.col("lives").alias("lives")))
    met = met.select("fp", "at", F.explode(F.when(F.col("columns").isNull(), alone).otherwise(F.concat(as_home, as_came))).alias("d")).select("fp", "at", "d.cell", "d.lives")
    dealt = met.repartition(partitions(fps.sparkSession), "at", "cell").sortWithinPartitions("at", "cell", F.desc("lives")).select("fp", "at", "cell", "lives")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, np.zeros(0, np.uint64)  # the cell at hand, and those at home in it
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            at, cell, lives = batch.column(1).to_numpy(), batch.column(2).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (cell[1:] != cell[:-1]), True]) if len(fp) else np.zeros(0, np.int64)
            # A group of one fingerprint has no pair; only a batch's first group can go on from the one before.
            some = np.flatnonzero((np.diff(edges) > 1) | (np.arange(len(edges) - 1) == 0) | (np.arange(len(edges) - 1) == len(edges) - 2))
            out: list[tuple[int, int]] = []
            for g in some.tolist():
                a, b = int(edges[g]), int(edges[g + 1])
                if (now := (int(at[a]), int(cell[a]))) != key:
                    key, held = now, np.zeros(0, np.uint64)
                n = a + int(np.count_nonzero(lives[a:b]))
                if n > a:
                    held = np.concatenate([held, fp[a:n]])
                if len(held):
                    out += forest(held, fp[n:b], most)
            if out:
                yield pa.RecordBatch.from_arrays(list(pa.array(np.array(out, np.uint64).T.copy().view(np.int64)[k]) for k in (0, 1)), names=["a", "b"])

    found = Stored(dealt.mapInArrow(run, "a long, b long"), "links")
    counted.drop()
    return found


def near_groups(docs: DataFrame, k: int = 3, most: int = 3, seed: int = 42, text: str = "text", key: str = "doc_id", column: int = 2_000, row: int = 8_000) -> DataFrame:
    """A row for each document: key, fingerprint (16 hexadecimal digits), component_id, the least key reachable by links.

    Texts without words (null, empty) have fingerprint 0 and are linked with one another and with all within ``most`` bits of
    it. Rows that share a key are judged one by one; null keys count as none, so a group that has no other has a null
    component_id. An empty table gives no rows; other columns are not read. Keys may be of any type that has an order.
    """
    prints = Stored(fingerprinted(docs, k, seed, text, [key]).withColumnRenamed(key, "key"), "simhash")
    fps = Stored(prints.df.groupBy("fp").agg(F.min("key").alias("least")), "fingerprints")
    edges = links(fps.df.select("fp"), most, column, row)
    label = components(edges.df)
    grouped = fps.df.join(label.select(F.col("node").alias("fp"), "label"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    first = grouped.groupBy("label").agg(F.min("least").alias("component_id"))
    named = grouped.select("fp", "label").join(first, "label").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    out = Stored(prints.df.join(named, "fp").select(F.col("key").alias(key), hexed.alias("fingerprint"), "component_id"), "simhash_groups")
    for t in (prints, fps, edges):
        t.drop()
    return out.df
