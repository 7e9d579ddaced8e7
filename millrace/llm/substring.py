"""Removing word runs that occur more than once, by a log-structured index of window fingerprints.

Every window of ``width`` words is named by its fingerprint: the least hash of the ``gram``-word runs
in it. Equal windows have equal fingerprints at equal offsets, and neighbouring windows mostly share
one run's, so a *stretch* of windows whose fingerprint is the same run is one entry; no two windows of
a stretch are equal. The work goes from cheap to exact:

1. Entries: (fingerprint, digest of all the stretch's words, place). Each batch becomes one sorted
   immutable run of the index, after being merge-joined with the runs that are there, which names the
   fingerprints that occur twice, be it in the batch or in the batch and the past. Entries are
   aggregated before the shuffle, so that a hot fingerprint is one row a task.
2. Verification: entries with a repeated fingerprint are compared by the 128-bit digests of their
   words, with one another and with the kinds of stretches that the index remembers. Stretches that
   occur twice as a whole are covered as a whole. Only where a fingerprint has different stretches, one
   witness of each kind is taken apart into its windows, and these are compared by their own
   digests. Fingerprint collisions thus cost time, never a wrong removal.
3. The covered spans of each text are merged and its other words are kept. The index is compacted.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shared import SPACE_BYTES, Stored, checkpointed, partitions, release, work_path
from millrace.llm.words import Texts, run_hashes, slices, sliding_argmin, word_table
from millrace.llm.worker import only

_TABLE = word_table(SPACE_BYTES)
_ENTRY = "fp long, d1 long, d2 long, k1 long, k2 long, start int, n int"


class FingerprintIndex:
    """Sorted immutable runs of fingerprints, as Parquet tables bucketed and sorted by fingerprint.

    With equal buckets a batch's run is merge-joined with older runs as both stream by, without a shuffle or a
    run in memory. An index with ``history`` outlives a call: its runs hold each kind of stretch (digest, whether
    it was there more than once, the place of one witness) and the texts of the batches lie beside them. Without
    it a run holds fingerprints only. ``folder`` names an index that is there already; it must be one that all
    executors see.

    What counts is what the newest list names. A call stages its runs and texts unlisted, and lists all of them, with its
    name and its result, by one new file once everything else has been done; so a call that fails leaves unlisted
    files and no trace in later results, and a call that is repeated by its name gets the result it had.
    """

    COLUMNS = "fp bigint, many boolean, d1 bigint, d2 bigint, k1 bigint, k2 bigint, start int, n int"
    SPANS = "k1 long, k2 long, spans array<struct<start:int,stop:int>>"

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int | None = None, history: bool = True, most_runs: int = 4):
        self.spark, self.folder, self.history, self.most_runs = spark, folder or work_path(spark, "fingerprints"), history, most_runs
        self.fs, self.path = FileSystem.from_uri(self.folder)
        self.fs.create_dir(self.path, recursive=True)
        self.state = {"version": 0, "buckets": buckets or partitions(spark), "runs": [], "texts": [], "calls": {}}
        if lists := self._lists():
            with self.fs.open_input_file(lists[-1]) as f:
                self.state = json.loads(f.read())

    def _lists(self) -> list[str]:
        """The lists, oldest first. Each has a name of its own, as not every store can replace a file."""
        return sorted(f.path for f in self.fs.get_file_info(FileSelector(self.path)) if re.fullmatch(r"index-\d+\.json", f.base_name))

    @property
    def runs(self) -> list[str]:
        return self.state["runs"]

    @property
    def calls(self) -> dict[str, str]:
        return self.state["calls"]

    def _note(self, **changes: list[str] | dict[str, str]) -> None:
        """Make the changes in one step: a new list appears under its name only when it is whole."""
        old = self._lists()
        state = self.state | changes | {"version": self.state["version"] + 1}
        at = f"{self.path}/index-{state['version']:08d}"
        with self.fs.open_output_stream(f"{at}.new") as f:
            f.write(json.dumps(state).encode())
        self.fs.move(f"{at}.new", f"{at}.json")
        self.state = state
        for x in old[:-1]:
            self.fs.delete_file(x)

    def run(self, name: str) -> DataFrame:
        """One run as a table whose buckets and order Spark knows."""
        table = f"millrace_{name.replace('-', '_')}"
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"create table {table} ({self.COLUMNS}) using parquet clustered by (fp) sorted by (fp) into {self.state['buckets']} buckets location '{self.folder}/{name}'")
        return self.spark.table(table)

    def _write(self, rows: DataFrame) -> str:
        """Rows that are dealt by fp, so that each bucket becomes one sorted file."""
        name = f"run-{uuid.uuid4().hex}"
        n = self.state["buckets"]
        table = f"millrace_{name.replace('-', '_')}"
        rows = rows.selectExpr("fp", "many", "d1", "d2", "k1", "k2", "start", "n")
        rows.write.bucketBy(n, "fp").sortBy("fp").options(path=f"{self.folder}/{name}", compression="uncompressed").saveAsTable(table)
        return name

    def stage(self, entries: DataFrame, earlier: list[str]) -> tuple[str, DataFrame]:
        """Make a batch of entries a run that is not listed yet: its name, and the fingerprints (with repeats) that
        occur in the batch and twice in it and the ``earlier`` runs together.
        """
        if self.history:
            kinds = entries.groupBy("fp", "d1", "d2").agg(F.count(F.lit(1)).alias("times"), *(F.first(c).alias(c) for c in ("k1", "k2", "start", "n"))).repartition(self.state["buckets"], "fp")
        else:
            none = {c: F.lit(None).cast("long" if c[0] in "dk" else "int") for c in ("d1", "d2", "k1", "k2", "start", "n")}
            kinds = entries.groupBy("fp").agg(F.count(F.lit(1)).alias("times")).withColumns(none)
        name = self._write(kinds.withColumn("many", F.col("times") > 1))
        new = self.run(name)
        twice = new.groupBy("fp").agg(F.count(F.lit(1)).alias("kinds"), F.max("many").alias("many")).where("kinds > 1 or many").select("fp")
        for r in earlier:
            twice = twice.unionAll(new.select("fp").join(self.run(r).select("fp").hint("merge"), "fp", "left_semi"))
        return name, twice

    def ingest(self, entries: DataFrame) -> DataFrame:
        """Stage a batch and list it at once; returns what ``stage`` names."""
        name, twice = self.stage(entries, self.runs)
        self._note(runs=[*self.runs, name])
        return twice

    def kinds(self, fingerprints: DataFrame, runs: list[str]) -> DataFrame:
        """What the given runs remember of stretches with the fingerprints."""
        parts = [self.run(r).join(fingerprints, "fp", "left_semi") for r in runs]
        return reduce(DataFrame.unionAll, parts) if parts else self.spark.createDataFrame([], self.COLUMNS)

    def remember(self, rows: DataFrame) -> str:
        """Stage the texts (k1, k2, text) of a batch, from which witnesses are read; returns the name to list."""
        name = f"texts-{uuid.uuid4().hex}"
        rows.select("k1", "k2", "text").write.parquet(f"{self.folder}/{name}")
        return name

    def keep(self, spans: DataFrame) -> str:
        """Stage a call's result; returns the name to list."""
        name = f"spans-{uuid.uuid4().hex}"
        spans.write.parquet(f"{self.folder}/{name}")
        return name

    def spans(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.SPANS).parquet(f"{self.folder}/{name}")

    def texts(self) -> DataFrame:
        """All texts kept, once each."""
        names = self.state["texts"]
        if not names:
            return self.spark.createDataFrame([], "k1 long, k2 long, text string")
        return self.spark.read.schema("k1 long, k2 long, text string").parquet(*(f"{self.folder}/{x}" for x in names))

    def merged(self, runs: list[str]) -> str:
        """Stage one run in place of several."""
        # Read as plain files: over a union of bucketed scans Spark 4.1 leaves the shuffle out, though it does not put equal buckets together.
        rows = self.spark.read.schema(self.COLUMNS).parquet(*(f"{self.folder}/{r}" for r in runs)).repartition(self.state["buckets"], "fp")
        return self._write(rows.groupBy("fp", "d1", "d2").agg((F.max("many") | (F.count(F.lit(1)) > 1)).alias("many"), *(F.first(c).alias(c) for c in ("k1", "k2", "start", "n"))))

    def compact(self, most_runs: int = 1) -> None:
        """Merge the runs into one if there are more than ``most_runs``; the old ones go once the new run is listed."""
        old = list(self.runs)
        if len(old) <= most_runs:
            return
        self._note(runs=[self.merged(old)])
        self._drop(old)

    def _drop(self, names: list[str]) -> None:
        for r in names:
            self.spark.sql(f"drop table if exists millrace_{r.replace('-', '_')}")
            self.fs.delete_dir(f"{self.path}/{r}")

    def drop(self) -> None:
        """Remove the index with all its files."""
        self._drop([f.base_name for f in self.fs.get_file_info(FileSelector(self.path)) if f.base_name.startswith("run-")])
        self.fs.delete_dir(self.path)


def keyed(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(k1, k2, key, text): rows that share key and text share (k1, k2), and so their result."""
    if docs.schema[key].dataType.typeName() not in ("long", "integer", "short", "byte", "void"):
        raise TypeError(f"{key} must be an integer column")
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("k1"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("k2"), F.col(key).alias("key"), F.col(text).alias("text"))


def _joined(x: Texts) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words with one blank after each, and each word's place there."""
    sizes = x.ends - x.starts + 1
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = x.buf[_TABLE[x.buf]]
    return out.tobytes(), starts, ends - 1


def _digests(data: bytes, starts: list[int], ends: list[int]) -> np.ndarray:
    return np.frombuffer(b"".join([blake2b(data[a:b], digest_size=16).digest() for a, b in zip(starts, ends, strict=True)]), "<i8").reshape(-1, 2)


def entries(rows: DataFrame, width: int, gram: int) -> DataFrame:
    """The stretches of all texts: fingerprint, digest of their words, place, number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("runs")
        for batch in batches:
            for at, to in slices(batch.column(2)):
                b = batch.slice(at, to - at)
                x = Texts(b.column(2), _TABLE)
                if len(x.starts) < width:
                    continue
                runs = run_hashes(x.word_hashes(), gram)
                places = sliding_argmin(runs, width - gram + 1)
                doc = x.doc_of_word()
                whole = np.flatnonzero(doc[: len(places)] == doc[width - 1 :])
                if not len(whole):
                    continue
                f, d = places[whole], doc[whole]
                new = np.flatnonzero(np.r_[True, (f[1:] != f[:-1]) | (d[1:] != d[:-1])])
                f = runs[f]
                size = np.diff(np.r_[new, len(whole)])
                first = whole[new]
                data, starts, ends = _joined(x)
                digests = _digests(data, starts[first].tolist(), ends[first + size - 1 + width - 1].tolist())
                doc = d[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f[new].view(np.int64)), pa.array(digests[:, 0]), pa.array(digests[:, 1]), b.column(0).take(pa.array(doc)), b.column(1).take(pa.array(doc)), pa.array((first - x.first[doc]).astype(np.int32)), pa.array(size.astype(np.int32))],
                    names=["fp", "d1", "d2", "k1", "k2", "start", "n"],
                )

    return rows.select("k1", "k2", "text").mapInArrow(run, _ENTRY)


def windows(texts: DataFrame, width: int) -> DataFrame:
    """(k1, k2, text, stretches, old) taken apart: digest and place of each window of the stretches, and ``old``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in slices(batch.column(2)):
                b = batch.slice(at, to - at)
                x = Texts(b.column(2), _TABLE)
                data, starts, ends = _joined(x)
                lists = b.column(3)
                flat = lists.flatten()
                doc = np.repeat(np.arange(len(b)), np.diff(lists.offsets.to_numpy()))
                begin, size = flat.field("start").to_numpy(), flat.field("n").to_numpy()
                doc = np.repeat(doc, size)
                first = np.repeat(begin, size) + np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
                place = x.first[doc] + first
                for lo in range(0, len(doc), 50_000):
                    part = slice(lo, lo + 50_000)
                    digests = _digests(data, starts[place[part]].tolist(), ends[place[part] + width - 1].tolist())
                    rows = pa.array(doc[part])
                    yield pa.RecordBatch.from_arrays([pa.array(digests[:, 0]), pa.array(digests[:, 1]), b.column(0).take(rows), b.column(1).take(rows), pa.array(first[part].astype(np.int32)), b.column(4).take(rows)], names=["d1", "d2", "k1", "k2", "start", "old"])

    return texts.mapInArrow(run, "d1 long, d2 long, k1 long, k2 long, start int, old boolean")


def repeated_spans(docs: DataFrame, width: int = 35, gram: int = 8, batches: int = 3, index: FingerprintIndex | None = None, text: str = "text", key: str = "doc_id", call: str | None = None) -> DataFrame:
    """(k1, k2, spans) with the word spans [s, e) that repeated windows cover, one row a text that has any.

    The rows go to the index in ``batches`` by a hash of the text; all are judged together with what the index
    held before. ``width`` and ``gram`` must be those of the index's earlier calls. Without an index the batches pass
    one that lives as long as the call: each is merge-joined with what came before it, which is compacted in between.
    A ``call`` that the index has listed already adds nothing and returns the result it had.
    """
    spark = docs.sparkSession
    if index is not None and call in index.calls:
        return index.spans(index.calls[call])
    rows = keyed(docs, text, key)
    own = index is None
    index = index or FingerprintIndex(spark, history=False)
    before = list(index.runs)
    past = index.texts()
    e = Stored(entries(rows, width, gram).withColumn("batch", F.pmod(F.xxhash64("k1", "k2"), F.lit(batches)).cast("int")), "entries")
    staged, found = [], []
    for k in range(batches):
        if own and len(staged) > 1:  # the runs merged stay until what has been joined with them is done
            staged = [index.merged(staged)]
        name, twice = index.stage(e.df.where(F.col("batch") == k).drop("batch"), before + staged)
        staged.append(name)
        found.append(twice)
    named = Stored(reduce(DataFrame.unionAll, found).distinct(), "named")
    some = Stored(e.df.join(named.df, "fp", "left_semi").select("fp", "d1", "d2", "k1", "k2", "start", "n"), "repeated")
    e.drop()
    release(spark)
    here = some.df.groupBy("fp", "d1", "d2").agg(F.count(F.lit(1)).alias("times"), *(F.first(c).alias(c) for c in ("k1", "k2", "start", "n"))).withColumn("old", F.lit(False))
    if before:
        there = index.kinds(named.df, before).select("fp", "d1", "d2", F.when(F.col("many"), 2).otherwise(1).cast("long").alias("times"), "k1", "k2", "start", "n", F.lit(True).alias("old"))
        one = F.min(F.struct("old", "k1", "k2", "start", "n"))  # a witness of this call, if there is one
        here = here.unionAll(there).groupBy("fp", "d1", "d2").agg(F.sum("times").alias("times"), one.alias("one")).select("fp", "d1", "d2", "times", "one.k1", "one.k2", "one.start", "one.n", "one.old")
    kinds = Stored(here, "kinds")
    mixed = kinds.df.groupBy("fp").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("fp")
    apart = kinds.df.join(mixed, "fp", "left_semi").groupBy("old", "k1", "k2").agg(F.collect_set(F.struct("start", "n")).alias("stretches"))
    source = rows.select("k1", "k2", "text", F.lit(False).alias("old"))
    if before:
        source = source.unionAll(past.dropDuplicates(["k1", "k2"]).select("k1", "k2", "text", F.lit(True).alias("old")))
    w = Stored(windows(source.join(apart, ["old", "k1", "k2"]).select("k1", "k2", "text", "stretches", "old"), width), "windows")
    twice = w.df.groupBy("d1", "d2").count().where("count > 1").select("d1", "d2")
    alone = Stored(w.df.where("not old").join(twice, ["d1", "d2"], "left_semi").select("k1", "k2", "start", F.lit(1).alias("n")), "alone")
    w.drop()
    release(spark)
    whole = some.df.join(kinds.df.where("times > 1").select("fp", "d1", "d2"), ["fp", "d1", "d2"], "left_semi").select("k1", "k2", "start", "n")
    spans = whole.unionAll(alone.df).groupBy("k1", "k2").agg(F.collect_set(F.struct("start", (F.col("start") + F.col("n") + (width - 1)).alias("stop"))).alias("spans"))
    if own or not index.history:
        out = checkpointed(spans)
    else:
        out = index.spans(kept := index.keep(spans))
        texts = index.remember(rows.where(F.octet_length("text") > 0))
        index._note(runs=before + staged, texts=[*index.state["texts"], texts], calls=index.calls | {call or uuid.uuid4().hex: kept})
    for t in (named, some, kinds, alone):
        t.drop()
    if own:
        index.drop()
    elif index.history:
        index.compact(index.most_runs)
    return out


def drop_repeats(docs: DataFrame, width: int = 35, gram: int = 8, batches: int = 3, index: FingerprintIndex | None = None, text: str = "text", key: str = "doc_id", call: str | None = None) -> DataFrame:
    """(key, n_words, n_removed, kept binary) of every row: the words that no repeated window covers, joined by blanks.

    Windows are ``width`` consecutive words; one repeats if its words also begin anywhere else, in the same
    text too, and is judged on the input. With an ``index``, "anywhere" includes all rows of earlier calls with
    it, and these rows are added to it, so that a growing corpus is deduplicated batch by batch. Give each batch a name as
    ``call``: repeated after a failure, with the same rows, the call returns what it returned or would have returned. A text of
    fewer words has no window and keeps all. Null or empty texts have no words. Keys are integers or null (others raise). Rows that share key and text are occurrences of one another. Columns other than
    ``key`` and ``text`` are not read.
    """
    spans = repeated_spans(docs, width, gram, batches, index, text, key, call)

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            for at, to in slices(batch.column(1)):
                b = batch.slice(at, to - at)
                x = Texts(b.column(1), _TABLE)
                data, starts, ends = _joined(x)
                lists = b.column(2)
                flat = lists.flatten()
                doc = np.repeat(np.arange(len(b)), np.diff(lists.offsets.to_numpy()))
                change = np.zeros(len(x.starts) + 1, np.int64)
                np.add.at(change, x.first[doc] + flat.field("start").to_numpy(), 1)
                np.add.at(change, x.first[doc] + flat.field("stop").to_numpy(), -1)
                keep = np.cumsum(change)[:-1] == 0
                total = np.r_[0, np.cumsum(keep)]
                kept_bytes = np.repeat(keep, ends - starts + 1)
                out = np.frombuffer(data, np.uint8)[kept_bytes].tobytes()
                place = np.r_[0, np.cumsum((ends - starts + 1) * keep)][x.first].tolist()
                removed = x.counts - np.diff(total[x.first])
                kept = [out[p : max(p, q - 1)] for p, q in zip(place, place[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], names=["key", "n_words", "n_removed", "kept"])

    rows = keyed(docs, text, key).join(spans, ["k1", "k2"], "left").select("key", "text", F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n_words long, n_removed long, kept binary").withColumnRenamed("key", key)


def brute_force(texts: list[str | None], width: int = 35) -> list[tuple[int, int, str]]:
    """(n_words, n_removed, digest of the kept words) by a plain dictionary of windows, for tests."""
    words = [(t or "").encode().split() for t in texts]
    seen: dict[tuple, int] = {}
    for w in words:
        for i in range(len(w) - width + 1):
            seen[tuple(w[i : i + width])] = seen.get(tuple(w[i : i + width]), 0) + 1
    out = []
    for w in words:
        hit = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                hit[i : i + width] = [True] * width
        kept = [x for x, h in zip(w, hit, strict=True) if not h]
        out.append((len(w), sum(hit), sha256(b" ".join(kept)).hexdigest()))
    return out
