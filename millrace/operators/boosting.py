"""Gradient-boosted classification trees of many classes over binned features, with missing values as they are.

Each round grows one tree a class on the gradients of the softmax loss. A level of all these trees is one Spark
aggregate: tasks add gradients, hessians and counts of their rows into histograms by (class, node, feature, bin), the
histograms of a (class, node) are added by one task, and the same task finds the best split, so that the driver gets a
row a node, whatever the number of rows or features. Missing values have a bin of their own and go to the side that
gains more. Gradients are whole numbers (of 2**-20), so sums and trees do not depend on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import checkpointed

UNIT = float(1 << 20)
MISSING = 255
#: Rows that one task takes at least.
ROWS = 20_000


@dataclass
class Tree:
    """A complete binary tree in heap order; a node with feature -1 sends all rows left."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        inner = (1 << depth) - 1
        return cls(np.full(inner, -1, np.int32), np.zeros(inner, np.int32), np.ones(inner, bool), np.zeros(inner + 1))

    def nodes(self, x: np.ndarray, level: int) -> np.ndarray:
        """Number of each row's node among those of the level; x holds bins."""
        at = np.zeros(len(x), np.int64)
        every = np.arange(len(x))
        for _ in range(level):
            f = self.feature[at]
            b = x[every, np.maximum(f, 0)]
            left = (f < 0) | np.where(b == MISSING, self.missing_left[at], b <= self.cut[at])
            at = 2 * at + 2 - left
        return at - ((1 << level) - 1)


def best_split(h: np.ndarray, least: float, l2: float) -> tuple[int, int, bool, float, float, float, float]:
    """(feature, cut, missing goes left, then gradients and hessians of the left and the right side) from (feature, bin, 2) sums.

    The last bin is of the missing. Without a split that gains and leaves hessians of ``least`` on both sides, the feature is -1 and
    all is left. Of equal gains the first by feature, cut, and missing to the left counts.
    """
    total = h[0].sum(axis=0) / UNIT
    known, missing = np.cumsum(h[:, :-1], axis=1)[:, :-1], h[:, -1:]
    left = np.stack([known + missing, known], axis=2) / UNIT  # feature, cut, direction, sums
    right = total - left
    score = lambda t: t[..., 0] ** 2 / (t[..., 1] + l2)
    fits = (left[..., 1] >= least) & (right[..., 1] >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, score(left) + score(right) - score(total), 0.0)
    if not gain.size or gain.max() <= 1e-9:
        return -1, 0, True, total[0], total[1], 0.0, 0.0
    f, cut, way = np.unravel_index(int(gain.argmax()), gain.shape)
    return int(f), int(cut), bool(way == 0), *left[f, cut, way], *right[f, cut, way]


def gradients(scores: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole-numbered gradients and hessians of the softmax loss, by row and class."""
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    p = e / e.sum(axis=1, keepdims=True)
    g = p.copy()
    g[np.arange(len(y)), y] -= 1.0
    return np.rint(g * UNIT), np.rint(p * (1 - p) * UNIT)


@dataclass
class BoostedTrees:
    features: list[str]
    classes: list[str]
    cuts: list[np.ndarray]
    prior: np.ndarray
    rounds: list[list[Tree]] = field(default_factory=list)

    def bins(self, columns: list[pa.Array]) -> np.ndarray:
        """Number of cuts below each value; null and NaN are MISSING."""
        out = np.empty((len(columns[0]) if columns else 0, len(columns)), np.uint8)
        for i, (c, cut) in enumerate(zip(columns, self.cuts, strict=True)):
            v = c.cast(pa.float64()).to_numpy(zero_copy_only=False)
            out[:, i] = np.where(np.isnan(v), MISSING, np.searchsorted(cut, v, "left"))
        return out

    def add(self, scores: np.ndarray, x: np.ndarray, rounds: list[list[Tree]]) -> np.ndarray:
        for trees in rounds:
            for k, t in enumerate(trees):
                scores[:, k] += t.value[t.nodes(x, int(len(t.value)).bit_length() - 1)]
        return scores

    def predicted(self, df: DataFrame, keep: list[str], out: str = "predicted") -> DataFrame:
        """The columns ``keep`` and the most likely class (the first of equals)."""
        if out in keep:
            raise ValueError(f"{out} is a column of the result")
        n = len(keep)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = self.bins(b.columns[n:])
                scores = self.add(np.tile(self.prior, (b.num_rows, 1)), x, self.rounds)
                yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array([self.classes[k] for k in scores.argmax(axis=1)], pa.string())], names=[*keep, out])

        kinds = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), f"`{out}` string"])
        return df.select(*keep, *(F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(self.features))).mapInArrow(run, kinds)


def quantile_cuts(df: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """At most bins - 1 ascending cuts a feature, at quantiles of its values; the driver gets features x bins numbers."""
    probs = [i / bins for i in range(1, bins)]
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias("x")) for i, f in enumerate(features)))).alias("v")
    got = df.select(each).where("v.x is not null").groupBy("v.i").agg(F.percentile_approx("v.x", probs, 10_000).alias("cuts"))
    cuts = {r.i: np.unique(r.cuts) for r in got.collect()}
    return [cuts.get(i, np.zeros(0)) for i in range(len(features))]


def fit(df: DataFrame, features: list[str], label: str, rounds: int = 30, depth: int = 3, rate: float = 0.3, bins: int = 32, least: float = 1.0, l2: float = 1.0, every: int = 10) -> BoostedTrees:
    """Boosted trees that tell ``label`` from ``features`` (numbers); rows without a label are left out.

    A task's histograms hold classes x 2**(depth - 1) x features x bins pairs of numbers, whatever its rows.

    Scores of the rows are written down each ``every`` rounds; in between, tasks add the newest trees to them as they
    read. An empty table, or one without labels, gives a model without classes; with one class it has no rounds.
    """
    if not 1 < bins <= 255 or least <= 0 or depth < 1:
        raise ValueError("bins must lie between 2 and 255, least above 0, depth at 1 or more")
    df = df.where(F.col(label).isNotNull())
    counts = {str(r[0]): r[1] for r in df.groupBy(F.col(label).cast("string")).count().collect()}
    classes = sorted(counts)
    sizes = np.array([counts[c] for c in classes], float)
    model = BoostedTrees(features, classes, quantile_cuts(df, features, bins), np.log(sizes / sizes.sum()) if classes else np.zeros(0))
    if len(classes) < 2 or not features:
        return model
    k, n_features, number = len(classes), len(features), {c: i for i, c in enumerate(classes)}
    width = max(len(c) for c in model.cuts) + 2  # bins, and one for the missing

    def prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = model.bins(b.columns[1:])
            scores = np.tile(model.prior, (b.num_rows, 1))
            yield pa.RecordBatch.from_arrays([pa.array([number[c] for c in b.column(0).to_pylist()], pa.int32()), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in scores], pa.binary())], names=["y", "x", "scores"])

    kinds = "y int, x binary, scores binary"
    parts = int(-(-sizes.sum() // ROWS))  # a task's rows are worth more than its histograms
    data = checkpointed(df.select(F.col(label).cast("string"), *(F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features))).mapInArrow(prepared, kinds).coalesce(parts))

    def opened(b: pa.RecordBatch, pending: list[list[Tree]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, n_features)
        scores = np.frombuffer(b"".join(b.column(2).to_pylist())).reshape(-1, k).copy()
        return b.column(0).to_numpy(), x, model.add(scores, x, pending)

    def level(pending: list[list[Tree]], trees: list[Tree], at: int) -> list:
        """The best split of each (class, node) of a level."""
        nodes = 1 << at

        def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k, nodes * n_features * width, 2))
            seen = False
            for b in batches:
                if not b.num_rows:
                    continue
                seen = True
                y, x, scores = opened(b, pending)
                g, h = gradients(scores, y)
                place = np.where(x == MISSING, width - 1, x).astype(np.int64) + np.arange(n_features) * width
                for c, t in enumerate(trees):
                    at_ = (place + (t.nodes(x, at) * (n_features * width))[:, None]).ravel()
                    for i, w in enumerate((g[:, c], h[:, c])):
                        total[c, :, i] += np.bincount(at_, np.repeat(w, n_features), minlength=nodes * n_features * width)
            if seen:
                parts = total.reshape(k, nodes, -1)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k), nodes), pa.int32()), pa.array(np.tile(np.arange(nodes), k), pa.int32()), pa.array([parts[c, n].tobytes() for c in range(k) for n in range(nodes)], pa.binary())], names=["c", "n", "h"])

        def splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int], np.ndarray] = {}
            for b in batches:
                for c, n, h in zip(*(x.to_pylist() for x in b.columns), strict=True):
                    held[c, n] = held.get((c, n), 0.0) + np.frombuffer(h)
            if held:
                found = [(*key, *best_split(h.reshape(n_features, width, 2), least, l2)) for key, h in held.items()]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found, strict=True)], names=["c", "n", "f", "cut", "left", "gl", "hl", "gr", "hr"])

        return data.mapInArrow(histograms, "c int, n int, h binary").repartition(min(parts, k * nodes), "c", "n").mapInArrow(splits, "c long, n long, f long, cut long, left boolean, gl double, hl double, gr double, hr double").collect()

    pending: list[list[Tree]] = []
    for r in range(rounds):
        trees = [Tree.empty(depth) for _ in range(k)]
        for at in range(depth):
            if at and all((t.feature[(1 << at - 1) - 1 : (1 << at) - 1] < 0).all() for t in trees):
                break  # no node of the level above was split
            for s in level(pending, trees, at):
                t, place = trees[s.c], (1 << at) - 1 + s.n
                t.feature[place], t.cut[place], t.missing_left[place] = s.f, s.cut, s.left
                # Each side's rows end, if nothing below splits them, in the leaf furthest left below it.
                for side, (g, h) in enumerate(((s.gl, s.hl), (s.gr, s.hr))):
                    t.value[(2 * s.n + side) << (depth - at - 1)] = -rate * g / (h + l2)
        model.rounds.append(trees)
        pending.append(trees)
        if len(pending) == every and r + 1 < rounds:
            done = list(pending)

            def scored(batches: Iterator[pa.RecordBatch], done: list[list[Tree]] = done) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    if b.num_rows:
                        scores = opened(b, done)[2]
                        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x.tobytes() for x in scores], pa.binary())], names=["y", "x", "scores"])

            data, pending = checkpointed(data.mapInArrow(scored, kinds)), []
    return model


def accuracy(model: BoostedTrees, df: DataFrame, label: str) -> float:
    """Share of rows whose class the model names; a class that it has not seen is never right. NaN without rows or classes."""
    rows = df.where(F.col(label).isNotNull()).withColumn("_label", F.col(label).cast("string"))
    if not model.classes:
        return float("nan")
    got = model.predicted(rows, ["_label"]).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_label") == F.col("predicted")).alias("right")).first()
    return got.right / got.n if got.n else float("nan")
