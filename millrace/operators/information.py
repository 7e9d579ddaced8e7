"""Mutual information of a label and a number by nearest neighbours (Ross, 2014), without a sort of all rows in one place.

Rows of one label and value count as one with a number. Values are cut into ranges at a bounded number of quantiles; what
crosses a range's border, the k values next to it of each label and the rows before it, is bounded by ranges x labels x k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import place_among


def digamma(n: np.ndarray) -> np.ndarray:
    """For whole numbers from 1: by recurrence up to 10, then the asymptotic series."""
    x = np.asarray(n, float).copy()
    out = np.zeros_like(x)
    for _ in range(10):
        low = x < 10
        out[low] -= 1 / x[low]
        x[low] += 1
    y = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def kth_distances(v: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """Distance of each of the ascending distinct values, of which there are n rows each, to its k-th neighbour (infinite if there are fewer)."""
    flat = np.repeat(v, np.minimum(n, k + 1))  # more of one value change nothing
    at = np.searchsorted(flat, v, "left")
    best = np.full(len(v), np.inf)
    for left in range(k + 1):
        lo, hi = at - left, at + k - left
        ok = (lo >= 0) & (hi < len(flat))
        lo, hi = lo[ok], hi[ok]
        best[ok] = np.minimum(best[ok], np.maximum(v[ok] - flat[lo], flat[hi] - v[ok]))
    # The row itself may be any of its equals.
    return np.where(n > k, 0.0, best)


def neighbour_information(df: DataFrame, group: str, col: str, k: int = 3, parts: int | None = None) -> DataFrame:
    """One row: mutual information in nats, at least 0; NULL without rows that count.

    A row counts with its label's k-th neighbour (or the furthest, of a label with fewer rows) and the number of all rows nearer
    than that, itself included (equal values, where that distance is 0). Rows without label or value are left out, and so are the
    neighbours of a row that is the only one of its label.
    """
    spark = df.sparkSession
    parts = parts or min(1000, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = df.where(F.col(group).isNotNull() & F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))).select(F.col(group).cast("string").alias("g"), F.col(col).cast("double").alias("x"))
    sizes = {r.g: r.n for r in rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = [g for g, n in sizes.items() if n > 1]
    if not labels:
        return spark.createDataFrame([(None,)], "mi double")
    rows = rows.where(F.col("g").isin(labels))
    cuts = sorted(set(rows.agg(F.percentile_approx("x", [i / parts for i in range(1, parts)], 10_000)).first()[0] or [])) if parts > 1 else []
    values = rows.groupBy("g", "x").agg(F.count(F.lit(1)).alias("n")).withColumn("part", place_among(F.col("x"), cuts))
    dealt = values.repartition("g", "part").sortWithinPartitions("g", "part", "x").select("g", "part", "x", "n")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
        """The (label, range) groups of a sorted stream; a range of distinct values is what a task of a sort holds."""
        held: list = []
        for b in batches:
            for g, p, x, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and held[0][:2] != (g, p):
                    yield *held[0][:2], np.array([r[2] for r in held]), np.array([r[3] for r in held])
                    held = []
                held.append((g, p, x, n))
        if held:
            yield *held[0][:2], np.array([r[2] for r in held]), np.array([r[3] for r in held])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, p, x, n in runs(batches):
            some = np.unique(np.r_[np.arange(min(k, len(x))), np.arange(max(0, len(x) - k), len(x))])
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(some)), pa.array([p] * len(some), pa.int32()), pa.array(x[some]), pa.array(n[some], pa.int64())], names=["g", "part", "x", "n"])

    border: dict[str, list[tuple[float, int, int]]] = {}
    for r in dealt.mapInArrow(ends, "g string, part int, x double, n long").collect():
        border.setdefault(r.g, []).append((r.x, r.n, r.part))
    for rows_ in border.values():
        rows_.sort()

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, p, x, n in runs(batches):
            before = [r for r in border[g] if r[2] < p][-k:]
            after = [r for r in border[g] if r[2] > p][:k]
            v = np.r_[[r[0] for r in before], x, [r[0] for r in after]]
            m = np.r_[[r[1] for r in before], n, [r[1] for r in after]].astype(np.int64)
            d = kth_distances(v, m, min(k, sizes[g] - 1))[len(before) : len(before) + len(x)]
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(x)), pa.array(x), pa.array(n, pa.int64()), pa.array(d)], names=["g", "x", "n", "d"])

    far = dealt.mapInArrow(distances, "g string, x double, n long, d double")
    # How many rows lie within d: rows before the upper end less rows before the lower one, each counted in the range that it falls in.
    asked = far.select("g", "x", "n", "d", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), (F.col("x") + s * F.col("d")).alias("q")) for s in (-1, 1)))).alias("e")).select("g", "x", "n", "d", "e.side", place_among(F.col("e.q"), cuts).alias("part"))
    there = values.groupBy("x", "part").agg(F.sum("n").alias("n"))
    before, total = {}, 0
    for r in there.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        before[r.part] = total
        total += r.n
    starts = np.array([before.get(p, None) if p in before else -1 for p in range(len(cuts) + 2)], np.int64)
    for p in range(len(starts) - 1, -1, -1):  # an empty range begins where the next one does
        if starts[p] < 0:
            starts[p] = starts[p + 1] if p + 1 < len(starts) else total
    both = asked.unionByName(there.withColumns({"g": F.lit(None).cast("string"), "d": F.lit(None).cast("double"), "side": F.lit(0)}))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, v, sums, held = None, np.zeros(0), np.zeros(1), []

        def answer() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            g, x, n, d, side = (np.array(c, t) for c, t in zip(zip(*held, strict=True), (object, float, np.int64, float, np.int64), strict=True))
            inside = lambda y: np.where(d == 0, y == x, np.abs(y - x) < d)
            at = np.searchsorted(v, x + side * d, "left")
            for _ in range(2):  # the sum may have been rounded past a neighbouring value
                if len(v):
                    here, back = v[np.minimum(at, len(v) - 1)], v[np.maximum(at - 1, 0)]
                    up = (at < len(v)) & np.where(side > 0, inside(here), ~inside(here) & (here < x))
                    down = (at > 0) & ~up & np.where(side > 0, ~inside(back) & (back > x), inside(back))
                    at = at + up - down
            m = side * (starts[part] + sums[at])
            yield pa.RecordBatch.from_arrays([pa.array(g.tolist(), pa.string()), pa.array(x), pa.array(n), pa.array(m.astype(np.int64))], names=["g", "x", "n", "m"])

        for b in batches:
            for p, side, x, n, g, d in zip(*(b.column(c).to_pylist() for c in ("part", "side", "x", "n", "g", "d")), strict=True):
                if p != part:
                    yield from answer()
                    part, held, fresh = p, [], ([], [])
                    v, sums = np.zeros(0), np.zeros(1)
                if side == 0:
                    fresh[0].append(x)
                    fresh[1].append(n)
                    continue
                if fresh[0]:
                    v, sums, fresh = np.array(fresh[0]), np.r_[0, np.cumsum(fresh[1])], ([], [])
                held.append((g, x, n, d, side))
                if len(held) > 50_000:
                    yield from answer()
                    held.clear()
        yield from answer()

    sides = both.repartition("part").sortWithinPartitions("part", F.col("side") != 0, "x").select("part", "side", "x", "n", "g", "d")
    m = sides.mapInArrow(counted, "g string, x double, n long, m long").groupBy("g", "x").agg(F.max("n").alias("n"), F.sum("m").alias("m"))
    per = m.groupBy("g", "m").agg(F.sum("n").alias("n"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g, n = b.column(0).to_pylist(), b.column(2).to_numpy()
            size = np.array([sizes[x] for x in g], float)
            t = n * (digamma(np.minimum(k, size - 1)) - digamma(size) - digamma(b.column(1).to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array([float(t.sum())]), pa.array([int(n.sum())], pa.int64())], names=["t", "n"])

    one = per.mapInArrow(summed, "t double, n long").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    used = sum(sizes[g] for g in labels)
    return one.select(F.greatest(F.lit(0.0), F.lit(float(digamma(np.array([used]))[0])) + F.col("t") / F.col("n")).alias("mi"))
