"""Windows over sorted rows whose statistics move on from row to row instead of being made anew.

Spark deals, sorts and streams the rows of each key (or each block of a key's time with the rows before it); a task holds one piece of a
run and what its windows reach back to. Quantiles come from a sorted ring with insertions and deletions, sums from
differences of extended-precision prefix sums, minima and maxima by doubling.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import fresh, micros

#: Given times (microseconds) and columns as floats (NaN for missing), the new columns of these rows; a "keep" among them says which rows stay.
Compute = Callable[[np.ndarray, list[np.ndarray]], dict[str, np.ndarray]]
PIECE = 100_000


def over_runs(df: DataFrame, values: list[str], compute: Compute, out: dict[str, str], key: str = "machine_id", ts: str = "timestamp", behind: int | str = 0, ahead: int = 0, block: str | None = None, halo: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, by default) with those that ``compute`` makes of each key's rows in order of time.

    ``out`` names the new columns and their types (double, boolean). ``behind`` is how far windows reach back, in rows or as a
    span of time, and ``ahead`` how many rows they reach on. With ``block``, a key's time is cut into blocks that are runs of their
    own, each with the rows of ``halo`` before it, and the number of tasks follows the data; windows by rows then need a
    regular grid. Rows without a time come before all others of their key, in a block of their own. NULL keys are one key.
    """
    from millrace.operators.series import micros_of

    keep = df.columns if keep is None else keep
    if set(out) & set(keep):
        raise ValueError(f"{sorted(set(out) & set(keep))} are columns of the table and of the result")
    span = micros_of(behind) if isinstance(behind, str) else None
    timed = df.schema[ts].dataType.typeName().startswith("timestamp")
    k, number, own, at, *inner = fresh(df.select(*keep), "_k", "_block", "_own", "_at", *(f"_v{i}" for i in range(len(values))))
    time = micros(ts) if timed else F.col(ts).cast("long")
    d = df.select(*(F.col(f"`{c}`") for c in keep), F.col(key).alias(k), time.alias(at), *(F.col(f"`{v}`").cast("double").alias(i) for v, i in zip(values, inner, strict=True)))
    if block:
        home, reach = F.floor(F.col(at) / micros_of(block)), F.floor((F.col(at) + micros_of(halo or "0 second")) / micros_of(block))
        d = d.withColumn(number, F.explode(F.coalesce(F.sequence(home, reach), F.array(F.lit(None).cast("long"))))).withColumn(own, home.eqNullSafe(F.col(number)))
        d = d.repartition(k, number)
    else:
        d = d.withColumn(number, F.lit(0).cast("long")).withColumn(own, F.lit(True)).repartition(k)
    d = d.sortWithinPartitions(k, number, at).select(*keep, k, number, own, at, *inner)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the run at hand, the first ``done`` of which have been given out
        done = rows = 0

        def given(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, done, rows
            b = pa.concat_batches(held)
            t = b.column(n + 3).fill_null(-(1 << 62)).to_numpy(zero_copy_only=False).astype(np.int64)
            made = compute(t, [c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns[n + 4 :]])
            end = len(t) if last else len(t) - ahead
            if span is not None and not last:
                end = min(end, int(np.searchsorted(t, t[-1], "left")))  # rows of one time see one another
            if end > done:
                use = b.column(n + 2).to_numpy(zero_copy_only=False)[done:end].astype(bool)
                if "keep" in made:
                    use &= made["keep"][done:end]
                part = b.slice(done, end - done)
                cols = [_arrow(made[c][done:end], kind) for c, kind in out.items()]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *cols], names=[*keep, *out]).filter(pa.array(use))
            start = max(0, end - behind) if span is None else int(np.searchsorted(t, t[end - 1] - span, "right")) if end else 0
            start = min(start, end)
            held, done, rows = [b.slice(start)], end - start, len(t) - start

        last_of = None
        for b in batches:
            if not b.num_rows:
                continue
            keys, blocks = b.column(n).to_numpy(zero_copy_only=False), b.column(n + 1).fill_null(-(1 << 62)).to_numpy(zero_copy_only=False)
            new = np.r_[True, (keys[1:] != keys[:-1]) | (blocks[1:] != blocks[:-1])]
            new[0] = last_of is not None and (keys[0] != last_of[0] or blocks[0] != last_of[1])
            edges = [0, *np.flatnonzero(new).tolist(), b.num_rows]
            for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
                if i and held:
                    yield from given(True)
                    held, done, rows = [], 0, 0
                if hi > lo:
                    held.append(b.slice(lo, hi - lo))
                    rows += hi - lo
                if rows - done > PIECE:
                    yield from given(False)
            last_of = keys[-1], blocks[-1]
        if held:
            yield from given(True)

    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + [f"`{c}` {kind}" for c, kind in out.items()]
    return d.mapInArrow(run, ", ".join(kinds))


def _arrow(x: np.ndarray, kind: str) -> pa.Array:
    if kind == "boolean":
        return pa.array(x.astype(bool))
    return pa.array(x, pa.float64(), mask=np.isnan(x))


def last_rows(n: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds [lo, hi) of the last ``rows`` rows at each of n rows."""
    hi = np.arange(1, n + 1)
    return np.maximum(hi - rows, 0), hi


def centred(n: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(n)
    return np.maximum(at - half, 0), np.minimum(at + half + 1, n)


def last_span(t: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the rows in (t - span, t], those of equal time included."""
    return np.searchsorted(t, t - span, "right"), np.searchsorted(t, t, "right")


def quantiles(v: np.ndarray, lo: np.ndarray, hi: np.ndarray, q: float = 0.5, least: int = 1) -> np.ndarray:
    """The interpolated quantile of v[lo:hi] at each row, NaN left out; NaN below ``least`` values. Bounds never fall."""
    ring: list[float] = []
    out = np.full(len(lo), np.nan)
    a = b = 0
    values = v.tolist()
    missing = np.isnan(v).tolist()
    for i, (x, y) in enumerate(zip(lo.tolist(), hi.tolist(), strict=True)):
        while b < y:
            if not missing[b]:
                insort(ring, values[b])
            b += 1
        while a < x:
            if not missing[a]:
                del ring[bisect_left(ring, values[a])]
            a += 1
        if len(ring) >= least and ring:
            place = q * (len(ring) - 1)
            low, high = floor(place), ceil(place)
            out[i] = ring[low] if low == high else (high - place) * ring[low] + (place - low) * ring[high]
    return out


def _sums(x: np.ndarray) -> np.ndarray:
    return np.r_[np.longdouble(0), np.cumsum(x, dtype=np.longdouble)]


class Frames:
    """Statistics of v[lo:hi] at each row, NaN left out, by differences of prefix sums."""

    def __init__(self, v: np.ndarray):
        self.v, self.there = v, ~np.isnan(v)
        some = v[self.there]
        self.centre = float(some.mean()) if len(some) else 0.0
        x = np.where(self.there, v, self.centre).astype(np.longdouble) - np.longdouble(self.centre)
        place = np.where(self.there, np.arange(len(v)) - len(v) / 2, 0).astype(np.longdouble)
        self.n = np.r_[0, np.cumsum(self.there)]
        self.s, self.ss, self.p, self.pp, self.ps = _sums(x), _sums(x * x), _sums(place), _sums(place * place), _sums(place * x)

    def count(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return self.n[hi] - self.n[lo]

    def stats(self, rows: int, wanted: tuple[str, ...], least: int) -> dict[str, np.ndarray]:
        """mean, std, min, max and slope over the last ``rows`` rows; NaN below ``least`` values."""
        lo, hi = last_rows(len(self.v), rows)
        n = self.count(lo, hi)
        few = n < least
        m = np.maximum(n, 1).astype(np.longdouble)
        s = self.s[hi] - self.s[lo]
        out: dict[str, np.ndarray] = {}
        low, high = extremes(self.v, rows)
        flat = low == high  # sums of equal values may differ in their last digit
        if "mean" in wanted:
            out["mean"] = np.where(flat, low, (s / m).astype(float) + self.centre)
        if "std" in wanted:
            spread = np.maximum(self.ss[hi] - self.ss[lo] - s * s / m, 0)
            out["std"] = np.where(n < 2, np.nan, np.where(flat, 0.0, np.sqrt(spread / np.maximum(m - 1, 1)).astype(float)))
        if "min" in wanted:
            out["min"] = low
        if "max" in wanted:
            out["max"] = high
        if "slope" in wanted:
            p = self.p[hi] - self.p[lo]
            wide = self.pp[hi] - self.pp[lo] - p * p / m
            with np.errstate(divide="ignore", invalid="ignore"):
                slope = ((self.ps[hi] - self.ps[lo] - p * s / m) / wide).astype(float)
            out["slope"] = np.where(n < 2, np.nan, np.where(flat, 0.0, slope))
        return {k: np.where(few, np.nan, x) for k, x in out.items()}


def extremes(v: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest of the last ``rows`` rows, NaN without any."""
    out = []
    for sign in (1.0, -1.0):
        x = np.where(np.isnan(v), np.inf, sign * v)
        x = np.r_[np.full(rows - 1, np.inf), x]
        span = 1
        while span < rows:
            step = min(span, rows - span)
            x = np.minimum(x[:-step], x[step:])
            span += step
        out.append(np.where(np.isinf(x), np.nan, sign * x))
    return out[0], out[1]


def held(flag: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Whether the flag is set in all of [lo, hi)."""
    n = np.r_[0, np.cumsum(~flag)]
    return n[hi] == n[lo]


def lagged(v: np.ndarray, rows: int) -> np.ndarray:
    return np.r_[np.full(min(rows, len(v)), np.nan), v[: max(0, len(v) - rows)]]


def flag_held(df: DataFrame, flag: Column, span: str, out: str, key: str = "machine_id", ts: str = "timestamp", block: str | None = None) -> DataFrame:
    """``df`` with whether the flag holds in all rows of (t - span, t]; NULL counts as not."""
    from millrace.operators.series import micros_of

    (on,) = fresh(df, "_on")
    size = micros_of(span)
    compute = lambda t, v: {out: held(v[0] == 1.0, *last_span(t, size))}
    base = df.drop(out) if out in df.columns else df
    return over_runs(base.withColumn(on, F.coalesce(flag, F.lit(False)).cast("double")), [on], compute, {out: "boolean"}, key, ts, span, 0, block, span, base.columns)
