"""Operators on regular and irregular series of many keys.

All window work is partitioned by key. ``blocked`` splits long histories of few keys into blocks of time
that carry a halo of earlier rows, so that the number of tasks follows the data and not the number of keys.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import divided, fresh, micros, outside
from millrace.operators import sliding


def reindex_grid(df: DataFrame, step: str = "1 minute", key: str = "machine_id", ts: str = "timestamp", flag: str = "was_missing_row") -> DataFrame:
    """A row for each step between a key's first and last timestamp; ``flag`` marks the added ones.

    The grid starts at each key's first timestamp; rows off it are left out, and so are rows without a key or a time, which
    have no place on any grid. Steps are made day by day, so that no array holds a whole history.
    """
    df = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    size = micros_of(step)
    a_day = max(1, 86_400_000_000 // size)  # steps in a chunk
    shift = lambda n: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (n * F.lit(size) / F.lit(1_000_000)).cast("decimal(18,6)"))
    ends = df.groupBy(key).agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    steps = F.floor((micros("hi") - micros("lo")) / size)
    chunks = ends.select(key, "lo", steps.alias("steps"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor(steps / a_day))).alias("chunk"))
    numbers = F.sequence(F.col("chunk") * a_day, F.least(F.col("steps"), (F.col("chunk") + 1) * a_day - 1))
    grid = chunks.select(key, "lo", F.explode(numbers).alias("i")).select(key, (F.col("lo") + shift(F.col("i"))).alias(ts))
    (there,) = fresh(df, "_there")
    marked = df.withColumn(there, F.lit(True))
    out = grid.join(marked, [key, ts], "left").withColumn(flag, F.col(there).isNull()).drop(there)
    return out.select(*df.columns, flag)


def micros_of(step: str) -> int:
    """Microseconds of '<n> <unit>'."""
    n, unit = step.split()
    return int(n) * {"microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 6 * 10**7, "hour": 36 * 10**8, "day": 864 * 10**8}[unit.rstrip("s")]


def steps_of(step: str, n: int) -> str:
    """n steps as '<n> <unit>'."""
    k, unit = step.split()
    return f"{int(k) * n} {unit}"


def invalidate(df: DataFrame, ranges: dict[str, list[float]], count: str = "n_invalid_sensors") -> DataFrame:
    """Values outside their inclusive range become NULL, never clipped; ``count`` says how many in the row."""
    bad = {c: outside(c, lo, hi) for c, (lo, hi) in ranges.items()}
    total = sum((b.cast("int") for b in bad.values()), F.lit(0)).cast("byte")
    return df.withColumns({count: total} | {c: F.when(~b, F.col(c)) for c, b in bad.items()})


def by_time(key: str, ts: str) -> Window:
    return Window.partitionBy(key).orderBy(ts)


def forward_fill(df: DataFrame, cols: list[str], limit: int, key: str = "machine_id", ts: str = "timestamp", flag: str = "was_imputed") -> DataFrame:
    """The last value of at most ``limit`` rows before, where a value is missing; ``flag`` marks rows that got any."""
    w = by_time(key, ts).rowsBetween(-limit, 0)
    temp = dict(zip(cols, fresh(df, *(f"_f_{c}" for c in cols)), strict=True))
    filled = df.withColumns({t: F.last(c, ignorenulls=True).over(w) for c, t in temp.items()})
    got = F.lit(False)
    for c, t in temp.items():
        got = got | (F.col(c).isNull() & F.col(t).isNotNull())
    return filled.withColumn(flag, got).withColumns({c: F.col(t) for c, t in temp.items()}).drop(*temp.values())


def interpolate_both(df: DataFrame, col: str, limit: int | None, key: str = "machine_id", ts: str = "timestamp", out: str = "interpolated", both: bool = True) -> DataFrame:
    """Linear by rows between neighbours, for the ``limit`` rows nearest to either (all, if None); ends take the nearest value.

    Without ``both``, rows before the first value stay missing. Not causal: for exploration only.
    """
    w = by_time(key, ts)
    n, p, q, i, j = fresh(df, "_n", "_p", "_q", "_i", "_j")
    d = df.withColumn(n, F.row_number().over(w))
    before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col(col).isNotNull(), F.col(n))
    d = d.withColumns({p: F.last(col, True).over(before), q: F.first(col, True).over(after), i: F.last(at, True).over(before), j: F.first(at, True).over(after)})
    near = F.lit(True) if limit is None else ((F.col(n) - F.col(i)) <= limit) | ((F.col(j) - F.col(n)) <= limit)
    line = F.col(p) + (F.col(q) - F.col(p)) * (F.col(n) - F.col(i)) / F.nullif(F.col(j) - F.col(i), F.lit(0))
    value = F.when(F.col(col).isNotNull(), F.col(col)).when(near, F.coalesce(line, F.col(p), F.col(q) if both else F.lit(None)))
    return d.withColumn(out, value).drop(n, p, q, i, j)


def trailing_median(df: DataFrame, col: str, rows: int = 15, least: int | None = None, key: str = "machine_id", ts: str = "timestamp", out: str = "rolling_median", block: str | None = None) -> DataFrame:
    """The median of the last ``rows`` rows; NULL below ``least`` values (by default all of them must be there).

    With ``block`` (for regular grids of a minute or more) a key's history is many tasks.
    """
    enough = rows if least is None else least
    compute = lambda t, v: {out: sliding.quantiles(v[0], *sliding.last_rows(len(t), rows), least=enough)}
    return sliding.over_runs(df, [col], compute, {out: "double"}, key, ts, behind=rows, block=block, halo=f"{rows} hour")


STATS = ("mean", "std", "min", "max", "slope")


def with_rolling_and_lags(df: DataFrame, roll: list[str], lag: list[str], windows: list[int], steps: list[int], key: str = "machine_id", ts: str = "timestamp", block: str | None = None, step: str = "1 hour") -> DataFrame:
    """Statistics over the last w rows (NULL below max(2, w // 2) values), values some rows before and changes since.

    One shuffle and one sort for all columns. With ``block`` (for rows of each ``step``) a key's history is many tasks.
    """
    cols = list(dict.fromkeys([*roll, *lag]))
    out = {f"{c}_roll{w}h_{s}": "double" for c in roll for w in windows for s in STATS} | {f"{c}_{k}{n}h": "double" for c in lag for n in steps for k in ("lag", "diff")}

    def compute(t: np.ndarray, values: list[np.ndarray]) -> dict[str, np.ndarray]:
        by_name, made = dict(zip(cols, values, strict=True)), {}
        for c in roll:
            frames = sliding.Frames(by_name[c])
            for w in windows:
                made |= {f"{c}_roll{w}h_{s}": x for s, x in frames.stats(w, STATS, max(2, w // 2)).items()}
        for c in lag:
            for n in steps:
                before = sliding.lagged(by_name[c], n)
                made |= {f"{c}_lag{n}h": before, f"{c}_diff{n}h": by_name[c] - before}
        return made

    reach = max([*windows, *steps], default=0)
    return sliding.over_runs(df, cols, compute, out, key, ts, behind=reach, block=block, halo=steps_of(step, reach))


def blocked(df: DataFrame, op: Callable[[DataFrame, str], DataFrame], block: str, halo: str, key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """Run a causal window operator over blocks of time, each with the rows of ``halo`` before it.

    ``op`` gets the rows and the name of the key to partition by, and keeps all their columns. The rows of the
    halo are given to it and taken out again; the result equals that over whole keys if no window reaches further back
    than the halo. Windows by rows reach as far as their rows do, so they need a regular grid. Rows without a time are a
    block of their own.
    """
    size, before = micros_of(block), micros_of(halo)
    home, number, part = fresh(df, "_home", "_block", "_part")
    at = F.floor(micros(ts) / size)
    reach = F.floor((micros(ts) + before) / size)
    d = df.withColumn(home, at).withColumn(number, F.explode(F.coalesce(F.sequence(at, reach), F.array(F.lit(None).cast("long"))))).withColumn(part, F.struct(key, number))
    return op(d, part).where(F.col(home).eqNullSafe(F.col(number))).drop(home, number, part)


def islands(df: DataFrame, state: Column, key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """(key, island, state, start, stop, n) for each stretch of rows of one state; NULL is a state of its own, unlike any neighbour."""
    w = by_time(key, ts)
    d = df.select(key, ts, state.alias("state"))
    change = F.coalesce(F.col("state") != F.lag("state").over(w), F.lit(True)).cast("int")
    d = d.withColumn("_c", change).withColumn("island", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(key, "island").agg(F.first("state").alias("state"), F.min(ts).alias("start"), F.max(ts).alias("stop"), F.count(F.lit(1)).alias("n"))


def longest_flat_run(df: DataFrame, col: str, key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """(key, longest_run) of equal neighbouring values; a missing value is a run of one."""
    return islands(df, F.col(col), key, ts).groupBy(key).agg(F.max("n").alias("longest_run"))


def isolated_share(df: DataFrame, mask: Column, key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """(key, n_flagged, isolated_share): share of flagged rows whose neighbours are not flagged."""
    w = by_time(key, ts)
    d = df.select(key, ts, F.coalesce(mask, F.lit(False)).cast("int").alias("m"))
    d = d.withColumn("alone", (F.col("m") == 1) & (F.lag("m", 1, 0).over(w) == 0) & (F.lead("m", 1, 0).over(w) == 0))
    return d.groupBy(key).agg(F.sum("m").alias("n_flagged"), divided(F.sum(F.col("alone").cast("double")), F.sum("m").cast("double")).alias("isolated_share"))


def hampel(df: DataFrame, col: str, window: int = 15, k: float = 5.0, least: int = 5, key: str = "machine_id", ts: str = "timestamp", out: str = "is_outlier") -> DataFrame:
    """Marks values further than k * 1.4826 * MAD from the centred rolling median. Not causal: for exploration only."""
    half = window // 2

    def compute(t: np.ndarray, values: list[np.ndarray]) -> dict[str, np.ndarray]:
        lo, hi = sliding.centred(len(t), half)
        apart = np.abs(values[0] - sliding.quantiles(values[0], lo, hi, least=least))
        scale = sliding.quantiles(apart, lo, hi, least=least) * 1.4826
        return {out: (scale != 0) & (apart > scale * k)}  # comparisons with NaN are false

    return sliding.over_runs(df, [col], compute, {out: "boolean"}, key, ts, behind=2 * half, ahead=2 * half)


#: Where an event stands among rows of its own time.
BEFORE, AFTER = 0, 2


def among_events(left: DataFrame, events: DataFrame, last: dict[str, str] | None = None, first: dict[str, str] | None = None, total: dict[str, str] | None = None, key: str = "machine_id", ts: str = "timestamp", block: str | None = None) -> DataFrame:
    """``left`` with what the events of its key say at each row's time, all in one union, one shuffle and a window sorted each way that is asked for.

    ``events`` has the key, ``at`` (microseconds), ``rank`` (BEFORE or AFTER rows of the same time) and value columns.
    last, first and total map new columns to value columns: the last value before the row, the first one
    after it, the sum of those before it (0 without any). Of values with one time the greatest counts as last and the least as first. Nothing
    is broadcast and no pairs are made, however many rows either side has. NULL keys have no events.

    With ``block``, each key's time is cut into blocks that are windows of their own: the last and first values and the
    sums that cross a border are found once a block, from the events alone, and stand at its ends as events.
    """
    last, first, total = last or {}, first or {}, total or {}
    values = [c for c in events.columns if c not in (key, "at", "rank")]
    k, at, rank, mine, number, whole = (f"__{x}" for x in ("key", "at", "rank", "mine", "block", "row"))
    e = events.select(F.col(key).alias(k), F.col("at").alias(at), F.col("rank").alias(rank), *(F.col(c).alias(f"__v_{c}") for c in values)).where(f"{at} is not null and {k} is not null")
    rows = left.select(F.struct(*(F.col(f"`{c}`") for c in left.columns)).alias(whole), F.col(key).alias(k), micros(ts).alias(at), F.lit(1).alias(rank))

    def found(rows: DataFrame, e: DataFrame, by: list[str]) -> DataFrame:
        u = rows.withColumn(mine, F.lit(True)).unionByName(e.withColumn(mine, F.lit(False)), allowMissingColumns=True)
        order = [F.col(c) for c in (at, rank, *(f"__v_{c}" for c in values))]
        # What comes after a row is what comes before it in the opposite order: a frame up to the last row would be gone through anew for each row.
        past, future = (Window.partitionBy(*by).orderBy(*o).rowsBetween(Window.unboundedPreceding, -1) for o in (order, [c.desc() for c in order]))
        made = {n: F.last(f"__v_{c}", True).over(past) for n, c in last.items()} | {n: F.last(f"__v_{c}", True).over(future) for n, c in first.items()}
        made |= {n: F.coalesce(F.sum(f"__v_{c}").over(past), F.lit(0)) for n, c in total.items()}
        return u.select("*", *(x.alias(f"__n_{n}") for n, x in made.items())).where(mine)

    by = [k]
    if block:
        size = micros_of(block)
        rows, e = (x.withColumn(number, F.floor(F.col(at) / size)) for x in (rows, e))
        ends = rows.select(k, number).distinct().select(k, number, F.explode(F.array(F.lit(0), F.lit(1))).alias("__end"))
        ends = ends.select(k, number, "__end", ((F.col(number) + F.col("__end")) * size).alias(at), F.lit(-1).alias(rank))
        crossing = found(ends, e.drop(number), [k])
        carried = {n: (c, 0) for n, c in (last | total).items()} | {n: (c, 1) for n, c in first.items()}
        parts = [crossing.where(F.col("__end") == end).select(k, number, at, F.lit(-2 if end == 0 else -1).alias(rank), *(F.col(f"__n_{n}").alias(f"__v_{c}") for n, (c, x) in carried.items() if x == end)) for end in (0, 1)]
        e = e.unionByName(parts[0], allowMissingColumns=True).unionByName(parts[1], allowMissingColumns=True)
        by = [k, number]
    return found(rows, e, by).select(*(F.col(whole)[c].alias(c) for c in left.columns), *(F.col(f"__n_{n}").alias(n) for n in (*last, *first, *total)))


def as_of(left: DataFrame, right: DataFrame, value: str, key: str = "machine_id", ts: str = "timestamp", right_ts: str | None = None, out: str | None = None, exact: bool = True, forward: bool = False, block: str | None = None) -> DataFrame:
    """``left`` with the value of the nearest right row of its key, before (or after) it; equal times match if ``exact``."""
    out = out or value
    rank = BEFORE if exact != forward else AFTER
    e = right.select(F.col(key), micros(right_ts or ts).alias("at"), F.lit(rank).alias("rank"), F.col(value).alias("v"))
    return among_events(left.drop(out) if out in left.columns else left, e, **{"first" if forward else "last": {out: "v"}}, key=key, ts=ts, block=block)


def expiring(right: DataFrame, span: str, key: str, right_ts: str) -> DataFrame:
    """Events (at, rank, n) whose running sum at t is the number of rows in [t - span, t)."""
    b = right.select(key, micros(right_ts).alias("at"), F.lit(AFTER).alias("rank"))
    return b.withColumn("n", F.lit(1)).unionByName(b.withColumns({"at": F.col("at") + micros_of(span), "n": F.lit(-1)}))


def range_count(left: DataFrame, right: DataFrame, span: str, key: str = "machine_id", ts: str = "timestamp", right_ts: str = "timestamp", out: str = "n", block: str | None = None) -> DataFrame:
    """``left`` with the number of right rows of its key in [t - span, t): a difference of two running counts."""
    return among_events(left, expiring(right, span, key, right_ts), total={out: "n"}, key=key, ts=ts, block=block)


def inside_any(left: DataFrame, spans: DataFrame, start: str, stop: str, key: str = "machine_id", ts: str = "timestamp", out: str = "inside", block: str | None = None) -> DataFrame:
    """``left`` with whether its time lies in any span [start, stop) of its key; spans that end before they begin are none."""
    good = spans.where(F.col(start) < F.col(stop))
    ends = [good.select(key, micros(c).alias("at"), F.lit(BEFORE).alias("rank"), F.lit(n).alias("n")) for c, n in ((start, 1), (stop, -1))]
    (count,) = fresh(left, "_open")
    d = among_events(left, ends[0].unionByName(ends[1]), total={count: "n"}, key=key, ts=ts, block=block)
    return d.withColumn(out, F.col(count) > 0).drop(count)


def over_time(key: str, ts: str, span: str) -> Window:
    """The rows of (t - span, t] of a key, by time and not by rows."""
    return Window.partitionBy(key).orderBy(micros(ts)).rangeBetween(-(micros_of(span) - 1), 0)
