"""Exploration: summaries, rank statistics, trajectories and label audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import divided, fresh, hours_between, micros, place_among
from millrace.operators.series import by_time, inside_any, interpolate_both, micros_of, reindex_grid


def counted(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    """(by.., col, n, before, total): each value's number of rows, the rows of its group with lesser values, and all of them.

    Values are counted first; the counts are summed in ranges of values, so no task sorts the values of a whole group. The
    ranges' borders are a bounded number of quantiles, a parameter of the plan, and change no result.
    """
    parts = min(1000, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n, before, total, part, sub = "__n", "__before", "__total", "__part", "__sum"
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias(n))
    cuts = df.agg(F.percentile_approx(col, [i / parts for i in range(1, parts)], 10_000)).first()[0]
    counts = counts.withColumn(part, place_among(F.col(col), sorted(set(cuts or []))))
    sums = counts.groupBy(*by, part).agg(F.sum(n).alias(sub))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    sums = sums.select(*by, part, F.coalesce(F.sum(sub).over(whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before), F.sum(sub).over(whole).alias(total))
    inside = F.coalesce(F.sum(n).over(Window.partitionBy(*by, part).orderBy(col).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    same = F.lit(True)
    left = counts.withColumn(sub, inside).alias("l")
    for c in [*by, part]:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return left.join(sums.alias("r"), same).select(*(F.col(f"l.{c}").alias(c) for c in [*by, col]), F.col(n), (F.col(before) + F.col(sub)).alias(before), F.col(total))


def percentiles(df: DataFrame, col: str, shares: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """(by.., a column a share): exact percentiles with linear interpolation, by ranks; groups without a value are absent."""
    by = by or []
    d = counted(df, col, by)
    out = []
    for name, share in shares.items():
        place = F.lit(share) * (F.col("__total") - 1)
        at = lambda k: F.max(F.when((F.col("__before") <= k) & (k < F.col("__before") + F.col("__n")), F.col(col).cast("double")))
        lo, hi, part = at(F.floor(place)), at(F.ceil(place)), F.max(place - F.floor(place))
        out.append((lo + (hi - lo) * part).alias(name))
    return d.groupBy(*by).agg(*out)


def medians(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """(by.., a median a column) by ranks, so that no task holds the values of a group; NULL where a group has none."""
    out = df.select(*by).distinct()
    for c in cols:
        same = F.lit(True)
        for b in by:
            same = same & F.col(f"l.{b}").eqNullSafe(F.col(f"r.{b}"))
        out = out.alias("l").join(percentiles(df, c, {"_m": 0.5}, by).alias("r"), same, "left").select("l.*", F.col("r._m").alias(c))
    return out


def describe(df: DataFrame, cols: list[str], shares: tuple[float, ...] = (0.01, 0.25, 0.5, 0.75, 0.99)) -> DataFrame:
    """(column, n, mean, std, min, max, percentiles.., skewness, kurtosis), the last two corrected for the sample's size.

    A column without any value has no row.
    """
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols))).alias("x")).select("x.*").where("v is not null")
    n, m2 = F.count("v").cast("double"), F.var_pop("v")
    skew = F.when((n > 2) & (m2 > 0), F.try_divide(F.skewness("v") * F.sqrt(n * (n - 1)), n - 2))
    kurt = F.when((n > 3) & (m2 > 0), F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.kurtosis("v") + 6))
    one = long.groupBy("column").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"), skew.alias("skewness"), kurt.alias("kurtosis"))
    names = {f"p{round(s * 100):02d}": s for s in shares}
    return one.join(percentiles(long, "v", names, ["column"]), "column").select("column", "n", "mean", "std", "min", "max", *names, "skewness", "kurtosis")


def average_rank(df: DataFrame, col: str, out: str = "rank") -> DataFrame:
    """``df`` with ranks from 1, ties sharing their mean; NULL has none."""
    v, r = fresh(df, "_v", "_r")
    ranked = counted(df.select(F.col(col).alias(v)), v, []).select(v, (F.col("__before") + (F.col("__n") + 1) / 2).alias(r))
    return df.join(ranked, F.col(col) == F.col(v), "left").select(*df.columns, F.col(r).alias(out))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: rank correlation over the rows that have both; NULL where a column does not vary or no row has both."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).alias("x"), F.col(y).alias("y"))
    d = average_rank(average_rank(d, "x", "a"), "y", "b")
    some = (F.var_pop("a") > 0) & (F.var_pop("b") > 0)
    return d.agg(F.when(some, F.try_divide(F.covar_pop("a", "b"), F.stddev_pop("a") * F.stddev_pop("b"))).alias("spearman"))


def spearman_matrix(df: DataFrame, cols: list[str], keys: list[str], by: list[str] | None = None) -> DataFrame:
    """(by.., x, y, n, spearman) for each two columns in each group: ranks among a column's values in the group, correlated over the rows with both.

    ``keys`` tell the rows of a group apart. All columns are ranked by one pass over (group, column, value), and a row's ranks
    come together by its keys. NULL where fewer than two rows have both or one does not vary; NULL groups are groups.
    """
    by = by or []
    if set(by) & set(keys):
        raise ValueError("a column cannot both group rows and tell them apart")
    groups, names = [f"_g{i}" for i in range(len(by))], [f"_c{i}" for i in range(len(cols))]
    ids = [f"_k{i}" for i in range(len(keys))]
    base = df.select(*(F.col(b).alias(g) for b, g in zip(by, groups, strict=True)), *(F.col(k).alias(i) for k, i in zip(keys, ids, strict=True)), *(F.col(c).cast("double").alias(n) for c, n in zip(cols, names, strict=True)))
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("c"), F.col(n).alias("v")) for n in names))).alias("x")
    long = base.select(*groups, *ids, each).select(*groups, *ids, F.col("x.c").alias("_col"), F.col("x.v").alias("_v")).where("_v is not null")
    ranks = counted(long, "_v", [*groups, "_col"]).withColumn("_r", F.col("__before") + (F.col("__n") + 1) / 2)
    same = F.lit(True)
    for c in [*groups, "_col", "_v"]:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    ranked = long.alias("l").join(ranks.alias("r"), same).select(*(F.col(f"l.{c}").alias(c) for c in [*groups, *ids, "_col"]), F.col("r._r").alias("_r"))
    wide = ranked.groupBy(*groups, *ids).pivot("_col", names).agg(F.first("_r"))
    pairs = [(i, j) for i in range(len(cols)) for j in range(i)]
    made = []
    for i, j in pairs:
        both = F.col(names[i]).isNotNull() & F.col(names[j]).isNotNull()
        x, y = (F.when(both, F.col(names[k])) for k in (i, j))
        r = F.when((F.var_pop(x) > 0) & (F.var_pop(y) > 0), F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))
        made.append(F.struct(F.lit(cols[i]).alias("x"), F.lit(cols[j]).alias("y"), F.count_if(both).alias("n"), r.alias("spearman")).alias(f"_p{i}_{j}"))
    one = wide.groupBy(*groups).agg(*made)
    return one.select(*(F.col(g).alias(b) for g, b in zip(groups, by, strict=True)), F.explode(F.array(*(F.col(f"_p{i}_{j}") for i, j in pairs))).alias("p")).select(*by, "p.*")


def kruskal(df: DataFrame, group: str, col: str) -> DataFrame:
    """One row: Kruskal-Wallis H with the correction for ties; NULL without rows or where all values are equal. Rows without a group are left out."""
    d = df.where(F.col(group).isNotNull() & F.col(col).isNotNull()).select(F.col(group).alias("g"), F.col(col).alias("v"))
    c = counted(d, "v", [])
    t, n = F.col("__n").cast("double"), F.col("__total").cast("double")
    ties = c.agg(F.max(n).alias("n"), F.sum(t * t * t - t).alias("ties"))
    ranks = c.select(F.col("v").alias("_v"), (F.col("__before") + (F.col("__n") + 1) / 2).alias("rank"))
    per = d.join(ranks, F.col("v") == F.col("_v")).groupBy("g").agg(F.sum("rank").alias("s"), F.count(F.lit(1)).alias("m"))
    sums = per.agg(F.sum(F.try_divide(F.col("s") * F.col("s"), F.col("m"))).alias("h"))
    one, n = sums.join(ties, F.lit(True)), F.col("n")
    h = F.try_divide(F.lit(12.0), n * (n + 1)) * F.col("h") - 3.0 * (n + 1)
    return one.select(F.try_divide(h, F.nullif(1 - F.try_divide(F.col("ties"), n * n * n - n), F.lit(0.0))).alias("h"))


def cliffs_delta(df: DataFrame, group: str, col: str, a: str, b: str) -> DataFrame:
    """One row: share of pairs where group a is greater less those where b is, from ranks, over all rows."""
    d = average_rank(df.where(F.col(group).isin(a, b) & F.col(col).isNotNull()).select(group, col), col)
    s = d.agg(F.sum(F.when(F.col(group) == a, F.col("rank"))).alias("r"), F.count_if(F.col(group) == a).cast("double").alias("m"), F.count_if(F.col(group) == b).cast("double").alias("n"))
    return s.select((divided(F.col("r") - F.col("m") * (F.col("m") + 1) / 2, F.col("m") * F.col("n")) * 2 - 1).alias("delta"))


def mutual_information(df: DataFrame, group: str, col: str, bins: int, lo: float, hi: float) -> DataFrame:
    """One row: mutual information in nats between a label and a value in equal bins; a binned estimate (``information`` has one by neighbours)."""
    if bins < 1 or not lo < hi:
        raise ValueError("there must be a bin, and lo must lie below hi")
    b = F.least(F.greatest(F.floor((F.col(col) - lo) / ((hi - lo) / bins)), F.lit(0)), F.lit(bins - 1))
    joint = df.where(F.col(col).isNotNull() & F.col(group).isNotNull()).groupBy(F.col(group).alias("g"), b.alias("b")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    g, v = Window.partitionBy("g"), Window.partitionBy("b")
    j = joint.withColumns({"ng": F.sum("n").over(g), "nb": F.sum("n").over(v)})
    total = joint.agg(F.sum("n").alias("all"))
    return j.join(total, F.lit(True)).agg(F.sum(F.col("n") / F.col("all") * F.log(F.col("n") * F.col("all") / (F.col("ng") * F.col("nb")))).alias("mi"))


def autocorrelation(df: DataFrame, col: str, most: int, key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """(key, lag, r) for lags 1..most: sums of products of centred values over the variance of the whole series; NULL where it does not vary."""
    d = df.where(F.col(col).isNotNull()).select(F.col(key).alias("k"), F.col(ts).alias("t"), F.col(col).alias("v"))
    d = d.withColumn("x", F.col("v") - F.avg("v").over(Window.partitionBy("k")))
    w = by_time("k", "t")
    d = d.select("k", "x", *(F.lag("x", n).over(w).alias(f"l{n}") for n in range(1, most + 1)))
    one = d.groupBy("k").agg(F.sum(F.col("x") * F.col("x")).alias("v"), F.array(*(F.sum(F.col("x") * F.col(f"l{n}")) for n in range(1, most + 1))).alias("s"))
    return one.select(F.col("k").alias(key), F.posexplode("s").alias("i", "p"), "v").select(key, (F.col("i") + 1).alias("lag"), divided(F.col("p"), F.col("v")).alias("r"))


def hourly_autocorrelation(df: DataFrame, col: str, most: int = 192, key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """(key, lag, r) of the hourly means, gaps filled by straight lines (and the last value after the last one)."""
    h = df.groupBy(F.col(key).alias("k"), F.window(ts, "1 hour")["start"].alias("t")).agg(F.avg(col).alias("v"))
    h = interpolate_both(reindex_grid(h, "1 hour", "k", "t"), "v", None, "k", "t", "v2", both=False)
    return autocorrelation(h, "v2", most, "k", "t").withColumnRenamed("k", key)


def health_state(df: DataFrame, failures: DataFrame, key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """``df`` with hours_to_failure and state for machines of one failure: its mode while degrading, post_failure, else healthy."""
    (first,) = fresh(df, "_f")
    f = failures.groupBy(key).agg(F.min_by(F.struct("failure_timestamp", "degradation_start_timestamp", "failure_mode"), "failure_timestamp").alias(first))
    d = df.join(f, key, "left")
    state = F.when(F.col(ts) >= F.col(f"{first}.failure_timestamp"), "post_failure").when(F.col(ts) >= F.col(f"{first}.degradation_start_timestamp"), F.col(f"{first}.failure_mode")).otherwise("healthy")
    return d.withColumn("hours_to_failure", hours_between(F.col(f"{first}.failure_timestamp"), F.col(ts))).withColumn("state", state).drop(first)


def trajectory(df: DataFrame, cols: list[str], mode: str = "failure_mode", hours: str = "hours_to_failure", step: int = 12) -> DataFrame:
    """(mode, days_before, medians): bins of ``step`` hours before the failure."""
    day = -F.ceil(F.col(hours) / step) * step / 24
    return medians(df.where(F.col(hours) > 0).withColumn("days_before", day), cols, [mode, "days_before"])


def resample(df: DataFrame, every: str, cols: list[str], how: str = "median", key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """(key, start, values) by periods counted from the midnight of the key's first day (so days and hours are the calendar's)."""
    fn = {"median": F.median, "mean": F.avg, "last": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts)))}[how]
    size = micros_of(every)
    if 86_400_000_000 % size == 0:
        start = F.window(ts, every)["start"]
        return df.groupBy(key, start.alias("start")).agg(*(fn(c).alias(c) for c in cols))
    (first,) = fresh(df, "_first")
    origin = df.groupBy(key).agg(F.date_trunc("day", F.min(ts)).cast(df.schema[ts].dataType).alias(first))
    number = F.floor((micros(ts) - micros(first)) / size)
    shift = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (number * F.lit(size) / F.lit(1_000_000)).cast("decimal(18,6)"))
    return df.join(origin, key).groupBy(key, (F.col(first) + shift).alias("start")).agg(*(fn(c).alias(c) for c in cols))


def healthy_running(df: DataFrame, failures: DataFrame, standby: str = "is_standby", after: str = "1 day", key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """The rows outside standby and outside all [degradation start, failure + a day) of their machine."""
    spans = failures.withColumn("_until", F.col("failure_timestamp") + F.expr(f"interval {after}"))
    (inside,) = fresh(df, "_inside")
    d = inside_any(df.where(~F.coalesce(F.col(standby), F.lit(False))), spans, "degradation_start_timestamp", "_until", key, ts, inside)
    return d.where(~F.col(inside)).drop(inside)


def drift(df: DataFrame, col: str, every: str = "7 day", key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """(start, median, min, max) over machines of their medians in each period; ``df`` holds the rows that count, as healthy_running gives them."""
    m = resample(df, every, [col], "median", key, ts)
    return m.groupBy("start").agg(F.median(col).alias("median"), F.min(col).alias("min"), F.max(col).alias("max"))


def reference_z(df: DataFrame, col: str, start: str, stop: str, key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """(key, day, z): daily medians against the machine's own median and deviation between two dates."""
    d = resample(df, "1 day", [col], "median", key, ts)
    at = lambda x: F.lit(x).cast(df.schema[ts].dataType)
    ref = df.where((F.col(ts) >= at(start)) & (F.col(ts) < at(stop)))
    ref = percentiles(ref, col, {"_m": 0.5}, [key]).join(ref.groupBy(key).agg(F.stddev_samp(col).alias("_s")), key)
    return d.join(ref, key).select(key, F.col("start").cast("date").alias("day"), divided(F.col(col) - F.col("_m"), F.col("_s")).alias("z"))


def normal_deviations(df: DataFrame, signals: list[str], until: str, key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """Adds z_<signal> and pct_<signal> against the machine's median by day type and hour before a date, vib_xy_delta and z_vib_xy_delta.

    Standby is outside the reference. There is neither a fallback nor a floor: cells that the reference lacks give NULL, and so does a
    deviation of 0. The two axes' difference is scaled by one deviation over all machines.
    """
    apart = F.col("vibration_x_g") - F.col("vibration_y_g")
    ref = df.where((F.col(ts) < F.lit(until).cast(df.schema[ts].dataType)) & ~F.coalesce(F.col("is_standby"), F.lit(False)))
    cells = ref.groupBy(key, "day_type", "hour").agg(*(e for s in signals for e in (F.median(s).alias(f"_m_{s}"), F.stddev_samp(s).alias(f"_s_{s}"))))
    d = df.join(cells, [key, "day_type", "hour"], "left").join(ref.agg(F.stddev_samp(apart).alias("_s_xy")), F.lit(True))
    new = {n: e for s in signals for n, e in ((f"z_{s}", divided(F.col(s) - F.col(f"_m_{s}"), F.col(f"_s_{s}"))), (f"pct_{s}", (divided(F.col(s), F.col(f"_m_{s}")) - 1) * 100))}
    new |= {"vib_xy_delta": apart, "z_vib_xy_delta": divided(apart, F.col("_s_xy"))}
    return d.withColumns(new).select(*df.columns, *new)


def identical_share(df: DataFrame, x: str, y: str, by: str) -> DataFrame:
    """(by, n, share_identical): share of rows where two columns are equal; a missing first one counts as equal."""
    same = F.col(x).isNull() | F.coalesce(F.col(x) == F.col(y), F.lit(False))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.avg(same.cast("double")).alias("share_identical"))


def standstill_days(df: DataFrame, value: float, cols: list[str], speed: str = "pump_rpm", key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """(day, n, machines, medians..) of the rows at an exact speed by day, and beside them the medians of the day that follows (next_<col>, over all rows)."""
    day = F.to_date(ts)
    at = df.where(F.col(speed) == value).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("machines"))
    days = at.select("day").unionByName(at.select(F.date_add("day", 1).alias("day"))).distinct()
    d = df.withColumn("_day", day).join(days.select(F.col("day").alias("_day")), "_day", "left_semi")
    by_day = medians(d, cols, ["_day"]).withColumnRenamed("_day", "day")
    following = by_day.select(F.date_sub("day", 1).alias("day"), *(F.col(c).alias(f"next_{c}") for c in cols))
    return at.join(by_day, "day").join(following, "day", "left")


def sampled(df: DataFrame, share: float, seed: int = 1, keys: list[str] | None = None) -> DataFrame:
    """About ``share`` of the rows, chosen by a hash of ``keys`` (all columns by default) and the seed, so the choice does not depend on how rows are dealt."""
    chosen = F.pmod(F.xxhash64(F.lit(seed), *(F.col(c) for c in keys or df.columns)), F.lit(1_000_000))
    return df.where(chosen < round(share * 1_000_000))


def _numbered(df: DataFrame, by: list[str], seed: int, keys: list[str] | None) -> tuple[DataFrame, DataFrame]:
    """(rows with _h, their hash, and _b, one of 4,096 ranges of hashes; (by.., _b, before, total): the rows of a group in lower ranges and in all)."""
    text = F.concat_ws("\x1f", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys or df.columns))
    d = df.withColumn("_h", F.sha2(text, 256)).withColumn("_b", F.substring("_h", 1, 3))
    n = d.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("_n").over(w.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return d, n.select(*by, "_b", before.alias("_before"), F.sum("_n").over(w).alias("_total"))


def _met(left: DataFrame, right: DataFrame, on: list[str], cols: list[str]) -> DataFrame:
    same = F.lit(True)
    for c in on:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return left.alias("l").join(right.alias("r"), same).select("l.*", *(F.col(f"r.{c}").alias(c) for c in cols))


def sampled_exactly(df: DataFrame, n: int, by: list[str] | None = None, seed: int = 1, keys: list[str] | None = None) -> DataFrame:
    """Exactly n rows of each group (all, where it has fewer): those of least SHA-256 of '<seed> 1F <keys> 1F ..', keys as text, NULL as ''.

    ``keys`` (all columns, by default) should tell rows apart; then the choice does not depend on how rows are dealt. Ranges of hashes are
    counted first, so only the rows of the range in which the n-th lies are sorted. NULL groups are groups.
    """
    by = by or []
    d, ranges = _numbered(df, by, seed, keys)
    d = _met(d, ranges.where(F.col("_before") < n), [*by, "_b"], ["_before"]).withColumn("_last", F.count(F.lit(1)).over(Window.partitionBy(*by, "_b")) + F.col("_before") > n)
    whole = d.where("not _last")
    part = d.where("_last").withColumn("_i", F.row_number().over(Window.partitionBy(*by, "_b").orderBy("_h"))).where(F.col("_i") + F.col("_before") <= n)
    return whole.select(*df.columns).unionByName(part.select(*df.columns))


def resampled_exactly(df: DataFrame, n: int, by: list[str] | None = None, seed: int = 1, keys: list[str] | None = None, draw: str = "draw") -> DataFrame:
    """n draws with replacement from each group, numbered from 1: draw i takes the row at place m modulo the group's size in the order of
    ``sampled_exactly``, m being the first 15 hexadecimal digits of the SHA-256 of '<seed>:<i>'.
    """
    by = by or []
    d, ranges = _numbered(df, by, seed, keys)
    d = _met(d, ranges, [*by, "_b"], ["_before"]).withColumn("_place", F.row_number().over(Window.partitionBy(*by, "_b").orderBy("_h")) + F.col("_before") - 1)
    draws = ranges.groupBy(*by).agg(F.max("_total").alias("_total")).withColumn(draw, F.explode(F.sequence(F.lit(1), F.lit(n))))
    m = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(draw).cast("string")), 256), 1, 15), 16, 10).cast("long")
    return _met(d, draws.withColumn("_place", m % F.col("_total")), [*by, "_place"], [draw]).select(*df.columns, draw)


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int, by: list[str] | None = None) -> DataFrame:
    """(by.., bin, n, density); values outside fall away."""
    by = by or []
    b = F.width_bucket(F.col(col), F.lit(lo), F.lit(hi), F.lit(bins))
    d = df.where((F.col(col) >= lo) & (F.col(col) < hi)).groupBy(*by, b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))
    return d.withColumn("density", F.col("n") / whole / ((hi - lo) / bins))


def crosstab(df: DataFrame, rows: list[str], column: str, values: list[str], aggregate: Column | None = None) -> DataFrame:
    """Counts (or an aggregate) of rows by columns, with the columns given so that no pass looks for them; absent cells are 0."""
    d = df.groupBy(*rows).pivot(column, values).agg(aggregate if aggregate is not None else F.count(F.lit(1)))
    return d.na.fill(0)


def top(df: DataFrame, n: int, by: Column, *ties: str) -> DataFrame:
    return df.orderBy(by.desc(), *ties).limit(n)


def label_consistency(left: DataFrame, right: DataFrame, key: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """Joined rows with a flag for each pair of columns, named by the left one: equal or not (two NULLs are equal)."""
    j = left.alias("l").join(right.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"))
    return j.select("l.*", *(F.col(f"l.{a}").eqNullSafe(F.col(f"r.{b}")).alias(f"{a}_matches") for a, b in pairs))


def rul_audit(df: DataFrame, given: str, built: str, sentinels: tuple[float, ...] = (0.0, 500.0)) -> DataFrame:
    """One row: median and greatest distance of a given remaining life from the built one, and shares at sentinel values."""
    d = df.select(F.abs(F.col(given) - F.col(built)).alias("gap"), F.col(given).alias("given"))
    one = d.agg(F.max("gap").alias("max_error"), *(F.avg((F.col("given") == s).cast("double")).alias(f"share_at_{int(s)}") for s in sentinels))
    return one.join(percentiles(d, "gap", {"median_error": 0.5}), F.lit(True), "left").select("median_error", *one.columns)


def maintenance_profile(actions: DataFrame, key: str = "machine_id") -> DataFrame:
    """(key, n_actions, n_reactive, n_preventive, reactive_ratio, cost, last_action, components)."""
    kind = F.col("action_type")
    return actions.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_actions"),
        F.count_if(kind == "Reactive").alias("n_reactive"),
        F.count_if(kind == "Preventive").alias("n_preventive"),
        divided(F.count_if(kind == "Reactive").cast("double"), F.count_if(kind == "Preventive").cast("double")).alias("reactive_ratio"),
        F.sum("cost_usd").alias("cost"),
        F.max("action_timestamp").alias("last_action"),
        F.array_join(F.array_sort(F.collect_set("component_replaced")), ", ").alias("components"),
    )
