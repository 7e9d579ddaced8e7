"""Column expressions shared by the operators. Missing values are NULL throughout; NaN is turned into NULL on entry."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it apart from the table's columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        out.append(n)
    return out


def place_among(value: Column, cuts: Column | list) -> Column:
    """How many of the ascending cuts are at most the value, by binary search; null counts as before all."""
    if isinstance(cuts, list):
        if not cuts:
            return F.lit(0)
        cuts = F.array(*(F.lit(c) for c in cuts))
    n = F.size(cuts)
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(16))))  # up to 65,535 cuts
    fits = lambda lo, p: (lo + p <= n) & (F.get(cuts, lo + p - 1) <= value)
    return F.aggregate(steps, F.lit(0), lambda lo, p: F.when(F.coalesce(fits(lo, p), F.lit(False)), lo + p).otherwise(lo))


def missing_if_nan(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def outside(c: str, lo: float, hi: float) -> Column:
    """Beyond the inclusive bounds; false for NULL."""
    return F.coalesce((F.col(c) < lo) | (F.col(c) > hi), F.lit(False))


def any_null(cols: list[str]) -> Column:
    return reduce(or_, (F.col(c).isNull() for c in cols))


def divided(a: Column, b: Column) -> Column:
    """NULL where the divisor is 0."""
    return a / F.nullif(b, F.lit(0.0))


def micros(c: str | Column) -> Column:
    """A timestamp (with or without zone) as microseconds; exact, so differences are exact too."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def hours_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(3.6e9)


def hour_start(c: str | Column) -> Column:
    """Begin of the hour, of the same type as the timestamp."""
    return F.window(c, "1 hour")["start"]


def hour_end(c: str | Column) -> Column:
    """The stamp of the hour that describes the minutes before it."""
    return F.window(c, "1 hour")["end"]


def kurtosis_from_moments(m1: Column, m2: Column, m3: Column, m4: Column) -> Column:
    """Excess kurtosis from raw moments, the variance held at 1e-12 at least."""
    variance = F.greatest(m2 - m1 * m1, F.lit(1e-12))
    fourth = m4 - 4 * m1 * m3 + 6 * m1 * m1 * m2 - 3 * F.pow(m1, F.lit(4.0))
    return fourth / (variance * variance) - 3


def correlation_from_moments(xy: Column, x: Column, y: Column, x2: Column, y2: Column) -> Column:
    """Pearson correlation from means, each variance held at 1e-12 at least."""
    return (xy - x * y) / F.sqrt(F.greatest(x2 - x * x, F.lit(1e-12)) * F.greatest(y2 - y * y, F.lit(1e-12)))


def crest(peak: Column, mean_square: Column) -> Column:
    return divided(peak, F.sqrt(mean_square))


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    angle = value * (2 * 3.141592653589793 / period)
    return F.sin(angle), F.cos(angle)
