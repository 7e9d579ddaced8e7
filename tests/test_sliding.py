"""Sliding windows against windows made anew for each row, over whole keys, pieces and blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import alarms, series, sliding


def rows(n=400, seed=2, keys=("a", "b", None)):
    r = np.random.default_rng(seed)
    out = []
    for k in keys:
        t = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), "min")
        v = np.where(r.random(n) < 0.15, np.nan, np.round(r.normal(0, 2, n), 1))
        v[40:60] = 1.5
        out += [(k, x.to_pydatetime(), None if np.isnan(y) else float(y), bool(z)) for x, y, z in zip(t, v, r.random(n) < 0.7, strict=True)]
    return out


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(rows(), "machine_id string, timestamp timestamp_ntz, v double, on boolean").repartition(5).persist()


def same(got, want, cols, tol=1e-9):
    a, b = (x.orderBy("machine_id", "timestamp").toPandas() for x in (got, want))
    assert len(a) == len(b)
    for c in cols:
        np.testing.assert_allclose(a[c].astype(float), b[c].astype(float), rtol=tol, atol=tol, err_msg=c)


@pytest.mark.parametrize("piece", [100_000, 50])
def test_rolling_statistics_and_lags(df, monkeypatch, piece):
    w = lambda n: Window.partitionBy("machine_id").orderBy("timestamp").rowsBetween(-(n - 1), 0)
    by = Window.partitionBy("machine_id").orderBy("timestamp")
    want = df.withColumn("_r", F.row_number().over(by).cast("double"))
    for n in (2, 7, 30):
        made = {"mean": F.avg("v"), "std": F.stddev_samp("v"), "min": F.min("v"), "max": F.max("v"), "slope": F.regr_slope("v", "_r")}
        want = want.withColumns({f"v_roll{n}h_{s}": F.when(F.count("v").over(w(n)) >= max(2, n // 2), e.over(w(n))) for s, e in made.items()})
    want = want.withColumns({"v_lag3h": F.lag("v", 3).over(by), "v_diff3h": F.col("v") - F.lag("v", 3).over(by)})
    monkeypatch.setattr(sliding, "PIECE", piece)
    got = series.with_rolling_and_lags(df, ["v"], ["v"], [2, 7, 30], [3])
    cols = [c for c in got.columns if "_roll" in c or "3h" in c]
    same(got, want, cols)
    same(series.with_rolling_and_lags(df, ["v"], ["v"], [2, 7, 30], [3], block="1 hour", step="1 minute"), want, cols)


def test_medians_by_rows_and_around(df):
    frame = lambda a, b: Window.partitionBy("machine_id").orderBy("timestamp").rowsBetween(a, b)
    want = df.withColumn("rolling_median", F.when(F.count("v").over(frame(-8, 0)) >= 4, F.percentile("v", 0.5).over(frame(-8, 0))))
    same(series.trailing_median(df, "v", 9, 4), want, ["rolling_median"])
    same(series.trailing_median(df, "v", 9, 4, block="1 hour"), want, ["rolling_median"])
    median = lambda c: F.when(F.count(c).over(frame(-3, 3)) >= 3, F.percentile(c, 0.5).over(frame(-3, 3)))
    want = df.withColumn("m", median("v")).withColumn("d", F.abs(F.col("v") - F.col("m"))).withColumn("s", F.nullif(median("d"), F.lit(0.0)) * 1.4826)
    want = want.withColumn("is_outlier", F.coalesce(F.col("d") > F.col("s") * 2.0, F.lit(False)))
    got = series.hampel(df, "v", window=7, k=2.0, least=3)
    same(got, want, ["is_outlier"])
    assert got.where("is_outlier").count() > 10


@pytest.mark.parametrize("q", [0.0, 0.25, 0.95, 1.0])
def test_quantiles(q):
    r = np.random.default_rng(7)
    v = np.where(r.random(500) < 0.3, np.nan, np.round(r.normal(size=500), 1))
    t = np.cumsum(r.integers(0, 4, 500))
    lo, hi = sliding.last_span(t, 9)
    got = sliding.quantiles(v, lo, hi, q, 2)
    for i in range(500):
        w = v[(t > t[i] - 9) & (t <= t[i])]
        w = w[~np.isnan(w)]
        assert np.isnan(got[i]) if len(w) < 2 else abs(got[i] - np.quantile(w, q)) < 1e-12


RULES = {"high": ("v", 1, 0.8, "median"), "low": ("v", -1, 0.8, "median"), "far": ("v", 1, 1.0, "absmean")}


def test_alarms_equal_windows_made_anew(df):
    size = 20 * 60 * 1_000_000
    w = Window.partitionBy("machine_id").orderBy(F.unix_micros(F.col("timestamp").cast("timestamp"))).rangeBetween(-(size - 1), 0)
    want = df
    for n, (c, sign, limit, how) in RULES.items():
        signal = F.abs(F.avg(c).over(w)) if how == "absmean" else F.percentile(c, 0.5).over(w) * sign
        want = want.withColumn(f"_{n}", F.coalesce(signal > limit, F.lit(False)).cast("int"))
    want = want.withColumns({n: (F.min(f"_{n}").over(w) == 1) & ~F.col("on") for n in RULES})
    want = want.withColumn("any_rule", F.col("high") | F.col("low") | F.col("far"))
    for block in (None, "2 hour"):
        got = alarms.rule_alarms(df, RULES, "20 minute", standby="on", block=block)
        same(got, want, [*RULES, "any_rule"])
    assert got.where("any_rule").count() > 5


def test_rows_without_key_or_time(spark):
    d = spark.sql("select * from values (cast(null as string), timestamp_ntz'2024-01-01 00:00:00', 1D), (null, timestamp_ntz'2024-01-01 00:02:00', 2D), ('a', null, 3D), ('a', timestamp_ntz'2024-01-01 00:00:00', 4D), ('a', timestamp_ntz'2024-01-01 00:02:00', null) t(machine_id, timestamp, v)")
    grid = series.reindex_grid(d)
    assert sorted((r.machine_id, r.timestamp.minute, r.v, r.was_missing_row) for r in grid.collect()) == [("a", 0, 4.0, False), ("a", 1, None, True), ("a", 2, None, False)]
    filled = series.blocked(d, lambda x, k: series.forward_fill(x, ["v"], 3, key=k), "1 day", "1 hour")
    assert filled.count() == 5 and sorted(r.v for r in filled.collect()) == [1.0, 2.0, 3.0, 4.0, 4.0]
    assert series.trailing_median(d, "v", 2, 1).count() == series.trailing_median(d, "v", 2, 1, block="1 hour").count() == 5
    assert series.trailing_median(d.limit(0), "v").count() == 0
    with pytest.raises(ValueError):
        series.trailing_median(d, "v", out="v")


def test_spans_of_short_units():
    assert series.micros_of("500 milliseconds") == 500_000 and series.micros_of("7 microseconds") == 7
