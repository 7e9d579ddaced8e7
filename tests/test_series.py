from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import series
from tests.make import frame, telemetry


@pytest.fixture(scope="module")
def ragged(spark):
    t = telemetry(days=1, step="1h")
    t.loc[[3, 4, 5, 6, 30], "pressure_bar"] = np.nan
    return frame(spark, t.drop(index=[10, 11, 40]))


def test_grid_adds_missing_steps(ragged):
    g = series.reindex_grid(ragged, "1 hour")
    assert g.count() == 48 and g.where("was_missing_row").count() == 3


def test_grid_leaves_out_rows_off_the_grid(spark):
    df = spark.sql("select 'a' machine_id, timestamp_ntz '2024-01-01 00:00:00' timestamp, 1.0D v union all select 'a', timestamp_ntz '2024-01-01 00:30:00', 2.0D union all select 'a', timestamp_ntz '2024-01-01 02:00:00', 3.0D")
    g = series.reindex_grid(df, "1 hour").orderBy("timestamp").collect()
    assert [(r.v, r.was_missing_row) for r in g] == [(1.0, False), (None, True), (3.0, False)]


def test_fill_stops_at_its_limit(ragged):
    f = series.forward_fill(ragged, ["pressure_bar"], 2).where("machine_id = 'HPU_01'").orderBy("timestamp").toPandas()
    assert f.pressure_bar[3:7].isna().tolist() == [False, False, True, True]
    assert f.pressure_bar[3] == f.pressure_bar[2] == f.pressure_bar[4]
    assert f.was_imputed.sum() == 2


def test_blocks_give_the_same_fill(ragged):
    g = series.reindex_grid(ragged, "1 hour")
    whole = series.forward_fill(g, ["pressure_bar"], 3)
    parts = series.blocked(g, lambda x, k: series.forward_fill(x, ["pressure_bar"], 3, key=k), "6 hour", "3 hour")
    assert parts.count() == whole.count() and parts.exceptAll(whole).count() == 0


def test_invalid_values_become_null_and_are_counted(spark):
    df = spark.createDataFrame([(560.0, -8.0), (100.0, 20.0), (None, 95.0)], "p double, t double")
    r = series.invalidate(df, {"p": [0, 350], "t": [10, 90]}).collect()
    assert [(x.p, x.t, x.n_invalid_sensors) for x in r] == [(None, None, 2), (100.0, 20.0, 0), (None, None, 1)]


def test_slope_of_a_line_is_its_slope(spark):
    df = spark.range(50).selectExpr("'a' machine_id", "timestamp_ntz '2024-01-01' + make_interval(0,0,0,0,cast(id as int)) timestamp", "3 + 0.5D * id y")
    s = series.with_rolling_and_lags(df, ["y"], ["y"], [10], [1]).orderBy("timestamp").toPandas()
    assert s.y_roll10h_slope[:4].isna().all() and np.allclose(s.y_roll10h_slope[4:], 0.5)
    assert np.allclose(s.y_diff1h[1:], 0.5) and s.y_lag1h.isna().sum() == 1


def test_rolling_equals_pandas(ragged):
    g = series.reindex_grid(ragged, "1 hour").where("machine_id = 'HPU_01'")
    got = series.with_rolling_and_lags(g, ["pressure_bar"], [], [6], []).orderBy("timestamp").toPandas()
    r = got.pressure_bar.rolling(6, min_periods=3)
    for k, v in (("mean", r.mean()), ("std", r.std()), ("min", r.min()), ("max", r.max())):
        np.testing.assert_allclose(got[f"pressure_bar_roll6h_{k}"].astype(float), v, rtol=1e-9)


def test_as_of_both_ways_equals_pandas(spark):
    rng = np.random.default_rng(1)
    at = lambda n: pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 200, n), unit="h")
    a = pd.DataFrame({"machine_id": rng.choice(["x", "y", "z"], 80), "timestamp": at(80), "i": np.arange(80)}).sort_values("timestamp")
    b = pd.DataFrame({"machine_id": rng.choice(["x", "y"], 30), "timestamp": at(30)}).drop_duplicates().sort_values("timestamp")
    for exact in (True, False):
        for forward in (True, False):
            got = series.as_of(frame(spark, a), frame(spark, b).withColumn("v", F.col("timestamp")), "v", exact=exact, forward=forward).toPandas().sort_values("i")
            want = pd.merge_asof(a, b.assign(v=b.timestamp), on="timestamp", by="machine_id", allow_exact_matches=exact, direction="forward" if forward else "backward").sort_values("i")
            assert (got.v.fillna(pd.Timestamp(0)).to_numpy() == want.v.fillna(pd.Timestamp(0)).to_numpy()).all(), (exact, forward)


def test_what_follows_a_row_takes_one_pass(spark):
    """A frame up to the last row is gone through anew for each row: time by the square of a key's rows."""
    rows = spark.range(40_000).selectExpr("'a' machine_id", "cast(timestamp_seconds(id) as timestamp_ntz) timestamp", "id")
    d = series.as_of(rows, rows.where("id % 1000 = 7").withColumn("stop", F.col("id")), "stop", forward=True)
    assert "unboundedfollowing" not in d._jdf.queryExecution().optimizedPlan().toString().lower()
    assert d.where("stop is distinct from if(id > 39007, null, id + pmod(7 - id, 1000))").isEmpty() and d.count() == 40_000


@pytest.mark.parametrize("block", [None, "10 hour"])
def test_events_of_one_time_on_both_sides_of_a_row(spark, block):
    rng = np.random.default_rng(3)
    rows = [("xyz"[i % 3], int(t)) for i, t in enumerate(rng.integers(0, 60, 70))]
    events = list({("xy"[i % 2], int(t), int(r), None if v % 4 == 0 else int(v), None if u % 3 == 0 else int(u)) for i, (t, r, v, u) in enumerate(zip(rng.integers(0, 60, 80), rng.choice([series.BEFORE, series.AFTER], 80), rng.integers(0, 20, 80), rng.integers(0, 20, 80), strict=True))})
    hours = lambda t: t * 3_600_000_000
    left = spark.createDataFrame([(k, i, t) for i, (k, t) in enumerate(rows)], "machine_id string, i int, t int").selectExpr("machine_id", "i", "cast(timestamp_seconds(t * 3600) as timestamp_ntz) timestamp")
    e = spark.createDataFrame([(k, hours(t), r, v, u) for k, t, r, v, u in events], "machine_id string, at long, rank int, v int, u int").withColumn("n", F.col("v"))
    got = series.among_events(left, e, last={"v_before": "v", "u_before": "u"}, first={"v_after": "v", "u_after": "u"}, total={"sum": "n"}, block=block)
    order = sorted(events, key=lambda x: (x[1], x[2], x[3] is not None, x[3] or 0, x[4] is not None, x[4] or 0))
    one = lambda xs: next((x for x in xs if x is not None), None)
    for r in got.collect():
        k, t = rows[r.i]
        past, future = ([x[3:] for x in order if x[0] == k and ((x[1], x[2]) < (t, 1)) == before] for before in (True, False))
        assert (r.v_before, r.u_before) == tuple(one(x[c] for x in reversed(past)) for c in (0, 1))
        assert (r.v_after, r.u_after) == tuple(one(x[c] for x in future) for c in (0, 1))
        assert r["sum"] == sum(x[0] or 0 for x in past)
    assert got.count() == 70


def test_range_count_bounds(spark):
    a = spark.sql("select 'm' machine_id, timestamp_ntz '2024-01-11' timestamp")
    b = spark.sql("select 'm' machine_id, explode(array(timestamp_ntz '2024-01-01', timestamp_ntz '2024-01-05', timestamp_ntz '2024-01-11', timestamp_ntz '2023-12-31 23:59:59')) timestamp")
    assert series.range_count(a, b, "10 day").first().n == 2  # t - span is in, t is out


def test_islands_runs_and_isolated(spark):
    v = [1.0, 1.0, None, None, 2.0, 2.0, 2.0, 1.0]
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate(v)], "machine_id string, timestamp int, v double")
    assert sorted(r.n for r in series.islands(df, F.col("v")).collect()) == [1, 1, 1, 2, 3]
    assert series.longest_flat_run(df, "v").first().longest_run == 3
    one = series.isolated_share(df, F.col("v") == 1).first()
    assert one.n_flagged == 3 and abs(one.isolated_share - 1 / 3) < 1e-12


def test_hampel_finds_the_spike(spark):
    rows = [("a", i, 100.0 if i == 20 else float(i % 3)) for i in range(40)]
    df = spark.createDataFrame(rows, "machine_id string, timestamp int, v double")
    assert [r.timestamp for r in series.hampel(df, "v").where("is_outlier").collect()] == [20]


def test_time_windows_are_open_on_the_left(spark):
    df = spark.range(6).selectExpr("'a' machine_id", "timestamp_ntz '2024-01-01' + make_interval(0,0,0,0,cast(id as int)) timestamp", "1.0D v")
    n = df.withColumn("n", F.count("v").over(series.over_time("machine_id", "timestamp", "3 hour"))).orderBy("timestamp")
    assert [r.n for r in n.collect()] == [1, 2, 3, 3, 3, 3]


def test_empty_table(spark, ragged):
    e = ragged.limit(0)
    g = series.reindex_grid(e, "1 hour")
    assert g.count() == 0 and series.forward_fill(g, ["pressure_bar"], 3).count() == 0 and series.islands(g, F.col("shift")).count() == 0
