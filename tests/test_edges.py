"""Empty tables, nulls, ties, repeated rows and clashing names through the operators on series and the exploration."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.config import DEFAULTS
from millrace.operators import alarms, eda, quality, regime, series
from millrace.operators.baseline import RegimeBaseline
from tests.make import failures, frame, maintenance, telemetry

VALUES = "g string, x double, y double"


@pytest.fixture(scope="module")
def hourly(spark):
    return frame(spark, telemetry(days=3, step="1h")).persist()


def test_rank_statistics_without_variation(spark):
    none = spark.createDataFrame([], VALUES)
    flat = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 2.0), ("b", 1.0, 3.0), (None, None, None)], VALUES)
    for d in (none, flat):
        assert eda.spearman(d, "x", "y").first().spearman is None and eda.kruskal(d, "g", "x").first().h is None
    assert eda.cliffs_delta(none, "g", "x", "a", "b").first().delta is None and eda.cliffs_delta(flat, "g", "x", "a", "b").first().delta == 0
    assert eda.mutual_information(none, "g", "x", 4, 0.0, 4.0).first().mi is None
    assert eda.describe(none, ["x"]).isEmpty() and eda.describe(flat, ["x"]).first().p50 == 1.0
    assert eda.rul_audit(none, "x", "y").first().median_error is None and eda.rul_audit(flat, "x", "y").first().median_error == 1.0
    assert eda.histogram(none, "x", 0.0, 1.0, 4).isEmpty() and eda.percentiles(none, "x", {"m": 0.5}, ["g"]).isEmpty()


def test_percentiles_and_ranks_equal_pandas(spark):
    rng = np.random.default_rng(2)
    p = pd.DataFrame({"g": rng.choice(list("abc"), 500), "x": rng.integers(0, 40, 500).astype(float), "y": rng.normal(size=500)})
    p.loc[::7, "x"] = np.nan
    d = frame(spark, p).repartition(5)
    got = eda.percentiles(d, "x", {"lo": 0.01, "mid": 0.5, "hi": 0.99}, ["g"]).toPandas().set_index("g").sort_index()
    np.testing.assert_allclose(got[["lo", "mid", "hi"]].to_numpy(), p.groupby("g").x.quantile([0.01, 0.5, 0.99]).unstack().to_numpy())
    ranked = eda.average_rank(d.withColumn("_v", F.lit(1)).withColumn("__n", F.lit(2)), "x").toPandas()
    assert {"_v", "__n", "rank"} <= set(ranked.columns) and len(ranked) == 500
    np.testing.assert_allclose(ranked["rank"].sort_values().dropna(), p.x.rank().sort_values().dropna())
    np.testing.assert_allclose(eda.spearman(d, "x", "y").first().spearman, p[["x", "y"]].dropna().rank().corr().iloc[0, 1])


def test_clashing_names_stay(spark, hourly):
    names = ["_v", "_t", "_d", "_side", "_n", "_row", "_there", "_block", "_home", "_part", "_f_pressure_bar", "_nth", "_m", "_s", "_p", "_q", "_i", "_j", "_open", "_found"]
    d = hourly.select("machine_id", "timestamp", "pressure_bar").withColumns({n: F.lit(i) for i, n in enumerate(names)})
    m = frame(spark, maintenance()).withColumn("_v", F.lit("theirs"))
    made = [
        series.reindex_grid(d, "1 hour"),
        series.forward_fill(d, ["pressure_bar"], 3),
        series.interpolate_both(d, "pressure_bar", 2),
        series.with_rolling_and_lags(d, ["pressure_bar"], ["pressure_bar"], [3], [1]),
        series.blocked(d, lambda x, k: series.forward_fill(x, ["pressure_bar"], 2, key=k), "6 hour", "2 hour"),
        series.hampel(d, "pressure_bar"),
        series.as_of(d, m, "action_timestamp", right_ts="action_timestamp"),
        series.range_count(d, m, "30 day", right_ts="action_timestamp", out="count"),
        series.inside_any(d, frame(spark, failures()), "degradation_start_timestamp", "failure_timestamp"),
        quality.dedupe_keep_first(d, ["machine_id", "timestamp"], ["pressure_bar"])[0],
        alarms.naive_alarm(d, "pressure_bar"),
    ]
    for x in made:
        assert x.count() == 144
        r = x.first()
        assert [r[n] for n in names] == list(range(len(names)))


def test_events_among_rows_with_blocks_nulls_and_ties(spark, hourly):
    rows = hourly.select("machine_id", "timestamp").unionAll(hourly.select("machine_id", "timestamp").limit(5)).unionAll(spark.sql("select cast(null as string), timestamp_ntz '2024-01-01 00:00:00'"))
    at = ["2023-12-30 00:00", "2024-01-01 00:00", "2024-01-01 00:00", "2024-01-01 13:30", "2024-01-02 12:00", "2024-01-05 00:00"]
    e = frame(spark, pd.DataFrame({"machine_id": ["HPU_01"] * 5 + ["HPU_02"], "at": pd.to_datetime(at), "v": [9.0, 1.0, 2.0, 5.0, 3.0, 4.0]})).unionAll(spark.sql("select 'HPU_01', cast(null as timestamp_ntz), 7.0D"))
    for exact in (True, False):
        for forward in (True, False):
            whole = series.as_of(rows, e, "v", right_ts="at", exact=exact, forward=forward)
            for block in ("5 hour", "1 day", "90 day"):
                assert whole.exceptAll(series.as_of(rows, e, "v", right_ts="at", exact=exact, forward=forward, block=block)).isEmpty()
            assert whole.count() == rows.count()
    near = {r.timestamp.isoformat()[5:13]: r.v for r in series.as_of(rows, e, "v", right_ts="at").where("machine_id = 'HPU_01'").collect()}
    assert near["01-01T00"] == 2.0 and near["01-01T14"] == 5.0 and near["01-02T11"] == 5.0 and near["01-02T12"] == 3.0
    n = series.range_count(rows, e, "12 hour", right_ts="at")
    assert n.exceptAll(series.range_count(rows, e, "12 hour", right_ts="at", block="7 hour")).isEmpty()
    assert {r.timestamp.isoformat()[5:13]: r.n for r in n.where("machine_id = 'HPU_01' and n > 0").collect()}["01-01T12"] == 2
    assert series.as_of(rows.limit(0), e, "v", right_ts="at").isEmpty() and series.as_of(rows, e.limit(0), "v", right_ts="at").where("v is not null").isEmpty()


def test_weeks_begin_with_the_first_day(spark):
    t = pd.date_range("2024-01-03 05:00", periods=20, freq="1D")
    d = frame(spark, pd.DataFrame({"machine_id": "a", "timestamp": t, "v": np.arange(20.0)}))
    got = {str(r.start)[:10]: r.v for r in eda.resample(d, "7 day", ["v"], "mean").collect()}
    assert got == {"2024-01-03": 3.0, "2024-01-10": 10.0, "2024-01-17": 16.5}
    assert eda.resample(d.limit(0), "7 day", ["v"]).isEmpty() and eda.drift(d.limit(0), "v").isEmpty()


def test_empty_and_missing_series(spark, hourly):
    none, gone = hourly.limit(0), hourly.withColumn("pressure_bar", F.lit(None).cast("double"))
    fails = frame(spark, failures())
    tag = lambda d: regime.tag_regimes(d, DEFAULTS["regimes"])
    assert series.reindex_grid(none, "1 hour").isEmpty() and series.islands(none, F.col("shift")).isEmpty() and quality.gap_report(none).isEmpty()
    assert eda.hourly_autocorrelation(none, "pressure_bar", 3).isEmpty() and eda.hourly_autocorrelation(gone, "pressure_bar", 3).isEmpty()
    assert eda.trajectory(none.withColumns({"failure_mode": F.lit("x"), "hours_to_failure": F.lit(1.0)}), ["pressure_bar"]).isEmpty()
    assert eda.healthy_running(tag(none), fails).isEmpty() and eda.healthy_running(tag(hourly), fails.limit(0)).count() == 144
    assert eda.normal_deviations(tag(none), ["pressure_bar"], "2024-01-21").isEmpty()
    assert eda.normal_deviations(tag(gone), ["pressure_bar"], "2024-01-21").where("z_pressure_bar is not null").isEmpty()
    assert eda.standstill_days(none, 1000.0, ["pressure_bar"]).isEmpty() and eda.identical_share(none, "vibration_x_g", "vibration_y_g", "shift").isEmpty()
    assert eda.health_state(hourly, fails.limit(0)).where("state <> 'healthy'").isEmpty() and eda.maintenance_profile(frame(spark, maintenance()).limit(0)).isEmpty()
    assert series.trailing_median(gone, "pressure_bar").where("rolling_median is not null").isEmpty() and eda.sampled(none, 0.5).isEmpty()
    z = RegimeBaseline(["pressure_bar"]).fit(tag(none))
    assert z.transform(tag(hourly)).where("z_pressure_bar is not null").isEmpty()
    assert RegimeBaseline(["pressure_bar"]).fit_transform(tag(gone)).where("z_pressure_bar is not null").isEmpty()
    quiet = hourly.withColumns({"any_rule": F.lit(False), "r": F.lit(False)})
    assert [(r.any_rule, r.first_rule) for r in alarms.lead_times(quiet, fails, ["r"]).collect()] == [(0.0, "-")]
    assert alarms.lead_times(quiet.limit(0), fails.limit(0), ["r"]).isEmpty()


def test_the_sample_does_not_depend_on_the_deal(hourly):
    a, b = (eda.sampled(hourly.repartition(n), 0.3, seed=4) for n in (2, 7))
    assert a.exceptAll(b).isEmpty() and 15 < a.count() == b.count() < 75
    assert eda.sampled(hourly, 1.0).count() == 144 and eda.sampled(hourly, 0.0).isEmpty()
