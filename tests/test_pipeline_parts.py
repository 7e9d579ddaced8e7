from __future__ import annotations

import json
from copy import deepcopy
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.config import DEFAULTS, load_config
from millrace.operators import alarms, quality, screening, splits, targets
from millrace.operators.baseline import CELL, RegimeBaseline
from millrace.operators.features import add_fleet_relative, band_shares, build_features, hourly_aggregate
from millrace.operators.regime import clean_telemetry, tag_regimes
from millrace.sources import files
from tests.make import failures, frame, maintenance, telemetry


@pytest.fixture(scope="module")
def cfg(tmp_path_factory):
    c = deepcopy(DEFAULTS)
    for k in c["paths"]:
        c["paths"][k] = str(tmp_path_factory.mktemp(k))
    return c


@pytest.fixture(scope="module")
def tables(spark):
    return {"telemetry": frame(spark, telemetry(days=2)), "failures": frame(spark, failures()), "maintenance": frame(spark, maintenance())}


def test_a_good_batch_passes_whole(tables, cfg):
    good, report, bad = quality.validate_all(tables, cfg, write=True)
    assert report.passed and good["telemetry"].count() == tables["telemetry"].count() and all(q.isEmpty() for q in bad.values())
    saved = json.loads(Path(cfg["paths"]["reports_dir"], "validation_report.json").read_text())
    assert saved["passed"] and saved["tables"]["maintenance"] == {"read": 3, "kept": 3} and len(saved["findings"]) == len(report.results)
    text = Path(cfg["paths"]["reports_dir"], "validation_report.md").read_text()
    assert text == report.to_markdown() and text.startswith("# Data validation: passed") and "## failures\n\n1 of 1 rows kept." in text
    assert all(r.n_failed == 0 or "floor" in r.check or "label" in r.check or "telemetry period" in r.check for r in report.results)


def test_each_fault_of_a_reading_goes_with_its_reason(spark, cfg):
    t = telemetry(days=1, step="30min").astype({"is_sensor_dropout": "int64", "day_of_week": "int64"})
    n = len(t)
    t = pd.concat([t, t.iloc[[20]].assign(flow_lpm=1.0)], ignore_index=True)
    t.loc[1, "machine_id"] = "PRESS_1"
    t.loc[40, "shift"] = "Evening"
    t.loc[41, ["shift", "day_of_week"]] = ["Evening", 7]
    t.loc[60, "is_sensor_dropout"] = 3
    t.loc[70, ["temp_celsius", "pressure_bar"]] = [95.0, -1.0]
    t.loc[80, "flow_lpm"] = np.nan
    report = quality.ValidationReport()
    good, bad = quality.validate_telemetry(frame(spark, t), cfg, report)
    assert good.count() == n - 4 == report.rows_out["telemetry"]
    assert good.where("machine_id = 'HPU_01' and flow_lpm = 1.0").isEmpty()  # of equal keys the first stays
    reasons = sorted(r[0].split(":")[0].split(" (")[0] + f" {r[0].count(';')}" for r in bad.select(quality.REASON).collect())
    assert reasons == ["duplicate 0", "is_sensor_dropout 0", "machine_id 0", "shift 0", "shift 1"]
    found = {r.check: r.n_failed for r in report.results}
    assert found["temp_celsius within [10, 90]"] == found["pressure_bar within [0, 350]"] == found["missing sensors and dropout flag agree"] == 1


@pytest.mark.parametrize("column", ["pump_rpm", "machine_id", "day_of_week"])
def test_a_table_without_a_wanted_column_is_rejected(tables, cfg, column):
    report = quality.ValidationReport()
    with pytest.raises(quality.BatchRejected):
        quality.validate_telemetry(tables["telemetry"].drop(column), cfg, report)
    assert not report.passed and report.to_markdown().startswith("# Data validation: rejected")


def test_events_that_break_the_contract_or_have_no_machine(spark, tables, cfg):
    one = failures()
    parts = [one.assign(event_id="ok"), one.assign(event_id="mode", failure_mode="noise"), one.assign(event_id="order", degradation_start_timestamp=one.failure_timestamp), one.assign(event_id="down", downtime_hours=0.0), one.assign(event_id="cost", repair_cost_usd=-5.0), one.assign(event_id="stray", machine_id="HPU_77"), one.assign(event_id="free", repair_cost_usd=np.nan)]
    good, report, bad = quality.validate_all(tables | {"failures": frame(spark, pd.concat(parts, ignore_index=True))}, cfg, write=False)
    assert sorted(r.event_id for r in good["failures"].collect()) == ["free", "ok"] and report.rows_out["failures"] == 2
    assert {r.event_id: r[quality.REASON] for r in bad["failures"].where("event_id = 'stray'").collect()} == {"stray": "unknown machine_id"} and bad["failures"].count() == 5


def test_ids_that_occur_again_all_go(spark, cfg):
    m = pd.concat([maintenance(), maintenance().iloc[[1]]], ignore_index=True)
    good, bad = quality.validate_table("maintenance", frame(spark, m), cfg, quality.ValidationReport())
    assert sorted(r.action_id for r in good.collect()) == ["W1", "W3"] and bad.count() == 2


def test_empty_and_null_tables_pass_the_gate(spark, tables, cfg):
    none = {k: v.limit(0) for k, v in tables.items()}
    good, report, _ = quality.validate_all(none, cfg, write=False)
    assert report.passed and all(g.isEmpty() for g in good.values()) and report.to_frame(spark).count() == len(report.results)
    t = tables["telemetry"].limit(2).withColumns({s: F.lit(None).cast("double") for s in DEFAULTS["sensors"]})
    good, _ = quality.validate_telemetry(t, cfg, quality.ValidationReport())
    assert good.count() == 2
    assert quality.issue_register(none["telemetry"], none["failures"], none["maintenance"], cfg).where("rows_affected > 0 and dimension <> 'schema'").isEmpty()


def test_files_are_typed_and_the_word_none_stays(spark, cfg, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    t = telemetry(machines=("HPU_05",), days=1, step="1h")
    t.loc[2, "flow_lpm"] = np.nan
    t.to_csv(raw / "sensor_telemetry.csv", index=False)
    failures().rename(columns={"event_id": "failure_event_id"}).to_csv(tmp_path / "failure_labels.csv", index=False)
    maintenance().rename(columns={"action_id": "maintenance_id"}).to_csv(raw / "maintenance_log.csv", index=False)
    c = deepcopy(cfg)
    c["paths"]["raw_dir"] = str(raw)
    got = files.ingest(spark, c)
    assert dict(got["telemetry"].dtypes)["timestamp"] == "timestamp_ntz" and got["telemetry"].where("flow_lpm is null").count() == 1
    assert got["maintenance"].where("component_replaced = 'None'").count() == 1 and got["failures"].first().event_id == "E7"
    narrow = files.read_narrow(spark, str(raw / "sensor_telemetry.csv"))
    assert dict(narrow.dtypes)["flow_lpm"] == "float" and narrow.count() == 24
    with pytest.raises(FileNotFoundError):
        files.find_file(spark, str(raw), "absent.csv")
    files.write_text(f"{tmp_path}/deep/er/x.txt", "çé\n")
    assert files.read_text(f"file://{tmp_path}/deep/er/x.txt") == "çé\n"


def test_a_word_among_the_numbers_stops_the_reader(spark, tmp_path):
    d = telemetry(days=1, step="6h").astype({"temp_celsius": object})
    d.loc[3, "temp_celsius"] = "warm"
    d.to_csv(tmp_path / "t.csv", index=False)
    with pytest.raises(Exception, match="(?i)malformed|bad record|cast|parse"):
        files.read_telemetry(spark, str(tmp_path / "t.csv")).collect()


def test_cleaning(spark, cfg):
    t = telemetry(machines=("HPU_03",), days=2)
    t.loc[700, "temp_celsius"] = 200.0
    t.loc[800:817, "pressure_bar"] = np.nan
    t.loc[2000:, "pump_rpm"] = 800.0
    t = t.drop(index=[1439, 1440])
    silver, log = clean_telemetry(frame(spark, t), cfg)
    s = silver.orderBy("timestamp").toPandas()
    assert len(s) == 2880 and log["rows_added_by_reindex"] == 2 and log["values_invalidated"] == {"pressure_bar": 0, "temp_celsius": 1, "flow_lpm": 0, "vibration_x_g": 0, "vibration_y_g": 0, "pump_rpm": 0}
    assert s.temp_celsius[700] == s.temp_celsius[699] and s.n_invalid_sensors[700] == 1
    assert s.pressure_bar[800:818].isna().sum() == 3 and s.pressure_bar[814] == s.pressure_bar[799]
    assert s.was_missing_row[1440] and s.is_sensor_dropout[1440] == 1 and s.pressure_bar[1440] == s.pressure_bar[1438]  # across the border of days
    assert not {"failure_mode", "rul_hours", "is_anomaly", "shift"} & set(s.columns)
    assert log["regime_vs_source_shift_agreement"] == 1.0 and log["standby_days"] == ["2024-01-02"]
    whole, _ = clean_telemetry(frame(spark, t), cfg, write=False, block=None)
    assert whole.exceptAll(silver).isEmpty() and silver.count() == whole.count()


def test_regime_borders(spark):
    times = ["2024-01-01 07:59", "2024-01-01 08:00", "2024-01-01 19:59", "2024-01-01 20:00", "2024-01-06 12:00", "2024-01-01 00:30", "2024-01-01 12:00", "2024-01-01 12:01"]
    rpm = [1500.0] * 6 + [1000.0, None]
    df = spark.createDataFrame(list(zip(times, rpm, strict=True)), "t string, pump_rpm double").withColumn("timestamp", F.col("t").cast("timestamp_ntz"))
    r = tag_regimes(df, DEFAULTS["regimes"]).collect()
    assert [x.regime for x in r] == ["Night", "Day", "Day", "Night", "Weekend", "Night", "Standby", "Day"]
    assert r[5].is_midnight_dip and r[4].day_of_week == 5


@pytest.fixture(scope="module")
def silver(spark, cfg):
    t = telemetry(days=20, step="10min")
    s = tag_regimes(frame(spark, t).drop("failure_mode", "rul_hours", "is_anomaly", "shift", "day_of_week"), cfg["regimes"])
    return s.withColumns({"was_imputed": F.lit(False), "n_invalid_sensors": F.lit(0)}).persist()


def alike(a, b, keys):
    """Equal rows, but for the last digits of sums in another order."""
    x, y = (d.orderBy(*keys).toPandas() for d in (a, b))
    pd.testing.assert_frame_equal(x, y, check_exact=False, rtol=1e-9, atol=1e-12)


def test_baseline_ignores_later_rows_and_keeps(spark, silver, tmp_path):
    b = RegimeBaseline(DEFAULTS["baseline"]["signals"]).fit(silver)
    later = silver.withColumn("pressure_bar", F.when(F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp_ntz"), F.col("pressure_bar") * 3).otherwise(F.col("pressure_bar")))
    c = RegimeBaseline(DEFAULTS["baseline"]["signals"]).fit(later)
    alike(b.cells, c.cells, CELL)
    z = b.transform(silver)
    means = z.groupBy("regime").agg(F.avg("z_pressure_bar").alias("z"), F.avg("pressure_bar").alias("p")).collect()
    assert all(abs(r.z) < 0.5 for r in means) and max(r.p for r in means) - min(r.p for r in means) > 20
    b.save(str(tmp_path / "b.parquet"))
    d = RegimeBaseline.load(spark, str(tmp_path / "b.parquet"), b.signals)
    alike(d.transform(silver), z, ["machine_id", "timestamp"])
    with pytest.raises(RuntimeError):
        RegimeBaseline(b.signals).transform(silver)


def test_standby_has_no_deviation(silver):
    d = silver.withColumn("is_standby", F.hour("timestamp") == 3)
    z = RegimeBaseline(["flow_lpm"]).fit_transform(d)
    assert z.where("is_standby and (z_flow_lpm is not null or pct_flow_lpm is not null)").isEmpty()


@pytest.fixture(scope="module")
def built(silver, spark, cfg):
    c = deepcopy(cfg)
    c["features"]["spectral_window_min"] = 36
    c["validation"]["sampling_interval"] = "10 minute"
    z = RegimeBaseline(c["baseline"]["signals"]).fit_transform(silver)
    f, d = build_features(z, frame(spark, maintenance()), c)
    return f.persist(), d.persist(), z, c


def test_registry_has_all_features(built):
    f, d, _, _ = built
    assert d.count() == 246 and set(r.feature for r in d.collect()) <= set(f.columns) and len(f.columns) == 250


def test_hour_describes_the_hour_before(built):
    f, _, z, _ = built
    at = F.lit("2024-01-03 05:00:00").cast("timestamp_ntz")
    row = f.where((F.col("timestamp") == at) & (F.col("machine_id") == "HPU_01")).first()
    m = z.where("machine_id = 'HPU_01'").where((F.col("timestamp") >= at - F.expr("interval 1 hour")) & (F.col("timestamp") < at)).agg(F.avg("flow_lpm").alias("m"), F.count("*").alias("n")).first()
    assert abs(row.flow_lpm_mean - m.m) < 1e-9 and row.n_minutes == m.n == 6 and row.hour_of_day == 4


def test_no_look_ahead(built, spark):
    f, _, z, c = built
    cut = F.lit("2024-01-17 12:00:00").cast("timestamp_ntz")
    changed = z.withColumns({s: F.when(F.col("timestamp") >= cut, F.col(s) * 0.5 + 5).otherwise(F.col(s)) for s in ("pressure_bar", "vibration_x_g", "z_pressure_bar", "pct_flow_lpm")})
    g, _ = build_features(changed, frame(spark, maintenance()), c)
    a, b = (x.where(F.col("timestamp") <= cut).orderBy("machine_id", "timestamp").toPandas() for x in (f, g))
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-9)
    assert not f.exceptAll(g).isEmpty()


def test_blocks_of_time_give_the_same_features(built, spark):
    f, _, z, c = built
    whole, _ = build_features(z, frame(spark, maintenance()), c, blocks=None)
    parts, _ = build_features(z, frame(spark, maintenance()), c, blocks=("1 day", "4 day", "5 day"))
    a, b, d = (x.orderBy("machine_id", "timestamp").toPandas() for x in (whole, parts, f))
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-7, atol=1e-9)
    pd.testing.assert_frame_equal(a, d, check_exact=False, rtol=1e-7, atol=1e-9)


def test_spectrum_of_known_waves():
    n = np.arange(360)
    w = np.stack([1 + np.cos(2 * np.pi * n / 40) + 3 * np.cos(2 * np.pi * n / 4), np.full(360, 2.5), np.full(360, np.nan), np.where(n == 100, np.nan, 1 + np.cos(2 * np.pi * n / 40))])
    s = band_shares(w, DEFAULTS["features"]["spectral_bands"])
    np.testing.assert_allclose(s[0, :3], [0.1, 0.0, 0.9], atol=1e-9)
    assert np.isnan(s[1, :3]).all() and s[1, 3] == 0 and abs(s[1, 4] + 12) < 1e-6 and np.isnan(s[2, 4]) and s[3, 0] > 0.9


def test_fleet_median(spark):
    h = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0), ("c", 1, 9.0)], "machine_id string, timestamp int, v double")
    assert sorted(r.fv for r in add_fleet_relative(h, ["v"])[0].collect()) == [-1.0, 0.0, 7.0]


def test_aggregate_of_hours_with_gaps(built):
    _, _, z, c = built
    h, _ = hourly_aggregate(z.withColumns({s: F.lit(None).cast("double") for s in ("vibration_x_g", "z_vibration_x_g")}), c)
    r = h.first()
    assert r.vib_x_burst_count == 0.0 and r.vib_x_p95 is None and r.missing_share == 1.0


def _rows(spark, machines=("HPU_01", "HPU_02"), hours=600):
    t = pd.date_range("2024-01-01 01:00", periods=hours, freq="1h")
    return frame(spark, pd.concat([pd.DataFrame({"machine_id": m, "timestamp": t}) for m in machines]))


@pytest.mark.parametrize("block", [None, "3 day"])
def test_targets_around_a_failure(spark, block):
    """The failure is on the 15th at 6:00, degrades from the 13th at 18:00 and takes 8 hours to mend."""
    got = targets.build_targets(_rows(spark), frame(spark, failures()), DEFAULTS, block=block)
    got = got.where("machine_id = 'HPU_02'").toPandas().set_index("timestamp")
    at = lambda s: got.loc[pd.Timestamp(s)]
    assert at("2024-01-13 18:00").failure_mode_label == "healthy" and at("2024-01-13 19:00").failure_mode_label == "valve_leakage"
    assert at("2024-01-13 19:00").rul_hours == 35 and at("2024-01-15 06:00").rul_hours == 0 and at("2024-01-01 02:00").rul_hours == 336
    assert at("2024-01-08 06:00").fail_within_h == 1 and at("2024-01-08 05:00").fail_within_h == 0
    assert at("2024-01-15 14:00").failure_mode_label == "repair" and np.isnan(at("2024-01-15 14:00").rul_hours)
    assert at("2024-01-15 15:00").failure_mode_label == "healthy" and at("2024-01-15 15:00").rul_censored and not at("2024-01-15 06:00").rul_censored
    assert at("2024-01-15 06:00").life_cycle == 0 and at("2024-01-15 07:00").life_cycle == 1


def test_targets_without_a_failure(spark):
    got = targets.build_targets(_rows(spark), frame(spark, failures()), DEFAULTS).where("machine_id = 'HPU_01'").toPandas().set_index("timestamp")
    last = got.index.max()
    known, near = last - pd.Timedelta(hours=336), last - pd.Timedelta(hours=168)
    hour = pd.Timedelta(hours=1)
    assert got.rul_hours[known] == 336 and np.isnan(got.rul_hours[known + hour])
    assert got.fail_within_h[near] == 0 and np.isnan(got.fail_within_h[near + hour])
    assert targets.build_targets(_rows(spark).limit(0), frame(spark, failures()), DEFAULTS).isEmpty()
    assert targets.build_targets(_rows(spark, hours=2), frame(spark, failures()).limit(0), DEFAULTS).where("in_repair or next_event_id is not null").isEmpty()


def test_folds(spark):
    f = spark.createDataFrame([("p", "leak"), ("p", "wear"), ("q", "wear"), ("q", "wear"), ("s", "dirt")], "machine_id string, failure_mode string")
    m = spark.createDataFrame([("s",), ("q",), ("p",), ("r",), ("q",), (None,)], "machine_id string")
    got = splits.leave_one_machine_out(m, f).orderBy("fold").collect()
    assert [tuple(r) for r in got] == [(0, "p", "leak, wear", "leak"), (1, "q", "wear", ""), (2, "r", "none (healthy reference)", ""), (3, "s", "dirt", "dirt")]
    assert sorted((r.machine_id or "", -1 if r.fold is None else r.fold) for r in splits.assign_folds(m, splits.leave_one_machine_out(m, f)).collect()) == [("", -1), ("p", 0), ("q", 1), ("q", 1), ("r", 2), ("s", 3)]


@pytest.fixture(scope="module")
def identity(spark):
    """Six machines: one column tells them apart by level, one by a few values, one not at all; and some of no use."""
    rng = np.random.default_rng(11)
    t = pd.date_range("2024-01-05", "2024-02-05", freq="2h")
    parts = []
    for k in range(6):
        plain = rng.uniform(0, 1, len(t))
        parts.append(pd.DataFrame({"machine_id": f"u{k}", "timestamp": t, "level": 3.0 * k + rng.uniform(0, 1, len(t)), "steps": float(k // 2), "plain": plain, "twin": 5 - plain, "flat": 7.0, "gone": np.nan}))
    d = frame(spark, pd.concat(parts, ignore_index=True))
    return d.withColumns({"failure_mode_label": F.lit("healthy"), "standby_share": F.lit(0.0), "in_repair": F.lit(False), "in_baseline_period": F.lit(False)})


def test_identity_leak_and_selection(spark, identity):
    names = ["level", "steps", "plain", "twin", "flat", "gone"]
    r = {x.feature: x.machine_id_accuracy for x in screening.identity_leak(identity, names, "2024-01-21").collect()}
    assert r["level"] > 0.99 and abs(r["steps"] - 0.5) < 1e-9 and r["plain"] < 0.3 and abs(r["flat"] - 1 / 6) < 1e-9 and abs(r["gone"] - 1 / 6) < 1e-9
    d = spark.createDataFrame([(i, n, "vibration", "") for i, n in enumerate(names)], "position int, feature string, group string, description string")
    kept, report = screening.select_features(identity, d, DEFAULTS)
    assert kept == ["plain"]
    assert {x.feature: x.status for x in report.collect()} == {"level": "dropped_identity_leak", "steps": "dropped_identity_leak", "plain": "kept", "twin": "dropped_correlated", "flat": "dropped_constant", "gone": "dropped_mostly_missing"}
    assert abs(screening.identity_chance(identity, "2024-01-21").first().chance - 1 / 6) < 1e-9


def test_screening_without_rows(spark, identity):
    none = identity.limit(0)
    assert screening.identity_leak(none, ["level"], "2024-01-21").isEmpty() and screening.identity_chance(none, "2024-01-21").first().chance is None
    assert np.isnan(screening.correlations(none, ["level", "plain"])).all() and np.isnan(screening.multi_feature_identity(none, ["level"], "2024-01-21"))
    late = identity.where("timestamp >= timestamp_ntz '2024-01-21'")
    assert [r.machine_id_accuracy for r in screening.identity_leak(late, ["level"], "2024-01-21").collect()] == [None]


def test_binned_trees_equal_trees_on_values():
    """Against plain growing of the best split first on sorted values."""
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 30, 400).astype(float), rng.integers(0, 3, 400)
    y = np.where(x > 17, (x > 23) * 1, y)
    train = np.arange(400) % 3 > 0
    gini = lambda v: len(v) - (np.bincount(v, minlength=3) ** 2).sum() / max(len(v), 1)

    def best(rows):
        out = (0.0, None)
        for c in np.unique(x[rows])[1:]:
            l, r = rows[x[rows] < c], rows[x[rows] >= c]
            if min(len(l), len(r)) >= 20 and gini(y[rows]) - gini(y[l]) - gini(y[r]) > out[0] + 1e-12:
                out = (gini(y[rows]) - gini(y[l]) - gini(y[r]), c)
        return out

    leaves = [(-np.inf, np.inf)]
    inside = lambda lo, hi, side: np.flatnonzero((x >= lo) & (x < hi) & (train == side))
    while len(leaves) < 32:
        gains = [best(inside(lo, hi, True)) for lo, hi in leaves]
        i = max(range(len(leaves)), key=lambda j: gains[j][0])
        if gains[i][1] is None:
            break
        lo, hi = leaves.pop(i)
        leaves += [(lo, gains[i][1]), (gains[i][1], hi)]
    want = sum((y[inside(lo, hi, False)] == np.bincount(y[inside(lo, hi, True)], minlength=3).argmax()).sum() for lo, hi in leaves) / (~train).sum()
    counts = [np.array([[((x == v) & (y == c) & (train == side)).sum() for c in range(3)] for v in range(30)], float) for side in (True, False)]
    assert abs(screening.tree_accuracy(*counts) - want) < 1e-12


def test_correlations_skip_missing_pairs(spark):
    rng = np.random.default_rng(3)
    p = pd.DataFrame(rng.normal(size=(300, 3)), columns=list("abc"))
    p["b"] += p.a
    p.loc[p.sample(60, random_state=1).index, "b"] = np.nan
    r = screening.correlations(frame(spark, p), list("abc"))
    np.testing.assert_allclose(r, p.corr().to_numpy(), rtol=1e-9)


def test_alarm_needs_hours(spark):
    rows = [("m", i, 5.0 if 10 <= i < 20 else 0.0) for i in range(30)]
    df = spark.createDataFrame(rows, "machine_id string, i int, v double").selectExpr("machine_id", "timestamp_ntz '2024-01-01' + make_interval(0,0,0,0,i) timestamp", "v", "false is_standby")
    a = alarms.rule_alarms(df, {"high": ("v", 1, 3.0, "median")}, span="3 hour").orderBy("timestamp").toPandas()
    assert a.index[a.high].min() == 13 and a.any_rule.equals(a.high)
    f = spark.sql("select 'e' event_id, 'm' machine_id, 'pump_wear' failure_mode, timestamp_ntz '2024-01-02' failure_timestamp, timestamp_ntz '2024-01-01' degradation_start_timestamp")
    lead = alarms.lead_times(alarms.rule_alarms(df, {"high": ("v", 1, 3.0, "median")}, span="3 hour"), f, ["high"]).first()
    assert lead.high == 11.0 and lead.first_rule == "high" and lead.window_h == 24.0


def test_alarms_of_the_default_rules(spark):
    t = telemetry(machines=("HPU_01",), days=4, step="20min").assign(is_standby=False)
    t.loc[150:200, "vibration_y_g"] -= 0.04
    d = frame(spark, t).withColumns({f"z_{s}": F.lit(0.0) for s in ("pressure_bar", "flow_lpm", "temp_celsius", "vibration_x_g")})
    a = alarms.rule_alarms(d).orderBy("timestamp").toPandas()
    assert a.xy_divergence.any() and a.any_rule.equals(a.xy_divergence) and not a.pressure_low.any()
    b = alarms.rule_alarms(d, block=None).orderBy("timestamp").toPandas()
    c = alarms.rule_alarms(d, block="1 day").orderBy("timestamp").toPandas()
    assert a.equals(b) and a.equals(c)
    assert alarms.rule_alarms(d.limit(0)).isEmpty()


def test_config_file(tmp_path):
    p = tmp_path / "configs" / "c.yaml"
    p.parent.mkdir()
    p.write_text("targets: {rul_cap_hours: 100}\ncleaning: {max_interpolation_gap_min: 7}\nvalidation: {sampling_interval: 1min}\n")
    c = load_config(p)
    assert c["targets"] == {"rul_cap_hours": 100, "warning_horizon_hours": 168} and c["cleaning"]["max_fill_rows"] == 7
    assert c["validation"]["sampling_interval"] == "1 minute" and Path(c["paths"]["raw_dir"]).is_dir()
