from __future__ import annotations

import json
from copy import deepcopy
from pathlib import Path

import pandas as pd

from millrace.config import DEFAULTS
from millrace.plans.pipeline import main, run
from millrace.sources.files import read_eligible
from tests.make import failures, maintenance, telemetry


def test_from_files_to_the_labelled_table(spark, tmp_path):
    cfg = deepcopy(DEFAULTS)
    for k in cfg["paths"]:
        cfg["paths"][k] = str(tmp_path / k)
        (tmp_path / k).mkdir()
    cfg["validation"]["sampling_interval"] = "20 minute"
    cfg["features"]["spectral_window_min"] = 36
    cfg["features"]["rolling_windows_h"] = [6]
    cfg["leakage_check"]["split_date"] = "2024-01-16"
    raw = tmp_path / "raw_dir"
    t = telemetry(machines=("HPU_01", "HPU_02", "HPU_03"), days=22, step="20min").drop(index=[50, 51])
    pd.concat([t, t.iloc[[7]]]).to_csv(raw / "sensor_telemetry.csv", index=False)
    failures().rename(columns={"event_id": "failure_event_id"}).to_csv(raw / "failure_labels.csv", index=False)
    maintenance().rename(columns={"action_id": "maintenance_id"}).to_csv(raw / "maintenance_log.csv", index=False)
    got = run(spark, cfg)
    s = got["summary"]
    assert s["validation_passed"] and s["hourly_rows"] == 3 * 22 * 24 and s["cleaning"]["rows_added_by_reindex"] == 2
    assert got["quarantine"]["telemetry"].count() == 1
    assert 0 < s["selected_features"] == len(got["kept"]) < s["candidate_features"]
    assert s["labels"]["valve_leakage"] > 0 and 0 <= s["identity_accuracy_selected"] <= 1
    assert not [f for f in got["kept"] if f.startswith("pump_rpm") or f.startswith("days_since")]
    out = tmp_path / "processed_dir"
    assert json.loads((out / "feature_list.json").read_text()) == got["kept"]
    assert len((out / "folds.csv").read_text().splitlines()) == 4
    assert json.loads((out / "pipeline_summary.json").read_text())["hourly_rows"] == s["hourly_rows"]
    assert spark.read.parquet(str(out / "dataset.parquet")).where("eligible").count() == s["eligible_rows"] > 0
    rows, names = read_eligible(spark, str(out))
    assert rows.count() == s["eligible_rows"] and names == got["kept"] and set(names) <= set(rows.columns)
    assert (tmp_path / "reports_dir" / "validation_report.md").exists() and Path(out / "feature_dictionary.csv").stat().st_size > 1000


def test_the_command_line_takes_a_configuration(spark, tmp_path, capsys):
    import yaml

    raw = tmp_path / "data" / "raw"
    raw.mkdir(parents=True)
    telemetry(machines=("HPU_01", "HPU_02"), days=18, step="1h").to_csv(raw / "sensor_telemetry.csv", index=False)
    failures().rename(columns={"event_id": "failure_event_id"}).to_csv(raw / "failure_labels.csv", index=False)
    maintenance().rename(columns={"action_id": "maintenance_id"}).to_csv(raw / "maintenance_log.csv", index=False)
    c = {"validation": {"sampling_interval": "1h"}, "features": {"spectral_window_min": 24, "rolling_windows_h": [6]}, "leakage_check": {"split_date": "2024-01-16"}}
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(c))
    main(["--config", str(tmp_path / "c.yaml"), "--root", str(tmp_path), "--no-forest"])
    assert f"hourly_rows: {2 * 18 * 24}" in capsys.readouterr().out
    assert (tmp_path / "data" / "processed" / "pipeline_summary.json").exists()
