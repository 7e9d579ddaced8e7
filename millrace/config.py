"""Settings: defaults in one place, overridden by a YAML file."""

from __future__ import annotations

from copy import deepcopy
from pathlib import Path
from typing import Any

#: Names, bounds and thresholds of the data contract and the features.
DEFAULTS: dict[str, Any] = {
    "paths": {"raw_dir": "data/raw", "interim_dir": "data/interim", "processed_dir": "data/processed", "quarantine_dir": "data/quarantine", "reports_dir": "reports"},
    "files": {"telemetry": "sensor_telemetry.csv", "failures": "failure_labels.csv", "maintenance": "maintenance_log.csv"},
    "contract_renames": {"failures": {"failure_event_id": "event_id"}, "maintenance": {"maintenance_id": "action_id"}},
    "sensors": ["pressure_bar", "temp_celsius", "flow_lpm", "vibration_x_g", "vibration_y_g", "pump_rpm"],
    "leakage_columns": ["is_anomaly", "failure_mode", "rul_hours"],
    "validation": {
        "sampling_interval": "1 minute",
        "machine_id_pattern": r"^HPU_\d{2}$",
        "failure_modes": ["pump_wear", "valve_leakage", "contamination", "cylinder_drift"],
        "action_types": ["Preventive", "Reactive", "Predictive", "Inspection"],
        "components": ["Pump", "Valve", "Filter", "Seal", "Oil", "None"],
        "shifts": ["Day", "Night", "Weekend"],
        "sensor_floor": {"vibration_x_g": 0.05, "vibration_y_g": 0.05},
    },
    "cleaning": {
        "valid_ranges": {"pressure_bar": [0, 350], "temp_celsius": [10, 90], "flow_lpm": [0, 150], "vibration_x_g": [0, 16], "vibration_y_g": [0, 16], "pump_rpm": [500, 1600]},
        "max_fill_rows": 15,
    },
    "regimes": {"standby_rpm_below": 1200, "day_shift_hours": [8, 20], "weekend_days": [5, 6], "midnight_dip_hours": [0]},
    "baseline": {"reference_days": 14, "min_samples_per_cell": 20, "signals": ["pressure_bar", "temp_celsius", "flow_lpm", "vibration_x_g", "vibration_y_g"]},
    "targets": {"rul_cap_hours": 336, "warning_horizon_hours": 168},
    "features": {
        "rolling_windows_h": [6, 24, 72],
        "lags_h": [1, 24],
        "spectral_window_min": 360,
        "spectral_bands": [[0.0, 0.05], [0.05, 0.15], [0.15, 0.5]],
        "vibration_burst_g": 1.0,
        "xy_divergence_g": 0.02,
        "corr_prune_threshold": 0.98,
        "exclude_from_model": ["machine_id", "pump_rpm", "vibration_x_g_min", "vibration_y_g_min", "z_vibration_x_g_min", "z_vibration_y_g_min"],
        "exclude_groups": ["maintenance"],
    },
    "leakage_check": {"split_date": "2024-01-21", "single_feature_flag_accuracy": 0.30},
    "random_state": 42,
}


def _merge(base: dict, over: dict) -> dict:
    for k, v in over.items():
        whole = k in ("valid_ranges", "sensor_floor", "contract_renames")
        base[k] = _merge(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) and not whole else v
    return base


def load_config(path: str | Path | None = None, root: str | Path | None = None) -> dict[str, Any]:
    """Defaults, then the YAML file's values. Relative paths are taken from ``root`` and their folders made.

    ``max_interpolation_gap_min`` is read as another name of ``max_fill_rows``, and ``1min`` as an interval.
    """
    cfg = deepcopy(DEFAULTS)
    if path is not None:
        import yaml

        _merge(cfg, yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})
    cleaning = cfg["cleaning"]
    cleaning["max_fill_rows"] = cleaning.pop("max_interpolation_gap_min", cleaning["max_fill_rows"])
    step = str(cfg["validation"]["sampling_interval"])
    cfg["validation"]["sampling_interval"] = {"1min": "1 minute", "1h": "1 hour"}.get(step, step)
    base = Path(root) if root is not None else (Path(path).resolve().parent.parent if path is not None else Path.cwd())
    for name, p in cfg["paths"].items():
        p = str(p)
        if "://" not in p:
            full = Path(p) if Path(p).is_absolute() else base / p
            full.mkdir(parents=True, exist_ok=True)
            p = str(full)
        cfg["paths"][name] = p
    return cfg
