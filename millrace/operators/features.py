"""Hourly features. One registry names every feature with its group, description and expression, and both the aggregate and the dictionary come from it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import any_null, correlation_from_moments, crest, cyclic, fresh, hour_end, kurtosis_from_moments, micros
from millrace.operators import sliding
from millrace.operators.series import AFTER, BEFORE, among_events, expiring, steps_of, with_rolling_and_lags

SIGNALS = ["pressure_bar", "temp_celsius", "flow_lpm", "vibration_x_g", "vibration_y_g"]
RAW = [*SIGNALS, "pump_rpm"]
#: Which features get fleet medians, rolling statistics and lags.
FLEET = ["z_pressure_bar_mean", "z_temp_celsius_mean", "z_flow_lpm_mean", "z_vibration_x_g_mean"]
ROLL = ["z_pressure_bar_mean", "z_temp_celsius_mean", "fz_temp_celsius_mean", "z_flow_lpm_mean", "z_vibration_x_g_mean", "z_vibration_x_g_max", "vib_x_kurtosis", "xy_delta_absmax", "pct_pressure_minus_flow_mean", "corr_pressure_flow"]
LAG = ["z_pressure_bar_mean", "z_temp_celsius_mean", "z_flow_lpm_mean", "z_vibration_x_g_mean", "xy_delta_mean"]

Registry = dict[str, tuple[str, str]]


def _flag(condition: Column) -> Column:
    """1.0 or 0.0; NULL stays NULL."""
    return condition.cast("double")


def hourly_expressions(cfg: dict) -> tuple[dict[str, Column], Registry]:
    """Aggregates of an hour's minutes by name, and their registry."""
    f = cfg["features"]
    x, y = F.col("vibration_x_g"), F.col("vibration_y_g")
    p, t, q = F.col("pressure_bar"), F.col("temp_celsius"), F.col("flow_lpm")
    apart = F.abs(x - y)
    out: dict[str, Column] = {}
    reg: Registry = {}

    def put(name: str, group: str, text: str, e: Column) -> None:
        out[name], reg[name] = e, (group, text)

    made = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    for s in RAW:
        for k, fn in made.items():
            put(f"{s}_{k}", "hourly_raw", f"{k} of {s} in the hour", fn(s))
    for s in SIGNALS:
        for k in ("mean", "min", "max"):
            put(f"z_{s}_{k}", "hourly_regime", f"{k} in the hour of {s} against the machine's own normal, in deviations", made[k](f"z_{s}"))
        put(f"pct_{s}_mean", "hourly_regime", f"mean in the hour of {s} against the machine's own normal, in percent", F.avg(f"pct_{s}"))
    m1, m2, m3, m4 = F.avg(x), F.avg(x * x), F.avg(x * x * x), F.avg(x * x * x * x)
    put("vib_x_p95", "vibration", "95th percentile of vibration X in the hour", F.percentile(x, 0.95))
    put("vib_x_burst_count", "vibration", f"minutes with vibration X over {f['vibration_burst_g']} g", F.coalesce(F.sum(_flag(x > f["vibration_burst_g"])), F.lit(0.0)))
    put("vib_x_kurtosis", "vibration", "excess kurtosis of vibration X in the hour", kurtosis_from_moments(m1, m2, m3, m4))
    put("vib_x_crest", "vibration", "greatest vibration X over its root mean square", crest(F.max(x), m2))
    put("xy_delta_mean", "cross_sensor", "mean of vibration X less Y", F.avg(x - y))
    put("xy_delta_absmax", "cross_sensor", "greatest distance of vibration X and Y", F.max(apart))
    put("xy_nonzero_share", "cross_sensor", "share of minutes where vibration X and Y differ", F.avg(_flag(apart > 1e-9)))
    put("xy_divergence_share", "cross_sensor", f"share of minutes where they differ by over {f['xy_divergence_g']} g", F.avg(_flag(apart > f["xy_divergence_g"])))
    put("pct_pressure_minus_flow_mean", "cross_sensor", "mean of pressure's percentage less flow's", F.avg(F.col("pct_pressure_bar") - F.col("pct_flow_lpm")))
    put("corr_pressure_flow", "cross_sensor", "correlation of pressure and flow in the hour", correlation_from_moments(F.avg(p * q), F.avg(p), F.avg(q), F.avg(p * p), F.avg(q * q)))
    put("corr_temp_flow", "cross_sensor", "correlation of temperature and flow in the hour", correlation_from_moments(F.avg(t * q), F.avg(t), F.avg(q), F.avg(t * t), F.avg(q * q)))
    put("imputed_share", "quality", "share of minutes that were filled", F.avg(_flag(F.col("was_imputed"))))
    put("invalid_count", "quality", "implausible readings taken out", F.coalesce(F.sum("n_invalid_sensors"), F.lit(0)).cast("long"))
    put("missing_share", "quality", "share of minutes with a sensor still missing", F.avg(_flag(any_null(RAW))))
    put("standby_share", "context", "share of minutes in standby", F.avg(_flag(F.col("is_standby"))))
    put("n_minutes", "quality", "minutes in the hour", F.count(F.lit(1)))
    return out, reg


def hourly_aggregate(minutes: DataFrame, cfg: dict) -> tuple[DataFrame, Registry]:
    """One row a machine and hour, stamped with the hour's end; with the hour's most frequent regime (ties: the first by name) if there is one."""
    e, reg = hourly_expressions(cfg)
    regime = [F.mode("regime", deterministic=True).alias("regime")] if "regime" in minutes.columns else []
    h = minutes.groupBy("machine_id", hour_end("timestamp").alias("_t")).agg(*(x.alias(n) for n, x in e.items()), *regime)
    return h.withColumnRenamed("_t", "timestamp"), reg


def add_fleet_relative(h: DataFrame, cols: list[str] = FLEET, ts: str = "timestamp") -> tuple[DataFrame, Registry]:
    """f<name>: the value less the median of all machines at that hour. An hour's group is as large as the fleet."""
    w = Window.partitionBy(ts)
    return h.withColumns({f"f{c}": F.col(c) - F.median(c).over(w) for c in cols}), {f"f{c}": ("fleet_relative", f"{c} less the fleet's median at that hour") for c in cols}


def add_rolling_and_lags(h: DataFrame, cfg: dict, roll: list[str] = ROLL, lag: list[str] = LAG, block: str | None = None) -> tuple[DataFrame, Registry]:
    """Trailing statistics and lags by rows. With ``block`` (for rows of every hour) a machine's history is many tasks."""
    f = cfg["features"]
    reg: Registry = {f"{c}_roll{w}h_{s}": ("rolling", f"{s} of {c} over the last {w} h") for c in roll for w in f["rolling_windows_h"] for s in ("mean", "std", "min", "max", "slope")}
    for c in lag:
        for n in f["lags_h"]:
            reg |= {f"{c}_lag{n}h": ("lag", f"{c} {n} h before"), f"{c}_diff{n}h": ("lag", f"change of {c} in {n} h")}
    return with_rolling_and_lags(h, roll, lag, f["rolling_windows_h"], f["lags_h"], block=block), reg


def band_shares(windows: np.ndarray, bands: list[list[float]]) -> np.ndarray:
    """(share of each band.., entropy, log power) of each row of minutes; gaps take the row's median."""
    n = windows.shape[1]
    frequency = np.fft.rfftfreq(n)
    gap = np.isnan(windows)
    empty = gap.all(axis=1)
    filled = windows.copy()
    filled[empty] = 0.0
    some = ~empty
    if some.any():
        filled[some] = np.where(gap[some], np.nanmedian(windows[some], axis=1, keepdims=True), windows[some])
    power = np.abs(np.fft.rfft(filled - filled.mean(axis=1, keepdims=True), axis=1)) ** 2
    power[:, 0] = 0.0
    total = power.sum(axis=1)
    share = np.divide(power, total[:, None], out=np.full_like(power, np.nan), where=total[:, None] > 0)
    out = np.empty((len(windows), len(bands) + 2))
    for i, (lo, hi) in enumerate(bands):
        out[:, i] = share[:, (frequency > lo) & (frequency <= hi)].sum(axis=1)
    out[:, -2] = -np.nansum(share * np.log(share + 1e-12), axis=1) / np.log(power.shape[1])
    out[:, -1] = np.log10(total / n + 1e-12)
    out[empty, -1] = np.nan
    return out


def spectral_names(bands: list[list[float]]) -> list[str]:
    return [*(f"vib_spec_band{i}_share" for i in range(len(bands))), "vib_spec_entropy", "vib_spec_log_power"]


def spectral_features(minutes: DataFrame, hours: DataFrame | None, cfg: dict, signal: str = "vibration_x_g", block: str | None = None) -> tuple[DataFrame, Registry]:
    """(machine_id, timestamp, band shares, entropy, log power) of the minutes before each hour's stamp.

    Minutes stream by in order of time; the last rows are laid out and transformed only where a row ends an hour. Hours with
    fewer rows before them have NULLs. With ``hours`` the result has a row for each of these, else only for hours with a
    window. With ``block`` (whole hours; for rows at every sampling interval) a machine's history is many tasks.
    """
    f = cfg["features"]
    size, bands = int(f["spectral_window_min"]), f["spectral_bands"]
    names = spectral_names(bands)
    stamp, hour = fresh(minutes, "_t", "_h")
    d = minutes.select("machine_id", hour_end("timestamp").alias(stamp), "timestamp", F.col(signal).cast("double").alias("_signal"))
    d = d.withColumn(hour, micros(stamp).cast("double") / 3.6e9)

    def compute(t: np.ndarray, values: list[np.ndarray]) -> dict[str, np.ndarray]:
        v, hours_ = values
        ends = np.r_[hours_[1:] != hours_[:-1], True] & (np.arange(len(v)) >= size - 1)
        out = np.full((len(v), len(names)), np.nan)
        at = np.flatnonzero(ends)
        for part in np.array_split(at, max(1, len(at) // 500)):
            if len(part):
                out[part] = band_shares(np.lib.stride_tricks.sliding_window_view(v, size)[part - (size - 1)], bands)
        return {"keep": ends} | dict(zip(names, out.T, strict=True))

    interval = cfg["validation"]["sampling_interval"]
    got = sliding.over_runs(d, ["_signal", hour], compute, dict.fromkeys(names, "double"), behind=size, ahead=1, block=block, halo=steps_of(interval, size), keep=["machine_id", stamp])
    got = got.withColumnRenamed(stamp, "timestamp")
    reg: Registry = {f"vib_spec_band{i}_share": ("spectral", f"share of vibration's power in {lo} to {hi} cycles a minute over {size} minutes") for i, (lo, hi) in enumerate(bands)}
    reg |= {"vib_spec_entropy": ("spectral", "spectral entropy of vibration, 1 for noise"), "vib_spec_log_power": ("spectral", "log10 of vibration's power")}
    return got if hours is None else hours.select("machine_id", "timestamp").join(got, ["machine_id", "timestamp"], "left"), reg


def add_context(h: DataFrame, ts: str = "timestamp") -> tuple[DataFrame, Registry]:
    start = F.col(ts) - F.expr("interval 1 hour")
    sine, cosine = cyclic(F.hour(start).cast("double"), 24)
    new = {"hour_sin": sine, "hour_cos": cosine, "is_weekend": F.weekday(start).isin(5, 6).cast("int"), "hour_of_day": F.hour(start)}
    reg: Registry = {"hour_sin": ("context", "sine of the hour of the day"), "hour_cos": ("context", "cosine of the hour of the day"), "is_weekend": ("context", "1 on Saturday and Sunday"), "hour_of_day": ("context", "hour of the day that the row describes")}
    return h.withColumns(new), reg


def add_maintenance(h: DataFrame, actions: DataFrame, ts: str = "timestamp", at: str = "action_timestamp", kind: str = "action_type", span: str = "90 day", block: str | None = None) -> tuple[DataFrame, Registry]:
    """Days since the last action and the last reactive one (equal times count), and reactive actions in [t - 90 days, t)."""
    reactive = F.col(kind) == "Reactive"
    done = actions.select("machine_id", micros(at).alias("at"), F.lit(BEFORE).alias("rank"), micros(at).alias("any"), F.when(reactive, micros(at)).alias("reactive"))
    events = done.unionByName(expiring(actions.where(reactive), span, "machine_id", at), allowMissingColumns=True)
    d = among_events(h, events, last={"_any": "any", "_re": "reactive"}, total={"reactive_actions_90d": "n"}, ts=ts, block=block)
    days = lambda c: (micros(ts) - F.col(c)) / 8.64e10
    d = d.withColumns({"days_since_maintenance": days("_any"), "days_since_reactive": days("_re")}).drop("_any", "_re")
    reg: Registry = {"days_since_maintenance": ("maintenance", "days since the last action"), "days_since_reactive": ("maintenance", "days since the last reactive action"), "reactive_actions_90d": ("maintenance", "reactive actions in the 90 days before")}
    return d, reg


def dictionary_frame(spark, reg: Registry, columns: list[str]) -> DataFrame:
    rows = [(i, k, g, t) for i, (k, (g, t)) in enumerate(reg.items()) if k in columns]
    return spark.createDataFrame(rows, "position int, feature string, group string, description string")


def build_features(minutes: DataFrame, actions: DataFrame, cfg: dict, reference_ends: DataFrame | None = None, blocks: tuple[str, str, str | None] | None = ("5 day", "90 day", None)) -> tuple[DataFrame, DataFrame]:
    """(hourly features with regime and in_baseline_period, dictionary).

    ``reference_ends`` (machine_id, reference_end) of a saved baseline keeps recent slices out of the
    baseline period; without it the ends are taken from the minutes given. ``blocks`` cuts a machine's history for
    the windows over minutes, over hours and over events, so that the number of tasks follows the data; it needs
    the regular grid that cleaning makes. None leaves a machine whole; events meet hourly rows, of which a machine has 8,760 a
    year, so they are left whole by default, which spares a pass for the blocks' borders.
    """
    from millrace.operators.baseline import reference_ends as ends_of

    of_minutes, of_hours, of_events = blocks or (None, None, None)
    h, reg = hourly_aggregate(minutes, cfg)
    for step in (add_fleet_relative, lambda d: add_rolling_and_lags(d, cfg, block=of_hours)):
        h, more = step(h)
        reg |= more
    spectral, more = spectral_features(minutes, None, cfg, block=of_minutes)
    reg |= more
    h = h.join(spectral, ["machine_id", "timestamp"], "left")
    for step in (add_context, lambda d: add_maintenance(d, actions, block=of_events)):
        h, more = step(h)
        reg |= more
    ends = reference_ends if reference_ends is not None else ends_of(minutes, cfg["baseline"]["reference_days"])
    h = h.join(ends, "machine_id", "left").withColumn("in_baseline_period", F.col("timestamp") <= F.col("reference_end")).drop("reference_end")
    return h, dictionary_frame(minutes.sparkSession, reg, h.columns)
