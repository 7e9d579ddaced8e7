"""Rule-based alarms: thresholds on rolling signals that hold for hours, their lead times and false alarms."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import fresh, hours_between, micros
from millrace.operators import sliding
from millrace.operators.series import AFTER, among_events, micros_of, steps_of

#: Name -> (column, sign of the deviation, threshold, statistic of the window).
RULES = {
    "pressure_low": ("z_pressure_bar", -1, 3.0, "median"),
    "flow_low": ("z_flow_lpm", -1, 3.0, "median"),
    "temp_high": ("z_temp_celsius", 1, 3.0, "median"),
    "vibration_high": ("z_vibration_x_g", 1, 3.0, "median"),
    "xy_divergence": ("vib_xy_delta", 1, 0.02, "absmean"),
}


def rule_alarms(df: DataFrame, rules: dict[str, tuple[str, int, float, str]] = RULES, span: str = "6 hour", key: str = "machine_id", ts: str = "timestamp", standby: str | None = "is_standby", block: str | None = "10 day") -> DataFrame:
    """``df`` with a flag for each rule and any_rule; a NULL standby counts as running.

    A rule on vib_xy_delta gets it from the two axes where the column is absent. The windows go by time and reach back
    two spans, so the work is cut into blocks of time with that halo; medians move on by a sorted ring.
    """
    if any(c == "vib_xy_delta" for c, *_ in rules.values()) and "vib_xy_delta" not in df.columns:
        df = df.withColumn("vib_xy_delta", F.col("vibration_x_g") - F.col("vibration_y_g"))
    size = micros_of(span)
    cols = list(dict.fromkeys(c for c, *_ in rules.values()))
    (idle,) = fresh(df, "_idle")
    d = df.withColumn(idle, (F.coalesce(F.col(standby), F.lit(False)) if standby else F.lit(False)).cast("double"))

    def compute(t: np.ndarray, values: list[np.ndarray]) -> dict[str, np.ndarray]:
        lo, hi = sliding.last_span(t, size)
        running, made = values[-1] == 0.0, {}
        for n, (c, sign, limit, how) in rules.items():
            v = values[cols.index(c)]
            frames = sliding.Frames(v)
            count = frames.count(lo, hi)
            if how == "absmean":
                with np.errstate(invalid="ignore", divide="ignore"):
                    signal = np.abs(((frames.s[hi] - frames.s[lo]) / count).astype(float) + frames.centre)
            else:
                signal = sign * sliding.quantiles(v, lo, hi)
            made[n] = sliding.held((count > 0) & (signal > limit), lo, hi) & running
        return made | {"any_rule": np.logical_or.reduce(list(made.values()))}

    reach = steps_of(span, 2)
    return sliding.over_runs(d, [*cols, idle], compute, dict.fromkeys([*rules, "any_rule"], "boolean"), key, ts, reach, 0, block, reach, df.columns)


def naive_alarm(df: DataFrame, col: str, k: float = 3.0, span: str = "6 hour", key: str = "machine_id", ts: str = "timestamp", out: str = "naive_low", block: str | None = "10 day") -> DataFrame:
    """Flag: below mean less k deviations of the machine's whole history, held for the span."""
    mean, spread = fresh(df, "_m", "_s")
    m = df.groupBy(key).agg(F.avg(col).alias(mean), F.stddev_samp(col).alias(spread))
    return sliding.flag_held(df.join(m, key), F.col(col) < F.col(mean) - F.col(spread) * k, span, out, key, ts, block).drop(mean, spread)


def lead_times(alarms: DataFrame, failures: DataFrame, rules: list[str], days: int = 30, key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """(event_id, key, failure_mode, window_h, hours of warning by rule and any_rule, first_rule): from the first alarm in the days before the failure.

    An event without one has 0 hours and first_rule '-'. The first alarm at or after the first of these days comes by
    one sorted window over events and alarms together; no event meets all alarms of its machine.
    """
    names = [*rules, "any_rule"]
    hit = alarms.where("any_rule").select(F.col(key), micros(ts).alias("at"), F.lit(AFTER).alias("rank"), *(F.when(F.col(n), F.col(ts)).alias(n) for n in names))
    f = failures.select("event_id", key, "failure_mode", "failure_timestamp", "degradation_start_timestamp", (F.col("failure_timestamp") - F.expr(f"interval {days} days")).alias("_from"))
    d = among_events(f, hit, first={n: n for n in names}, key=key, ts="_from")
    d = d.withColumns({n: F.when(F.col(n) < F.col("failure_timestamp"), hours_between(F.col("failure_timestamp"), F.col(n))).otherwise(0.0) for n in names})
    best = F.greatest(*rules) if len(rules) > 1 else F.col(rules[0])
    first = F.coalesce(*(F.when(F.col(n) == best, F.lit(n)) for n in rules))
    return d.select("event_id", key, "failure_mode", hours_between(F.col("failure_timestamp"), F.col("degradation_start_timestamp")).alias("window_h"), *names, F.when(F.col("any_rule") > 0, first).otherwise("-").alias("first_rule"))


def false_alarms(alarms: DataFrame, flag: str, healthy: Column, per_hour: float, standby: str = "is_standby", key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """One row: healthy hours, alarm hours in them, those on weekends, and machines with an alarm in standby."""
    on = F.col(flag)
    return alarms.agg(
        (F.count_if(healthy) / per_hour).alias("healthy_hours"),
        (F.count_if(healthy & on) / per_hour).alias("alarm_hours"),
        (F.count_if(healthy & on & (F.weekday(F.col(ts)) >= 5)) / per_hour).alias("weekend_alarm_hours"),
        F.count_distinct(F.when(F.col(standby) & on, F.col(key))).alias("standby_machines"),
    )
