"""Targets from failure events: remaining life (capped, censored), warning and mode labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import hours_between, micros
from millrace.operators.series import AFTER, among_events


def build_targets(rows: DataFrame, failures: DataFrame, cfg: dict, data_end: DataFrame | None = None, grain: str = "1 hour", key: str = "machine_id", ts: str = "timestamp", block: str | None = None) -> DataFrame:
    """Nine target columns for each (key, ts), which stamps the end of the period ``grain`` before it.

    The next failure is the first at or after ts, the previous one the last before it; both come by
    one sorted window over rows and events together. ``data_end`` (key, data_end) bounds what was observed; by default the last
    row of each key. Rows before the end of the last repair are in repair: their remaining life and warning are unknown.
    """
    t = cfg["targets"]
    cap, horizon = float(t["rul_cap_hours"]), float(t["warning_horizon_hours"])
    event = F.struct(F.col("failure_timestamp").alias("at"), F.col("event_id").alias("id"), F.col("degradation_start_timestamp").alias("start"), F.col("failure_mode").alias("mode"), F.col("downtime_hours").cast("double").alias("down"))
    f = failures.select(key, micros("failure_timestamp").alias("at"), F.lit(AFTER).alias("rank"), event.alias("event"), F.lit(1).alias("n"))
    d = among_events(rows.select(key, ts), f, last={"previous": "event"}, first={"next": "event"}, total={"life_cycle": "n"}, key=key, ts=ts, block=block)
    end = F.max(ts).over(Window.partitionBy(key))
    if data_end is not None:
        d = d.join(data_end.select(key, F.col("data_end").alias("_end")), key, "left")
        end = F.col("_end")
    begin = F.col(ts) - F.expr(f"interval {grain}")
    htf = hours_between(F.col("next.at"), F.col(ts))
    bound = hours_between(end, F.col(ts))
    none = F.col("next").isNull()
    d = d.withColumns({"_htf": htf, "_bound": bound})
    until = F.col("previous.at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("previous.down") * 3600).cast("decimal(18,6)"))
    repair = F.coalesce(F.col("previous").isNotNull() & (begin < until), F.lit(False))
    rul = F.when(none, F.when(F.col("_bound") >= cap, F.lit(cap))).otherwise(F.least("_htf", F.lit(cap)))
    warn = F.when(none, F.when(F.col("_bound") >= horizon, F.lit(0.0))).otherwise((F.col("_htf") <= horizon).cast("double"))
    label = F.when(repair, "repair").when(~none & (begin >= F.col("next.start")), F.col("next.mode")).otherwise("healthy")
    return d.select(
        key,
        ts,
        F.col("life_cycle").cast("int").alias("life_cycle"),
        F.col("next.id").alias("next_event_id"),
        F.col("_htf").alias("hours_to_failure"),
        label.alias("failure_mode_label"),
        repair.alias("in_repair"),
        F.when(~repair, rul).alias("rul_hours"),
        rul.isNull().alias("rul_censored"),
        F.when(~repair, warn).cast("float").alias("fail_within_h"),
        (~label.isin("healthy", "repair")).alias("is_degrading"),
    )
