"""Cleaning: regular grid, implausible values out, short gaps filled causally, regimes tagged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.series import blocked, forward_fill, invalidate, reindex_grid, steps_of


def tag_regimes(df: DataFrame, cfg: dict, ts: str = "timestamp", rpm: str = "pump_rpm") -> DataFrame:
    """Adds hour, day_of_week (Monday 0), day_type, is_standby, regime and is_midnight_dip. A missing speed is no standby."""
    h0, h1 = cfg["day_shift_hours"]
    hour, day = F.hour(ts), F.weekday(F.col(ts))
    weekend = day.isin(*cfg["weekend_days"])
    standby = F.coalesce(F.col(rpm) < cfg["standby_rpm_below"], F.lit(False))
    return df.withColumns(
        {
            "hour": hour.cast("byte"),
            "day_of_week": day.cast("byte"),
            "day_type": F.when(weekend, "Weekend").otherwise("Weekday"),
            "is_standby": standby,
            "regime": F.when(standby, "Standby").when(weekend, "Weekend").when(hour.between(h0, h1 - 1), "Day").otherwise("Night"),
            "is_midnight_dip": hour.isin(*cfg["midnight_dip_hours"]),
        }
    )


def regime_agreement(clean: DataFrame, source: DataFrame, label: str = "shift", key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """One row (n, agreement): share of rows, standby apart, whose regime is the source's label."""
    d = clean.select(key, ts, "regime").join(source.select(key, ts, label), [key, ts]).where("regime <> 'Standby'")
    return d.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("regime") == F.col(label)).cast("double")).alias("agreement"))


def clean_telemetry(tel: DataFrame, cfg: dict, write: bool = True, block: str | None = "5 day") -> tuple[DataFrame, dict]:
    """(clean rows on the full grid, log of what each rule changed). Labels and the source's shift are taken out.

    Gaps are filled in blocks of time, so that a machine's history is many tasks; None fills it in one.
    """
    sensors, c = cfg["sensors"], cfg["cleaning"]
    d = tel.drop(*cfg["leakage_columns"], "shift", "day_of_week")
    grid = reindex_grid(d, cfg["validation"]["sampling_interval"])
    inside = invalidate(grid, c["valid_ranges"])
    fill = lambda d, key: forward_fill(d, sensors, c["max_fill_rows"], key=key)
    halo = steps_of(cfg["validation"]["sampling_interval"], c["max_fill_rows"])
    filled = blocked(inside, fill, block, halo) if block else fill(inside, "machine_id")
    filled = filled.withColumn("is_sensor_dropout", F.coalesce("is_sensor_dropout", F.lit(1)).cast("byte")) if "is_sensor_dropout" in filled.columns else filled
    silver = tag_regimes(filled, cfg["regimes"])
    if write:
        at = f"{cfg['paths']['interim_dir']}/silver_telemetry.parquet"
        silver.write.mode("overwrite").partitionBy("machine_id").parquet(at)
        silver = tel.sparkSession.read.parquet(at).select(*silver.columns)
    nulls = lambda df: df.agg(F.sum(sum((F.col(s).isNull().cast("int") for s in sensors), F.lit(0))).alias("n")).first().n or 0
    bad = tel.agg(*(F.count_if((F.col(s) < lo) | (F.col(s) > hi)).alias(s) for s, (lo, hi) in c["valid_ranges"].items()), F.count(F.lit(1)).alias("rows")).first()
    one = silver.agg(F.count(F.lit(1)).alias("rows"), F.count_if("was_missing_row").alias("added"), F.count_if("was_imputed").alias("imputed"), F.array_sort(F.collect_set(F.when(F.col("is_standby"), F.to_date("timestamp").cast("string")))).alias("days")).first()
    log = {
        "rows_in": bad.rows,
        "rows_added_by_reindex": one.added,
        "missing_values_before": nulls(grid),
        "values_invalidated": {s: bad[s] for s in c["valid_ranges"]},
        "rows_imputed": one.imputed,
        "missing_values_after": nulls(silver),
        "regime_minutes": {r.regime: r["count"] for r in silver.groupBy("regime").count().collect()},
        "standby_days": list(one.days),
        "rows_out": one.rows,
    }
    if "shift" in tel.columns:
        log["regime_vs_source_shift_agreement"] = regime_agreement(silver, tel).first().agreement
    return silver, log
