"""Folds that leave one machine out, and other row masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def leave_one_machine_out(machines: DataFrame, failures: DataFrame, key: str = "machine_id", mode: str = "failure_mode") -> DataFrame:
    """(fold, test_machine, test_failure_modes, unseen_mode_in_train); folds are numbered by machine.

    A mode is unseen in training when no other machine has it. Modes are counted by machine before anything meets, so
    the result's size is that of the fleet.
    """
    pairs = failures.select(key, mode).distinct()
    only = pairs.groupBy(mode).agg(F.count(F.lit(1)).alias("_machines"))
    per = pairs.join(only, mode).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(mode)), ", ").alias("modes"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("_machines") == 1, F.col(mode)))), ", ").alias("unseen"))
    d = machines.select(key).where(F.col(key).isNotNull()).distinct().join(per, key, "left")
    number = F.row_number().over(Window.orderBy(key)) - 1
    return d.select(number.cast("int").alias("fold"), F.col(key).alias("test_machine"), F.coalesce("modes", F.lit("none (healthy reference)")).alias("test_failure_modes"), F.coalesce("unseen", F.lit("")).alias("unseen_mode_in_train"))


def assign_folds(rows: DataFrame, folds: DataFrame, key: str = "machine_id") -> DataFrame:
    """``rows`` with the fold in which their machine is tested."""
    return rows.join(folds.select(F.col("test_machine").alias(key), F.col("fold").cast("short").alias("fold")), key, "left")


def time_holdout(start: str, ts: str = "timestamp") -> Column:
    return F.col(ts) >= F.lit(start).cast("timestamp_ntz")


def eligible() -> Column:
    """Neither in repair, nor in the baseline period, nor mostly in standby."""
    return F.coalesce(~F.col("in_repair") & ~F.col("in_baseline_period") & (F.col("standby_share") < 0.5), F.lit(False))
