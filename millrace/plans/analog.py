"""Telemetry, failures and maintenance made from the events table, for queries on the test tables; and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = ["pump_wear", "valve_leakage", "contamination", "cylinder_drift"]
SENSORS = ["pressure_bar", "temp_celsius", "flow_lpm", "vibration_x_g", "vibration_y_g", "pump_rpm"]


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("k", k)
    v = F.col("value")
    return e.select(
        "event_id",
        F.format_string("HPU_%02d", F.col("user_id") % 10 + 1).alias("machine_id"),
        F.col("ts").alias("timestamp"),
        v.alias("pressure_bar"),
        ((v + F.col("k")) / 2).alias("temp_celsius"),
        F.col("k").alias("flow_lpm"),
        (v / 100).alias("vibration_x_g"),
        F.when(F.col("event_type") == "error", F.col("k") / 100).otherwise(v / 100).alias("vibration_y_g"),
        (F.col("k") * 6 + 1000).alias("pump_rpm"),
        F.when(F.col("k") % 7 == 0, 1).otherwise(0).alias("is_sensor_dropout"),
        F.when(F.col("k") % 10 == 3, "Lunch").when(F.hour("ts").between(8, 19), "Day").otherwise("Night").alias("shift"),
        F.weekday("ts").alias("day_of_week"),
        "event_type",
    )


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("flow_lpm").cast("int")
    d = telemetry(spark, sf_dir).where((F.col("event_type") == "error") & (F.col("pressure_bar") >= 200))
    return d.select(F.col("event_id").cast("string").alias("event_id"), "machine_id", F.col("timestamp").alias("failure_timestamp"), (F.col("timestamp") - F.expr("interval 48 hours")).alias("degradation_start_timestamp"), F.element_at(F.array(*map(F.lit, MODES)), k % 4 + 1).alias("failure_mode"), (k % 24 + 1).cast("double").alias("downtime_hours"))


def maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("flow_lpm").cast("int")
    d = telemetry(spark, sf_dir).where((F.col("event_type") == "purchase") & (F.col("pressure_bar") >= 150))
    return d.select(F.col("event_id").cast("string").alias("action_id"), "machine_id", F.col("timestamp").alias("action_timestamp"), F.when(k % 2 == 1, "Reactive").otherwise("Preventive").alias("action_type"), F.element_at(F.array(*map(F.lit, ["Pump", "Valve", "None"])), k % 3 + 1).alias("component_replaced"), F.col("pressure_bar").alias("cost_usd"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means by machine and hour, stamped with the hour's begin."""
    t = telemetry(spark, sf_dir)
    return t.groupBy("machine_id", F.window("timestamp", "1 hour")["start"].alias("t")).agg(*(F.round(F.avg(s), 9).alias(s) for s in SENSORS)).withColumnRenamed("t", "timestamp")


TEL = """tel as (select event_id, printf('HPU_%02d', user_id % 10 + 1) as machine_id, ts as "timestamp", value as pressure_bar,
  (value + k) / 2 as temp_celsius, k as flow_lpm, value / 100 as vibration_x_g,
  case when event_type = 'error' then k / 100 else value / 100 end as vibration_y_g, k * 6 + 1000 as pump_rpm,
  case when cast(k as int) % 7 = 0 then 1 else 0 end as is_sensor_dropout,
  case when cast(k as int) % 10 = 3 then 'Lunch' when hour(ts) between 8 and 19 then 'Day' else 'Night' end as shift,
  isodow(ts) - 1 as day_of_week, event_type
  from (select *, cast(regexp_extract(props, '"k": *([0-9]+)', 1) as double) as k from events))"""

FAIL = """fail as (select cast(event_id as varchar) as event_id, machine_id, "timestamp" as failure_timestamp, "timestamp" - interval 48 hour as degradation_start_timestamp,
  case cast(flow_lpm as int) % 4 when 0 then 'pump_wear' when 1 then 'valve_leakage' when 2 then 'contamination' else 'cylinder_drift' end as failure_mode,
  cast(cast(flow_lpm as int) % 24 + 1 as double) as downtime_hours from tel where event_type = 'error' and pressure_bar >= 200)"""

ACT = """act as (select cast(event_id as varchar) as action_id, machine_id, "timestamp" as action_timestamp,
  case when cast(flow_lpm as int) % 2 = 1 then 'Reactive' else 'Preventive' end as action_type,
  case cast(flow_lpm as int) % 3 when 0 then 'Pump' when 1 then 'Valve' else 'None' end as component_replaced,
  pressure_bar as cost_usd from tel where event_type = 'purchase' and pressure_bar >= 150)"""

CELL = """cell as (select machine_id, date_trunc('hour', "timestamp") as "timestamp", """ + ", ".join(f"round(avg({s}), 9) as {s}" for s in SENSORS) + """
  from tel group by all)"""

GRID = """grid as (select g.machine_id, g."timestamp", """ + ", ".join(f"c.{s}" for s in SENSORS) + """, c.machine_id is null as was_missing_row
  from (select machine_id, unnest(generate_series(min("timestamp"), max("timestamp"), interval 1 hour)) as "timestamp" from cell group by machine_id) g
  left join cell c on c.machine_id = g.machine_id and c."timestamp" = g."timestamp")"""
