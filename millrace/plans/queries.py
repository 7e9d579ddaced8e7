"""Queries by name on the test tables, each with SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import DEFAULTS
from millrace.functions.columns import any_null, hours_between
from millrace.operators import alarms, eda, information, quality, regime, screening, series, splits, targets
from millrace.operators import features as feat
from millrace.operators.baseline import RegimeBaseline, baseline_cells
from millrace.plans import analog as a

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

RANGES = {s: list(map(float, r)) for s, r in DEFAULTS["cleaning"]["valid_ranges"].items()}
T = '"timestamp"'
SIGNALS = DEFAULTS["baseline"]["signals"]


def query(sql: str | None = None, *parts: str) -> Callable[[Query], Query]:
    """Register a function under its name, with SQL over the named common tables."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = ("with " + ",\n".join(parts) + "\n" if parts else "") + sql
        return f

    return put


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def grid(spark: SparkSession, d: str) -> DataFrame:
    return series.reindex_grid(a.cells(spark, d), "1 hour")


def r6(e: str, name: str) -> str:
    return f"round({e}, 6) as {name}"


TELG = (a.TEL,)
CELLG = (a.TEL, a.CELL)
GRIDG = (a.TEL, a.CELL, a.GRID)
# The grid without implausible values, with gaps of up to three hours filled: the clean series.
INSIDE = "inside as (select machine_id, " + T + ", was_missing_row, " + ", ".join(f"case when {s} < {lo} or {s} > {hi} then null else {s} end as {s}" for s, (lo, hi) in RANGES.items()) + " from grid)"
FILL = f"filled as (select machine_id, {T}, was_missing_row, " + ", ".join(f"coalesce({s}, last_value({s} ignore nulls) over (partition by machine_id order by {T} rows between 3 preceding and current row)) as {s}" for s in RANGES) + " from inside)"
TAGS = f"""hour({T}) as hour, isodow({T}) - 1 as day_of_week, case when isodow({T}) >= 6 then 'Weekend' else 'Weekday' end as day_type,
  coalesce(pump_rpm < 1200, false) as is_standby,
  case when coalesce(pump_rpm < 1200, false) then 'Standby' when isodow({T}) >= 6 then 'Weekend' when hour({T}) between 8 and 19 then 'Day' else 'Night' end as regime"""
CLEAN = f"clean as (select *, {TAGS} from filled)"
CLEANG = (*GRIDG, INSIDE, FILL, CLEAN)


def clean(spark: SparkSession, d: str) -> DataFrame:
    g = series.forward_fill(series.invalidate(grid(spark, d), RANGES), list(RANGES), 3)
    return regime.tag_regimes(g, DEFAULTS["regimes"])


# Scans, projections, filters


@query(f"select event_id, machine_id, pressure_bar, case when flow_lpm > 50 then 'high' else 'low' end as flow_class from tel where event_type in ('error', 'purchase') and pressure_bar between 10 and 200", *TELG)
def scan_project_filter(spark, d):
    t = a.telemetry(spark, d).where(F.col("event_type").isin("error", "purchase") & F.col("pressure_bar").between(10, 200))
    return t.select("event_id", "machine_id", "pressure_bar", F.when(F.col("flow_lpm") > 50, "high").otherwise("low").alias("flow_class"))


@query("select l_orderkey, l_linenumber, l_extendedprice from lineitem where l_quantity > 45 and l_discount between 0.05 and 0.07")
def pushed_filter(spark, d):
    return spark.read.parquet(f"{d}/lineitem.parquet").where("l_quantity > 45 and l_discount between 0.05 and 0.07").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(f"select machine_id, {T}, " + ", ".join(r6(s, s) for s in RANGES) + ", " + " + ".join(f"coalesce(cast({s} < {lo} or {s} > {hi} as int), 0)" for s, (lo, hi) in RANGES.items()) + " as n_invalid_sensors from grid", *GRIDG)
def invalidate_ranges(spark, d):
    g = series.invalidate(grid(spark, d), RANGES)
    return rounded(g.select("machine_id", "timestamp", *RANGES, F.col("n_invalid_sensors").cast("int").alias("n_invalid_sensors")))


SQL["invalidate_ranges"] = "with " + ",\n".join((*GRIDG, INSIDE)) + f" select i.machine_id, i.{T}, " + ", ".join(r6(f"i.{s}", s) for s in RANGES) + ", " + " + ".join(f"coalesce(cast(g.{s} < {lo} or g.{s} > {hi} as int), 0)" for s, (lo, hi) in RANGES.items()) + f" as n_invalid_sensors from inside i join grid g on g.machine_id = i.machine_id and g.{T} = i.{T}"


@query(f"select machine_id, {T}, hour, day_of_week, day_type, is_standby, regime, hour = 0 as is_midnight_dip from clean", *CLEANG)
def regime_tagging(spark, d):
    return clean(spark, d).select("machine_id", "timestamp", F.col("hour").cast("long"), F.col("day_of_week").cast("long"), "day_type", "is_standby", "regime", "is_midnight_dip")


@query(f"select machine_id, {T}, round(sin(2 * pi() * hour({T} - interval 1 hour) / 24), 6) + 0.0 as hour_sin, round(cos(2 * pi() * hour({T} - interval 1 hour) / 24), 6) + 0.0 as hour_cos, cast(isodow({T} - interval 1 hour) >= 6 as bigint) as is_weekend, hour({T} - interval 1 hour) as hour_of_day from cell", *CELLG)
def context_cyclic(spark, d):
    h, _ = feat.add_context(a.cells(spark, d).select("machine_id", "timestamp"))
    return rounded(h.withColumns({"is_weekend": F.col("is_weekend").cast("long"), "hour_of_day": F.col("hour_of_day").cast("long")}))


@query("select count(*) as n, count(*) filter (where \"timestamp\" >= timestamp '2024-01-15') as n_holdout from tel", *TELG)
def time_holdout(spark, d):
    return a.telemetry(spark, d).agg(F.count(F.lit(1)).alias("n"), F.count_if(splits.time_holdout("2024-01-15")).alias("n_holdout"))


# Validation


def spoiled(spark: SparkSession, d: str) -> DataFrame:
    """The telemetry analog with a fault of each kind on some rows."""
    t, e = a.telemetry(spark, d), F.col("event_id")
    new = {"machine_id": F.when(e % 17 == 0, "PUMP_1").when(e % 101 == 0, None).otherwise(F.col("machine_id")), "timestamp": F.when(e % 19 != 0, F.col("timestamp")), "is_sensor_dropout": F.when(e % 23 == 0, 2).otherwise(F.col("is_sensor_dropout")), "day_of_week": F.when(e % 29 == 0, 9).otherwise(F.col("day_of_week"))}
    sensors = {s: F.when(e % (31 + 2 * i) == 0, "high").otherwise(F.col(s).cast("string")) for i, s in enumerate(a.SENSORS)}
    return t.withColumns(new | sensors)


_PATTERN, _SHIFTS = DEFAULTS["validation"]["machine_id_pattern"], DEFAULTS["validation"]["shifts"]


@query(f"""select coalesce(r, '-') as reason, count(*) as n from (select unnest(case when len(rs) = 0 then [null] else rs end) as r from (select list_filter([
  case when m is null then 'machine_id: not_nullable' end, case when not regexp_matches(m, '{_PATTERN}') then 'machine_id: str_matches(''{_PATTERN}'')' end, case when event_id % 19 = 0 then 'timestamp: not_nullable' end,
  {", ".join(f"case when event_id % {31 + 2 * i} = 0 then '{s}: double' end" for i, s in enumerate(a.SENSORS))},
  case when event_id % 23 = 0 then 'is_sensor_dropout: isin([0, 1])' end, case when shift not in ('Day', 'Night', 'Weekend') then 'shift: isin([''Day'', ''Night'', ''Weekend''])' end, case when event_id % 29 = 0 then 'day_of_week: in_range(0, 6)' end], lambda x: x is not null) as rs
  from (select *, case when event_id % 17 = 0 then 'PUMP_1' when event_id % 101 = 0 then null else machine_id end as m from tel))) group by 1""", *TELG)
def contract_quarantine(spark, d):
    """Rows by broken rule ('-': none), from the valid rows and the reasons of the quarantined ones."""
    good, bad = quality.split_valid(spoiled(spark, d), quality.telemetry_rules(DEFAULTS))
    r = bad.select(F.explode(F.split(quality.REASON, "; ")).alias("reason")).unionByName(good.select(F.lit("-").alias("reason")))
    return r.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("""select event_id, concat_ws('; ', case when event_id is null then 'event_id: not_nullable' end, case when n <> 1 or event_id is null then 'event_id: field_uniqueness' end, case when down <= 0 or down is null then 'downtime_hours: greater_than(0)' end,
  case when cost < 0 then 'repair_cost_usd: greater_than_or_equal_to(0)' end, case when st >= failure_timestamp then 'failure_timestamp: degradation must start before failure' end, case when mode = 'rust' then 'mode' end) as reasons from
  (select *, count(*) over (partition by event_id) as n from (select case when k % 9 = 0 then null when k % 7 = 0 then 'again' else event_id end as event_id, failure_timestamp, case when k % 5 = 0 then failure_timestamp + interval 1 hour else degradation_start_timestamp end as st,
  case when k % 4 = 0 then -1.0 when k % 11 = 0 then null else downtime_hours end as down, case when k % 3 = 0 then null else 10.0 - k % 8 * 2 end as cost, case when k % 6 = 0 then 'rust' else failure_mode end as mode from (select *, cast(event_id as bigint) as k from fail)))""", a.TEL, a.FAIL)
def failure_contract(spark, d):
    """Reasons of each failure event against the contract of failures, on events with faults of each kind."""
    f, k = a.failures(spark, d), F.col("event_id").cast("long")
    f = f.withColumn("k", k).withColumns({"event_id": F.when(F.col("k") % 9 == 0, None).when(F.col("k") % 7 == 0, "again").otherwise(F.col("event_id")), "degradation_start_timestamp": F.when(F.col("k") % 5 == 0, F.col("failure_timestamp") + F.expr("interval 1 hour")).otherwise(F.col("degradation_start_timestamp")), "downtime_hours": F.when(F.col("k") % 4 == 0, -1.0).when(F.col("k") % 11 == 0, None).otherwise(F.col("downtime_hours")), "repair_cost_usd": F.when(F.col("k") % 3 != 0, F.lit(10.0) - F.col("k") % 8 * 2), "failure_mode": F.when(F.col("k") % 6 == 0, "rust").otherwise(F.col("failure_mode"))})
    short = F.transform("reasons", lambda x: F.when(x.startswith("failure_mode: "), "mode").otherwise(x))
    order = F.array_append(F.filter(short, lambda x: x != "mode"), F.when(F.array_contains(short, "mode"), "mode"))
    return quality.with_reasons(f, quality.failure_rules(DEFAULTS)).select("event_id", F.concat_ws("; ", order).alias("reasons"))


@query("""select action_id, concat_ws('; ', case when n <> 1 then 'action_id: field_uniqueness' end, case when action_type = 'Guess' then 'action_type' end, case when component_replaced is null then 'component_replaced' end, case when cost < 0 then 'cost_usd: greater_than_or_equal_to(0)' end) as reasons from
  (select *, count(*) over (partition by action_id) as n from (select case when k % 7 = 0 then 'again' else action_id end as action_id, case when k % 4 = 0 then 'Guess' else action_type end as action_type, case when k % 5 = 0 then null else component_replaced end as component_replaced, case when k % 3 = 0 then -cost_usd else cost_usd end as cost from (select *, cast(action_id as bigint) as k from act)))""", a.TEL, a.ACT)
def maintenance_contract(spark, d):
    m = a.maintenance(spark, d).withColumn("k", F.col("action_id").cast("long"))
    m = m.withColumns({"action_id": F.when(F.col("k") % 7 == 0, "again").otherwise(F.col("action_id")), "action_type": F.when(F.col("k") % 4 == 0, "Guess").otherwise(F.col("action_type")), "component_replaced": F.when(F.col("k") % 5 != 0, F.col("component_replaced")), "cost_usd": F.when(F.col("k") % 3 == 0, -F.col("cost_usd")).otherwise(F.col("cost_usd"))})
    short = F.transform("reasons", lambda x: F.when(x.startswith("action_type: "), "action_type").when(x.startswith("component_replaced: "), "component_replaced").otherwise(x))
    return quality.with_reasons(m, quality.maintenance_rules(DEFAULTS)).select("action_id", F.concat_ws("; ", short).alias("reasons"))


@query(f"""select machine_id, {T}, count(*) as n_reasons from (select machine_id, {T}, row_number() over (partition by machine_id, {T} order by event_id) as nth from
  (select machine_id, date_trunc('hour', {T}) as {T}, event_id from tel)) where nth > 1 group by all""", *TELG)
def duplicate_quarantine(spark, d):
    t = a.telemetry(spark, d).withColumn("timestamp", F.window("timestamp", "1 hour")["start"]).select("machine_id", "timestamp", "event_id")
    _, again = quality.dedupe_keep_first(t, ["machine_id", "timestamp"], ["event_id"])
    return again.groupBy("machine_id", "timestamp").agg(F.count(quality.REASON).alias("n_reasons"))


@query(f"""select event_id, machine_id, {T} from (select *, row_number() over (partition by machine_id, {T} order by event_id) as nth from
  (select machine_id, date_trunc('hour', {T}) as {T}, event_id from tel)) where nth = 1""", *TELG)
def dedupe_keep_first(spark, d):
    t = a.telemetry(spark, d).withColumn("timestamp", F.window("timestamp", "1 hour")["start"]).select("event_id", "machine_id", "timestamp")
    return quality.dedupe_keep_first(t, ["machine_id", "timestamp"], ["event_id"])[0]


@query("""select event_id, machine_id, failure_mode, concat_ws('; ', case when downtime_hours > 20 then 'downtime' end, case when failure_mode = 'pump_wear' then 'mode' end) as reasons from fail""", a.TEL, a.FAIL)
def reason_rules(spark, d):
    rules = [quality.Rule("downtime_hours", "limit", F.col("downtime_hours") <= 20), quality.Rule("failure_mode", "allowed", F.col("failure_mode") != "pump_wear")]
    f = quality.with_reasons(a.failures(spark, d), rules)
    short = F.transform("reasons", lambda x: F.when(x.startswith("downtime"), "downtime").otherwise("mode"))
    return f.select("event_id", "machine_id", "failure_mode", F.array_join(short, "; ").alias("reasons"))


@query("select " + ", ".join(f"count(*) filter (where {s} < {lo} or {s} > {hi}) as {s}" for s, (lo, hi) in RANGES.items()) + " from tel", *TELG)
def range_report(spark, d):
    return quality.range_counts(a.telemetry(spark, d), RANGES)


@query("select count(*) filter (where vibration_x_g = 0.05) as vibration_x_g, count(*) filter (where vibration_y_g = 0.05) as vibration_y_g, count(*) as n_rows from tel", *TELG)
def floor_report(spark, d):
    return quality.floor_counts(a.telemetry(spark, d), DEFAULTS["validation"]["sensor_floor"])


@query("select sensor, count(*) filter (where v < lo) as n_below, count(*) filter (where v > hi) as n_above, round(min(v), 6) as lowest, round(max(v), 6) as highest, round(avg(bad) filter (where v < lo or v > hi), 6) as share_degraded from (" + " union all ".join(f"select '{s}' as sensor, {s} as v, {lo} as lo, {hi} as hi, cast(event_type = 'error' as double) as bad from tel" for s, (lo, hi) in RANGES.items()) + ") group by sensor", *TELG)
def range_profile(spark, d):
    return rounded(quality.range_profile(a.telemetry(spark, d), RANGES, F.col("event_type") == "error"))


@query(f'select machine_id, min({T}) as "first", max({T}) as "last", count(*) as n, cast(floor((epoch_us(max({T})) - epoch_us(min({T}))) / 3600000000) as bigint) + 1 as n_expected from cell group by 1', *CELLG)
def expected_rows(spark, d):
    return quality.expected_rows(a.cells(spark, d), "1 hour")


@query("""select id, dimension, rows_affected from (select unnest(['DQ-01', 'DQ-02', 'DQ-03', 'DQ-04', 'DQ-05', 'DQ-06', 'DQ-07', 'DQ-08', 'DQ-09']) as id, unnest(['completeness', 'validity', 'validity', 'context', 'redundancy', 'label', 'label', 'coverage', 'schema']) as dimension,
  unnest([count(*) filter (where is_sensor_dropout = 1), count(*) filter (where pressure_bar > 350), count(*) filter (where temp_celsius < 10), count(*) filter (where pump_rpm = 1000), count(*) filter (where vibration_x_g = vibration_y_g),
  (select count(*) from fail where failure_timestamp = date_trunc('day', failure_timestamp)), 0, (select count(*) from act, (select min("timestamp") as t0, max("timestamp") as t1 from tel) where not action_timestamp between t0 and t1 + interval 1 day), 2]) as rows_affected from tel)""", a.TEL, a.FAIL, a.ACT)
def issue_register(spark, d):
    r = quality.issue_register(a.telemetry(spark, d), a.failures(spark, d), a.maintenance(spark, d), DEFAULTS)
    return r.select("id", "dimension", "rows_affected")


@query(f"select count(*) filter (where was_missing_row) as n_missing, count(*) filter (where was_missing_row <> (isodow({T}) = 1)) as n_mismatch from grid", *GRIDG)
def dropout_flag_mismatch(spark, d):
    g = grid(spark, d).withColumn("is_sensor_dropout", (F.weekday("timestamp") == 0).cast("int"))
    return quality.dropout_mismatch(g, list(RANGES))


@query("select " + ", ".join(f"count(*) filter (where {s} is null) as {s}" for s in RANGES) + ", count(*) filter (where was_missing_row or (" + " or ".join(f"{s} is null" for s in RANGES) + ")) as rows_any_null, count(*) filter (where not was_missing_row and (" + " or ".join(f"{s} is null" for s in RANGES) + ")) as rows_partly_null from inside", *GRIDG, INSIDE)
def null_profile(spark, d):
    return quality.null_profile(series.invalidate(grid(spark, d), RANGES), list(RANGES))


@query(f"select machine_id, count(*) filter (where epoch_us({T}) - epoch_us(p) > 3600000000) as n_gaps, count(*) filter (where second({T}) <> 0) as n_off_grid from (select *, lag({T}) over (partition by machine_id order by {T}) as p from cell) group by machine_id", *CELLG)
def gap_report(spark, d):
    return quality.gap_report(a.cells(spark, d), "1 hour")


@query(f"select (epoch_us({T}) - epoch_us(p)) / 1e6 as seconds, count(*) as n from (select *, lag({T}) over (partition by machine_id order by {T}) as p from cell) where p is not null group by 1", *CELLG)
def interval_histogram(spark, d):
    return quality.interval_histogram(a.cells(spark, d))


@query("select o_orderkey, o_custkey, 'orphan' as kind from orders anti join (select * from customer where c_custkey % 3 <> 0) c on c_custkey = o_custkey union all select o_orderkey, o_custkey, 'known' from orders semi join (select * from customer where c_custkey % 3 <> 0) c on c_custkey = o_custkey")
def referential_semi_anti(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_custkey")
    c = spark.read.parquet(f"{d}/customer.parquet").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("o_custkey"))
    good, bad = quality.referential_split(o, c, "o_custkey")
    return good.withColumn("kind", F.lit("known")).unionByName(bad.drop(quality.REASON).withColumn("kind", F.lit("orphan"))).select("o_orderkey", "o_custkey", "kind")


@query(f"select count(*) filter (where moved between t0 and t1 + interval 1 day) as n_inside, count(*) as n_events from (select action_timestamp + to_days(cast(cast(action_id as bigint) % 5 * 4 - 8 as int)) as moved from act), (select min({T}) as t0, max({T}) as t1 from tel)", a.TEL, a.ACT)
def coverage_window(spark, d):
    """Actions, some of them moved by days, against the telemetry's period."""
    shift = F.make_dt_interval((F.col("action_id").cast("long") % 5 * 4 - 8).cast("int"))
    return quality.coverage(a.maintenance(spark, d).withColumn("moved", F.col("action_timestamp") + shift), "moved", a.telemetry(spark, d))


# Series


@query(f"select machine_id, {T}, " + ", ".join(r6(s, s) for s in a.SENSORS) + ", was_missing_row from grid", *GRIDG)
def grid_reindex(spark, d):
    return rounded(grid(spark, d).select("machine_id", "timestamp", *a.SENSORS, "was_missing_row"))


@query(f"select f.machine_id, f.{T}, " + ", ".join(r6(f"f.{s}", s) for s in RANGES) + ", " + " or ".join(f"(i.{s} is null and f.{s} is not null)" for s in RANGES) + f" as was_imputed from filled f join inside i on i.machine_id = f.machine_id and i.{T} = f.{T}", *GRIDG, INSIDE, FILL)
def ffill_limit(spark, d):
    g = series.forward_fill(series.invalidate(grid(spark, d), RANGES), list(RANGES), 3)
    return rounded(g.select("machine_id", "timestamp", *RANGES, "was_imputed"))


@query(f"select f.machine_id, f.{T}, " + ", ".join(r6(f"f.{s}", s) for s in RANGES) + f" from filled f", *GRIDG, INSIDE, FILL)
def ffill_blocked(spark, d):
    """The same fill over days with a halo of three hours, so that a long history of one machine is many tasks."""
    g = series.invalidate(grid(spark, d), RANGES)
    return rounded(series.blocked(g, lambda x, k: series.forward_fill(x, list(RANGES), 3, key=k), "1 day", "3 hour").select("machine_id", "timestamp", *RANGES))


ISLAND = f"""isl as (select machine_id, {T}, state, sum(c) over (partition by machine_id order by {T}) as island from (select machine_id, {T}, was_missing_row as state,
  coalesce(cast(was_missing_row <> lag(was_missing_row) over (partition by machine_id order by {T}) as int), 1) as c from grid))"""


@query(f"select machine_id, cast(island as bigint) as island, state, min({T}) as start, max({T}) as stop, count(*) as n from isl group by machine_id, island, state", *GRIDG, ISLAND)
def gaps_islands(spark, d):
    return series.islands(grid(spark, d), F.col("was_missing_row"))


@query(f"""select machine_id, max(n) as longest_run from (select machine_id, island, count(*) as n from (select machine_id, sum(c) over (partition by machine_id order by {T}) as island from
  (select machine_id, {T}, coalesce(cast(r <> lag(r) over (partition by machine_id order by {T}) as int), 1) as c from (select machine_id, {T}, cast(round(pump_rpm / 200) as int) as r from grid))) group by all) group by machine_id""", *GRIDG)
def longest_flat_run(spark, d):
    g = grid(spark, d).withColumn("r", F.round(F.col("pump_rpm") / 200).cast("int"))
    return series.longest_flat_run(g, "r")


@query(f"""select machine_id, cast(sum(m) as bigint) as n_flagged, round(sum(cast(m = 1 and p = 0 and q = 0 as double)) / nullif(sum(m), 0), 6) as isolated_share from (select machine_id, m, lag(m, 1, 0) over w as p, lead(m, 1, 0) over w as q
  from (select machine_id, {T}, coalesce(cast(pressure_bar > 60 as int), 0) as m from grid) window w as (partition by machine_id order by {T})) group by machine_id""", *GRIDG)
def isolated_share(spark, d):
    return rounded(series.isolated_share(grid(spark, d), F.col("pressure_bar") > 60))


@query(f"""select machine_id, {T}, coalesce(dev > 3.0 * 1.4826 * nullif(mad, 0), false) as is_outlier from (select *, case when count(dev) over w >= 3 then quantile_cont(dev, 0.5) over w end as mad from
  (select *, abs(pressure_bar - m) as dev from (select *, case when count(pressure_bar) over w >= 3 then quantile_cont(pressure_bar, 0.5) over w end as m from grid window w as (partition by machine_id order by {T} rows between 3 preceding and 3 following)))
  window w as (partition by machine_id order by {T} rows between 3 preceding and 3 following))""", *GRIDG)
def hampel_filter(spark, d):
    return series.hampel(grid(spark, d), "pressure_bar", window=7, k=3.0, least=3).select("machine_id", "timestamp", "is_outlier")


@query(f"""select machine_id, {T}, round(case when pressure_bar is not null then pressure_bar when n - i <= 2 or j - n <= 2 then coalesce(p + (q - p) * (n - i) / (j - i), p, q) end, 6) as interpolated from (select *,
  last_value(pressure_bar ignore nulls) over b as p, first_value(pressure_bar ignore nulls) over f as q, last_value(pos ignore nulls) over b as i, first_value(pos ignore nulls) over f as j from
  (select *, case when pressure_bar is not null then n end as pos from (select *, row_number() over (partition by machine_id order by {T}) as n from grid))
  window b as (partition by machine_id order by {T} rows between unbounded preceding and current row), f as (partition by machine_id order by {T} rows between current row and unbounded following))""", *GRIDG)
def interpolate_both(spark, d):
    return rounded(series.interpolate_both(grid(spark, d), "pressure_bar", 2).select("machine_id", "timestamp", "interpolated"))


@query(f"""select machine_id, {T}, round(case when count(pressure_bar) over w >= 15 then quantile_cont(pressure_bar, 0.5) over w end, 6) as rolling_median from grid window w as (partition by machine_id order by {T} rows between 14 preceding and current row)""", *GRIDG)
def rolling_median(spark, d):
    return rounded(series.trailing_median(grid(spark, d), "pressure_bar", 15).select("machine_id", "timestamp", "rolling_median"))


W6 = f"partition by machine_id order by {T} rows between 5 preceding and current row"


@query(f"""select machine_id, {T}, """ + ", ".join(f"round(case when count(pressure_bar) over w >= 3 then {fn} over w end, 6) as pressure_bar_roll6h_{n}" for n, fn in (("mean", "avg(pressure_bar)"), ("std", "stddev_samp(pressure_bar)"), ("min", "min(pressure_bar)"), ("max", "max(pressure_bar)"), ("slope", "regr_slope(pressure_bar, row)"))) + f" from (select *, cast(row_number() over (partition by machine_id order by {T}) as double) as row from grid) window w as ({W6})", *GRIDG)
def rolling_stats(spark, d):
    g = series.with_rolling_and_lags(grid(spark, d).select("machine_id", "timestamp", "pressure_bar"), ["pressure_bar"], [], [6], [])
    return rounded(g.drop("pressure_bar"))


@query(f"select machine_id, {T}, " + ", ".join(f"round(lag(flow_lpm, {n}) over w, 6) as flow_lpm_lag{n}h, round(flow_lpm - lag(flow_lpm, {n}) over w, 6) as flow_lpm_diff{n}h" for n in (1, 24)) + f" from grid window w as (partition by machine_id order by {T})", *GRIDG)
def lag_diff(spark, d):
    return rounded(series.with_rolling_and_lags(grid(spark, d).select("machine_id", "timestamp", "flow_lpm"), [], ["flow_lpm"], [], [1, 24]).drop("flow_lpm"))


@query(f"select t.event_id, t.machine_id, t.{T}, x.action_timestamp as last_action from tel t asof left join act x on t.machine_id = x.machine_id and t.{T} >= x.action_timestamp", a.TEL, a.ACT)
def asof_last_event(spark, d):
    m = a.maintenance(spark, d)
    return series.as_of(a.telemetry(spark, d).select("event_id", "machine_id", "timestamp"), m, "action_timestamp", right_ts="action_timestamp", out="last_action")


@query(f"select t.machine_id, t.{T}, count(x.action_timestamp) as n from cell t left join act x on x.machine_id = t.machine_id and x.action_type = 'Reactive' and x.action_timestamp >= t.{T} - interval 5 day and x.action_timestamp < t.{T} group by all", a.TEL, a.CELL, a.ACT)
def range_count(spark, d):
    return series.range_count(a.cells(spark, d).select("machine_id", "timestamp"), a.maintenance(spark, d).where("action_type = 'Reactive'"), "5 day", right_ts="action_timestamp")


@query(f"""select t.machine_id, t.{T}, min(x.failure_timestamp) filter (where x.failure_timestamp >= t.{T}) as next_failure, max(x.failure_timestamp) filter (where x.failure_timestamp < t.{T}) as previous_failure
  from cell t left join fail x on x.machine_id = t.machine_id group by all""", a.TEL, a.CELL, a.FAIL)
def next_prev_event(spark, d):
    c, f = a.cells(spark, d).select("machine_id", "timestamp"), a.failures(spark, d)
    n = series.as_of(c, f, "failure_timestamp", right_ts="failure_timestamp", out="next_failure", forward=True)
    return series.as_of(n, f, "failure_timestamp", right_ts="failure_timestamp", out="previous_failure", exact=False)


# Baseline


@query(f"""select machine_id, day_type, hour, {", ".join(f"{r6(f'm_{s}', s + '__median')}, {r6(f'greatest(s_{s}, f_{s} * 0.25)', s + '__std')}, n_{s} as {s}__count" for s in SIGNALS)} from floors, picked""",
  *CLEANG,
  f"ref as (select c.* from clean c join (select machine_id, min({T}) as lo from clean group by 1) b on b.machine_id = c.machine_id where c.{T} < lo + interval 14 day and not is_standby)",
  "fine as (select machine_id, day_type, hour, " + ", ".join(f"median({s}) as m_{s}, stddev_samp({s}) as s_{s}, count({s}) as n_{s}" for s in SIGNALS) + " from ref group by all)",
  "rough as (select machine_id, day_type, " + ", ".join(f"median({s}) as m_{s}, stddev_samp({s}) as s_{s}" for s in SIGNALS) + " from ref group by all)",
  "picked as (select f.machine_id, f.day_type, f.hour, " + ", ".join(f"case when n_{s} < 5 then r.m_{s} else f.m_{s} end as m_{s}, case when n_{s} < 5 then r.s_{s} else f.s_{s} end as s_{s}, n_{s}" for s in SIGNALS) + " from fine f left join rough r on r.machine_id = f.machine_id and r.day_type = f.day_type)",
  "floors as (select " + ", ".join(f"median(s_{s}) as f_{s}" for s in SIGNALS) + " from picked)")
def baseline_table(spark, d):
    b = baseline_cells(clean(spark, d), SIGNALS, 14, 5)
    return rounded(b.withColumn("hour", F.col("hour").cast("long")))


@query(SQL["baseline_table"].rpartition("select machine_id, day_type, hour")[0].rstrip() + f""", tab as (select machine_id, day_type, hour, {", ".join(f"m_{s}, greatest(s_{s}, f_{s} * 0.25) as v_{s}" for s in SIGNALS)} from floors, picked),
  starts as (select machine_id, min({T}) as lo from clean group by 1)
  select c.machine_id, c.{T}, {", ".join(f"round(case when not is_standby then (c.{s} - m_{s}) / nullif(v_{s}, 0) end, 6) as z_{s}, round(case when not is_standby then 100 * (c.{s} / nullif(m_{s}, 0) - 1) end, 6) as pct_{s}" for s in SIGNALS)},
  c.{T} < lo + interval 14 day as in_baseline_period from clean c left join tab using (machine_id, day_type, hour) join starts st on st.machine_id = c.machine_id""")
def baseline_zscore(spark, d):
    z = RegimeBaseline(SIGNALS, 14, 5).fit_transform(clean(spark, d))
    return rounded(z.select("machine_id", "timestamp", *(f"{k}_{s}" for s in SIGNALS for k in ("z", "pct")), "in_baseline_period"))


# Hourly features


def minutes(spark: SparkSession, d: str) -> DataFrame:
    """Raw rows with what the hourly aggregate wants; percentages and deviations are plain differences here."""
    t = series.invalidate(a.telemetry(spark, d), RANGES)
    t = regime.tag_regimes(t, DEFAULTS["regimes"]).withColumn("was_imputed", F.col("flow_lpm") > 90)
    return t.withColumns({f"z_{s}": F.col(s) - 1 for s in SIGNALS} | {f"pct_{s}": F.col(s) * 2 for s in SIGNALS})


MIN = "mi as (select event_id, machine_id, " + T + ", event_type, " + ", ".join(f"case when {s} < {lo} or {s} > {hi} then null else {s} end as {s}" for s, (lo, hi) in RANGES.items()) + ", " + " + ".join(f"cast({s} < {lo} or {s} > {hi} as int)" for s, (lo, hi) in RANGES.items()) + f" as n_invalid from tel), mt as (select *, {TAGS}, flow_lpm > 90 as was_imputed, date_trunc('hour', {T}) + interval 1 hour as tt from mi)"
_X, _Y, _P, _Q, _TT = "vibration_x_g", "vibration_y_g", "pressure_bar", "flow_lpm", "temp_celsius"


def _corr(x: str, y: str) -> str:
    return f"(avg({x} * {y}) - avg({x}) * avg({y})) / sqrt(greatest(avg({x} * {x}) - avg({x}) * avg({x}), 1e-12) * greatest(avg({y} * {y}) - avg({y}) * avg({y}), 1e-12))"


@query(f"select machine_id, tt as {T}, " + ", ".join(f"round(avg({s}), 6) as {s}_mean, round(stddev_samp({s}), 6) as {s}_std, round(min({s}), 6) as {s}_min, round(max({s}), 6) as {s}_max" for s in a.SENSORS) + f""",
  round(quantile_cont({_X}, 0.95), 6) as vib_x_p95, cast(coalesce(sum(cast({_X} > 1 as int)), 0) as double) as vib_x_burst_count, round(max({_X}) / nullif(sqrt(avg({_X} * {_X})), 0), 6) as vib_x_crest,
  round(avg({_X} - {_Y}), 6) as xy_delta_mean, round(max(abs({_X} - {_Y})), 6) as xy_delta_absmax, round(avg(cast(abs({_X} - {_Y}) > 1e-9 as double)), 6) as xy_nonzero_share, round(avg(cast(abs({_X} - {_Y}) > 0.02 as double)), 6) as xy_divergence_share,
  round(avg(cast(was_imputed as double)), 6) as imputed_share, cast(sum(n_invalid) as bigint) as invalid_count, round(avg(cast(is_standby as double)), 6) as standby_share, count(*) as n_minutes from mt group by machine_id, tt""", a.TEL, MIN)
def hourly_features(spark, d):
    h, _ = feat.hourly_aggregate(minutes(spark, d), DEFAULTS)
    raw = [f"{s}_{k}" for s in a.SENSORS for k in ("mean", "std", "min", "max")]
    return rounded(h.select("machine_id", "timestamp", *raw, "vib_x_p95", "vib_x_burst_count", "vib_x_crest", "xy_delta_mean", "xy_delta_absmax", "xy_nonzero_share", "xy_divergence_share", "imputed_share", "invalid_count", "standby_share", "n_minutes"))


@query(f"""select machine_id, tt as {T}, case when count(*) > 1 then round((avg(x4) - 4 * avg(x) * avg(x3) + 6 * avg(x) * avg(x) * avg(x2) - 3 * avg(x) ** 4) / greatest(avg(x2) - avg(x) * avg(x), 1e-12) ** 2 - 3, 4) end as vib_x_kurtosis,
  round({_corr(_P, _Q)}, 5) + 0.0 as corr_pressure_flow, round({_corr(_TT, _Q)}, 5) + 0.0 as corr_temp_flow
  from (select *, {_X} as x, {_X} * {_X} as x2, {_X} * {_X} * {_X} as x3, {_X} * {_X} * {_X} * {_X} as x4 from mt) group by machine_id, tt
  having count(*) = 1 or count({_X}) >= 4 and var_pop({_X}) > 1e-3 and count({_Q}) >= 4 and var_pop({_Q}) > 1 and var_pop({_P}) > 1 and var_pop({_TT}) > 1""", a.TEL, MIN)
def hourly_moments(spark, d):
    """Kurtosis and correlations of hours that vary, and correlations of hours of one row, whose variances stand at their floor; elsewhere moments leave rounding noise only."""
    h, _ = feat.hourly_aggregate(minutes(spark, d), DEFAULTS)
    v = minutes(spark, d).groupBy("machine_id", F.window("timestamp", "1 hour")["end"].alias("t")).agg(F.count(F.lit(1)).alias("n"), F.count(_X).alias("nx"), F.var_pop(_X).alias("vx"), F.count(_Q).alias("nq"), F.var_pop(_Q).alias("vq"), F.var_pop(_P).alias("vp"), F.var_pop(_TT).alias("vt"))
    v = v.where("n = 1 or nx >= 4 and vx > 1e-3 and nq >= 4 and vq > 1 and vp > 1 and vt > 1").select("machine_id", F.col("t").alias("timestamp"), "n")
    return h.join(v, ["machine_id", "timestamp"]).select("machine_id", "timestamp", F.when(F.col("n") > 1, F.round("vib_x_kurtosis", 4)).alias("vib_x_kurtosis"), *((F.round(c, 5) + 0.0).alias(c) for c in ("corr_pressure_flow", "corr_temp_flow")))


@query(f"select machine_id, {T}, round(pressure_bar - median(pressure_bar) over (partition by {T}), 6) as fpressure_bar from cell", *CELLG)
def fleet_relative(spark, d):
    return rounded(feat.add_fleet_relative(a.cells(spark, d), ["pressure_bar"])[0].select("machine_id", "timestamp", "fpressure_bar"))


@query(f"select machine_id, tt as {T}, regime from (select *, row_number() over (partition by machine_id, tt order by n desc, regime) as nth from (select machine_id, tt, regime, count(*) as n from mt group by all)) where nth = 1", a.TEL, MIN)
def modal_regime(spark, d):
    return minutes(spark, d).groupBy("machine_id", F.window("timestamp", "1 hour")["end"].alias("t")).agg(F.mode("regime", deterministic=True).alias("regime")).select("machine_id", F.col("t").alias("timestamp"), "regime")


@query(f"""select h.machine_id, h.{T}, round((epoch_us(h.{T}) - epoch_us(any_t)) / 8.64e10, 6) as days_since_maintenance, round((epoch_us(h.{T}) - epoch_us(re_t)) / 8.64e10, 6) as days_since_reactive, n as reactive_actions_90d from
  (select t.machine_id, t.{T}, max(x.action_timestamp) filter (where x.action_timestamp <= t.{T}) as any_t, max(x.action_timestamp) filter (where x.action_type = 'Reactive' and x.action_timestamp <= t.{T}) as re_t,
  count(*) filter (where x.action_type = 'Reactive' and x.action_timestamp < t.{T} and x.action_timestamp >= t.{T} - interval 90 day) as n from cell t left join act x on x.machine_id = t.machine_id group by all) h""", a.TEL, a.CELL, a.ACT)
def maintenance_features(spark, d):
    h, _ = feat.add_maintenance(a.cells(spark, d).select("machine_id", "timestamp"), a.maintenance(spark, d))
    return rounded(h)


_N = 24
_SPECTRUM = (
    f"w0 as (select machine_id, {T}, list(pressure_bar) over (partition by machine_id order by {T} rows between {_N - 1} preceding and current row) as w, count(*) over (partition by machine_id order by {T} rows between {_N - 1} preceding and current row) as c from grid)",
    f"w1 as (select machine_id, {T}, list_transform(w, lambda x: coalesce(x, m)) as w from (select *, list_aggregate(list_filter(w, lambda x: x is not null), 'median') as m from w0 where c = {_N}))",
    f"pw as (select machine_id, {T}, k, power(list_sum([w[i + 1] * cos(2 * pi() * k * i / {_N}) for i in range({_N})]), 2) + power(list_sum([w[i + 1] * sin(2 * pi() * k * i / {_N}) for i in range({_N})]), 2) as p from (select *, unnest(range(1, {_N // 2 + 1})) as k from w1))",
    f"pt as (select *, sum(p) over (partition by machine_id, {T}) as total from pw)",
)
_BANDS = [[0.0, 0.15], [0.15, 0.5]]


@query(f"""select machine_id, {T} + interval 1 hour as {T}, round(sum(case when k / {_N}.0 > 0 and k / {_N}.0 <= 0.15 then p / total else 0 end), 6) as vib_spec_band0_share, round(sum(case when k / {_N}.0 > 0.15 and k / {_N}.0 <= 0.5 then p / total else 0 end), 6) as vib_spec_band1_share,
  round(-sum(p / total * ln(p / total + 1e-12)) / ln({_N // 2 + 1}), 5) as vib_spec_entropy, round(log10(any_value(total) / {_N} + 1e-12), 6) as vib_spec_log_power from pt where total > 1e-6 group by machine_id, {T}""", *GRIDG, *_SPECTRUM)
def spectral_shares(spark, d):
    """Windows of 24 rows; gaps take the window's median. Windows without any power have no shares."""
    g = grid(spark, d).withColumn("vibration_x_g", F.col("pressure_bar"))
    cfg = DEFAULTS | {"features": DEFAULTS["features"] | {"spectral_window_min": _N, "spectral_bands": _BANDS}, "validation": DEFAULTS["validation"] | {"sampling_interval": "1 hour"}}
    s, _ = feat.spectral_features(g, g.select("machine_id", (F.col("timestamp") + F.expr("interval 1 hour")).alias("timestamp")), cfg, block="5 day")
    s = s.where("vib_spec_band0_share is not null")
    return rounded(s.withColumn("vib_spec_entropy", F.round("vib_spec_entropy", 5)))


def features_of(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Features and dictionary of the clean series, an hour counting as a minute."""
    cfg = DEFAULTS | {"features": DEFAULTS["features"] | {"spectral_window_min": 24}, "validation": DEFAULTS["validation"] | {"sampling_interval": "1 hour"}}
    z = RegimeBaseline(SIGNALS, 14, 5).fit_transform(clean(spark, d).withColumn("n_invalid_sensors", F.lit(0)))
    return feat.build_features(z, a.maintenance(spark, d), cfg)


@query()
def feature_table(spark, d):
    return features_of(spark, d)[0]


_ZT = SQL["baseline_zscore"]
_ZTAB = _ZT.rpartition("select c.machine_id")[0].rstrip() + ", zt as (select c.machine_id" + _ZT.rpartition("select c.machine_id")[2].replace("round(case", "(case").replace("end, 6)", "end)").replace(f"c.{T},", f"c.{T}, c.pressure_bar, c.flow_lpm, c.vibration_x_g, c.vibration_y_g, c.regime, c.is_standby,", 1) + f"), zh as (select *, {T} + interval 1 hour as tt, cast(row_number() over (partition by machine_id order by {T}) as double) as row, vibration_x_g - vibration_y_g as xy from zt)"
_ROLLED = {"z_pressure_bar_mean": "z_pressure_bar", "z_flow_lpm_mean": "z_flow_lpm", "xy_delta_absmax": "abs(xy)"}


def _rolled(c: str, e: str, w: int) -> str:
    over = f"over (partition by machine_id order by tt rows between {w - 1} preceding and current row)"
    made = {"mean": f"avg({e}) {over}", "std": f"stddev_samp({e}) {over}", "min": f"min({e}) {over}", "max": f"max({e}) {over}", "slope": f"regr_slope({e}, row) {over}"}
    return ", ".join(f"round(case when count({e}) {over} >= {max(2, w // 2)} then {x} end + 1.3e-6, 5) as {c}_roll{w}h_{n}" for n, x in made.items())


_LAGS = ", ".join(f"round(lag({e}, {n}) over (partition by machine_id order by tt) + 1.3e-6, 5) as {c}_lag{n}h, round({e} - lag({e}, {n}) over (partition by machine_id order by tt) + 1.3e-6, 5) as {c}_diff{n}h" for c, e in (("z_pressure_bar_mean", "z_pressure_bar"), ("xy_delta_mean", "xy")) for n in (1, 24))


@query(_ZTAB + f""" select machine_id, tt as {T}, regime, tt <= lo + interval 14 day as in_baseline_period, round(pressure_bar + 1.3e-6, 5) as pressure_bar_mean, round(z_pressure_bar + 1.3e-6, 5) as z_pressure_bar_mean, round(z_temp_celsius - median(z_temp_celsius) over (partition by tt) + 1.3e-6, 5) as fz_temp_celsius_mean, round(pct_pressure_bar - pct_flow_lpm + 1.3e-6, 5) as pct_pressure_minus_flow_mean,
  cast(is_standby as double) as standby_share, hour({T}) as hour_of_day, {", ".join(_rolled(c, e, w) for c, e in _ROLLED.items() for w in (6, 24, 72))}, {_LAGS} from zh join (select machine_id, min({T}) as lo from clean group by 1) using (machine_id)""")
def feature_values(spark, d):
    """The feature table's columns of each kind that SQL can say: raw, regime, fleet, rolling, lag, context; moved a little, off the ties of rounding."""
    f = features_of(spark, d)[0]
    rolled = [f"{c}_roll{w}h_{n}" for c in _ROLLED for w in (6, 24, 72) for n in ("mean", "std", "min", "max", "slope")]
    lagged = [f"{c}_{k}{n}h" for c in ("z_pressure_bar_mean", "xy_delta_mean") for n in (1, 24) for k in ("lag", "diff")]
    values = ["pressure_bar_mean", "z_pressure_bar_mean", "fz_temp_celsius_mean", "pct_pressure_minus_flow_mean", *rolled, *lagged]
    return f.select("machine_id", "timestamp", "regime", "in_baseline_period", "standby_share", F.col("hour_of_day").cast("long").alias("hour_of_day"), *(F.round(F.col(c) + 1.3e-6, 5).alias(c) for c in values))


_SIG = str(SIGNALS)
_NAMES = f"""select s || '_' || k as feature, 'hourly_raw' as "group" from (select unnest({str(a.SENSORS)}) as s), (select unnest(['mean', 'std', 'min', 'max']) as k)
  union all select 'z_' || s || '_' || k, 'hourly_regime' from (select unnest({_SIG}) as s), (select unnest(['mean', 'min', 'max']) as k) union all select 'pct_' || s || '_mean', 'hourly_regime' from (select unnest({_SIG}) as s)
  union all select 'f' || c, 'fleet_relative' from (select unnest({str(feat.FLEET)}) as c)
  union all select c || '_roll' || w || 'h_' || k, 'rolling' from (select unnest({str(feat.ROLL)}) as c), (select unnest([6, 24, 72]) as w), (select unnest(['mean', 'std', 'min', 'max', 'slope']) as k)
  union all select c || '_' || k || n || 'h', 'lag' from (select unnest({str(feat.LAG)}) as c), (select unnest([1, 24]) as n), (select unnest(['lag', 'diff']) as k)
  union all select unnest(['vib_x_p95', 'vib_x_burst_count', 'vib_x_kurtosis', 'vib_x_crest']), 'vibration'
  union all select unnest(['xy_delta_mean', 'xy_delta_absmax', 'xy_nonzero_share', 'xy_divergence_share', 'pct_pressure_minus_flow_mean', 'corr_pressure_flow', 'corr_temp_flow']), 'cross_sensor'
  union all select unnest(['imputed_share', 'invalid_count', 'missing_share', 'n_minutes']), 'quality' union all select unnest(['standby_share', 'hour_sin', 'hour_cos', 'is_weekend', 'hour_of_day']), 'context'
  union all select unnest(['vib_spec_band0_share', 'vib_spec_band1_share', 'vib_spec_band2_share', 'vib_spec_entropy', 'vib_spec_log_power']), 'spectral' union all select unnest(['days_since_maintenance', 'days_since_reactive', 'reactive_actions_90d']), 'maintenance'"""


@query(_NAMES)
def feature_dictionary(spark, d):
    return features_of(spark, d)[1].select("feature", "group")


# Targets, folds


TARGET = f"""tg as (select t.machine_id, t.{T}, count(f.event_id) filter (where f.failure_timestamp < t.{T}) as life_cycle, min(struct_pack(at := f.failure_timestamp, id := f.event_id, st := f.degradation_start_timestamp, mo := f.failure_mode)) filter (where f.failure_timestamp >= t.{T}) as nx,
  max(struct_pack(at := f.failure_timestamp, id := f.event_id, st := f.degradation_start_timestamp, mo := f.failure_mode, dn := f.downtime_hours)) filter (where f.failure_timestamp < t.{T}) as pv, max(e.hi) as hi from cell t left join fail f on f.machine_id = t.machine_id join (select machine_id, max({T}) as hi from cell group by 1) e on e.machine_id = t.machine_id group by t.machine_id, t.{T}),
th as (select *, (epoch_us(nx.at) - epoch_us({T})) / 3.6e9 as htf, (epoch_us(hi) - epoch_us({T})) / 3.6e9 as bound, coalesce({T} - interval 1 hour < pv.at + to_microseconds(cast(pv.dn * 3600000000 as bigint)), false) as rep from tg),
tl as (select *, case when rep then 'repair' when nx is not null and {T} - interval 1 hour >= nx.st then nx.mo else 'healthy' end as lab, case when nx is null then case when bound >= 336 then 336.0 end else least(htf, 336.0) end as rul,
  case when nx is null then case when bound >= 168 then 0.0 end else cast(htf <= 168 as double) end as warn from th)"""


@query(f"select machine_id, {T}, life_cycle, nx.id as next_event_id, round(htf, 6) as hours_to_failure, lab as failure_mode_label, rep as in_repair, round(case when not rep then rul end, 6) as rul_hours, rul is null as rul_censored, case when not rep then warn end as fail_within_h, lab not in ('healthy', 'repair') as is_degrading from tl", a.TEL, a.CELL, a.FAIL, TARGET)
def targets_full(spark, d):
    t = targets.build_targets(a.cells(spark, d).select("machine_id", "timestamp"), a.failures(spark, d), DEFAULTS)
    return rounded(t.withColumns({"life_cycle": F.col("life_cycle").cast("long"), "fail_within_h": F.col("fail_within_h").cast("double")}))


@query(f"select lab as failure_mode_label, count(*) as n, count(*) filter (where not rep and rul is not null) as rul_known from tl group by 1", a.TEL, a.CELL, a.FAIL, TARGET)
def label_summary(spark, d):
    t = targets.build_targets(a.cells(spark, d).select("machine_id", "timestamp"), a.failures(spark, d), DEFAULTS)
    return t.groupBy("failure_mode_label").agg(F.count(F.lit(1)).alias("n"), F.count("rul_hours").alias("rul_known"))


@query(f"select t.machine_id, t.{T} from tl t join (select machine_id, {T}, cast(pump_rpm < 1200 as int) as sb from cell) c on c.machine_id = t.machine_id and c.{T} = t.{T} join (select machine_id, min({T}) as lo from cell group by 1) b on b.machine_id = t.machine_id where not rep and not (t.{T} <= lo + interval 3 day) and sb < 0.5", a.TEL, a.CELL, a.FAIL, TARGET)
def eligible_rows(spark, d):
    c = a.cells(spark, d)
    t = targets.build_targets(c.select("machine_id", "timestamp"), a.failures(spark, d), DEFAULTS)
    lo = c.groupBy("machine_id").agg((F.min("timestamp") + F.expr("interval 3 days")).alias("end"))
    x = t.join(c.select("machine_id", "timestamp", (F.col("pump_rpm") < 1200).cast("double").alias("standby_share")), ["machine_id", "timestamp"]).join(lo, "machine_id")
    return x.withColumn("in_baseline_period", F.col("timestamp") <= F.col("end")).where(splits.eligible()).select("machine_id", "timestamp")


FOLD = """fo as (select cast(row_number() over (order by m.machine_id) - 1 as bigint) as fold, m.machine_id as test_machine, coalesce((select string_agg(mo, ', ' order by mo) from (select distinct failure_mode as mo from fail where machine_id = m.machine_id)), 'none (healthy reference)') as test_failure_modes,
  coalesce((select string_agg(mo, ', ' order by mo) from (select distinct failure_mode as mo from fail where machine_id = m.machine_id and failure_mode not in (select failure_mode from fail f2 where f2.machine_id <> m.machine_id))), '') as unseen_mode_in_train from (select distinct machine_id from tel) m)"""


@query("select * from fo", a.TEL, a.FAIL, FOLD)
def folds_lomo(spark, d):
    f = splits.leave_one_machine_out(a.telemetry(spark, d).select("machine_id"), a.failures(spark, d))
    return f.withColumn("fold", F.col("fold").cast("long"))


@query(f"select c.machine_id, c.{T}, fold from cell c join fo on test_machine = machine_id", a.TEL, a.CELL, a.FAIL, FOLD)
def fold_assign(spark, d):
    c = a.cells(spark, d).select("machine_id", "timestamp")
    f = splits.leave_one_machine_out(c, a.failures(spark, d))
    return splits.assign_folds(c, f).select("machine_id", "timestamp", F.col("fold").cast("long").alias("fold"))


@query(f"select fold, test_machine, count(*) as test_rows, count(*) filter (where lab not in ('healthy', 'repair')) as degrading_rows, count(*) filter (where not rep and rul is not null) as rul_known from tl join fo on test_machine = machine_id group by all", a.TEL, a.CELL, a.FAIL, TARGET, FOLD)
def fold_summary(spark, d):
    c = a.cells(spark, d).select("machine_id", "timestamp")
    f = splits.leave_one_machine_out(c, a.failures(spark, d))
    t = splits.assign_folds(targets.build_targets(c, a.failures(spark, d), DEFAULTS), f)
    return t.groupBy(F.col("fold").cast("long").alias("fold"), F.col("machine_id").alias("test_machine")).agg(F.count(F.lit(1)).alias("test_rows"), F.count_if("is_degrading").alias("degrading_rows"), F.count("rul_hours").alias("rul_known"))


# Screening


@query(" union all ".join(f"select '{s}' as feature, round(avg(cast({s} is null as double)), 6) as null_share, round(stddev_samp({s}), 6) as std from inside" for s in a.SENSORS), *GRIDG, INSIDE)
def screening_stats(spark, d):
    return rounded(screening.feature_stats(series.invalidate(grid(spark, d), RANGES), a.SENSORS))


@query(" union all ".join(f"select '{x}' as a, '{y}' as b, round(corr({x}, {y}), 6) as r from inside" for i, x in enumerate(a.SENSORS) for y in a.SENSORS[:i]), *GRIDG, INSIDE)
def pairwise_corr(spark, d):
    r = screening.correlations(series.invalidate(grid(spark, d), RANGES), a.SENSORS)
    rows = [(x, y, round(float(r[i, j]), 6)) for i, x in enumerate(a.SENSORS) for j, y in enumerate(a.SENSORS[:i])]
    return spark.createDataFrame(rows, "a string, b string, r double")


@query("select round(max(n) / sum(n), 6) as chance from (select machine_id, count(*) as n from tel where \"timestamp\" >= timestamp '2024-01-21' group by 1)", *TELG)
def identity_chance(spark, d):
    t = a.telemetry(spark, d).withColumns({"failure_mode_label": F.lit("healthy"), "standby_share": F.lit(0.0)})
    return rounded(screening.identity_chance(t, "2024-01-21"))


@query()
def identity_leak(spark, d):
    t = grid(spark, d).withColumns({"failure_mode_label": F.lit("healthy"), "standby_share": F.lit(0.0)})
    return screening.identity_leak(t, a.SENSORS, "2024-01-21")


@query()
def multi_feature_identity(spark, d):
    t = grid(spark, d).withColumns({"failure_mode_label": F.lit("healthy"), "standby_share": F.lit(0.0)})
    return spark.createDataFrame([(screening.multi_feature_identity(t, a.SENSORS, "2024-01-21"),)], "accuracy double")


# Alarms


ALARM = f"""al as (select *, coalesce(min(coalesce(cast(s > 45 as int), 0)) over w = 1, false) and not is_standby as flow_high, coalesce(min(coalesce(cast(p > 30 as int), 0)) over w = 1, false) and not is_standby as pressure_high from
  (select *, quantile_cont(flow_lpm, 0.5) over w as s, abs(avg(pressure_bar) over w) as p from clean window w as (partition by machine_id order by {T} range between interval 21599999999 microseconds preceding and current row))
  window w as (partition by machine_id order by {T} range between interval 21599999999 microseconds preceding and current row)), aa as (select *, flow_high or pressure_high as any_rule from al)"""
ALARM_RULES = {"flow_high": ("flow_lpm", 1, 45.0, "median"), "pressure_high": ("pressure_bar", 1, 30.0, "absmean")}


@query(f"select machine_id, {T}, flow_high, pressure_high, any_rule from aa", *CLEANG, ALARM)
def sustained_alarm(spark, d):
    return alarms.rule_alarms(clean(spark, d), ALARM_RULES).select("machine_id", "timestamp", *ALARM_RULES, "any_rule")


@query(f"""select event_id, machine_id, failure_mode, window_h, flow_high, pressure_high, any_rule, case when any_rule <= 0 then '-' when flow_high >= pressure_high then 'flow_high' else 'pressure_high' end as first_rule from (select f.event_id, f.machine_id, f.failure_mode, 48.0::double as window_h,
  {", ".join(f"round(coalesce((epoch_us(f.failure_timestamp) - epoch_us(min(x.{T}) filter (where x.{n}))) / 3.6e9, 0), 6) as {n}" for n in ("flow_high", "pressure_high", "any_rule"))}
  from fail f left join aa x on x.machine_id = f.machine_id and x.any_rule and x.{T} >= f.failure_timestamp - interval 30 day and x.{T} < f.failure_timestamp group by f.event_id, f.machine_id, f.failure_mode, f.failure_timestamp)""", *CLEANG, ALARM, a.FAIL)
def lead_time(spark, d):
    x = alarms.rule_alarms(clean(spark, d), ALARM_RULES)
    return rounded(alarms.lead_times(x, a.failures(spark, d), list(ALARM_RULES)))


@query(f"select round(count(*) filter (where hour < 20) / 1.0, 6) as healthy_hours, round(count(*) filter (where hour < 20 and any_rule) / 1.0, 6) as alarm_hours, round(count(*) filter (where hour < 20 and any_rule and day_of_week >= 5) / 1.0, 6) as weekend_alarm_hours, count(distinct machine_id) filter (where is_standby and any_rule) as standby_machines from aa", *CLEANG, ALARM)
def false_alarm(spark, d):
    x = alarms.rule_alarms(clean(spark, d), ALARM_RULES)
    return rounded(alarms.false_alarms(x, "any_rule", F.col("hour") < 20, 1.0))


@query(f"""select machine_id, {T}, min(coalesce(cast(pressure_bar > m + 0.2 * s as int), 0)) over (partition by machine_id order by {T} range between interval 7199999999 microseconds preceding and current row) = 1 as naive_low from
  (select *, avg(pressure_bar) over (partition by machine_id) as m, stddev_samp(pressure_bar) over (partition by machine_id) as s from clean)""", *CLEANG)
def naive_alarm(spark, d):
    c = clean(spark, d).withColumn("low", -F.col("pressure_bar"))
    return alarms.naive_alarm(c, "low", 0.2, "2 hour").select("machine_id", "timestamp", "naive_low")


_REF = "ref as (select * from clean where \"timestamp\" < timestamp '2024-01-21' and not is_standby)"
_NORMAL = f"""nd as (select c.*, {", ".join(f"(c.{s} - m_{s}) / nullif(s_{s}, 0) as z_{s}, 100 * (c.{s} / nullif(m_{s}, 0) - 1) as pct_{s}" for s in SIGNALS)}, c.vibration_x_g - c.vibration_y_g as vib_xy_delta, (c.vibration_x_g - c.vibration_y_g) / nullif(sxy, 0) as z_vib_xy_delta
  from clean c left join (select machine_id, day_type, hour, {", ".join(f"median({s}) as m_{s}, stddev_samp({s}) as s_{s}" for s in SIGNALS)} from ref group by all) b using (machine_id, day_type, hour), (select stddev_samp(vibration_x_g - vibration_y_g) as sxy from ref))"""


def normal(spark: SparkSession, d: str) -> DataFrame:
    return eda.normal_deviations(clean(spark, d), SIGNALS, "2024-01-21")


@query(f"select machine_id, {T}, " + ", ".join(f"round(z_{s} + 1.3e-6, 5) as z_{s}, round(pct_{s} + 1.3e-6, 5) as pct_{s}" for s in SIGNALS) + ", round(vib_xy_delta + 1.3e-6, 5) as vib_xy_delta, round(z_vib_xy_delta + 1.3e-6, 5) as z_vib_xy_delta from nd", *CLEANG, _REF, _NORMAL)
def normal_deviations(spark, d):
    """Moved a little, off the ties of rounding."""
    values = [*(f"{k}_{s}" for s in SIGNALS for k in ("z", "pct")), "vib_xy_delta", "z_vib_xy_delta"]
    return normal(spark, d).select("machine_id", "timestamp", *(F.round(F.col(c) + 1.3e-6, 5).alias(c) for c in values))


_WIN = f"window w as (partition by machine_id order by {T} range between interval 21599999999 microseconds preceding and current row)"


@query(f"""select *, {" or ".join(alarms.RULES)} as any_rule from (select machine_id, {T}, {", ".join(f"coalesce(min(coalesce(cast(s_{n} > {limit} as int), 0)) over w = 1, false) and not is_standby as {n}" for n, (_, _, limit, _) in alarms.RULES.items())} from
  (select machine_id, {T}, is_standby, {", ".join((f"abs(avg({c}) over w)" if how == "absmean" else f"quantile_cont({c}, 0.5) over w * {sign}") + f" as s_{n}" for n, (c, sign, _, how) in alarms.RULES.items())} from nd {_WIN}) {_WIN})""", *CLEANG, _REF, _NORMAL)
def default_alarms(spark, d):
    """The alarms of the default rules on the deviations from each machine's normal."""
    x = alarms.rule_alarms(normal(spark, d).drop("vib_xy_delta"))
    return x.select("machine_id", "timestamp", *alarms.RULES, "any_rule")


# Exploration


@query("select event_type, count(*) as n, round(avg(cast(vibration_x_g = vibration_y_g or vibration_x_g is null as double)), 6) as share_identical from tel group by 1", *TELG)
def identical_axes(spark, d):
    return rounded(eda.identical_share(a.telemetry(spark, d), "vibration_x_g", "vibration_y_g", "event_type"))


@query(f"""select x.day, x.n, x.machines, round(m.p, 6) as pressure_bar, round(m.q, 6) as flow_lpm, round(f.p, 6) as next_pressure_bar, round(f.q, 6) as next_flow_lpm from (select date_trunc('day', {T}) as day, count(*) as n, count(distinct machine_id) as machines from tel where pump_rpm = 1000 group by 1) x
  join md m on m.day = x.day left join md f on f.day = x.day + interval 1 day""", a.TEL, f"md as (select date_trunc('day', {T}) as day, median(pressure_bar) as p, median(flow_lpm) as q from tel group by 1)")
def standstill_days(spark, d):
    return rounded(eda.standstill_days(a.telemetry(spark, d), 1000.0, ["pressure_bar", "flow_lpm"]).withColumn("day", F.col("day").cast("timestamp_ntz")))


@query()
def seeded_sample(spark, d):
    """A tenth of the rows by a seeded hash: the sampling operator itself."""
    return eda.sampled(a.telemetry(spark, d).select("event_id", "machine_id", "pressure_bar"), 0.1, seed=1, keys=["event_id"])


@query(" union all ".join(f"select '{s}' as \"column\", count({s}) as n, round(avg({s}), 6) as mean, round(stddev_samp({s}), 6) as std, round(min({s}), 6) as min, round(max({s}), 6) as max, " + ", ".join(f"round(quantile_cont({s}, {q}), 6) as p{round(q * 100):02d}" for q in (0.01, 0.25, 0.5, 0.75, 0.99)) + f", round(skewness({s}), 6) as skewness, round(kurtosis({s}), 6) as kurtosis from tel" for s in ("pressure_bar", "flow_lpm")), *TELG)
def describe_percentiles(spark, d):
    return rounded(eda.describe(a.telemetry(spark, d), ["pressure_bar", "flow_lpm"]))


@query("select machine_id, event_type, " + ", ".join(f"count(*) filter (where shift = '{s}') as \"{s}\"" for s in ("Day", "Night", "Lunch")) + " from tel group by all", *TELG)
def pivot_crosstab(spark, d):
    return eda.crosstab(a.telemetry(spark, d), ["machine_id", "event_type"], "shift", ["Day", "Night", "Lunch"])


@query(f"select machine_id, date_trunc('day', {T}) as start, round(median(pressure_bar), 6) as pressure_bar, round(median(flow_lpm), 6) as flow_lpm from tel group by all", *TELG)
def resample_daily(spark, d):
    return rounded(eda.resample(a.telemetry(spark, d), "1 day", ["pressure_bar", "flow_lpm"]))


_HEALTHY = f"hz as (select c.* from clean c where not is_standby and not exists (select 1 from fail f where f.machine_id = c.machine_id and f.degradation_start_timestamp < f.failure_timestamp + interval 1 day and c.{T} >= f.degradation_start_timestamp and c.{T} < f.failure_timestamp + interval 1 day))"


def healthy(spark: SparkSession, d: str) -> DataFrame:
    return eda.healthy_running(clean(spark, d), a.failures(spark, d))


@query(f"""select start, round(median(m), 6) as median, round(min(m), 6) as min, round(max(m), 6) as max from (select machine_id, o + to_days(cast(floor((epoch_us({T}) - epoch_us(o)) / 604800000000) * 7 as int)) as start, median(pressure_bar) as m
  from hz join (select machine_id, date_trunc('day', min({T})) as o from hz group by 1) using (machine_id) group by all) group by start""", *CLEANG, a.FAIL, _HEALTHY)
def weekly_drift(spark, d):
    """Weeks from the midnight of each machine's first day, over rows in healthy operation."""
    return rounded(eda.drift(healthy(spark, d), "pressure_bar"))


@query(f"""select machine_id, o + to_days(cast(floor((epoch_us({T}) - epoch_us(o)) / 604800000000) * 7 as int)) as start, round(avg(flow_lpm), 6) as flow_lpm from tel join (select machine_id, date_trunc('day', min({T})) as o from tel group by 1) using (machine_id) group by all""", *TELG)
def resample_weekly(spark, d):
    return rounded(eda.resample(a.telemetry(spark, d), "7 day", ["flow_lpm"], "mean"))


@query(f"""select machine_id, date_trunc('day', {T}) as day, round((median(pressure_bar) - any_value(m)) / nullif(any_value(s), 0), 6) as z from tel join (select machine_id, median(pressure_bar) as m, stddev_samp(pressure_bar) as s from tel where {T} < timestamp '2024-01-21' group by 1) using (machine_id) group by machine_id, 2""", *TELG)
def daily_reference_z(spark, d):
    return rounded(eda.reference_z(a.telemetry(spark, d), "pressure_bar", "2024-01-01", "2024-01-21").withColumn("day", F.col("day").cast("timestamp_ntz")))


@query(f"select failure_mode, days_before, round(median(pressure_bar), 6) as pressure_bar from (select failure_mode, -ceil(h / 12) * 12 / 24 as days_before, pressure_bar from (select f.failure_mode, t.pressure_bar, (epoch_us(f.failure_timestamp) - epoch_us(t.{T})) / 3.6e9 as h from tel t asof join fail f on f.machine_id = t.machine_id and t.{T} <= f.failure_timestamp) where h > 0) group by all", a.TEL, a.FAIL)
def trajectories(spark, d):
    """Medians by mode and half days before each row's next failure."""
    f = a.failures(spark, d).withColumn("next", F.struct("failure_timestamp", "failure_mode"))
    t = series.as_of(a.telemetry(spark, d).select("machine_id", "timestamp", "pressure_bar"), f, "next", right_ts="failure_timestamp", forward=True)
    t = t.select("pressure_bar", F.col("next.failure_mode").alias("failure_mode"), hours_between(F.col("next.failure_timestamp"), F.col("timestamp")).alias("hours_to_failure"))
    return rounded(eda.trajectory(t, ["pressure_bar"]))


@query(f"""select t.event_id, t.machine_id, case when t.{T} >= f.at then 'post_failure' when t.{T} >= f.st then f.mo else 'healthy' end as state, round((epoch_us(f.at) - epoch_us(t.{T})) / 3.6e9, 4) as hours_to_failure from tel t left join
  (select machine_id, min(failure_timestamp) as at, arg_min(degradation_start_timestamp, failure_timestamp) as st, arg_min(failure_mode, failure_timestamp) as mo from fail group by 1) f on f.machine_id = t.machine_id""", a.TEL, a.FAIL)
def health_states(spark, d):
    return rounded(eda.health_state(a.telemetry(spark, d), a.failures(spark, d)).select("event_id", "machine_id", "state", "hours_to_failure"), 4)


RANKS = "rk as (select *, (rank() over (order by pressure_bar) + (count(*) over (partition by pressure_bar) - 1) / 2.0) as rx, (rank() over (order by flow_lpm) + (count(*) over (partition by flow_lpm) - 1) / 2.0) as ry from tel)"


@query("select round(corr(rx, ry), 6) as spearman from rk", a.TEL, RANKS)
def spearman(spark, d):
    return rounded(eda.spearman(a.telemetry(spark, d), "pressure_bar", "flow_lpm"))


_LONG = "lg as (select event_id, event_type, unnest(['pressure_bar', 'flow_lpm', 'vibration_y_g', 'pump_rpm']) as c, unnest([pressure_bar, flow_lpm, vibration_y_g, case when day_of_week < 6 then pump_rpm end]) as v from tel), lr as (select *, rank() over (partition by event_type, c order by v) + (count(*) over (partition by event_type, c, v) - 1) / 2.0 as r from lg where v is not null)"


@query("""select a.event_type, a.c as x, b.c as y, count(*) as n, round(corr(a.r, b.r), 6) as spearman from lr a join lr b on a.event_id = b.event_id and list_position(['pressure_bar', 'flow_lpm', 'vibration_y_g', 'pump_rpm'], a.c) > list_position(['pressure_bar', 'flow_lpm', 'vibration_y_g', 'pump_rpm'], b.c) group by all""", a.TEL, _LONG)
def spearman_by_state(spark, d):
    """Rank correlations of several columns, one of them with holes, within each kind of event."""
    t = a.telemetry(spark, d).withColumn("pump_rpm", F.when(F.col("day_of_week") < 6, F.col("pump_rpm")))
    return rounded(eda.spearman_matrix(t, ["pressure_bar", "flow_lpm", "vibration_y_g", "pump_rpm"], ["event_id"], ["event_type"]))


@query("""select round(greatest(0, (select h from hs where n = (select count(*) from pt) - 1) + avg(hk.h - hg.h - hm.h)), 6) as mi from (select nn.i, least(3, ng - 1) as k, ng, count(*) filter (where case when d = 0 then b.x = nn.x else abs(b.x - nn.x) < d end) as m from nn, pt b group by all) z
  join hs hk on hk.n = z.k - 1 join hs hg on hg.n = z.ng - 1 join hs hm on hm.n = z.m - 1""", a.TEL,
  "pt as (select machine_id as g, pressure_bar as x, row_number() over (order by event_id) as i from tel)",
  "nn as (select a.i, any_value(a.x) as x, list_sort(list(abs(a.x - b.x)))[least(3, count(*))] as d, count(*) + 1 as ng from pt a join pt b on a.g = b.g and a.i <> b.i group by a.i)",
  "hs as (select 0 as n, 0.0::double as h union all select n, sum(1.0::double / n) over (order by n) from (select unnest(range(1, (select count(*) + 1 from pt))) as n))")
def neighbour_information(spark, d):
    """What an event's value says of its machine, by nearest neighbours; the SQL compares all pairs."""
    return rounded(information.neighbour_information(a.telemetry(spark, d), "machine_id", "pressure_bar", 3))


_HASHED = "sh as (select event_id, event_type, sha256('1' || chr(31) || event_id) as h from tel), sp as (select *, row_number() over (partition by event_type order by h) - 1 as p, count(*) over (partition by event_type) as n from sh)"


@query("select event_id, event_type from sp where p < 25", a.TEL, _HASHED)
def exact_sample(spark, d):
    return eda.sampled_exactly(a.telemetry(spark, d).select("event_id", "event_type"), 25, ["event_type"], seed=1, keys=["event_id"])


@query("select event_id, event_type, draw from sp join (select draw::int as draw, ('0x' || substr(sha256('1:' || draw), 1, 15))::bigint as m from (select unnest(range(1, 41)) as draw)) on p = m % n", a.TEL, _HASHED)
def exact_resample(spark, d):
    """Forty draws with replacement of each kind of event."""
    return eda.resampled_exactly(a.telemetry(spark, d).select("event_id", "event_type"), 40, ["event_type"], seed=1, keys=["event_id"])


@query("""select round((12.0 / (n * (n + 1.0)) * h - 3 * (n + 1)) / (1 - ties / (power(n, 3) - n)), 6) as h from (select sum(s * s / m) as h, sum(m) as n from (select event_type, sum(rx) as s, count(*) as m from rk group by 1)),
  (select sum(power(c, 3) - c) as ties from (select count(*) as c from tel group by pressure_bar))""", a.TEL, RANKS)
def kruskal(spark, d):
    return rounded(eda.kruskal(a.telemetry(spark, d), "event_type", "pressure_bar"))


@query("select round((sum(cast(x.v > y.v as int)) - sum(cast(x.v < y.v as int))) / count(*), 6) as delta from (select pressure_bar as v from tel where event_type = 'error') x, (select pressure_bar as v from tel where event_type = 'purchase') y", *TELG)
def cliffs_delta(spark, d):
    return rounded(eda.cliffs_delta(a.telemetry(spark, d), "event_type", "pressure_bar", "error", "purchase"))


@query("""select round(sum(n / tot * ln(n * tot / (ng * nb))), 6) as mi from (select n, sum(n) over (partition by g) as ng, sum(n) over (partition by b) as nb, sum(n) over () as tot from
  (select machine_id as g, least(greatest(floor((pressure_bar - 0) / 20.0), 0), 9) as b, cast(count(*) as double) as n from tel group by all))""", *TELG)
def mutual_information(spark, d):
    return rounded(eda.mutual_information(a.telemetry(spark, d), "machine_id", "pressure_bar", 10, 0.0, 200.0))


@query(f"""select p.machine_id, k as lag, round(sum(p.x * q.x) / nullif(any_value(v.s), 0), 6) as r from ac p join (select unnest(range(1, 193)) as k) on true left join ac q on q.machine_id = p.machine_id and q.n = p.n - k join (select machine_id, sum(x * x) as s from ac group by 1) v on v.machine_id = p.machine_id group by all""", *TELG,
  f"hm as (select machine_id, date_trunc('hour', {T}) as t, avg(pressure_bar) as v from tel group by all)",
  "hg as (select g.machine_id, g.t, h.v, row_number() over (partition by g.machine_id order by g.t) as n from (select machine_id, unnest(generate_series(min(t), max(t), interval 1 hour)) as t from hm group by 1) g left join hm h on h.machine_id = g.machine_id and h.t = g.t)",
  "hn as (select *, last_value(v ignore nulls) over b as p, first_value(v ignore nulls) over f as q, last_value(case when v is not null then n end ignore nulls) over b as i, first_value(case when v is not null then n end ignore nulls) over f as j from hg window b as (partition by machine_id order by t rows between unbounded preceding and current row), f as (partition by machine_id order by t rows between current row and unbounded following))",
  "hi as (select machine_id, t, coalesce(v, p + (q - p) * (n - i) / nullif(j - i, 0), p) as v from hn)",
  "ac as (select machine_id, v - avg(v) over (partition by machine_id) as x, row_number() over (partition by machine_id order by t) as n from hi where v is not null)")
def autocorrelation(spark, d):
    """192 lags of the hourly means, gaps filled by straight lines."""
    r = eda.hourly_autocorrelation(a.telemetry(spark, d), "pressure_bar", 192)
    return rounded(r.withColumn("lag", F.col("lag").cast("long")))


@query("select bin, n, round(n / (sum(n) over ()) / 10.0, 6) as density from (select cast(floor(pressure_bar / 10) + 1 as int) as bin, count(*) as n from tel where pressure_bar >= 0 and pressure_bar < 200 group by 1)", *TELG)
def histogram(spark, d):
    return rounded(eda.histogram(a.telemetry(spark, d), "pressure_bar", 0.0, 200.0, 20))


@query("select event_id, machine_id, pressure_bar from tel order by pressure_bar desc, event_id limit 12", *TELG)
def value_topk(spark, d):
    return eda.top(a.telemetry(spark, d).select("event_id", "machine_id", "pressure_bar"), 12, F.col("pressure_bar"), "event_id")


@query("""select machine_id, count(*) as n_actions, count(*) filter (where action_type = 'Reactive') as n_reactive, count(*) filter (where action_type = 'Preventive') as n_preventive,
  round(count(*) filter (where action_type = 'Reactive') / nullif(count(*) filter (where action_type = 'Preventive'), 0), 6) as reactive_ratio, round(sum(cost_usd), 4) as cost, max(action_timestamp) as last_action, string_agg(distinct component_replaced, ', ' order by component_replaced) as components from act group by machine_id""", a.TEL, a.ACT)
def maintenance_profile(spark, d):
    return rounded(eda.maintenance_profile(a.maintenance(spark, d))).withColumn("cost", F.round("cost", 4))


@query("select failure_mode, count(*) as n, count(distinct machine_id) as machines, round(sum(downtime_hours), 6) as downtime, round(avg(downtime_hours), 6) as mean_downtime, string_agg(distinct machine_id, ', ' order by machine_id) as machine_list from fail group by 1", a.TEL, a.FAIL)
def failure_profile(spark, d):
    return rounded(a.failures(spark, d).groupBy("failure_mode").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("machine_id").alias("machines"), F.sum("downtime_hours").alias("downtime"), F.avg("downtime_hours").alias("mean_downtime"), F.array_join(F.array_sort(F.collect_set("machine_id")), ", ").alias("machine_list")))


@query("select f.event_id, f.failure_mode is not distinct from x.component_replaced as failure_mode_matches, f.event_id is not distinct from x.action_id as event_id_matches from fail f join act x on x.machine_id = f.machine_id and x.action_id = (select max(action_id) from act y where y.machine_id = f.machine_id)", a.TEL, a.FAIL, a.ACT)
def label_consistency(spark, d):
    m = a.maintenance(spark, d).groupBy("machine_id").agg(F.max_by("component_replaced", "action_id").alias("component_replaced"), F.max("action_id").alias("action_id"))
    j = eda.label_consistency(a.failures(spark, d), m, "machine_id", [("failure_mode", "component_replaced"), ("event_id", "action_id")])
    return j.select("event_id", "failure_mode_matches", "event_id_matches")


@query("select round(median(abs(pressure_bar - flow_lpm)), 6) as median_error, round(max(abs(pressure_bar - flow_lpm)), 6) as max_error, round(avg(cast(pressure_bar = 0 as double)), 6) as share_at_0, round(avg(cast(pressure_bar = 500 as double)), 6) as share_at_500 from tel", *TELG)
def rul_audit(spark, d):
    return rounded(eda.rul_audit(a.telemetry(spark, d), "pressure_bar", "flow_lpm"))


@query("select x.machine_id, x.action_id, f.event_id from fail f right join (select machine_id, arg_max(action_id, action_timestamp) as action_id from act group by 1) x on x.machine_id = f.machine_id and f.failure_mode = 'pump_wear'", a.TEL, a.FAIL, a.ACT)
def right_outer(spark, d):
    """Failures of one mode against each machine's last action."""
    f = a.failures(spark, d).where("failure_mode = 'pump_wear'").select("machine_id", "event_id")
    x = a.maintenance(spark, d).groupBy("machine_id").agg(F.max_by("action_id", "action_timestamp").alias("action_id"))
    return f.join(x, "machine_id", "right").select("machine_id", "action_id", "event_id")


@query("select machine_id, shift from tel where event_type = 'error' union select machine_id, shift from tel where event_type = 'purchase'", *TELG)
def union_distinct(spark, d):
    t = a.telemetry(spark, d)
    one = lambda k: t.where(F.col("event_type") == k).select("machine_id", "shift")
    return one("error").unionByName(one("purchase")).dropDuplicates()


@query("select machine_id, shift from tel where event_type = 'error' except all select machine_id, shift from tel where event_type = 'purchase'", *TELG)
def except_all(spark, d):
    t = a.telemetry(spark, d)
    return t.where("event_type = 'error'").select("machine_id", "shift").exceptAll(t.where("event_type = 'purchase'").select("machine_id", "shift"))


@query(f"select regime, count(*) as n, round(median(pressure_bar), 6) as pressure_bar, round(median(flow_lpm), 6) as flow_lpm from clean c where not exists (select 1 from fail f where f.machine_id = c.machine_id and c.{T} >= f.degradation_start_timestamp and c.{T} < f.failure_timestamp) group by 1", *CLEANG, a.FAIL)
def regime_medians(spark, d):
    """Medians by regime of the rows outside degradation; standby is a regime."""
    h = series.inside_any(clean(spark, d), a.failures(spark, d), "degradation_start_timestamp", "failure_timestamp").where("not inside")
    n = h.groupBy("regime").agg(F.count(F.lit(1)).alias("n"))
    for c in ("pressure_bar", "flow_lpm"):
        n = n.join(eda.percentiles(h, c, {c: 0.5}, ["regime"]), "regime", "left")
    return rounded(n)


@query(f"select count(*) as n, round(avg(cast(regime = case when hour({T}) between 8 and 19 then 'Day' else 'Night' end as double)), 6) as agreement from clean where regime <> 'Standby'", *CLEANG)
def regime_agreement(spark, d):
    c = clean(spark, d)
    return rounded(regime.regime_agreement(c, c.select("machine_id", "timestamp", F.when(F.hour("timestamp").between(8, 19), "Day").otherwise("Night").alias("shift"))))


@query("select count(*) as n, count(*) filter (where pressure_bar is null or temp_celsius is null or flow_lpm is null or vibration_x_g is null or vibration_y_g is null or pump_rpm is null) as n_missing, count(*) filter (where was_missing_row) as n_added, count(*) filter (where is_standby) as n_standby from clean", *CLEANG)
def cleaning_log(spark, d):
    return clean(spark, d).agg(F.count(F.lit(1)).alias("n"), F.count_if(any_null(list(RANGES))).alias("n_missing"), F.count_if("was_missing_row").alias("n_added"), F.count_if("is_standby").alias("n_standby"))


@query(f"select shift, count(distinct hour({T})) as n_hours, count(distinct day_of_week) as n_days, string_agg(distinct printf('%02d', hour({T})), ',' order by printf('%02d', hour({T}))) as hours from tel group by shift", *TELG)
def shift_definition(spark, d):
    h = F.format_string("%02d", F.hour("timestamp"))
    return a.telemetry(spark, d).groupBy("shift").agg(F.count_distinct(F.hour("timestamp")).alias("n_hours"), F.count_distinct("day_of_week").alias("n_days"), F.array_join(F.array_sort(F.collect_set(h)), ",").alias("hours"))


STATE = f"""st as (select t.*, case when t.{T} >= f.at then 'post_failure' when t.{T} >= f.st then f.mo else 'healthy' end as state, (epoch_us(f.at) - epoch_us(t.{T})) / 3.6e9 as htf from tel t left join
  (select machine_id, min(failure_timestamp) as at, arg_min(degradation_start_timestamp, failure_timestamp) as st, arg_min(failure_mode, failure_timestamp) as mo from fail group by 1) f on f.machine_id = t.machine_id)"""


@query(f"select machine_id, date_trunc('hour', {T}) as hour, state, round(avg(pressure_bar), 6) as pressure_bar from st where pump_rpm >= 1200 and state <> 'post_failure' group by all", a.TEL, a.FAIL, STATE)
def state_hourly_mean(spark, d):
    t = eda.health_state(a.telemetry(spark, d), a.failures(spark, d)).where("pump_rpm >= 1200 and state <> 'post_failure'")
    return rounded(t.groupBy("machine_id", F.window("timestamp", "1 hour")["start"].alias("hour"), "state").agg(F.avg("pressure_bar").alias("pressure_bar")))


@query("select state, -ceil(htf / 12) * 12 / 24 as days_before, round(median(flow_lpm), 6) as flow_lpm from st where htf > 0 and -ceil(htf / 12) * 12 / 24 in (-2.0, -1.0, -0.5) group by all", a.TEL, a.FAIL, STATE)
def trajectory_snapshot(spark, d):
    t = eda.health_state(a.telemetry(spark, d), a.failures(spark, d))
    return rounded(eda.trajectory(t, ["flow_lpm"], mode="state").where(F.col("days_before").isin(-2.0, -1.0, -0.5)))


@query(f"select machine_id, date_trunc('day', {T}) as start, round(arg_max(pressure_bar, {T}), 6) as pressure_bar from tel group by all", *TELG)
def resample_last(spark, d):
    return rounded(eda.resample(a.telemetry(spark, d), "1 day", ["pressure_bar"], "last"))


@query(f"""select * from (
  select 'telemetry' as "table", 'unique (machine_id, timestamp)' as "check", sum(n - 1)::bigint as n_failed from (select count(*) as n from tel group by machine_id, {T})
  union all select 'telemetry', 'shift: isin([''Day'', ''Night'', ''Weekend''])', count(*) from t1 where shift = 'Lunch'
  union all select 'telemetry', s || ' within range', n from (select unnest({str(list(RANGES))}) as s, unnest([{", ".join(f"count(*) filter (where {s} < {lo} or {s} > {hi})" for s, (lo, hi) in RANGES.items())}]) as n from t2)
  union all select 'telemetry', s || ' at floor', n from (select unnest(['vibration_x_g', 'vibration_y_g']) as s, unnest([count(*) filter (where vibration_x_g = 0.05), count(*) filter (where vibration_y_g = 0.05)]) as n from t2)
  union all select 'telemetry', 'missing sensors and dropout flag agree', count(*) filter (where is_sensor_dropout = 1) from t2
  union all select 'telemetry', 'regular 1 minute grid', count(*) filter (where epoch_us({T}) - epoch_us(p) > 60000000) from (select {T}, lag({T}) over (partition by machine_id order by {T}) as p from t2)
  union all select 'telemetry', 'label columns present in telemetry', 1
  union all select k, c, n from (select unnest(['failures', 'maintenance', 'failures', 'maintenance']) as k, unnest(['machine_id exists in telemetry', 'machine_id exists in telemetry', 'events inside telemetry period', 'events inside telemetry period']) as c,
    unnest([(select count(*) from fail where machine_id not in (select machine_id from t2)), (select count(*) from act where machine_id not in (select machine_id from t2)),
      (select count(*) from fail, e where failure_timestamp not between t0 and t1 + interval 1 day), (select count(*) from act, e where action_timestamp not between t0 and t1 + interval 1 day)]) as n)) where n_failed > 0""",
  a.TEL, a.FAIL, a.ACT, f"t1 as (select * from (select *, row_number() over (partition by machine_id, {T} order by event_id) as nth from tel) where nth = 1)", "t2 as (select * from t1 where shift <> 'Lunch')", f"e as (select min({T}) as t0, max({T}) as t1 from t2)")
def validation_report(spark, d):
    """What the gate finds over all three tables, without writing: the lines with a count."""
    tables = {"telemetry": a.telemetry(spark, d).withColumn("is_anomaly", F.lit(0)), "failures": a.failures(spark, d), "maintenance": a.maintenance(spark, d)}
    r = quality.validate_all(tables, DEFAULTS, write=False)[1].to_frame(spark).where("n_failed > 0")
    check = F.regexp_replace(F.regexp_replace("check", r" within \[.*", " within range"), " readings exactly at sensor floor .*", " at floor")
    return r.select("table", check.alias("check"), "n_failed")


@query(f"select hour, day_type, round(median(pressure_bar), 6) as pressure_bar from hz group by all", *CLEANG, a.FAIL, _HEALTHY)
def hour_profile(spark, d):
    return rounded(eda.percentiles(healthy(spark, d).withColumn("hour", F.col("hour").cast("long")), "pressure_bar", {"pressure_bar": 0.5}, ["hour", "day_type"]))


@query("select 'pressure_bar' as \"column\", 'missing' as kind union all select 'k', 'extra' union all select 'flow_lpm as flow', 'renamed'")
def contract_diff(spark, d):
    t = a.telemetry(spark, d).withColumn("k", F.lit(1)).drop("pressure_bar").withColumnRenamed("flow_lpm", "flow")
    diff = quality.contract_diff(t, a.telemetry(spark, d).columns, {"flow_lpm": "flow", "pressure_bar": "pressure"})
    return spark.createDataFrame([(c, k) for k, cs in diff.items() for c in cs], "column string, kind string")
