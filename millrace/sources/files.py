"""Files in and out: typed CSV readers, layers as Parquet, small artefacts as text."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import missing_if_nan

#: The tables' columns and types.
TELEMETRY = "machine_id string, timestamp timestamp_ntz, pressure_bar double, temp_celsius double, flow_lpm double, vibration_x_g double, vibration_y_g double, pump_rpm double, is_anomaly byte, failure_mode string, rul_hours double, is_sensor_dropout byte, shift string, day_of_week byte"
FAILURES = {"failure_timestamp": "timestamp_ntz", "degradation_start_timestamp": "timestamp_ntz", "downtime_hours": "double", "repair_cost_usd": "double"}
MAINTENANCE = {"action_timestamp": "timestamp_ntz", "cost_usd": "double"}


def find_file(spark: SparkSession, raw_dir: str, name: str) -> str:
    """``raw_dir``/name, or the same name one folder up."""
    up = raw_dir.rstrip("/").rpartition("/")[0]
    for at in (f"{raw_dir.rstrip('/')}/{name}", f"{up}/{name}"):
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return at
    raise FileNotFoundError(f"{name} is neither in {raw_dir} nor in {up}")


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    """Typed by column name; a word where a number should be is an error of reading. NaN becomes NULL.

    Columns outside the contract are read as text. Rows keep the file's order within a partition.
    """
    kinds = dict(x.strip().split(" ") for x in TELEMETRY.split(","))
    schema = ", ".join(f"`{c}` {kinds.get(c, 'string')}" for c in _header(spark, path))
    d = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    return d.withColumns({c: missing_if_nan(c) for c, t in d.dtypes if t == "double"})


def _read_events(spark: SparkSession, path: str, kinds: dict[str, str], renames: dict[str, str] | None) -> DataFrame:
    d = spark.read.option("header", True).option("nullValue", "").csv(path)
    return d.withColumns({c: F.col(c).cast(k) for c, k in kinds.items() if c in d.columns}).withColumnsRenamed(renames or {})


def read_failures(spark: SparkSession, path: str, renames: dict[str, str] | None = None) -> DataFrame:
    return _read_events(spark, path, FAILURES, renames)


def read_maintenance(spark: SparkSession, path: str, renames: dict[str, str] | None = None) -> DataFrame:
    """Only the empty text is missing: the word None stays a value."""
    return _read_events(spark, path, MAINTENANCE, renames)


def ingest(spark: SparkSession, cfg: dict, write: bool = True) -> dict[str, DataFrame]:
    """The three tables as delivered, under the contract's names; with ``write`` also as the bronze layer."""
    raw, renames = cfg["paths"]["raw_dir"], cfg["contract_renames"]
    readers = {"telemetry": lambda p: read_telemetry(spark, p), "failures": lambda p: read_failures(spark, p, renames.get("failures")), "maintenance": lambda p: read_maintenance(spark, p, renames.get("maintenance"))}
    out = {n: read(find_file(spark, raw, cfg["files"][n])) for n, read in readers.items()}
    if write:
        for n, d in out.items():
            write_layer(d, f"{cfg['paths']['interim_dir']}/bronze_{n}.parquet")
    return out


def write_layer(df: DataFrame, path: str, by: list[str] | None = None) -> DataFrame:
    """Write as Parquet and read back, which also cuts the lineage."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).parquet(path)
    return df.sparkSession.read.parquet(path).select(*df.columns)


def read_narrow(spark: SparkSession, path: str) -> DataFrame:
    """Telemetry for exploration: sensors as 32-bit floats, sorted within partitions by machine and time."""
    d = read_telemetry(spark, path)
    d = d.withColumns({c: F.col(c).cast("float") for c, t in d.dtypes if t == "double"})
    return d.repartition("machine_id").sortWithinPartitions("machine_id", "timestamp")


def read_eligible(spark: SparkSession, processed_dir: str) -> tuple[DataFrame, list[str]]:
    """(eligible rows of the labelled table, names of the selected features), as the pipeline wrote them."""
    features = json.loads(read_text(f"{processed_dir}/feature_list.json"))
    return spark.read.parquet(f"{processed_dir}/dataset.parquet").where("eligible"), features


def _file_system(path: str):
    """(file system, path) by the session's Hadoop settings, so that artefacts go where the tables go."""
    spark = SparkSession.active()
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def write_text(path: str, text: str) -> None:
    fs, at = _file_system(path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(path: str) -> str:
    fs, at = _file_system(path)
    spark = SparkSession.active()
    data = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
    finally:
        data.close()


def write_small_csv(df: DataFrame, path: str) -> None:
    """A small table as one CSV file, by the driver; for dictionaries and folds."""
    import csv
    import io

    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    w.writerow(df.columns)
    w.writerows(df.collect())
    write_text(path, out.getvalue())


def write_json(value: object, path: str) -> None:
    write_text(path, json.dumps(value, indent=2, default=str))
