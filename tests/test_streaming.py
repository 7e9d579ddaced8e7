from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.config import DEFAULTS
from millrace.operators import series
from millrace.streaming import live
from tests.make import frame, telemetry


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("stream") / "in")
    t = telemetry(days=1, step="10min")
    t.loc[20:24, "pressure_bar"] = np.nan
    t.loc[[30, 31, 60, 130], "is_sensor_dropout"] = 1
    df = frame(spark, t).withColumns({"timestamp": F.col("timestamp").cast("timestamp"), "was_imputed": F.lit(False), "n_invalid_sensors": F.lit(0), "is_standby": F.lit(False)})
    df = df.withColumns({f"{k}_{s}": F.col(s) for s in DEFAULTS["baseline"]["signals"] for k in ("z", "pct")})
    for k in range(4):
        df.where(F.floor(F.hour("timestamp") / 6) == k).coalesce(1).write.mode("append").parquet(at)
    return at, spark.read.parquet(at)


def drained(spark, make, at, schema, mode="append"):
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(at)
    name = f"t{abs(hash((make.__name__, at))) % 10**8}"
    q = make(s).writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    return spark.table(name)


def test_hours_equal_the_batch(spark, source):
    at, df = source

    def hours(s):
        return live.hourly(s, DEFAULTS, ["flow_lpm_mean", "n_minutes"])

    got = {(r.machine_id, r.timestamp): (r.flow_lpm_mean, r.n_minutes) for r in drained(spark, hours, at, df.schema).collect()}
    want = {(r.machine_id, r.end): (r.m, r.n) for r in df.groupBy("machine_id", F.window("timestamp", "1 hour").end.alias("end")).agg(F.avg("flow_lpm").alias("m"), F.count("*").alias("n")).collect()}
    assert len(got) >= len(want) - 4 and all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in got)


def test_repeats_fall_away(spark, source):
    at, df = source

    def once(s):
        return live.deduplicated(s.unionAll(s))

    assert drained(spark, once, at, df.schema).count() == df.count()


def test_episodes(spark, source):
    at, df = source

    def episodes(s):
        return live.dropout_episodes(s, "15 minutes")

    got = sorted(r.n for r in drained(spark, episodes, at, df.schema).collect())
    assert got == [1, 2]


def test_trailing_equals_the_batch(spark, source):
    at, df = source

    def rolling(s):
        return live.trailing(s, "pressure_bar", rows=6, fill=2)

    got = drained(spark, rolling, at, df.schema).where("machine_id = 'HPU_01'").orderBy("timestamp").toPandas()
    f = series.forward_fill(df, ["pressure_bar"], 2)
    b = series.with_rolling_and_lags(f.select("machine_id", "timestamp", "pressure_bar"), ["pressure_bar"], ["pressure_bar"], [6], [1]).where("machine_id = 'HPU_01'").orderBy("timestamp").toPandas()
    assert len(got) == len(b) == 144
    for a, c in (("mean", "roll6h_mean"), ("std", "roll6h_std"), ("min", "roll6h_min"), ("max", "roll6h_max"), ("lag", "lag1h")):
        np.testing.assert_allclose(got[a].astype(float), b[f"pressure_bar_{c}"].astype(float), rtol=1e-9)
