"""Streams with holes, late, repeated and stray readings against the batch operators."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.config import DEFAULTS
from millrace.operators import alarms, features, series
from millrace.streaming import keyed

START = datetime(2024, 1, 1)
SCHEMA = "machine_id string, timestamp timestamp, v double, is_standby boolean"


def drained(spark, make, batches, tmp, schema=SCHEMA):
    """All rows that come out, one file a trigger, in the given order."""
    at = str(tmp / "in")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{at}/f={i:03d}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(at)
    name = f"k{abs(hash(at)) % 10**9}"
    q = make(stream).writeStream.outputMode("append").format("memory").queryName(name).option("checkpointLocation", str(tmp / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None
    return spark.table(name)


@pytest.fixture(scope="module")
def few_shuffles(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def minutes(machine, first, last, seed, holes=()):
    r = np.random.default_rng(seed)
    return [(machine, START + timedelta(minutes=m), None if r.random() < 0.1 else float(np.round(r.normal(3 if 40 < m % 180 < 170 else 0, 1), 2)), m % 97 < 3) for m in range(first, last) if not any(a <= m < b for a, b in holes)]


def test_minutes_with_holes_equal_the_batch(spark, tmp_path, few_shuffles):
    a = minutes("A", 0, 240, 1, [(50, 57), (100, 140)])
    b = minutes("B", 0, 150, 2)  # falls silent
    batches = [[x for x in a + b if lo <= (x[1] - START).seconds // 60 < lo + 40] for lo in range(0, 240, 40)]
    late = [("A", START + timedelta(minutes=3), 77.0, False), ("A", START + timedelta(minutes=53), 78.0, False)]
    again = [("A", START + timedelta(minutes=201), 79.0, False)]
    stray = [("A", START + timedelta(minutes=202, seconds=30), 80.0, False)]
    batches[3] += late
    batches[5] += again + stray
    end = [("Z", START + timedelta(hours=9), 0.0, False)]
    out = drained(spark, lambda s: keyed.clean_minutes(s, ["v"], fill=4, lateness="20 minutes"), [*batches, end, []], tmp_path)
    rows = out.collect()
    refused = sorted((r.machine_id, r.v, r.reason) for r in rows if r.reason)
    assert {(v, why) for _, v, why in refused} == {(77.0, "late"), (78.0, "late"), (79.0, "duplicate"), (80.0, "off_grid")}
    came = sum(len(x) for x in batches)
    assert sum(not r.was_missing_row for r in rows) == came  # went out or to quarantine, nothing else
    batch = spark.createDataFrame(a + b, SCHEMA).select("machine_id", "timestamp", "v")
    want = series.forward_fill(series.reindex_grid(batch), ["v"], 4)
    want = {(r.machine_id, r.timestamp): (r.v, r.was_missing_row, r.was_imputed) for r in want.collect()}
    got = {(r.machine_id, r.timestamp): (r.v, r.was_missing_row, r.was_imputed) for r in rows if not r.reason}
    assert {k: v for k, v in got.items() if k in want} == want
    more = sorted(k for k in got if k not in want)
    # After a machine's last reading, as many missing minutes as its patience, by timers.
    assert all(got[k][1] for k in more) and len(more) == 8 and {k[0] for k in more} == {"A", "B"}


def test_sinks_hold_all_rows_once(spark, tmp_path, few_shuffles):
    a = minutes("A", 0, 60, 1)
    at = str(tmp_path / "in")
    for i, rows in enumerate([a[:30], a[30:], [("Z", START + timedelta(hours=5), 1.0, False)], [a[3]]]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{at}/f={i:03d}")
    s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(at)
    cleaned = keyed.clean_minutes(s, ["v"], fill=0)
    put = keyed.to_sinks(cleaned, str(tmp_path / "clean"), str(tmp_path / "late"))
    q = cleaned.writeStream.foreachBatch(put).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    put(spark.read.parquet(str(tmp_path / "late") + "/batch=*").limit(0).withColumn("reason", F.lit(None).cast("string")), 99)
    clean, late = (spark.read.parquet(str(tmp_path / x)) for x in ("clean", "late"))
    assert clean.where("machine_id = 'A'").count() == 60 and late.where("reason = 'late'").count() == 1


RULES = {"high": ("v", 1, 1.0, "median"), "far": ("v", 1, 2.0, "absmean")}


def test_rule_changes_equal_the_batch(spark, tmp_path, few_shuffles):
    rows = minutes("A", 0, 500, 5, [(300, 310)]) + minutes("B", 0, 500, 6)
    batches = [[x for x in rows if lo <= int((x[1] - START).total_seconds()) // 60 < lo + 70] for lo in range(0, 500, 70)]
    out = drained(spark, lambda s: keyed.rule_changes(s, RULES, "30 minute"), batches, tmp_path)
    got = sorted((r.machine_id, r.rule, r.timestamp, r.lit) for r in out.collect())
    flags = alarms.rule_alarms(spark.createDataFrame(rows, SCHEMA), RULES, "30 minute", block=None).orderBy("machine_id", "timestamp").collect()
    want, now = [], {}
    for r in flags:
        for n in [*RULES, "any_rule"]:
            if r[n] != now.get((r.machine_id, n), False):
                want.append((r.machine_id, n, r.timestamp, r[n]))
                now[r.machine_id, n] = r[n]
    assert got == sorted(want) and len(got) > 8


def test_spectra_equal_the_batch(spark, tmp_path, few_shuffles):
    cfg = {**DEFAULTS, "features": {**DEFAULTS["features"], "spectral_window_min": 90}}
    rows = minutes("A", 7, 400, 3, [(200, 205), (290, 370)]) + minutes("B", 0, 130, 4)
    batches = [[x for x in rows if lo <= int((x[1] - START).total_seconds()) // 60 < lo + 45] for lo in range(0, 400, 45)]
    end = [("Z", START + timedelta(hours=30), 0.0, False)]
    out = drained(spark, lambda s: keyed.spectral(s, cfg, "v", "5 minutes"), [*batches, end, []], tmp_path)
    want, _ = features.spectral_features(spark.createDataFrame(rows, SCHEMA), None, cfg, "v")
    key = lambda r: (r.machine_id, r.timestamp)
    names = features.spectral_names(cfg["features"]["spectral_bands"])
    got, want = ({key(r): [np.nan if r[n] is None else r[n] for n in names] for r in x.collect()} for x in (out, want))
    assert sorted(got) == sorted(want) and len(want) > 5
    for k in want:
        np.testing.assert_allclose(got[k], want[k], rtol=1e-9, atol=1e-12)
