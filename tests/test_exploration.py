"""Rank correlations by group, exact samples, neighbour-based information and the pipeline stage, against plain versions."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from millrace.config import DEFAULTS
from millrace.operators import eda, information
from millrace.operators.baseline import MachineNormal, RegimeBaseline
from tests.make import frame, telemetry


def plain_information(pairs, k=3):
    """By distances to all rows, as defined."""
    pairs = [(g, x) for g, x in pairs if g is not None and x is not None and x == x]
    size = {}
    for g, _ in pairs:
        size[g] = size.get(g, 0) + 1
    pairs = [(g, x) for g, x in pairs if size[g] > 1]
    if not pairs:
        return None
    psi = lambda n: sum(1 / i for i in range(1, n)) - 0.5772156649015329
    x, total = np.array([v for _, v in pairs]), 0.0
    labels = np.array([g for g, _ in pairs])
    for i, (g, v) in enumerate(pairs):
        near = np.sort(np.abs(x[(labels == g) & (np.arange(len(x)) != i)] - v))
        n = min(k, len(near))
        d = near[n - 1]
        m = int((x == v).sum() if d == 0 else (np.abs(x - v) < d).sum())
        total += psi(n) - psi(size[g]) - psi(m)
    return max(0.0, psi(len(pairs)) + total / len(pairs))


@pytest.mark.parametrize("parts,k,digits", [(1, 3, 6), (7, 3, 6), (16, 3, 1), (5, 8, 2)])
def test_information_equals_all_pairs(spark, parts, k, digits):
    r = np.random.default_rng(parts + k)
    g = r.integers(0, 4, 2000)
    x = np.round(r.normal(g * 0.7, 1.0), digits)
    x[:300] = 0.5  # many rows of one value
    rows = [(f"m{a}", float(b)) for a, b in zip(g, x, strict=True)] + [("only", 9.0), (None, 1.0), ("m0", None), ("m1", float("nan")), ("two", -5.0), ("two", 7.0)]
    d = spark.createDataFrame(rows, "g string, x double").repartition(3)
    assert abs(information.neighbour_information(d, "g", "x", k, parts).first().mi - plain_information(rows, k)) < 1e-9


def test_information_of_nothing(spark):
    d = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None)], "g string, x double")
    assert information.neighbour_information(d, "g", "x").first().mi is None
    assert information.neighbour_information(d.limit(0), "g", "x").first().mi is None
    n = np.arange(1, 40)
    np.testing.assert_allclose(information.digamma(n), [sum(1 / i for i in range(1, m)) - 0.5772156649015329 for m in n], atol=1e-12)
    with pytest.raises(ValueError):
        eda.mutual_information(d, "g", "x", 5, 1.0, 1.0)


def test_rank_correlations_by_group(spark):
    r = np.random.default_rng(4)
    rows = []
    for i in range(300):
        v = [float(np.round(r.normal(), 1)) for _ in range(3)]
        rows.append((i, [None, "a", "b"][i % 3], v[0], None if i % 5 == 0 else v[0] + v[1], v[2] if i % 3 else 1.0))
    d = spark.createDataFrame(rows, "id int, g string, x double, y double, z double").repartition(3)
    got = {(x.g, x.x, x.y): (x.n, x.spearman) for x in eda.spearman_matrix(d, ["x", "y", "z"], ["id"], ["g"]).collect()}
    p = pd.DataFrame(rows, columns=["id", "g", "x", "y", "z"])
    assert len(got) == 9
    for g in (None, "a", "b"):
        ranks = p[p["g"].isna() if g is None else p["g"] == g][["x", "y", "z"]].rank()
        for a, b in (("y", "x"), ("z", "x"), ("z", "y")):
            n, s = got[g, a, b]
            both = ranks[[a, b]].dropna()
            want = both[a].corr(both[b]) if len(both) > 1 and both.nunique().min() > 1 else float("nan")
            assert n == len(both) and (s is None if math.isnan(want) else abs(s - want) < 1e-12)
    assert eda.spearman_matrix(d.limit(0), ["x", "y"], ["id"], ["g"]).count() == 0
    with pytest.raises(ValueError):
        eda.spearman_matrix(d, ["x"], ["g"], ["g"])


def hashed(seed, *keys):
    return hashlib.sha256("\x1f".join([str(seed), *("" if k is None else str(k) for k in keys)]).encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 7, 2000])
def test_samples_have_exactly_n_rows_of_a_group(spark, n):
    rows = [(i, None if i % 10 == 0 else "big" if i % 2 else "small" if i % 5 == 0 else f"g{i % 3}") for i in range(5000)]
    d = spark.createDataFrame(rows, "id int, g string")
    parts = [sorted((r.g or "", r.id) for r in eda.sampled_exactly(d.repartition(k), n, ["g"], 3, ["id"]).collect()) for k in (1, 6)]
    want = []
    for g in {r[1] for r in rows}:
        want += [(g or "", i) for i, _ in sorted(((i, x) for i, x in rows if x == g), key=lambda r: hashed(3, r[0]))[:n]]
    assert parts[0] == parts[1] == sorted(want)
    assert eda.sampled_exactly(d, n, seed=5).count() == n


def test_draws_with_replacement(spark):
    rows = [(i, None if i % 9 == 0 else "ab"[i % 2]) for i in range(600)]
    d = spark.createDataFrame(rows, "id int, g string").repartition(4)
    got = sorted((r.g or "", r.draw, r.id) for r in eda.resampled_exactly(d, 500, ["g"], 2, ["id"]).collect())
    want = []
    for g in (None, "a", "b"):
        ids = [i for i, x in sorted(((i, x) for i, x in rows if x == g), key=lambda r: hashed(2, r[0]))]
        want += [(g or "", k, ids[int(hashlib.sha256(f"2:{k}".encode()).hexdigest()[:15], 16) % len(ids)]) for k in range(1, 501)]
    assert got == sorted(want) and eda.resampled_exactly(d.limit(0), 5).count() == 0


def test_machine_normal_is_a_stage_that_can_be_saved(spark, tmp_path):
    df = frame(spark, telemetry(days=3, step="10min")).withColumns({"is_standby": F.lit(False), "day_type": F.when(F.weekday("timestamp") >= 5, "weekend").otherwise("workday"), "hour": F.hour("timestamp")})
    signals = DEFAULTS["baseline"]["signals"]
    want = RegimeBaseline(signals, 2, 5).fit_transform(df).orderBy("machine_id", "timestamp").toPandas()
    stage = MachineNormal(signals=signals, referenceDays=2, minSamples=5)
    stage.write().overwrite().save(str(tmp_path / "stage"))
    assert MachineNormal.load(str(tmp_path / "stage")).extractParamMap() == stage.extractParamMap()
    model = Pipeline(stages=[stage]).fit(df)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert again.stages[0].uid == stage.uid and again.stages[0].getOrDefault("referenceDays") == 2
    for m in (model, again):
        pd.testing.assert_frame_equal(m.transform(df).orderBy("machine_id", "timestamp").toPandas(), want)
    assert Pipeline(stages=[MachineNormal()]).fit(df).stages[0].getOrDefault("minSamples") == 20
