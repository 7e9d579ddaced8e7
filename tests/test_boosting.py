"""Boosted trees against a plain booster that loops over rows, features and cuts."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import boosting, screening


def table(n=160, seed=3):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        k = int(r.integers(0, 3))
        a = None if r.random() < 0.2 else float(np.round(r.normal(k, 0.8), 1))
        b = float("nan") if k == 2 and r.random() < 0.7 else float(r.integers(0, 6))
        rows.append((f"M{k}", a, b, int(r.integers(0, 3)), None))
    return rows


SCHEMA, NAMES = "machine string, a double, b double, c int, d double", ["a", "b", "c", "d"]


def plain_booster(rows, cuts, rounds, depth, rate, least, l2):
    """Raw scores of each row and class after all rounds, one node at a time."""
    classes = sorted({r[0] for r in rows})
    y = [classes.index(r[0]) for r in rows]
    x = [[None if v is None or math.isnan(v) else sum(c < v for c in cuts[j]) for j, v in enumerate(r[1:])] for r in rows]
    scores = [[math.log(y.count(k) / len(y)) for k in range(len(classes))] for _ in rows]
    unit = 1 << 20
    for _ in range(rounds):
        grads = []
        for s, t in zip(scores, y):
            e = np.exp(np.array(s) - max(s))
            p = e / e.sum()
            one = np.eye(len(classes))[t]
            grads.append((np.rint((p - one) * unit), np.rint(p * (1 - p) * unit)))
        for k in range(len(classes)):
            def grow(ids, left):
                g, h = (sum(int(grads[i][j][k]) for i in ids) / unit for j in (0, 1))
                best = (1e-9, None)
                for j in range(len(x[0])) if left else ():
                    for c in range(max(len(q) for q in cuts)):
                        for way in (True, False):
                            side = lambda i: way if x[i][j] is None else x[i][j] <= c
                            lo = [i for i in ids if side(i)]
                            gl, hl = (sum(int(grads[i][m][k]) for i in lo) / unit for m in (0, 1))
                            gr, hr = g - gl, h - hl
                            if hl >= least and hr >= least:
                                gain = gl * gl / (hl + l2) + gr * gr / (hr + l2) - g * g / (h + l2)
                                if gain > best[0]:
                                    best = (gain, lo)
                if best[1] is None:
                    for i in ids:
                        scores[i][k] += -rate * g / (h + l2)
                    return
                inside = set(best[1])
                grow(best[1], left - 1)
                grow([i for i in ids if i not in inside], left - 1)
            grow(list(range(len(rows))), depth)
    return classes, scores


@pytest.mark.parametrize("depth,bins", [(1, 4), (3, 8)])
def test_trees_equal_a_plain_booster(spark, depth, bins, monkeypatch):
    monkeypatch.setattr(boosting, "ROWS", 40)  # four tasks
    rows = table()
    kw = {"rounds": 5, "depth": depth, "rate": 0.4, "least": 0.5, "l2": 1.0}
    one, many = spark.createDataFrame(rows, SCHEMA).coalesce(1), spark.createDataFrame(rows, SCHEMA).repartition(5)
    model, other = (boosting.fit(d, NAMES, "machine", bins=bins, every=2, **kw) for d in (one, many))
    classes, want = plain_booster(rows, model.cuts, **kw)
    import pyarrow as pa

    x = model.bins([pa.array([r[1 + j] for r in rows], pa.float64()) for j in range(4)])
    for m in (model, other):
        got = m.add(np.tile(m.prior, (len(rows), 1)), x, m.rounds)
        assert m.classes == classes == ["M0", "M1", "M2"]
        np.testing.assert_allclose(got, np.array(want), atol=1e-9)
    said = [r.predicted for r in model.predicted(one.withColumn("n", F.monotonically_increasing_id()), ["n"]).orderBy("n").collect()]
    assert said == [classes[k] for k in np.array(want).argmax(axis=1)]


def test_missing_values_have_a_direction(spark):
    """Only that a value is missing tells the classes apart."""
    rows = [("x" if i % 2 else "y", None if i % 2 else float(i % 5)) for i in range(60)]
    d = spark.createDataFrame(rows, "k string, v double")
    assert boosting.accuracy(boosting.fit(d, ["v"], "k", rounds=3, depth=1), d, "k") == 1.0


def test_edges(spark):
    d = spark.createDataFrame(table(40), SCHEMA)
    none = boosting.fit(d.limit(0), NAMES, "machine", rounds=2)
    assert none.classes == [] and math.isnan(boosting.accuracy(none, d, "machine"))
    same = boosting.fit(d.withColumn("machine", F.lit("M1")), NAMES, "machine", rounds=2)
    assert same.rounds == [] and boosting.accuracy(same, d, "machine") == d.where("machine = 'M1'").count() / 40
    unknown = boosting.fit(d.withColumn("machine", F.when(F.col("machine") != "M2", F.col("machine"))), NAMES, "machine", rounds=2)
    assert unknown.classes == ["M0", "M1"] and math.isnan(boosting.accuracy(unknown, d.limit(0), "machine"))
    with pytest.raises(ValueError):
        unknown.predicted(d, ["machine"], "machine")
    with pytest.raises(ValueError):
        boosting.fit(d, NAMES, "machine", bins=300)


def test_identity_of_machines_needs_features_that_tell(spark):
    """A level of its own gives a machine away in later hours; noise does not."""
    r = np.random.default_rng(1)
    rows = [(f"M{m}", f"2024-01-{1 + h // 8:02d} {h % 8:02d}:00:00", 10.0 * m + float(r.normal()), float(r.normal()), "healthy", 0.0) for m in range(4) for h in range(120)]
    d = spark.createDataFrame(rows, "machine_id string, timestamp string, level double, noise double, failure_mode_label string, standby_share double").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    tell, blind = (screening.multi_feature_identity(d, [f], "2024-01-10", rounds=4, depth=2) for f in ("level", "noise"))
    assert tell > 0.97 and blind < 0.6
    assert math.isnan(screening.multi_feature_identity(d, ["level"], "2023-01-01", rounds=1))
