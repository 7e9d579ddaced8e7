"""Feature screening: exclusions, missing shares, constants, machine-identity leaks, redundancy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import place_among
from millrace.operators import boosting
from millrace.operators.splits import eligible

#: Columns that are never features, and the order in which groups are kept.
META = ["machine_id", "timestamp", "regime", "in_baseline_period", "n_minutes", "fold", "failure_mode_label", "rul_hours", "rul_censored", "fail_within_h", "hours_to_failure", "in_repair", "life_cycle", "next_event_id", "is_degrading", "hour_of_day"]
PRIORITY = ["fleet_relative", "hourly_regime", "cross_sensor", "vibration", "rolling", "lag", "spectral", "context", "quality", "maintenance", "hourly_raw"]


def healthy_rows(ds: DataFrame) -> DataFrame:
    return ds.where((F.col("failure_mode_label") == "healthy") & (F.col("standby_share") < 0.5))


def feature_stats(ds: DataFrame, features: list[str]) -> DataFrame:
    """(feature, null_share, std), from one aggregate over all rows."""
    one = ds.agg(*(e for f in features for e in (F.avg(F.col(f).isNull().cast("double")).alias(f"n_{f}"), F.stddev_samp(F.col(f).cast("double")).alias(f"s_{f}"))))
    return one.select(F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f"n_{f}").alias("null_share"), F.col(f"s_{f}").alias("std")) for f in features))).alias("x")).select("x.*")


def correlations(ds: DataFrame, features: list[str]) -> np.ndarray:
    """Pearson correlations over the rows where both values are there; NaN where one does not vary.

    Each task sums its batches' products with 0/1 masks into one matrix of features squared; the matrices are dealt by
    rows and added by tasks of their own, so the driver gets one sum, whose size follows the features and not the rows.
    Columns are centred first. Without rows all are NaN.
    """
    k = len(features)
    means = ds.agg(*(F.avg(F.col(f).cast("double")).alias(f"m{i}") for i, f in enumerate(features))).first()
    centre = np.array([0.0 if m is None else m for m in means])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            x = np.column_stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in b.columns]) - centre
            m = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            got = np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
            total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array([total[:, i].tobytes() for i in range(k)], pa.binary())], names=["i", "g"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for i, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held[i] = held.get(i, 0.0) + np.frombuffer(g)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["i", "g"])

    total = np.zeros((4, k, k))
    parts = ds.select(*(F.col(f).cast("double") for f in features)).mapInArrow(products, "i int, g binary")
    for r in parts.repartition("i").mapInArrow(added, "i int, g binary").collect():
        total[:, r.i] = np.frombuffer(r.g).reshape(4, k)
    n, sx, sxx, sxy = total
    with np.errstate(invalid="ignore", divide="ignore"):
        cov = sxy - sx * sx.T / n
        vx, vy = sxx - sx * sx / n, (sxx - sx * sx / n).T
        return cov / np.sqrt(np.where(vx > 1e-24, vx, np.nan) * np.where(vy > 1e-24, vy, np.nan))


def tree_accuracy(train: np.ndarray, test: np.ndarray, leaves: int = 32, least: int = 20) -> float:
    """Test accuracy of a one-feature classification tree over ordered bins, grown best split first by Gini impurity.

    train and test hold the rows of each bin (a line) and class (a column). NaN without rows on either side.
    """
    if not train.sum() or not test.sum():
        return float("nan")
    counts = np.vstack([np.zeros(train.shape[1]), np.cumsum(train, axis=0)])
    size = counts.sum(axis=1)
    loss = lambda c: c.sum(axis=-1) - (c * c).sum(axis=-1) / np.maximum(c.sum(axis=-1), 1)

    def best(lo: int, hi: int) -> tuple[float, int]:
        cut = np.arange(lo + 1, hi)
        cut = cut[(size[cut] - size[lo] >= least) & (size[hi] - size[cut] >= least)]
        if not len(cut):
            return 0.0, -1
        gain = loss(counts[hi] - counts[lo]) - loss(counts[cut] - counts[lo]) - loss(counts[hi] - counts[cut])
        i = int(gain.argmax())
        return float(gain[i]), int(cut[i])

    parts = [(*best(0, len(train)), 0, len(train))]
    while len(parts) < leaves and max(p[0] for p in parts) > 1e-12:
        i = max(range(len(parts)), key=lambda j: parts[j][0])
        _, cut, lo, hi = parts.pop(i)
        parts += [(*best(lo, cut), lo, cut), (*best(cut, hi), cut, hi)]
    right = sum(test[lo:hi, int((counts[hi] - counts[lo]).argmax())].sum() for *_, lo, hi in parts)
    return float(right / test.sum())


def identity_leak(ds: DataFrame, features: list[str], split_date: str, bins: int = 256) -> DataFrame:
    """(feature, machine_id_accuracy): how well each feature alone names the machine in later healthy hours.

    Values are put into ``bins`` bins between quantiles of the feature (values themselves where these are few), and rows are
    counted by feature, bin, machine and side of the split before any task sees a feature: a tree grows on at
    most bins x machines counts, whatever the number of rows. Missing values count as -999. Machines that are NULL are left out; a feature
    with rows on one side of the date only has NULL, and without healthy rows there is no row.
    """
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.coalesce(F.col(f).cast("double"), F.lit(-999.0)).alias("x")) for f in features)))
    d = healthy_rows(ds).where("machine_id is not null").select(F.col("machine_id"), (F.col("timestamp") < F.lit(split_date).cast("timestamp_ntz")).alias("train"), each.alias("v")).select("machine_id", "train", "v.feature", "v.x")
    cuts = d.groupBy("feature").agg(F.array_sort(F.array_distinct(F.percentile_approx("x", [i / bins for i in range(1, bins)], 10_000))).alias("cuts"))
    n = d.join(cuts, "feature").groupBy("feature", place_among(F.col("x"), F.col("cuts")).alias("bin"), "machine_id", "train").agg(F.count(F.lit(1)).alias("n"))

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        y, names = pd.factorize(g["machine_id"], sort=True)
        b, places = pd.factorize(g["bin"], sort=True)
        sides = []
        for side in (True, False):
            m = np.zeros((len(places), len(names)))
            on = (g["train"] == side).to_numpy()
            np.add.at(m, (b[on], y[on]), g["n"].to_numpy()[on])
            sides.append(m)
        return pd.DataFrame({"feature": [g["feature"].iat[0]], "machine_id_accuracy": [tree_accuracy(*sides)]})

    return n.groupBy("feature").applyInPandas(fit, "feature string, machine_id_accuracy double")


def identity_chance(ds: DataFrame, split_date: str) -> DataFrame:
    """One row: the share of the most frequent machine among later healthy hours."""
    n = healthy_rows(ds).where(F.col("timestamp") >= F.lit(split_date).cast("timestamp_ntz")).groupBy("machine_id").count()
    return n.agg(F.try_divide(F.max("count"), F.sum("count")).alias("chance"))


def multi_feature_identity(ds: DataFrame, features: list[str], split_date: str, rounds: int = 20, depth: int = 3) -> float:
    """Accuracy on later healthy hours of boosted trees that name the machine from all features, fitted to earlier ones.

    Missing values stay missing. A machine without earlier rows is never named; NaN where a side of the date has no rows.
    """
    d = healthy_rows(ds).where("machine_id is not null").select("machine_id", "timestamp", *features)
    before = F.col("timestamp") < F.lit(split_date).cast("timestamp_ntz")
    return boosting.accuracy(boosting.fit(d.where(before), features, "machine_id", rounds, depth), d.where(~before), "machine_id")


def select_features(ds: DataFrame, dictionary: DataFrame, cfg: dict) -> tuple[list[str], DataFrame]:
    """(kept features in order of priority, report a feature): config, missing, constant, identity leak, correlation, in this order."""
    f, leak = cfg["features"], cfg["leakage_check"]
    groups = {r.feature: r.group for r in dictionary.orderBy("position").collect()}
    numeric = ("double", "float", "bigint", "int", "smallint", "tinyint")
    names = [c for c, t in ds.dtypes if c in groups and c not in META and t in numeric]
    rows = ds.where(eligible())
    stats = {r.feature: r for r in feature_stats(rows, names).collect()}
    accuracy = {r.feature: r.machine_id_accuracy for r in identity_leak(ds, names, leak["split_date"]).collect()}
    status: dict[str, str] = {}
    for c in names:
        if c.startswith(tuple(f["exclude_from_model"])) or groups[c] in f["exclude_groups"]:
            status[c] = "excluded_by_config"
        elif (stats[c].null_share or 0) > 0.5:
            status[c] = "dropped_mostly_missing"
        elif (stats[c].std or 0) < 1e-9:
            status[c] = "dropped_constant"
        elif (accuracy.get(c) or 0) > leak["single_feature_flag_accuracy"]:
            status[c] = "dropped_identity_leak"
        else:
            status[c] = "kept"
    live = sorted((c for c in names if status[c] == "kept"), key=lambda c: (PRIORITY.index(groups[c]) if groups[c] in PRIORITY else 99, names.index(c)))
    r = np.abs(correlations(rows, live)) if live else np.zeros((0, 0))
    kept: list[int] = []
    detail: dict[str, str] = {}
    for i, c in enumerate(live):
        near = [k for k in kept if r[i, k] > f["corr_prune_threshold"]]
        if near:
            status[c], detail[c] = "dropped_correlated", f"|r| > {f['corr_prune_threshold']} with {live[near[0]]}"
        else:
            kept.append(i)
    out = [(c, groups[c], status[c], detail.get(c, ""), stats[c].null_share, accuracy.get(c)) for c in names]
    return [live[i] for i in kept], ds.sparkSession.createDataFrame(out, "feature string, group string, status string, detail string, nan_share double, machine_id_accuracy double")
