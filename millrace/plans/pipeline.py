"""The whole way from raw files to a labelled feature table."""

from __future__ import annotations

import argparse
import time
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import load_config
from millrace.operators.baseline import RegimeBaseline
from millrace.operators.features import build_features
from millrace.operators.quality import validate_all
from millrace.operators.regime import clean_telemetry
from millrace.operators.screening import identity_chance, multi_feature_identity, select_features
from millrace.operators.splits import assign_folds, eligible, leave_one_machine_out
from millrace.operators.targets import build_targets
from millrace.sources.files import ingest, write_json, write_layer, write_small_csv


def run(spark: SparkSession, cfg: dict, tables: dict[str, DataFrame] | None = None, forest: bool = True) -> dict[str, Any]:
    """Ingest, validate, clean, baseline, features, targets, folds, screening; each layer is written and read back.

    Writes the gold table, feature dictionary, folds, feature list and summary to the processed folder.
    ``forest`` also trains the boosted trees that name machines from all features.
    """
    begin = time.time()
    out, mid = cfg["paths"]["processed_dir"], cfg["paths"]["interim_dir"]
    raw = tables or ingest(spark, cfg)
    valid, report, quarantine = validate_all(raw, cfg)
    valid = {n: spark.read.parquet(f"{mid}/validated_{n}.parquet") for n in valid}
    silver, log = clean_telemetry(valid["telemetry"], cfg)
    b = cfg["baseline"]
    base = RegimeBaseline(b["signals"], b["reference_days"], b["min_samples_per_cell"]).fit(silver)
    base.save(f"{out}/baseline.parquet")
    base.release()
    base = RegimeBaseline.load(spark, f"{out}/baseline.parquet", b["signals"])
    z = write_layer(base.transform(silver), f"{mid}/silver_z.parquet")
    features, dictionary = build_features(z, valid["maintenance"], cfg, base.ends)
    features = write_layer(features, f"{mid}/features.parquet")
    ends = silver.groupBy("machine_id").agg((F.max("timestamp") + F.expr(f"interval {cfg['validation']['sampling_interval']}")).alias("data_end"))
    targets = build_targets(features.select("machine_id", "timestamp"), valid["failures"], cfg, ends)
    folds = leave_one_machine_out(features.select("machine_id"), valid["failures"])
    ds = assign_folds(features.join(targets, ["machine_id", "timestamp"], "left"), folds).withColumn("eligible", eligible())
    ds = write_layer(ds, f"{out}/dataset.parquet", ["fold"])
    kept, screening = select_features(ds, dictionary, cfg)
    split = cfg["leakage_check"]["split_date"]
    names = [r.feature for r in screening.collect()]
    write_small_csv(dictionary.join(screening.drop("group"), "feature", "left").orderBy("position"), f"{out}/feature_dictionary.csv")
    write_small_csv(folds.orderBy("fold"), f"{out}/folds.csv")
    write_json(kept, f"{out}/feature_list.json")
    counts = ds.agg(F.count(F.lit(1)).alias("n"), F.count_if("eligible").alias("e"), F.count_if(F.col("eligible") & F.col("rul_hours").isNotNull()).alias("r")).first()
    summary = {
        "cleaning": log,
        "validation_passed": report.passed,
        "hourly_rows": counts.n,
        "eligible_rows": counts.e,
        "candidate_features": dictionary.count(),
        "selected_features": len(kept),
        "screening": {r.status: r["count"] for r in screening.groupBy("status").count().collect()},
        "identity_chance": identity_chance(ds, split).first().chance,
        "identity_accuracy_all": multi_feature_identity(ds, names, split) if forest else None,
        "identity_accuracy_selected": multi_feature_identity(ds, kept, split) if forest and kept else None,
        "labels": {r.failure_mode_label: r["count"] for r in ds.where("eligible").groupBy("failure_mode_label").count().collect()},
        "rul_known": counts.r,
        "seconds": round(time.time() - begin, 1),
    }
    write_json(summary, f"{out}/pipeline_summary.json")
    return {"dataset": ds, "dictionary": dictionary, "folds": folds, "kept": kept, "screening": screening, "report": report, "quarantine": quarantine, "summary": summary}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="millrace", description="Build the labelled feature table from raw files.")
    p.add_argument("--config", default=None, help="YAML file; defaults are used without it")
    p.add_argument("--root", default=None, help="folder that relative paths are taken from")
    p.add_argument("--no-forest", action="store_true", help="leave out the model that names machines")
    a = p.parse_args(argv)
    from millrace.session import get_session

    got = run(get_session(), load_config(a.config, a.root), forest=not a.no_forest)
    for k, v in got["summary"].items():
        print(f"{k}: {v}")


if __name__ == "__main__":
    main()
