"""Session defaults."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """A session in UTC with adaptive execution. Arguments left out keep what the cluster has set."""
    b = (
        SparkSession.builder.appName("millrace")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    return b.getOrCreate()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the folder of ``spark.checkpoint.dir``, which all executors share; lineage is cut there.

    Where the setting is absent and the master is local (tests), a temporary folder is made; on a cluster its absence is an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="millrace_")
        sc.setCheckpointDir(base)
    return df.checkpoint()
