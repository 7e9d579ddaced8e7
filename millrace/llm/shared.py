"""Places and helpers that all text operators share."""

from __future__ import annotations

import gc
import heapq
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What the contracts call white space: the bytes 0x20 and 0x09 to 0x0D.
SPACE_BYTES = bytes([0x20, *range(0x09, 0x0E)])


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir`` as a URI, which driver and executors all see.

    Where the setting is absent and the master is local (tests), a temporary folder is made and
    set; on a cluster its absence is an error, since a machine-local folder would not be shared.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="millrace_")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base if re.match(r"[a-z0-9+.-]+:", base) else "file://" + base


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder of its own below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder; lineage is cut and a lost executor costs nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


class Stored:
    """A table in the shared folder, as Parquet; ``drop`` when all that reads it has run.

    Hashes make up most of what is stored here, so the pages are not compressed.
    """

    def __init__(self, df: DataFrame, name: str, **options: str):
        self.spark, self.at = df.sparkSession, work_path(df.sparkSession, name)
        df.write.options(**({"compression": "uncompressed"} | options)).parquet(self.at)
        self.df = self.spark.read.schema(df.schema).parquet(self.at)

    def drop(self) -> None:
        drop_path(self.at)


def drop_path(uri: str) -> None:
    from pyarrow.fs import FileSystem

    fs, path = FileSystem.from_uri(uri)
    fs.delete_dir(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of steps that have ended; it acts on the driver's garbage collections."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def smaller_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of fewer rows for tables of long texts, unless the session has a number of its own."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(rows))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_number(key: Column, cuts: list[int]) -> Column:
    """How many of the ascending ``cuts`` are at most ``key``, by binary search; null counts as before all."""
    if not cuts:
        return F.lit(0)
    values = F.array(*[F.lit(c).cast("long") for c in cuts]) if len(cuts) < 64 else F.from_json(F.lit(str(cuts)), "array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    fits = lambda lo, p: (lo + p <= len(cuts)) & (F.get(values, lo + p - 1) <= key)
    return F.aggregate(steps, F.lit(0), lambda lo, p: F.when(F.coalesce(fits(lo, p), F.lit(False)), lo + p).otherwise(lo))


def dealt(number: Column, sizes: dict[int, int], n: int) -> Column:
    """A task below ``n`` for each range number, so that the tasks' sums of sizes come out alike: the largest first, each to the least full."""
    full = [(0, i) for i in range(n)]
    task = [0] * (max(sizes, default=0) + 1)
    for k in sorted(sizes, key=lambda k: (-sizes[k], k)):
        held, task[k] = heapq.heappop(full)
        heapq.heappush(full, (held + sizes[k], task[k]))
    return F.coalesce(F.get(F.from_json(F.lit(str(task)), "array<int>"), number), F.lit(0))
