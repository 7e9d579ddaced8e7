"""A machine's own normal, by day type and hour of day, learned from its first days."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import divided

CELL = ["machine_id", "day_type", "hour"]


def reference_ends(df: DataFrame, days: int) -> DataFrame:
    return df.groupBy("machine_id").agg((F.min("timestamp") + F.expr(f"interval {days} days")).alias("reference_end"))


def baseline_cells(df: DataFrame, signals: list[str], days: int, least: int) -> DataFrame:
    """(cell, <signal>__median, __std, __count): sparse cells take median and deviation of their day type; deviations have a floor.

    The floor is a quarter of the median deviation over all cells of all machines.
    """
    ref = df.join(reference_ends(df, days), "machine_id").where((F.col("timestamp") < F.col("reference_end")) & ~F.col("is_standby"))
    fine = ref.groupBy(*CELL).agg(*(e for s in signals for e in (F.median(s).alias(f"{s}__median"), F.stddev_samp(s).alias(f"{s}__std"), F.count(s).alias(f"{s}__count"))))
    rough = ref.groupBy("machine_id", "day_type").agg(*(e for s in signals for e in (F.median(s).alias(f"_{s}_m"), F.stddev_samp(s).alias(f"_{s}_s"))))
    d = fine.join(rough, ["machine_id", "day_type"], "left")
    for s in signals:
        few = F.col(f"{s}__count") < least
        d = d.withColumns({f"{s}__median": F.when(few, F.col(f"_{s}_m")).otherwise(F.col(f"{s}__median")), f"{s}__std": F.when(few, F.col(f"_{s}_s")).otherwise(F.col(f"{s}__std"))})
    d = d.select(*CELL, *(f"{s}__{x}" for s in signals for x in ("median", "std", "count")))
    floors = d.agg(*(F.median(f"{s}__std").alias(f"_{s}_floor") for s in signals))
    one = d.join(floors, F.lit(True))
    return one.select(*CELL, *(e for s in signals for e in (F.col(f"{s}__median"), F.when(F.col(f"{s}__std").isNotNull(), F.greatest(f"{s}__std", F.col(f"_{s}_floor") * 0.25)).alias(f"{s}__std"), F.col(f"{s}__count"))))


class RegimeBaseline:
    """fit / transform / save / load over DataFrames. The cells number (machines x day types x hours), so they are small."""

    def __init__(self, signals: list[str], reference_days: int = 14, min_samples: int = 20):
        self.signals, self.reference_days, self.min_samples = signals, reference_days, min_samples
        self.cells: DataFrame | None = None
        self.ends: DataFrame | None = None

    def fit(self, df: DataFrame) -> RegimeBaseline:
        self.release()
        self.cells = baseline_cells(df, self.signals, self.reference_days, self.min_samples).persist()
        self.ends = reference_ends(df, self.reference_days).persist()
        return self

    def release(self) -> None:
        """Let go of what fit() holds; transform() then needs fit() or load() again."""
        for d in (self.cells, self.ends):
            if d is not None:
                d.unpersist()
        self.cells = self.ends = None

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds z_<signal> and pct_<signal> (NULL in standby, without a cell, or where the divisor is 0) and in_baseline_period."""
        if self.cells is None or self.ends is None:
            raise RuntimeError("fit() or load() the baseline first")
        d = df.join(self.cells.drop(*(f"{s}__count" for s in self.signals)), CELL, "left").join(self.ends, "machine_id", "left")
        new = {}
        for s in self.signals:
            m, v = F.col(f"{s}__median"), F.col(f"{s}__std")
            new[f"z_{s}"] = F.when(~F.col("is_standby"), divided(F.col(s) - m, v))
            new[f"pct_{s}"] = F.when(~F.col("is_standby"), (divided(F.col(s), m) - 1) * 100.0)
        new["in_baseline_period"] = F.col("timestamp") < F.col("reference_end")
        return d.withColumns(new).select(*df.columns, *new)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def save(self, path: str) -> None:
        self.cells.write.mode("overwrite").parquet(path)
        self.ends.write.mode("overwrite").parquet(f"{path}.ref")

    @classmethod
    def load(cls, spark: SparkSession, path: str, signals: list[str]) -> RegimeBaseline:
        """Cells and reference ends as saved; the other parameters are the defaults."""
        b = cls(signals)
        b.cells, b.ends = spark.read.parquet(path), spark.read.parquet(f"{path}.ref")
        return b


class _NormalParams(Params):
    signals = Param(Params._dummy(), "signals", "columns that are scored", TypeConverters.toListString)
    referenceDays = Param(Params._dummy(), "referenceDays", "days from a machine's first reading that its normal is learned from", TypeConverters.toInt)
    minSamples = Param(Params._dummy(), "minSamples", "values below which a cell takes its day type's", TypeConverters.toInt)


class MachineNormal(Estimator, _NormalParams, DefaultParamsReadable, DefaultParamsWritable):
    """``RegimeBaseline`` as a stage of a ``pyspark.ml.Pipeline``."""

    @keyword_only
    def __init__(self, *, signals: list[str] | None = None, referenceDays: int = 14, minSamples: int = 20):
        super().__init__()
        self._setDefault(signals=["pressure_bar", "temp_celsius", "flow_lpm", "vibration_x_g", "vibration_y_g"], referenceDays=14, minSamples=20)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> MachineNormalModel:
        signals, days = self.getOrDefault("signals"), self.getOrDefault("referenceDays")
        model = MachineNormalModel(baseline_cells(dataset, signals, days, self.getOrDefault("minSamples")), reference_ends(dataset, days))
        model._resetUid(self.uid)
        return self._copyValues(model)


class MachineNormalModel(Model, _NormalParams, MLReadable, MLWritable):
    """Adds z_<signal>, pct_<signal> and in_baseline_period, as ``RegimeBaseline.transform`` does.

    A fitted model learns anew each time it is used, until it is saved and loaded; a loaded one reads its tables.
    """

    def __init__(self, cells: DataFrame | None = None, ends: DataFrame | None = None):
        super().__init__()
        self.cells, self.ends = cells, ends

    def _transform(self, dataset: DataFrame) -> DataFrame:
        b = RegimeBaseline(self.getOrDefault("signals"))
        b.cells, b.ends = self.cells, self.ends
        return b.transform(dataset)

    def write(self) -> MLWriter:
        return _NormalWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _NormalReader()


class _NormalWriter(MLWriter):
    def __init__(self, model: MachineNormalModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.cells.write.parquet(f"{path}/cells")
        self.model.ends.write.parquet(f"{path}/ends")


class _NormalReader(MLReader):
    def load(self, path: str) -> MachineNormalModel:
        read = self.sparkSession.read.parquet
        model = MachineNormalModel(read(f"{path}/cells"), read(f"{path}/ends"))
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
