"""The batch operators that are causal, as Structured Streaming.

Hourly rows are tumbling windows with a watermark; repeated readings are dropped within it; trailing
statistics, lags and limited fills keep a bounded ring of rows a machine in keyed state. Given the rows
of a closed stream, the results equal those of the batch operators.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.operators.features import hourly_expressions


def deduplicated(stream: DataFrame, lateness: str = "10 minutes", key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """The first reading of each key and time; rows later than the watermark fall away."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key, ts])


def hourly(stream: DataFrame, cfg: dict, names: list[str] | None = None, lateness: str = "10 minutes", key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """Hourly features of the registry, stamped with the hour's end, once the watermark has passed it."""
    e, _ = hourly_expressions(cfg)
    return stream.withWatermark(ts, lateness).groupBy(key, F.window(ts, "1 hour").alias("_w")).agg(*(x.alias(n) for n, x in e.items() if names is None or n in names)).select(key, F.col("_w.end").alias(ts), *(n for n in e if names is None or n in names))


def dropout_episodes(stream: DataFrame, gap: str = "2 minutes", lateness: str = "10 minutes", key: str = "machine_id", ts: str = "timestamp", flag: str = "is_sensor_dropout") -> DataFrame:
    """(key, start, stop, n) of dropouts: session windows over flagged rows. The watermark follows these rows, so an episode goes out with a later one."""
    d = stream.where(F.col(flag) == 1).withWatermark(ts, lateness)
    return d.groupBy(key, F.session_window(ts, gap).alias("_w")).agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("stop")).select(key, F.col("_w.start").alias("start"), "stop", "n")


def trailing(stream: DataFrame, col: str, rows: int, least: int | None = None, lag: int = 1, fill: int = 0, key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """(key, ts, value, mean, std, min, max, lag) over the last ``rows`` rows of each key, gaps filled for ``fill`` rows.

    State is the last rows of a key: ``rows`` or ``lag`` values and a count, whatever the stream's length. Rows of a
    batch are taken in order of time; a row older than the last one seen is left out, as its windows have gone out.
    """
    need = max(2, rows // 2) if least is None else least
    kind = stream.schema[ts].dataType.simpleString()

    def step(k: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ring, since, last, held = (list(state.get[0]), state.get[1], state.get[2], state.get[3]) if state.exists else ([], 0, None, None)
        got = pd.concat(list(batches)).sort_values(ts, kind="stable")
        out = []
        for t, v in zip(got[ts], got[col], strict=True):
            if last is not None and t.value <= last:
                continue
            last = t.value
            since, held = (0, v) if pd.notna(v) else (since + 1, held)
            v = v if pd.notna(v) else (held if since <= fill else None)
            ring = [*ring, None if v is None or pd.isna(v) else float(v)][-max(rows, lag + 1) :]
            w = pd.Series([x for x in ring[-rows:] if x is not None], dtype=float)
            ok = len(w) >= need
            before = ring[-1 - lag] if len(ring) > lag else None
            out.append((k[0], t, ring[-1], *((w.mean(), w.std(), w.min(), w.max()) if ok else (None,) * 4), before))
        state.update((ring, since, last if last is not None else 0, None if held is None or pd.isna(held) else float(held)))
        yield pd.DataFrame(out, columns=[key, ts, "value", "mean", "std", "min", "max", "lag"])

    schema = f"{key} string, {ts} {kind}, value double, mean double, std double, min double, max double, lag double"
    d = stream.select(key, ts, F.col(col).cast("double").alias(col))
    return d.groupBy(key).applyInPandasWithState(step, schema, "ring array<double>, since int, last long, held double", "append", GroupStateTimeout.NoTimeout)


def scored(stream: DataFrame, cells: DataFrame, signals: list[str]) -> DataFrame:
    """Deviations from a saved baseline: a join of the stream with the table of cells, which Spark broadcasts if its size allows."""
    from millrace.functions.columns import divided
    from millrace.operators.baseline import CELL

    d = stream.join(cells, CELL, "left")
    return d.withColumns({f"z_{s}": F.when(~F.col("is_standby"), divided(F.col(s) - F.col(f"{s}__median"), F.col(f"{s}__std"))) for s in signals}).drop(*(c for c in cells.columns if c not in CELL))
