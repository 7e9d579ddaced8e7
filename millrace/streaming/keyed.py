"""Causal operators with keyed state and event-time timers: cleaning with missing minutes, rules, spectra, late rows.

Each keeps a bounded state a machine, whatever the length of the stream, and gives what the batch operator gives for
the rows of a closed stream. They need Spark's RocksDB state store, which they set where the session has the default.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.columns import fresh, micros
from millrace.operators import sliding
from millrace.operators.alarms import RULES
from millrace.operators.features import band_shares, spectral_names
from millrace.operators.series import micros_of

HOUR = 3_600_000_000


def _with_timers(df: DataFrame) -> None:
    conf, name = df.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    if "HDFSBackedStateStoreProvider" in conf.get(name, "HDFSBackedStateStoreProvider"):
        conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _floats(values: Any) -> list[float]:
    return [float("nan") if v is None else float(v) for v in values]


class _Minutes(StatefulProcessor):
    """State: the last minute given out, its values with their ages, and readings that wait for the watermark."""

    def __init__(self, key: str, cols: list[str], step: int, fill: int, patience: int):
        self.key, self.cols, self.step, self.fill, self.patience = key, cols, step, fill, patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("minutes", "sent long, silent int, timer long, age array<int>, held array<double>, at array<long>, v array<double>")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        s, n = self._load(), len(self.cols)
        refused = []
        for b in rows:
            b = b[~b["tick"]]
            for at, *v in zip(b["at"].tolist(), *(b[f"v{i}"].tolist() for i in range(n)), strict=True):
                some = s["sent"] if s["sent"] is not None else next(iter(s["wait"]), at)
                if s["sent"] is not None and at <= s["sent"]:
                    refused.append((at, v, "late"))
                elif (at - some) % self.step:
                    refused.append((at, v, "off_grid"))
                elif at in s["wait"]:
                    refused.append((at, v, "duplicate"))
                else:
                    s["wait"][at] = _floats(v)
        yield self._out(key, s, timerValues, refused)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        s = self._load()
        s["timer"] = None
        yield self._out(key, s, timerValues, [])

    def close(self) -> None:
        pass

    def _load(self) -> dict:
        n = len(self.cols)
        if not self.state.exists():
            return {"sent": None, "silent": 0, "timer": None, "age": [1 << 30] * n, "held": [float("nan")] * n, "wait": {}}
        sent, silent, timer, age, held, at, v = self.state.get()
        return {"sent": sent, "silent": silent, "timer": timer, "age": list(age), "held": _floats(held), "wait": {a: _floats(v[i * n : (i + 1) * n]) for i, a in enumerate(at)}}

    def _out(self, key: Any, s: dict, timers: Any, refused: list) -> pd.DataFrame:
        """The minutes that the watermark has passed, gaps included, then what is refused; sets the next timer and stores the state."""
        passed, wait, n = timers.getCurrentWatermarkInMs() * 1000, s["wait"], len(self.cols)
        last, out = max(wait, default=None), []
        while (now := self._next(s)) is not None and now < passed:
            missing = now not in wait
            if missing and (last is None or now > last) and s["silent"] >= self.patience:
                break  # nobody knows whether the machine goes on
            v, imputed = wait.pop(now, [float("nan")] * n), False
            for i in range(n):
                if v[i] == v[i]:
                    s["age"][i], s["held"][i] = 0, v[i]
                else:
                    s["age"][i] = min(s["age"][i] + 1, 1 << 30)
                    if s["age"][i] <= self.fill:
                        v[i], imputed = s["held"][i], True
            s["sent"], s["silent"] = now, s["silent"] + 1 if missing else 0
            out.append((key[0], now, *v, missing, imputed, None))
        out += [(key[0], at, *_floats(v), False, False, why) for at, v, why in refused]
        due = self._next(s)
        wanted = None if due is None or (not wait and s["silent"] >= self.patience) else due // 1000 + 1
        if wanted != s["timer"]:
            if s["timer"] is not None:
                self.handle.deleteTimer(s["timer"])
            if wanted is not None:
                self.handle.registerTimer(wanted)
            s["timer"] = wanted
        at = sorted(wait)
        self.state.update((s["sent"], s["silent"], s["timer"], s["age"], s["held"], at, [x for a in at for x in wait[a]]))
        return pd.DataFrame(out, columns=["key", "at", *(f"v{i}" for i in range(n)), "missing", "imputed", "reason"]).astype({"at": "int64", "missing": bool, "imputed": bool, "reason": object} | {f"v{i}": float for i in range(n)})

    def _next(self, s: dict) -> int | None:
        return s["sent"] + self.step if s["sent"] is not None else min(s["wait"], default=None)


def clean_minutes(stream: DataFrame, cols: list[str], step: str = "1 minute", fill: int = 15, lateness: str = "10 minutes", patience: int | None = None, key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """(key, ts, cols, was_missing_row, was_imputed, reason): every minute of each machine in order, holes filled for ``fill`` rows.

    A minute goes out when the watermark has passed it, by a timer if its machine is silent; missing ones too, up to
    the last reading and for ``patience`` (by default ``fill``) minutes of silence. Readings that come for a minute that has gone out
    (late), for one that another reading has (duplicate) or between minutes (off_grid) are not lost: they come
    out as they are, with that ``reason``, which is NULL for all others. So the readings that came in are those that went out,
    those with a reason and those that still wait for the watermark.
    """
    _with_timers(stream)
    n = len(cols)
    kind = stream.schema[ts].dataType.simpleString()
    row = lambda tick: F.struct(F.lit(tick).alias("tick"), F.when(F.lit(tick), F.col(ts).cast("timestamp")).alias("clock"), micros(ts).alias("at"), *((F.lit(None) if tick else F.col(c)).cast("double").alias(f"v{i}") for i, c in enumerate(cols)))
    # A tick moves the watermark and may be dropped as late. A reading has no time for the watermark to judge, so it always arrives.
    d = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(F.col(key).cast("string").alias("key"), F.explode(F.array(row(True), row(False))).alias("r")).select("key", "r.*").withWatermark("clock", lateness)
    fields = ", ".join(f"v{i} double" for i in range(n))
    out = d.groupBy("key").transformWithStateInPandas(_Minutes(key, cols, micros_of(step), fill, fill if patience is None else patience), f"key string, at long, {fields}, missing boolean, imputed boolean, reason string", "Append", "EventTime")
    value = lambda i: F.when(~F.isnan(f"v{i}"), F.col(f"v{i}"))
    return out.select(F.col("key").alias(key), F.timestamp_micros("at").cast(kind).alias(ts), *(value(i).alias(c) for i, c in enumerate(cols)), F.col("missing").alias("was_missing_row"), F.col("imputed").alias("was_imputed"), "reason")


def to_sinks(cleaned: DataFrame, clean: str, quarantine: str) -> Callable[[DataFrame, int], None]:
    """For ``writeStream.foreachBatch``: a batch's rows go to one table, those with a reason to another.

    A batch that is run again writes the same partition again, so that no row is there twice.
    """

    def put(batch: DataFrame, number: int) -> None:
        for at, part in ((clean, batch.where("reason is null").drop("reason")), (quarantine, batch.where("reason is not null"))):
            part.write.mode("overwrite").parquet(f"{at}/batch={number}")

    return put


class _Rules(StatefulProcessor):
    """State: the values of the last span, when each rule last failed to hold, and whether it is on."""

    def __init__(self, rules: dict, cols: list[str], span: int):
        self.rules, self.cols, self.span = rules, cols, span

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("rules", "at array<long>, v array<double>, failed array<long>, lit array<boolean>")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        k, names = len(self.cols), [*self.rules, "any_rule"]
        at, v, failed, lit = [], [], [None] * len(self.rules), [False] * len(names)
        if self.state.exists():
            at, v, failed, lit = (list(x) for x in self.state.get())
        new = pd.concat(list(rows)).sort_values("at", kind="stable")
        if at:
            new = new[new["at"] > at[-1]]  # what has been judged is not judged again
        if not len(new):
            return
        old = len(at)
        t = np.r_[np.array(at, np.int64), new["at"].to_numpy(np.int64)]
        x = np.vstack([np.array(_floats(v)).reshape(-1, k), new[[f"v{i}" for i in range(k)]].to_numpy(float)])
        lo, hi = sliding.last_span(t, self.span)
        fresh_ = slice(old, None)
        running = ~new["idle"].to_numpy(bool)
        state = []
        for r, (c, sign, limit, how) in enumerate(self.rules.values()):
            col = x[:, self.cols.index(c)]
            if how == "absmean":
                f = sliding.Frames(col)
                count = f.count(lo, hi)
                with np.errstate(invalid="ignore", divide="ignore"):
                    signal = np.abs(((f.s[hi] - f.s[lo]) / count).astype(float) + f.centre)
            else:
                signal = sign * sliding.quantiles(col, lo, hi)
            ok = (signal > limit)[fresh_]
            bad = np.where(ok, -(1 << 62), t[fresh_])
            bad = np.maximum.accumulate(np.r_[-(1 << 62) if failed[r] is None else failed[r], bad])[1:]
            failed[r] = None if bad[-1] == -(1 << 62) else int(bad[-1])
            state.append((bad <= t[fresh_] - self.span) & running)
        state.append(np.logical_or.reduce(state))
        out = []
        for r, (name, on) in enumerate(zip(names, state, strict=True)):
            for i in np.flatnonzero(on != np.r_[lit[r], on[:-1]]).tolist():
                out.append((key[0], int(t[old + i]), name, bool(on[i])))
            lit[r] = bool(on[-1])
        start = int(np.searchsorted(t, t[-1] - self.span, "right"))
        self.state.update((t[start:].tolist(), x[start:].ravel().tolist(), failed, lit))
        if out:
            yield pd.DataFrame(out, columns=["key", "at", "rule", "lit"])

    def close(self) -> None:
        pass


def rule_changes(stream: DataFrame, rules: dict[str, tuple[str, int, float, str]] = RULES, span: str = "6 hour", key: str = "machine_id", ts: str = "timestamp", standby: str | None = "is_standby") -> DataFrame:
    """(key, ts, rule, lit): one row when a rule of ``rule_alarms``, or any of them, goes on or off; all are off at first.

    The readings of a machine must come in order, as ``clean_minutes`` gives them; older ones than the last are passed over.
    """
    _with_timers(stream)
    if any(c == "vib_xy_delta" for c, *_ in rules.values()) and "vib_xy_delta" not in stream.columns:
        stream = stream.withColumn("vib_xy_delta", F.col("vibration_x_g") - F.col("vibration_y_g"))
    cols = list(dict.fromkeys(c for c, *_ in rules.values()))
    kind = stream.schema[ts].dataType.simpleString()
    idle = F.coalesce(F.col(standby), F.lit(False)) if standby else F.lit(False)
    d = stream.select(F.col(key).cast("string").alias("key"), micros(ts).alias("at"), idle.alias("idle"), *(F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)))
    out = d.groupBy("key").transformWithStateInPandas(_Rules(rules, cols, micros_of(span)), "key string, at long, rule string, lit boolean", "Append", "None")
    return out.select(F.col("key").alias(key), F.timestamp_micros("at").cast(kind).alias(ts), "rule", "lit")


class _Spectra(StatefulProcessor):
    """State: the last values, the hour they are in, and whether its window has gone out."""

    def __init__(self, size: int, bands: list[list[float]]):
        self.size, self.bands = size, bands

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("ring", "v array<double>, last long, sent long")

    def _load(self) -> tuple[list[float], int | None, int | None]:
        return (_floats((x := self.state.get())[0]), x[1], x[2]) if self.state.exists() else ([], None, None)

    def _rows(self, key: Any, found: list[tuple[int, list[float]]]) -> pd.DataFrame:
        shares = band_shares(np.array([w for _, w in found]).reshape(-1, self.size), self.bands)
        return pd.DataFrame({"key": [key[0]] * len(found), "at": [h for h, _ in found]} | {f"s{i}": shares[:, i] for i in range(shares.shape[1])})

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        ring, last, sent = self._load()
        new = pd.concat(list(rows)).sort_values("at", kind="stable")
        found, timer = [], None if last is None else (last // HOUR + 1) * HOUR // 1000
        for at, v in zip(new["at"].tolist(), _floats(new["v"].tolist()), strict=True):
            if last is not None and at <= last:
                continue
            if last is not None and at // HOUR != last // HOUR:
                end = (last // HOUR + 1) * HOUR
                if len(ring) == self.size and sent != end:
                    found.append((end, list(ring)))
                sent = end
            ring, last = [*ring, v][-self.size :], at
        due = None if last is None else (last // HOUR + 1) * HOUR // 1000
        if due != timer or not self.state.exists():
            if timer is not None and sent != timer * 1000:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        self.state.update((ring, last, sent))
        if found:
            yield self._rows(key, found)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        ring, last, sent = self._load()
        end = (last // HOUR + 1) * HOUR
        if expiredTimerInfo.getExpiryTimeInMs() * 1000 == end and sent != end:
            self.state.update((ring, last, end))
            if len(ring) == self.size:
                yield self._rows(key, [(end, ring)])

    def close(self) -> None:
        pass


def spectral(stream: DataFrame, cfg: dict, signal: str = "vibration_x_g", lateness: str = "10 minutes", key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """``spectral_features`` of each hour with a window, once a reading of a later hour has come or the watermark has passed its end."""
    _with_timers(stream)
    size, bands = int(cfg["features"]["spectral_window_min"]), cfg["features"]["spectral_bands"]
    names, kind = spectral_names(bands), stream.schema[ts].dataType.simpleString()
    (clock,) = fresh(stream, "_clock")
    d = stream.withColumn(clock, F.col(ts).cast("timestamp")).withWatermark(clock, lateness).select(F.col(key).cast("string").alias("key"), micros(ts).alias("at"), F.col(signal).cast("double").alias("v"), clock)
    out = d.groupBy("key").transformWithStateInPandas(_Spectra(size, bands), "key string, at long, " + ", ".join(f"s{i} double" for i in range(len(names))), "Append", "EventTime")
    return out.select(F.col("key").alias(key), F.timestamp_micros("at").cast(kind).alias(ts), *(F.when(~F.isnan(f"s{i}"), F.col(f"s{i}")).alias(n) for i, n in enumerate(names)))
