"""Panes of tumbling windows on the engine's own state: early, on-time and late
firings, allowed lateness, late firing count, closing behaviour
FIRE_IF_NON_EMPTY, accumulating and discarding panes with pane metadata.

The rows of a micro-batch are first folded per task into partial aggregates of
(keys, window), so a hot key is a few rows per task. The partials go to
``transformWithState`` keyed by (keys, window): the pane counters live in its state
store (RocksDB), an event-time timer fires the on-time pane at the window's end and closes the
window too if the watermark is past end + lateness by then; else it sets another one for that. Rows
of a key come and go as ``Row``s, a frame per key would cost more than the work. Checkpoints,
restarts and state cleanup are Spark's. With W the watermark (the greatest event time of earlier batches) rows of a
window with W >= end + lateness are dropped (and counted in a ``DROPPED`` row that
carries no pane), W >= end makes a late pane once ``late_firing_count`` rows are
buffered, anything else an early pane. An on-time pane without new rows is emitted
for accumulating panes only; buffered late rows leave with the closing pane.

*Early firings.* Without a ``clock`` every micro-batch fires its early rows, so the
trigger interval is the early period. With a ``clock`` (processing time of a row in
ms, the same for all rows of a micro-batch) an early pane fires by its age: the
first row opens the pane, further rows join it, and it fires in the first
micro-batch that brings the key a row at ``early_firing_period`` or more after the
opening. A key without further rows does not wait for one: a timer fires its pane once
the watermark has moved on by the period from where the pane opened. What the pane
holds when the window ends leaves on time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventlake.functions.shipping import ship_by_value
from eventlake.operators.aggregates import float_avg
from eventlake.session import rocksdb_state
from eventlake.settings import Settings

MODES = ("accumulating", "discarding")


def _fold(keys: list[str], value: str, size: int):
    """Partial aggregates of a task's rows per (keys, window)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["win_start_ms"] = b["event_ms"] // size * size
            g = b.groupby([*keys, "win_start_ms"], dropna=False, sort=False)[value]
            out = g.agg(n="size", s="sum", mn="min", mx="max").reset_index()
            at = b.groupby([*keys, "win_start_ms"], dropna=False, sort=False)[["event_ms", "clock_ms"]].max().reset_index(drop=True)
            yield out.assign(last=at["event_ms"], clock=at["clock_ms"])[[*keys, "win_start_ms", "n", "s", "mn", "mx", "last", "clock"]]

    return run


#: state of a window: totals; pending late rows (p) and early rows (e); counters; when the early pane opened, when it is due
_STATE = ("n", "s", "mn", "mx", "pn", "ps", "pmn", "pmx", "en", "es", "emn", "emx", "on_time",
          "acc_idx", "acc_ns", "dis_idx", "dis_ns", "opened", "due")


class PaneProcessor(StatefulProcessor):
    """State of one (keys, window): running totals, buffered early and late rows, pane counters."""

    def __init__(self, keys: list[str], size: int, lateness: int, late_count: int, number: str, early: int = 0):
        self.keys, self.size, self.lateness, self.late_count, self.number = keys, size, lateness, late_count, number
        self.early = early

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kinds = dict.fromkeys(_STATE, "long") | {"on_time": "boolean"} | {
            p + c: self.number for p in ("", "p", "e") for c in ("s", "mn", "mx")}
        self.totals = handle.getValueState("totals", ", ".join(f"{c} {kinds[c]}" for c in _STATE))

    def _load(self) -> dict | None:
        """The state of the key, None if there is none: one call of the store."""
        got = self.totals.get()
        return None if got is None else dict(zip(_STATE, got))

    @staticmethod
    def _new() -> dict:
        return dict.fromkeys(_STATE, 0) | dict.fromkeys(
            ("mn", "mx", "pmn", "pmx", "emn", "emx", "opened", "due")) | {"on_time": False}

    @staticmethod
    def _add(st: dict, pre: str, n, s, mn, mx) -> None:
        st[pre + "n"], st[pre + "s"] = st[pre + "n"] + n, st[pre + "s"] + s
        st[pre + "mn"] = mn if st[pre + "mn"] is None else min(st[pre + "mn"], mn)
        st[pre + "mx"] = mx if st[pre + "mx"] is None else max(st[pre + "mx"], mx)

    def _fire(self, st: dict, key: tuple, timing: str, delta: tuple | None, last: bool) -> list[tuple]:
        """The rows of one firing. ``delta``: (n, s, mn, mx) new since the last one, None if nothing is."""
        if delta is not None:
            self._add(st, "", *delta)
        out = []
        for mode, idx, ns, stats in (("accumulating", "acc_idx", "acc_ns", (st["n"], st["s"], st["mn"], st["mx"])),
                                     ("discarding", "dis_idx", "dis_ns", delta)):
            if stats is None:
                continue
            out.append((*key, timing, st[idx], -1 if timing == "EARLY" else st[ns], st[idx] == 0, last, *stats, mode))
            st[idx] += 1
            st[ns] += timing != "EARLY"
        return out

    def _rows(self, rows: list[tuple]) -> Iterator[Row]:
        out = Row(*self.keys, "win_start_ms", "timing", "pane_idx", "pane_nonspeculative_idx",
                  "is_first", "is_last", "num_records", "sum", "min", "max", "mode")
        return (out(*r) for r in rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n, s, mn, mx, last, clock = 0, 0, None, None, 0, 0
        for r in rows:
            # a partial of NaN values alone comes as null; it counts rows only
            n, s = n + r["n"], s + (0.0 if r["s"] is None else r["s"])
            if r["mn"] is not None:
                mn = r["mn"] if mn is None else min(mn, r["mn"])
                mx = r["mx"] if mx is None else max(mx, r["mx"])
            last, clock = max(last, r["last"]), max(clock, r["clock"])
        if mn is None:
            mn = mx = float("nan")
        w, end = timerValues.getCurrentWatermarkInMs(), int(key[-1]) + self.size
        if w >= end + self.lateness:
            yield from self._rows([(*key, "DROPPED", 0, 0, False, False, n, s, mn, mx, "dropped")])
            return
        st, out = self._load(), []
        known = st is not None
        st = st if known else self._new()
        if not known:  # the timer of the end registers the closing one, if that is still ahead
            self.handle.registerTimer(end if w < end else end + self.lateness)
        if w < end:
            self._add(st, "e", n, s, mn, mx)
            if st["opened"] is None:
                st["opened"], st["due"] = clock, max(w, last) + self.early
                if self.early and st["due"] < end:
                    self.handle.registerTimer(st["due"])
            if clock - st["opened"] >= self.early:
                out = self._early(st, key)
        else:
            if known and not st["on_time"]:  # the watermark passed the end in this very micro-batch
                out = self._fire(st, key, "ON_TIME", self._take(st, "e"), False)
            st["on_time"] = True
            self._add(st, "p", n, s, mn, mx)
            if st["pn"] >= self.late_count:
                out += self._fire(st, key, "LATE", self._take(st, "p"), False)
        self._store(st)
        yield from self._rows(out)

    def _early(self, st: dict, key: tuple) -> list[tuple]:
        st["opened"] = st["due"] = None
        return self._fire(st, key, "EARLY", self._take(st, "e"), False)

    @staticmethod
    def _take(st: dict, pre: str) -> tuple | None:
        """What is buffered under ``pre``; None if nothing is."""
        got = tuple(st[pre + c] for c in ("n", "s", "mn", "mx"))
        st |= {pre + "n": 0, pre + "s": 0, pre + "mn": None, pre + "mx": None}
        return got if got[0] else None

    def _store(self, st: dict) -> None:
        self.totals.update(tuple(st[c] for c in _STATE))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        st, end = self._load(), int(key[-1]) + self.size
        if st is None:
            return
        at, w, out = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs(), []
        if at < end:  # an early pane is due, unless it has fired or the window has ended
            if st["due"] == at and w < end:
                out = self._early(st, key)
                self._store(st)
            yield from self._rows(out)
            return
        if not st["on_time"]:  # the watermark may be past the close too; the on-time pane comes first
            out = self._fire(st, key, "ON_TIME", self._take(st, "e"), False)
            st["on_time"] = True
        if w < end + self.lateness:
            self.handle.registerTimer(end + self.lateness)
            self._store(st)
        else:
            if st["pn"]:
                out += self._fire(st, key, "LATE", self._take(st, "p"), True)
            self.totals.clear()
        yield from self._rows(out)

    def close(self) -> None:
        pass


def processing_clock() -> Column:
    """The micro-batch's processing time in ms."""
    return F.unix_millis(F.current_timestamp())


def pane_stream(valid: DataFrame, settings: Settings = Settings(), keys=("dim1",), value: str = "metrics1",
                time_col: str = "event_time", clock: Column | None = None) -> DataFrame:
    """The panes of a stream of rows with ``keys``, ``value`` (any integral or
    fractional type), ``event_ms`` and the event time. Keys keep their type. With a
    ``clock`` early panes fire ``early_firing_period`` after they opened."""
    ship_by_value(__name__)
    keys = list(keys)
    integral = isinstance(valid.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    number = "long" if integral else "double"
    named = ", ".join(f"`{k}` {valid.schema[k].dataType.simpleString()}" for k in keys)
    rows = (valid.withWatermark(time_col, "0 seconds")
            .select(*keys, "event_ms", F.col(value).cast(number).alias(value), time_col,
                    (F.lit(0) if clock is None else clock).cast("long").alias("clock_ms"))
            .where(F.col(value).isNotNull()).drop(time_col))
    parts = rows.mapInPandas(_fold(keys, value, settings.window_ms),
                             f"{named}, win_start_ms long, n long, s {number}, mn {number}, mx {number}, last long, clock long")
    panes = parts.groupBy(*keys, "win_start_ms").transformWithState(
        PaneProcessor(keys, settings.window_ms, settings.lateness_ms, settings.late_firing_count, number,
                      0 if clock is None else settings.early_ms),
        f"{named}, win_start_ms long, timing string, pane_idx long, pane_nonspeculative_idx long, is_first boolean, "
        f"is_last boolean, num_records long, sum {number}, min {number}, max {number}, mode string",
        "Append", "EventTime")
    return panes.select(*keys, "win_start_ms", (F.col("win_start_ms") + settings.window_ms).alias("win_end_ms"),
                        F.unix_millis(F.current_timestamp()).alias("process_ts"), "timing", "pane_idx",
                        "pane_nonspeculative_idx", "is_first", "is_last", "num_records", "sum", "max", "min",
                        float_avg(F.col("sum"), F.col("num_records")).alias("avg"), "mode")


def start_pane_query(valid: DataFrame, out_path: str, checkpoint: str, settings: Settings = Settings(),
                     keys=("dim1",), value: str = "metrics1", trigger: dict | None = None, sink=None, clock: Column | None = None):
    """Write the panes under ``out_path/batch_id=<id>/mode=<accumulating|discarding|dropped>``
    (a replayed batch overwrites its own); ``sink(panes, batch_id)`` may take them further."""
    panes = pane_stream(valid, settings, keys, value, clock=clock)

    def write(df: DataFrame, batch_id: int) -> None:
        path = f"{out_path.rstrip('/')}/batch_id={batch_id}"
        df.write.mode("overwrite").partitionBy("mode").parquet(path)
        if sink is not None:
            sink(df.sparkSession.read.schema(df.schema).option("basePath", path).parquet(path), batch_id)

    w = panes.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    with rocksdb_state(valid.sparkSession):
        return w.trigger(**(trigger or {"availableNow": True})).start()


def waiting_late_rows(spark: SparkSession, checkpoint: str, settings: Settings) -> DataFrame:
    """Late rows that the pane query holds back until ``late_firing_count`` are there, per window, read
    from the state at its last committed micro-batch: win_start_ms, win_end_ms, timing, num_records."""
    state = (spark.read.format("statestore").option("stateVarName", "totals").load(checkpoint)
             .select(F.col("key.win_start_ms").alias("win_start_ms"), F.col("value.pn").alias("num_records")))
    return state.where("num_records > 0").select("win_start_ms", (F.col("win_start_ms") + settings.window_ms).alias("win_end_ms"),
                                                 F.lit("LATE").alias("timing"), "num_records")
