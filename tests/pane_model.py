"""Batch replay of the streaming pane semantics (early / on-time / late
firings, allowed lateness, accumulating vs discarding panes).

Model: micro-batch ``b = floor(arrival_ms / early_ms)``; the event-time
watermark after batch b is the running max of event time over batches <= b
(the last batch closes the bounded input: +inf). For a window ending at E
with allowed lateness L, a row arriving in batch b is

  DROPPED  if wm_before(b) >= E + L
  LATE     if E <= wm_before(b) < E + L
  ON_TIME  if wm_before(b) < E <= wm_after(b)
  EARLY    otherwise.

Scale: rows are touched once, by a partial aggregate to pane partials
``(keys, window, b)``. The watermark is a prefix max over the (small) batch
table, computed as a blocked scan: a per-block running max (partitioned by
block) plus a running max over block maxima (a table of #batches/BLOCK rows).
Timing, pane indexes and running totals are then computed on pane tables
whose size does not depend on the row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.time import LONG_MAX
from eventlake.operators.aggregates import float_avg
from eventlake.session import ensure_checkpoint_dir
from eventlake.settings import Settings

BLOCK = 4096
_UNB = Window.unboundedPreceding


def pane_partials(rows: DataFrame, settings: Settings, keys=("dim1",), value: str = "metrics1",
                  event_ms: str = "event_ms", arrival_ms: str = "arrival_ms") -> DataFrame:
    """Rows -> (keys, win_start_ms, b) with count/sum/min/max and the max event
    time of the group (feeds the watermark)."""
    size, early = settings.window_ms, settings.early_ms
    ev = F.col(event_ms)
    return (rows.groupBy(*keys,
                         (ev - F.pmod(ev, F.lit(size))).alias("win_start_ms"),
                         F.floor(F.col(arrival_ms) / F.lit(early)).cast("bigint").alias("b"))
            .agg(F.count(F.lit(1)).alias("num_records"),
                 F.sum(F.col(value)).cast("bigint").alias("sum"),
                 F.min(F.col(value)).alias("min"), F.max(F.col(value)).alias("max"),
                 F.max(ev).alias("max_event_ms"), F.min(ev).alias("min_event_ms")))


def batch_watermarks(batch_max: DataFrame, block: int = BLOCK, close_input: bool = True) -> DataFrame:
    """(b, bmax[, bmin]) -> (b, wm_before, wm_after[, lo_ms, hi_ms]);
    wm_before null = -inf. With ``close_input`` the last batch's wm_after is
    +inf (end of a bounded input); a live stream never gets there. ``lo_ms`` /
    ``hi_ms`` are the smallest / largest event time overall (with ``bmin``)."""
    has_min = "bmin" in batch_max.columns
    bm = batch_max.withColumn("blk", F.floor(F.col("b") / F.lit(block)).cast("bigint"))
    w = Window.partitionBy("blk").orderBy("b")
    local = bm.select("b", "blk",
                      F.max("bmax").over(w.rowsBetween(_UNB, Window.currentRow)).alias("loc_incl"),
                      F.max("bmax").over(w.rowsBetween(_UNB, -1)).alias("loc_excl"))
    # Block table: one row per BLOCK batches; the whole-table windows below
    # run over it only.
    blocks = bm.groupBy("blk").agg(F.max("bmax").alias("blk_max"), F.max("b").alias("blk_last_b"),
                                   *([F.min("bmin").alias("blk_min")] if has_min else []))
    whole = Window.partitionBy()
    blocks = blocks.select(
        "blk",
        F.max("blk_max").over(Window.orderBy("blk").rowsBetween(_UNB, -1)).alias("prev_max"),
        F.max("blk_last_b").over(whole).alias("last_b"),
        *([F.min("blk_min").over(whole).alias("lo_ms"), F.max("blk_max").over(whole).alias("hi_ms")]
          if has_min else []))
    j = local.join(blocks, "blk")
    wm_after = F.greatest(F.col("loc_incl"), F.col("prev_max"))
    if close_input:
        wm_after = F.when(F.col("b") == F.col("last_b"), F.lit(LONG_MAX)).otherwise(wm_after)
    return j.select(
        "b",
        F.greatest(F.col("loc_excl"), F.col("prev_max")).alias("wm_before"),
        wm_after.alias("wm_after"),
        *(["lo_ms", "hi_ms"] if has_min else []))


def timing_expr(settings: Settings, crossing: str = "ON_TIME"):
    e = F.col("win_start_ms") + F.lit(settings.window_ms)
    before, after = F.col("wm_before"), F.col("wm_after")
    return (F.when(before >= e + F.lit(settings.lateness_ms), F.lit("DROPPED"))
            .when(before >= e, F.lit("LATE"))
            .when(after >= e, F.lit(crossing))
            .otherwise(F.lit("EARLY")))


def _timed(rows: DataFrame, settings: Settings, keys, value: str, crossing: str,
           close_input: bool, materialize: bool = True):
    p = pane_partials(rows, settings, keys, value)
    if materialize and not rows.isStreaming:
        ensure_checkpoint_dir(rows.sparkSession)
        p = p.checkpoint(eager=True)
    wm = batch_watermarks(p.groupBy("b").agg(F.max("max_event_ms").alias("bmax"),
                                             F.min("min_event_ms").alias("bmin")),
                          close_input=close_input)
    if materialize and not rows.isStreaming:
        # one row per micro-batch, read by several branches: computed once
        wm = wm.checkpoint(eager=True)
    t = (p.join(wm.drop("lo_ms", "hi_ms"), "b")
         .withColumn("win_end_ms", F.col("win_start_ms") + F.lit(settings.window_ms))
         .withColumn("timing", timing_expr(settings, crossing)))
    return t, wm


def timed_partials(rows: DataFrame, settings: Settings, keys=("dim1",), value: str = "metrics1",
                   crossing: str = "ON_TIME", materialize: bool = True) -> DataFrame:
    """Pane partials with window end and timing.

    The partials feed two branches (the panes and the watermark); they are
    written once as a reliable checkpoint in the shared checkpoint folder so
    the rows are scanned and shuffled once and a lost executor does not send
    the job back to the source."""
    return _timed(rows, settings, keys, value, crossing, True, materialize)[0]


def _crossings(wm: DataFrame, size: int, shift: int) -> DataFrame:
    """(b, win_end_ms): the batch in which the watermark first reaches
    ``win_end_ms + shift``, for every aligned window end of the data's time
    span. Batch b crosses the values in (wm_before, wm_after]; enumerating
    them yields one row per window end (bounded by time span / window size,
    not by rows)."""
    lo = F.coalesce(F.col("wm_before"), F.col("lo_ms") - F.lit(1)) - F.lit(shift)
    hi = F.least(F.col("wm_after") - F.lit(shift), F.col("hi_ms") + F.lit(size))
    start = lo - F.pmod(lo, F.lit(size)) + F.lit(size)
    stop = hi - F.pmod(hi, F.lit(size))
    return wm.select("b", F.explode(
        F.when(start <= stop, F.sequence(start, stop, F.lit(size).cast("bigint")))
         .otherwise(F.array().cast("array<bigint>"))).alias("win_end_ms"))


def _on_time_panes(t: DataFrame, wm: DataFrame, settings: Settings, keys) -> DataFrame:
    """Live mode: the (empty) ON_TIME firing of every window that was open
    (had an EARLY pane), at the first batch whose watermark reaches the window
    end."""
    opened = (t.filter(F.col("timing") == "EARLY")
              .groupBy(*keys, "win_start_ms", "win_end_ms").agg(F.count(F.lit(1)).alias("_n")))
    return opened.join(_crossings(wm, settings.window_ms, 0), "win_end_ms").select(
        *keys, "win_start_ms", "win_end_ms", "b", F.lit("ON_TIME").alias("timing"),
        F.lit(0).cast("bigint").alias("num_records"), F.lit(0).cast("bigint").alias("sum"),
        F.lit(None).cast("int").alias("min"), F.lit(None).cast("int").alias("max"),
        F.lit(1).alias("_ord"))


_FIRED = "array<struct<b:bigint,num_records:bigint,sum:bigint,min:int,max:int,closing:boolean>>"


def _late_count_panes(late: DataFrame, wm: DataFrame, settings: Settings, keys) -> DataFrame:
    """late_firing_count n > 1: per window, walk its late partials in batch
    order, buffering until n rows are pending, then fire and reset; rows
    still pending when the watermark reaches end + lateness fire as the
    closing (last) pane. A running sum with reset is not a window function,
    so it runs as an ``aggregate`` over the window's late partials -- at most
    lateness / early period + 1 of them."""
    n = settings.late_firing_count
    gc = _crossings(wm, settings.window_ms, settings.lateness_ms).withColumnRenamed("b", "gc_b")
    parts = (late.groupBy(*keys, "win_start_ms", "win_end_ms")
             .agg(F.sort_array(F.collect_list(F.struct(
                 F.col("b").cast("bigint").alias("b"), F.col("num_records").cast("bigint").alias("n"),
                 F.col("sum").cast("bigint").alias("s"), F.col("min").cast("int").alias("mn"),
                 F.col("max").cast("int").alias("mx")))).alias("_parts"))
             .join(gc, "win_end_ms", "left"))
    init = F.struct(F.lit(0).cast("bigint").alias("pn"), F.lit(0).cast("bigint").alias("ps"),
                    F.lit(None).cast("int").alias("pmn"), F.lit(None).cast("int").alias("pmx"),
                    F.array().cast(_FIRED).alias("fired"))

    def step(acc, x):
        pn, ps = acc["pn"] + x["n"], acc["ps"] + x["s"]
        pmn, pmx = F.least(acc["pmn"], x["mn"]), F.greatest(acc["pmx"], x["mx"])
        fire = pn >= F.lit(n)
        pane = F.struct(x["b"].alias("b"), pn.alias("num_records"), ps.alias("sum"), pmn.alias("min"),
                        pmx.alias("max"), F.lit(False).alias("closing"))
        return F.struct(
            F.when(fire, F.lit(0).cast("bigint")).otherwise(pn).alias("pn"),
            F.when(fire, F.lit(0).cast("bigint")).otherwise(ps).alias("ps"),
            F.when(fire, F.lit(None).cast("int")).otherwise(pmn).alias("pmn"),
            F.when(fire, F.lit(None).cast("int")).otherwise(pmx).alias("pmx"),
            F.when(fire, F.concat(acc["fired"], F.array(pane))).otherwise(acc["fired"]).cast(_FIRED)
             .alias("fired"))

    def finish(acc):
        closing = F.struct(F.col("gc_b").alias("b"), acc["pn"].alias("num_records"),
                           acc["ps"].alias("sum"), acc["pmn"].alias("min"), acc["pmx"].alias("max"),
                           F.lit(True).alias("closing"))
        return F.when((acc["pn"] > 0) & F.col("gc_b").isNotNull(),
                      F.concat(acc["fired"], F.array(closing))).otherwise(acc["fired"]).cast(_FIRED)

    fired = parts.select(*keys, "win_start_ms", "win_end_ms",
                         F.explode(F.aggregate("_parts", init, step, finish)).alias("p"))
    return fired.select(
        *keys, "win_start_ms", "win_end_ms", F.col("p.b").alias("b"), F.lit("LATE").alias("timing"),
        F.col("p.num_records").alias("num_records"), F.col("p.sum").alias("sum"),
        F.col("p.min").alias("min"), F.col("p.max").alias("max"),
        F.when(F.col("p.closing"), F.lit(2)).otherwise(F.lit(0)).alias("_ord"))


def lateness_audit(rows: DataFrame, settings: Settings, keys=()) -> DataFrame:
    """Row counts per (keys, window, timing) incl. DROPPED."""
    t = timed_partials(rows, settings, keys=tuple(keys) or ("dim1",))
    return (t.groupBy(*keys, "win_start_ms", "win_end_ms", "timing")
            .agg(F.sum("num_records").alias("n_rows")))


def _panes(rows: DataFrame, settings: Settings, keys, value, crossing, live: bool,
           with_on_time: bool) -> DataFrame:
    if live:
        crossing = "EARLY"
    t, wm = _timed(rows, settings, keys, value, crossing, close_input=not live)
    t = (t.filter(F.col("timing") != "DROPPED")
         .select(*keys, "win_start_ms", "win_end_ms", "b", "timing", "num_records", "sum", "min", "max",
                 F.lit(0).alias("_ord")))
    if settings.late_firing_count > 1:
        late = t.filter(F.col("timing") == "LATE")
        t = t.filter(F.col("timing") != "LATE").unionByName(_late_count_panes(late, wm, settings, keys))
    if live and with_on_time:
        t = t.unionByName(_on_time_panes(t, wm, settings, keys))
    w = Window.partitionBy(*keys, "win_start_ms").orderBy("b", "_ord")
    nonspec = F.sum(F.when(F.col("timing") != "EARLY", 1).otherwise(0)).over(
        w.rowsBetween(_UNB, Window.currentRow))
    # live: only a closing pane is known to be the last; replay of a bounded
    # input: the window's final pane
    last = (F.col("_ord") == 2) if live else \
        (F.row_number().over(Window.partitionBy(*keys, "win_start_ms").orderBy(
            F.col("b").desc(), F.col("_ord").desc())) == 1)
    return t.select(
        *keys, "win_start_ms", "win_end_ms", "b",
        ((F.col("b") + 1) * F.lit(settings.early_ms)).alias("process_ts"),
        "timing",
        (F.row_number().over(w) - 1).cast("bigint").alias("pane_idx"),
        F.when(F.col("timing") == "EARLY", F.lit(-1)).otherwise(nonspec - 1).cast("bigint")
         .alias("pane_nonspeculative_idx"),
        (F.row_number().over(w) == 1).alias("is_first"),
        last.alias("is_last"),
        "num_records", "sum", "min", "max", "_ord")


def pane_replay_discarding(rows: DataFrame, settings: Settings, keys=("dim1",),
                           value: str = "metrics1", crossing: str = "ON_TIME",
                           live: bool = False) -> DataFrame:
    """One row per fired pane with the stats of that pane's rows only.

    ``live=True`` gives what a running stream emits: rows of the batch that
    crosses the window end are EARLY, the input never ends (no final +inf
    watermark) and no pane is known to be the last."""
    p = _panes(rows, settings, keys, value, crossing, live, with_on_time=False)
    return p.drop("_ord").withColumn("avg", float_avg(F.col("sum"), F.col("num_records")))


def pane_replay_accumulating(rows: DataFrame, settings: Settings, keys=("dim1",),
                             value: str = "metrics1", crossing: str = "ON_TIME",
                             live: bool = False) -> DataFrame:
    """One row per fired pane with running stats of the window so far. In
    ``live`` mode an ON_TIME pane re-emits the running total once the
    watermark passes the window end (as the stream does)."""
    p = _panes(rows, settings, keys, value, crossing, live, with_on_time=True)
    w = Window.partitionBy(*keys, "win_start_ms").orderBy("b", "_ord").rowsBetween(_UNB, Window.currentRow)
    acc = p.select(
        *[c for c in p.columns if c not in ("num_records", "sum", "min", "max", "_ord")],
        F.sum("num_records").over(w).alias("num_records"),
        F.sum("sum").over(w).alias("sum"),
        F.min("min").over(w).alias("min"),
        F.max("max").over(w).alias("max"))
    return acc.withColumn("avg", float_avg(F.col("sum"), F.col("num_records")))


def classify_rows(rows: DataFrame, settings: Settings, event_ms: str = "event_ms",
                  arrival_ms: str = "arrival_ms") -> DataFrame:
    """Per-row timing label (joins rows to the batch watermark table; use the
    aggregate forms above when only counts or panes are needed)."""
    size, early = settings.window_ms, settings.early_ms
    ev = F.col(event_ms)
    r = rows.withColumn("win_start_ms", ev - F.pmod(ev, F.lit(size))) \
            .withColumn("b", F.floor(F.col(arrival_ms) / F.lit(early)).cast("bigint"))
    wm = batch_watermarks(r.groupBy("b").agg(F.max(ev).alias("bmax")))
    return (r.join(wm, "b")
            .withColumn("win_end_ms", F.col("win_start_ms") + F.lit(size))
            .withColumn("timing", timing_expr(settings)))
