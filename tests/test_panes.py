"""Pane semantics on the hand-written sequence (window 6 s, lateness 8 s,
early period 2 s, key x, one micro-batch per input group)."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from eventlake.operators import encode as enc
from eventlake.operators.aggregates import window_stats
from pane_model import (classify_rows, lateness_audit, pane_replay_accumulating,
                                       pane_replay_discarding)
from eventlake.settings import Settings
from eventlake.streaming.panes import PaneProcessor

S = Settings.deployed()
# (batch, value, event second)
SEQ = [(0, 1, 1), (1, 5, 2), (1, 7, 9), (2, 9, 4), (3, 2, 300), (4, 4, 5), (5, 4, 5)]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"e{i}", "x", v, s * 1000, b * S.early_ms) for i, (b, v, s) in enumerate(SEQ)]
    df = spark.createDataFrame(data, "id string, dim1 string, metrics1 int, event_ms long, arrival_ms long")
    return df.withColumn("event_time", F.timestamp_millis("event_ms"))


def test_row_timings(rows):
    got = {r.id: r.timing for r in classify_rows(rows, S).collect()}
    assert got == {"e0": "EARLY", "e1": "ON_TIME", "e2": "EARLY", "e3": "LATE",
                   "e4": "EARLY", "e5": "DROPPED", "e6": "DROPPED"}


def test_watermarks(rows):
    wm = {r.b: r.wm_before for r in classify_rows(rows, S).select("b", "wm_before").distinct().collect()}
    assert wm == {0: None, 1: 1000, 2: 9000, 3: 9000, 4: 300000, 5: 300000}


def test_discarding_and_accumulating(rows):
    d = [r.asDict() for r in pane_replay_discarding(rows, S).filter("win_start_ms = 0")
         .orderBy("b").collect()]
    a = [r.asDict() for r in pane_replay_accumulating(rows, S).filter("win_start_ms = 0")
         .orderBy("b").collect()]
    assert [(p["timing"], p["sum"]) for p in d] == [("EARLY", 1), ("ON_TIME", 5), ("LATE", 9)]
    assert [(p["timing"], p["sum"]) for p in a] == [("EARLY", 1), ("ON_TIME", 6), ("LATE", 15)]
    assert [p["pane_idx"] for p in a] == [0, 1, 2]
    assert [p["pane_nonspeculative_idx"] for p in a] == [-1, 0, 1]
    assert [p["is_first"] for p in a] == [True, False, False]
    assert [p["is_last"] for p in a] == [False, False, True]
    assert a[-1]["num_records"] == 3 and a[-1]["min"] == 1 and a[-1]["max"] == 9
    assert a[-1]["avg"] == pytest.approx(5.0)


def test_lateness_audit_counts(rows):
    got = {(r.win_start_ms, r.timing): r.n_rows for r in lateness_audit(rows, S).collect()}
    assert got[(0, "DROPPED")] == 2 and got[(0, "LATE")] == 1 and got[(6000, "EARLY")] == 1


def test_tall_and_wide_cells(rows):
    acc = pane_replay_accumulating(rows, S).filter("win_start_ms = 0")
    tall = {(r.row_key, r.qualifier): r.value for r in enc.tall_encode(acc).collect()}
    key = f"x#{9223372036854775807 - 2 * S.early_ms}#0"
    assert tall[(key, "sum")] == "6"
    assert tall[(key, "timing")] == "ON_TIME"
    assert tall[(key, "pane")] == "PaneInfo{timing=ON_TIME, index=1, onTimeIndex=0}"
    assert tall[(key, "window")] == "[1970-01-01T00:00:00.000Z..1970-01-01T00:00:06.000Z)"
    dis = pane_replay_discarding(rows, S).filter("win_start_ms = 0")
    wide = {(r.row_key, r.qualifier): r.value for r in enc.wide_encode(dis).collect()}
    assert wide[("x#0#6000", "sum#0")] == "1" and wide[("x#0#6000", "sum#2")] == "9"
    assert wide[("x#0#6000", "avg#1")] == "5.0"


def test_panes_recombine_to_window_aggregate(spark):
    """discarding sum == last accumulating pane == read_wide_total == plain
    window aggregate when nothing is dropped (huge lateness)."""
    from eventlake.plans import fixtures as fx
    from conftest import SF001
    s = Settings.fixture().with_(allowed_lateness="1000h")
    e = fx.enriched(spark, SF001)
    plain = {(r.dim1, r.win_start_ms): (r.num_records, r.sum, r.min, r.max)
             for r in window_stats(e, s).collect()}
    dis = pane_replay_discarding(e, s)
    tot = {(r.dim1, r.win_start_ms): (r.num_records, r.sum, r.min, r.max)
           for r in enc.read_wide_total(enc.wide_encode(dis)).collect()}
    acc = pane_replay_accumulating(e, s).filter("is_last")
    last = {(r.dim1, r.win_start_ms): (r.num_records, r.sum, r.min, r.max) for r in acc.collect()}
    assert plain == tot == last
    assert lateness_audit(e, s).filter("timing = 'DROPPED'").count() == 0


def test_live_replay_late_count_closing_pane(rows):
    """late_firing_count=2 in live mode: the one late row waits and fires as
    the closing pane at the batch where the watermark passes end + lateness
    (same panes as the streaming machine)."""
    s2 = S.with_(late_firing_count=2)
    a = pane_replay_accumulating(rows, s2, live=True).filter("win_start_ms = 0").orderBy("pane_idx").collect()
    assert [(p.timing, p.pane_idx, p.pane_nonspeculative_idx, p.is_last, p.sum, p.b) for p in a] == [
        ("EARLY", 0, -1, False, 1, 0), ("EARLY", 1, -1, False, 6, 1), ("ON_TIME", 2, 0, False, 6, 1),
        ("LATE", 3, 1, True, 15, 3)]
    d = pane_replay_discarding(rows, s2, live=True).filter("win_start_ms = 0").orderBy("pane_idx").collect()
    assert [(p.timing, p.sum, p.is_last) for p in d] == [("EARLY", 1, False), ("EARLY", 5, False),
                                                         ("LATE", 9, True)]


class FakeStore:
    """A handle with one value state that keeps count of the calls of the store."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], 0

    def getValueState(self, name, schema):
        return self

    def registerTimer(self, at):
        self.timers.append(at)
        self.calls += 1

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.value = None


class At:
    """Timer values at a watermark, and the info of a timer that is due."""

    def __init__(self, ms):
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms


@pytest.mark.parametrize("watermark, timings, timers", [(6000, ["ON_TIME"], [14000]), (20000, ["ON_TIME"], [])])
def test_a_key_takes_few_calls_of_the_store(watermark, timings, timers):
    store = FakeStore()
    p = PaneProcessor(["k"], 6000, 8000, 1, "long")
    p.init(store)
    part = Row(n=2, s=5, mn=1, mx=4, last=1000, clock=0)
    fired = list(p.handleInputRows(("x", 0), iter([part, part]), At(0)))
    assert [(r.timing, r.num_records, r["sum"], r["min"], r["max"]) for r in fired] == [("EARLY", 4, 10, 1, 4)] * 2
    assert store.calls == 3 and store.timers == [6000]  # read, one timer, write
    store.timers = []
    ended = list(p.handleExpiredTimer(("x", 0), At(watermark), At(6000)))
    assert [r.timing for r in ended] == timings and ended[0].mode == "accumulating"
    assert store.timers == timers and (store.value is None) == (not timers)  # past the close the key is gone at once
    assert not timers or not list(p.handleExpiredTimer(("x", 0), At(14000), At(14000))) and store.value is None


def test_partials_of_nan_alone_count_rows_only():
    store = FakeStore()
    p = PaneProcessor(["k"], 6000, 8000, 1, "double")
    p.init(store)
    part = Row(n=2, s=5.5, mn=1.5, mx=4.0, last=1000, clock=0)
    empty = Row(n=1, s=None, mn=None, mx=None, last=900, clock=0)
    fired = list(p.handleInputRows(("x", 0), iter([empty, part, empty]), At(0)))
    assert [(r.num_records, r["sum"], r["min"], r["max"]) for r in fired] == [(4, 5.5, 1.5, 4.0)] * 2
    fired = list(p.handleInputRows(("y", 0), iter([empty]), At(0)))
    assert fired[1].num_records == 1 and fired[1]["min"] != fired[1]["min"]
