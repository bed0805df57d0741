import uuid

import pytest
from pyspark.sql import functions as F

from eventlake.settings import Settings
from eventlake.streaming.panes import start_pane_query
from eventlake.streaming.replay import SLICE, Steps, replay, stage_slices

S = Settings.deployed()
SEQ = [(0, 1, 1), (1, 5, 2), (1, 7, 9), (2, 9, 4), (3, 2, 300), (4, 4, 5), (5, 4, 5)]
SCHEMA = "dim1 string, event_ms long, metrics1 int"


@pytest.fixture
def work(tmp_path):
    return str(tmp_path)


def _panes(spark, work, settings, rows=None, schema=SCHEMA, slices=None):
    """Panes of SEQ (or ``rows``), one micro-batch per slice, a restart before each."""
    rows = rows or [("x", s * 1000, v, b) for b, v, s in SEQ]
    src = f"{work}/src-{uuid.uuid4().hex[:6]}"
    known = stage_slices(spark.createDataFrame(rows, f"{schema}, {SLICE} int"), src)
    out, ckpt = f"{work}/out-{uuid.uuid4().hex[:6]}", f"{work}/ckpt-{uuid.uuid4().hex[:6]}"
    replay(spark, src, known, schema, lambda st: start_pane_query(
        st.withColumn("event_time", F.timestamp_millis("event_ms")), out, ckpt, settings))
    return spark.read.parquet(out)


def test_pane_sequence(spark, work):
    out = _panes(spark, work, S)
    at = lambda mode, w: out.filter((F.col("mode") == mode) & (F.col("win_start_ms") == w)).orderBy("pane_idx").collect()
    assert [(r.timing, r.pane_idx, r.pane_nonspeculative_idx, r.sum) for r in at("accumulating", 0)] == \
        [("EARLY", 0, -1, 1), ("EARLY", 1, -1, 6), ("ON_TIME", 2, 0, 6), ("LATE", 3, 1, 15)]
    assert [(r.timing, r.pane_idx, r.pane_nonspeculative_idx, r.sum) for r in at("discarding", 0)] == \
        [("EARLY", 0, -1, 1), ("EARLY", 1, -1, 5), ("LATE", 2, 0, 9)]
    assert [(r.timing, r.sum) for r in at("accumulating", 6000)] == [("EARLY", 7), ("ON_TIME", 7)]
    # two rows came when the watermark was past end + lateness: counted, in no pane
    assert sum(r.num_records for r in at("dropped", 0)) == 2


def test_late_count_buffers_until_close(spark, work):
    """late_firing_count=2: the single late row (9@4s) is buffered and fires
    as the closing pane (last) when the watermark passes end + lateness."""
    out = _panes(spark, work, S.with_(late_firing_count=2)).filter("win_start_ms = 0")
    acc = out.filter("mode = 'accumulating'").orderBy("pane_idx").collect()
    assert [(r.timing, r.pane_idx, r.pane_nonspeculative_idx, r.is_last, r.sum) for r in acc] == \
        [("EARLY", 0, -1, False, 1), ("EARLY", 1, -1, False, 6), ("ON_TIME", 2, 0, False, 6), ("LATE", 3, 1, True, 15)]
    dis = out.filter("mode = 'discarding'").orderBy("pane_idx").collect()
    assert [(r.timing, r.sum, r.is_last) for r in dis] == [("EARLY", 1, False), ("EARLY", 5, False), ("LATE", 9, True)]


def test_pane_keys_and_values_of_other_types(spark, work):
    rows = [(7, 1000, 0.5, 0), (7, 2000, 1.25, 0), (8, 3000, 2.0, 1), (None, 1000, 4.0, 1)]
    out = _panes(spark, work, S, rows, "dim1 long, event_ms long, metrics1 double").filter("mode = 'accumulating'")
    assert {(r.dim1, r.sum, r.min) for r in out.collect() if r.timing == "EARLY"} == {(7, 1.75, 0.5), (8, 2.0, 2.0), (None, 4.0, 4.0)}


@pytest.mark.parametrize("late_count", [1, 2])
def test_stream_panes_equal_live_replay(spark, work, late_count):
    """The stream and the batch replay in live mode give the same panes (timing,
    indexes, flags, stats) for both pane kinds, on real rows micro-batched by the
    same arrival rule. Some deliveries are held back by one batch (-> LATE under
    5-day lateness) or three (-> DROPPED)."""
    from conftest import SF001
    from pane_model import pane_replay_accumulating, pane_replay_discarding
    from eventlake.plans import fixtures as fx
    s = Settings.fixture().with_(early_firing_period="120h", allowed_lateness="120h", late_firing_count=late_count)
    held = (F.when(F.pmod(F.col("seq"), F.lit(11)) == 0, 3)
             .when(F.pmod(F.col("seq"), F.lit(7)) == 0, 1).otherwise(0))
    rows = (fx.enriched(spark, SF001).withColumn("arrival_ms", F.col("arrival_ms") + held * F.lit(s.early_ms))
            .select("dim1", "event_ms", "arrival_ms", "metrics1",
                    F.floor(F.col("arrival_ms") / s.early_ms).cast("bigint").alias(SLICE)))
    slices = stage_slices(rows.drop("arrival_ms"), f"{work}/src")
    replay(spark, f"{work}/src", slices, SCHEMA, lambda st: start_pane_query(
        st.withColumn("event_time", F.timestamp_millis("event_ms")), f"{work}/out", f"{work}/ckpt", s))
    cols = ["dim1", "win_start_ms", "timing", "pane_idx", "pane_nonspeculative_idx", "is_first",
            "is_last", "num_records", "sum", "min", "max"]
    out = spark.read.parquet(f"{work}/out")
    for mode, batch in (("accumulating", pane_replay_accumulating), ("discarding", pane_replay_discarding)):
        got = sorted(tuple(r) for r in out.filter(F.col("mode") == mode).select(*cols).collect())
        exp = sorted(tuple(r) for r in batch(rows.withColumnRenamed(SLICE, "_b"), s, live=True).select(*cols).collect())
        assert got == exp, mode
    assert {r.timing for r in out.select("timing").distinct().collect()} == {"EARLY", "ON_TIME", "LATE", "DROPPED"}


def test_slices_are_staged_in_parallel(spark, work):
    df = spark.range(1000).repartition(4).select("id", (F.col("id") % 3).cast("int").alias(SLICE))
    assert stage_slices(df, f"{work}/s") == [0, 1, 2]
    import glob
    assert all(len(glob.glob(f"{work}/s/{SLICE}={k}/part-*")) == 4 for k in range(3))


def test_watermark_keeps_rows_within_lateness_and_drops_those_past_it(spark, work):
    """6 s windows, 8 s lateness: with the watermark past the end, a row counts up to
    end + lateness and not after."""
    from eventlake.streaming.stats import start_stats_query
    rows = [("x", 1000, 1, 0), ("x", 13000, 1, 0), ("x", 2000, 10, 1), ("x", 15000, 1, 1), ("x", 3000, 100, 2)]
    known = stage_slices(spark.createDataFrame(rows, f"{SCHEMA}, {SLICE} int"), f"{work}/src")
    for mode in ("update", "append"):
        replay(spark, f"{work}/src", known, SCHEMA, lambda st: start_stats_query(
            st.withColumn("event_time", F.timestamp_millis("event_ms")), f"{work}/{mode}", f"{work}/ck_{mode}", S, mode=mode))
    first = lambda mode: spark.read.parquet(f"{work}/{mode}").filter("win_start_ms = 0")
    assert first("update").agg(F.max("sum")).first()[0] == 11
    assert [(r.num_records, r.sum) for r in first("append").collect()] == [(2, 11)]


def test_readme_example(spark, work):
    """Dedup into a message table, then stats and panes of it, as the README shows."""
    from eventlake.plans import fixtures as fx
    from eventlake.schemas import MESSAGE
    from eventlake.sources import fixture_dimension, read_message_stream
    from eventlake.streaming.stats import start_dedup_query, start_stats_query, valid_enriched
    from conftest import SF001
    fx.redelivered_messages(spark, SF001).write.parquet(f"{work}/in")
    s, dim = Settings.fixture(), fixture_dimension(spark)
    start_dedup_query(read_message_stream(spark, f"{work}/in"), f"{work}/messages", f"{work}/c0", s).awaitTermination()
    valid, dead = valid_enriched(spark.readStream.schema(MESSAGE).parquet(f"{work}/messages"), dim, s)
    start_stats_query(valid, f"{work}/stats", f"{work}/c1", s, mode="update").awaitTermination()
    start_pane_query(valid, f"{work}/panes", f"{work}/c2", s).awaitTermination()
    assert spark.read.parquet(f"{work}/messages").count() == 1000
    assert spark.read.parquet(f"{work}/stats").agg(F.sum("num_records")).first()[0] == 1000
    assert spark.read.parquet(f"{work}/panes").filter("mode = 'discarding'").agg(F.sum("num_records")).first()[0] == 1000


def test_dedup_keeps_late_messages(spark, work):
    """Messages far behind the latest event time are not redeliveries and stay."""
    from conftest import msg_rows
    from eventlake.schemas import MESSAGE
    from eventlake.streaming.stats import start_dedup_query
    rows = msg_rows(spark, [b"a"] * 5).collect()
    old = [r.asDict() | {"attributes": {"id": f"old{i}", "timestamp": "1000"}} for i, r in enumerate(rows)]
    batches = [rows, [*old, rows[0].asDict()]]
    df = None
    for k, b in enumerate(batches):
        part = spark.createDataFrame(b, MESSAGE).withColumn(SLICE, F.lit(k))
        df = part if df is None else df.union(part)
    known = stage_slices(df, f"{work}/src")
    replay(spark, f"{work}/src", known, MESSAGE, Steps(lambda st: start_dedup_query(st, f"{work}/out", f"{work}/ck", S)))
    assert spark.read.parquet(f"{work}/out").count() == 10


def test_refreshing_dimension_rereads(spark, tmp_path):
    from eventlake.streaming.enrich import RefreshingDimension
    calls = []

    def loader():
        calls.append(1)
        v = "cool" if len(calls) == 1 else "cold"
        return spark.createDataFrame([("teal", v)], "dim1 string, dim1_val string")

    d = RefreshingDimension(loader, ttl_s=0)
    assert d.get().first().dim1_val == "cool"
    assert d.get().first().dim1_val == "cold" and d.version == 2
    keep = RefreshingDimension(loader, ttl_s=3600)
    keep.get()
    keep.get()
    assert keep.version == 1


def test_fanout_all_sinks(spark):
    from conftest import SF001
    from eventlake.plans.streams import q_stream_fanout_sinks
    rows = q_stream_fanout_sinks(spark, SF001).collect()
    n = {s: sum(r.sink == s for r in rows) for s in {r.sink for r in rows}}
    assert n["csv"] == n["records"] == n["warehouse"] == n["docs"] == 900 and n["errors"] == 100
    assert all(len(r.value.split(",")) == 16 for r in rows if r.sink == "csv")


def test_per_trigger_stats_sum_to_totals(spark):
    from conftest import SF001
    from eventlake.plans import fixtures as fx
    from eventlake.plans.streams import q_stream_per_trigger_stats
    out = q_stream_per_trigger_stats(spark, SF001)
    per = {r.dim1: (r.n, r.s) for r in out.groupBy("dim1").agg(F.sum("num_records").alias("n"),
                                                                  F.sum("sum").alias("s")).collect()}
    tot = {r.dim1: (r.n, r.s) for r in fx.enriched(spark, SF001).groupBy("dim1").agg(
        F.count(F.lit(1)).alias("n"), F.sum("metrics1").alias("s")).collect()}
    assert per == tot and out.select("batch_id").distinct().count() > 1
