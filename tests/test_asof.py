"""Lookup from a change log, early panes by age, and panes in a session without settings of ours."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from eventlake.settings import Settings
from eventlake.streaming.asof import start_as_of_query
from eventlake.streaming.panes import start_pane_query
from eventlake.streaming.replay import SLICE, replay, stage_slices

EVENT = "message_id string, dim1 string, event_ms long, big long"
CHANGE = "dim1 string, dim1_val string, event_ms long"


def test_late_event_gets_the_value_of_its_time(spark, tmp_path):
    work = str(tmp_path)
    big = 2**60 + 1
    events = [("a", "x", 5, big, 0), ("b", "x", 15, big, 0), ("c", "x", 25, big, 1), ("late", "x", 12, big, 1), ("d", "y", 25, None, 1),
              ("e", None, 25, 1, 1), ("gone", "x", 40, 1, 1), ("early", "x", -5, 1, 1)]
    changes = [("x", "old", 0, 0), ("x", "mid", 10, 0), ("x", "new", 20, 1), ("x", None, 30, 1), ("", "empty key", 0, 0)]
    slices = stage_slices(spark.createDataFrame(events, f"{EVENT}, {SLICE} int"), f"{work}/events")
    stage_slices(spark.createDataFrame(changes, f"{CHANGE}, {SLICE} int"), f"{work}/changes")
    at = lambda df: df.withColumn("event_time", F.timestamp_millis("event_ms"))
    shown = []

    def start(s):
        shown.append(slices[len(shown)])
        log = spark.readStream.schema(CHANGE).parquet(f"{work}/changes/{SLICE}={{{','.join(map(str, shown))}}}")
        return start_as_of_query(at(s), at(log), f"{work}/out", f"{work}/ckpt", Settings(allowed_lateness="1h"), salts=3)

    replay(spark, f"{work}/events", slices, EVENT, start)
    got = {r.message_id: (r.dim1_val, r.big) for r in spark.read.parquet(f"{work}/out").collect()}
    none = Settings().not_found
    assert got == {"a": ("old", big), "b": ("mid", big), "c": ("new", big), "late": ("mid", big), "d": (none, None), "e": (none, 1),
                   "gone": (none, 1), "early": (none, 1)}


def test_early_pane_fires_by_its_age(spark, tmp_path):
    """Two micro-batches inside one delay give one early pane; a key without further rows is woken by the watermark."""
    work, s = str(tmp_path), Settings(window_size="100s", early_firing_period="10s", allowed_lateness="5s")
    rows = [("x", 1_000, 1, 1_000, 0), ("x", 5_000, 2, 5_000, 1), ("idle", 2_000, 7, 2_000, 0), ("x", 12_000, 4, 12_000, 2),
            ("x", 30_000, 8, 30_000, 3), ("x", 101_000, 16, 101_000, 4)]
    slices = stage_slices(spark.createDataFrame(rows, f"dim1 string, event_ms long, metrics1 int, now long, {SLICE} int"), f"{work}/src")
    replay(spark, f"{work}/src", slices, "dim1 string, event_ms long, metrics1 int, now long", lambda st: start_pane_query(
        st.withColumn("event_time", F.timestamp_millis("event_ms")), f"{work}/out", f"{work}/ckpt", s, clock=F.col("now")))
    out = spark.read.parquet(f"{work}/out").where("mode = 'discarding' and win_start_ms = 0").orderBy("pane_idx").collect()
    assert [(r.timing, r.num_records, r.sum) for r in out if r.dim1 == "x"] == [("EARLY", 3, 7), ("ON_TIME", 1, 8)]
    assert [(r.timing, r.num_records, r.sum) for r in out if r.dim1 == "idle"] == [("EARLY", 1, 7)]


def test_panes_in_a_plain_session(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
from eventlake.plans.streams import STREAM_QUERIES
n = STREAM_QUERIES["stream_panes"](spark, "/root/testdata/sf0.001").count()
print("rows", n, spark.conf.get("spark.sql.streaming.stateStore.providerClass"))
"""
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert "rows 1429" in out.stdout and "HDFSBacked" in out.stdout, out.stderr[-1500:]
