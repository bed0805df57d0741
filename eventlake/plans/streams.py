"""Registered streaming queries. Each replays the fixture messages (derived
by Spark from ``events``) in slices of arrival time from the shared checkpoint
folder, one ``availableNow`` run per slice on the same checkpoint, and returns the
written result as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.functions.time import epoch_ms
from eventlake.operators import encode as enc
from eventlake.plans import fixtures as fx
from eventlake.schemas import MESSAGE
from eventlake.session import prepare, scratch_path
from eventlake.sinks.tables import Rule, read_failed, read_warehouse_rows, start_warehouse
from eventlake.sinks.tall import CELL, TallTable
from eventlake.sources.log import BUCKET, drain, read_message_log
from eventlake.sources.dims import fixture_dimension, read_dimension
from eventlake.streaming import stats as st
from eventlake.streaming.asof import start_as_of_query
from eventlake.streaming.enrich import RefreshingDimension, start_refreshing_enrich_query
from eventlake.streaming.fanout import FanOut, with_window_ms
from eventlake.sinks.keyed import KeyedTable, window_day
from eventlake.sinks.named import committed_files, start_named_files
from eventlake.streaming.panes import start_pane_query, waiting_late_rows
from eventlake.streaming.replay import SLICE, Steps, arrival_slices, replay, run, stage_slices

S = fx.FIXTURE
#: Minutes of arrival time per slice, and how much before midnight the first slice
#: begins. With 6-hour windows and 30 minutes of lateness, the second slice begins
#: 20 minutes behind a window's end (late rows), the third 50 (dropped rows).
SLICE_MINUTES, SHIFT_MINUTES = 12270, 10
LATE_COUNT = 3


#: Windows, slices and early delay of the query about the age of early panes: two slices
#: lie within the delay, the third does not.
EARLY = S.with_(window_size="240h", early_firing_period="144h")
EARLY_SLICE_MINUTES = 6480
#: Slices and shards of the query about named files.
FILE_SLICE_MINUTES, FILE_SHARDS = 12270, 3


def _staged(spark: SparkSession, sf_dir: str, name: str, messages=fx.messages,
            minutes: int = SLICE_MINUTES) -> tuple[str, list[int]]:
    prepare(spark)
    root = scratch_path(spark, name)
    m = arrival_slices(messages(spark, sf_dir), minutes, SHIFT_MINUTES)
    return root, stage_slices(m, f"{root}/src")


def _valid(stream: DataFrame) -> DataFrame:
    return st.valid_enriched(stream, fixture_dimension(stream.sparkSession), S, process_ts=fx.batch_process_ts())[0]


def _dense_batches(df: DataFrame) -> DataFrame:
    """``batch_id`` counts the micro-batches that wrote rows (few of them)."""
    ids = df.select("batch_id").distinct()
    dense = ids.select("batch_id", (F.row_number().over(Window.orderBy("batch_id")) - 1).cast("bigint").alias("_b"))
    return df.join(F.broadcast(dense), "batch_id").drop("batch_id").withColumnRenamed("_b", "batch_id")


def _stats(spark: SparkSession, sf_dir: str, name: str, mode: str) -> DataFrame:
    root, slices = _staged(spark, sf_dir, name)
    replay(spark, f"{root}/src", slices, MESSAGE,
           lambda s: st.start_stats_query(_valid(s), f"{root}/out", f"{root}/ckpt", S, mode=mode))
    return spark.read.parquet(f"{root}/out")


def q_stream_update_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dense_batches(_stats(spark, sf_dir, "stream_update_stats", "update"))


def q_stream_append_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows still open when the input ends are not emitted: append mode waits for the watermark."""
    return _stats(spark, sf_dir, "stream_append_stats", "append").drop("batch_id")


def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One copy of every message, late ones too (which copy of a slice stays is open)."""
    root, slices = _staged(spark, sf_dir, "stream_dedup", fx.redelivered_messages)
    replay(spark, f"{root}/src", slices, MESSAGE,
           lambda s: st.start_dedup_query(s, f"{root}/out", f"{root}/ckpt", S))
    return spark.read.parquet(f"{root}/out").select(
        F.col("attributes").getItem(S.id_attr).alias("id"), F.col("payload").cast("string").alias("payload"))


def q_stream_dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redelivered and late messages: dedup into a message table, then window stats
    of that table in update and in append mode."""
    root, slices = _staged(spark, sf_dir, "stream_dedup_stats", fx.redelivered_messages)

    def stats(mode: str):
        def start(_: DataFrame):
            clean = spark.readStream.schema(MESSAGE).parquet(f"{root}/messages")
            return st.start_stats_query(_valid(clean), f"{root}/{mode}", f"{root}/ckpt_{mode}", S, mode=mode)
        return start

    replay(spark, f"{root}/src", slices, MESSAGE, Steps(
        lambda s: st.start_dedup_query(s, f"{root}/messages", f"{root}/ckpt", S), stats("update"), stats("append")))
    update = _dense_batches(spark.read.parquet(f"{root}/update")).withColumn("mode", F.lit("update"))
    append = spark.read.parquet(f"{root}/append").drop("batch_id")
    return update.unionByName(append.withColumn("mode", F.lit("append")).withColumn("batch_id", F.lit(-1).cast("bigint")))


def q_stream_error_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters per window with the default trigger: one result when the watermark
    passes the window's end, no lateness."""
    root, slices = _staged(spark, sf_dir, "stream_error_windows", fx.faulty_messages)

    def start(s: DataFrame):
        _, dead = st.valid_enriched(s, fixture_dimension(spark), S, process_ts=fx.batch_process_ts())
        return st.start_error_window_query(dead, f"{root}/out", f"{root}/ckpt", S)

    replay(spark, f"{root}/src", slices, MESSAGE, start)
    return spark.read.parquet(f"{root}/out").drop("batch_id")


END_KEY = "__end__"


def _end_of_input(spark: SparkSession) -> DataFrame:
    """A message far in the future under a key of its own: behind it every window closes."""
    at = 253_402_300_000_000  # the year 9999, in ms
    text = S.csv_delimiter.join([str(at), "0", "end", "0", END_KEY, "0"])
    return spark.range(1).select(
        F.lit("end").alias("message_id"), F.lit(text).cast("binary").alias("payload"),
        F.create_map(F.lit(S.id_attr), F.lit("end"), F.lit(S.ts_attr), F.lit(str(at))).alias("attributes"),
        F.timestamp_millis(F.lit(at)).alias("publish_ts"))


AS_IT_COMES = {"processingTime": "0 seconds"}


def _log(spark: SparkSession, sf_dir: str, name: str, closed: bool = False) -> str:
    """The fixture messages as a message log whose buckets are the slices. ``closed``: the input ends."""
    prepare(spark)
    root = scratch_path(spark, name)
    m = arrival_slices(fx.messages(spark, sf_dir), SLICE_MINUTES, SHIFT_MINUTES).withColumnRenamed(SLICE, BUCKET)
    m.write.partitionBy(BUCKET).parquet(f"{root}/log")
    if closed:
        _end_of_input(spark).withColumn(BUCKET, F.lit(1 << 20)).write.mode("append").partitionBy(BUCKET).parquet(f"{root}/log")
    return root


def _run_panes(spark: SparkSession, root: str, settings, sink=None) -> None:
    """One pane query over the log, a micro-batch per bucket."""
    messages = read_message_log(spark, f"{root}/log", f"{root}/ckpt")
    drain(start_pane_query(_valid(messages), f"{root}/out", f"{root}/ckpt", settings, trigger=AS_IT_COMES, sink=sink))


def _panes(spark: SparkSession, sf_dir: str, name: str, late_count: int = 1, closed: bool = False) -> tuple[DataFrame, str]:
    """The panes that the pane query wrote (dropped rows too), and its folder. ``closed``: the input
    ends, so every window gets its on-time and closing panes."""
    root = _log(spark, sf_dir, name, closed)
    _run_panes(spark, root, S.with_(late_firing_count=late_count))
    return spark.read.parquet(f"{root}/out").where(F.col("dim1") != END_KEY), root


def _fired(panes: DataFrame, mode: str | None = None) -> DataFrame:
    out = panes.where("mode <> 'dropped'" if mode is None else F.col("mode") == mode)
    return out.drop("process_ts", "batch_id") if mode is None else out.drop("process_ts", "batch_id", "mode")


def _with_process_ts(panes: DataFrame) -> DataFrame:
    """A processing time that a replay can repeat: one millisecond per pane behind the window's end."""
    return panes.withColumn("process_ts", F.col("win_end_ms") + F.col("pane_idx"))


def q_stream_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fired(_panes(spark, sf_dir, "stream_panes", LATE_COUNT)[0])


def q_pane_replay_live_discarding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The discarding panes of a running stream, late rows firing one by one."""
    return _fired(_panes(spark, sf_dir, "pane_replay_live_discarding")[0], "discarding")


def q_pane_replay_live_accumulating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fired(_panes(spark, sf_dir, "pane_replay_live_accumulating")[0], "accumulating")


def q_pane_replay_discarding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The discarding panes of an input that ends: all windows close."""
    return _fired(_panes(spark, sf_dir, "pane_replay_discarding", LATE_COUNT, closed=True)[0], "discarding")


def q_pane_replay_accumulating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fired(_panes(spark, sf_dir, "pane_replay_accumulating", LATE_COUNT, closed=True)[0], "accumulating")


def q_lateness_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per window and timing: fired panes, dropped rows, and the late rows that still wait in
    the state of the running stream for more of their kind."""
    panes, root = _panes(spark, sf_dir, "lateness_audit", LATE_COUNT)
    counted = panes.where("mode <> 'accumulating'").select("win_start_ms", "win_end_ms", "timing", "num_records")
    return (counted.unionByName(waiting_late_rows(spark, f"{root}/ckpt", S)).where("num_records > 0")
            .groupBy("win_start_ms", "win_end_ms", "timing").agg(F.sum("num_records").alias("n_rows")))


def q_tall_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enc.tall_encode(_with_process_ts(_fired(_panes(spark, sf_dir, "tall_encode", closed=True)[0], "accumulating")))


def q_wide_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enc.wide_encode(_with_process_ts(_fired(_panes(spark, sf_dir, "wide_encode", closed=True)[0], "discarding")))


def q_read_wide_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide rows of a keyed table that every micro-batch of the pane query merged into, each
    of them twice (as after a failure), added up again."""
    root = _log(spark, sf_dir, "read_wide_total")
    table = KeyedTable(spark, f"{root}/wide", window_day())

    def merge(panes: DataFrame, batch_id: int) -> None:
        cells = enc.wide_encode(panes.where("mode = 'discarding'"))
        for _ in range(2):
            table.merge(cells, batch_id)

    _run_panes(spark, root, S, merge)
    return enc.read_wide_total(table.cells())


def q_sink_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed wide table itself: one row per window, a group of five cells per pane."""
    root = _log(spark, sf_dir, "sink_wide_rows")
    table = KeyedTable(spark, f"{root}/wide", window_day())
    _run_panes(spark, root, S, lambda panes, k: table.merge(enc.wide_encode(panes.where("mode = 'discarding'")), k))
    keys = F.array_sort(F.map_keys("cells"))
    return table.rows().select("row_key", F.size("cells").alias("n_cells"), F.array_join(keys, ",").alias("qualifiers"))


def q_sink_named_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail lines as named files, three shards per window and micro-batch: every file's path and lines."""
    root, slices = _staged(spark, sf_dir, "sink_named_files", minutes=FILE_SLICE_MINUTES)
    s = S.with_(window_size="240h", num_shards=FILE_SHARDS)

    def start(stream: DataFrame):
        detail = enc.csv_line(with_window_ms(enc.detail_rows(_valid(stream), s), s), delimiter=s.csv_delimiter)
        return start_named_files(detail.select("line", "win_start_ms", "win_end_ms", "seq"), f"{root}/files", f"{root}/ckpt", s,
                                 shard=F.col("seq"))

    replay(spark, f"{root}/src", slices, MESSAGE, start)
    return committed_files(spark, f"{root}/files")


def q_sink_warehouse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse rows of a stream in which every tenth row or so breaks a rule of the target: what the
    table holds, and what the failed inserts hold."""
    root, slices = _staged(spark, sf_dir, "sink_warehouse_failures")
    rules = [Rule("seq", "int", required=True), Rule("dim1", required=True), Rule("metrics1", "int", required=True, low=0, high=10**6),
             Rule("event_ts", "bigint", required=True), Rule("dim1_val")]

    def start(s: DataFrame):
        k, text = F.pmod(F.col("seq"), F.lit(50)), F.col("metrics1").cast("string")
        faulty = _valid(s).select(
            "seq", F.when(k != 7, F.col("dim1")).alias("dim1"), "event_ts", "dim1_val",
            F.when(k == 0, F.lit("n/a")).when(k == 17, F.lit("-5")).when(k == 33, F.lit("1000001")).otherwise(text).alias("metrics1"))
        return start_warehouse(faulty, f"{root}/table", f"{root}/ckpt", rules, F.to_date(F.timestamp_millis("event_ts")))

    replay(spark, f"{root}/src", slices, MESSAGE, start)
    rows, failed = read_warehouse_rows(spark, f"{root}/table"), read_failed(spark, f"{root}/table")
    text = lambda c: F.col(c).cast("string")
    return (rows.select("seq", F.lit("rows").alias("route"), F.concat_ws("|", text("event_date"), "dim1", text("metrics1")).alias("value"))
            .unionByName(failed.select(F.get_json_object("raw", "$.seq").cast("int").alias("seq"), F.lit("failed").alias("route"),
                                       F.col("reason").alias("value"))))


def q_read_tall_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 10 tall rows of every key, each by a scan of its prefix."""
    panes, root = _panes(spark, sf_dir, "read_tall_latest", closed=True)
    tall = TallTable(spark, f"{root}/tall")
    cells = enc.tall_encode(_with_process_ts(_fired(panes, "accumulating")))
    tall.write(cells, 0)
    keys = [r[0] for r in panes.select("dim1").distinct().orderBy("dim1").collect()]  # event types
    parts = [tall.latest(k, 10).where("family = 'stats' and qualifier in ('num_records', 'sum')") for k in keys]
    out = parts[0] if parts else spark.createDataFrame([], CELL)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("row_key", "qualifier", "cell_ts", "value")


def q_stream_early_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early panes by their age, per user (many have rows in few slices only, so the
    timer fires their panes). The clock of a row is the end of its slice."""
    root, slices = _staged(spark, sf_dir, "stream_early_delay", minutes=EARLY_SLICE_MINUTES)
    first = spark.read.schema(MESSAGE).parquet(f"{root}/src").agg(F.min(F.unix_micros("publish_ts"))).first()[0] or 0
    begin = first // 86_400_000_000 * 86_400_000 - SHIFT_MINUTES * 60_000
    length = EARLY_SLICE_MINUTES * 60_000
    clock = F.lit(begin) + (F.floor((F.col("arrival_ms") - F.lit(begin)) / F.lit(length)) + 1) * F.lit(length)
    replay(spark, f"{root}/src", slices, MESSAGE, lambda s: start_pane_query(
        _valid(s), f"{root}/out", f"{root}/ckpt", EARLY, keys=("thread_id",), clock=clock))
    return spark.read.parquet(f"{root}/out").where("mode <> 'dropped'").drop("process_ts", "batch_id")


def q_stream_per_trigger_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global window, repeated trigger, discarding: stats of each micro-batch."""
    root, slices = _staged(spark, sf_dir, "stream_per_trigger_stats")
    replay(spark, f"{root}/src", slices, MESSAGE,
           lambda s: st.start_per_trigger_query(_valid(s), f"{root}/out", f"{root}/ckpt"))
    return _dense_batches(spark.read.parquet(f"{root}/out"))


def q_stream_enrich_refreshing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup changes between slices and is re-read every micro-batch (TTL 0):
    from the third slice on, ``error`` is known and ``click`` has a newer value."""
    root, slices = _staged(spark, sf_dir, "stream_enrich_refreshing")
    dim = RefreshingDimension(lambda: read_dimension(spark, path=f"{root}/dim"), ttl_s=0)
    done = []

    def start(s: DataFrame):
        if not done:
            (fixture_dimension(spark).withColumn("updated_at", F.lit(1)).write.parquet(f"{root}/dim"))
        if len(done) == 2:
            (spark.createDataFrame([("error", "support", 1), ("click", "landing", 2)], "dim1 string, dim1_val string, updated_at int")
             .write.mode("append").parquet(f"{root}/dim"))
        done.append(1)
        return start_refreshing_enrich_query(s, dim, f"{root}/out", f"{root}/ckpt", S, process_ts=fx.batch_process_ts())

    replay(spark, f"{root}/src", slices, MESSAGE, start)
    return spark.read.parquet(f"{root}/out").drop("batch_id", "dim_version")


def q_stream_enrich_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup as a change log: known from the start, but ``error`` from the tenth day on, ``click`` with a
    newer value from the 15th, ``view`` gone from the 20th. Events get the value of their time."""
    root, slices = _staged(spark, sf_dir, "stream_enrich_as_of")
    first = spark.read.schema(MESSAGE).parquet(f"{root}/src").agg(F.min(F.unix_micros("publish_ts"))).first()[0] or 0
    t0 = first // 86_400_000_000 * 86_400_000
    day = 86_400_000
    later = spark.createDataFrame([("error", "support", t0 + 10 * day), ("click", "landing", t0 + 15 * day), ("view", None, t0 + 20 * day)],
                                  "dim1 string, dim1_val string, event_ms long")
    changes = fixture_dimension(spark).select("dim1", "dim1_val", F.lit(0).cast("long").alias("event_ms")).unionByName(later)
    at = F.greatest(F.col("event_ms"), F.lit(t0)) - F.lit(t0 - SHIFT_MINUTES * 60_000)
    changes = changes.withColumn("event_time", F.timestamp_millis("event_ms")).withColumn(
        SLICE, F.floor(at / F.lit(SLICE_MINUTES * 60_000)).cast("int"))
    schema = changes.drop(SLICE).schema
    changes.write.partitionBy(SLICE).parquet(f"{root}/changes")
    shown: list[int] = []
    s = S.with_(allowed_lateness="2h")

    def start(messages: DataFrame):
        shown.append(slices[len(shown)])
        log = spark.readStream.schema(schema).parquet(f"{root}/changes/{SLICE}={{{','.join(map(str, shown))}}}")
        events = _valid(messages).select("message_id", "dim1", "metrics1", "event_ms", "event_time")
        return start_as_of_query(events, log, f"{root}/out", f"{root}/ckpt", s)

    replay(spark, f"{root}/src", slices, MESSAGE, start)
    return spark.read.parquet(f"{root}/out")


def q_stream_fanout_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every sink holds after one run over the faulty messages: (sink, key, value)."""
    prepare(spark)
    root = scratch_path(spark, "stream_fanout_sinks")
    fx.faulty_messages(spark, sf_dir).write.parquet(f"{root}/src")
    fan = FanOut(spark.readStream.schema(MESSAGE).parquet(f"{root}/src"), f"{root}/sinks", fixture_dimension(spark), S,
                 process_ts=fx.batch_process_ts())
    fan.run()
    r = f"{root}/sinks"

    def rows(df: DataFrame, sink: str, key, value) -> DataFrame:
        return df.select(F.lit(sink).alias("sink"), key.cast("string").alias("key"), value.cast("string").alias("value"))

    text = lambda *c: F.concat_ws("|", *[F.coalesce(F.col(x).cast("string"), F.lit("-")) for x in c])
    docs = spark.read.text(f"{r}/docs/*/*.ndjson").where(~F.col("value").startswith('{"index"'))
    panes = spark.read.parquet(f"{r}/panes").where("mode = 'accumulating'")
    wide = enc.read_wide_total(fan.wide().cells())
    tall = spark.read.parquet(f"{r}/tall").where("qualifier = 'num_records'")
    return (rows(spark.read.text(f"{r}/csv"), "csv", F.substring_index("value", ",", 1), F.col("value"))
            .union(rows(spark.read.parquet(f"{r}/records"), "records", F.col("seq"), text("event_ts", "dim1", "metrics1", "dim1_val", "window_id")))
            .union(rows(spark.read.parquet(f"{r}/warehouse"), "warehouse", F.col("seq"), text("event_date", "dim1_val", "metrics1")))
            .union(rows(docs, "docs", F.get_json_object("value", "$.seq"), F.col("value")))
            .union(rows(spark.read.text(f"{r}/errors"), "errors", F.lit(None).cast("string"), F.col("value")))
            .union(rows(panes.groupBy("timing").agg(F.count("*").alias("n")), "panes", F.col("timing"), F.col("n")))
            .union(rows(tall.groupBy(F.lit("cells").alias("k")).agg(F.count("*").alias("n")), "tall", F.col("k"), F.col("n")))
            .union(rows(wide, "wide", text("dim1", "win_start_ms"), text("num_records", "sum", "max", "min"))))


STREAM_QUERIES = {
    "stream_update_stats": q_stream_update_stats,
    "stream_append_stats": q_stream_append_stats,
    "stream_dedup": q_stream_dedup,
    "stream_dedup_stats": q_stream_dedup_stats,
    "stream_error_windows": q_stream_error_windows,
    "stream_panes": q_stream_panes,
    "stream_early_delay": q_stream_early_delay,
    "lateness_audit": q_lateness_audit,
    "pane_replay_discarding": q_pane_replay_discarding,
    "pane_replay_accumulating": q_pane_replay_accumulating,
    "pane_replay_live_discarding": q_pane_replay_live_discarding,
    "pane_replay_live_accumulating": q_pane_replay_live_accumulating,
    "tall_encode": q_tall_encode,
    "wide_encode": q_wide_encode,
    "read_wide_total": q_read_wide_total,
    "sink_wide_rows": q_sink_wide_rows,
    "sink_named_files": q_sink_named_files,
    "sink_warehouse_failures": q_sink_warehouse_failures,
    "read_tall_latest": q_read_tall_latest,
    "stream_per_trigger_stats": q_stream_per_trigger_stats,
    "stream_enrich_refreshing": q_stream_enrich_refreshing,
    "stream_enrich_as_of": q_stream_enrich_as_of,
    "stream_fanout_sinks": q_stream_fanout_sinks,
}
