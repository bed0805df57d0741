"""Stream building blocks on the built-in stateful operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.time import epoch_ms
from eventlake.operators.aggregates import window_bounds, window_stats
from eventlake.operators.dedup import dedup_stream
from eventlake.operators.enrich import enrich
from eventlake.operators.parse import parse_messages, split_routes
from eventlake.settings import Settings, spark_interval


def watermark_delay_ms(settings: Settings) -> int:
    """A windowed aggregate compares the *window end* with the watermark, so a
    delay of the allowed lateness is the exact rule: a row counts until the
    greatest event time seen reaches its window's end + lateness."""
    return settings.lateness_ms


def valid_enriched(messages: DataFrame, dim: DataFrame, settings: Settings = Settings(),
                   process_ts: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """messages (batch or stream) -> (enriched valid rows with event_ms and
    arrival_ms, dead letters). Redeliveries are removed before, by
    ``start_dedup_query``."""
    valid, dead = split_routes(parse_messages(messages, settings, process_ts=process_ts))
    e = enrich(valid, dim, settings)
    e = e.withColumn("event_ms", epoch_ms(F.col("event_time"))) \
         .withColumn("arrival_ms", epoch_ms(F.col("publish_ts")))
    return e, dead


def windowed_stats_stream(valid: DataFrame, settings: Settings = Settings(),
                          keys=("dim1",)) -> DataFrame:
    """Watermarked tumbling-window stats. Output mode ``update`` re-emits the
    running totals of every window touched in a trigger (accumulating early
    and late results); ``append`` emits each window once, when it closes."""
    w = valid.withWatermark("event_time", f"{watermark_delay_ms(settings)} milliseconds")
    return window_stats(w, settings, keys=keys)


def start_stats_query(valid: DataFrame, out_path: str, checkpoint: str,
                      settings: Settings = Settings(), mode: str = "update",
                      trigger: dict | None = None, keys=("dim1",)):
    """Run ``windowed_stats_stream`` and write each trigger's result under
    ``out_path/batch_id=<id>`` (overwrite -> a replayed batch is idempotent)."""
    stats = windowed_stats_stream(valid, settings, keys)

    def sink(df: DataFrame, batch_id: int):
        (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
           .parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}"))

    w = (stats.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .foreachBatch(sink))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def start_dedup_query(messages: DataFrame, out_path: str, checkpoint: str,
                      settings: Settings = Settings(), trigger: dict | None = None):
    """Drop redelivered messages (same id attribute) and append the others, late
    ones too, to a message table that the next query reads as its source."""
    d = dedup_stream(messages, settings)
    w = (d.writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", checkpoint).option("path", out_path))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def start_per_trigger_query(valid: DataFrame, out_path: str, checkpoint: str, keys=("dim1",),
                            value: str = "metrics1", trigger: dict | None = None):
    """Unwindowed, discarding per-trigger stats (a global window with a
    repeated processing-time trigger): every micro-batch emits the stats of
    the rows that arrived in it, per key, under ``batch_id=<id>``."""
    from eventlake.operators.aggregates import float_avg, stats_aggs

    def sink(df: DataFrame, batch_id: int):
        (df.groupBy(*keys).agg(*stats_aggs(value))
           .withColumn("avg", float_avg(F.col("sum"), F.col("num_records")))
           .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
           .write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}"))

    w = valid.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def start_error_window_query(dead: DataFrame, out_path: str, checkpoint: str, settings: Settings = Settings(),
                             trigger: dict | None = None):
    """Dead letters per window: one row when the watermark (no delay) passes the
    window's end, none after it. The dead-letter files have every message."""
    counts = (dead.withWatermark("event_time", "0 seconds")
              .groupBy(F.window("event_time", spark_interval(settings.window_size)).alias("window"))
              .agg(F.count("*").alias("n_rows")))

    def sink(df: DataFrame, batch_id: int):
        (df.select(*window_bounds(), "n_rows").write.mode("overwrite")
           .parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}"))

    w = counts.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(sink)
    return w.trigger(**(trigger or {"availableNow": True})).start()
