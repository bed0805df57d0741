"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the given tables in full (through the fixture mapping in
``fixtures``) and returns a lazily planned DataFrame. Oracle SQL for the same
names lives in ``oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.time import epoch_ms
from eventlake.operators import aggregates as agg
from eventlake.operators import encode as enc
from eventlake.operators.dedup import dedup_by_id, dedup_key
from eventlake.operators.parse import assign_event_time, route_counts, split_routes
from eventlake.operators.wordcount import count_words
from eventlake.plans import fixtures as fx
from eventlake.schemas import DETAIL, WAREHOUSE
from eventlake.session import scratch_path
from eventlake.sinks.bulk import BULK_DEAD_LETTER, bulk_batches, write_bulk_docs
from eventlake.sources.tables import load_table

S = fx.FIXTURE


def q_parse_csv_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.parsed(spark, sf_dir)
    return p.select("message_id", "event_ts", "thread_id", "thread_name", "seq", "dim1",
                    "metrics1", "process_ts",
                    epoch_ms(F.col("event_time")).alias("event_time_ms"))


def q_route_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_counts(fx.parsed(spark, sf_dir, faulty=True))


def q_dedup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dedup_by_id(fx.redelivered_messages(spark, sf_dir), S)
    return d.select(dedup_key(S).alias("id"), "message_id",
                    F.col("payload").cast("string").alias("payload"),
                    epoch_ms(F.col("publish_ts")).alias("publish_ms"))


def q_enrich_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.enriched(spark, sf_dir)
    return e.select("message_id", "dim1", "dim1_val", "metrics1")


def q_agg_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.window_stats(fx.enriched(spark, sf_dir), S)


def q_min_globally_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.min_globally_windowed(fx.enriched(spark, sf_dir), S.window_size)


def q_latest_n_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.enriched(spark, sf_dir)
    top = agg.latest_n_per_key(e, 3, "dim1", ["process_ts", "seq"])
    return top.select("dim1", "rank", "message_id", "event_ts", "process_ts", "metrics1")


def q_latest_globally(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.enriched(spark, sf_dir)
    return agg.latest_globally(e, ["event_ts", "seq"],
                               ["message_id", "event_ts", "seq", "dim1", "metrics1"])


def q_limit_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peek report: the 10 newest enriched events."""
    e = fx.enriched(spark, sf_dir)
    return agg.limit_n(e, 10, ["event_ts", "seq"]).select("message_id", "event_ts", "dim1", "dim1_val",
                                                            "metrics1")


def q_count_per_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_words(load_table(spark, sf_dir, "documents"), "text")


def q_assign_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.parsed(spark, sf_dir, faulty=True)
    out = assign_event_time(p, "raw", fallback=epoch_ms(F.col("publish_ts")), delimiter=S.csv_delimiter)
    return out.select("message_id", "event_time_ms")



def _detail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enc.csv_line(enc.detail_rows(fx.enriched(spark, sf_dir), S), delimiter=S.csv_delimiter)


def q_typed_by_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = enc.typed_by_schema(_detail_lines(spark, sf_dir), DETAIL, "line", S.csv_delimiter)
    return t.select(*DETAIL.fieldNames(), "error")


def q_typed_warehouse_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse rows from the typed detail columns (``typed_by_schema`` has the way through text)."""
    w = enc.warehouse_record(enc.detail_rows(fx.enriched(spark, sf_dir), S), S.truncate_seconds)
    return w.select(*WAREHOUSE.fieldNames(), F.col("event_date").cast("string").alias("event_date"))


def q_warehouse_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = enc.warehouse_record(enc.detail_rows(fx.enriched(spark, sf_dir), S), S.truncate_seconds)
    return (w.groupBy(F.col("event_date").cast("string").alias("event_date"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def q_json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enc.json_document(fx.enriched(spark, sf_dir)).select("message_id", "doc", "n_bytes")


def q_windowed_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters per error-file path: default trigger, so one final
    on-time pane per window and one shard."""
    _, dead = split_routes(fx.parsed(spark, sf_dir, faulty=True))
    w = agg.window_stats(dead.withColumn("_v", F.lit(0)), S, keys=(), value="_v")
    w = (w.withColumn("pane_idx", F.lit(0)).withColumn("is_last", F.lit(True))
          .withColumn("timing", F.lit("ON_TIME")))
    return enc.windowed_path(w, S, output_dir=S.err_output_dir).select(
        "path", F.col("num_records").alias("n_rows"))


def q_bulk_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk requests the document sink sends: totals are independent of how
    the rows are partitioned; every batch respects the limits."""
    docs = enc.json_document(fx.enriched(spark, sf_dir))
    b = bulk_batches(docs, "doc", S.bulk_max_docs, S.bulk_max_bytes)
    return b.agg(F.sum("n_docs").alias("n_docs"), F.sum("doc_bytes").alias("doc_bytes"),
                 F.sum("body_bytes").alias("body_bytes"),
                 (F.max("n_docs") <= S.bulk_max_docs).alias("within_limits"))


def q_bulk_item_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of the bulk writer: documents that a strict target rejects."""
    root = scratch_path(spark, "bulk_item_errors")
    docs = enc.json_document(fx.enriched(spark, sf_dir)).select("doc", "message_id")
    write_bulk_docs(docs, S, transport="file", id_col="message_id", path=f"{root}/docs",
                    dead_letter_path=f"{root}/dead", reject=f'"dim1_val":"{S.not_found}"')
    return spark.read.schema(BULK_DEAD_LETTER).json(f"{root}/dead").select("doc_id", "status", "error_type", "doc")


QUERIES = {
    "parse_csv_messages": q_parse_csv_messages,
    "route_dead_letter": q_route_dead_letter,
    "dedup_by_id": q_dedup_by_id,
    "enrich_broadcast": q_enrich_broadcast,
    "agg_window_stats": q_agg_window_stats,
    "min_globally_windowed": q_min_globally_windowed,
    "latest_n_per_key": q_latest_n_per_key,
    "latest_globally": q_latest_globally,
    "limit_n": q_limit_n,
    "count_per_element": q_count_per_element,
    "assign_event_time": q_assign_event_time,
    "typed_by_schema": q_typed_by_schema,
    "typed_warehouse_row": q_typed_warehouse_row,
    "warehouse_daily": q_warehouse_daily,
    "json_document": q_json_document,
    "windowed_path": q_windowed_path,
    "bulk_batches": q_bulk_batches,
    "bulk_item_errors": q_bulk_item_errors,
}


def q_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> messages -> parse -> dead-letter split -> broadcast enrich ->
    window stats per (dim1, dim1_val)."""
    return agg.window_stats(fx.enriched(spark, sf_dir), S, keys=("dim1", "dim1_val"))


def all_queries() -> dict:
    from eventlake.plans.streams import STREAM_QUERIES
    return {**QUERIES, **STREAM_QUERIES}
