"""Payload decoding, positional CSV parsing, typed fields and dead letters.

One parse produces a single frame with an ``error`` column; ``split_routes``
turns it into the valid and dead-letter outputs (two filters over the same
plan -- persist it, or write both from one ``foreachBatch``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.text import csv_fields, decode_payload, field_at, java_int, java_long
from eventlake.functions.time import epoch_ms
from eventlake.settings import Settings

# Fixed value: the dead-letter text for a message without payload.
NO_PAYLOAD_TEXT = "Failed to extract pubsub payload"


def event_time_from_attributes(settings: Settings) -> Column:
    """Event time = message attribute (epoch ms); missing/garbled attribute
    falls back to the publish time."""
    ms = java_long(F.col("attributes").getItem(settings.ts_attr))
    return F.coalesce(F.timestamp_millis(ms), F.col("publish_ts"))


def parse_messages(messages: DataFrame, settings: Settings = Settings(),
                   process_ts: Column | None = None) -> DataFrame:
    """message frame -> one row per message with typed raw fields, the
    enrichment key, ``process_ts`` (epoch ms), ``event_time`` and ``error``
    (null for valid rows).

    ``process_ts`` defaults to the processing clock (constant per streaming
    micro-batch); pass an expression over the parsed columns (e.g.
    ``F.col('event_ts') + 1000``) for reproducible batch runs.

    Strict mode (default): fewer than 6 fields or an unparsable typed field
    is a dead letter. Non-strict mode keeps the reference rule: only fewer than
    4 fields (or no payload) is a dead letter; missing fields stay null.
    """
    text = decode_payload(F.col("payload"))
    fields = csv_fields(text, settings.csv_delimiter)
    base = messages.select(
        F.col("message_id"),
        F.col("attributes"),
        F.col("publish_ts"),
        event_time_from_attributes(settings).alias("event_time"),
        text.alias("raw"),
        fields.alias("_f"),
    )
    f = F.col("_f")
    s_event_ts, s_seq, s_metrics = field_at(f, 0), field_at(f, 3), field_at(f, 5)
    typed = base.select(
        "message_id", "attributes", "publish_ts", "event_time", "raw",
        F.size(f).alias("_n"),
        java_long(s_event_ts).alias("event_ts"),
        field_at(f, 1).alias("thread_id"),
        field_at(f, 2).alias("thread_name"),
        java_int(s_seq).alias("seq"),
        field_at(f, 4).alias("dim1"),
        java_int(s_metrics).alias("metrics1"),
        s_event_ts.alias("_s0"), s_seq.alias("_s3"), s_metrics.alias("_s5"),
    )
    n = F.col("_n")
    if settings.strict:
        error = (F.when(F.col("raw").isNull(), F.lit("null_payload"))
                 .when(n < 6, F.lit("too_few_fields"))
                 .when(F.col("event_ts").isNull(), F.lit("bad_event_ts"))
                 .when(F.col("seq").isNull(), F.lit("bad_seq"))
                 .when(F.col("metrics1").isNull(), F.lit("bad_metrics1")))
    else:
        error = (F.when(F.col("raw").isNull(), F.lit("null_payload"))
                 .when(n < 4, F.lit("too_few_fields")))
    pts = process_ts if process_ts is not None else F.unix_millis(F.current_timestamp())
    return typed.select(
        "message_id", "attributes", "publish_ts", "event_time", "raw",
        "event_ts", "thread_id", "thread_name", "seq", "dim1", "metrics1",
        pts.cast("bigint").alias("process_ts"),
        error.alias("error"),
    )


def route(parsed: DataFrame, valid: bool, cols: list) -> DataFrame:
    """Rows of one route. Written as a 0-or-1-row generator rather than a
    ``filter``: Catalyst would push a filter on ``error`` below the parse and
    inline every parsed expression into the predicate (evaluating the parse
    several times per row in one huge, un-JITted method). The generator reads
    the parsed columns once."""
    cond = F.col("error").isNull() if valid else F.col("error").isNotNull()
    return parsed.select(F.inline(F.when(cond, F.array(F.struct(*cols))).otherwise(F.array())))


def split_routes(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, dead_letter). Valid rows carry the typed fields (not the raw
    text or attributes); dead letters keep the raw payload text (or the
    fixed no-payload text) plus the reason."""
    valid = route(parsed, True, [c for c in parsed.columns if c not in ("error", "raw", "attributes")])
    dead = route(parsed, False, [
        "message_id", "event_time", "publish_ts",
        F.coalesce(F.col("raw"), F.lit(NO_PAYLOAD_TEXT)).alias("payload"),
        F.col("error").alias("reason")])
    return valid, dead


def route_counts(parsed: DataFrame) -> DataFrame:
    """Rows per route and reason (``valid`` rows have reason ``ok``)."""
    return (parsed.select(
        F.when(F.col("error").isNull(), F.lit("valid")).otherwise(F.lit("dead_letter")).alias("route"),
        F.coalesce(F.col("error"), F.lit("ok")).alias("reason"))
        .groupBy("route", "reason").agg(F.count(F.lit(1)).alias("n_rows")))


def assign_event_time(lines: DataFrame, text_col: str = "raw",
                      fallback: Column | None = None, delimiter: str = ",") -> DataFrame:
    """Event time from CSV field 0 (trimmed epoch ms); a missing or
    non-numeric field falls back to ``fallback`` (default: now)."""
    f0 = F.trim(field_at(csv_fields(F.col(text_col), delimiter), 0))
    fb = fallback if fallback is not None else F.unix_millis(F.current_timestamp())
    return lines.withColumn("event_time_ms", F.coalesce(java_long(f0), fb.cast("bigint")))


def event_ms(df: DataFrame, time_col: str = "event_time") -> Column:
    return epoch_ms(F.col(time_col))
