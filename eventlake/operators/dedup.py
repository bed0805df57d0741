"""Redelivery removal keyed on the id attribute (falls back to message_id,
so messages without the attribute are never merged together)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.settings import Settings, parse_duration


def dedup_key(settings: Settings = Settings()):
    return F.coalesce(F.col("attributes").getItem(settings.id_attr), F.col("message_id"))


def dedup_by_id(messages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Batch: keep the first delivery (earliest publish_ts, then message_id)
    per id. The aggregate keeps one whole message per id before the shuffle, so a
    hot id never lands as a whole group in one task; as the kept struct is not of
    fixed width, Spark plans it as a sort aggregate."""
    cols = messages.columns
    keyed = messages.withColumn("_dedup_key", dedup_key(settings))
    first = (keyed.groupBy("_dedup_key")
             .agg(F.min_by(F.struct(*cols), F.struct("publish_ts", "message_id")).alias("_m")))
    return first.select("_m.*")


def dedup_stream(messages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Streaming: drop redeliveries seen within ``dedup_horizon`` of processing
    time (bounded state). The operator's clock is the time a message is seen, not
    its event time, so a message is never dropped for being late. Use it as a
    query of its own in front of event-time operators: a query has one watermark,
    and theirs is on the event time."""
    horizon = f"{parse_duration(settings.dedup_horizon)} milliseconds"
    m = messages.withColumn("_dedup_key", dedup_key(settings)).withColumn("_seen", F.current_timestamp())
    return (m.withWatermark("_seen", horizon)
            .dropDuplicatesWithinWatermark(["_dedup_key"])
            .drop("_dedup_key", "_seen"))
