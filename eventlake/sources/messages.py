"""Message sources.

A message is ``(message_id, payload binary, attributes map, publish_ts)``.
Offline and in tests messages are replayed from parquet/JSON folders; with a
Kafka package deployed, ``kafka_to_messages`` normalises a Kafka frame (value
-> payload, headers -> attributes) to the same schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.time import epoch_ms
from eventlake.schemas import MESSAGE
from eventlake.settings import Settings


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(MESSAGE).load(path)


def read_message_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(MESSAGE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def kafka_to_messages(kafka_df: DataFrame) -> DataFrame:
    """Kafka source frame (``includeHeaders=true``) -> message schema. Kafka
    allows a header key to repeat; the last one counts."""
    given = F.coalesce(F.col("headers"), F.array())
    last = F.filter(given, lambda h, i: ~F.exists(
        F.slice(given, i + 2, F.size(given)), lambda later: later["key"] == h["key"]))
    headers = F.map_from_entries(F.transform(
        last, lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value"))))
    return kafka_df.select(
        F.concat_ws("-", F.col("topic"), F.col("partition").cast("string"),
                    F.col("offset").cast("string")).alias("message_id"),
        F.col("value").alias("payload"),
        headers.alias("attributes"),
        F.col("timestamp").alias("publish_ts"))


def messages_from_events(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Replay the ``events`` table as queue messages (fixture mapping).

    payload = ``event_ts,thread_id,thread_name,seq,dim1,metrics1``; the id and
    event-time attributes carry the event id and epoch ms; publish_ts adds a
    deterministic 0..96 minute delivery delay so lateness occurs.
    """
    ev_ms = epoch_ms(F.col("ts"))
    thread_id = F.col("user_id").cast("string")
    payload = F.concat_ws(
        settings.csv_delimiter, ev_ms.cast("string"), thread_id,
        F.concat(F.lit("thread-"), thread_id), F.col("event_id").cast("string"),
        F.col("event_type"), F.floor(F.col("value")).cast("string"))
    delay_min = F.pmod(F.col("event_id") * F.lit(7919), F.lit(97))
    return events.select(
        F.col("event_id").cast("string").alias("message_id"),
        payload.cast("binary").alias("payload"),
        F.create_map(F.lit(settings.id_attr), F.col("event_id").cast("string"),
                     F.lit(settings.ts_attr), ev_ms.cast("string")).alias("attributes"),
        (F.col("ts").cast("timestamp") + F.make_dt_interval(mins=delay_min)).alias("publish_ts"),
    )
