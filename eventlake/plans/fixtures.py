"""The fixture mapping from the given ``events`` table to queue messages,
plus deterministic fault injection and redelivery for the parse / dedup
queries. Everything here is derived by Spark from the given tables, so the
work grows with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.time import epoch_ms
from eventlake.operators.enrich import enrich
from eventlake.operators.parse import parse_messages, split_routes
from eventlake.session import prepare
from eventlake.settings import Settings
from eventlake.sources.dims import fixture_dimension
from eventlake.sources.messages import messages_from_events
from eventlake.sources.tables import load_table

FIXTURE = Settings.fixture()
S_NOT_FOUND = FIXTURE.not_found

# Fault classes injected by ``event_id % 50``.
FAULT_TRUNCATED = 0      # payload cut to its first 3 fields
FAULT_PADDED_TS = 7      # event_ts wrapped in spaces
FAULT_BAD_METRIC = 17    # metrics1 = 'n/a'
FAULT_NO_PAYLOAD = 33    # payload null
FAULT_BAD_TS = 41        # event_ts = 'x17'
FAULT_TRAILING = 45      # two trailing delimiters appended (still valid)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return load_table(spark, sf_dir, "events")


def messages(spark: SparkSession, sf_dir: str, settings: Settings = FIXTURE) -> DataFrame:
    return messages_from_events(events(spark, sf_dir), settings)


def faulty_messages(spark: SparkSession, sf_dir: str, settings: Settings = FIXTURE) -> DataFrame:
    """Messages with deterministic faults in 5 of every 50 events."""
    m = messages(spark, sf_dir, settings)
    d = settings.csv_delimiter
    text = F.col("payload").cast("string")
    parts = F.split(text, d, -1)
    rest = F.array_join(F.slice(parts, F.lit(2), F.size(parts) - 1), d)
    k = F.pmod(F.col("message_id").cast("bigint"), F.lit(50))
    payload = (F.when(k == FAULT_TRUNCATED, F.array_join(F.slice(parts, 1, 3), d))
               .when(k == FAULT_PADDED_TS, F.concat(F.lit(" "), parts[0], F.lit(" "), F.lit(d), rest))
               .when(k == FAULT_BAD_METRIC, F.concat(F.array_join(F.slice(parts, 1, 5), d), F.lit(d + "n/a")))
               .when(k == FAULT_NO_PAYLOAD, F.lit(None).cast("string"))
               .when(k == FAULT_BAD_TS, F.concat(F.lit("x17"), F.lit(d), rest))
               .when(k == FAULT_TRAILING, F.concat(text, F.lit(d + d)))
               .otherwise(text))
    return m.withColumn("payload", payload.cast("binary"))


# Fixed value: deliveries slower than this miss the ack deadline and are
# delivered again.
ACK_DEADLINE_MINUTES = 80


def redelivered_messages(spark: SparkSession, sf_dir: str, settings: Settings = FIXTURE) -> DataFrame:
    """Messages whose delivery took longer than the ack deadline are
    delivered a second time, 5 minutes later, under a new message id but the
    same id attribute (about 1 in 6 messages). One scan: each message expands
    to its deliveries."""
    m = messages(spark, sf_dir, settings)
    late_ack = (F.unix_seconds(F.col("publish_ts"))
                - F.floor(F.col("attributes").getItem(settings.ts_attr).cast("bigint") / 1000)
                >= ACK_DEADLINE_MINUTES * 60)
    first = F.struct(F.col("message_id").alias("message_id"), F.col("publish_ts").alias("publish_ts"))
    again = F.struct(F.concat(F.col("message_id"), F.lit("-r")).alias("message_id"),
                     (F.col("publish_ts") + F.expr("INTERVAL 5 MINUTES")).alias("publish_ts"))
    deliveries = F.when(late_ack, F.array(first, again)).otherwise(F.array(first))
    return (m.select("payload", "attributes", F.explode(deliveries).alias("_d"))
            .select(F.col("_d.message_id").alias("message_id"), "payload", "attributes",
                    F.col("_d.publish_ts").alias("publish_ts")))


def batch_process_ts():
    """Reproducible processing time for batch runs: event time + 1 s."""
    return F.col("event_ts") + F.lit(1000)


def parsed(spark: SparkSession, sf_dir: str, settings: Settings = FIXTURE,
           faulty: bool = False) -> DataFrame:
    m = faulty_messages(spark, sf_dir, settings) if faulty else messages(spark, sf_dir, settings)
    return parse_messages(m, settings, process_ts=batch_process_ts())


def enriched(spark: SparkSession, sf_dir: str, settings: Settings = FIXTURE) -> DataFrame:
    """Valid, enriched rows with ``event_ms`` and ``arrival_ms`` columns."""
    valid, _ = split_routes(parsed(spark, sf_dir, settings))
    e = enrich(valid, fixture_dimension(spark), settings)
    return e.withColumn("event_ms", epoch_ms(F.col("event_time"))) \
            .withColumn("arrival_ms", epoch_ms(F.col("publish_ts")))
