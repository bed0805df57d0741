"""A message log as a stream source of its own.

The log is a folder of Parquet files, one sub-folder per bucket of arrival time
(``arrival=<number>``). Offsets are bucket numbers: a micro-batch reads the buckets from its
start to before its end, one partition per file. ``buckets_per_trigger`` bounds how much a trigger
takes, so a backlog is worked off in even steps and not in one micro-batch. A bucket must be
complete before it is read: give the writer's lag in ``hold_back`` buckets.

On a restart the reader finds its place in the query's own offset log, whose folder is the
``checkpoint`` option; the engine replays an unfinished micro-batch by its offsets.

The source does not know ``availableNow``; ``drain`` runs a query until it has read all
there is."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from eventlake.functions.shipping import ship_by_value
from eventlake.schemas import MESSAGE
from eventlake.session import hadoop_path
from eventlake.sinks.staged import Folder

ship_by_value(__name__)

BUCKET = "arrival"


class LogFile(InputPartition):
    def __init__(self, name: str):
        super().__init__(name)
        self.name = name


class MessageLogReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema):
        self.o, self.schema = options, schema
        self.step, self.hold = int(options.get("buckets_per_trigger", "1")), int(options.get("hold_back", "0"))
        self.at: int | None = None

    def _buckets(self) -> list[int]:
        """Complete buckets, in order."""
        found = sorted(int(n.partition("=")[2]) for n in Folder(self.o["path"]).names("") if n.startswith(BUCKET + "="))
        return found[:len(found) - self.hold] if self.hold else found

    def _planned(self) -> int | None:
        """The last offset that the query has planned."""
        if not self.o.get("checkpoint"):
            return None
        folder = Folder(self.o["checkpoint"])
        numbers = sorted((int(n) for n in folder.names("offsets") if n.isdigit()), reverse=True)
        for line in folder.read(f"offsets/{numbers[0]}").decode().splitlines() if numbers else ():
            if line.startswith("{") and BUCKET in (got := json.loads(line)):
                return int(got[BUCKET])
        return None

    def initialOffset(self) -> dict:
        buckets = self._buckets()
        return {BUCKET: buckets[0] if buckets else 0}

    def latestOffset(self) -> dict:
        if self.at is None:
            planned = self._planned()
            self.at = self.initialOffset()[BUCKET] if planned is None else planned
        ahead = [b for b in self._buckets() if b >= self.at]
        if ahead:
            self.at = ahead[min(self.step, len(ahead)) - 1] + 1
        return {BUCKET: self.at}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if start[BUCKET] > end[BUCKET]:
            raise ValueError("the log was restarted without its place: give the query's checkpoint folder as option 'checkpoint'")
        self.at = max(self.at or 0, end[BUCKET])
        folder = Folder(self.o["path"])
        return [LogFile(f"{BUCKET}={b}/{n}") for b in self._buckets() if start[BUCKET] <= b < end[BUCKET]
                for n in folder.names(f"{BUCKET}={b}") if n.endswith(".parquet")]

    def read(self, partition: LogFile):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        want = to_arrow_schema(self.schema)
        folder = Folder(self.o["path"])
        with folder.fs.open_input_file(folder.at(partition.name)) as f:
            for batch in pq.ParquetFile(f, coerce_int96_timestamp_unit="us").iter_batches(columns=want.names):
                yield pa.RecordBatch.from_arrays([batch.column(n).cast(want.field(n).type) for n in want.names], schema=want)


class MessageLogDataSource(DataSource):
    @classmethod
    def name(cls):
        return "messagelog"

    def schema(self):
        return MESSAGE

    def streamReader(self, schema):
        return MessageLogReader(dict(self.options), schema)


def append_messages(messages: DataFrame, path: str, minutes: int, shift: int = 0) -> None:
    """Append messages to a log with buckets of ``minutes`` of arrival time, which begin ``shift`` minutes ahead
    of whole multiples."""
    bucket = F.floor((F.unix_micros("publish_ts") + F.lit(shift * 60_000_000)) / F.lit(minutes * 60_000_000))
    messages.withColumn(BUCKET, bucket).write.mode("append").partitionBy(BUCKET).parquet(path)


def read_message_log(spark: SparkSession, path: str, checkpoint: str, buckets_per_trigger: int = 1, hold_back: int = 0) -> DataFrame:
    """The log as a stream; ``checkpoint`` is the folder of the query that reads it."""
    spark.dataSource.register(MessageLogDataSource)
    uri = lambda p: hadoop_path(spark, p)[0].toString()
    return (spark.readStream.format("messagelog").option("path", uri(path)).option("checkpoint", uri(checkpoint))
            .option("buckets_per_trigger", str(buckets_per_trigger)).option("hold_back", str(hold_back)).load())


def drain(query) -> None:
    """Let a running query read all there is, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
