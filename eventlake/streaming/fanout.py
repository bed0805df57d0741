"""All sinks of the pipeline as streaming queries over shared tables.

Messages -> (dedup) message table -> (parse) routed table, partitioned into valid
rows and dead letters -> one query per sink: detail CSV and record files per window,
the day-partitioned warehouse, JSON documents through the bulk sink, dead-letter
files per window, and the panes with their tall (accumulating) and wide
(discarding) cells. A message is parsed once; every table is written by Spark's
exactly-once file sink, so sinks can lag, fail and restart on their own. Records
and warehouse rows come from typed columns, never from CSV text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions.time import epoch_ms
from eventlake.operators import encode as enc
from eventlake.operators.enrich import enrich
from eventlake.operators.parse import NO_PAYLOAD_TEXT, parse_messages
from eventlake.schemas import MESSAGE
from eventlake.session import hadoop_path
from eventlake.settings import Settings
from eventlake.sinks.bulk import start_bulk_docs
from eventlake.sinks.files import PARTS, start_files, windowed_lines, _window_layout
from eventlake.sinks.keyed import KeyedTable, window_day
from eventlake.sinks.named import start_named_files
from eventlake.sinks.tables import write_cells
from eventlake.streaming.panes import start_pane_query
from eventlake.streaming.replay import run
from eventlake.streaming.stats import start_dedup_query


def with_window_ms(df: DataFrame, settings: Settings, time_col: str = "event_time") -> DataFrame:
    ms = epoch_ms(F.col(time_col))
    start = ms - F.pmod(ms, F.lit(settings.window_ms))
    return df.withColumn("win_start_ms", start).withColumn("win_end_ms", start + F.lit(settings.window_ms))


class FanOut:
    """``steps()`` gives the queries in the order of their tables; ``run()`` runs each
    once over what is there; ``start(trigger)`` starts them all side by side."""

    def __init__(self, messages: DataFrame, root: str, dim: DataFrame, settings: Settings = Settings(),
                 process_ts: Column | None = None, record_format: str = "parquet", dedup: bool = True,
                 named_files: bool = False):
        """``named_files``: CSV and dead letters under the shard template's names instead of Spark's (the
        names hold colons, which object stores take and HDFS does not)."""
        self.named = named_files
        self.messages, self.root, self.dim, self.s = messages, root.rstrip("/"), dim, settings
        self.process_ts, self.fmt, self.dedup = process_ts, record_format, dedup
        self.spark: SparkSession = messages.sparkSession

    def _ckpt(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        path, fs = hadoop_path(self.spark, f"{self.root}/{name}")
        fs.mkdirs(path)
        return self.spark.readStream.schema(schema).parquet(f"{self.root}/{name}")

    def _parsed(self) -> DataFrame:
        src = self._table("messages", MESSAGE) if self.dedup else self.messages
        p = parse_messages(src, self.s, process_ts=self.process_ts)
        return p.drop("attributes").withColumn("route", F.when(F.col("error").isNull(), F.lit("valid")).otherwise(F.lit("dead")))

    def _routed(self, route: str) -> DataFrame:
        return self._table("routed", self._parsed().schema).where(F.col("route") == route)

    def valid(self) -> DataFrame:
        return enrich(self._routed("valid").drop("raw", "error", "route"), self.dim, self.s)

    def dead(self) -> DataFrame:
        return self._routed("dead").select("message_id", "event_time", "publish_ts",
                                           F.coalesce("raw", F.lit(NO_PAYLOAD_TEXT)).alias("payload"), F.col("error").alias("reason"))

    def wide(self) -> KeyedTable:
        """The wide rows: one per window, merged by row key."""
        return KeyedTable(self.spark, f"{self.root}/wide", window_day())

    def steps(self, trigger: dict | None = None) -> list:
        s, root = self.s, self.root

        def detail() -> DataFrame:
            return with_window_ms(enc.detail_rows(self.valid(), s), s)

        def cells(panes: DataFrame, batch_id: int) -> None:
            write_cells(enc.tall_encode(panes.where("mode = 'accumulating'")), f"{root}/tall", batch_id=batch_id)
            self.wide().merge(enc.wide_encode(panes.where("mode = 'discarding'")), batch_id)

        def lines(rows: DataFrame, name: str):
            if self.named:
                return start_named_files(rows, f"{root}/{name}", self._ckpt(name), s, shard=F.xxhash64("message_id"), trigger=trigger)
            return start_files(windowed_lines(rows, s, "line", ["message_id"]), f"{root}/{name}", self._ckpt(name), "text", trigger=trigger)

        def csv() -> DataFrame:
            return (enc.csv_line(detail(), delimiter=s.csv_delimiter)
                    .select("line", "win_start_ms", "win_end_ms", "message_id"))

        records = lambda: _window_layout(detail(), s, ["seq"])
        out = [lambda: start_dedup_query(self.messages, f"{root}/messages", self._ckpt("dedup"), s, trigger)] if self.dedup else []
        return out + [
            lambda: start_files(self._parsed(), f"{root}/routed", self._ckpt("parse"), parts=["route"], trigger=trigger),
            lambda: lines(csv(), "csv"),
            lambda: start_files(records().select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in enc.DETAIL.fields], *PARTS),
                                f"{root}/records", self._ckpt("records"), self.fmt, trigger=trigger),
            lambda: start_files(enc.warehouse_record(detail(), s.truncate_seconds), f"{root}/warehouse",
                                self._ckpt("warehouse"), parts=["event_date"], trigger=trigger),
            lambda: lines(with_window_ms(self.dead(), s).withColumnRenamed("payload", "line"), "errors"),
            lambda: start_bulk_docs(enc.json_document(self.valid()).select("doc", "message_id"), s, self._ckpt("docs"), trigger,
                                    transport="file", id_col="message_id", path=f"{root}/docs"),
            lambda: start_pane_query(self.valid().withColumn("event_ms", epoch_ms(F.col("event_time"))), f"{root}/panes",
                                     self._ckpt("panes"), s, trigger=trigger, sink=cells),
        ]

    def run(self) -> None:
        for step in self.steps():
            run(step())

    def start(self, trigger: dict) -> list:
        return [step() for step in self.steps(trigger)]
