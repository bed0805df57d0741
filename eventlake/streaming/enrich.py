"""Slowly changing lookup for streams: the dimension is re-read when older
than a TTL, checked for size and broadcast to the micro-batch join."""

from __future__ import annotations

import time
from typing import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.time import epoch_ms
from eventlake.operators.enrich import enrich
from eventlake.operators.parse import parse_messages, split_routes
from eventlake.settings import Settings


class RefreshingDimension:
    """Holds the current dimension snapshot; ``get()`` re-reads it with
    ``loader`` once ``ttl_s`` seconds have passed (0 = every call)."""

    def __init__(self, loader: Callable[[], DataFrame], ttl_s: float = 20.0):
        self.loader, self.ttl_s = loader, ttl_s
        self.df: DataFrame | None = None
        self.loaded_at = float("-inf")
        self.version = 0

    def get(self) -> DataFrame:
        now = time.monotonic()
        if self.df is None or now - self.loaded_at >= self.ttl_s:
            old = self.df
            self.df = self.loader().persist(StorageLevel.MEMORY_AND_DISK)
            self.df.count()
            if old is not None:
                old.unpersist()
            self.loaded_at, self.version = now, self.version + 1
        return self.df


def start_refreshing_enrich_query(messages: DataFrame, dim: RefreshingDimension, out_path: str,
                                  checkpoint: str, settings: Settings = Settings(),
                                  process_ts: Column | None = None, trigger: dict | None = None):
    """Parse + enrich every micro-batch against the current snapshot and
    write the enriched rows under ``out_path/batch_id=<id>`` (with the
    snapshot version used)."""

    def run(batch: DataFrame, batch_id: int):
        valid, _ = split_routes(parse_messages(batch, settings, process_ts=process_ts))
        e = enrich(valid, dim.get(), settings)
        (e.select("message_id", "dim1", "dim1_val", "metrics1",
                  epoch_ms(F.col("event_time")).alias("event_ms"),
                  F.lit(dim.version).alias("dim_version"), F.lit(batch_id).cast("bigint").alias("batch_id"))
          .write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}"))

    w = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    return w.trigger(**(trigger or {"availableNow": True})).start()
