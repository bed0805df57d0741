"""Enrichment as of the event's time, from a change log of the dimension.

The dimension is not read again but kept as state: its changes (key, value, from when) are a
stream of their own. Events and changes meet in ``transformWithState`` under the
key; an event gets the value that was valid at its event time, so a late event gets the value
of its time and not the newest one. Changes of a micro-batch count before its events.

A hot key is split over ``salts`` groups: an event goes to one of them by a hash of its id, a change to
all (the dimension is small beside the events). A group holds a micro-batch's rows of its key, which the
source's rate bounds. Of the changes that the watermark less the allowed lateness has passed
only the newest stays, as no event can ask for the others any more.

A change with a null value ends the key's value: events after it have the default, as events
have for which no change is old enough. Of changes at the same time the last in order of value counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventlake.functions.shipping import ship_by_value
from eventlake.session import rocksdb_state
from eventlake.settings import Settings

SALTS = 16


class AsOfProcessor(StatefulProcessor):
    """State of one (key, salt): the times and values of the changes, in order."""

    def __init__(self, default: str, lateness: int):
        self.default, self.lateness = default, lateness

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.changes = handle.getValueState("changes", "at array<long>, value array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        at, value = (list(x) for x in self.changes.get()) if self.changes.exists() else ([], [])
        events, new = [], []
        for b in rows:
            change = b["body"].isna().to_numpy()
            new += list(zip(b["event_ms"][change].tolist(), b["dim1_val"][change].tolist()))
            events.append(b[~change])
        if new:
            known = sorted({**dict(zip(at, value)), **dict(sorted(new, key=lambda x: (x[0], x[1] or "")))}.items())
            at, value = [a for a, _ in known], [v for _, v in known]
        times = np.array(at, np.int64)
        for e in events:
            if len(e):
                k = np.searchsorted(times, e["event_ms"].to_numpy(np.int64), side="right") - 1
                got = [self.default if i < 0 or value[i] is None else value[i] for i in k]
                yield pd.DataFrame({"body": e["body"].to_numpy(), "dim1_val": got})
        passed = int(np.searchsorted(times, timerValues.getCurrentWatermarkInMs() - self.lateness, side="right")) - 1
        if new or passed > 0:
            cut = max(0, passed)
            self.changes.update((at[cut:], value[cut:]))

    def close(self) -> None:
        pass


def enrich_as_of(events: DataFrame, changes: DataFrame, settings: Settings = Settings(), salts: int = SALTS) -> DataFrame:
    """``events`` (dim1, event_ms, event_time, message_id and more) plus ``dim1_val`` as of their time.
    ``changes``: dim1, dim1_val, event_ms, event_time (from when). Both are streams; rows without a key have the default."""
    ship_by_value(__name__)
    events = events.drop("dim1_val")
    own = T.StructType([f for f in events.schema.fields if f.name != "event_time"])
    # an event's columns travel as JSON: pandas would turn integers beside nulls into doubles
    left = (events.withWatermark("event_time", "0 seconds")
            .select("dim1", "event_ms", F.lit(None).cast("string").alias("dim1_val"), F.to_json(F.struct(*own.fieldNames())).alias("body"),
                    F.pmod(F.xxhash64("message_id"), F.lit(salts)).cast("int").alias("salt")))
    right = (changes.withWatermark("event_time", "0 seconds")
             .select("dim1", "event_ms", "dim1_val", F.lit(None).cast("string").alias("body"),
                     F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")))
    both = left.unionByName(right).withColumn("part", F.coalesce(F.concat(F.lit("="), "dim1"), F.lit(""))).drop("dim1")
    out = both.groupBy("part", "salt").transformWithStateInPandas(
        AsOfProcessor(settings.not_found, settings.lateness_ms), "body string, dim1_val string", "Append", "EventTime")
    return out.select(F.from_json("body", own).alias("e"), "dim1_val").select("e.*", "dim1_val")


def start_as_of_query(events: DataFrame, changes: DataFrame, out_path: str, checkpoint: str, settings: Settings = Settings(),
                      trigger: dict | None = None, salts: int = SALTS):
    """Write the enriched events to ``out_path`` by Spark's exactly-once file sink."""
    w = (enrich_as_of(events, changes, settings, salts).writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", checkpoint).option("path", out_path))
    with rocksdb_state(events.sparkSession):
        return w.trigger(**(trigger or {"availableNow": True})).start()
