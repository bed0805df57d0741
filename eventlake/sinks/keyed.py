"""Cells as a keyed table: one row per row key, merged in place.

The table lies in parts, one per (span, bucket): the span comes from the row key (for wide
rows the day of the window), the bucket is a hash. A merge reads and rewrites only the parts
that its cells touch, so its cost follows the new cells and the spans they fall in, not the
table. New parts are written beside the old ones; then a manifest that names the valid
parts is put in place under the next number, by a rename that fails if the number is taken.
Readers take the newest manifest, so they see a merge as a whole or not at all. A merge
whose epoch the manifest already holds is a replay and does nothing; one that was cut off
before the rename left no trace but files that no manifest names. Parts that a
merge replaces are deleted by the next one, when readers have moved on."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import hadoop_path

ROW = "row_key string, cells map<string,struct<cell_ts:bigint,value:string>>"
DAY_MS = 86_400_000


def window_day() -> Column:
    """Span of wide rows: the day in which the window of ``key#start#end`` begins."""
    return F.floor(F.substring_index(F.substring_index("row_key", "#", -2), "#", 1).cast("long") / F.lit(DAY_MS))


class KeyedTable:
    """A table at ``path``; ``span`` and ``buckets`` stay the same over its life."""

    def __init__(self, spark: SparkSession, path: str, span: Column | None = None, buckets: int = 8):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.span = F.lit(0) if span is None else span

    def _manifest(self) -> tuple[int, dict]:
        p, fs = hadoop_path(self.spark, f"{self.path}/manifest")
        if not fs.exists(p):
            return 0, {"epoch": -1, "parts": {}, "replaced": []}
        number = max((int(str(f.getPath().getName())[:12]) for f in fs.listStatus(p) if str(f.getPath().getName()).endswith(".json")),
                     default=0)
        if not number:
            return 0, {"epoch": -1, "parts": {}, "replaced": []}
        text = self.spark.read.text(f"{self.path}/manifest/{number:012d}.json", wholetext=True).first()[0]
        return number, json.loads(text)

    def _put_manifest(self, number: int, content: dict) -> None:
        to, fs = hadoop_path(self.spark, f"{self.path}/manifest/{number:012d}.json")
        staged, _ = hadoop_path(self.spark, f"{self.path}/manifest/_{uuid.uuid4().hex}")
        out = fs.create(staged, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        if fs.exists(to) or not fs.rename(staged, to):
            fs.delete(staged, False)
            raise RuntimeError(f"{self.path}: another writer has put manifest {number} in place")

    def _rows(self, parts: dict[str, str], only: list[str] | None = None) -> DataFrame:
        dirs = [f"{self.path}/{d}" for k, d in parts.items() if only is None or k in only]
        if not dirs:
            return self.spark.createDataFrame([], ROW)
        return self.spark.read.schema(ROW).parquet(*dirs)

    def merge(self, cells: DataFrame, epoch: int) -> bool:
        """Merge ``cells`` (row_key, family, qualifier, cell_ts, value) of an epoch; of a cell the latest
        timestamp counts. False if the epoch was merged before."""
        number, m = self._manifest()
        if epoch <= m["epoch"]:
            return False
        at = F.concat_ws("/", F.concat(F.lit("span="), "span"), F.concat(F.lit("bucket="), "bucket"))
        place = lambda df: df.withColumn("span", self.span.cast("string")).withColumn(
            "bucket", F.pmod(F.xxhash64("row_key"), F.lit(self.buckets)).cast("string"))
        new = cells.select("row_key", F.concat_ws(":", "family", "qualifier").alias("cell"), "cell_ts", "value")
        touched = [r[0] for r in place(new.select("row_key").distinct()).select(at).distinct().collect()]  # parts, not rows
        if not touched:
            self._put_manifest(number + 1, {"epoch": epoch, "parts": m["parts"], "replaced": []})
            return True
        old = self._rows(m["parts"], touched).select("row_key", F.explode("cells").alias("cell", "c")).select(
            "row_key", "cell", "c.cell_ts", "c.value")
        rows = (old.unionByName(new).groupBy("row_key", "cell")
                .agg(F.max_by(F.struct("cell_ts", "value"), F.struct("cell_ts", "value")).alias("c"))
                .groupBy("row_key").agg(F.map_from_entries(F.collect_list(F.struct("cell", "c"))).alias("cells")))
        version = f"data/{number + 1:012d}-{uuid.uuid4().hex[:8]}"
        (place(rows).repartition("span", "bucket").sortWithinPartitions("span", "bucket", "row_key")
         .write.partitionBy("span", "bucket").parquet(f"{self.path}/{version}"))
        parts = {**m["parts"], **{t: f"{version}/{t}" for t in touched}}
        replaced = [m["parts"][t] for t in touched if t in m["parts"]]
        self._put_manifest(number + 1, {"epoch": epoch, "parts": parts, "replaced": replaced})
        for d in m["replaced"]:
            p, fs = hadoop_path(self.spark, f"{self.path}/{d}")
            fs.delete(p, True)
        return True

    def rows(self) -> DataFrame:
        """row_key and its cells, ``family:qualifier`` -> (cell_ts, value)."""
        return self._rows(self._manifest()[1]["parts"])

    def cells(self) -> DataFrame:
        """row_key, family, qualifier, cell_ts, value."""
        return (self.rows().select("row_key", F.explode("cells").alias("cell", "c"))
                .select("row_key", F.substring_index("cell", ":", 1).alias("family"),
                        F.expr("substring(cell, instr(cell, ':') + 1)").alias("qualifier"), "c.cell_ts", "c.value"))
