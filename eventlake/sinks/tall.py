"""Tall cells laid out for newest-first reads of one key.

Row keys are ``key#<reverse time>#<window start>``, so under a key's prefix the newest row comes
first. The table is partitioned by a hash bucket of the key and by the day of the cells'
time, and sorted by row key inside its files. A read of the newest rows of a key looks into
one bucket only, takes its days from the newest on until it has enough rows, and asks for
the range of row keys of the prefix, which prunes files and row groups: what it opens depends
on the rows it wants, not on the age or the size of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import hadoop_path
from eventlake.sinks.keyed import DAY_MS

#: what stands before the last two parts of the row key (it may hold ``#``)
KEY = "substring(row_key, 1, length(row_key) - length(substring_index(row_key, '#', -2)) - 1)"
CELL = "row_key string, family string, qualifier string, cell_ts long, value string"


class TallTable:
    """``buckets`` stays the same over the table's life."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def write(self, cells: DataFrame, batch_id: int) -> None:
        """Add the cells of a micro-batch; a replayed one replaces its own files."""
        out = (cells.withColumn("bucket", self._bucket(F.expr(KEY))).withColumn("day", F.floor(F.col("cell_ts") / F.lit(DAY_MS)))
               .withColumn("batch", F.lit(batch_id)))
        (out.hint("rebalance", "bucket", "day").sortWithinPartitions("bucket", "day", "row_key", "qualifier")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "day", "batch").parquet(self.path))

    def _days(self, bucket: int) -> list[int]:
        p, fs = hadoop_path(self.spark, f"{self.path}/bucket={bucket}")
        if not fs.exists(p):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return sorted((int(n[4:]) for n in names if n.startswith("day=")), reverse=True)

    def scan(self, key: str, days: list[int], bucket: int) -> DataFrame:
        """The cells of ``key`` in some days of its bucket: a range of row keys."""
        dirs = [f"{self.path}/bucket={bucket}/day={d}" for d in days]
        if not dirs:
            return self.spark.createDataFrame([], CELL)
        rows = self.spark.read.schema(CELL).option("basePath", f"{self.path}/bucket={bucket}/").parquet(*dirs)
        in_range = (F.col("row_key") >= key + "#") & (F.col("row_key") < key + "$")  # '$' follows '#'
        return rows.where(in_range & (F.expr(KEY) == key)).select("row_key", "family", "qualifier", "cell_ts", "value")

    def latest(self, key: str, n: int) -> DataFrame:
        """The cells of the newest ``n`` rows of ``key``, newest first."""
        bucket = self.spark.range(1).select(self._bucket(F.lit(key))).first()[0]
        left, taken, more = self._days(bucket), [], 1
        while left:
            taken, left, more = taken + left[:more], left[more:], more * 2
            if self.scan(key, taken, bucket).select("row_key").distinct().limit(n).count() == n:
                break
        rows = self.scan(key, taken, bucket)
        first = rows.select("row_key").distinct().orderBy("row_key").limit(n)
        return rows.join(F.broadcast(first), "row_key").orderBy("row_key", "family", "qualifier")  # ``n`` row keys
