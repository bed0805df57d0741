"""Replay a table as a stream, slice by slice: the table is written once, in
parallel, partitioned by slice; then each slice is shown to the query in turn and
processed by one ``availableNow`` run on the same checkpoint. Used by tests and the
registered streaming queries; production streams read their queue directly."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE = "_slice"


def arrival_slices(messages: DataFrame, minutes: int, shift: int = 0) -> DataFrame:
    """Number the messages by arrival time, ``minutes`` per slice, beginning ``shift``
    minutes before the midnight ahead of the first arrival: a longer input has
    more slices, not larger ones."""
    first = messages.agg(F.min(F.unix_micros("publish_ts"))).first()[0] or 0
    begin = first - first % 86_400_000_000 - shift * 60_000_000
    return messages.withColumn(SLICE, F.floor((F.unix_micros("publish_ts") - F.lit(begin)) / F.lit(minutes * 60_000_000)).cast("int"))


def stage_slices(df: DataFrame, path: str, col: str = SLICE) -> list[int]:
    """Write the table once, one folder per slice with as many files as tasks had
    rows of it. Returns the slice numbers (few: one per micro-batch)."""
    df.write.mode("append").partitionBy(col).parquet(path)
    return sorted(r[0] for r in df.sparkSession.read.parquet(path).select(col).distinct().collect())


def replay(spark: SparkSession, path: str, slices: list[int], schema: StructType | str,
           start: Callable[[DataFrame], object], col: str = SLICE) -> None:
    """Run ``start(stream)`` (which starts an ``availableNow`` query and returns
    it, or several in their order) once per slice; the stream shows the slices so
    far, and the checkpoint knows which of their files are done."""
    for k in range(len(slices)):
        shown = ",".join(str(s) for s in slices[:k + 1])
        stream = spark.readStream.schema(schema).parquet(f"{path.rstrip('/')}/{col}={{{shown}}}")
        for step in start(stream) if isinstance(start, Steps) else (start(stream),):
            run(step)


class Steps:
    """Several queries per slice: each callable starts one after the one before has ended."""

    def __init__(self, *steps: Callable[[DataFrame], object]):
        self.steps = steps

    def __call__(self, stream: DataFrame):
        return (step(stream) for step in self.steps)


def run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
