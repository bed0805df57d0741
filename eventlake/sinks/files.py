"""Windowed file sinks (CSV text for detail rows and dead letters, Avro or
another columnar format for records).

Files land under ``root/<YYYY>/<MM>/<DD>/<HH>/window=<start-end>/shard=<k>``
(directory parts from the window end, as the reference's path template), so
a window's files are found by path. ``rebalance`` lets AQE split a hot window
over several tasks instead of writing it from one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.time import instant_str
from eventlake.settings import Settings


def _window_layout(df: DataFrame, settings: Settings, key_cols: list[str]) -> DataFrame:
    end = F.timestamp_millis(F.col("win_end_ms"))
    return df.select(
        "*",
        F.date_format(end, "yyyy").alias("YYYY"), F.date_format(end, "MM").alias("MM"),
        F.date_format(end, "dd").alias("DD"), F.date_format(end, "HH").alias("HH"),
        F.concat(instant_str(F.col("win_start_ms")), F.lit("-"), instant_str(F.col("win_end_ms")))
         .alias("window_id"),
        F.pmod(F.xxhash64(*[F.col(c) for c in key_cols]), F.lit(settings.num_shards)).alias("shard"))


PARTS = ["YYYY", "MM", "DD", "HH", "window_id", "shard"]


def windowed_lines(df: DataFrame, settings: Settings = Settings(), text_col: str = "line",
                   key_cols: list[str] | None = None) -> DataFrame:
    """``text_col`` plus the folder columns, for batch writers and stream sinks alike."""
    return _window_layout(df, settings, key_cols or [text_col]).select(text_col, *PARTS)


def write_windowed_text(df: DataFrame, root: str, settings: Settings = Settings(),
                        text_col: str = "line", key_cols: list[str] | None = None) -> None:
    """Write ``text_col`` lines, one folder per window and shard. Needs
    ``win_start_ms`` / ``win_end_ms`` columns."""
    out = windowed_lines(df, settings, text_col, key_cols)
    out.hint("rebalance", *PARTS).write.mode("append").partitionBy(*PARTS).text(root)


def write_avro(df: DataFrame, root: str, settings: Settings = Settings(), fmt: str = "avro",
               key_cols: list[str] | None = None) -> None:
    """Record files with snappy compression, same layout as the text sink.
    ``fmt='avro'`` needs the spark-avro package; ``parquet``/``orc`` work
    everywhere."""
    keys = key_cols or [c for c in df.columns if c not in ("win_start_ms", "win_end_ms")][:1]
    out = _window_layout(df, settings, keys)
    (out.hint("rebalance", *PARTS).write.mode("append")
        .format(fmt).option("compression", "snappy").partitionBy(*PARTS).save(root))


def start_files(df: DataFrame, root: str, checkpoint: str, fmt: str = "parquet", parts: list[str] | None = None,
                trigger: dict | None = None):
    """A stream into partitioned files by Spark's own file sink: its log makes the
    files of a replayed micro-batch count once, without a folder per batch."""
    w = (df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
         .option("path", root).partitionBy(*(parts or PARTS)))
    if fmt in ("avro", "parquet", "orc"):
        w = w.option("compression", "snappy")
    return w.trigger(**(trigger or {"availableNow": True})).start()
