"""Windowed and keyed aggregates.

All aggregates are declarative (count/sum/min/max/max_by), so Spark plans a
partial (map-side) hash aggregate before the shuffle: a key holding a third
of all rows shuffles one partial row per map task, not its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.time import epoch_ms
from eventlake.settings import Settings, spark_interval


def float_avg(total: Column, n: Column) -> Column:
    """float32 mean as the reference computes it (``sum.floatValue()/count``,
    0 when empty). A float32/float32 quotient done in double and rounded once
    to float32 equals the float32 division."""
    return F.when(n > 0, (total.cast("float") / n.cast("float")).cast("float")) \
        .otherwise(F.lit(0.0).cast("float"))


def stats_aggs(value: str = "metrics1") -> list[Column]:
    v = F.col(value)
    return [F.count(F.lit(1)).alias("num_records"), F.sum(v).cast("bigint").alias("sum"),
            F.max(v).alias("max"), F.min(v).alias("min")]


def window_bounds(window_col: str = "window") -> list[Column]:
    return [epoch_ms(F.col(f"{window_col}.start")).alias("win_start_ms"),
            epoch_ms(F.col(f"{window_col}.end")).alias("win_end_ms")]


def window_stats(df: DataFrame, settings: Settings = Settings(), keys=("dim1",),
                 value: str = "metrics1", time_col: str = "event_time",
                 keep_window: bool = False) -> DataFrame:
    """Per (tumbling window, keys): num_records, sum, max, min, avg (float32).
    Works on batch and streaming frames (the window carries the watermark)."""
    g = df.groupBy(F.window(F.col(time_col), spark_interval(settings.window_size)).alias("window"),
                   *keys).agg(*stats_aggs(value))
    out = g.select(*keys, *window_bounds(), "num_records", "sum", "max", "min",
                   float_avg(F.col("sum"), F.col("num_records")).alias("avg"),
                   *(["window"] if keep_window else []))
    return out


def min_globally_windowed(df: DataFrame, size: str, value: str = "metrics1",
                          time_col: str = "event_time") -> DataFrame:
    """Minimum per tumbling window over all keys; empty windows give no row."""
    return (df.groupBy(F.window(F.col(time_col), spark_interval(size)).alias("window"))
            .agg(F.min(F.col(value)).alias("min_value"))
            .select(*window_bounds(), "min_value"))


def latest_globally(df: DataFrame, order_cols: list[str], cols: list[str]) -> DataFrame:
    """The single latest row by ``order_cols`` (ties broken by the later
    columns), via a partial ``max_by`` aggregate -- no sort, no shuffle of rows."""
    order = F.struct(*[F.col(c) for c in order_cols])
    return (df.agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_l"))
            .select("_l.*"))


def latest_n_per_key(df: DataFrame, n: int, key: str, order_desc: list[str]) -> DataFrame:
    """Newest ``n`` rows per key (rank 1 = newest). ``row_number() <= n``
    lets Spark insert a partial WindowGroupLimit before the shuffle, so each
    map task ships at most n rows per key even for a hot key."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order_desc])
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def count_per_element(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def limit_n(df: DataFrame, n: int, order_desc: list[str]) -> DataFrame:
    """Top-n report: the first ``n`` rows by ``order_desc`` (descending).
    Planned as TakeOrderedAndProject: each task keeps its own top n, the
    driver merges n x tasks rows."""
    return df.orderBy(*[F.col(c).desc() for c in order_desc]).limit(n)
