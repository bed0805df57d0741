"""Dimension lookup: left join on ``dim1`` with a not-found default.

The dimension side is broadcast only if the plan's statistics bound its size in
bytes (no job runs for that). Beyond the bound, or when the size is unknown, the
join is left to Spark: AQE broadcasts what turns out small and splits hot keys
of a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.settings import Settings


def unique_dimension(dim: DataFrame, key: str = "dim1", value: str = "dim1_val",
                     on_duplicate: str = "auto") -> DataFrame:
    """One value per key (the lookup is a map). ``resolve``: the latest
    ``updated_at`` wins (null is oldest, ties go to the greater value; without
    that column the greatest value). ``error``: a repeated key fails the job that
    uses the lookup. ``auto``: resolve where ``updated_at`` exists, else error."""
    dated = "updated_at" in dim.columns
    if on_duplicate not in ("auto", "resolve", "error"):
        raise ValueError(f"on_duplicate: {on_duplicate}")
    if dated:
        v = F.max_by(F.col(value), F.struct("updated_at", value))
    else:
        v = F.max(F.col(value))
    if on_duplicate == "error" or on_duplicate == "auto" and not dated:
        v = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(
            F.lit("duplicate dimension key: "), F.coalesce(F.col(key), F.lit("null"))))).otherwise(v)
    return dim.groupBy(key).agg(v.alias(value))


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; huge where it knows nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def enrich(df: DataFrame, dim: DataFrame, settings: Settings = Settings(),
           key: str = "dim1", value: str = "dim1_val", strategy: str = "auto",
           on_duplicate: str = "auto") -> DataFrame:
    """Append ``dim1_val`` (case-sensitive exact match; missing -> default).

    strategy: ``auto`` (broadcast behind the size bound), ``broadcast``, ``shuffle``.
    """
    cols = [key, value] + (["updated_at"] if "updated_at" in dim.columns else [])
    dim = dim.select(*cols)
    d = unique_dimension(dim, key, value, on_duplicate).withColumnRenamed(value, "_dim_val")
    if strategy == "auto":
        strategy = "broadcast" if plan_bytes(dim) <= settings.broadcast_max_bytes else "shuffle"
    if strategy == "broadcast":
        d = F.broadcast(d)
    joined = df.join(d, on=key, how="left")
    cols = [c for c in df.columns]
    return joined.select(*cols, F.coalesce(F.col("_dim_val"), F.lit(settings.not_found)).alias(value))
