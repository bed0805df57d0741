"""Table sinks: day-partitioned warehouse table and key/value cell tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.sinks.files import start_files


def write_warehouse(rows: DataFrame, path: str | None = None, table: str | None = None,
                    fmt: str = "parquet") -> None:
    """Append warehouse rows partitioned by ``event_date`` (DAY partitioning on
    event_ts; readers get partition pruning on date filters)."""
    w = rows.hint("rebalance", "event_date").write.format(fmt).mode("append").partitionBy("event_date")
    if table:
        w.saveAsTable(table)
    else:
        w.save(path)


def write_cells(cells: DataFrame, path: str, fmt: str = "parquet", batch_id: int | None = None) -> None:
    """Key/value cells (row_key, family, qualifier, cell_ts, value), sorted by
    row key within files so prefix scans read few row groups."""
    out = cells.repartitionByRange("row_key").sortWithinPartitions("row_key", "qualifier")
    if batch_id is not None:
        out.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")
    else:
        out.write.mode("append").format(fmt).save(path)


@dataclass(frozen=True)
class Rule:
    """What the target table asks of a column."""
    column: str
    type: str = "string"
    required: bool = False
    low: object = None
    high: object = None


def checked_rows(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """``rows`` (any types) as the target's columns, with ``reason`` (null: fit for the table; else the first
    rule broken: ``required``, ``type`` or ``range`` and the column) and ``raw``, the row as JSON
    where it is not fit."""
    typed, reasons = [], []
    for r in rules:
        given = F.col(r.column)
        value = given.try_cast(r.type) if r.type != "string" else given.cast("string")
        typed.append(value.alias(r.column))
        if r.required:
            reasons.append(F.when(given.isNull(), F.lit(f"required {r.column}")))
        reasons.append(F.when(given.isNotNull() & value.isNull(), F.lit(f"type {r.column}")))
        beyond = [value < F.lit(r.low)] * (r.low is not None) + [value > F.lit(r.high)] * (r.high is not None)
        for b in beyond:
            reasons.append(F.when(b, F.lit(f"range {r.column}")))
    reason = F.coalesce(*reasons)
    raw = F.when(reason.isNotNull(), F.to_json(F.struct(*[F.col(r.column) for r in rules])))
    return rows.select(*typed, reason.alias("reason"), raw.alias("raw"))


def _routed(rows: DataFrame, rules: list[Rule], day: Column) -> DataFrame:
    out = checked_rows(rows, rules)
    fit = F.col("reason").isNull()
    return (out.withColumn("route", F.when(fit, F.lit("rows")).otherwise(F.lit("failed")))
            .withColumn("event_date", F.when(fit, day)))


def start_warehouse(rows: DataFrame, root: str, checkpoint: str, rules: list[Rule], day: Column, trigger: dict | None = None):
    """A stream into the day-partitioned table at ``root``. Rows that the target would refuse are failed
    inserts: they land beside the table (``read_failed``), in the same commit of the same
    micro-batch, so a row is in one of the two and once. Faults of the storage are not faults of
    rows: the task is retried, then the micro-batch."""
    return start_files(_routed(rows, rules, day), root, checkpoint, parts=["route", "event_date"], trigger=trigger)


def read_warehouse_rows(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root).where("route = 'rows'").drop("route", "reason", "raw")


def read_failed(spark: SparkSession, root: str) -> DataFrame:
    """reason and raw of the failed inserts."""
    return spark.read.parquet(root).where("route = 'failed'").select("reason", "raw")
