"""Schemas: one StructType per record shape (single source of truth)."""

from __future__ import annotations

from pyspark.sql import types as T

# Message as it comes off a queue (or a replayed table of messages).
MESSAGE = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    T.StructField("publish_ts", T.TimestampType()),
])

# The positional CSV layouts of the event record.
RAW_FIELDS = ["event_ts", "thread_id", "thread_name", "seq", "dim1", "metrics1"]
ENRICHED_FIELDS = RAW_FIELDS + ["process_ts", "dim1_val"]
DETAIL_FIELDS = ENRICHED_FIELDS + [
    "window", "pane_info", "pane_idx", "pane_nonspeculative_idx",
    "is_first", "is_last", "pane_timing", "pane_event_ts",
]

# Record schema of the detail row (file/Avro layout): epoch-ms longs.
DETAIL = T.StructType([
    T.StructField("event_ts", T.LongType()),
    T.StructField("thread_id", T.StringType()),
    T.StructField("thread_name", T.StringType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("dim1", T.StringType()),
    T.StructField("metrics1", T.IntegerType()),
    T.StructField("process_ts", T.LongType()),
    T.StructField("dim1_val", T.StringType()),
    T.StructField("window", T.StringType()),
    T.StructField("pane_info", T.StringType()),
    T.StructField("pane_idx", T.LongType()),
    T.StructField("pane_nonspeculative_idx", T.LongType()),
    T.StructField("is_first", T.BooleanType()),
    T.StructField("is_last", T.BooleanType()),
    T.StructField("pane_timing", T.StringType()),
    T.StructField("pane_event_ts", T.LongType()),
])

RAW = T.StructType(DETAIL.fields[:6])
ENRICHED = T.StructType(DETAIL.fields[:8])

# Warehouse table: ms columns become TIMESTAMP (seconds precision by default).
WAREHOUSE = T.StructType([
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("thread_id", T.StringType()),
    T.StructField("thread_name", T.StringType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("dim1", T.StringType()),
    T.StructField("metrics1", T.IntegerType()),
    T.StructField("process_ts", T.TimestampType()),
    T.StructField("dim1_val", T.StringType()),
    T.StructField("window", T.StringType()),
    T.StructField("pane_info", T.StringType()),
    T.StructField("pane_idx", T.LongType()),
    T.StructField("pane_nonspeculative_idx", T.LongType()),
    T.StructField("is_first", T.BooleanType()),
    T.StructField("is_last", T.BooleanType()),
    T.StructField("pane_timing", T.StringType()),
    T.StructField("pane_event_ts", T.TimestampType()),
])

# Dimension table; only (dim1, dim1_val) is read by the lookup.
DIMENSION = T.StructType([
    T.StructField("dim1", T.StringType()),
    T.StructField("dim1_val", T.StringType()),
])

# Tall / wide key-value cells.
CELL = T.StructType([
    T.StructField("row_key", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("qualifier", T.StringType()),
    T.StructField("cell_ts", T.LongType()),
    T.StructField("value", T.StringType()),
])

SUPPORTED_RECORD_TYPES = (T.StringType, T.BooleanType, T.IntegerType,
                          T.LongType, T.FloatType, T.DoubleType)


def from_avro_json(avsc: dict) -> T.StructType:
    """Record schema (Avro JSON, primitive field types only) -> StructType."""
    mapping = {"string": T.StringType(), "boolean": T.BooleanType(),
               "int": T.IntegerType(), "long": T.LongType(),
               "float": T.FloatType(), "double": T.DoubleType()}
    fields = []
    for f in avsc["fields"]:
        t = f["type"]
        if not isinstance(t, str) or t.lower() not in mapping:
            raise ValueError(f"Field type {t} is not supported.")
        fields.append(T.StructField(f["name"], mapping[t.lower()]))
    return T.StructType(fields)


def from_warehouse_json(doc: dict) -> T.StructType:
    """Warehouse schema JSON (key ``"BigQuery Schema"`` with name/type/mode)
    -> StructType."""
    mapping = {"TIMESTAMP": T.TimestampType(), "STRING": T.StringType(),
               "INTEGER": T.LongType(), "INT64": T.LongType(),
               "BOOLEAN": T.BooleanType(), "BOOL": T.BooleanType(),
               "FLOAT": T.DoubleType(), "FLOAT64": T.DoubleType(), "DATE": T.DateType()}
    # Fixed value: the key holding the field list in the warehouse schema file.
    out = []
    for f in doc["BigQuery Schema"]:
        t = f["type"].upper()
        if t not in mapping:
            raise ValueError(f"Field type {t} is not supported.")
        out.append(T.StructField(f["name"], mapping[t], f.get("mode", "NULLABLE") != "REQUIRED"))
    return T.StructType(out)
