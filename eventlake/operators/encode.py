"""Encoders: detail rows and CSV lines, schema-typed records, warehouse rows,
JSON documents, tall and wide key/value cells, windowed file paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions.text import (csv_fields, field_at, java_bool, java_double, java_float,
                                      java_int, java_long)
from eventlake.functions.time import (epoch_ms, instant_str, interval_window_str, pane_file_str,
                                      pane_info_str, reverse_ts)
from eventlake.operators.aggregates import float_avg
from eventlake.schemas import DETAIL, DETAIL_FIELDS, ENRICHED_FIELDS, SUPPORTED_RECORD_TYPES
from eventlake.settings import Settings, spark_interval

# ---------------------------------------------------------------- detail rows


def detail_rows(enriched: DataFrame, settings: Settings = Settings(),
                time_col: str = "event_time") -> DataFrame:
    """Enriched rows + the 8 window/pane fields. The detail path has no
    grouping between windowing and this step, so every row carries the
    unfired pane (index 0, first and last, timing UNKNOWN)."""
    w = F.window(F.col(time_col), spark_interval(settings.window_size))
    d = enriched.withColumn("_w", w)
    start, end = epoch_ms(F.col("_w.start")), epoch_ms(F.col("_w.end"))
    idx, nonspec = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    first, last, timing = F.lit(True), F.lit(True), F.lit("UNKNOWN")
    keep = [c for c in enriched.columns if c not in DETAIL_FIELDS]
    return d.select(
        *keep, *ENRICHED_FIELDS,
        interval_window_str(start, end).alias("window"),
        pane_info_str(idx, nonspec, first, last, timing).alias("pane_info"),
        idx.alias("pane_idx"), nonspec.alias("pane_nonspeculative_idx"),
        first.alias("is_first"), last.alias("is_last"), timing.alias("pane_timing"),
        epoch_ms(F.col(time_col)).alias("pane_event_ts"))


def csv_line(df: DataFrame, fields=DETAIL_FIELDS, delimiter: str = ",", out: str = "line") -> DataFrame:
    """Positional CSV text of the given columns (booleans as true/false, nulls as
    empty fields, so later columns keep their place)."""
    return df.withColumn(out, F.concat_ws(delimiter, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]))


def typed_records(detail: DataFrame, schema: T.StructType = DETAIL) -> DataFrame:
    """Detail rows as records of ``schema``, column by column: no text in between, so
    nulls and values that hold a delimiter stay what they are."""
    return detail.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


# ------------------------------------------------------------- typed records

_PARSERS = {
    T.StringType: lambda s: s, T.BooleanType: java_bool, T.IntegerType: java_int,
    T.LongType: java_long, T.FloatType: java_float, T.DoubleType: java_double,
}


def typed_by_schema(df: DataFrame, schema: T.StructType = DETAIL, text_col: str = "line",
                    delimiter: str = ",", mode: str = "dead_letter") -> DataFrame:
    """CSV text -> record by schema position (string/boolean/int/long/float/
    double; other types are rejected when the plan is built). Extra CSV
    fields are ignored. ``mode='dead_letter'`` adds ``error`` (too few fields
    or an unparsable value); ``mode='fail'`` raises at runtime instead."""
    for f in schema.fields:
        if not isinstance(f.dataType, SUPPORTED_RECORD_TYPES):
            raise ValueError(f"Field type {f.dataType.simpleString()} is not supported.")
    parts = csv_fields(F.col(text_col), delimiter)
    d = df.withColumn("_p", parts)
    typed, checks = [], []
    for i, f in enumerate(schema.fields):
        raw = field_at(F.col("_p"), i)
        v = _PARSERS[type(f.dataType)](raw)
        typed.append(v.alias(f.name))
        if not isinstance(f.dataType, (T.StringType, T.BooleanType)):
            checks.append(F.when(v.isNull(), F.lit(f"bad_{f.name}")))
    n = len(schema.fields)
    error = F.coalesce(F.when(F.size(F.col("_p")) < n, F.lit("too_few_fields")), *checks)
    if mode == "fail":  # in every typed column, so that pruning one does not prune the check
        fail = F.raise_error(F.concat(F.lit("bad record: "), error))
        typed = [F.when(error.isNotNull(), fail).otherwise(t).alias(f.name) for t, f in zip(typed, schema.fields)]
    keep = [c for c in df.columns if c not in schema.fieldNames()]
    return d.select(*keep, *typed, error.alias("error"))


def warehouse_row(df: DataFrame, text_col: str = "line", delimiter: str = ",",
                  truncate_seconds: bool = True) -> DataFrame:
    """Detail CSV text -> warehouse row: ms fields (0, 6, 15) to TIMESTAMP
    (truncated to seconds by default), 10/11 long, 3/5 int, 12/13 boolean,
    others string. A short row leaves the missing tail null. Adds the day
    partition column ``event_date``."""
    parts = F.col("_p")
    cols = []
    for i, name in enumerate(DETAIL_FIELDS):
        s = field_at(parts, i)
        if i in (0, 6, 15):
            ms = java_long(s)
            # ms -> whole seconds, truncating toward zero like TimeUnit.toSeconds
            v = F.timestamp_seconds((ms / F.lit(1000)).cast("bigint")) \
                if truncate_seconds else F.timestamp_millis(ms)
        elif i in (10, 11):
            v = java_long(s)
        elif i in (3, 5):
            v = java_int(s)
        elif i in (12, 13):
            v = F.when(s.isNotNull(), java_bool(s))
        else:
            v = s
        cols.append(v.alias(name))
    d = df.withColumn("_p", csv_fields(F.col(text_col), delimiter))
    keep = [c for c in df.columns if c not in DETAIL_FIELDS and c != text_col]
    out = d.select(*keep, *cols)
    return out.withColumn("event_date", F.to_date(F.col("event_ts")))


def warehouse_record(detail: DataFrame, truncate_seconds: bool = True) -> DataFrame:
    """The same row from typed detail columns."""
    def ts(c: str) -> Column:
        ms = F.col(c).cast("bigint")
        return F.timestamp_seconds((ms / F.lit(1000)).cast("bigint")) if truncate_seconds else F.timestamp_millis(ms)
    times = {DETAIL_FIELDS[i] for i in (0, 6, 15)}
    out = detail.select(*[(ts(c) if c in times else F.col(c)).alias(c) for c in DETAIL_FIELDS])
    return out.withColumn("event_date", F.to_date(F.col("event_ts")))


# ------------------------------------------------------------------ documents


def json_document(df: DataFrame, ms_as: str = "millis") -> DataFrame:
    """Document JSON (``@timestamp``, thread_id, thread_name, seq, dim1,
    metrics1, process_ts, dim1_val). Timestamps are epoch-ms numbers by
    default (``ms_as='iso'`` renders ISO-8601 text). Adds ``n_bytes``
    (UTF-8 length of the document)."""
    def ts(c):
        return F.col(c).cast("bigint") if ms_as == "millis" else instant_str(F.col(c))
    doc = F.to_json(F.struct(
        ts("event_ts").alias("@timestamp"), F.col("thread_id"), F.col("thread_name"),
        F.col("seq").cast("bigint").alias("seq"), F.col("dim1"),
        F.col("metrics1").cast("bigint").alias("metrics1"), ts("process_ts").alias("process_ts"),
        F.col("dim1_val")))
    return df.withColumn("doc", doc).withColumn("n_bytes", F.octet_length(F.col("doc")))


# ------------------------------------------------------------ key/value cells

_STATS = ("num_records", "sum", "max", "min", "avg")


def tall_encode(panes: DataFrame, key: str = "dim1") -> DataFrame:
    """Accumulating panes -> tall cells. Row key ``key#(Long.MAX-process_ts)#win_start``
    (newest first under a key prefix; the window start keeps two windows
    firing in the same millisecond apart). Families: ``stats`` and
    ``window_info``; cell timestamp = process_ts; values are strings."""
    rk = F.concat_ws("#", F.col(key), reverse_ts(F.col("process_ts")).cast("string"),
                     F.col("win_start_ms").cast("string"))
    ts = F.col("process_ts")
    stats = [(s, F.col(s)) for s in _STATS]
    info = [
        ("window", interval_window_str(F.col("win_start_ms"), F.col("win_end_ms"))),
        ("pane", pane_info_str(F.col("pane_idx"), F.col("pane_nonspeculative_idx"),
                               F.col("is_first"), F.col("is_last"), F.col("timing"))),
        ("pane_idx", F.col("pane_idx")), ("pane_nonspeculative_idx", F.col("pane_nonspeculative_idx")),
        ("is_first", F.col("is_first")), ("is_last", F.col("is_last")), ("timing", F.col("timing")),
        ("win_start_ts", F.col("win_start_ms")), ("win_end_ts", F.col("win_end_ms")),
    ]
    both = F.concat(F.array(*[F.struct(F.lit("stats").alias("f"), F.lit(q).alias("q"), v.cast("string").alias("v"))
                              for q, v in stats]),
                    F.array(*[F.struct(F.lit("window_info").alias("f"), F.lit(q).alias("q"),
                                       v.cast("string").alias("v")) for q, v in info]))
    return (panes.select(rk.alias("row_key"), ts.alias("cell_ts"), F.explode(both).alias("c"))
            .select("row_key", F.col("c.f").alias("family"), F.col("c.q").alias("qualifier"),
                    "cell_ts", F.col("c.v").alias("value")))


def wide_encode(panes: DataFrame, key: str = "dim1") -> DataFrame:
    """Discarding panes -> wide cells: row key ``key#winStartMs#winEndMs``,
    qualifier ``stat#paneIdx`` (one column group per pane)."""
    rk = F.concat_ws("#", F.col(key), F.col("win_start_ms").cast("string"),
                     F.col("win_end_ms").cast("string"))
    arr = F.array(*[F.struct(F.concat(F.lit(s + "#"), F.col("pane_idx").cast("string")).alias("q"),
                             F.col(s).cast("string").alias("v")) for s in _STATS])
    return (panes.select(rk.alias("row_key"), F.col("process_ts").alias("cell_ts"), F.explode(arr).alias("c"))
            .select("row_key", F.lit("stats").alias("family"), F.col("c.q").alias("qualifier"),
                    "cell_ts", F.col("c.v").alias("value")))


def wide_rows(cells: DataFrame) -> DataFrame:
    """Wide cells -> one row per row key with a ``qualifier -> value`` map
    (a row holds 5 cells per pane of one window: bounded). Of a cell written
    again the latest counts."""
    return latest_cells(cells).groupBy("row_key").agg(
        F.map_from_entries(F.collect_list(F.struct("qualifier", "value"))).alias("cells"))


def latest_cells(cells: DataFrame) -> DataFrame:
    """One value per (row_key, qualifier): the one with the latest cell timestamp."""
    return cells.groupBy("row_key", "qualifier").agg(
        F.max_by("value", F.struct("cell_ts", "value")).alias("value"))


def read_wide_total(cells: DataFrame) -> DataFrame:
    """Recombine the discarded panes of each wide row from its cells: total count
    and sum, min of mins, max of maxes, avg = sum/count. The key may hold ``#``:
    the row key is split from its right end."""
    e = latest_cells(cells).select("row_key", F.substring_index("qualifier", "#", 1).alias("stat"),
                                   F.col("value").alias("v"))
    num = F.col("v").cast("bigint")
    g = e.groupBy("row_key").agg(
        F.sum(F.when(F.col("stat") == "num_records", num)).alias("num_records"),
        F.sum(F.when(F.col("stat") == "sum", num)).alias("sum"),
        F.max(F.when(F.col("stat") == "max", num)).cast("int").alias("max"),
        F.min(F.when(F.col("stat") == "min", num)).cast("int").alias("min"))
    tail = F.substring_index("row_key", "#", -2)
    return g.select(
        F.expr("substring(row_key, 1, length(row_key) - length(substring_index(row_key, '#', -2)) - 1)").alias("dim1"),
        F.substring_index(tail, "#", 1).cast("bigint").alias("win_start_ms"),
        F.substring_index(tail, "#", -1).cast("bigint").alias("win_end_ms"),
        "num_records", "sum", "max", "min", float_avg(F.col("sum"), F.col("num_records")).alias("avg"))


# ---------------------------------------------------------------- file paths


def resolve_dir(template: str, end_ms: Column) -> Column:
    """Replace YYYY, MM, DD, HH in a directory template from the window end."""
    t = F.timestamp_millis(end_ms)
    out = F.lit(template)
    for token, fmt in (("YYYY", "yyyy"), ("MM", "MM"), ("DD", "dd"), ("HH", "HH")):
        out = F.replace(out, F.lit(token), F.date_format(t, fmt))
    return out


def shard_name(template: str, start_ms: Column, end_ms: Column, pane: Column,
               shard: Column, num_shards: int) -> Column:
    """Expand a shard template: ``W`` window, ``P`` pane, ``S..`` shard,
    ``N..`` shard count (zero padded to the run length)."""
    import re
    parts = []
    for tok in re.findall(r"S+|N+|P|W|[^SNPW]+", template):
        if tok == "W":
            parts.append(F.concat(instant_str(start_ms), F.lit("-"), instant_str(end_ms)))
        elif tok == "P":
            parts.append(pane)
        elif tok[0] == "S":
            parts.append(F.lpad(shard.cast("string"), len(tok), "0"))
        elif tok[0] == "N":
            parts.append(F.lit(str(num_shards).zfill(len(tok))))
        else:
            parts.append(F.lit(tok))
    return F.concat(*parts)


def windowed_path(df: DataFrame, settings: Settings = Settings(), output_dir: str | None = None,
                  suffix: str | None = None, shard: Column | None = None) -> DataFrame:
    """Add ``path``: resolved dir + prefix + shard template + suffix, from
    ``win_start_ms``, ``win_end_ms``, ``pane_idx``, ``is_last``, ``timing``."""
    d = output_dir if output_dir is not None else settings.output_dir
    sfx = suffix if suffix is not None else settings.csv_suffix
    shard = shard if shard is not None else F.lit(0)
    pane = pane_file_str(F.col("pane_idx"), F.col("is_last"), F.col("timing"))
    name = shard_name(settings.shard_template, F.col("win_start_ms"), F.col("win_end_ms"),
                      pane, shard, settings.num_shards)
    return df.withColumn("path", F.concat(resolve_dir(d, F.col("win_end_ms")),
                                          F.lit(settings.filename_prefix), name, F.lit(sfx)))
