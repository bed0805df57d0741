"""Column-level helpers (built-in Spark expressions only, no UDFs)."""

from eventlake.functions.text import (csv_fields, decode_payload, field_at, java_bool,
                                      java_float, java_int, java_long, tokenize)
from eventlake.functions.time import (epoch_ms, from_epoch_ms, instant_str, interval_window_str,
                                      pane_file_str, pane_info_str, reverse_ts, window_start_ms)

__all__ = [
    "csv_fields", "decode_payload", "field_at", "java_bool", "java_float", "java_int",
    "java_long", "tokenize", "epoch_ms", "from_epoch_ms", "instant_str",
    "interval_window_str", "pane_file_str", "pane_info_str", "reverse_ts", "window_start_ms",
]
