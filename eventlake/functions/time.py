"""Time expressions: epoch milliseconds, window bounds, window/pane text.

All rendering assumes the session time zone is UTC (see ``session.prepare``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_MAX = 9223372036854775807


def epoch_ms(ts: Column) -> Column:
    """timestamp (or timestamp_ntz, read as UTC) -> epoch ms, floored."""
    return F.unix_millis(ts.cast("timestamp"))


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def window_start_ms(ms: Column, size_ms: int) -> Column:
    """Epoch-aligned tumbling window start for an epoch-ms column."""
    return ms - F.pmod(ms, F.lit(size_ms))


def instant_str(ms: Column) -> Column:
    """ISO-8601 UTC instant with milliseconds, e.g. 2024-01-01T06:00:00.000Z."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def interval_window_str(start_ms: Column, end_ms: Column) -> Column:
    """Interval window text ``[start..end)``."""
    return F.concat(F.lit("["), instant_str(start_ms), F.lit(".."), instant_str(end_ms), F.lit(")"))


def pane_info_str(idx: Column, nonspec_idx: Column, is_first: Column, is_last: Column,
                  timing: Column) -> Column:
    """Pane text: ``PaneInfo{isFirst=true, isLast=true, timing=ON_TIME, index=0,
    onTimeIndex=0}``; absent flags and a -1 on-time index are omitted; the
    unfired pane renders as ``PaneInfo.NO_FIRING``."""
    body = F.concat(
        F.lit("PaneInfo{"),
        F.when(is_first, F.lit("isFirst=true, ")).otherwise(F.lit("")),
        F.when(is_last, F.lit("isLast=true, ")).otherwise(F.lit("")),
        F.lit("timing="), timing,
        F.lit(", index="), idx.cast("string"),
        F.when(nonspec_idx != -1, F.concat(F.lit(", onTimeIndex="), nonspec_idx.cast("string")))
         .otherwise(F.lit("")),
        F.lit("}"))
    return F.when(timing == F.lit("UNKNOWN"), F.lit("PaneInfo.NO_FIRING")).otherwise(body)


def pane_file_str(idx: Column, is_last: Column, timing: Column) -> Column:
    """Pane part of a windowed file name: ``pane-<i>[-late][-last]``."""
    return F.concat(F.lit("pane-"), idx.cast("string"),
                    F.when(timing == F.lit("LATE"), F.lit("-late")).otherwise(F.lit("")),
                    F.when(is_last, F.lit("-last")).otherwise(F.lit("")))


def reverse_ts(ms: Column) -> Column:
    """``Long.MAX_VALUE - ms`` so a prefix scan returns newest first."""
    return F.lit(LONG_MAX) - ms
