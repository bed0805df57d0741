"""eventlake: event-stream analytics as Spark DataFrame functions.

Every operator is a plain function ``f(df, ...) -> DataFrame`` that works on
batch tables and, where it makes sense, on Structured Streaming DataFrames.
"""

from eventlake.settings import Settings, parse_duration

__all__ = ["Settings", "parse_duration"]
