"""Pipeline settings: one dataclass instead of a command-line option parser.

Defaults follow the reference job's documented option defaults; the
``deployed()`` preset uses the values its deployment script passes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

_DURATION = re.compile(r"^(\d+)([smh])$")
_UNIT_MS = {"s": 1_000, "m": 60_000, "h": 3_600_000}
_UNIT_NAME = {"s": "seconds", "m": "minutes", "h": "hours"}


def parse_duration(value: str | None) -> int:
    """Parse ``'5s' | '13m' | '2h'`` to milliseconds; anything else (empty,
    zero, null, other units) is rejected with ``ValueError``."""
    if value is None:
        raise ValueError("duration must not be null")
    m = _DURATION.match(value.strip())
    if not m:
        raise ValueError(f"unsupported duration {value!r}: use <n>s, <n>m or <n>h")
    ms = int(m.group(1)) * _UNIT_MS[m.group(2)]
    if ms <= 0:
        raise ValueError(f"duration must be greater than 0: {value!r}")
    return ms


def spark_interval(value: str) -> str:
    """``'6h'`` -> ``'6 hours'`` (a Spark interval string)."""
    parse_duration(value)
    m = _DURATION.match(value.strip())
    return f"{int(m.group(1))} {_UNIT_NAME[m.group(2)]}"


@dataclass(frozen=True)
class Settings:
    # windowing / triggers
    window_size: str = "5m"
    allowed_lateness: str = "5m"
    early_firing_period: str = "1m"
    late_firing_count: int = 1
    # message attributes
    id_attr: str = "id"
    ts_attr: str = "timestamp"
    # payload
    csv_delimiter: str = ","
    not_found: str = "Not Found"
    strict: bool = True
    # file sinks
    output_dir: str = "out/YYYY/MM/DD/HH/"
    err_output_dir: str = "err/YYYY/MM/DD/HH/"
    filename_prefix: str = "events"
    shard_template: str = "W-P-SS-of-NN"
    csv_suffix: str = ".csv"
    avro_suffix: str = ".avro"
    num_shards: int = 1
    # bulk document sink
    bulk_max_docs: int = 1000
    bulk_max_bytes: int = 5 * 1024 * 1024
    bulk_max_attempts: int = 6
    bulk_max_retry_ms: int = 60_000
    bulk_initial_backoff_ms: int = 5_000
    # broadcast guard for the dimension lookup (bytes, by the plan's statistics); above it the join shuffles
    broadcast_max_bytes: int = 64 * 1024 * 1024
    # how long (processing time) an id is remembered for redeliveries
    dedup_horizon: str = "10m"
    # warehouse
    truncate_seconds: bool = True

    def __post_init__(self):
        for name in ("window_size", "allowed_lateness", "early_firing_period", "dedup_horizon"):
            parse_duration(getattr(self, name))
        if self.late_firing_count < 1:
            raise ValueError("late_firing_count must be >= 1")
        if self.num_shards < 1:
            raise ValueError("num_shards must be >= 1")
        if self.bulk_max_docs < 1 or self.bulk_max_bytes < 1:
            raise ValueError("bulk batch limits must be positive")

    @property
    def window_ms(self) -> int:
        return parse_duration(self.window_size)

    @property
    def lateness_ms(self) -> int:
        return parse_duration(self.allowed_lateness)

    @property
    def early_ms(self) -> int:
        return parse_duration(self.early_firing_period)

    def with_(self, **kw) -> "Settings":
        return replace(self, **kw)

    @classmethod
    def deployed(cls) -> "Settings":
        """Values the reference's deployment passes (6 s windows, 8 s lateness,
        2 s early firings, late count 1, one shard)."""
        return cls(window_size="6s", allowed_lateness="8s", early_firing_period="2s")

    @classmethod
    def fixture(cls) -> "Settings":
        """Settings used by the registered queries over the ``events`` table,
        which spans 30 days: 6-hour windows, 30-minute lateness and
        30-minute micro-batches."""
        return cls(window_size="6h", allowed_lateness="30m", early_firing_period="30m")
