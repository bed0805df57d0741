import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventlake.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def msg_rows(spark, payloads, ts_ms=1700000000000, publish_ms=None):
    """Messages from raw payload bytes (None = no payload)."""
    import datetime as dt
    from eventlake.schemas import MESSAGE
    rows = []
    for i, p in enumerate(payloads):
        b = None if p is None else (p if isinstance(p, (bytes, bytearray)) else p.encode())
        pub = dt.datetime.fromtimestamp(((publish_ms or ts_ms) + i) / 1000, dt.timezone.utc)
        rows.append((f"m{i}", bytearray(b) if b is not None else None,
                     {"id": f"m{i}", "timestamp": str(ts_ms)}, pub))
    return spark.createDataFrame(rows, MESSAGE)
