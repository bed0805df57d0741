"""The message log as a stream source: bounded micro-batches, offsets kept over a restart."""

import datetime as dt

import pytest

from eventlake.schemas import MESSAGE
from eventlake.sources.log import append_messages, drain, read_message_log


def _messages(spark, minutes):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    return spark.createDataFrame([(f"m{m}", bytearray(b"x"), {"id": f"m{m}"}, at + dt.timedelta(minutes=m)) for m in minutes], MESSAGE)


def _run(spark, work, seen, per_trigger=1, hold_back=0):
    def sink(df, batch_id):
        seen.append((batch_id, sorted(r.message_id for r in df.collect())))
    s = read_message_log(spark, f"{work}/log", f"{work}/ckpt", per_trigger, hold_back)
    drain(s.writeStream.option("checkpointLocation", f"{work}/ckpt").foreachBatch(sink).trigger(processingTime="0 seconds").start())


def test_buckets_are_read_in_order_and_once(spark, tmp_path):
    work, seen = str(tmp_path), []
    append_messages(_messages(spark, [1, 2, 11, 35, 36]), f"{work}/log", 10)
    _run(spark, work, seen)
    assert seen == [(0, ["m1", "m2"]), (1, ["m11"]), (2, ["m35", "m36"])]
    # restarts go on from their place; a larger bound takes several buckets
    _run(spark, work, seen)
    append_messages(_messages(spark, [41, 52, 63]), f"{work}/log", 10)
    _run(spark, work, seen, per_trigger=2)
    assert seen[3:] == [(3, ["m41", "m52"]), (4, ["m63"])]


def test_last_bucket_is_held_back(spark, tmp_path):
    work, seen = str(tmp_path), []
    append_messages(_messages(spark, [1, 11, 21]), f"{work}/log", 10)
    _run(spark, work, seen, hold_back=1)
    assert [ids for _, ids in seen] == [["m1"], ["m11"]]


def test_failed_micro_batch_is_read_again(spark, tmp_path):
    work, seen = str(tmp_path), []
    append_messages(_messages(spark, [1, 11, 21]), f"{work}/log", 10)

    def fails(df, batch_id):
        if batch_id == 1:
            raise OSError("cut off")
        seen.append((batch_id, [r.message_id for r in df.collect()]))
    s = read_message_log(spark, f"{work}/log", f"{work}/ckpt")
    q = s.writeStream.option("checkpointLocation", f"{work}/ckpt").foreachBatch(fails).trigger(processingTime="0 seconds").start()
    with pytest.raises(Exception):
        q.processAllAvailable()
    _run(spark, work, seen)
    assert seen == [(0, ["m1"]), (1, ["m11"]), (2, ["m21"])]
