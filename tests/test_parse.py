from pyspark.sql import functions as F

from eventlake.operators.enrich import enrich
from eventlake.operators.parse import NO_PAYLOAD_TEXT, assign_event_time, parse_messages, split_routes
from eventlake.settings import Settings
from eventlake.sources.dims import fixture_dimension

from conftest import msg_rows

COLOUR_DIM = [("teal", "cool"), ("amber", "warm"), ("slate", "neutral")]

EDGE = [
    "1700000000000,t1,n1,7,teal,42",
    "1700000000000,t1,n1",
    "1700000000000,t1,n1,7",
    "1700000000000,t1,n1,7,unknown,42",
    "1700000000000,t1,n1,7,TEAL,42",
    "1700000000000,t1,n1,7,teal,x",
    "1700000000000,t1,n1,7,teal,99999999999",
    "1700000000000,t1,n1,7,teal,42,,",
    b"a\xffb",
    None,
]


def _run(spark, strict=True):
    s = Settings(strict=strict)
    p = parse_messages(msg_rows(spark, EDGE), s, process_ts=F.col("event_ts") + 1000)
    valid, dead = split_routes(p)
    dim = spark.createDataFrame(COLOUR_DIM, "dim1 string, dim1_val string")
    v = {r.message_id: r for r in enrich(valid, dim, s).collect()}
    d = {r.message_id: r for r in dead.collect()}
    return v, d


def test_strict_routes(spark):
    v, d = _run(spark, strict=True)
    assert set(v) == {"m0", "m3", "m4", "m7"}
    assert v["m0"].dim1_val == "cool" and v["m0"].metrics1 == 42 and v["m0"].seq == 7
    assert v["m0"].process_ts == 1700000001000
    assert v["m3"].dim1_val == "Not Found"
    assert v["m4"].dim1_val == "Not Found"  # case-sensitive
    assert v["m7"].dim1_val == "cool" and v["m7"].metrics1 == 42  # trailing empties ignored
    assert d["m1"].reason == "too_few_fields" and d["m1"].payload == "1700000000000,t1,n1"
    assert d["m2"].reason == "too_few_fields"
    assert d["m5"].reason == "bad_metrics1"
    assert d["m6"].reason == "bad_metrics1"  # exceeds int
    assert d["m8"].payload == "a�b"
    assert d["m9"].payload == NO_PAYLOAD_TEXT and d["m9"].reason == "null_payload"
    assert len(v) + len(d) == len(EDGE)


def test_non_strict_keeps_reference_rule(spark):
    v, d = _run(spark, strict=False)
    assert "m2" in v and v["m2"].dim1_val == "Not Found"
    assert "m1" in d and "m9" in d
    assert "m8" in d  # decodes to one field only


def test_assign_event_time(spark):
    df = spark.createDataFrame([(" 1700000000123 ,a",), ("x1,a",), (None,)], "raw string")
    out = [r.event_time_ms for r in assign_event_time(df, "raw", fallback=F.lit(5)).collect()]
    assert out == [1700000000123, 5, 5]


def test_fixture_dimension_leaves_error_out(spark):
    keys = {r.dim1 for r in fixture_dimension(spark).collect()}
    assert keys == {"click", "view", "purchase", "signup"}


def test_enrich_duplicate_keys(spark):
    import pytest
    v = spark.createDataFrame([("teal",)], "dim1 string")
    dim = spark.createDataFrame([("teal", "cool", 1), ("teal", "cold", 2), ("teal", "old", None)],
                                "dim1 string, dim1_val string, updated_at int")
    assert enrich(v, dim).first().dim1_val == "cold"  # latest update wins
    assert enrich(v, dim.where("updated_at is null")).first().dim1_val == "old"  # known, though never dated
    tied = dim.withColumn("updated_at", F.lit(1))
    assert enrich(v, tied).first().dim1_val == "old"  # ties: the greater value
    with pytest.raises(Exception, match="duplicate dimension key: teal"):
        enrich(v, dim, on_duplicate="error").collect()
    with pytest.raises(Exception, match="duplicate dimension key: teal"):
        enrich(v, dim.drop("updated_at")).collect()
