from pyspark.sql import functions as F

from eventlake.operators.wordcount import count_words
from eventlake.sources.dims import read_dimension_or_empty
from eventlake.sources.tables import read_text


def test_dimension_or_empty(spark, tmp_path):
    df = read_dimension_or_empty(spark, path=str(tmp_path / "missing"))
    assert df.count() == 0 and df.columns == ["dim1", "dim1_val"]


def test_text_source_and_sink_word_count(spark, tmp_path):
    lines = ["red kite", "red", "kite red tail", "", "tail red"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / "in"))
    counts = count_words(read_text(spark, str(tmp_path / "in")))
    counts.select("formatted").write.text(str(tmp_path / "out"))
    got = {r.value for r in spark.read.text(str(tmp_path / "out")).collect()}
    assert got == {"red: 4", "kite: 2", "tail: 2"}


def test_kafka_frame_normalises(spark):
    from eventlake.sources.messages import kafka_to_messages
    df = spark.createDataFrame(
        [("t", 0, 5, bytearray(b"1,a,b,2,teal,3"), [("id", bytearray(b"m1")), ("timestamp", bytearray(b"1000")),
                                                           ("id", bytearray(b"m2"))], None)],
        "topic string, partition int, offset long, value binary, "
        "headers array<struct<key:string,value:binary>>, timestamp timestamp")
    r = kafka_to_messages(df).collect()[0]
    assert r.message_id == "t-0-5" and r.attributes == {"id": "m2", "timestamp": "1000"}  # the last of a repeated key


def test_read_dimension_keeps_update_time_for_last_wins(spark, tmp_path):
    from eventlake.operators.enrich import enrich
    from eventlake.sources.dims import read_dimension
    spark.createDataFrame([("teal", "cool", 1), ("teal", "cold", 2), ("amber", "warm", 1)],
                          "dim1 string, dim1_val string, updated_at int").write.parquet(str(tmp_path / "dim"))
    dim = read_dimension(spark, path=str(tmp_path / "dim"))
    assert "updated_at" in dim.columns
    v = spark.createDataFrame([("teal",), ("amber",)], "dim1 string")
    assert {r.dim1: r.dim1_val for r in enrich(v, dim).collect()} == {"teal": "cold", "amber": "warm"}
