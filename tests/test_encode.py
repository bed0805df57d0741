import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.operators import encode as enc
from eventlake.schemas import DETAIL, from_avro_json
from eventlake.settings import Settings


def test_typed_by_schema_rules(spark):
    df = spark.createDataFrame([("a,TRUE,1,2,1.5,2.5,extra",), ("a,yes,x,2,1.5,2.5",), ("a,true",)],
                               "line string")
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("s", T.StringType()), ("b", T.BooleanType()), ("i", T.IntegerType()),
        ("l", T.LongType()), ("f", T.FloatType()), ("d", T.DoubleType())]])
    r = enc.typed_by_schema(df, schema).collect()
    assert (r[0].s, r[0].b, r[0].i, r[0].l, r[0].d, r[0].error) == ("a", True, 1, 2, 2.5, None)
    assert r[1].b is False and r[1].error == "bad_i"
    assert r[2].error == "too_few_fields"


def test_typed_by_schema_rejects_unsupported(spark):
    df = spark.createDataFrame([("1",)], "line string")
    with pytest.raises(ValueError):
        enc.typed_by_schema(df, T.StructType([T.StructField("x", T.DecimalType(10, 2))]))
    with pytest.raises(ValueError):
        from_avro_json({"fields": [{"name": "x", "type": "bytes"}]})


def test_avro_schema_roundtrip():
    import json
    avsc = {"fields": [{"name": f.name, "type": {"LongType()": "long", "StringType()": "string",
            "IntegerType()": "int", "BooleanType()": "boolean"}[repr(f.dataType)]} for f in DETAIL.fields]}
    assert from_avro_json(json.loads(json.dumps(avsc))) == DETAIL


def test_warehouse_row_truncates_and_null_tail(spark):
    df = spark.createDataFrame([("1700000000999,t,n,7,teal,42,1700000001999,cool",)], "line string")
    r = enc.warehouse_row(df).collect()[0]
    assert r.event_ts.timestamp() == 1700000000 and r.process_ts.timestamp() == 1700000001
    assert r.window is None and r.pane_idx is None and r.is_first is None
    assert str(r.event_date) == "2023-11-14"


def test_json_document(spark):
    df = spark.createDataFrame([(1700000000000, "t", "n", 7, "teal", 42, 1700000001000, "cool")],
                               "event_ts long, thread_id string, thread_name string, seq int, dim1 string,"
                               " metrics1 int, process_ts long, dim1_val string")
    r = enc.json_document(df).collect()[0]
    assert r.doc == ('{"@timestamp":1700000000000,"thread_id":"t","thread_name":"n","seq":7,'
                     '"dim1":"teal","metrics1":42,"process_ts":1700000001000,"dim1_val":"cool"}')
    assert r.n_bytes == len(r.doc.encode())


def test_windowed_path(spark):
    df = spark.createDataFrame([(0, 21600000, 2, True, "LATE")],
                               "win_start_ms long, win_end_ms long, pane_idx long, is_last boolean, timing string")
    s = Settings(output_dir="gs://b/YYYY/MM/DD/HH/", num_shards=3)
    p = enc.windowed_path(df, s, shard=F.lit(1)).collect()[0].path
    assert p == ("gs://b/1970/01/01/06/events1970-01-01T00:00:00.000Z-1970-01-01T06:00:00.000Z"
                 "-pane-2-late-last-01-of-03.csv")


def test_detail_rows_no_firing(spark):
    from eventlake.plans import fixtures as fx
    from conftest import SF001
    d = enc.csv_line(enc.detail_rows(fx.enriched(spark, SF001), Settings.fixture())).filter("seq = 0").collect()[0]
    parts = d.line.split(",")
    assert len(parts) == 16 and parts[9] == "PaneInfo.NO_FIRING" and parts[14] == "UNKNOWN"
    assert parts[8].startswith("[2024-01-01T00:00:00.000Z..")


def test_typed_by_schema_fail_mode_raises(spark):
    df = spark.createDataFrame([("a,1",), ("b,x",)], "line string")
    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("i", T.IntegerType())])
    ok = enc.typed_by_schema(df.limit(1), schema, mode="fail").collect()
    assert ok[0].i == 1
    with pytest.raises(Exception, match="bad record: bad_i"):
        enc.typed_by_schema(df, schema, mode="fail").collect()


def test_json_document_iso_timestamps(spark):
    df = spark.createDataFrame([(1700000000123, "t", "n", 7, "teal", 42, 1700000001000, "cool")],
                               "event_ts long, thread_id string, thread_name string, seq int, dim1 string,"
                               " metrics1 int, process_ts long, dim1_val string")
    r = enc.json_document(df, ms_as="iso").collect()[0]
    assert r.doc.startswith('{"@timestamp":"2023-11-14T22:13:20.123Z"')


def test_warehouse_schema_file_loader():
    from eventlake.schemas import from_warehouse_json
    doc = {"BigQuery Schema": [{"name": "event_ts", "type": "TIMESTAMP", "mode": "NULLABLE"},
                               {"name": "seq", "type": "INTEGER"}, {"name": "is_first", "type": "BOOLEAN"}]}
    st = from_warehouse_json(doc)
    assert [(f.name, f.dataType.simpleString()) for f in st.fields] == [
        ("event_ts", "timestamp"), ("seq", "bigint"), ("is_first", "boolean")]
    with pytest.raises(ValueError):
        from_warehouse_json({"BigQuery Schema": [{"name": "x", "type": "GEOGRAPHY"}]})


def test_nulls_and_commas_keep_their_columns(spark):
    from eventlake.operators.encode import csv_line, typed_records, warehouse_record
    from eventlake.schemas import DETAIL, DETAIL_FIELDS
    row = [1700000000000, "t", "n", 7, None, None, 1700000001000, "a, b", "[w)", "p", 0, 0, True, True, "UNKNOWN", 1700000000000]
    df = spark.createDataFrame([tuple(row)], DETAIL)
    assert csv_line(df).first().line.split(",")[4:6] == ["", ""]
    assert tuple(typed_records(df).first()) == tuple(row)
    w = warehouse_record(df).first()
    assert w.dim1 is None and w.metrics1 is None and w.dim1_val == "a, b" and w.pane_timing == "UNKNOWN"
    assert set(DETAIL_FIELDS) < set(w.asDict())


def test_fail_mode_fails_whatever_is_selected(spark):
    import pytest
    from pyspark.sql import types as T
    from eventlake.operators.encode import typed_by_schema
    schema = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.StringType())])
    df = spark.createDataFrame([("oops,b",)], "line string")
    for c in ("x", "y"):
        with pytest.raises(Exception, match="bad record"):
            typed_by_schema(df, schema, mode="fail").select(c).collect()


def test_wide_totals_of_odd_keys_and_repeated_cells(spark):
    from eventlake.operators.encode import read_wide_total, wide_rows
    cell = lambda k, q, ts, v: (f"{k}#0#6000", "stats", q, ts, v)
    rows = [cell("a#b", q, 1, v) for q, v in (("num_records#0", "2"), ("sum#0", "5"), ("max#0", "4"), ("min#0", "1"))]
    rows += [cell("a#b", "sum#0", 2, "7"), cell("a#b", "num_records#1", 1, "1"), cell("a#b", "sum#1", 1, "1")]
    cells = spark.createDataFrame(rows, "row_key string, family string, qualifier string, cell_ts long, value string")
    r = read_wide_total(cells).first()
    assert (r.dim1, r.win_start_ms, r.win_end_ms, r.num_records, r["sum"]) == ("a#b", 0, 6000, 3, 8)
    assert wide_rows(cells).first().cells["sum#0"] == "7"
