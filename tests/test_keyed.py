"""Keyed wide table and named files."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from eventlake.settings import Settings
from eventlake.sinks import keyed, named

CELL = "row_key string, family string, qualifier string, cell_ts long, value string"
DAY = keyed.DAY_MS


def _cells(spark, *rows):
    return spark.createDataFrame([(f"k#{s}#{s + 10}", "stats", q, ts, v) for s, q, ts, v in rows], CELL)


def _rows(table):
    return {r.row_key: {k: c.value for k, c in r.cells.items()} for r in table.rows().collect()}


def test_one_row_per_key_after_replay_and_retry(spark, tmp_path, monkeypatch):
    t = keyed.KeyedTable(spark, str(tmp_path / "t"), keyed.window_day(), buckets=2)
    assert t.rows().count() == 0
    assert t.merge(_cells(spark, (0, "n#0", 1, "5"), (DAY, "n#0", 1, "7")), 0)
    assert not t.merge(_cells(spark, (0, "n#0", 9, "wrong")), 0)  # a replayed epoch
    put = keyed.KeyedTable._put_manifest

    def cut_off(*a):
        raise OSError("cut off")
    monkeypatch.setattr(keyed.KeyedTable, "_put_manifest", cut_off)
    with pytest.raises(OSError):
        t.merge(_cells(spark, (0, "n#1", 2, "6")), 1)
    assert _rows(t)["k#0#10"] == {"stats:n#0": "5"}
    monkeypatch.setattr(keyed.KeyedTable, "_put_manifest", put)
    untouched = t._manifest()[1]["parts"]
    assert t.merge(_cells(spark, (0, "n#1", 2, "6"), (0, "n#0", 0, "older")), 1)
    assert _rows(t) == {"k#0#10": {"stats:n#0": "5", "stats:n#1": "6"}, f"k#{DAY}#{DAY + 10}": {"stats:n#0": "7"}}
    # only the parts of the touched day were written anew
    now = t._manifest()[1]["parts"]
    assert {k for k in now if now[k] != untouched.get(k)} == {k for k in now if k.startswith("span=0/")}
    assert t.merge(_cells(spark), 2) and t.rows().count() == 2
    assert {(r.family, r.qualifier) for r in t.cells().collect()} == {("stats", "n#0"), ("stats", "n#1")}


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    t = keyed.KeyedTable(spark, str(tmp_path / "t"))
    t.merge(_cells(spark, (0, "n#0", 1, "5")), 0)
    with pytest.raises(RuntimeError, match="another writer"):
        t._put_manifest(1, {})


S = Settings(num_shards=3, output_dir="YYYY/MM/DD/HH/")


def _lines(spark, rows):
    return spark.createDataFrame(rows, "line string, win_start_ms long, win_end_ms long, at int").repartition(4)


def _files(root):
    return {os.path.relpath(f, root): open(f).read() for f in glob.glob(f"{root}/2*/**/*.csv", recursive=True)}


def test_named_files_of_a_batch(spark, tmp_path):
    root, w = str(tmp_path / "o"), 1_704_067_200_000  # 2024-01-01
    rows = [(f"a{i}", w, w + 3_600_000, i) for i in range(6)] + [("b", w + 3_600_000, w + 7_200_000, 1), (None, w, w + 3_600_000, 0)]
    named.write_named_files(_lines(spark, rows), root, S, shard=F.col("at"))
    name = "2024/01/01/{}/events2024-01-01T{}:00:00.000Z-2024-01-01T{}:00:00.000Z-pane-{}-0{}-of-03.csv".format
    got = _files(root)
    assert set(got) == {name("01", "00", "01", 0, s) for s in range(3)} | {name("02", "01", "02", 0, s) for s in range(3)}
    assert sorted(got[name("01", "00", "01", 0, 0)].split("\n")) == ["", "", "a0", "a3"]
    assert got[name("02", "01", "02", 0, 0)] == "" and got[name("02", "01", "02", 0, 1)] == "b\n"
    # the next write of a window is its next pane
    named.write_named_files(_lines(spark, rows[:1]), root, S, shard=F.col("at"))
    assert _files(root)[name("01", "00", "01", 1, 0)] == "a0\n" and len(_files(root)) == 9
    assert {(r.path, r.n_lines) for r in named.committed_files(spark, root).collect()} == \
        {(p, text.count("\n")) for p, text in _files(root).items()}
    assert not glob.glob(f"{root}/_staging/*")


def test_a_write_without_windows_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="per window"):
        named.write_named_files(spark.createDataFrame([("a",)], "line string"), str(tmp_path / "o"), S)


def test_failed_write_leaves_no_file_and_known_panes_keep_their_name(spark, tmp_path):
    root = str(tmp_path / "o")
    df = spark.range(4).select(F.concat(F.lit("x"), F.when(F.col("id") == 3, F.raise_error(F.lit("bad row"))).otherwise("")).alias("line"),
                               F.lit(0).cast("long").alias("win_start_ms"), F.lit(10).cast("long").alias("win_end_ms"))
    with pytest.raises(Exception):
        named.write_named_files(df, root, S)
    assert not glob.glob(f"{root}/**/*.csv", recursive=True)
    panes = spark.createDataFrame([("l", 0, 10, 2, True, "LATE")], "line string, win_start_ms long, win_end_ms long, pane_idx int, is_last boolean, timing string")
    named.write_named_files(panes, root, Settings())
    assert [os.path.basename(f) for f in glob.glob(f"{root}/1970/**/*.csv", recursive=True)] == \
        ["events1970-01-01T00:00:00.000Z-1970-01-01T00:00:00.010Z-pane-2-late-last-00-of-01.csv"]


def test_replayed_epoch_of_a_stream_counts_once(tmp_path):
    import pyarrow as pa
    o = {**named._options(str(tmp_path), S, "", None)}
    schema = type("Schema", (), {"fieldNames": lambda self: list(named.COLUMNS)})()
    rows = pa.RecordBatch.from_pydict({"line": ["a", "b"], "win_start_ms": [0, 0], "win_end_ms": [10, 10], "pane": pa.array([None, None], pa.string()), "shard": [0, 1]})
    for epoch in (0, 0, 1):
        w = named.NamedFilesStreamWriter(o, schema)
        w.commit([w.write(iter([rows])), None], epoch)
    assert sum("pane-0" in f for f in os.listdir(tmp_path)) == 3 and sum("pane-1" in f for f in os.listdir(tmp_path)) == 3
    w.abort([w.write(iter([rows]))], 2)
    assert len([f for f in os.listdir(tmp_path) if f.endswith(".csv")]) == 6


def test_newest_rows_of_a_key_by_a_scan_of_its_prefix(spark, tmp_path):
    from eventlake.functions.time import LONG_MAX
    from eventlake.sinks.tall import CELL, TallTable
    t = TallTable(spark, str(tmp_path / "t"), buckets=4)
    rows = [(f"{k}#{LONG_MAX - ts}#0", "stats", "n", ts, f"{k}{ts}") for k in ("a", "a#b", "c") for ts in range(0, 40 * DAY, DAY)]
    t.write(spark.createDataFrame(rows, CELL), 0)
    t.write(spark.createDataFrame(rows[-1:], CELL), 1)
    t.write(spark.createDataFrame(rows, CELL), 0)  # replayed
    assert [r.value for r in t.latest("a", 3).collect()] == [f"a{39 * DAY - k * DAY}" for k in range(3)]
    assert [r.value for r in t.latest("a#b", 1).collect()] == [f"a#b{39 * DAY}"]
    assert t.latest("none", 3).count() == 0 and t.latest("a", 100).count() == 40
    bucket = spark.range(1).select(t._bucket(F.lit("a"))).first()[0]
    assert t._days(bucket)[0] == 39
    newest = t.scan("a", t._days(bucket)[:1], bucket)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_key,a#)" in plan and "LessThan(row_key,a$)" in plan
    assert len(newest.inputFiles()) <= 2  # of the day, whatever the table's age


def test_rows_that_the_target_refuses(spark):
    from eventlake.sinks.tables import Rule, checked_rows
    rules = [Rule("a", "int", required=True, low=0, high=9), Rule("b", "date"), Rule("c", required=True)]
    rows = [("1", "2024-01-01", "x"), (None, "no", "x"), ("q", None, "x"), ("10", None, "x"), ("5", "no", "x"), ("5", None, None)]
    out = checked_rows(spark.createDataFrame(rows, "a string, b string, c string"), rules).collect()
    assert [r.reason for r in out] == [None, "required a", "type a", "range a", "type b", "required c"]
    assert out[0].raw is None and out[0].a == 1 and out[4].raw == '{"a":"5","b":"no","c":"x"}'
