import glob
import json

from pyspark.sql import functions as F

from eventlake.settings import Settings
from eventlake.sinks.bulk import (INDEX_ACTION, _retry_needed, bulk_batches, bulk_item_errors,
                                  iter_batches, write_bulk_docs)


def test_batch_rule_count_and_bytes():
    docs = [("x" * 10, None)] * 25
    sizes = [len(b) for b, _ in iter_batches(iter(docs), max_docs=10, max_bytes=10_000)]
    assert sizes == [10, 10, 5]
    # bytes checked after adding: 35 >= 30 flushes 4 docs of 10 bytes
    sizes = [(len(b), n) for b, n in iter_batches(iter([("x" * 10, None)] * 5), 100, 30)]
    assert sizes == [(3, 30), (2, 20)]


def test_retry_predicate():
    assert _retry_needed({"errors": True, "items": [{"index": {"status": 201}}, {"index": {"status": 429}}]})
    assert not _retry_needed({"errors": True, "items": [{"index": {"status": 400}}]})
    assert not _retry_needed({"errors": False, "items": []})


def test_bulk_batches_plan(spark):
    docs = spark.range(2500).select(F.to_json(F.struct(F.col("id"))).alias("doc")).repartition(3)
    b = bulk_batches(docs, max_docs=1000).collect()
    assert sum(r.n_docs for r in b) == 2500 and max(r.n_docs for r in b) <= 1000
    assert sum(r.body_bytes - r.doc_bytes for r in b) == 2500 * (len(INDEX_ACTION) + 2)


def test_planned_bytes_match_bodies_with_ids(spark):
    docs = spark.range(300).select(F.to_json(F.struct(F.col("id"))).alias("doc"),
                                   F.concat(F.lit("id-"), F.col("id").cast("string")).alias("doc_id"))
    plan = bulk_batches(docs, max_docs=70, id_col="doc_id").collect()
    full = bulk_batches(docs, max_docs=70, id_col="doc_id", with_body=True).collect()
    assert sorted((r.partition_id, r.batch_no, r.n_docs, r.body_bytes) for r in plan) == \
        sorted((r.partition_id, r.batch_no, r.n_docs, r.body_bytes) for r in full)


def test_write_bulk_docs_file_transport(spark, tmp_path):
    docs = spark.range(250).select(F.to_json(F.struct(F.col("id"))).alias("doc"),
                                   F.col("id").cast("string").alias("doc_id")).repartition(2)
    write_bulk_docs(docs, Settings(bulk_max_docs=100), transport="file", path=str(tmp_path / "bulk"),
                    id_col="doc_id")
    files = glob.glob(str(tmp_path / "bulk" / "*.ndjson"))
    lines = [ln for f in files for ln in open(f).read().splitlines()]
    actions, bodies = lines[0::2], lines[1::2]
    assert len(bodies) == 250 and len(files) >= 3
    assert {json.loads(a)["index"]["_id"] for a in actions} == {str(i) for i in range(250)}


def test_bulk_item_errors(spark):
    resp = json.dumps({"took": 3, "errors": True, "items": [
        {"index": {"_id": "a", "status": 201}},
        {"index": {"_id": "b", "status": 400, "error": {"type": "mapper_parsing_exception", "reason": "bad"}}},
        {"index": {"_id": "c", "status": 429, "error": {"type": "es_rejected_execution_exception",
                                                         "reason": "busy"}}}]})
    df = spark.createDataFrame([(1, resp)], "request_no int, response string")
    got = [(r.item_pos, r.doc_id, r.status, r.error_type) for r in bulk_item_errors(df).orderBy("item_pos").collect()]
    assert got == [(1, "b", 400, "mapper_parsing_exception"), (2, "c", 429, "es_rejected_execution_exception")]


class Fake:
    """An index in this process: answers from a list, remembers the bodies."""

    def __init__(self, answers):
        self.answers, self.bodies = list(answers), []

    def post(self, body, name):
        self.bodies.append((name, body))
        return self.answers.pop(0) if self.answers else {"errors": False, "items": []}


def _write(monkeypatch, tmp_path, answers, n=3, **options):
    import pyarrow as pa
    from eventlake.sinks import bulk
    fake = Fake(answers)
    waits = []
    writer = bulk.BulkDocsWriter({"max_docs": "2", "initial_backoff_ms": "10", "dead_letter_path": str(tmp_path / "dead"), **options})
    monkeypatch.setattr(writer, "_transport", lambda staged: fake)
    monkeypatch.setattr(bulk.time, "sleep", waits.append)
    rows = pa.RecordBatch.from_pydict({"doc": [f'{{"k":{i}}}' for i in range(n)]})
    return fake, waits, writer, lambda: writer.write(iter([rows]))


BUSY = {"errors": True, "items": [{"index": {"status": 429}}, {"index": {"status": 201}}]}


def test_throttled_batch_is_sent_again_with_longer_waits(monkeypatch, tmp_path):
    fake, waits, _, go = _write(monkeypatch, tmp_path, [BUSY, BUSY])
    commit = go()
    assert [b for _, b in fake.bodies[:3]] == [fake.bodies[0][1]] * 3  # the whole body each time
    assert waits == [0.01, 0.02] and commit.counts == {"batches": 2, "docs": 3, "failed": 0, "retries": 2}


def test_throttled_batch_is_given_up(monkeypatch, tmp_path):
    import pytest
    _, waits, _, go = _write(monkeypatch, tmp_path, [BUSY] * 9, max_attempts="3")
    with pytest.raises(OSError, match="still throttled after 3 attempts"):
        go()
    assert len(waits) == 2
    _, waits, _, go = _write(monkeypatch, tmp_path, [BUSY] * 9, max_retry_ms="25")
    with pytest.raises(OSError, match="still throttled"):
        go()


def test_rejected_items_become_dead_letters(monkeypatch, tmp_path):
    bad = {"errors": True, "items": [{"index": {"status": 201}}, {"index": {"_id": "b", "status": 400, "error": {
        "type": "mapper", "reason": "no", "caused_by": {"type": "number", "reason": "x is not one"}}}}]}
    _, _, writer, go = _write(monkeypatch, tmp_path, [bad])
    staged = go()
    assert staged.counts["failed"] == 1 and not glob.glob(str(tmp_path / "dead" / "*.jsonl"))
    writer.commit([staged, None])
    lines = [json.loads(x) for f in glob.glob(str(tmp_path / "dead" / "*.jsonl")) for x in open(f)]
    assert [(x["item_pos"], x["doc_id"], x["status"], x["caused_by"], x["doc"]) for x in lines] == \
        [(1, "b", 400, "x is not one", '{"k":1}')]


def test_replay_with_fewer_partitions_leaves_no_stale_file(spark, tmp_path):
    docs = spark.range(40).select(F.to_json(F.struct(F.col("id"))).alias("doc"))
    for parts in (4, 1):
        write_bulk_docs(docs.repartition(parts), Settings(), transport="file", path=str(tmp_path / "b"))
    lines = [x for f in glob.glob(str(tmp_path / "b" / "*.ndjson")) for x in open(f)]
    assert len(lines) == 80


def test_folder_of_others_is_not_emptied(spark, tmp_path):
    import pytest
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "mine.txt").write_text("keep")
    with pytest.raises(ValueError, match="not written by this sink"):
        write_bulk_docs(spark.range(1).select(F.lit("{}").alias("doc")), Settings(), transport="file", path=str(tmp_path / "b"))
    assert (tmp_path / "b" / "mine.txt").read_text() == "keep"


def test_line_separators_inside_documents(spark, tmp_path):
    docs = [json.dumps({"t": f"a{c}b"}, ensure_ascii=False) for c in "\u2028\u2029\x85\x0b\x0c\x1c"]
    write_bulk_docs(spark.createDataFrame([(d,) for d in docs], "doc string"), Settings(), transport="file", path=str(tmp_path / "b"))
    lines = [x for f in glob.glob(str(tmp_path / "b" / "*.ndjson")) for x in open(f, newline="\n").read().split("\n")]
    assert sorted(x for x in lines if "_id" not in x and '"t"' in x) == sorted(docs)


def _stream_docs(spark, src, out, ckpt, source=None):
    from eventlake.sinks import bulk
    s = spark.readStream.schema("id long").parquet(src).select(F.to_json(F.struct("id")).alias("doc"), F.col("id").cast("string").alias("key"))
    if source is None:
        return bulk.start_bulk_docs(s, Settings(), ckpt, transport="file", path=out, id_col="key", reject='"id":7}')
    spark.dataSource.register(source)
    opts = bulk._options(Settings(), {"transport": "file", "path": out, "id_col": "key", "reject": '"id":7}'})
    return s.writeStream.format("bulkdocs").options(**opts).option("checkpointLocation", ckpt).trigger(availableNow=True).start()


def _ids(path):
    return sorted(json.loads(x)["id"] for f in glob.glob(path) for x in open(f) if '"index"' not in x)


def test_killed_and_restarted_stream_gives_each_document_once(spark, tmp_path):
    import pytest
    from eventlake.sinks import bulk

    class CutOff(bulk.BulkDocsStreamWriter):
        """Dies in the commit, after the first file was moved."""

        def commit(self, messages, batchId):
            for m in messages:
                for where, staged, name in m.files[:1]:
                    bulk.Folder(self.o[where]).move(staged, f"epoch={batchId}/{name}")
            raise OSError("cut off")

    class Source(bulk.BulkDocsDataSource):
        def streamWriter(self, schema, overwrite):
            return CutOff(dict(self.options))

    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    spark.range(0, 30).repartition(3).write.parquet(src)
    q = _stream_docs(spark, src, out, ckpt, Source)
    with pytest.raises(Exception):
        q.awaitTermination()
    assert _ids(out + "/epoch=0/*.ndjson")  # some files of the epoch are there
    _stream_docs(spark, src, out, ckpt).awaitTermination()
    want = [i for i in range(30) if i != 7]
    assert _ids(out + "/*/*.ndjson") == want
    spark.range(30, 40).write.mode("append").parquet(src)
    _stream_docs(spark, src, out, ckpt).awaitTermination()
    assert _ids(out + "/*/*.ndjson") == [*want, *range(30, 40)]
    dead = [json.loads(x)["doc_id"] for f in glob.glob(out + "_dead/*/*.jsonl") for x in open(f)]
    assert dead == ["7"] and not glob.glob(out + "/_staging/*") + glob.glob(out + "_dead/_staging/*/*")


def test_replayed_epoch_is_recorded_once(tmp_path):
    import pyarrow as pa
    from eventlake.sinks import bulk
    o = {"path": str(tmp_path / "o"), "dead_letter_path": str(tmp_path / "d")}
    rows = pa.RecordBatch.from_pydict({"doc": ['{"id":1}', '{"id":2}']})
    for _ in range(2):  # the same epoch, written twice
        w = bulk.BulkDocsStreamWriter(o)
        w.commit([w.write(iter([rows]))], 4)
    w.abort([w.write(iter([rows]))], 5)
    assert _ids(o["path"] + "/*/*.ndjson") == [1, 2] and not glob.glob(o["path"] + "/_staging/*")


def test_byte_limit_cuts_batches(spark):
    import numpy as np
    from eventlake.sinks.bulk import cut_points
    lens = np.array([10, 10, 25, 1, 40, 3, 3, 3])
    assert [len(b) for b, _ in iter_batches(iter([("x" * n, None) for n in lens]), 3, 30)] == [3, 2, 3]
    assert cut_points(lens, 3, 30) == [3, 5, 8]
    assert cut_points(lens, 100, 1000) == []
    docs = spark.range(100).select(F.lit("y" * 50).alias("doc")).coalesce(1)
    got = bulk_batches(docs, max_docs=1000, max_bytes=500).orderBy("batch_no").collect()
    assert [(r.batch_no, r.n_docs, r.doc_bytes) for r in got] == [(k, 10, 500) for k in range(10)]
