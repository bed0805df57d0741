"""Bulk document index sink.

Documents (JSON strings) are sent in bulk requests. Each Spark task batches
its own partition: a batch is flushed when it holds ``max_docs`` documents or
``max_bytes`` bytes of documents (checked after adding, so a batch may exceed
the byte limit by its last document); the remainder is flushed at the end of
the partition. A response with ``errors: true`` and any item status 429 is
retried with exponential back-off (``max_attempts`` tries within
``max_retry_ms``); the whole body is re-sent, so documents should carry a
deterministic ``_id`` (``id_col``) to make retries idempotent. Items failing
with other statuses are reported, not lost: the writer writes them as
dead-letter JSON lines.

Transports: ``file`` (one NDJSON body per batch, named by partition and batch
number; staged per task attempt and moved when the write commits) and
``http`` (POST ``<url>/<index>/_bulk``). No server is started by this module.
``write_bulk_docs`` is the batch sink, ``start_bulk_docs`` the streaming one.
"""

from __future__ import annotations

import json
import time
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter

from eventlake.functions.shipping import ship_by_value
from eventlake.session import clear_own, hadoop_path
from eventlake.sinks.staged import STAGING, Epochs, Folder, Staged, attempt_id, clear_attempts

# Functions of this module run inside Python workers: pickle them by value
# so executors need no installed copy of the package.
ship_by_value(__name__)

# Fixed value: the bulk action line preceding every document.
INDEX_ACTION = '{ "index" : {} }'
MARKER = "_bulkdocs"


def action_line(doc_id: str | None) -> str:
    if doc_id is None:
        return INDEX_ACTION
    return json.dumps({"index": {"_id": doc_id}}, separators=(",", ":"))


def iter_batches(docs: Iterator[tuple[str, str | None]], max_docs: int, max_bytes: int):
    """Yield lists of (doc, id) per flush, with the count/byte rule."""
    batch, size = [], 0
    for doc, doc_id in docs:
        batch.append((doc, doc_id))
        size += len(doc.encode("utf-8"))
        if len(batch) >= max_docs or size >= max_bytes:
            yield batch, size
            batch, size = [], 0
    if batch:
        yield batch, size


def body_of(batch) -> str:
    return "".join(f"{action_line(i)}\n{d}\n" for d, i in batch)


# ------------------------------------------------------------------ planning


def cut_points(lens: np.ndarray, max_docs: int, max_bytes: int) -> list[int]:
    """Ends of the full batches in a run of document lengths: a batch ends with the
    document that brings it to ``max_docs`` documents or ``max_bytes`` bytes. One
    search in the running sum per batch."""
    sums, ends, at = np.cumsum(lens), [], 0
    while True:
        before = int(sums[at - 1]) if at else 0
        end = min(at + max_docs, int(np.searchsorted(sums, before + max_bytes)) + 1)
        if end > len(lens):
            return ends
        ends.append(end)
        at = end


def bulk_batches(docs: DataFrame, doc_col: str = "doc", max_docs: int = 1000,
                 max_bytes: int = 5 * 1024 * 1024, id_col: str | None = None,
                 with_body: bool = False) -> DataFrame:
    """The bulk requests each partition would send: one row per batch with
    ``partition_id, batch_no, n_docs, doc_bytes, body_bytes`` (and ``body``).

    Without ``with_body`` only the UTF-8 byte lengths (computed JVM-side with
    ``octet_length``) cross into Python, not the documents."""
    if with_body:
        cols = [F.col(doc_col)] + ([F.col(id_col)] if id_col else [])
    else:
        cols = [F.octet_length(F.col(doc_col)).alias("_len")]
        if id_col:
            cols.append(F.octet_length(F.to_json(F.struct(F.struct(F.col(id_col).alias("_id"))
                                                          .alias("index")))).alias("_alen"))
    schema = ("partition_id int, batch_no int, n_docs long, doc_bytes long, body_bytes long"
              + (", body string" if with_body else ""))
    plain_action = len(INDEX_ACTION.encode("utf-8"))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        no = 0

        def frame(recs):
            nonlocal no
            out = [{"partition_id": pid, "batch_no": no + k, "n_docs": n, "doc_bytes": size, "body_bytes": total,
                    **({"body": body} if with_body else {})} for k, (n, size, total, body) in enumerate(recs)]
            no += len(out)
            return pd.DataFrame(out)

        if with_body:
            def rows():
                for pdf in it:
                    ids = pdf[id_col] if id_col else [None] * len(pdf)
                    yield from zip(pdf[doc_col], ids)
            for batch, size in iter_batches(rows(), max_docs, max_bytes):
                body = body_of(batch)
                yield frame([(len(batch), size, len(body.encode("utf-8")), body)])
        else:
            left_len, left_all = np.empty(0, np.int64), np.empty(0, np.int64)
            for pdf in it:
                lens = np.concatenate([left_len, pdf["_len"].to_numpy(np.int64)])
                extra = pdf["_alen"].to_numpy(np.int64) if id_col else np.full(len(pdf), plain_action, np.int64)
                total = np.concatenate([left_all, pdf["_len"].to_numpy(np.int64) + extra + 2])
                ends = cut_points(lens, max_docs, max_bytes)
                if ends:
                    starts = [0, *ends[:-1]]
                    yield frame([(e - s, int(lens[s:e].sum()), int(total[s:e].sum()), None) for s, e in zip(starts, ends)])
                    lens, total = lens[ends[-1]:], total[ends[-1]:]
                left_len, left_all = lens, total
            if len(left_len):
                yield frame([(len(left_len), int(left_len.sum()), int(left_all.sum()), None)])

    return docs.select(*cols).mapInPandas(run, schema)


# ------------------------------------------------------------- item errors

BULK_RESPONSE = ("struct<took:long, errors:boolean, items:array<struct<index:struct<"
                 "_index:string, _id:string, status:int, error:struct<type:string, reason:string, caused_by:struct<type:string, reason:string>>>>>>")


# a line of the writer's dead letters
BULK_DEAD_LETTER = ("batch string, item_pos int, doc_id string, status int, error_type string, error_reason string, "
                    "caused_by string, doc string")


def bulk_item_errors(responses: DataFrame, response_col: str = "response") -> DataFrame:
    """Parse bulk responses; one row per failed item (status >= 300) with its
    position in the request, id, status, error type and reason."""
    r = responses.withColumn("_r", F.from_json(F.col(response_col), BULK_RESPONSE))
    keep = [c for c in responses.columns if c != response_col]
    items = r.select(*keep, F.posexplode("_r.items").alias("item_pos", "item"))
    return (items.filter(F.col("item.index.status") >= 300)
            .select(*keep, "item_pos", F.col("item.index._id").alias("doc_id"),
                    F.col("item.index.status").alias("status"),
                    F.col("item.index.error.type").alias("error_type"),
                    F.col("item.index.error.reason").alias("error_reason")))


# ------------------------------------------------------------------ writer


def _retry_needed(resp: dict) -> bool:
    return bool(resp.get("errors")) and any(
        (it.get("index") or {}).get("status") == 429 for it in resp.get("items", []))


class _FileTransport:
    """Bodies as files of a task attempt, moved to their place when the write commits. ``reject``
    (text) makes it strict like an index mapping: a document that holds the text is answered with
    status 400 and not written."""

    def __init__(self, path: str, staged: Staged, reject: str | None = None):
        self.folder, self.staged, self.reject = Folder(path), staged, reject

    def post(self, body: str, name: str) -> dict:
        lines = body.split("\n")  # JSON escapes line feeds, but not the other line separators
        items, kept = [], []
        for action, doc in zip(lines[0::2], lines[1::2]):
            item = {"_id": json.loads(action)["index"].get("_id"), "status": 201}
            if self.reject is not None and self.reject in doc:
                item |= {"status": 400, "error": {"type": "mapper_parsing_exception", "reason": "document holds " + self.reject}}
            else:
                kept += [action, doc]
            items.append({"index": item})
        if kept:
            at = f"{STAGING}/{self.staged.attempt}/{name}.ndjson"
            self.folder.write(at, ("\n".join(kept) + "\n").encode())
            self.staged.files.append(("path", at, name + ".ndjson"))
        return {"took": 0, "errors": any(i["index"]["status"] >= 300 for i in items), "items": items}


class _HttpTransport:
    def __init__(self, url: str, index: str, user: str | None, password: str | None, timeout: float):
        self.endpoint = f"{url.rstrip('/')}/{index}/_bulk"
        self.auth = None
        if user is not None:
            import base64
            self.auth = "Basic " + base64.b64encode(f"{user}:{password or ''}".encode()).decode()
        self.timeout = timeout

    def post(self, body: str, name: str) -> dict:
        import urllib.request
        req = urllib.request.Request(self.endpoint, data=body.encode("utf-8"), method="POST",
                                     headers={"Content-Type": "application/x-ndjson"})
        if self.auth:
            req.add_header("Authorization", self.auth)
        with urllib.request.urlopen(req, timeout=self.timeout) as resp:  # noqa: S310 - user-configured endpoint
            return json.loads(resp.read().decode("utf-8"))


class _Bulk:
    """Requests are sent by the tasks as they go, each with retries. What lands in files (the
    ``file`` transport's bodies, and dead letters with either transport) is staged per attempt and
    moved by the commit; an index gets a replayed document again under the same id."""

    def __init__(self, options: dict):
        self.o = options

    def _transport(self, staged: Staged):
        o = self.o
        if o.get("transport", "file") == "file":
            return _FileTransport(o["path"], staged, o.get("reject"))
        return _HttpTransport(o["url"], o["index"], o.get("user"), o.get("password"),
                              float(o.get("timeout_s", "30")))

    def write(self, iterator):
        from pyspark import TaskContext
        o = self.o
        pid = TaskContext.get().partitionId() if TaskContext.get() else 0
        doc_col, id_col = o.get("doc_col", "doc"), o.get("id_col")
        max_docs, max_bytes = int(o.get("max_docs", "1000")), int(o.get("max_bytes", str(5 << 20)))
        attempts = int(o.get("max_attempts", "6"))
        max_retry_ms = int(o.get("max_retry_ms", "60000"))
        backoff_ms = int(o.get("initial_backoff_ms", "5000"))
        staged = Staged(attempt_id(), counts=dict.fromkeys(("batches", "docs", "failed", "retries"), 0))
        transport, dead_folder = self._transport(staged), Folder(o["dead_letter_path"])

        def rows():
            for rb in iterator:
                d = rb.column(rb.schema.get_field_index(doc_col)).to_pylist()
                ids = rb.column(rb.schema.get_field_index(id_col)).to_pylist() if id_col else [None] * len(d)
                yield from zip(d, ids)

        for no, (batch, _) in enumerate(iter_batches(rows(), max_docs, max_bytes)):
            body = body_of(batch)
            name = f"part-{pid:05d}-batch-{no:06d}"
            start, wait, resp = time.monotonic(), backoff_ms, None
            for attempt in range(attempts):
                resp = transport.post(body, name)
                if not _retry_needed(resp):
                    break
                elapsed = (time.monotonic() - start) * 1000
                if attempt == attempts - 1 or elapsed + wait > max_retry_ms:
                    raise OSError(f"bulk batch {name}: still throttled after {attempt + 1} attempts")
                staged.counts["retries"] += 1
                time.sleep(wait / 1000)
                wait *= 2
            dead = []  # the rejects of one request at most
            for pos, it in enumerate(resp.get("items", [])):
                item = it.get("index") or {}
                if item.get("status", 0) >= 300:
                    error = item.get("error") or {}
                    dead.append(json.dumps({"batch": name, "item_pos": pos, "doc_id": item.get("_id"), "status": item["status"],
                                            "error_type": error.get("type"), "error_reason": error.get("reason"),
                                            "caused_by": (error.get("caused_by") or {}).get("reason"),
                                            "doc": batch[pos][0] if pos < len(batch) else None}))
            if dead:
                at = f"{STAGING}/{staged.attempt}/{name}.jsonl"
                dead_folder.write(at, ("\n".join(dead) + "\n").encode())
                staged.files.append(("dead_letter_path", at, name + ".jsonl"))
            staged.counts["failed"] += len(dead)
            staged.counts["batches"] += 1
            staged.counts["docs"] += len(batch)
        # a request sent again within the retries staged its file again under the same name
        staged.files = list(dict.fromkeys(staged.files))
        return staged

    def _folders(self) -> list[Folder]:
        return [Folder(self.o[x]) for x in ("dead_letter_path", "path") if self.o.get(x)]

    def _move(self, messages, under: str = "") -> None:
        folders = {x: Folder(self.o[x]) for x in ("path", "dead_letter_path") if self.o.get(x)}
        for m in messages:
            for where, staged, name in m.files if m is not None else ():
                folders[where].move(staged, under + name)

    def _clear(self, messages) -> None:
        for f in self._folders():
            clear_attempts(f, messages)


class BulkDocsWriter(_Bulk, DataSourceArrowWriter):
    def commit(self, messages):
        self._move(messages)
        self._clear(messages)

    def abort(self, messages):
        self._clear(messages)


class BulkDocsStreamWriter(_Bulk, DataSourceStreamArrowWriter):
    """An epoch's files land under ``epoch=<batch>``, its record comes last (in the folder of dead letters)."""

    def commit(self, messages, batchId):
        epochs = Epochs(Folder(self.o["dead_letter_path"]))
        if not epochs.done(batchId):
            if self.o.get("path"):
                Folder(self.o["path"]).clear(f"epoch={batchId}")  # of a commit that was cut off
            Folder(self.o["dead_letter_path"]).clear(f"epoch={batchId}")
            self._move(messages, f"epoch={batchId}/")
            total = {k: sum(m.counts[k] for m in messages if m is not None) for k in ("batches", "docs", "failed", "retries")}
            epochs.record(batchId, total)
        self._clear(messages)

    def abort(self, messages, batchId):
        self._clear(messages)


class BulkDocsDataSource(DataSource):
    """``df.write.format("bulkdocs").option("transport", "file").option("path", ...)``, and the same as a stream."""

    @classmethod
    def name(cls):
        return "bulkdocs"

    def schema(self):
        return "doc string"

    def writer(self, schema, overwrite):
        return BulkDocsWriter(dict(self.options))

    def streamWriter(self, schema, overwrite):
        return BulkDocsStreamWriter(dict(self.options))


def register(spark) -> None:
    spark.dataSource.register(BulkDocsDataSource)


def _options(settings, options: dict) -> dict[str, str]:
    """Options of the sink as text: the settings' limits, and the dead-letter folder (``<path>_dead`` unless given)."""
    if options.get("path") and not options.get("dead_letter_path"):
        options["dead_letter_path"] = options["path"].rstrip("/") + "_dead"
    if not options.get("dead_letter_path"):
        raise ValueError("dead_letter_path is required: rejected documents must land somewhere")
    opts = {"max_docs": settings.bulk_max_docs, "max_bytes": settings.bulk_max_bytes,
            "max_attempts": settings.bulk_max_attempts, "max_retry_ms": settings.bulk_max_retry_ms,
            "initial_backoff_ms": settings.bulk_initial_backoff_ms, **options}
    return {k: str(v) for k, v in opts.items() if v is not None}


def write_bulk_docs(docs: DataFrame, settings, **options) -> None:
    """Send documents through the bulk sink with the settings' batch and
    retry limits (options: transport, path | url+index, id_col, ...). Rejected
    documents go to ``dead_letter_path`` (``<path>_dead`` unless given; required
    without a path). A folder that an earlier write of this sink made is emptied first;
    one with anything else in it is an error. Paths without a scheme are on the default file system."""
    register(docs.sparkSession)
    opts = _options(settings, options)
    for name in ("path", "dead_letter_path"):
        if opts.get(name):
            opts[name] = clear_own(docs.sparkSession, opts[name], MARKER)
    docs.write.format("bulkdocs").mode("append").options(**opts).save()


def start_bulk_docs(docs: DataFrame, settings, checkpoint: str, trigger: dict | None = None, **options):
    """A stream of documents through the bulk sink: files land per epoch and once, whatever is
    killed and restarted; an index is idempotent by ``id_col``."""
    register(docs.sparkSession)
    opts = _options(settings, options)
    for name in ("path", "dead_letter_path"):
        if opts.get(name):
            p, fs = hadoop_path(docs.sparkSession, opts[name])
            fs.mkdirs(p)
            opts[name] = p.toString()
    w = docs.writeStream.format("bulkdocs").options(**opts).option("checkpointLocation", checkpoint).outputMode("append")
    return w.trigger(**(trigger or {"availableNow": True})).start()
