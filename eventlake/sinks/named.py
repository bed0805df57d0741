"""Windowed text files under the names of a shard template: exactly ``num_shards`` files
per window and pane, in the directory that the window's end gives, committed in two
phases.

The rows are dealt out by (window, shard), so a file is written by one task, and a hot window
by as many tasks as it has shards. Names are made by the driver's commit: shards without rows
become empty files there, and a pane without a number of its own gets the next
one of its window. Needs ``win_start_ms`` and ``win_end_ms``: a write without windows is an
error."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter

from eventlake.functions.shipping import ship_by_value
from eventlake.functions.time import pane_file_str
from eventlake.session import hadoop_path
from eventlake.settings import Settings
from eventlake.sinks.staged import COMMITS, STAGING, Epochs, Folder, Staged, attempt_id, clear_attempts

ship_by_value(__name__)

OPEN = 64  # files that a task holds open
COLUMNS = ("line", "win_start_ms", "win_end_ms", "pane", "shard")


def instant(ms: int) -> str:
    t = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=ms)
    return t.strftime("%Y-%m-%dT%H:%M:%S.") + f"{ms % 1000:03d}Z"


def file_name(o: dict, start: int, end: int, pane: str, shard: int) -> str:
    """Directory from the window's end, prefix, the template's ``W P S N`` filled in, suffix."""
    t = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=end)
    folder = o["directory"]
    for token, part in (("YYYY", f"{t.year:04d}"), ("MM", f"{t.month:02d}"), ("DD", f"{t.day:02d}"), ("HH", f"{t.hour:02d}")):
        folder = folder.replace(token, part)
    fill = {"W": lambda x: f"{instant(start)}-{instant(end)}", "P": lambda x: pane,
            "S": lambda x: str(shard).zfill(len(x)), "N": lambda x: o["num_shards"].zfill(len(x))}
    name = re.sub("S+|N+|P|W", lambda m: fill[m.group()[0]](m.group()), o["template"])
    return folder + o["prefix"] + name + o["suffix"]


class _Named:
    """The two phases, shared by batch and stream."""

    def __init__(self, options: dict, schema):
        self.o = options
        missing = [c for c in COLUMNS if c not in schema.fieldNames()]
        if missing:
            raise ValueError(f"named files are written per window; missing: {', '.join(missing)}")

    def write(self, iterator):
        folder, out, opened = Folder(self.o["path"]), Staged(attempt_id()), {}
        try:
            for batch in iterator:
                lines: dict[tuple, list[str]] = {}
                for line, *of in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in COLUMNS]):
                    lines.setdefault(tuple(of), []).append(line or "")
                for of, text in lines.items():
                    if of not in opened:
                        if len(opened) >= OPEN:  # the longest open file is closed; further rows of it make a second part
                            opened.pop(next(iter(opened))).close()
                        staged = f"{STAGING}/{out.attempt}/{len(out.files)}"
                        opened[of] = folder.open(staged)
                        out.files.append((staged, *of))
                    opened[of].write(("\n".join(text) + "\n").encode())
                    out.counts[of] = out.counts.get(of, 0) + len(text)
        finally:
            for f in opened.values():
                f.close()
        return out

    def _commit(self, messages, epoch: int) -> None:
        folder = Folder(self.o["path"])
        epochs = Epochs(folder)
        if not epochs.done(epoch):
            files = [f for m in messages if m is not None for f in m.files]
            panes = {tuple(f[1:4]) for f in files}
            earlier = [tuple(w) for r in epochs.before(epoch) for w in r["windows"]]
            number = {w: sum(e[0] == w[0] for e in earlier) for w in panes if w[2] is None}
            text = {w: f"pane-{number[w]}" if w[2] is None else w[2] for w in panes}
            parts: dict[tuple, list[str]] = {}
            for f in files:
                parts.setdefault((tuple(f[1:4]), f[4]), []).append(f[0])
            named = []
            for w in sorted(panes, key=str):
                for shard in range(int(self.o["num_shards"])):
                    name = file_name(self.o, w[0], w[1], text[w], shard)
                    named.append({"path": name, "n_lines": sum(m.counts.get((*w, shard), 0) for m in messages if m is not None)})
                    # a replay of a commit that was cut off finds the name taken, and replaces it
                    folder.gather(parts.get((w, shard), []), name)
            epochs.record(epoch, {"windows": sorted([w[0], w[1], text[w]] for w in panes), "files": named})
        clear_attempts(folder, messages)

    def _abort(self, messages) -> None:
        clear_attempts(Folder(self.o["path"]), messages)


class NamedFilesWriter(_Named, DataSourceArrowWriter):
    """A batch write is an epoch after all earlier ones."""

    def commit(self, messages):
        done = Folder(self.o["path"]).names("_commits")
        self._commit(messages, int(done[-1][:12]) + 1 if done else 0)

    def abort(self, messages):
        self._abort(messages)


class NamedFilesStreamWriter(_Named, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId):
        self._commit(messages, batchId)

    def abort(self, messages, batchId):
        self._abort(messages)


class NamedFilesDataSource(DataSource):
    @classmethod
    def name(cls):
        return "namedfiles"

    def schema(self):
        return "line string, win_start_ms long, win_end_ms long, pane string, shard int"

    def writer(self, schema, overwrite):
        return NamedFilesWriter(dict(self.options), schema)

    def streamWriter(self, schema, overwrite):
        return NamedFilesStreamWriter(dict(self.options), schema)


def named_lines(df: DataFrame, settings: Settings = Settings(), text_col: str = "line",
                shard: Column | None = None) -> DataFrame:
    """Lines with window, pane text (null: numbered at commit) and shard (a hash of the line
    unless given), each file's rows together in one task."""
    for c in ("win_start_ms", "win_end_ms"):
        if c not in df.columns:
            raise ValueError(f"named files are written per window; missing: {c}")
    known = {"pane_idx", "is_last", "timing"} <= set(df.columns)
    pane = pane_file_str(F.col("pane_idx"), F.col("is_last"), F.col("timing")) if known else F.lit(None).cast("string")
    at = shard if shard is not None else F.xxhash64(text_col)
    return df.select(F.col(text_col).cast("string").alias("line"), F.col("win_start_ms").cast("long").alias("win_start_ms"),
                     F.col("win_end_ms").cast("long").alias("win_end_ms"), pane.alias("pane"),
                     F.pmod(at, F.lit(settings.num_shards)).cast("int").alias("shard")).repartition("win_start_ms", "pane", "shard")


def _options(root: str, settings: Settings, directory: str, suffix: str | None) -> dict[str, str]:
    return {"path": root, "directory": directory, "prefix": settings.filename_prefix, "template": settings.shard_template,
            "suffix": settings.csv_suffix if suffix is None else suffix, "num_shards": str(settings.num_shards)}


def committed_files(spark: SparkSession, root: str) -> DataFrame:
    """path (under ``root``) and n_lines of every file, from the records of the commits."""
    p, fs = hadoop_path(spark, f"{root}/{COMMITS}")
    schema = "files array<struct<path:string,n_lines:long>>"
    if not fs.exists(p):
        return spark.createDataFrame([], "path string, n_lines long")
    return spark.read.schema(schema).json(f"{root}/{COMMITS}/*.json").select(F.explode("files").alias("f")).select("f.*")


def write_named_files(df: DataFrame, root: str, settings: Settings = Settings(), text_col: str = "line",
                      shard: Column | None = None, directory: str = "YYYY/MM/DD/HH/", suffix: str | None = None) -> None:
    """Append the lines of ``df`` as named files under ``root``."""
    df.sparkSession.dataSource.register(NamedFilesDataSource)
    (named_lines(df, settings, text_col, shard).write.format("namedfiles")
     .options(**_options(root, settings, directory, suffix)).mode("append").save())


def start_named_files(df: DataFrame, root: str, checkpoint: str, settings: Settings = Settings(), text_col: str = "line",
                      shard: Column | None = None, directory: str = "YYYY/MM/DD/HH/", suffix: str | None = None,
                      trigger: dict | None = None):
    """The lines of a stream as named files; a replayed micro-batch counts once."""
    df.sparkSession.dataSource.register(NamedFilesDataSource)
    w = (named_lines(df, settings, text_col, shard).writeStream.format("namedfiles")
         .options(**_options(root, settings, directory, suffix)).option("checkpointLocation", checkpoint).outputMode("append"))
    return w.trigger(**(trigger or {"availableNow": True})).start()
