"""Two-phase commit of files that data source writers make in tasks.

A task writes under ``_staging/<id of the attempt>`` and names its files in its
commit message; the driver's commit moves them to their names, and leaves a record of
the epoch last. A replayed epoch that has its record only clears what was staged again; one
that was cut off while moving moves the same names once more. Files of failed or
doubled attempts are named in no message and are cleared with their folder."""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql.datasource import WriterCommitMessage

STAGING, COMMITS = "_staging", "_commits"


class Folder:
    """A folder of any file system that pyarrow resolves (local path, hdfs://, s3://, gs://)."""

    def __init__(self, uri: str):
        from pyarrow import fs
        if uri.startswith("file:/") and not uri.startswith("file://"):  # Hadoop's form of a local URI
            uri = "file://" + uri[len("file:"):]
        self.fs, base = fs.FileSystem.from_uri(uri if "://" in uri else os.path.abspath(uri))
        self.base = base.rstrip("/")

    def at(self, name: str) -> str:
        return f"{self.base}/{name}"

    def open(self, name: str):
        self.fs.create_dir(self.at(name).rpartition("/")[0], recursive=True)
        return self.fs.open_output_stream(self.at(name))

    def write(self, name: str, data: bytes) -> None:
        with self.open(name) as f:
            f.write(data)

    def read(self, name: str) -> bytes:
        with self.fs.open_input_stream(self.at(name)) as f:
            return f.read()

    def exists(self, name: str) -> bool:
        from pyarrow import fs
        return self.fs.get_file_info(self.at(name)).type != fs.FileType.NotFound

    def names(self, folder: str) -> list[str]:
        from pyarrow import fs
        found = self.fs.get_file_info(fs.FileSelector(self.at(folder), allow_not_found=True))
        return sorted(f.base_name for f in found)

    def move(self, name: str, to: str) -> None:
        self.fs.create_dir(self.at(to).rpartition("/")[0], recursive=True)
        if self.exists(to):
            self.fs.delete_file(self.at(to))
        self.fs.move(self.at(name), self.at(to))

    def gather(self, names: list[str], to: str) -> None:
        """Make the file ``to`` of staged files: moved if it is one, copied one after another
        if they are several, empty if there is none."""
        if len(names) == 1:
            self.move(names[0], to)
            return
        with self.open(to) as out:
            for n in names:
                with self.fs.open_input_stream(self.at(n)) as f:
                    while chunk := f.read(1 << 20):
                        out.write(chunk)

    def clear(self, folder: str) -> None:
        if self.exists(folder):
            self.fs.delete_dir(self.at(folder))


@dataclass
class Staged(WriterCommitMessage):
    """Files of one task attempt: (staged name, what the sink needs to name it)."""
    attempt: str
    files: list[tuple] = field(default_factory=list)
    counts: dict = field(default_factory=dict)


def attempt_id() -> str:
    return uuid.uuid4().hex


class Epochs:
    """The records of committed epochs in a folder."""

    def __init__(self, folder: Folder):
        self.folder = folder

    def done(self, epoch: int) -> bool:
        return self.folder.exists(f"{COMMITS}/{epoch:012d}.json")

    def record(self, epoch: int, content: dict) -> None:
        """Written under another name and moved: a record is there as a whole or not at all."""
        staged = f"{STAGING}/{attempt_id()}"
        self.folder.write(staged, json.dumps(content).encode())
        self.folder.move(staged, f"{COMMITS}/{epoch:012d}.json")

    def before(self, epoch: int) -> list[dict]:
        return [json.loads(self.folder.read(f"{COMMITS}/{n}")) for n in self.folder.names(COMMITS) if int(n[:12]) < epoch]


def clear_attempts(folder: Folder, messages) -> None:
    for m in messages:
        if m is not None:
            folder.clear(f"{STAGING}/{m.attempt}")
