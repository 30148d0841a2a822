"""A line sink that writes each epoch of a stream once.

Tasks stage their lines as files of names that no other attempt has. The commit of an epoch is one
file that lists them, put in place by a rename; readers see the files that commits list, and no others.
An epoch that is replayed finds its commit in place and leaves it, and its own staged files are
removed; so are those of an epoch that fails. Paths are those of pyarrow's file systems (a shared folder,
hdfs://, s3://), as the writer runs in Python on every executor.

    spark.dataSource.register(EpochLines)
    lines.writeStream.format("epoch_lines").option("path", path).option("checkpointLocation", place).start()
    committed_lines(spark, path)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

#: Lines are buffered up to so many bytes.
BUFFER = 4 << 20


@dataclass
class Staged(WriterCommitMessage):
    """What a task staged."""

    files: list[str] = field(default_factory=list)
    lines: int = 0


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class EpochLinesWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, root = _place(self.path)
        name, n, out = f"staged/{uuid.uuid4().hex}.txt", 0, None
        held, size = [], 0
        for b in iterator:
            for value in b.column("value").cast(pa.binary()).to_pylist():
                if value is None:
                    continue
                held.append(value + b"\n")
                size, n = size + len(held[-1]), n + 1
                if size >= BUFFER:
                    out = out or self._open(store, root, name)
                    out.write(b"".join(held))
                    held, size = [], 0
        if held:
            out = out or self._open(store, root, name)
            out.write(b"".join(held))
        if out is None:
            return Staged()
        out.close()
        return Staged([name], n)

    @staticmethod
    def _open(store: fs.FileSystem, root: str, name: str):
        store.create_dir(f"{root}/staged", recursive=True)
        return store.open_output_stream(f"{root}/{name}")

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        store, root = _place(self.path)
        files, lines = [f for m in messages if m for f in m.files], sum(m.lines for m in messages if m)
        done = f"{root}/commits/{batchId:012d}.json"
        if store.get_file_info(done).type == fs.FileType.File:
            self._remove(store, root, files)  # committed by an earlier attempt
            return
        store.create_dir(f"{root}/commits", recursive=True)
        fresh = f"{root}/commits/_{uuid.uuid4().hex}"
        with store.open_output_stream(fresh) as out:
            out.write(json.dumps({"epoch": batchId, "files": files, "lines": lines}).encode())
        store.move(fresh, done)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        store, root = _place(self.path)
        self._remove(store, root, [f for m in messages if m for f in m.files])

    @staticmethod
    def _remove(store: fs.FileSystem, root: str, files: list[str]) -> None:
        for f in files:
            if store.get_file_info(f"{root}/{f}").type == fs.FileType.File:
                store.delete_file(f"{root}/{f}")


class EpochLines(DataSource):
    """The sink ``epoch_lines``: option ``path``; the stream has a string column ``value``."""

    @classmethod
    def name(cls) -> str:
        return "epoch_lines"

    def schema(self) -> str:
        return "value string"

    def streamWriter(self, schema, overwrite: bool) -> EpochLinesWriter:
        if "value" not in schema.names:
            raise ValueError("epoch_lines needs a column 'value'")
        return EpochLinesWriter(self.options["path"])


def commits(path: str) -> list[dict]:
    """The commits under ``path`` in order of epochs."""
    store, root = _place(path.rstrip("/"))
    found = store.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True))
    names = sorted(i.path for i in found if i.type == fs.FileType.File and i.base_name.endswith(".json"))
    out = []
    for name in names:
        with store.open_input_stream(name) as f:
            out.append(json.loads(f.read()))
    return out


def committed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value) of all committed epochs."""
    files = [f"{path.rstrip('/')}/{f}" for c in commits(path) for f in c["files"]]
    return spark.read.text(files) if files else spark.createDataFrame([], "value string")
