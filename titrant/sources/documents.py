"""A document for each key, as files: a Python data source that writes many documents a task and commits them together.

A task writes its documents into a folder of its own below a staging folder, and beside them one index of their keys and
file names, so its memory is that of one batch. When all tasks are done, the driver moves these folders, one a task and
not one a document, into a new snapshot and puts it in the place of the old one. If any task fails, the staging folder
goes and the old snapshot stays as it was; attempts that were lost or repeated are never moved, as only the attempts that
report to the commit are.

Reading takes the folders' indexes, one partition each, so nothing is listed document by document, and gives Arrow batches
of a bounded size; with ``keys`` only the documents named there are opened.

The folder may be anything that Arrow's file systems reach (local or mounted folders, HDFS, object stores). Keys are any
strings, none null and none twice; a null document is an empty file and comes back as an empty text.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

NAME = "documents_by_key"
SCHEMA = "key string, value string"
#: So many documents a task writes, about.
PER_TASK = 10_000
INDEX = "_keys.jsonl"
#: So many documents a batch that is read has at most; it ends sooner behind ``BATCH_BYTES``.
BATCH, BATCH_BYTES = 2_000, 8 << 20
#: Longer names are cut, and told apart by a digest.
NAME_MOST = 150


def located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def file_name(key: str) -> str:
    """The key, as far as file systems allow it."""
    plain = quote(key, safe=" ,+()")
    if plain in ("", ".", "..") or plain.startswith("_") or len(plain) > NAME_MOST:
        plain = f"{plain[:NAME_MOST].strip('._')}~{hashlib.sha256(key.encode()).hexdigest()[:32]}"
    return f"{plain}.json"


@dataclass
class Done(WriterCommitMessage):
    folder: str
    documents: int


class DocumentWriter(DataSourceArrowWriter):
    def __init__(self, path: str, columns: list[str], overwrite: bool):
        if sorted(columns) != ["key", "value"]:
            raise ValueError(f"documents have a key and a value, not {', '.join(columns)}")
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.staging = f"{self.path}.staging-{uuid.uuid4().hex}"
        system, staging = located(self.staging)
        system.create_dir(staging, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Done:
        task = TaskContext.get()
        system, staging = located(self.staging)
        folder = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        # not the staging folder itself: where that is gone, the job has failed, and a task that lingers must leave nothing
        system.create_dir(f"{staging}/{folder}", recursive=False)
        seen: set[bytes] = set()
        with system.open_output_stream(f"{staging}/{folder}/{INDEX}") as index:
            for batch in iterator:
                for key, value in zip(batch.column("key").to_pylist(), batch.column("value").to_pylist(), strict=True):
                    if key is None:
                        raise ValueError("a document without a key")
                    mark = hashlib.sha256(key.encode()).digest()
                    if mark in seen:
                        raise ValueError(f"two documents with the key {key!r}")
                    seen.add(mark)
                    name = file_name(key)
                    with system.open_output_stream(f"{staging}/{folder}/{name}") as out:
                        out.write((value or "").encode())
                    index.write(json.dumps({"key": key, "file": name}).encode() + b"\n")
        return Done(folder, len(seen))

    def commit(self, messages: list[Done | None]) -> None:
        system, path = located(self.path)
        _, staging = located(self.staging)
        fresh = f"{staging}-whole"
        system.create_dir(fresh, recursive=True)
        for m in messages:
            if m is not None:
                system.move(f"{staging}/{m.folder}", f"{fresh}/{m.folder}")
        there = system.get_file_info(path).type != fs.FileType.NotFound
        if there and not self.overwrite:
            self._dropped(fresh)
            self._dropped(staging)
            raise ValueError(f"{self.path} is there already; a snapshot is written whole, with mode 'overwrite'")
        if there:
            system.move(path, f"{staging}-old")
        system.move(fresh, path)
        self._dropped(f"{staging}-old")
        self._dropped(staging)

    def abort(self, messages: list[Done | None]) -> None:
        _, staging = located(self.staging)
        self._dropped(staging)
        self._dropped(f"{staging}-whole")

    def _dropped(self, folder: str) -> None:
        system, _ = located(self.path)
        if system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir(folder)


class Folder(InputPartition):
    def __init__(self, name: str):
        self.name = name


class DocumentReader(DataSourceReader):
    def __init__(self, path: str, keys: list[str] | None):
        self.path, self.keys = path.rstrip("/"), keys

    def partitions(self) -> list[Folder]:
        system, path = located(self.path)
        return [Folder(x.base_name) for x in system.get_file_info(fs.FileSelector(path)) if x.type == fs.FileType.Directory]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        system, path = located(self.path)
        wanted = None if self.keys is None else set(self.keys)
        keys, values, held = [], [], 0
        with system.open_input_stream(f"{path}/{partition.name}/{INDEX}") as index:
            for line in _lines(index):
                entry = json.loads(line)
                if wanted is None or entry["key"] in wanted:
                    with system.open_input_stream(f"{path}/{partition.name}/{entry['file']}") as document:
                        value = document.readall()
                    keys.append(entry["key"])
                    values.append(value)
                    held += len(value)
                    if len(keys) >= BATCH or held >= BATCH_BYTES:
                        yield _batch(keys, values)
                        keys, values, held = [], [], 0
        if keys:
            yield _batch(keys, values)


def _batch(keys: list[str], values: list[bytes]) -> pa.RecordBatch:
    # the cast fails on what isn't UTF-8
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(values, pa.binary()).cast(pa.string())], ["key", "value"])


def _lines(stream: pa.NativeFile) -> Iterator[bytes]:
    rest = b""
    while block := stream.read(1 << 20):
        *whole, rest = (rest + block).split(b"\n")
        yield from whole
    if rest:
        yield rest


class Documents(DataSource):
    """``key, value``. Options: ``path``; for reading, ``keys``, a JSON array of those wanted."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DocumentReader:
        keys = self.options.get("keys")
        return DocumentReader(self.options["path"], json.loads(keys) if keys else None)

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(self.options["path"], list(schema.names), overwrite)


def write_documents(documents: DataFrame, path: str) -> None:
    """A snapshot of ``key, value`` in the place of any earlier one, about ``PER_TASK`` documents a task; equal keys meet in one task, which fails."""
    spark = documents.sparkSession
    spark.dataSource.register(Documents)
    tasks = max(1, -(-documents.count() // PER_TASK))
    documents.select("key", F.col("value").cast("string").alias("value")).repartition(tasks, "key").write.format(NAME).mode("overwrite").save(path)


def read_documents(spark, path: str, keys: list[str] | None = None) -> DataFrame:
    spark.dataSource.register(Documents)
    reader = spark.read.format(NAME)
    return (reader if keys is None else reader.option("keys", json.dumps(keys))).load(path)
