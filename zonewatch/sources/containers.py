"""Frame containers (A5): files that hold many frames, read by byte range.

One file a frame costs a file system call and a listing entry a frame.  A container is
the frames' bytes one after the other, then an index (place, length and name of
each frame), then the index's place and ``MAGIC``.  The writer makes one container a
task; a job becomes visible as a whole when its list of files is written to ``_log``.
A reader's partitions are byte ranges of the files: a range holds the frames that begin in it,
so partitions grow with the bytes, whatever the number of files or frames.  As a
stream the offset is the number of jobs read.

Formats of Spark's Python data source API: ``register(spark)``, then
``df.write.format("frame_container")`` (columns name string, content binary) and
``spark.read`` / ``spark.readStream.format("frame_container").load(folder)``
(path, name, length, content).  Options: ``range_bytes``, ``jobs_per_batch``.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, DataSourceArrowWriter, InputPartition, WriterCommitMessage)

MAGIC = b"FRMPACK1"
FORMAT = "frame_container"
RANGE_BYTES = 32 << 20
BATCH_BYTES = 8 << 20  # of an Arrow batch handed to Spark
LOG = "_log"
SCHEMA = "path string, name string, length long, content binary"
_TAIL = struct.Struct("<QQQ")  # place and length of the index, number of frames
_TAIL_BYTES = _TAIL.size + len(MAGIC)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


class ContainerWriter:
    """Frames into one container file; nothing but the index is held."""

    def __init__(self, out):
        self.out, self.at = out, 0
        self.starts: list[int] = []
        self.lengths: list[int] = []
        self.names: list[str] = []

    def add(self, name: str, content: bytes) -> None:
        self.out.write(content)
        self.starts.append(self.at)
        self.lengths.append(len(content))
        self.names.append(name)
        self.at += len(content)

    def close(self) -> int:
        """Write the index; the bytes of the file."""
        sink = pa.BufferOutputStream()
        table = pa.table({"start": pa.array(self.starts, pa.int64()), "length": pa.array(self.lengths, pa.int64()),
                          "name": pa.array(self.names, pa.string())})
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        index = sink.getvalue().to_pybytes()
        self.out.write(index + _TAIL.pack(self.at, len(index), len(self.names)) + MAGIC)
        return self.at + len(index) + _TAIL_BYTES


def read_index(file, size: int) -> pa.Table:
    """start, length, name of the frames of an open container of ``size`` bytes."""
    file.seek(max(size - _TAIL_BYTES, 0))
    tail = file.read()
    if len(tail) != _TAIL_BYTES or tail[_TAIL.size:] != MAGIC:
        raise ValueError("not a frame container")
    at, length, _ = _TAIL.unpack(tail[:_TAIL.size])
    file.seek(at)
    return pa.ipc.open_stream(file.read(length)).read_all()


@dataclass
class ByteRange(InputPartition):
    path: str
    size: int
    start: int
    end: int


def byte_ranges(files: list[tuple[str, int]], range_bytes: int) -> list[ByteRange]:
    return [ByteRange(path, size, at, min(at + range_bytes, size)) for path, size in files for at in range(0, size, range_bytes)]


def read_range(part: ByteRange) -> Iterator[pa.RecordBatch]:
    """The frames that begin in the range, in batches of about ``BATCH_BYTES``."""
    fs, path = file_system(part.path)
    with fs.open_input_file(path) as file:
        index = read_index(file, part.size)
        start, length = index.column("start").to_numpy(), index.column("length").to_numpy()
        names = index.column("name")
        # frames without bytes share their start with the next one; a start belongs to one range only
        at, last = (int(x) for x in np.searchsorted(start, [part.start, part.end]))
        while at < last:
            to = max(at + 1, int(np.searchsorted(start, start[at] + BATCH_BYTES, "right")) - 1)
            to = min(max(to, at + 1), last)
            file.seek(int(start[at]))
            held = file.read(int(start[to - 1] + length[to - 1] - start[at]))
            contents = [held[s:s + n] for s, n in zip((start[at:to] - start[at]).tolist(), length[at:to].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.path] * (to - at), pa.string()), names.slice(at, to - at).combine_chunks().cast(pa.string()),
                 pa.array(length[at:to], pa.int64()), pa.array(contents, pa.binary())], names=["path", "name", "length", "content"])
            at = to


def jobs(folder: str) -> list[str]:
    """The written jobs of a folder, in order."""
    fs, path = file_system(f"{folder}/{LOG}")
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted(f"{folder}/{LOG}/{f.base_name}" for f in found if f.base_name.endswith(".json"))


def files_of(job: str) -> list[tuple[str, int]]:
    fs, path = file_system(job)
    with fs.open_input_file(path) as file:
        return [(path, size) for path, size in json.loads(file.read())]


class _Reader(DataSourceReader):
    def __init__(self, folder: str, range_bytes: int):
        self.folder, self.range_bytes = folder, range_bytes

    def partitions(self) -> list[InputPartition]:
        return byte_ranges([f for job in jobs(self.folder) for f in files_of(job)], self.range_bytes) or [ByteRange("", 0, 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        return read_range(partition) if partition.path else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, folder: str, range_bytes: int, jobs_per_batch: int | None):
        self.folder, self.range_bytes, self.most = folder, range_bytes, jobs_per_batch
        self.told: int | None = None

    def initialOffset(self) -> dict:
        return {"jobs": 0}

    def latestOffset(self, *args) -> dict:
        """All jobs there are, or ``jobs_per_batch`` more than the offset given before."""
        there = len(jobs(self.folder))
        if self.most is not None:
            before = args[0]["jobs"] if args and args[0] else (self.told or 0)
            there = min(there, before + self.most)
        self.told = there
        return {"jobs": there}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        files = [f for job in jobs(self.folder)[start["jobs"]:end["jobs"]] for f in files_of(job)]
        return byte_ranges(files, self.range_bytes) or [ByteRange("", 0, 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        return read_range(partition) if partition.path else iter(())

    def commit(self, end: dict) -> None:
        pass


@dataclass
class _Written(WriterCommitMessage):
    path: str | None
    size: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, names: list[str]):
        self.folder, self.names = folder, names

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        name = f"{self.folder}/frames-{uuid.uuid4().hex}.bin"  # a lost task's file is in no log
        fs, path = file_system(name)
        writer = None
        for batch in iterator:
            for frame, content in zip(batch.column(self.names.index("name")).to_pylist(),
                                      batch.column(self.names.index("content")).to_pylist(), strict=True):
                if writer is None:
                    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    writer = ContainerWriter(fs.open_output_stream(path))
                writer.add(frame or "", content or b"")
        if writer is None:
            return _Written(None, 0)
        size = writer.close()
        writer.out.close()
        return _Written(name, size)

    def commit(self, messages: list[_Written]) -> None:
        fs, path = file_system(f"{self.folder}/{LOG}")
        fs.create_dir(path, recursive=True)
        held = json.dumps([(m.path, m.size) for m in messages if m is not None and m.path])
        number = len(jobs(self.folder))
        part = f"{path}/{uuid.uuid4().hex}.part"
        with fs.open_output_stream(part) as out:
            out.write(held.encode())
        fs.move(part, f"{path}/{number:012d}.json")

    def abort(self, messages: list[_Written]) -> None:
        for m in messages:
            if m is not None and m.path:
                fs, path = file_system(m.path)
                fs.delete_file(path)


class FrameContainers(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _folder(self) -> str:
        return self.options["path"].rstrip("/")

    def _range_bytes(self) -> int:
        return int(self.options.get("range_bytes", RANGE_BYTES))

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self._folder(), self._range_bytes())

    def streamReader(self, schema) -> DataSourceStreamReader:
        most = self.options.get("jobs_per_batch")
        return _StreamReader(self._folder(), self._range_bytes(), int(most) if most else None)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("containers are appended to")
        return _Writer(self._folder(), schema.names)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FrameContainers)
