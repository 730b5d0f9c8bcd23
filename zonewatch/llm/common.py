"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewatch.session import checkpoint_dir, settings

SPACE = b" \t\n\r\x0b\x0c"  # what bytes.split() splits on: \x20 and \x09-\x0D
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder, removed when the driver's JVM ends."""
    base = checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return str(fs.makeQualified(hadoop_path).toString())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``run_folder`` that nothing reads any more, before the driver ends."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage
    in storage that outlives executors, and computes ``df`` once.  What was shuffled for it is
    removed once it is written, not when the driver next collects garbage."""
    path = f"{folder}/{name}"
    with settings(df.sparkSession, **{CLEANUP: "true"}):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a file in the shared folder, usable inside tasks."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), os.path.abspath(uri)
    return pafs.FileSystem.from_uri(uri)


def put_file(uri: str, data: bytes) -> None:
    """Write a file whole: a reader sees all of it or nothing, also after a lost task."""
    fs, path = store(uri)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as out:
        out.write(data)
    fs.move(part, path)


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and nothing else changed; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def without(docs: DataFrame, rejected: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose ``key``, one a row, is no doc_id of ``rejected``."""
    gone = rejected.select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs[key] == gone["_gone"], "left_anti")


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as bytes, null as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes (or one row), so that what is derived from
    a batch stays small however long its texts are."""
    at = 0
    while at < len(texts):
        to, held = at + 1, len(texts[at])
        while to < len(texts) and held + len(texts[to]) <= most:
            held += len(texts[to])
            to += 1
        yield at, to
        at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64); bijective."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of every run of ``width`` neighbouring ids."""
    n = len(ids) - width + 1
    h = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        with np.errstate(over="ignore"):
            for k in range(width):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + ids[k:k + n])
    return h


class Words(dict):
    """Cache from a key to a computed value, bounded to two generations of ``most`` keys: a
    full one is set aside, and what is still asked for comes back from it.  Keys of more
    than ``longest`` characters are computed each time."""

    def __init__(self, make, most: int = 250_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key):
        if type(key) in (bytes, str) and len(key) > self.longest:
            return self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value
