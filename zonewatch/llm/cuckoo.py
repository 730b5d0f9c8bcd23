"""Exact dedup (operator 6): a cuckoo-filter index of live digests.

Every text is lower-cased (A-Z only) and digested in the JVM.  Rows of one
digest are counted per salt before they move, so a text that a third of all
rows share reaches its bucket as at most ``SALTS`` rows.  Each task then holds
one bucket range of the index: a cuckoo filter of 64-bit keys in front of the
bucketed content (full digest, length, keeper, copies).  A miss in the filter
is a new text; a hit is verified against the content.  A failed insertion
doubles the filter and refills it from the stored keys.  Deletion takes a
digest out of the content and its fingerprint out of the filter.

Cases: a null text counts as empty, so null and empty texts form one group.
The largest doc_id stays; a null doc_id is smaller than any other, and a group
of null ids keeps them.  Rows that repeat both doc_id and text are one document
listed twice and get the same answer.  An empty table gives an empty result.
Extra columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.llm.common import lower_ascii

SALTS = 32
SLOTS = 4
MAX_KICKS = 200
STORED, DELETE, INSERT = 0, 1, 2

INDEX_SCHEMA = "digest binary, n_bytes long, keep_id long, copies long, salts array<int>"


class CuckooFilter:
    """Approximate set of 64-bit keys with deletion: 16-bit fingerprints, two buckets a key."""

    def __init__(self, buckets: int = 1024):
        self.mask = buckets - 1
        self.table = np.zeros(buckets * SLOTS, np.uint16).tolist()
        self.size = 0

    def _places(self, key: int) -> tuple[int, int, int]:
        mark = (key >> 48) or 1
        first = (key * 0x9E3779B97F4A7C15 >> 20) & self.mask
        return mark, first, first ^ (mark * 0x5BD1E995 & self.mask)

    def __contains__(self, key: int) -> bool:
        mark, a, b = self._places(key)
        table = self.table
        return mark in table[a * SLOTS:a * SLOTS + SLOTS] or mark in table[b * SLOTS:b * SLOTS + SLOTS]

    def insert(self, key: int) -> bool:
        """False if no place was found: then the filter must be rebuilt from its keys."""
        mark, a, b = self._places(key)
        table = self.table
        for bucket in (a, b):
            for at in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not table[at]:
                    table[at] = mark
                    self.size += 1
                    return True
        at_bucket = b
        for kick in range(MAX_KICKS):
            at = at_bucket * SLOTS + (kick * 7 + mark) % SLOTS
            mark, table[at] = table[at], mark
            at_bucket ^= mark * 0x5BD1E995 & self.mask
            for at in range(at_bucket * SLOTS, at_bucket * SLOTS + SLOTS):
                if not table[at]:
                    table[at] = mark
                    self.size += 1
                    return True
        return False

    def delete(self, key: int) -> bool:
        mark, a, b = self._places(key)
        for bucket in (a, b):
            for at in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.table[at] == mark:
                    self.table[at] = 0
                    self.size -= 1
                    return True
        return False


class DigestIndex:
    """The filter and, by key, the content that its hits are verified against."""

    def __init__(self, buckets: int = 1024):
        self.filter = CuckooFilter(buckets)
        self.content: dict[int, list[list]] = {}
        self.false_hits = self.resizes = 0

    @staticmethod
    def key(digest: bytes) -> int:
        return int.from_bytes(digest[:8], "big")

    def find(self, digest: bytes, n_bytes: int) -> list | None:
        key = self.key(digest)
        if key not in self.filter:
            return None
        for entry in self.content.get(key, ()):
            if entry[0] == digest and entry[1] == n_bytes:
                return entry
        self.false_hits += 1
        return None

    def insert(self, digest: bytes, n_bytes: int, doc_id: int | None, copies: int, salts: list[int]) -> None:
        entry = self.find(digest, n_bytes)
        if entry is None:
            key = self.key(digest)
            held = self.content.setdefault(key, [])
            held.append([digest, n_bytes, doc_id, copies, list(salts)])
            if len(held) == 1 and not self.filter.insert(key):  # one fingerprint a key
                self._resize()
            return
        if doc_id is not None and (entry[2] is None or doc_id > entry[2]):
            entry[2] = doc_id
        entry[3] += copies
        entry[4].extend(salts)

    def delete(self, digest: bytes, n_bytes: int) -> bool:
        entry = self.find(digest, n_bytes)
        if entry is None:
            return False
        key = self.key(digest)
        self.content[key].remove(entry)
        if not self.content[key]:
            del self.content[key]
            self.filter.delete(key)
        return True

    def _resize(self) -> None:
        """A filter of twice the buckets, refilled from the stored keys."""
        buckets = 2 * (self.filter.mask + 1)
        while True:
            self.resizes += 1
            grown = CuckooFilter(buckets)
            if all(grown.insert(key) for key in self.content):
                self.filter = grown
                return
            buckets *= 2

    def entries(self) -> Iterator[list]:
        for held in self.content.values():
            yield from held


def _index_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's bucket range: stored rows, then deletions, then insertions."""
    index = DigestIndex()
    for part in parts:
        for kind, digest, n_bytes, keep_id, copies, salts in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if kind == DELETE:
                index.delete(digest, n_bytes)
            else:
                index.insert(digest, n_bytes, keep_id, copies, salts or [])
    held = list(index.entries())
    schema = pa.schema([("digest", pa.binary()), ("n_bytes", pa.int64()), ("keep_id", pa.int64()),
                        ("copies", pa.int64()), ("salts", pa.list_(pa.int32()))])
    for at in range(0, len(held), 10_000):
        columns = list(zip(*held[at:at + 10_000], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, SHA-256 of the normalised text, its length in bytes, and the row's salt."""
    text = lower_ascii(docs["text"])
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.pmod(F.xxhash64(docs["doc_id"]), F.lit(SALTS)).cast("int").alias("salt"))


def update_index(index: DataFrame | None, inserted: DataFrame | None = None,
                 deleted: DataFrame | None = None) -> DataFrame:
    """The live index after taking out the texts of ``deleted`` and adding ``inserted``.

    ``index`` is an earlier result (or None), the other two have doc_id and text.
    """
    parts = []
    if index is not None:
        parts.append(index.select(F.lit(STORED).alias("kind"), "digest", "n_bytes", "keep_id", "copies", "salts"))
    if deleted is not None:
        parts.append(digests(deleted).select("digest", "n_bytes").distinct().select(
            F.lit(DELETE).alias("kind"), "digest", "n_bytes", F.lit(None).cast("long").alias("keep_id"),
            F.lit(0).cast("long").alias("copies"), F.array().cast("array<int>").alias("salts")))
    if inserted is not None:
        parts.append(_counted(digests(inserted)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return _indexed(rows)


def _counted(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("digest", "n_bytes", "salt").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("copies")).select(
        F.lit(INSERT).alias("kind"), "digest", "n_bytes", "keep_id", "copies", F.array("salt").alias("salts"))


def _indexed(rows: DataFrame) -> DataFrame:
    return rows.repartition("digest").sortWithinPartitions("kind").mapInArrow(_index_rows, INDEX_SCHEMA)


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept."""
    keyed = digests(docs)
    live = _indexed(_counted(keyed)).select(
        F.col("digest").alias("_digest"), F.col("n_bytes").alias("_n"), "keep_id",
        F.col("copies").alias("group_size"), F.explode("salts").alias("_salt"))
    joined = keyed.join(live, (keyed["digest"] == live["_digest"]) & (keyed["n_bytes"] == live["_n"])
                        & (keyed["salt"] == live["_salt"]))
    return joined.select("doc_id", "digest", "keep_id", "group_size",
                         F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))
