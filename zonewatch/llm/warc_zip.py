"""WARC (operator 2): records in ZIP-packaged archives, read by range.

Writing.  A task writes its rows as WARC/1.1 records, each a gzip member, into
``archive/*.warc.gz`` members that the ZIP stores as they are, beside
``indexes/*.idx`` members with a line (offset, length) for each record.  An
archive is closed at ``ARCHIVE_BYTES``.  Files get a new name in each attempt,
and only the manifest of finished tasks is read, so a lost executor leaves an
orphan, never a double record.

Reading.  One row per archive parses the end record, the ZIP64 locator and end
record where there are any, and the central directory; local headers give
where a member's bytes begin.  Index members yield (path, offset, length) rows,
which are dealt out and read by range, neighbours together; nothing is
extracted.  A WARC member without an index is walked record by record.

Duplicates.  Of records with equal payloads of ``MIN_REVISIT`` bytes or more,
the one with the largest page_id is the response and the others revisit it:
their block holds the HTTP header, whose Content-Length is the payload's.

Cases: a null html is an empty payload, a null url is written as the record's
own name, a null page_id is a response and comes back null.  Rows that repeat a
page_id are records of their own.  Extra columns are ignored.  An empty table
gives an empty manifest and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewatch.llm.common import run_folder, stage, store

MIN_REVISIT = 1000
MEMBER_BYTES, ARCHIVE_BYTES = 8 << 20, 64 << 20
READ_BYTES, READ_GAP = 4 << 20, 64 << 10
SALTS = 16
NAME = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- records -------------------------------------------------------------------------------


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    name = f"{NAME}{'null' if page_id is None else page_id}"
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>",
             f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%') if url else name}",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{NAME}{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in data.decode("utf-8", "replace").split("\r\n")[1:])}


def parse_record(data: bytes) -> dict:
    """page_id, url, payload (None in a revisit), payload_bytes, digest, record_type, refers_to."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    warc = _headers(head)
    block = rest[:int(warc["content-length"])]
    if len(block) < int(warc["content-length"]):
        raise ValueError("truncated WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")

    def page(value: str | None) -> int | None:
        number = (value or "").strip("<>").removeprefix(NAME)
        return int(number) if number not in ("", "null") else None

    digest = base64.b32decode(warc["warc-payload-digest"].partition(":")[2]).hex()
    revisit = warc["warc-type"] == "revisit"
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {warc['warc-record-id']} does not match its digest")
    return {"page_id": page(warc["warc-record-id"]), "url": warc.get("warc-target-uri"),
            "payload": None if revisit else payload, "payload_digest": digest, "record_type": warc["warc-type"],
            "payload_bytes": int(_headers(http)["content-length"]) if revisit else len(payload),
            "refers_to": page(warc.get("warc-refers-to"))}


# --- ZIP directories -----------------------------------------------------------------------


@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int  # where its local header begins


def _zip64(extra: bytes, size: int, packed: int, header: int) -> tuple[int, int, int]:
    """The three fields, those at their limit taken from the ZIP64 extra field in this order."""
    while len(extra) >= 4:
        kind, n = struct.unpack_from("<HH", extra)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
            size = next(values) if size == 0xFFFFFFFF else size
            packed = next(values) if packed == 0xFFFFFFFF else packed
            header = next(values) if header == 0xFFFFFFFF else header
            break
        extra = extra[4 + n:]
    return size, packed, header


def directory(f, size: int) -> list[Member]:
    """Members of an archive from its end record and its central directory."""
    tail_at = max(0, size - (22 + 0xFFFF + 20 + 56))
    f.seek(tail_at)
    tail = f.read(size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20:at + 22], "little") != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)  # the signature may also stand in a comment
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, offset = struct.unpack_from("<HII", tail, at + 10)
    end = tail_at + at
    if at >= 20 and tail[at - 20:at - 16] == b"PK\x06\x07":
        (record_at,) = struct.unpack_from("<Q", tail, at - 12)
        f.seek(record_at)
        record = f.read(56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record where its locator points")
        count, length, offset = struct.unpack_from("<QQQ", record, 32)
        end = record_at
    if offset + length > end:
        raise ValueError("central directory runs past its end")
    f.seek(offset)
    data, at, out = f.read(length), 0, []
    for _ in range(count):
        if data[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory entry")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, whole, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, at + 20)
        (header,) = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[at + 46 + n_name:at + 46 + n_name + n_extra]
        whole, packed, header = _zip64(extra, whole, packed, header)
        out.append(Member(name, method, packed, header))
        at += 46 + n_name + n_extra + n_comment
    return out


def data_offset(f, member: Member) -> int:
    """Where a member's bytes begin: name and extra field may differ in the local header."""
    f.seek(member.header)
    local = f.read(30)
    if local[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header for {member.name}")
    n_name, n_extra = struct.unpack_from("<HH", local, 26)
    return member.header + 30 + n_name + n_extra


# --- writing -------------------------------------------------------------------------------


class ArchiveWriter:
    """ZIP archives in ``folder``, closed and begun anew by size; ``done`` lists (path, records)."""

    def __init__(self, folder: str, indexed: bool = True):
        self.folder, self.indexed, self.done = folder, indexed, []
        self.zip = None
        self._member()

    def _member(self) -> None:
        self.data, self.index = io.BytesIO(), []

    def add(self, record: bytes) -> None:
        held = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = held.compress(record) + held.flush()
        self.index.append((self.data.tell(), len(packed)))
        self.data.write(packed)
        if self.data.tell() >= MEMBER_BYTES:
            self._close_member()

    def _close_member(self) -> None:
        if not self.index:
            return
        if self.zip is None:
            self.uri = f"{self.folder}/{uuid.uuid4().hex}.wacz"
            fs, path = store(self.uri)
            self.out = fs.open_output_stream(path)
            self.zip, self.members, self.size, self.records = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED), 0, 0, 0
        name = f"data-{self.members:04d}"
        self.zip.writestr(f"archive/{name}.warc.gz", self.data.getvalue())
        if self.indexed:
            self.zip.writestr(f"indexes/{name}.idx", "".join(f"{a} {b}\n" for a, b in self.index))
        self.members, self.size, self.records = self.members + 1, self.size + self.data.tell(), self.records + len(self.index)
        self._member()
        if self.size >= ARCHIVE_BYTES:
            self._close_archive()

    def _close_archive(self) -> None:
        if self.zip is not None:
            self.zip.close()
            self.out.close()
            self.done.append((self.uri, self.records))
            self.zip = None

    def close(self) -> None:
        self._close_member()
        self._close_archive()


def revisits(pages: DataFrame) -> DataFrame:
    """page_id, digest, refers_to of the records that revisit another."""
    payload = F.coalesce(pages["html"], F.lit("")).cast("binary")
    keyed = pages.select(pages["page_id"].cast("long").alias("page_id"), F.unhex(F.sha1(payload)).alias("digest"),
                         F.pmod(F.xxhash64(pages["page_id"]), F.lit(SALTS)).alias("salt"),
                         F.octet_length(payload).alias("n_bytes")).filter(
        F.col("n_bytes") >= MIN_REVISIT).drop("n_bytes").filter(F.col("page_id").isNotNull())
    target = keyed.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).filter(
        "least < refers_to").select(F.col("digest").alias("_digest"), "refers_to",
                                    F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    return keyed.join(target, (keyed["digest"] == target["_digest"]) & (keyed["salt"] == target["_salt"])).filter(
        "page_id < refers_to").select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write every row of ``pages`` (page_id, url, html); the manifest: path, records."""
    found = revisits(pages).select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to")
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                        pages["html"].cast("binary").alias("html"))
    digest = F.unhex(F.sha1(F.coalesce(rows["html"], F.lit(b""))))
    rows = rows.join(found, (rows["page_id"] == found["_page"]) & (digest == found["_digest"]), "left").select(
        "page_id", "url", "html", "refers_to")

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder)
        for part in parts:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in part.columns), strict=True):
                writer.add(make_record(page_id, url, html or b"", refers_to))
        writer.close()
        if writer.done:
            paths, records = zip(*writer.done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(records, pa.int64())], names=["path", "records"])

    return rows.mapInArrow(write, "path string, records long")


# --- reading -------------------------------------------------------------------------------


def _walk(f, at: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of the gzip members of a WARC member without an index."""
    end, held, held_at = at + size, b"", at
    while at < end:
        unpack, used = zlib.decompressobj(31), 0
        while not unpack.eof:
            if not held:
                f.seek(held_at)
                held = f.read(min(READ_BYTES, end - held_at))
                if not held:
                    raise ValueError("truncated record")
            unpack.decompress(held)
            used += len(held) - len(unpack.unused_data)
            held_at += len(held) - len(unpack.unused_data)
            held = unpack.unused_data
        yield at, used
        at += used


def _walk_plain(f, at: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of the records of a WARC member without compression, by their headers."""
    end = at + size
    while at < end:
        head, mark = b"", -1
        while mark < 0:
            f.seek(at + len(head))
            more = f.read(min(READ_BYTES, 4096 + len(head), end - at - len(head)))
            if not more:
                raise ValueError("truncated record")
            head += more
            mark = head.find(b"\r\n\r\n")
        fields = dict(line.split(b":", 1) for line in head[:mark].lower().split(b"\r\n")[1:] if b":" in line)
        length = mark + 4 + int(fields[b"content-length"]) + 4
        yield at, length
        at += length


def _places(f, members: list) -> Iterator[list[tuple[int, int]]]:
    """The records of each WARC member; members of one name each have their own index, in their order."""
    held: dict[str, list] = {}
    for member in members:
        held.setdefault(member.name, []).append(member)
    for name, same in held.items():
        if not name.endswith((".warc.gz", ".warc")):
            continue
        indexes = held.get(name.replace("archive/", "indexes/").removesuffix(".gz").removesuffix(".warc") + ".idx", [])
        for k, member in enumerate(same):
            if member.method != 0:
                raise ValueError(f"{name} is not stored: its records cannot be read by range")
            begin = data_offset(f, member)
            if len(indexes) == len(same) and indexes[k].method == 0:
                f.seek(data_offset(f, indexes[k]))
                yield [(begin + int(a), int(n)) for a, n in map(bytes.split, f.read(indexes[k].size).splitlines())]
            else:
                yield list((_walk if name.endswith(".gz") else _walk_plain)(f, begin, member.size))


def _locate(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("length", pa.int64())])
    for part in parts:
        for uri in part.column(0).to_pylist():
            fs, path = store(uri)
            with fs.open_input_file(path) as f:
                for places in _places(f, list(directory(f, f.size()))):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([uri] * len(places), pa.string()), pa.array([p[0] for p in places], pa.int64()),
                        pa.array([p[1] for p in places], pa.int64())], schema=schema)


RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _unpacked(record: bytes) -> bytes:
    return zlib.decompress(record, 31) if record[:2] == b"\x1f\x8b" else record


def _read(keep_payload: bool):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def ranges(part: pa.RecordBatch) -> Iterator[tuple[str, int, int, list]]:
        """Neighbouring records of one file, to be read at once."""
        run: list = []
        for place in sorted(zip(*(c.to_pylist() for c in part.columns), strict=True)):
            if run and (place[0] != run[0][0] or place[1] - (run[-1][1] + run[-1][2]) > READ_GAP
                        or place[1] + place[2] - run[0][1] > READ_BYTES):
                yield run[0][0], run[0][1], run[-1][1] + run[-1][2], run
                run = []
            run.append(place)
        if run:
            yield run[0][0], run[0][1], run[-1][1] + run[-1][2], run

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for uri, begin, end, run in ranges(part):
                fs, path = store(uri)
                with fs.open_input_file(path) as f:
                    f.seek(begin)
                    data = f.read(end - begin)
                rows = [parse_record(_unpacked(data[at - begin:at - begin + n])) for _, at, n in run]
                if not keep_payload:
                    rows = [r | {"payload": None} for r in rows]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return read


def read_archives(manifest: DataFrame, keep_payload: bool = True) -> DataFrame:
    """One row per record of the archives in ``manifest`` (path): see ``RECORDS``."""
    places = manifest.select("path").repartition("path").mapInArrow(_locate, "path string, at long, length long")
    places = stage(places, run_folder(manifest.sparkSession, "warc-places"), "places")
    # dealt by stretches of a file, as many as the bytes to read ask for, so that large archives are read
    # by many tasks in long ranges (the places themselves are too narrow to be dealt by their own size)
    total = places.agg(F.sum("length")).first()[0] or 0
    dealt = places.repartition(max(1, ceil(total / READ_BYTES)), "path", F.floor(F.col("at") / READ_BYTES))
    return dealt.mapInArrow(_read(keep_payload), RECORDS)


def pages_through_archives(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared folder and read the records back."""
    folder = run_folder(spark, "warc")
    manifest = stage(write_archives(pages, f"{folder}"), folder, "manifest")
    return read_archives(manifest, keep_payload=False).drop("payload", "url")
