"""Byte-level BPE encoding and decoding (operator 7) by monoid tree reduction.

Text level.  A text is encoded by halves down to leaves of ``LEAF`` characters,
which are lists of the split pattern's matches.  Two neighbours are joined by
matching again in a window around the seam that grows on both sides to a place
that is provably final: a space followed by a non-space.  No match crosses such
a place, whatever stands on either side: the alternatives that may begin with a
space match from it, and the white-space alternatives stop before it.

Token level.  A match longer than ``PIECE`` bytes is encoded by halves too, and
short parts, seams and pairs recur, so a worker keeps what it has found for them.
Two neighbours are joined by re-encoding a window of tokens around the seam,
which doubles until both its edges are stable: a sequence of tokens is the
encoding of its bytes where every two neighbours are the encoding of theirs, so
it is enough that the window's first and last token hold beside the tokens
outside it.

Decoding concatenates the bytes of halves up the same tree.

A worker keeps the ids of common matches (a bounded cache).  Cases: a null or empty text has no
ids; null and repeated doc_ids are rows like any other; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from zonewatch.llm.common import Words, slices, store

LEAF = 8192
PIECE, LONG = 5, 96
NONE = 1 << 60
CACHED_MATCHES, CACHED_SEAMS = 700_000, 150_000


class Splitter:
    """Matches of the split pattern.  Texts without characters from U+0250 on take the
    standard library's faster engine, with the pattern's classes spelled out."""

    LATIN = 0x250

    def __init__(self, pattern: str):
        self.any = regex.compile(pattern).findall
        kind = {c: unicodedata.category(chr(c))[0] for c in range(self.LATIN)}
        letters, numbers = (_ranges([c for c in kind if kind[c] == k]) for k in "LN")
        blank = _ranges([c for c in kind if regex.match(r"\s", chr(c))])
        spelled = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{blank}{letters}{numbers}]").replace(
            r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]").replace(r"\S", f"[^{blank}]").replace(r"\s", f"[{blank}]")
        self.latin = re.compile(spelled).findall if "\\p" not in spelled else self.any
        self.beyond = re.compile(f"[^\\x00-{chr(self.LATIN - 1)}]").search

    def __call__(self, text: str) -> list[str]:
        return self.any(text) if self.beyond(text) else self.latin(text)

    def tree(self, text: str) -> list[str]:
        if len(text) <= LEAF:
            return self(text)
        half = len(text) // 2
        return self.join(self.tree(text[:half]), self.tree(text[half:]))

    def join(self, left: list[str], right: list[str]) -> list[str]:
        """Matches of two neighbouring texts: only a window around the seam is matched again."""
        i, j = len(left) - 1, 0
        while i > 0 and not _final(left[i]):
            i -= 1
        while j < len(right) and not _final(right[j]):
            j += 1
        return left[:max(i, 0)] + self("".join(left[max(i, 0):] + right[:j])) + right[j:]


def _final(match: str) -> bool:
    """Whether a match must begin where this one does, whatever the text around it."""
    return len(match) > 1 and match[0] == " " and not match[1].isspace()


def _ranges(points: list[int]) -> str:
    """Character class text for sorted code points."""
    out, at = [], 0
    while at < len(points):
        to = at
        while to + 1 < len(points) and points[to + 1] == points[to] + 1:
            to += 1
        out.append(f"\\u{points[at]:04x}-\\u{points[to]:04x}")
        at = to + 1
    return "".join(out)


class ByteBPE:
    """Encoder and decoder of a rank file (lines of base64 token and rank)."""

    def __init__(self, path: str, pattern: str):
        fs, name = store(path)
        with fs.open_input_file(name) as f:
            lines = f.read().splitlines()
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = Splitter(pattern)
        self.short = Words(self.merge, CACHED_SEAMS)  # bytes of few characters
        self.seams = Words(self._seam, CACHED_SEAMS)  # of two tokens
        self.matches = Words(lambda match: self.encode_piece(match.encode()), CACHED_MATCHES)

    def merge(self, piece: bytes) -> list[int]:
        """Ids by merging the neighbours of lowest rank, leftmost first."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) > LONG:
            return self._merge_long(piece)
        get = ranks.get
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [get(piece[i:i + 2], NONE) for i in range(len(piece) - 1)]
        while pairs:
            low = min(pairs)
            if low == NONE:
                break
            i = pairs.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], NONE)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], NONE)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap, for windows that grew."""
        get, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))  # of the part that begins here; 0 where none does
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, to = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= n or end[mid] != to:
                continue  # one of the two parts has changed
            end[i], end[mid] = to, 0
            if to < n:
                before[to] = i
                if (r := get(piece[i:end[to]])) is not None:
                    heapq.heappush(heap, (r, i, end[to]))
            if (p := before[i]) >= 0 and (r := get(piece[p:to])) is not None:
                heapq.heappush(heap, (r, p, to))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def _seam(self, pair: tuple[int, int]) -> list[int]:
        return self.merge(self.tokens[pair[0]] + self.tokens[pair[1]])

    def _holds(self, a: int, b: int) -> bool:
        """Whether two neighbouring tokens are the encoding of their bytes."""
        return len(seam := self.seams[a, b]) == 2 and seam[0] == a

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of two neighbouring parts of a piece."""
        window, width = self.seams[left[-1], right[0]], 1
        if len(window) == 2 and window[0] == left[-1]:
            return left + right  # the seam holds, and so do all pairs within the parts
        while not ((len(left) <= width or self._holds(left[-width - 1], window[0]))
                   and (len(right) <= width or self._holds(window[-1], right[width]))):
            width *= 2
            window = self.merge(b"".join(map(self.tokens.__getitem__, left[-width:] + right[:width])))
        return left[:-width] + window + right[width:]

    def encode_piece(self, piece: bytes) -> list[int]:
        n = len(piece)
        if n <= PIECE:
            return self.short[piece]
        if piece in self.ranks:
            return [self.ranks[piece]]
        return self.join(self.encode_piece(piece[:n // 2]), self.encode_piece(piece[n // 2:]))

    def encode(self, text: str) -> np.ndarray:
        found = self.split.tree(text)
        ids = map(self.matches.__getitem__, found)
        return np.fromiter(chain.from_iterable(ids), np.int32)

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_coders: dict[tuple[str, str], ByteBPE] = {}


def coder(path: str, pattern: str) -> ByteBPE:
    """One per worker process."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = ByteBPE(path, pattern)
    return _coders[path, pattern]


IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
TEXTS = pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])


def encode_batches(parts: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    bpe = coder(path, pattern)
    for part in parts:
        doc_ids, texts = part.column(0), [t or "" for t in part.column(1).to_pylist()]
        for at, to in slices(texts, 1 << 20):
            ids = [bpe.encode(t) for t in texts[at:to]]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([doc_ids.slice(at, to - at), pa.ListArray.from_arrays(
                pa.array(ends), pa.array(np.concatenate(ids)), type=IDS.field(1).type)], schema=IDS)


def id_lists(column: pa.ListArray) -> list[list[int]]:
    """Rows of ids, null as none: by way of the flat values, many times faster than row by row."""
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    if column.null_count:
        return [x or [] for x in column.to_pylist()]
    return [values[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]


def decode_batches(parts: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    bpe = coder(path, pattern)
    for part in parts:
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(
            [bpe.decode(ids) for ids in id_lists(part.column(1))], pa.binary())], schema=TEXTS)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids of every text."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(
        lambda parts: encode_batches(parts, path, pattern), "doc_id long, ids array<int>")


def decode_documents(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, text (bytes) of rows of ids."""
    return ids.select("doc_id", "ids").mapInArrow(
        lambda parts: decode_batches(parts, path, pattern), "doc_id long, text binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the bytes that they decode to: the two
    operators one after the other within a task, so ids are not sent through the JVM."""
    def digest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Words(str)
        for coded in encode_batches(parts, path, pattern):
            ids = id_lists(coded.column(1))
            texts = next(decode_batches(iter([coded]), path, pattern)).column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([
                coded.column(0), pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(" ".join(map(names.__getitem__, x)).encode()).hexdigest() for x in ids]),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
