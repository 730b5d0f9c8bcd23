"""Packing (operator 8): best-fit decreasing into windows of at most 2048 tokens.

A document's tokens are its text's ids and an end id.  Overlong documents are
cut into full windows, each a sequence of its own; what is left over is dealt
by hash to lanes of about ``LANE_ROWS`` documents.  In a lane the pieces go
from long to short into the open sequence with the least room that still holds
them, which a segment tree over the remaining capacities finds.

Tokens.  Where the tokenizer's file says that it drops white space and never merges
across it, a text's ids are those of its words one after the other: a worker keeps
ids of words (a bounded cache of two generations) and passes the new ones of a slice to the tokenizer
together.  Texts of ASCII and Latin-1 letters are lower-cased first and cut by the tokenizer's own pattern, so
that words are kept without the signs around them.  A tokenizer of any other kind is given whole texts.

Cases: a null or empty text is the end id alone.  Null and repeated doc_ids
are packed like any other; repeated rows are packed each.  Sequence ids are
unique, not gapless.  Extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.llm.common import mix, slices, utf8

WINDOW = 2048
END_ID = 1
LANE_ROWS = 8192
CACHED_WORDS, LONGEST = 600_000, 64  # two generations of about 200 bytes a word
MATCHES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# of Latin-1 only ASCII and letters: each is one character in NFC, and its small letter is one byte, too
NOT_PLAIN = bytes(c for c in range(128, 256) if not chr(c).isalpha() or c < 0xC0) + b"<"
SMALL = bytes(ord(low) if len(low := chr(c).lower()) == 1 and ord(low) < 256 else c for c in range(256))
PLAIN_MATCHES = re.compile(rb"[a-z\xdf-\xff]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\s0-9a-z\xdf-\xff]+")
SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "<|>")


class CapacityTree:
    """Open sequences by remaining capacity; a node counts the sequences below it."""

    def __init__(self, most: int):
        self.leaves = 1 << (most + 1).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.held: dict[int, list[int]] = {}

    def put(self, room: int, sequence: int) -> None:
        self.held.setdefault(room, []).append(sequence)
        self._add(room, 1)

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, sequence) of the least room >= need."""
        count, node = self.count, need + self.leaves
        while not count[node]:
            while node & 1:  # a right child has nothing after it below its parent
                node >>= 1
                if not node:
                    return None
            node += 1
            if node & (node - 1) == 0:  # past the last node of the level
                return None
        while node < self.leaves:
            node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.held[room].pop()


def best_fit(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """(sequence, offset) of pieces given from long to short."""
    tree, made, out = CapacityTree(window), 0, []
    for length in lengths:
        found = tree.take(length)
        if found is None:
            room, sequence = window, made
            made += 1
        else:
            room, sequence = found
        out.append((sequence, window - room))
        if room > length:
            tree.put(room - length, sequence)
    return out


def plain_matches(text: bytes) -> list[bytes] | None:
    """The matches of ``MATCHES`` in a text of ASCII and Latin-1 letters, small and in Latin-1;
    None for any other text, and for one that may hold a special token."""
    if not text.isascii():
        try:
            text = text.decode().encode("latin-1")
        except UnicodeError:
            return None
    if len(text.translate(None, NOT_PLAIN)) < len(text):
        return None
    return PLAIN_MATCHES.findall(text.translate(SMALL))


def cuts_at_space(tokenizer: dict) -> bool:
    """Whether the tokenizer (its file as read) drops white space, never merges across it and takes a
    run of signs behind a letter or digit for a match of its own, so that ids can be kept by word."""
    normal, cut = ((tokenizer.get(k) or {}).get(f) or [] for k, f in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")))
    return (
        [n.get("type") for n in normal] == ["NFC", "Replace", "Lowercase"]
        and normal[1] == {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
        and [c.get("type") for c in cut] == ["Split", "ByteLevel"]
        and cut[0]["pattern"] == {"Regex": MATCHES} and (cut[0]["behavior"], cut[0]["invert"]) == ("Removed", True)
        and not cut[1]["add_prefix_space"] and not cut[1]["use_regex"]
        and all(t["content"][:1] == "<" and t["content"][-1:] == ">" for t in tokenizer["added_tokens"])
        and all(t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in tokenizer["added_tokens"]))


class WordIds:
    """Token ids of texts, little-endian unsigned 32-bit; where ``cuts_at_space`` holds word by word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            self.by_word = cuts_at_space(json.load(f))
        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encode(self, text: bytes) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            held = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() for e in held]
        plain = [plain_matches(t) for t in texts]
        split = [t.split() if p is None else p for t, p in zip(texts, plain, strict=True)]
        if len(self.words) >= CACHED_WORDS:
            self.words, self.old = {}, self.words
        # a word in UTF-8 is never one in Latin-1: it has bytes that no small letter there has
        matches = set().union(*(p for p in plain if p is not None)).difference(self.words)
        self._learn_atoms(matches)
        new = set().union(*(w for w, p in zip(split, plain, strict=True) if p is None)).difference(self.words)
        if new:
            self._learn(new)
        out = [b"".join(map(self.words.__getitem__, words)) for words in split]
        for word in (*matches, *new):
            if len(word) > LONGEST:  # not likely to come again
                del self.words[word]
        return out

    def _learn_atoms(self, new: set[bytes]) -> None:
        """Ids of new matches of ``PLAIN_MATCHES``."""
        known = {m: ids for m in new if (ids := self.old.get(m))} if self.old else {}
        self.words.update(known)
        wanted = [m for m in new if m not in known]
        for at, to in slices(wanted, 1 << 14):
            self.words.update(zip(wanted[at:to], self._ids([m.decode("latin-1") for m in wanted[at:to]]), strict=True))

    def _learn(self, new: set[bytes]) -> None:
        """Ids of new words, from those of their stems and of the signs behind them."""
        parts, atoms = {}, set()
        for word in new:
            ids = self.old.get(word)
            if ids is not None:
                self.words[word] = ids
                continue
            stem, signs = word, b""
            bare = word.rstrip(SIGNS)
            if bare != word and bare[-1:].isalnum():
                stem, signs = bare, word[len(bare):]
            # letters are lower-cased anyway, in other scripts after they are composed; and
            # a special token is one only as it is written
            if stem.isascii() and b"<|" not in stem:
                stem = stem.lower()
            parts[word] = stem, signs
            atoms.add(stem)
            atoms.add(signs)
        atoms.discard(b"")
        known = {atom: ids for atom in atoms if (ids := self.words.get(atom) or self.old.get(atom))}
        wanted = [atom for atom in atoms if atom not in known]
        for at, to in slices(wanted, 1 << 14):
            known.update(zip(wanted[at:to], self._ids([w.decode("utf-8", "replace") for w in wanted[at:to]]), strict=True))
        known[b""] = b""
        for word, (stem, signs) in parts.items():
            self.words[word] = known[stem] + known[signs]

    def _ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each word, from one call: a token belongs to the word in which it begins."""
        held = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        starts = np.fromiter((a for a, _ in held.offsets), np.int64, len(held.ids))
        ends = np.cumsum([len(t) + 1 for t in texts])
        edges = [0, *(4 * np.searchsorted(starts, ends)).tolist()]
        ids = np.array(held.ids, "<u4").tobytes()
        return [ids[a:z] for a, z in zip(edges, edges[1:], strict=False)]


_tokenizers: dict[str, WordIds] = {}
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("lane", pa.int64())])


def _cut(path: str, lanes: int):
    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _tokenizers.get(path) or _tokenizers.setdefault(path, WordIds(path))
        row = 0
        for part in parts:
            doc_ids, texts = part.column(0).to_pylist(), utf8(part.column(1))
            for at, to in slices(texts, 1 << 20):
                pieces = []
                for doc_id, ids in zip(doc_ids[at:to], ids_of.encode_all(texts[at:to]), strict=True):
                    row += 1
                    ids = memoryview(ids + END_ID.to_bytes(4, "little"))
                    n = len(ids) // 4
                    # the row's number within its input split keeps repeated rows apart
                    lane = int(mix(np.array([(doc_id or 0) * 0x9E3779B1 + row & 0x7FFFFFFFFFFFFFFF], np.uint64))[0]) % lanes
                    for start in range(0, n, WINDOW):
                        held = ids[4 * start:4 * (start + WINDOW)]
                        pieces.append((doc_id, start, len(held) // 4, zlib.crc32(held), n, lane))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pieces, strict=True)], schema=PIECES)
    return cut


def _pack_lane(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    lane = key[0].as_py()
    rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
    placed = best_fit(rows.column("length").to_pylist())
    return rows.drop_columns(["lane"]).append_column(
        "sequence_id", pa.array([lane << 32 | s for s, _ in placed], pa.int64())).append_column(
        "offset", pa.array([o for _, o in placed], pa.int64()))


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    lanes = max(1, ceil(docs.count() / LANE_ROWS))
    columns = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.mapInArrow(_cut(tokenizer_path, lanes), f"{columns}, lane long").groupBy("lane").applyInArrow(
        _pack_lane, f"{columns}, sequence_id long, offset long")
