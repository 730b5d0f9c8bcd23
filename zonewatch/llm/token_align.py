"""Cross-tokenizer alignment (operator 11) by galloping intersection of token ends.

Byte-level BPE (A) and piece BPE (B) cut the same bytes, space + text, into tokens.  The ends
of the shorter list drive a search into the longer one: from the place where an
earlier end was found the step doubles until it is past the end looked for, and a binary
search finishes inside the last step.  Ends found in both lists cut the tokens into groups;
the ranks of two neighbouring ends differ by what overlaps the token between them, which gives
the links of overlapping A and B tokens.  All texts of a slice are laid one after the other, so
one search in numpy serves the slice; every ``ANCHOR``-th end is found first, by the same search, and
the ends between two anchors gallop from the first.

How often an id pair is linked is counted over the whole corpus.  A slice (about
``SLICE_BYTES`` of text) keeps its distinct pairs and, packed, each document's count of them.
Pairs are summed by Spark; the totals go back to the slices that hold the pair (at most once a
slice each, whatever its count), never to every task.  Only the highest count of each B id is broadcast
where the planner finds it small: it has no more rows than B has ids.

Cases: a text that is null or empty, or whose tokens of either side do not spell space + text (a
U+2581 in the text, for one, which B cannot tell from a space), has no tokens: zeros and ''.
Null and repeated doc_ids are rows like any other.  Texts are taken whole; a very long one is a slice
of its own.  Ties for a B id's highest count all count.  Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.llm.common import run_folder, slices, stage, store, utf8

ANCHOR = 32
SLICE_BYTES = 2 << 20
CODEC = "zstd"
CACHED_WORDS = 450_000  # about 270 bytes each
# Parts begin at a space between two other characters, the second no white space.  A's pattern begins a match
# at each such space whatever stands around it; that B's vocabulary joins nothing across it is looked up.
_CUT = re.compile(r"(?<! )(?= \S)").split


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of the ascending ``short``, how many of the ascending ``long`` are smaller."""
    n = len(long)
    if not len(short) or not n:
        return np.zeros(len(short), np.int64)
    if max(short[-1], long[-1]) < 1 << 31:
        short, long = short.astype(np.int32, copy=False), long.astype(np.int32, copy=False)
    if len(short) <= ANCHOR:
        low = np.zeros(len(short), np.int64)
    else:
        low = np.repeat(gallop(short[::ANCHOR], long), ANCHOR)[:len(short)]
    step = np.ones(len(short), np.int64)
    going = np.flatnonzero(long[np.minimum(low, n - 1)] < short)  # the others are found where they start
    high = low.copy()
    while len(going):  # all before low is smaller; double the step until long[low + step] is not
        probe = low[going] + step[going]
        past = (probe >= n) | (long[np.minimum(probe, n - 1)] >= short[going])
        done = going[past]
        high[done] = np.minimum(probe[past], n)
        going = going[~past]
        low[going] += step[going]
        step[going] *= 2
    open_ = np.flatnonzero(low < high)
    while len(open_):  # long[low] is smaller, long[high] is not
        middle = (low[open_] + high[open_]) >> 1
        smaller = long[np.minimum(middle, n - 1)] < short[open_]
        low[open_[smaller]] = middle[smaller] + 1
        high[open_[~smaller]] = middle[~smaller]
        open_ = open_[low[open_] < high[open_]]
    return low


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of two lists of ascending ends of the same bytes: the token numbers of A and B that end
    together, and the links as (A token, B token), by the shorter list's tokens."""
    swap = len(b_ends) < len(a_ends)
    short, long = (b_ends, a_ends) if swap else (a_ends, b_ends)
    rank = gallop(short, long)
    both = long[np.minimum(rank, len(long) - 1)] == short if len(long) else np.zeros(len(short), bool)
    at = np.flatnonzero(both)
    first = np.concatenate(([0], (rank + both)[:-1]))[:len(short)]  # the first that ends after the token's start
    n = rank - first + 1
    i = np.repeat(np.arange(len(short)), n)
    j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return (rank[at], at, j, i) if swap else (at, rank[at], i, j)


class TokenizerPair:
    """The two tokenizers and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        def read(path: str) -> bytes:
            fs, name = store(path)
            with fs.open_input_file(name) as f:
                return f.read()

        self.a = Tokenizer.from_buffer(read(a_path))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=read(b_path))
        code = _byte_of_character()
        entries = sorted((i, t) for t, i in self.a.get_vocab().items())
        self.a_bytes = [b""] * (entries[-1][0] + 1)
        for i, token in entries:
            self.a_bytes[i] = bytes(code[c] for c in token) if all(c in code for c in token) else token.encode()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.a_length, self.b_length = (np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        # no B token holds a space after something else, so that none crosses a cut
        self.falls_apart = not any(b" " in t.lstrip(b" ") for t in self.b_bytes)
        self.words: dict[str, tuple | None] = {}
        self.decimal = [str(i).encode() + sign for sign in (b",", b"|", b";", b"") for i in range(self.most)]

    @property
    def most(self) -> int:
        return max(len(self.a_bytes), len(self.b_bytes))

    def encode(self, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Ids of both sides of each text, as little-endian 32-bit numbers; none where either does not
        spell space + text."""
        cut = [self._parts(t) for t in texts]
        if len(self.words) > CACHED_WORDS:
            self.words = {}
        words = self.words
        new = list({part for parts in cut if parts for part in parts}.difference(words))
        for at in range(0, len(new), 4096):
            self._learn(new[at:at + 4096])
        out = []
        for parts in cut:
            found = [words[part] for part in parts or ()]
            a, b = zip(*found, strict=True) if found and None not in found else ((), ())
            out.append((b"".join(a), b"".join(b)))
        return out

    def _parts(self, text: bytes) -> list[str] | None:
        if not text:
            return None
        try:
            decoded = " " + text.decode()
        except UnicodeDecodeError:
            return None
        return [part for part in _CUT(decoded) if part] if self.falls_apart else [decoded]

    def _learn(self, parts: list[str]) -> None:
        """Ids of parts that begin with a space, by both libraries; none unless both spell the part."""
        a_ids = (e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False))
        b_ids = self.b.encode([part[1:] for part in parts], num_threads=1)  # it adds the space itself
        for part, a, b in zip(parts, a_ids, b_ids, strict=True):
            spelled = part.encode()
            same = all(b"".join(map(side.__getitem__, ids)) == spelled for side, ids in ((self.a_bytes, a), (self.b_bytes, b)))
            self.words[part] = (pack(f"<{len(a)}I", *a), pack(f"<{len(b)}I", *b)) if same else None


def _byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    characters for themselves, the other bytes in order for the characters from U+0100 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b != 0x20]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


_pairs: dict[tuple[str, str], TokenizerPair] = {}


def _tokenizers(a_path: str, b_path: str) -> TokenizerPair:
    return _pairs.get((a_path, b_path)) or _pairs.setdefault((a_path, b_path), TokenizerPair(a_path, b_path))


def _squeeze(values: np.ndarray) -> bytes:
    """Numbers below 2^32, as their length and the compressed planes of their four bytes."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec=CODEC, asbytes=True)


def _unsqueeze(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=4 * n, codec=CODEC), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and how often each occurs."""
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))[:len(values)])
    return values[first], np.diff(np.concatenate((first, [len(values)])))


def aligned(tokens: list[tuple[bytes, bytes]], pair: TokenizerPair) -> dict:
    """What the documents of one slice hold: counts, groups' texts, links as distinct id pairs."""
    docs = len(tokens)
    n_a, n_b = (np.array([len(t[k]) // 4 for t in tokens], np.int64) for k in (0, 1))
    a, b = (np.frombuffer(b"".join(t[k] for t in tokens), "<u4").astype(np.int64) for k in (0, 1))
    a_group, b_group, i, j = align(np.cumsum(pair.a_length[a]), np.cumsum(pair.b_length[b]))
    last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
    doc_of_a = np.repeat(np.arange(docs), n_a)
    n_groups = np.bincount(doc_of_a[a_group], minlength=docs) if len(a) else np.zeros(docs, np.int64)
    link_doc = doc_of_a[i]
    keys = a[i] * len(pair.b_bytes) + b[j]
    distinct, sums = _counted(keys)
    local = np.searchsorted(distinct, keys)
    held, times = _counted(link_doc * max(len(distinct), 1) + local)
    doc, local = np.divmod(held, max(len(distinct), 1))
    # tokens in the order of the groups' text: by group, A before B, and the sign after each
    # (0 comma, 1 bar, 2 semicolon, 3 nothing)
    after_a, after_b = np.zeros(len(a) + 1, np.int64), np.zeros(len(b) + 1, np.int64)
    after_a[a_group + 1], after_b[b_group + 1] = 1, 1
    group_a, group_b = np.cumsum(after_a)[:-1], np.cumsum(after_b)[:-1]
    code = np.empty(len(a) + len(b), np.int64)
    place_a = np.arange(len(a)) + np.concatenate(([0], b_group + 1))[group_a]
    place_b = np.arange(len(b)) + np.concatenate((a_group + 1, [0]))[group_b]
    code[place_a], code[place_b] = a, b
    code[place_a[a_group]] += pair.most
    code[place_b[b_group]] += 2 * pair.most
    ends = np.cumsum(n_a + n_b)
    code[ends[n_b > 0] - 1] += pair.most
    spelled, starts = list(map(pair.decimal.__getitem__, code.tolist())), ends - n_a - n_b
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": np.bincount(link_doc, minlength=docs),
            "groups": [b"".join(spelled[s:e]) for s, e in zip(starts, ends, strict=True)],
            "pairs": distinct, "sums": sums, "doc": doc, "local": local, "times": times}


SLICES = pa.schema([("slice", pa.int64()), ("pair", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("b_ids", pa.int64()),
                    ("doc_id", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
                    ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())), ("groups_sha256", pa.list_(pa.string())),
                    ("held", pa.list_(pa.int64())), ("local", pa.binary()), ("times", pa.binary())])
_DDL = ("slice long, pair array<long>, n array<long>, b_ids long, doc_id array<long>, n_a array<long>, n_b array<long>, "
        "n_groups array<long>, n_links array<long>, groups_sha256 array<string>, held array<long>, local binary, times binary")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _align(a_path: str, b_path: str):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, name = _tokenizers(a_path, b_path), TaskContext.get().partitionId() << 32
        for part in parts:
            ids, texts = part.column(0).to_pylist(), utf8(part.column(1))
            for at, to in slices(texts, SLICE_BYTES):
                found = aligned(pair.encode(texts[at:to]), pair)
                groups = [hashlib.sha256(g).hexdigest() if g else "" for g in found["groups"]]
                row = {"slice": name, "pair": found["pairs"], "n": found["sums"], "b_ids": len(pair.b_bytes), "doc_id": ids[at:to],
                       "groups_sha256": groups, "held": np.bincount(found["doc"], minlength=to - at),
                       "local": _squeeze(found["local"]), "times": _squeeze(found["times"])}
                row |= {k: found[k] for k in ("n_a", "n_b", "n_groups", "n_links")}
                name += 1
                yield pa.RecordBatch.from_pylist([row], schema=SLICES)
    return run


def _score(key: tuple[pa.Scalar, ...], rows: pa.Table, totals: pa.Table) -> pa.Table:
    """The documents of a slice, from what its pairs count over the corpus."""
    row = rows.slice(0, 1).to_pylist()[0]
    order = np.argsort(totals.column("pair").to_numpy())  # as the slice numbers its pairs
    count, best = (totals.column(c).to_numpy(zero_copy_only=False).astype(np.int64)[order] for c in ("total", "best"))
    local, times = _unsqueeze(row["local"]), _unsqueeze(row["times"])
    ends = np.cumsum(np.array(row["held"], np.int64))
    out = {c: pa.array(row[c], pa.string() if c == "groups_sha256" else pa.int64())
           for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    for name, value in (("n_best", best), ("count_sum", count)):
        sums = np.concatenate(([0], np.cumsum(value[local] * times)))[np.concatenate(([0], ends))]
        out[name] = pa.array(np.diff(sums), pa.int64())
    return pa.table([out[c.split()[0]] for c in RESULT.split(", ")], names=[c.split()[0] for c in RESULT.split(", ")])


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    folder = run_folder(docs.sparkSession, "align")
    held = stage(docs.mapInArrow(_align(a_path, b_path), _DDL), folder, "slices")
    asked = held.select(F.col("slice").alias("asker"), "b_ids", F.explode(F.arrays_zip("pair", "n")).alias("x")).select(
        "asker", F.col("x.pair").alias("pair"), F.col("x.n").alias("n"), F.expr("x.pair % b_ids").alias("b"))
    totals = stage(asked.groupBy("pair", "b").agg(F.sum("n").alias("total")), folder, "totals")
    highest = totals.groupBy(F.col("b").alias("_b")).agg(F.max("total").alias("highest"))
    known = totals.join(highest, F.col("b") == F.col("_b")).select(
        F.col("pair").alias("_pair"), "total", (F.col("total") == F.col("highest")).alias("best"))
    answers = asked.join(known.hint("merge"), F.col("pair") == F.col("_pair")).select("asker", "pair", "total", "best")
    return held.drop("pair", "n", "b_ids").groupBy("slice").cogroup(answers.groupBy("asker")).applyInArrow(_score, RESULT)
