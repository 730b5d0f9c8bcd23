"""Word model of the quality rules (operator 10): order-3 modified Kneser-Ney over words.

Counts.  Every document counts, whole.  A block (documents of one language out
of a few MB of a task) lies compressed in a file of its task, and sends no words:
it sends the sorted hashes of its distinct trigrams, as differences, with their
counts, to parts by hash range.  Most grams lie in one block: the first bits of all of them go ahead, ``FILTER_BITS``
longer than the corpus's words need, and only grams whose first bits another block sent too follow whole; what is known of
the others is the block's own, and it speaks for them (its counts of their counts go along).  A part is a sorted hash array of the model: it
adds the counts up and answers each block with the corpus counts of its trigrams, in a file that the block
reads its share of whenever it needs it, so that answers are written once and never shuffled; of the blocks
that hold a trigram one is told that it speaks for it.  That block adds to its
bigrams what the trigram gives them: total and kinds of followers as a context, kinds of
predecessors as a gram (a gram that opens a text has its raw count).  Bigrams go
to their parts with these sums, are answered, and give to words in the same way.
A gram is a hash, ``MARGIN_BITS`` longer than the corpus's words need, so that at any size
one in a million shares its hash; a common one is one entry a block, wherever it lies.  Parts grow in number with the words of the corpus.  Nothing is dropped or sampled.

Score.  A document is judged by the others: its own counts are taken out of all
levels of the model, continuation counts and totals included, before its words
are scored (discounts, one figure a level, stay those of the corpus).  Below a
language's words lie those of all languages, so a text that mixes them is not
taken for noise, and below these the character model of ``kn_rules``, which
spells a word that no other document has.  The result is -sum(log p) / words.
"""

from __future__ import annotations

import copy
import uuid
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.llm.common import mix, stage, store

PART_WORDS = 1 << 22  # words of the corpus a part
LEAST_PARTS = 48
MARGIN_BITS = 20  # bits of a gram's hash beyond those that number the words of the corpus
FILTER_BITS = 5  # the same for the first look at which grams several blocks hold: one in 32 looks shared and is not
FILTERED = {3: 5, 2: 4}  # level of what the first look says of trigrams and bigrams
OPEN = np.uint64(0x6A09E667F3BCC909)  # stands before a text's first words
OPENS = np.array([OPEN])
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
ANSWER, TALLY = 0, 1

KEPT = "block long, lang string, n_words long, file string, offset long, size long"
PLACE = ("block", "lang", "file", "offset", "size")
SENT = "lang string, part int, block long, keys binary, n binary, level int, tally binary"
SENT_ARROW = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("n", pa.binary()),
                        ("level", pa.int32()), ("tally", pa.binary())])
MADE = "kind int, lang string, part int, block long, level int, n binary, file string, offset long, size long"
MADE_ARROW = pa.schema([("kind", pa.int32()), ("lang", pa.string()), ("part", pa.int32()), ("block", pa.int64()), ("level", pa.int32()),
                        ("n", pa.binary()), ("file", pa.string()), ("offset", pa.int64()), ("size", pa.int64())])
SLICE_WORDS = 1 << 16  # words of the documents that are scored together


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(a + GOLDEN) * GOLDEN + b)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def ranges(keys: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """(part, from, to) of sorted keys."""
    edges = np.searchsorted(part_of(keys, parts), np.arange(parts + 1))
    for k in np.flatnonzero(np.diff(edges)).tolist():
        yield k, int(edges[k]), int(edges[k + 1])


def kinds(n: np.ndarray) -> np.ndarray:
    """(len(n), 3) of 1 where a count is 1, 2, and 3 or more."""
    return np.stack([n == 1, n == 2, n >= 3], axis=1).astype(np.int64)


def sorted_places(keys: np.ndarray) -> np.ndarray:
    """The places of the keys in sorted order, equal ones in theirs: keys are sorted with their place in the lowest
    bits, which is faster than an indirect sort; where the bits it takes would tell keys apart, that is used."""
    keys = keys.astype(np.uint64, copy=False)
    place = (1 << len(keys).bit_length()) - 1
    moved = keys << np.uint64(64 - int(keys.max(initial=1)).bit_length())
    order = (np.sort(moved & np.uint64(~place & (1 << 64) - 1) | np.arange(len(keys), dtype=np.uint64)) & np.uint64(place)).astype(np.int64)
    held = keys[order]
    return order if (held[1:] >= held[:-1]).all() else np.argsort(keys, kind="stable")


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct keys, none negative, the first place of each, and the number among them of every key."""
    order = sorted_places(keys)
    held = keys[order]
    opens = np.ones(len(keys), bool)
    opens[1:] = held[1:] != held[:-1]
    at = np.empty(len(keys), np.int64)
    at[order] = np.cumsum(opens) - 1
    return held[opens], order[opens], at


def summed(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of ``values`` by ``at``."""
    if values.ndim == 1:
        return np.bincount(at, values, size).astype(np.int64)
    return np.stack([np.bincount(at, c, size) for c in values.T], axis=1).astype(np.int64)


def packed(figures: np.ndarray) -> bytes:
    """Small figures, a column after the other, compressed; their length stands in front."""
    raw = np.ascontiguousarray(figures.T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(held: bytes, dtype: type, columns: int) -> np.ndarray:
    raw = pa.decompress(held[8:], int.from_bytes(held[:8], "little"), "zstd", asbytes=True)
    return np.frombuffer(raw, dtype).reshape(columns, -1).T


def packed_counts(n: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, the lowest bytes of all first."""
    size = next(k for k in (1, 2, 4, 8) if int(n.max(initial=0)) < 1 << 8 * k)
    return bytes([size]) + packed(np.ascontiguousarray(n.T).astype(f"<u{size}").view(np.uint8).reshape(-1, size))


def unpacked_counts(held: bytes, columns: int) -> np.ndarray:
    flat = np.ascontiguousarray(unpacked(held[1:], np.uint8, held[0])).view(f"<u{held[0]}")
    return flat.astype(np.int64).reshape(columns, -1).T


def hash_bits(n_words: int, margin: int = MARGIN_BITS) -> int:
    return min(64, margin + int(n_words).bit_length())


def packed_keys(keys: np.ndarray, bits: int) -> bytes:
    """Sorted keys as differences, the lowest bytes of all first."""
    return packed(np.diff(keys >> np.uint64(64 - bits), prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8))


def unpacked_keys(held: bytes) -> np.ndarray:
    """The keys without the bits left out."""
    return np.cumsum(np.ascontiguousarray(unpacked(held, np.uint8, 8)).view(np.uint64).ravel(), dtype=np.uint64)


class BlockFile:
    """A task's blocks one after the other in a file of the shared folder, written whole
    under a name of the attempt; the rows that name it count only if the task ends well."""

    def __init__(self, folder: str):
        self.uri, self.at, self.out = f"{folder}/blocks-{uuid.uuid4().hex}", 0, None

    def write(self, held: bytes) -> tuple[str, int, int]:
        """Where the bytes lie: file, offset, size."""
        if self.out is None:
            fs, path = store(self.uri)
            self.out = fs.open_output_stream(path)
        self.out.write(held)
        self.at += len(held)
        return self.uri, self.at - len(held), len(held)

    def put(self, words: np.ndarray, ids: np.ndarray, spelled: np.ndarray, lengths: np.ndarray) -> tuple[str, int, int]:
        """Where the block lies: file, offset, size."""
        # common words have small ids; those met equally often lie in order of their hashes, kept as differences
        order = np.lexsort((words, -np.bincount(ids, minlength=len(words))))
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        # a word is 56 bits of its hash, its spelling's log p single precision
        parts = [packed(np.diff(words[order] >> np.uint64(8), prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)), packed(rank[ids].view(np.uint8).reshape(-1, 4)),
                 packed(spelled[order].astype(np.float32)), packed(lengths.astype(np.int64))]
        return self.write(np.array([len(x) for x in parts], np.int64).tobytes() + b"".join(parts))

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def read_range(uri: str, offset: int, size: int) -> bytes:
    fs, path = store(uri)
    with fs.open_input_file(path) as f:
        f.seek(offset)
        return f.read(size)


def read_block(place: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """words, ids, spelled, lengths."""
    held = read_range(place["file"], place["offset"], place["size"])
    edges = 32 + np.cumsum([0, *np.frombuffer(held[:32], np.int64).tolist()])
    words, ids, spelled, lengths = (held[a:z] for a, z in zip(edges.tolist(), edges[1:].tolist(), strict=False))
    return (unpacked_keys(words), np.ascontiguousarray(unpacked(ids, np.uint8, 4)).view(np.int32).ravel(),
            unpacked(spelled, np.float32, 1).ravel().astype(np.float64), unpacked(lengths, np.int64, 1).ravel())


class Grams:
    """The grams of a block: after a call of its level, the distinct ones and those of each word."""

    def __init__(self, words: np.ndarray, ids: np.ndarray, lengths: np.ndarray, bits: int):
        self.left_out = np.uint64(64 - bits)
        own = lengths[lengths > 0]
        self.starts = np.cumsum(own) - own  # the texts' first words
        self.words, self.ids = words, ids
        self.doc, self.spelled = np.repeat(np.arange(len(lengths)), lengths), ids
        self.gram = pair(self.before(words[ids], OPEN), words[ids])

    def before(self, values: np.ndarray, at_start: int | np.unsignedinteger) -> np.ndarray:
        """Of each word the value of that before it in its text."""
        out = np.roll(values, 1)
        out[self.starts] = at_start
        return out

    def short(self, keys: np.ndarray) -> np.ndarray:
        return keys >> self.left_out << self.left_out

    def trigrams(self) -> None:
        # the context of a word is the bigram that ends before it
        keys = pair(self.before(self.gram, pair(OPENS, OPENS)[0]), self.gram)
        self.tri, self.tri_first, self.tri_at = distinct(self.short(keys))
        self.tri_n = np.bincount(self.tri_at, minlength=len(self.tri))

    def bigrams(self) -> None:
        self.bi, _, at = distinct(self.short(np.concatenate([pair(OPENS, OPENS), self.gram])))
        self.gram_at, self.opening = at[1:], at[0]
        self.context_at = self.before(self.gram_at, self.opening)

    def unigrams(self) -> None:
        n = np.bincount(self.ids, minlength=len(self.words))
        used = np.flatnonzero(n)
        # words are 56 bits long: mixed, so that the first bits tell them apart
        self.uni, _, at = distinct(self.short(mix(np.concatenate([OPENS, self.words[used]]))))
        number = np.zeros(len(n), np.int64)
        number[used] = at[1:]
        self.word_at = number[self.ids]
        self.before_at = self.before(self.word_at, at[0])
        self.uni_n = summed(at[1:], n[used], len(self.uni))

    def words_from(self, first: int, to: int, doc: int) -> Grams:
        """The words first to to, where document doc begins, with what has been told of each; the distinct grams stay those of the block."""
        out = copy.copy(self)
        for name in ("doc", "spelled", "tri_at", "context_at", "gram_at", "before_at", "word_at"):
            setattr(out, name, getattr(self, name)[first:to])
        out.doc = out.doc - doc
        return out


def _rows(place: dict, keys: np.ndarray, n: np.ndarray, parts: int, bits: int) -> pa.Table:
    """What a block sends to each part: its keys there and their figures."""
    return _sent([(place["lang"], p, place["block"], packed_keys(keys[a:z], bits), packed_counts(n[a:z]), None, None)
                  for p, a, z in ranges(keys, parts)])


def _sent(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(SENT_ARROW)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, SENT_ARROW, strict=True)], schema=SENT_ARROW)


def shortened(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct first bits of sorted keys, and the number among them of every key."""
    short = keys >> np.uint64(64 - bits) << np.uint64(64 - bits)
    opens = np.ones(len(short), bool)
    opens[1:] = short[1:] != short[:-1]
    return short[opens], np.cumsum(opens) - 1


def _short_rows(place: dict, level: int, keys: np.ndarray, parts: int, short: int) -> pa.Table:
    """The first bits of a block's grams of a level: enough to tell most that no other block holds."""
    keys, _ = shortened(keys, short)
    return _sent([(place["lang"], p, place["block"], packed_keys(keys[a:z], short), None, level, None) for p, a, z in ranges(keys, parts)])


def _send_short(parts: int, bits: int, short: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.to_pylist():
                words, ids, _, lengths = read_block(place)
                g = Grams(words, ids, lengths, bits)
                g.trigrams()
                yield from _short_rows(place, 3, g.tri, parts, short).to_batches()
    return send


def _seen(rows: pa.Table, lang: str, part: int, level: int, file: BlockFile) -> list[tuple]:
    """For each block which of the short keys that it sent to a part another block sent too."""
    rows = rows.filter(pc.equal(rows.column("level"), level))
    if not len(rows):
        return []
    keys = [unpacked_keys(x) for x in rows.column("keys").to_pylist()]
    edges = np.cumsum([0, *map(len, keys)]).tolist()
    _, _, at = distinct(np.concatenate(keys))
    shared = (np.bincount(at) > 1)[at].astype(np.int64)
    return [_answer(file, lang, part, block, FILTERED[level], shared[a:z])
            for block, a, z in zip(rows.column("block").to_pylist(), edges, edges[1:], strict=False)]


def _filter(folder: str):
    def look(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        file = BlockFile(folder)
        out = _seen(rows, key[0].as_py(), key[1].as_py(), 3, file)
        file.close()
        return _made(out)
    return look


def _shared(keys: np.ndarray, rows: pa.Table, level: int, short: int) -> np.ndarray:
    """Which of a block's grams another block may hold too; no other gram is held by another block."""
    return _figures(rows, FILTERED[level], 1)[shortened(keys, short)[1], 0] == 1


def _with_unshared(shared: np.ndarray, answer: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The figures of all grams of a block: as answered, and its own where no other block holds the gram, for which it speaks."""
    out = np.ones((len(shared), answer.shape[1]), np.int64)
    out[:, :-1] = own.reshape(len(own), -1)
    out[shared] = answer
    return out


def _own_rows(place: dict, keys: np.ndarray, n: np.ndarray, shared: np.ndarray, parts: int, bits: int) -> pa.Table:
    """What a block sends of a level: its shared grams, and the counts of the counts of the others."""
    rows = _rows(place, keys[shared], n[shared], parts, bits)
    counts = n.reshape(len(n), -1)[~shared, -1]
    return pa.concat_tables([rows, _sent([(place["lang"], 0, place["block"], None, None, None, _tally(counts[counts > 0]))])])


def _send_trigrams(parts: int, bits: int, short: int):
    def send(key: tuple[pa.Scalar, ...], places: pa.Table, rows: pa.Table) -> pa.Table:
        place = places.to_pylist()[0]
        words, ids, _, lengths = read_block(place)
        g = Grams(words, ids, lengths, bits)
        g.trigrams(), g.bigrams()
        own = _own_rows(place, g.tri, g.tri_n, _shared(g.tri, rows, 3, short), parts, bits)
        return pa.concat_tables([own, _short_rows(place, 2, g.bi, parts, short)])  # bigrams are looked at in the same pass
    return send


def _figures(rows: pa.Table, level: int, columns: int) -> np.ndarray:
    """What the parts answered to a block's grams of a level, in the order of the grams."""
    rows = rows.filter(pc.equal(rows.column("level"), level)).sort_by("part")
    places = zip(*(rows.column(c).to_pylist() for c in ("file", "offset", "size")), strict=True)
    return np.concatenate([np.zeros((0, columns), np.int64), *(unpacked_counts(read_range(*place), columns) for place in places)])


def _upper_figures(g: Grams, rows: pa.Table, short: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The corpus figures of a block's trigrams, what these give to its bigrams, and which of these are shared."""
    tri = _with_unshared(_shared(g.tri, rows, 3, short), _figures(rows, 3, 2), g.tri_n)
    return tri, bigram_sums(g, tri), _shared(g.bi, rows, 2, short)


def followed(at: np.ndarray, n: np.ndarray, size: int) -> list[np.ndarray]:
    """Of each context the sum of its followers' counts, and how many of these are 1, 2, and 3 or more."""
    return [summed(at, n, size), *(np.bincount(at[held], minlength=size) for held in (n == 1, n == 2, n >= 3))]


def bigram_sums(g: Grams, answer: np.ndarray) -> np.ndarray:
    """What the trigrams that a block speaks for give to its bigrams: total, kinds 1 to 3, predecessors."""
    speaks = answer[:, 1] == 1
    n, first = answer[speaks, 0], g.tri_first[speaks]
    context, gram = g.context_at[first], g.gram_at[first]
    return np.column_stack([*followed(context, n, len(g.bi)), summed(gram, np.where(context == g.opening, n, 1), len(g.bi))])


def word_sums(g: Grams, answer: np.ndarray) -> np.ndarray:
    """What the bigrams that a block speaks for give to its words, and the words' own counts.
    Every bigram of the corpus that a block holds is the end of a trigram there."""
    last = np.full(len(g.bi), -1)
    last[g.gram_at] = np.arange(len(g.gram_at))
    speaks = (answer[:, 5] == 1) & (last >= 0)
    n, last = answer[speaks, 4], last[speaks]
    return np.column_stack([*followed(g.before_at[last], n, len(g.uni)), np.bincount(g.word_at[last], minlength=len(g.uni)), g.uni_n])


def _send_lower(level: int, parts: int, bits: int, short: int):
    """The bigrams (2) or words (1) of a block, once the level above has been answered."""
    def send(key: tuple[pa.Scalar, ...], places: pa.Table, rows: pa.Table) -> pa.Table:
        place = places.to_pylist()[0]
        words, ids, _, lengths = read_block(place)
        g = Grams(words, ids, lengths, bits)
        g.trigrams(), g.bigrams()
        _, sums, shared = _upper_figures(g, rows, short)
        if level == 2:
            return _own_rows(place, g.bi, sums, shared, parts, bits)
        g.unigrams()
        return _rows(place, g.uni, word_sums(g, _with_unshared(shared, _figures(rows, 2, 6), sums)), parts, bits)
    return send


def _tally(n: np.ndarray) -> bytes:
    """Counts of the counts 1 to 4, their sum, kinds 1 to 3."""
    return np.array([*((n == k).sum() for k in (1, 2, 3, 4)), n.sum(), *kinds(n).sum(axis=0)], np.int64).tobytes()


def _met(rows: pa.Table, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple]]:
    """The part's sorted keys, their sums, the keys of each block in these, whether that block
    speaks for them, and (language, block, from, to)."""
    keys = [unpacked_keys(x) for x in rows.column("keys").to_pylist()]
    sums = np.concatenate([unpacked_counts(x, columns) for x in rows.column("n").to_pylist()])
    edges = np.cumsum([0, *map(len, keys)]).tolist()
    unique, first, at = distinct(np.concatenate(keys))
    speaks = np.zeros(len(at), np.int64)
    speaks[first] = 1
    blocks = zip(rows.column("lang").to_pylist(), rows.column("block").to_pylist(), edges, edges[1:], strict=False)
    return unique, summed(at, sums, len(unique)), at, speaks, list(blocks)


def _answer(file: BlockFile, lang: str, part: int, block: int, level: int, figures: np.ndarray) -> tuple:
    return (ANSWER, lang, part, block, level, None, *file.write(packed_counts(figures)))


def _tallied(lang: str | None, part: int, level: int, n: bytes) -> tuple:
    return (TALLY, lang, part, None, level, n, None, None, None)


def _made(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), MADE_ARROW, strict=True)], schema=MADE_ARROW)


def _count(level: int, folder: str):
    """A part of the trigrams (3) or bigrams (2) of a language."""
    def count(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lang, part, file = key[0].as_py(), key[1].as_py(), BlockFile(folder)
        own = rows.filter(pc.is_valid(rows.column("tally")))
        tally = sum((np.frombuffer(x, np.int64) for x in own.column("tally").to_pylist()), np.zeros(8, np.int64))
        out = _seen(rows, lang, part, 2, file)
        rows = rows.filter(pc.is_valid(rows.column("n")))
        if len(rows):
            _, sums, at, speaks, blocks = _met(rows, 1 if level == 3 else 5)
            n = sums[:, -1]
            out += [_answer(file, lang, part, block, level, np.column_stack([sums[at[a:z]], speaks[a:z]])) for _, block, a, z in blocks]
            tally = tally + np.frombuffer(_tally(n[n > 0]), np.int64)  # marks before a text are no gram
        file.close()
        return _made([*out, _tallied(lang, part, level, tally.tobytes())])
    return count


def _words(folder: str):
    """A part of the words of all languages: the sixth figure is a word's count in the whole corpus."""
    def words(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        part, out, file = key[0].as_py(), [], BlockFile(folder)
        _, n, at, _, blocks = _met(rows, 6)
        n, corpus_at = n[:, 5], {block: at[a:z] for _, block, a, z in blocks}
        for lang in pc.unique(rows.column("lang")).to_pylist():
            _, sums, own_at, _, own = _met(rows.filter(pc.equal(rows.column("lang"), lang)), 6)
            out += [_answer(file, lang, part, block, 1, np.column_stack([sums[own_at[a:z], :5], n[corpus_at[block]]])) for _, block, a, z in own]
            out.append(_tallied(lang, part, 1, _tally(sums[:, 4])))
        file.close()
        return _made([*out, _tallied(None, part, 0, np.array([n.sum(), (n > 0).sum()], np.int64).tobytes())])
    return words


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts for counts 0, 1, 2 and 3 or more."""
    if min(n1, n2, n3) == 0:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    d = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, [0, 0.05, 0.1, 0.15], [0, 0.95, 1.9, 2.9])


def _level(n, own_n, total, own_total, kind, cut, below):
    """Interpolated probability of counts ``own_n`` in contexts of ``own_total`` and ``kind``."""
    seen = own_total > 0
    least = np.maximum(own_total, 1)
    weight = np.where(seen, (kind[:, 0] * cut[1] + kind[:, 1] * cut[2] + kind[:, 2] * cut[3]) / least, 1.0)
    return np.where(seen, (own_n - cut[np.minimum(own_n, 3)]) / least, 0.0) + weight * below


def document_scores(g: Grams, spelled: np.ndarray, n_docs: int, tri: np.ndarray, bi: np.ndarray, uni: np.ndarray,
                    tally: dict[int, np.ndarray]) -> np.ndarray:
    """Sum of log p of each document's words by the model of all other documents.

    ``tri``, ``bi`` and ``uni`` are the corpus figures of the block's distinct grams,
    ``spelled`` log p of its words by their characters, ``tally`` that of the language."""
    cut = {k: discounts(*tally[k][:4]) for k in (1, 2, 3)}

    # distinct trigrams of each document, then its bigrams, then its words: (document, gram)
    _, first, at = distinct(g.doc * max(len(g.tri), 1) + g.tri_at)
    own = np.bincount(at, minlength=len(first))
    doc, context, gram = g.doc[first], g.context_at[first], g.gram_at[first]
    n3 = tri[g.tri_at[first]].astype(np.int64)
    left3 = n3 - own
    c_key, _, c_at = distinct(doc * len(g.bi) + context)
    change3 = summed(c_at, np.column_stack([own, kinds(n3) - kinds(left3)]), len(c_key))
    total3 = bi[context, 0] - change3[c_at, 0]
    kind3 = bi[context, 1:4] - change3[c_at, 1:]

    s_key, s_first, s_at = distinct(doc * len(g.bi) + gram)
    gone = summed(s_at, np.where(context == g.opening, own, left3 == 0), len(s_key))
    s_doc, s_bi = doc[s_first], gram[s_first]
    before, word = g.before_at[first][s_first], g.word_at[first][s_first]
    n2 = bi[s_bi, 4]
    left2 = n2 - gone
    u_key, _, u_at = distinct(s_doc * len(g.uni) + before)
    change2 = summed(u_at, np.column_stack([gone, kinds(n2) - kinds(left2)]), len(u_key))
    total2 = uni[before, 0] - change2[u_at, 0]
    kind2 = uni[before, 1:4] - change2[u_at, 1:]

    w_key, w_first, w_at = distinct(s_doc * len(g.uni) + word)
    w_doc = s_doc[w_first]
    n1 = uni[word[w_first], 4]
    left1 = n1 - summed(w_at, (left2 == 0).astype(np.int64), len(w_key))
    change1 = summed(w_doc, np.column_stack([n1 - left1, kinds(n1) - kinds(left1)]), n_docs)
    total1 = tally[1][4] - change1[w_doc, 0]
    kind1 = tally[1][5:8] - change1[w_doc, 1:]

    own0 = summed(s_at, own, len(s_key))
    own0 = summed(w_at, own0, len(w_key))
    in_doc = summed(w_doc, own0, n_docs)[w_doc]
    n0, types = tally[0]
    p0 = (uni[word[w_first], 5] - own0 + types * np.exp(spelled[g.spelled[first][s_first][w_first]])) / (n0 - in_doc + types)
    p1 = _level(n1, left1, total1, total1, kind1, cut[1], p0)
    p2 = _level(n2, left2, total2, total2, kind2, cut[2], p1[w_at])
    p3 = _level(n3, left3, total3, total3, kind3, cut[3], p2[s_at])
    return np.bincount(doc, own * np.log(np.maximum(p3, 1e-300)), n_docs)


def document_slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``most`` words, or of one document."""
    ends, at = np.cumsum(lengths), 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(ends, most + ends[at] - lengths[at], "right")))
        yield at, to
        at = to


def block_scores(g: Grams, spelled: np.ndarray, lengths: np.ndarray, tri: np.ndarray, bi: np.ndarray, uni: np.ndarray,
                 tally: dict[int, np.ndarray]) -> np.ndarray:
    """``document_scores`` of all documents of a block, some at a time: what that takes does not grow with the block."""
    ends, out = np.cumsum(lengths), []
    for at, to in document_slices(lengths, SLICE_WORDS):
        own = g.words_from(int(ends[at] - lengths[at]), int(ends[to - 1]), at)
        out.append(document_scores(own, spelled, to - at, tri, bi, uni, tally))
    return np.concatenate(out)


def _finish(tallies: dict[str, dict[int, np.ndarray]], bits: int, short: int):
    def finish(key: tuple[pa.Scalar, ...], places: pa.Table, rows: pa.Table) -> pa.Table:
        place = places.to_pylist()[0]
        words, ids, spelled, lengths = read_block(place)
        g = Grams(words, ids, lengths, bits)
        g.trigrams(), g.bigrams(), g.unigrams()
        tri, sums, shared = _upper_figures(g, rows, short)
        bi = _with_unshared(shared, _figures(rows, 2, 6), sums)
        sums = block_scores(g, spelled, lengths, tri[:, 0], bi, _figures(rows, 1, 6), {**tallies[None], **tallies[place["lang"]]})
        sums = [s / n if n else None for s, n in zip((-sums).tolist(), lengths.tolist(), strict=True)]
        return pa.table({"block": pa.array([place["block"]] * len(lengths), pa.int64()),
                         "place": pa.array(range(len(lengths)), pa.int32()), "log_ppl": pa.array(sums, pa.float64())})
    return finish


def _keep(folder: str):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = BlockFile(folder)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ids, lengths = np.frombuffer(r["ids"], np.int32), np.array(r["lengths"], np.int64)
                rows.append((r["block"], r["lang"], len(ids), *file.put(np.frombuffer(r["words"], np.uint64), ids,
                                                                        np.frombuffer(r["spelled"], np.float64), lengths)))
            if rows:
                names = ("block", "lang", "n_words", "file", "offset", "size")
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)
        file.close()
    return keep


def score_blocks(blocks: DataFrame, folder: str) -> DataFrame:
    """block, place, log_ppl (log-perplexity a word, null without words) for every document of
    ``blocks``: block, lang, words (hashes of distinct words), ids (places in words), lengths
    (words of each document), spelled (log p of distinct words by characters)."""
    return score_kept(stage(blocks.select("block", "lang", "words", "ids", "spelled", "lengths").mapInArrow(_keep(folder), KEPT), folder, "kept"),
                      folder)


def score_kept(kept: DataFrame, folder: str) -> DataFrame:
    """The same for blocks that lie in files: block, lang, n_words, file, offset, size."""
    kept = kept.filter("n_words > 0")
    n_words, n_blocks = kept.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.count("*")).first()
    parts, bits, short = max(LEAST_PARTS, ceil(n_words / PART_WORDS)), hash_bits(n_words), hash_bits(n_words, FILTER_BITS)
    # rows here are places of a few MB each, so tasks are told by blocks, not by bytes
    tasks = max(8, ceil(n_blocks / 4))
    places = kept.select(*PLACE).repartition(tasks, "block")
    sent = places.mapInArrow(_send_short(parts, bits, short), SENT)
    told = stage(sent.groupBy("lang", "part").applyInArrow(_filter(folder), MADE), folder, "words-shared")
    for level, by, send, count in ((3, ("lang", "part"), _send_trigrams(parts, bits, short), _count(3, folder)),
                                   (2, ("lang", "part"), _send_lower(2, parts, bits, short), _count(2, folder)),
                                   (1, ("part",), _send_lower(1, parts, bits, short), _words(folder))):
        above = told.filter(F.col("kind") == ANSWER).repartition(tasks, "block")
        sent = places.groupBy("block").cogroup(above.groupBy("block")).applyInArrow(send, SENT)
        told = told.unionByName(stage(sent.groupBy(*by).applyInArrow(count, MADE), folder, f"words-{level}"))
    tallies: dict[str, dict[int, np.ndarray]] = {}
    figures = told.filter(F.col("kind") == TALLY).select("lang", "level", "n").groupBy("lang", "level").applyInArrow(_added, "lang string, level int, n binary")
    for r in figures.collect():  # three rows a language, one for all
        tallies.setdefault(r.lang, {})[r.level] = np.frombuffer(r.n, np.int64)
    answers = told.filter(F.col("kind") == ANSWER).repartition(tasks, "block").groupBy("block")
    return places.groupBy("block").cogroup(answers).applyInArrow(_finish(tallies, bits, short), "block long, place int, log_ppl double")


def _added(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in rows.column("n").to_pylist())
    return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "level": pa.array([key[1].as_py()], pa.int32()), "n": [total.tobytes()]})
