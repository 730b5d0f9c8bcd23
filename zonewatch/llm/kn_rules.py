"""Quality rules (operator 10): base rules and perplexity bands of Kneser-Ney models.

Words.  ``kn_words`` counts the word n-grams of all documents up to order 3 and
scores every document by the model of all others: log_ppl, -sum(log p) / words.

Characters.  For every language, a modified Kneser-Ney model of order 4 over the
characters inside words, with marks for a word's start and end; the word model
spells unknown words with it.  Characters are folded into 63 symbols (small
letters, capitals as one, digits as one, each common sign of its own, other
characters by remainder), so an n-gram is a 24-bit key and a model has at most
64**4 of them however large the corpus is.  Spark counts the 4-grams of all
documents (tasks add up distinct words first, the group-by adds up tasks);
continuation counts of the lower orders and the counts of counts are group-bys
over the n-gram types.  One task a language turns its rows into sorted arrays of
keys, probabilities and back-off weights and writes them to the shared folder;
scorers load the languages they meet.  Its figure is -sum(log p) / symbols.

Verdict.  Within a language the quartiles over all documents that pass the base
rules give the bands, widened for short documents by 1 + SHORT / sqrt(words).
By characters it is [q1 - LOWER * r, q3 + UPPER * r], r = max(q3 - q1, MIN_RANGE).
By words it ends at q3 + WORD_UPPER * max(q3 - q2, MIN_RANGE), exact copies counted
once, and has no lower end: a copy is well foreseen, and left to the dedup
operators.  Outside a band a document is rejected.

Base rules: fewer than 20 words, or more than 30 % of the words inside 8-word
windows that occur twice or more in the text.

Cases: null or empty text has no words and fails the base rules; a null
language is a language of its own; a null doc_id stays null.  The same row
twice counts twice.  Extra columns are ignored.  An empty table gives an empty
result.
"""

from __future__ import annotations

import io
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.llm import kn_words
from zonewatch.llm.common import SPACE, mix, put_file, remove_folder, run_folder, stage, store, utf8

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
LOWER, UPPER, MIN_RANGE, SHORT = 8.0, 20.0, 0.02, 8.0
WORD_UPPER = 5.0

ORDER = 4
START, END, OTHER = 1, 2, 52
SIGNS = ".,'\"-()!?/|#*$%&<>:;"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that do not begin a character
VOCABULARY = 300_000
SALTS = 256
BLOCK_BYTES, WAITING_BYTES = 4 << 20, 16 << 20  # text of a block, and of all that are being filled


def _classes() -> np.ndarray:
    out = np.full(128, OTHER - 1, np.uint32)
    out[ord("a"):ord("z") + 1] = np.arange(3, 29)
    out[ord("A"):ord("Z") + 1] = 29
    out[ord("0"):ord("9") + 1] = 30
    for k, sign in enumerate(SIGNS):
        out[ord(sign)] = 31 + k
    return out


CLASSES = _classes()


def fold(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """4-gram keys of the words, one for each symbol predicted, and the word of each key."""
    pad = b"\x00" * (ORDER - 1)
    text = (pad + (b"\x01" + pad).join(words) + b"\x01").decode("utf-8", "replace") if words else ""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    symbols = np.where(points < 128, CLASSES[np.minimum(points, 127)], OTHER + points % 12).astype(np.uint32)
    symbols[points == 0] = START
    symbols[points == 1] = END
    if not len(symbols):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    keys = symbols.copy()
    for back in range(1, ORDER):
        keys[back:] |= symbols[:-back] << np.uint32(6 * back)
    predicted = symbols != START
    owner = np.cumsum(symbols == END) - (symbols == END)
    return keys[predicted], owner[predicted]


def _clean(words: list[bytes]) -> list[bytes]:
    """The two marks are not characters of words."""
    whole = b" ".join(words)
    if b"\x00" not in whole and b"\x01" not in whole:
        return words
    return [w.replace(b"\x00", b"?").replace(b"\x01", b"?") for w in words]


COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int32()), ("n", pa.int64())])


def _count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """4-gram counts of a task's documents, by language."""
    words: dict[str, Counter] = {}
    grams: dict[str, np.ndarray] = {}

    def add(lang: str) -> None:
        counter = words.pop(lang)
        seen = list(counter)
        keys, owner = fold(_clean(seen))
        weight = np.fromiter(counter.values(), np.float64, len(seen))[owner]
        old = grams.get(lang)
        if old is not None:
            keys, weight = np.concatenate([old[0].astype(np.uint32), keys]), np.concatenate([old[1], weight])
        unique, at = np.unique(keys, return_inverse=True)
        grams[lang] = (unique, np.bincount(at, weight, len(unique)))

    for part in parts:
        langs, texts = part.column(0).to_pylist(), utf8(part.column(1))
        for lang, text in zip(langs, texts, strict=True):
            counter = words.setdefault(lang or "", Counter())
            counter.update(text.split())
            if len(counter) > VOCABULARY:
                add(lang or "")
    for lang in list(words):
        add(lang)
    for lang, (keys, n) in grams.items():
        for at in range(0, len(keys), 50_000):
            k = keys[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.astype(np.int32)),
                                              pa.array(n[at:at + 50_000].astype(np.int64))], schema=COUNTS)


def ngram_counts(docs: DataFrame) -> DataFrame:
    """lang, level (1 to 4), gram, n: raw counts at the top and for grams that open a word,
    below the number of distinct symbols that precede the gram."""
    top = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), "text").mapInArrow(
        _count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    levels = [top.withColumn("level", F.lit(ORDER))]
    for level in range(ORDER - 1, 0, -1):
        size = 6 * level
        lower = F.col("gram").bitwiseAND((1 << size) - 1)
        levels.append(levels[-1].groupBy("lang", lower.alias("gram")).agg(
            F.sum("n").alias("raw"), F.count("*").alias("types")).select(
            "lang", "gram", F.when(F.shiftright("gram", size - 6) == START, F.col("raw")).otherwise(F.col("types")).alias("n"),
            F.lit(level).alias("level")))
    out = levels[0]
    for other in levels[1:]:
        out = out.unionByName(other)
    return out


def _discounts(n: np.ndarray) -> np.ndarray:
    """Discounts for counts 1, 2 and 3 or more, from the counts of counts."""
    n1, n2, n3, n4 = ((n == k).sum() for k in (1, 2, 3, 4))
    if min(n1, n2, n3) == 0:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    d = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, [0, 0.05, 0.1, 0.15], [0, 0.95, 1.9, 2.9])


def build_arrays(levels: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[str, np.ndarray]:
    """Sorted keys with interpolated probabilities, and sorted contexts with back-off weights."""
    model: dict[str, np.ndarray] = {}
    lower = np.full(64, 1 / 64)  # order 0: any symbol
    for level in range(1, ORDER + 1):
        keys, n = levels[level]
        order = np.argsort(keys)
        keys, n = keys[order].astype(np.uint32), n[order].astype(np.float64)
        context, at = np.unique(keys >> np.uint32(6), return_inverse=True)
        total = np.bincount(at, n, len(context))
        cut = _discounts(n)[np.minimum(n, 3).astype(int)]
        gamma = np.bincount(at, cut, len(context)) / total
        below = keys & np.uint32((1 << 6 * (level - 1)) - 1)
        base = lower[keys & np.uint32(63)] if level == 1 else _probability(model, level - 1, below)
        model[f"k{level}"], model[f"p{level}"] = keys, (n - cut) / total[at] + gamma[at] * base
        model[f"c{level}"], model[f"g{level}"] = context, gamma
    return model


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _probability(model: dict[str, np.ndarray], level: int, grams: np.ndarray) -> np.ndarray:
    """p(last symbol | those before) of n-grams of ``level`` symbols."""
    if level == 0:
        return np.full(len(grams), 1 / 64)
    at, known = _find(model[f"k{level}"], grams)
    out = model[f"p{level}"][at]
    if not known.all():
        rest = grams[~known]
        where, seen = _find(model[f"c{level}"], rest >> np.uint32(6))
        weight = np.where(seen, model[f"g{level}"][where], 1.0)
        out[~known] = weight * _probability(model, level - 1, rest & np.uint32((1 << 6 * (level - 1)) - 1))
    return out


def _model_file(folder: str, lang: str) -> str:
    return f"{folder}/kn-{lang.encode().hex() or 'none'}.npz"


def _builder(folder: str):
    def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        level, gram, n = (rows.column(c).to_numpy() for c in ("level", "gram", "n"))
        levels = {k: (gram[level == k].astype(np.uint32), n[level == k]) for k in range(1, ORDER + 1)}
        held = io.BytesIO()
        np.savez(held, **build_arrays(levels))
        put_file(_model_file(folder, lang), held.getvalue())
        return pa.table({"lang": [lang], "n_grams": pa.array([len(level)], pa.int64())})
    return build


def build_models(docs: DataFrame, folder: str) -> DataFrame:
    """Write a model file for each language into ``folder``; lang, n_grams."""
    counts = ngram_counts(docs)
    return stage(counts.groupBy("lang").applyInArrow(_builder(folder), "lang string, n_grams long"), folder, "models")


class _Scorer:
    """A language's model and the scores of the words met so far."""

    def __init__(self, folder: str, lang: str):
        self.file, self.model = _model_file(folder, lang), None
        self.ids: dict[bytes, int] = {}
        self.scores, self.hashes = np.zeros(0), np.zeros(0, np.uint64)

    def learn(self, words: set[bytes]) -> None:
        if len(self.ids) > VOCABULARY:
            self.ids, self.scores, self.hashes = {}, np.zeros(0), np.zeros(0, np.uint64)
        new = [w for w in words if w not in self.ids]
        if not new:
            return
        if self.model is None:  # a language without words has none
            fs, path = store(self.file)
            with fs.open_input_file(path) as f, np.load(io.BytesIO(f.read())) as held:
                self.model = {k: held[k] for k in held.files}
        grams, owner = fold(_clean(new))
        met, _, at = kn_words.distinct(grams)  # words share most of their 4-grams
        scores = np.bincount(owner, np.log(_probability(self.model, ORDER, met))[at], len(new))
        self.ids.update(zip(new, range(len(self.ids), len(self.ids) + len(new)), strict=True))
        self.scores = np.concatenate([self.scores, scores])
        self.hashes = np.concatenate([self.hashes, np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))])


def repeated_words(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each document the words inside windows of ``WINDOW`` words that occur twice or more in it."""
    own = np.repeat(np.arange(len(lengths)), lengths)
    count = max(len(ids) - WINDOW + 1, 0)
    at = np.flatnonzero(own[:count] == own[WINDOW - 1:])  # windows that lie in one document
    if len(at) < 2:
        return np.zeros(len(lengths), np.int64)
    h, width = mix(ids.astype(np.uint64) + np.uint64(1)), 1
    while width < WINDOW:  # windows of twice the width from two neighbours
        h, width = kn_words.pair(h[:-width], h[width:]), 2 * width
    _, _, number = kn_words.distinct(kn_words.pair(own[at].astype(np.uint64), h[at]))
    starts = np.bincount(number)[number] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[at] += starts
    edge[at + WINDOW] -= starts
    return np.bincount(own, np.cumsum(edge)[:-1] > 0, len(lengths)).astype(np.int64)


def base_counts(text: bytes) -> tuple[int, int, int]:
    """word_chars, n_symbols, n_dup_lines."""
    solid = text.translate(None, SPACE)
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return len(solid.translate(None, CONTINUATION)), len(solid) - len(solid.translate(None, SYMBOLS)), len(lines) - len(set(lines))


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ROW = pa.struct([("doc_id", pa.int64()), *[(c, pa.int64()) for c in FIGURES], ("base_failed", pa.bool_()), ("char_ppl", pa.float64())])
SCHEMA = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("file", pa.string()),
                    ("offset", pa.int64()), ("size", pa.int64()), ("docs", pa.list_(ROW))])
BLOCKS = (f"{kn_words.KEPT}, docs array<struct<doc_id: long, " + "".join(f"{c}: long, " for c in FIGURES)
          + "base_failed: boolean, char_ppl: double>>")


def _blocks(folder: str):
    """Blocks of documents of one language, with their words and all that needs no other block."""
    def block_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers: dict[str, _Scorer] = {}
        waiting: dict[str, list[tuple[int | None, bytes]]] = {}
        held: Counter = Counter()
        file = kn_words.BlockFile(folder)
        block, filling = TaskContext.get().partitionId() << 32, 0

        def made(lang: str) -> pa.RecordBatch:
            nonlocal block, filling
            if lang not in scorers:
                if len(scorers) >= 8:
                    scorers.pop(next(iter(scorers)))
                scorers[lang] = _Scorer(folder, lang)
            own, members = scorers[lang], waiting.pop(lang)
            filling -= held.pop(lang)
            split = [text.split() for _, text in members]
            own.learn(set().union(*split))
            lengths = np.array([len(words) for words in split])
            ids = np.fromiter(map(own.ids.__getitem__, chain.from_iterable(split)), np.int64, lengths.sum())
            ends, docs = np.cumsum(lengths).tolist(), []
            repeats = [n for at, to in kn_words.document_slices(lengths, kn_words.SLICE_WORDS)
                       for n in repeated_words(ids[ends[at] - lengths[at]:ends[to - 1]], lengths[at:to]).tolist()]
            for (doc_id, text), end, n, repeated in zip(members, ends, lengths.tolist(), repeats, strict=True):
                base = n, *base_counts(text), repeated
                failed = base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEAT_PERCENT * base[0]
                ppl = -float(own.scores[ids[end - n:end]].sum()) / (base[1] + base[0]) if n else None
                docs.append({"doc_id": doc_id, **dict(zip(FIGURES, base, strict=True)), "base_failed": failed, "char_ppl": ppl})
            met = np.bincount(ids, minlength=len(own.ids)) > 0
            used, places = np.flatnonzero(met), (np.cumsum(met) - 1)[ids]
            where = file.put(own.hashes[used], places, own.scores[used], lengths)
            block += 1
            row = (block - 1, lang, len(places), *where, docs)
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, SCHEMA, strict=True)], schema=SCHEMA)

        for part in parts:
            for doc_id, lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), utf8(part.column(2)), strict=True):
                waiting.setdefault(lang, []).append((doc_id, text))
                held[lang] += len(text) + 64
                filling += len(text) + 64
                if held[lang] >= BLOCK_BYTES:
                    yield made(lang)
                elif filling >= WAITING_BYTES:
                    yield made(held.most_common(1)[0][0])
        for lang in list(waiting):
            yield made(lang)
        file.close()
    return block_rows


def quality_rules(docs: DataFrame, lower: float = LOWER, upper: float = UPPER, word_upper: float = WORD_UPPER) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept, log_ppl."""
    folder, scratch = (run_folder(docs.sparkSession, name) for name in ("rules", "rules-model"))
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].alias("lang"), docs["text"].alias("text"))
    build_models(docs, scratch)
    blocks = stage(docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), "text").mapInArrow(
        _blocks(scratch), BLOCKS), scratch, "blocks")
    by_words = kn_words.score_kept(blocks, scratch)
    by_chars = blocks.select("block", "lang", F.posexplode("docs").alias("place", "doc")).select("block", "place", "lang", "doc.*")
    scored = stage(by_chars.join(by_words, ["block", "place"], "left"), folder, "scored")
    remove_folder(docs.sparkSession, scratch)  # the scores are written; models and blocks are not read again
    passed = scored.filter("not base_failed")
    by_char = passed.groupBy("lang").agg(F.percentile_approx("char_ppl", [0.25, 0.75], 10_000).alias("c"))
    by_word = passed.select("lang", "n_words", "log_ppl").distinct().groupBy("lang").agg(
        F.percentile_approx("log_ppl", [0.5, 0.75], 10_000).alias("w"))
    # a language may hold most documents: its one row of quartiles is copied to every salt
    quartiles = by_char.join(by_word, "lang").select(
        F.col("lang").alias("_lang"), "c", "w", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    wider = 1 + SHORT / F.sqrt(F.greatest("n_words", F.lit(1)))  # without words a document fails the base rules
    q1, q3 = F.col("c")[0], F.col("c")[1]
    spread = F.greatest(q3 - q1, F.lit(MIN_RANGE)) * wider
    w2, w3 = F.col("w")[0], F.col("w")[1]
    foreseen = F.col("log_ppl") <= w3 + word_upper * F.greatest(w3 - w2, F.lit(MIN_RANGE)) * wider
    inside = F.col("char_ppl").between(q1 - lower * spread, q3 + upper * spread) & foreseen
    salt = F.pmod(F.xxhash64(scored["doc_id"], scored["n_words"], scored["word_chars"]), F.lit(SALTS))
    return scored.join(quartiles, (scored["lang"] == quartiles["_lang"]) & (salt == quartiles["_salt"]), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"), "log_ppl")
