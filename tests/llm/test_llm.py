"""Each operator against a brute-force version on small tables with awkward rows."""

import base64
import hashlib
import importlib
import io
import json
import random
import re
import zipfile
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from zonewatch.llm import (
    bpe_tree, chat, cuckoo, kn_rules, kn_words, line_dedup, minhash, packing, pu_quality, sharding, warc_zip)
from zonewatch.llm.common import mix, run_folder, stage

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, kept boolean, score double, _salt int"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def awkward_rows():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdeéü") for _ in range(rng.randint(1, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    texts = [None, "", "   ", "\n\n", "one", "One", "a b c d", "x " * 3000, prose(6000), "w" * 5000, "中文 混合 text 🙂\x1c\xa0end"]
    base = prose(200)
    words = base.split()
    for k in range(40):  # near copies, each with an edit of its own
        own = list(words)
        own[rng.randrange(len(own))] = f"edit{k}"
        texts.append(" ".join(own))
    texts += [base, base.upper(), base, base.replace(" ", "\n", 3)] * 3
    for _ in range(60):
        texts.append(prose(rng.randint(1, 120)) + "\nshared footer line\n" + prose(rng.randint(1, 30)))
    rows = [(k, t, rng.choice(["en", "fr", None]), rng.choice(["s0", "s0", "s1", "s2", "s3", "s4", "s5", None]), 0, "x", False, 0.5, 3)
            for k, t in enumerate(texts)]
    rows += [(None, "no id", "en", "s0", 0, "x", False, 0.5, 3), (None, "no id", None, None, 0, "x", False, 0.5, 3), (5, "One", "en", "s0", 0, "x", False, 0.5, 3)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return awkward_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def key(row):
    return tuple((v is not None, v) for v in row)


def as_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


# --- 6: exact dedup ------------------------------------------------------------------------


def test_exact_groups(docs, rows, none):
    digest = [hashlib.sha256((r[1] or "").encode().lower()).hexdigest() for r in rows]
    groups = {}
    for d, r in zip(digest, rows, strict=True):
        groups.setdefault(d, []).append(r[0])
    want = []
    for d, r in zip(digest, rows, strict=True):
        keep = max((i for i in groups[d] if i is not None), default=None)
        want.append((r[0], keep, len(groups[d]), r[0] == keep, d))
    got = cuckoo.exact_groups(docs).withColumn("sha", F.lower(F.hex("digest")))
    assert as_rows(got, "doc_id", "keep_id", "group_size", "kept", "sha") == sorted(want, key=key)
    assert cuckoo.exact_groups(none).count() == 0


def test_cuckoo_index_inserts_deletes_and_resizes():
    rng = random.Random(3)
    index, live = cuckoo.DigestIndex(buckets=2), {}
    for step in range(6000):
        if live and step % 5 == 0:
            gone = rng.choice(list(live))
            assert index.delete(gone, 9)
            del live[gone]
        else:
            digest = rng.randbytes(32) if rng.random() < 0.8 or not live else rng.choice(list(live))
            index.insert(digest, 9, step, 1, [0])
            live[digest] = live.get(digest, 0) + 1
    assert {e[0]: e[3] for e in index.entries()} == live
    assert index.resizes > 3 and index.filter.size == len(live)
    assert all(index.find(d, 9) for d in live) and not index.delete(b"?" * 32, 9)
    assert all(index.find(rng.randbytes(32), 9) is None for _ in range(3000))


def test_hits_are_verified_against_the_content():
    index = cuckoo.DigestIndex()
    first, twin = b"k" * 8 + b"a" * 24, b"k" * 8 + b"b" * 24  # one key, two texts
    index.insert(first, 1, 1, 1, [])
    assert index.find(twin, 1) is None and index.false_hits == 1
    index.insert(twin, 1, 2, 1, [])
    assert index.delete(first, 1) and index.find(twin, 1)[2] == 2


def test_index_updates(spark):
    def texts(*pairs):
        return spark.createDataFrame(list(pairs), "doc_id long, text string")

    first = cuckoo.update_index(None, texts((1, "a"), (2, "B"), (3, "c")))
    second = cuckoo.update_index(first, texts((4, "A"), (5, "c")), deleted=texts((0, "b"), (0, "C")))
    assert sorted((r.keep_id, r.copies) for r in second.collect()) == [(4, 2), (5, 1)]


# --- 3: near dedup -------------------------------------------------------------------------


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(*(words[k:] for k in range(5)), strict=False)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute_components(rows):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    sets = {r[0]: shingle_set(r[1]) for r in rows if r[0] is not None}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}, sets


def near_rows():
    """Copies around the threshold of hubs that link them, so that a bucket's first member
    does not settle it, and a chain."""
    rng = random.Random(11)
    out = []
    for _ in range(6):
        hub = [f"w{rng.randrange(10**9)}" for _ in range(150)]
        for _ in range(30):
            own = list(hub)
            for _ in range(rng.choice([1, 2, 2, 3])):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10**9)}"
            out.append(" ".join(own))
        out.append(" ".join(hub))
    chain = [f"c{k}" for k in range(400)]
    out += [" ".join(chain[k:k + 100]) for k in range(0, 300, 6)]
    rng.shuffle(out)
    return [(k, t) for k, t in enumerate(out)]


@pytest.mark.parametrize("which", ["awkward", "near"])
def test_near_duplicates(spark, rows, docs, which):
    if which == "near":
        rows = near_rows()
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    else:  # one id, one text
        rows = [r for r in rows if r[0] != 5 or r[1] != "One" or r[3] != "s0" or r[2] != "en"]
        docs = spark.createDataFrame(rows, DOCS).repartition(4)
    want, sets = brute_components(rows)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    named = {r.doc_id: r for r in got if r.doc_id is not None}
    assert {i: r.component_id for i, r in named.items()} == want
    assert all(r.n_shingles == len(sets[i]) and r.kept == (i == r.component_id) for i, r in named.items())
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)


def test_near_duplicates_of_nothing(none):
    assert minhash.near_duplicates(none).count() == 0


def test_sketch_fills_every_coordinate_and_estimates():
    sets = [np.unique(mix(np.arange(a, b, dtype=np.uint64))) for a, b in ((0, 1), (0, 3), (0, 2000), (500, 2500))]
    rows = minhash.sketch(sets)
    assert (rows != minhash.EMPTY).all()
    assert abs((rows[2] == rows[3]).mean() - 0.6) < 0.2
    alone = minhash.sketch(sets[2:3])
    assert (alone[0] == rows[2]).all()


def test_block_links_span_exactly():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(50)]
    both = minhash.overlaps(sets[:20], sets[20:])
    assert all(both[i, j] == len(np.intersect1d(sets[i], sets[20 + j])) for i in range(20) for j in range(30))


# --- 10: quality rules ---------------------------------------------------------------------


def brute_base(text):
    data, text = (text or "").encode(), text or ""
    words = WORD.findall(data)
    lines = [x for x in data.split(b"\n") if WORD.search(x)]
    windows = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
    marked = {p for k in range(len(words) - 7) if windows[tuple(words[k:k + 8])] > 1 for p in range(k, k + 8)}
    return (len(words), sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", text))), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(marked))


def test_quality_rules_base(docs, rows, none):
    got = kn_rules.quality_rules(docs)
    want = []
    for r in rows:
        base = brute_base(r[1])
        want.append((r[0], *base, base[0] < 20 or 100 * base[4] > 30 * base[0]))
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert as_rows(got, *columns) == sorted(want, key=key)
    assert got.filter("base_failed and kept").count() == 0
    assert kn_rules.quality_rules(none).count() == 0


def test_perplexity_bands_reject_noise_and_keep_prose(spark):
    rng = random.Random(2)
    prose = [" ".join(rng.choice(["river", "stone", "evening", "was", "the", "walking", "home"]) for _ in range(80)) for _ in range(200)]
    noise = ["".join(rng.choice("#@~^`{}[]\\+=|;:<>") + rng.choice("QXZ94") for _ in range(300)).replace("9", " ") + " x" * 25]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(prose + noise)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.kept for r in kn_rules.quality_rules(docs).collect() if not r.base_failed}
    assert not got[200] and all(v for k, v in got.items() if k < 200)


def test_kneser_ney_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([("en", "abc abd abe xyz ab abc 12, A-b"), (None, "ab")], "lang string, text string")
    levels = {k: ([], []) for k in range(1, 5)}
    for r in kn_rules.ngram_counts(docs).filter("lang = 'en'").collect():
        levels[r.level][0].append(r.gram)
        levels[r.level][1].append(r.n)
    model = kn_rules.build_arrays({k: (np.array(g, np.uint32), np.array(n)) for k, (g, n) in levels.items()})
    for context in list(model["c4"]) + [np.uint32(123456)]:
        grams = (np.uint32(context) << np.uint32(6)) | np.arange(64, dtype=np.uint32)
        assert abs(kn_rules._probability(model, 4, grams).sum() - 1) < 1e-9
    assert levels[4][1] and sum(levels[4][1]) == sum(len(w) + 1 for w in "abc abd abe xyz ab abc 12, A-b".split())


def brute_word_ppl(docs, me, spelled):
    """log-perplexity a word of ``docs[me]`` by the model of the others, from plain counts."""
    def padded(words):
        return [None, None, *words]

    def counts(texts):
        tri = Counter(g for w in texts for p in [padded(w)] for g in zip(p, p[1:], p[2:]))
        bi, uni = Counter(), Counter()
        for (a, b, c), n in tri.items():
            bi[b, c] += n if a is None and b is None else 1
        for (_, c) in bi:
            uni[c] += 1
        return {3: tri, 2: bi, 1: Counter({(c,): n for c, n in uni.items()})}

    cut = {k: kn_words.discounts(*((np.array(list(v.values())) == m).sum() for m in (1, 2, 3, 4))) for k, v in counts(docs).items()}
    others = [d for k, d in enumerate(docs) if k != me]
    model = counts(others)
    flat, types = Counter(w for d in others for w in d), len({w for d in docs for w in d})

    def p(gram):
        if not gram:
            raise AssertionError
        k = len(gram)
        below = p(gram[1:]) if k > 1 else (flat[gram[0]] + types * np.exp(spelled[gram[0]])) / (sum(flat.values()) + types)
        followers = [n for g, n in model[k].items() if g[:-1] == gram[:-1]]
        if not followers:
            return below
        n = model[k][gram]
        free = sum(cut[k][min(m, 3)] for m in followers)
        return (n - cut[k][min(n, 3)] + free * below) / sum(followers)

    own = padded(docs[me])
    return -sum(np.log(p(g)) for g in zip(own, own[1:], own[2:])) / len(docs[me])


def test_word_model_leaves_each_document_out(spark):
    rng = random.Random(8)
    docs = [rng.choices("a b c d e f g hapax1 hapax2".split(), [9, 8, 7, 6, 5, 4, 3, 1, 1], k=rng.randint(1, 60)) for _ in range(25)]
    docs += [docs[3], ["only", "here"], ["a"]]
    places = {w: k for k, w in enumerate(sorted({w for d in docs for w in d}))}
    spelled = {w: -2.0 - len(w) for w in places}
    rows = []
    for block, members in enumerate((docs[:9], docs[9:20], [*docs[20:], []])):  # three blocks, one with an empty text
        ids = np.array([places[w] for d in members for w in d], np.int32)
        rows.append((block, "x", mix(np.arange(1, len(places) + 1, dtype=np.uint64)).tobytes(), ids.tobytes(),
                     np.array([spelled[w] for w in places]).tobytes(), [len(d) for d in members]))
    blocks = spark.createDataFrame(rows, "block long, lang string, words binary, ids binary, spelled binary, lengths array<int>")
    got = {(r.block, r.place): r.log_ppl for r in kn_words.score_blocks(blocks, run_folder(spark, "test")).collect()}
    assert got.pop((2, len(docs) - 20)) is None and len(got) == len(docs)
    for k, at in enumerate(sorted(got)):
        assert abs(got[at] - brute_word_ppl(docs, k, spelled)) < 1e-9


def test_rules_see_words_and_their_order(spark):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("aeioubdglmnrst", k=rng.randint(2, 9))) for _ in range(3000)]
    weight = [1 / (k + 1) for k in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, weight, k=300)) for _ in range(300)]
    seen = sorted({w for t in texts for w in t.split()})
    odd = [" ".join(rng.choices(seen, k=300)), " ".join(str(rng.randrange(10 ** 6)) for _ in range(300)),
           " ".join(w.upper() for w in rng.choices(seen, k=300))]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts + odd)], "doc_id long, text string, lang string")
    rows = {r.doc_id: r for r in kn_rules.quality_rules(docs).collect()}
    assert all(rows[k].kept for k in range(300)) and not any(rows[k].kept for k in (300, 301, 302))
    line = "the old river runs past the mill and the quiet stone bridge at evening when boats come slowly home again".split()
    again = [" ".join(rng.sample(line, len(line))) for _ in range(2)]
    docs = spark.createDataFrame([(k, " ".join(line) + f" {k}x", "en") for k in range(30)] + [(30 + k, t, "en") for k, t in enumerate(again)],
                                 "doc_id long, text string, lang string")
    ppl = {r.doc_id: r.log_ppl for r in kn_rules.quality_rules(docs).collect()}
    assert min(ppl[30], ppl[31]) > max(ppl[k] for k in range(30)) + 1


# --- 1: quality classifier -----------------------------------------------------------------


def labelled(spark, n=900):
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(n):
        words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(10, 60))]
        good = rng.random() < 0.8
        rows.append((k, " ".join(words) if good else " ".join(w + rng.choice(["###", "$$$"]) for w in words), "x"))
        if rng.random() < 0.5:
            labels.append((k, int(good), None))
    rows += [(None, None, "x"), (n, "", "x")]
    labels += [(None, 1, None), (0, None, None)]
    return (spark.createDataFrame(rows, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows)


def test_classifier_separates_and_ignores_held_out_labels(spark):
    docs, labels, rows = labelled(spark)
    model = pu_quality.fit(docs, labels)
    assert 0.7 < model.prior < 0.92
    got = pu_quality.score_documents(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, *_ in rows if k is not None)
    right = sum(by_id[k].predicted == int("#" not in t and "$" not in t) for k, t, _ in rows[:900])
    assert right > 880
    flipped = labels.withColumn("quality", F.when(pu_quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (pu_quality.fit(docs, flipped).weights == model.weights).all()


def test_classifier_without_positives_or_rows(spark):
    docs, labels, _ = labelled(spark, 40)
    model = pu_quality.fit(docs, labels.filter("quality = 0"))
    assert {r.score for r in pu_quality.score_documents(docs, model).collect()} == {1.0}
    assert pu_quality.score_documents(docs.limit(0), pu_quality.fit(docs.limit(0), labels)).count() == 0


def test_non_negative_risk_steps_back():
    slope = pu_quality.nn_risk_slope(np.array([4.0, 4.0, -6.0, -6.0]), 2, 0.9)
    assert (slope[:2] > 0).all() and (slope[2:] < 0).all()


def test_blocks_are_scored_some_documents_at_a_time(monkeypatch):
    """No step takes more words at once than a slice, and the scores are those of the whole block."""
    rng = np.random.default_rng(3)
    lengths = np.array([0, 7, 300, 0, 40, 41, 1, 0])
    words, ids = rng.integers(0, 1 << 60, 30).astype(np.uint64), rng.integers(0, 30, lengths.sum())
    g = kn_words.Grams(words, ids, lengths, 60)
    g.trigrams(), g.bigrams(), g.unigrams()
    tri, bi = 2 * g.tri_n, 50 + np.arange(6 * len(g.bi)).reshape(-1, 6) % 7
    uni = 90 + np.arange(6 * len(g.uni)).reshape(-1, 6) % 5
    tally = {0: np.array([9000, 30]), **{k: np.array([9, 5, 4, 3, 9000, 9, 5, 70]) for k in (1, 2, 3)}}
    spelled = -rng.random(30) * 9
    whole = kn_words.document_scores(g, spelled, len(lengths), tri, bi, uni, tally)
    taken, scores = [], kn_words.document_scores

    def noted(own, *rest):
        taken.append(len(own.doc))
        return scores(own, *rest)

    monkeypatch.setattr(kn_words, "document_scores", noted)
    monkeypatch.setattr(kn_words, "SLICE_WORDS", 80)
    assert kn_words.block_scores(g, spelled, lengths, tri, bi, uni, tally).tolist() == whole.tolist()
    assert max(x for x in taken if x != 300) <= 80 and sum(taken) == lengths.sum()


def test_answers_are_written_once(spark, tmp_path):
    """A part's answer is a place in a file; the rows that are shuffled hold no figures."""
    place = {"lang": "en", "block": 4}
    sent = kn_words._rows(place, np.array([5 << 40, 9 << 50], np.uint64), np.array([1, 3]), 1, 64)
    made = kn_words._count(3, str(tmp_path))((pa.scalar("en"), pa.scalar(0)), sent).to_pylist()
    answer, tally = made
    assert answer["n"] is None and answer["block"] == 4 and tally["kind"] == kn_words.TALLY
    rows = pa.Table.from_pylist([answer], kn_words.MADE_ARROW)
    assert kn_words._figures(rows, 3, 2).tolist() == [[1, 1], [3, 1]]


def test_repeated_words_of_many_documents():
    rng = np.random.default_rng(8)
    lengths = np.array([0, 3, 8, 9, 200, 64, 0, 90])
    ids = rng.integers(0, 2, lengths.sum())
    want, at = [], 0
    for n in lengths.tolist():
        doc = ids[at:at + n].tolist()
        windows = [tuple(doc[k:k + 8]) for k in range(n - 7)]
        want.append(len({k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}))
        at += n
    assert kn_rules.repeated_words(ids, lengths).tolist() == want and sum(want) > 100


def test_rules_of_null_and_empty_texts_of_a_language_that_passes(spark):
    good = " ".join(f"word{k}" for k in range(40))
    docs = spark.createDataFrame([(k, "en", f"{good} {k}") for k in range(30)] + [(90, "en", None), (91, "en", ""), (92, None, None)],
                                 "doc_id long, lang string, text string")
    rows = {r.doc_id: r for r in kn_rules.quality_rules(docs).collect()}
    assert len(rows) == 33 and sum(r.kept for r in rows.values()) == 30
    assert all(rows[k].n_words == 0 and rows[k].base_failed and not rows[k].kept for k in (90, 91, 92))


# --- 8: packing ----------------------------------------------------------------------------


def test_packing(docs, rows, none):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(WORDS)
    got = packing.pack_documents(docs, WORDS).collect()
    want = Counter()
    for r in rows:
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        for at in range(0, len(ids), 2048):
            part = ids[at:at + 2048]
            want[r[0], at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(none, WORDS).count() == 0


def test_word_ids_equal_whole_texts():
    ids, rng = packing.WordIds(WORDS), random.Random(5)
    parts = ["a", "Word", "THE", ",", ".", "..", "'s", "'LL", "\u0130", "\u0391\u03a3", "H\u0331", "E\u0301", "<|endoftext|>", "<|ENDOFTEXT|>",
             "\u4e2d", "3", "\xbd", "\xa0", "\x1c", "_", "x" * 70]
    for _ in range(1500):
        text = "".join(rng.choice(parts) + rng.choice(["", "", " ", "\n", "  "]) for _ in range(rng.randint(0, 14)))
        assert ids.encode(text.encode()) == np.array(ids.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_tokenizers_of_another_kind_get_whole_texts(tmp_path):
    other = json.loads(Path(WORDS).read_text(encoding="utf-8"))
    other["normalizer"] = {"type": "Sequence", "normalizers": [{"type": "NFC"}]}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(other), encoding="utf-8")
    ids = packing.WordIds(str(path))
    assert not ids.by_word and packing.WordIds(WORDS).by_word
    for text in ("", "Two Words.\n", "THE end ... ,"):
        assert ids.encode(text.encode()) == np.array(ids.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_words_of_plain_texts_are_kept_once():
    """Whatever their case and the signs around them, also with Latin-1 letters."""
    ids = packing.WordIds(WORDS)
    text = "Word, word. WORD word*** Word. \xc9t\xe9, \xe9t\xe9. It's 'word' it's 7"
    ids.encode(text.encode())
    assert set(ids.words) == {b"word", b",", b".", b"***", b"\xe9t\xe9", b"it", b"'s", b"'", b"7"}
    odd = ["don''t x's.'s 'S", "a<|endoftext|>B", "J\u030c j\u030c \u0130 I\u0307", "\xd7a\xf7 \xaa\xb5", "\xc3\xa9 \xe9", "a\xa0b\x85c\x1cd", ""]
    for t, held in zip(odd, ids.encode_all([t.encode() for t in odd]), strict=True):
        assert held == np.array(ids.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_word_ids_of_slices_with_signs_and_old_words(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 50)
    ids, rng = packing.WordIds(WORDS), random.Random(6)
    ends = ["", ".", "...", ",\"", "***", "&&&", "'", "'.", "'s", "<|", "|>", "\u0338", "\u2026", ".9", "-"]
    for _ in range(60):
        texts = [" ".join(rng.choice(["the", "It", "\xc9t\xe9", "A3", "3", "e\u0301", "y" * 90, "", "x<|endoftext|>"]) + rng.choice(ends)
                          for _ in range(rng.randint(0, 30))) for _ in range(4)]
        want = [np.array(ids.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert ids.encode_all([t.encode() for t in texts]) == want


def test_best_fit_takes_the_tightest_room():
    rng = random.Random(9)
    lengths = sorted((rng.randint(1, 2048) for _ in range(3000)), reverse=True)
    rooms = []
    for length, (sequence, offset) in zip(lengths, packing.best_fit(lengths), strict=True):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            assert 2048 - offset == min(fitting)
            rooms[sequence] -= length
        else:
            assert (sequence, offset) == (len(rooms), 0)
            rooms.append(2048 - length)
    assert sum(lengths) / (2048 * len(rooms)) > 0.98


# --- 7: byte-level BPE ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tree_bpe_documents(docs, rows, none, library):
    coded = bpe_tree.encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    want = sorted(((r[0], library.encode_ordinary(r[1] or "")) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = sorted(((r.doc_id, r.ids) for r in coded.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == want
    texts = bpe_tree.decode_documents(coded, RANKS, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, bytes(r.text)) for r in texts) == Counter((r[0], (r[1] or "").encode()) for r in rows)
    digests = bpe_tree.round_trip_digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests) == Counter(
        (r[0], len(i := library.encode_ordinary(r[1] or "")), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(),
         hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in rows)
    assert bpe_tree.round_trip_digests(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_tree_bpe_at_any_cut(library, monkeypatch):
    bpe, rng = bpe_tree.ByteBPE(RANKS, public_tokenizers.PATTERN), random.Random(1)
    parts = [" ", "  ", "\n", " \n", "'s", "'re", "'", "r", "e", "a", "aa" * 30, "é", "中", "1", "12 3", "!?", "\x1c", "\xa0", "　", "🙂",
             "zq" * 40, "\t", "ing", "the "]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        monkeypatch.setattr(bpe_tree, "LEAF", rng.choice([1, 2, 3, 7, 8192]))
        monkeypatch.setattr(bpe_tree, "PIECE", rng.choice([1, 2, 3, 6, 48]))
        for kept in (bpe.matches, bpe.short, bpe.seams):
            kept.clear()
            kept.old = {}
        ids = bpe.encode(text).tolist()
        assert ids == library.encode_ordinary(text), repr(text)
        assert bpe.decode(ids) == text.encode()


def test_both_engines_split_alike():
    split, rng = bpe_tree.Splitter(public_tokenizers.PATTERN), random.Random(2)
    latin = [chr(c) for c in range(0x250)]
    for k in range(0x250):
        text = f"a {chr(k)}{chr(k)}b 1{chr(k)} .{chr(k)}  {chr(k)}'s"
        assert split.latin(text) == split.any(text), k
    for _ in range(2000):
        text = "".join(rng.choice(latin) for _ in range(30))
        assert split.latin(text) == split.any(text)
    assert split.beyond("a\u0250") and not split.beyond("a\u024f")


def test_tree_bpe_of_long_matches(library):
    bpe, rng = bpe_tree.ByteBPE(RANKS, public_tokenizers.PATTERN), random.Random(6)
    for text in ("a" * 5000, "ab" * 4000, " " * 9000, "\n \n" * 3000, "".join(rng.choice("abcdefghij") for _ in range(20000)), "é" * 3000):
        assert bpe.encode(text).tolist() == library.encode_ordinary(text)


# --- 2: archives ---------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, path string, refers_to string"


def page_rows():
    long_text = "<p>é" + "x" * 1200
    return [(1, "http://a/1", long_text), (2, "http://a/2", long_text), (3, None, long_text), (4, "http://b/\r\nX: y", "short"),
            (5, "http://b/5", "short"), (6, "http://b/6", None), (7, "http://b/7", ""), (None, "http://c", long_text),
            (8, "http://d/8", "a\r\n\r\nb\x00" + "z" * 70000), (2, "http://a/2", long_text), (9, "u", "y" * 999), (10, "u", "y" * 999),
            (11, "u", "y" * 1000), (12, "u", "y" * 1000)]


def test_archives_round_trip(spark):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES).repartition(3)
    folder = run_folder(spark, "test-warc")
    manifest = stage(warc_zip.write_archives(pages, folder), folder, "manifest")
    got = warc_zip.read_archives(manifest).collect()
    largest = {}
    for page, _, html in rows:
        largest[html] = max(largest.get(html, page or 0), page or 0)
    want = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        target = largest[html] if len(data) >= 1000 and page is not None and page < largest[html] else None
        want[page, len(data), hashlib.sha1(data).hexdigest(), "response" if target is None else "revisit", target] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert Counter(bytes(r.payload) for r in got if r.record_type == "response") == Counter(
        (html or "").encode() for page, _, html in rows if not (len((html or "").encode()) >= 1000 and page is not None and page < largest[html]))
    assert sum(r.records for r in manifest.collect()) == len(rows)
    assert warc_zip.pages_through_archives(spark, pages.limit(0)).count() == 0


def test_zip64_directories_and_comments(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 200)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 3)
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"PK\x05\x06 not the end"
        for k in range(9):
            z.writestr(f"archive/m{k}é.warc.gz", bytes([k]) * (100 * k + 1))
    data = held.getvalue()
    assert b"PK\x06\x06" in data
    members = warc_zip.directory(io.BytesIO(data), len(data))
    assert [m.name for m in members] == [f"archive/m{k}é.warc.gz" for k in range(9)]
    for k, m in enumerate(members):
        at = warc_zip.data_offset(io.BytesIO(data), m)
        assert data[at:at + m.size] == bytes([k]) * (100 * k + 1)
    with pytest.raises(ValueError):
        warc_zip.directory(io.BytesIO(data[:-9]), len(data) - 9)


def test_archive_without_index_and_large_archives(spark, monkeypatch):
    monkeypatch.setattr(warc_zip, "MEMBER_BYTES", 500)
    monkeypatch.setattr(warc_zip, "ARCHIVE_BYTES", 1500)
    folder = run_folder(spark, "test-walk")
    for indexed in (False, True):
        writer = warc_zip.ArchiveWriter(folder, indexed)
        for k in range(60):
            writer.add(warc_zip.make_record(k, None, f"page {k} ".encode() * k, None))
        writer.close()
        assert len(writer.done) > 2
        manifest = spark.createDataFrame(writer.done, "path string, records long")
        got = {r.page_id: bytes(r.payload) for r in warc_zip.read_archives(manifest).collect()}
        assert got == {k: f"page {k} ".encode() * k for k in range(60)}


# --- 4: sharding ---------------------------------------------------------------------------


@pytest.mark.parametrize("range_rows", [16_384, 7])
def test_sharding(docs, rows, none, monkeypatch, range_rows):
    monkeypatch.setattr(sharding, "RANGE_ROWS", range_rows)
    got = sharding.interleave(docs).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    source = {r[0]: r[3] for r in rows if r[0] is not None}
    mixture = Counter((source[r.doc_id], r.shard) for r in got if r.doc_id is not None)
    for name, n in Counter(source.values()).items():
        assert all(abs(mixture[name, s] - n / 16) <= 2 for s in range(16))
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert sharding.interleave(none).count() == 0


def test_sharding_does_not_depend_on_the_ranges(docs, monkeypatch):
    ids = "doc_id is not null and doc_id <> 5"
    first = as_rows(sharding.interleave(docs.filter(ids)), "doc_id", "shard", "slot")
    monkeypatch.setattr(sharding, "RANGE_ROWS", 5)
    assert as_rows(sharding.interleave(docs.filter(ids).repartition(2)), "doc_id", "shard", "slot") == first


# --- 5: line dedup -------------------------------------------------------------------------


@pytest.mark.parametrize("min_sites", [2, 5])
def test_line_dedup(docs, rows, none, min_sites):
    blank = " \t\r\x0b\x0c"
    sites = {}
    for r in rows:
        for line in (r[1] or "").split("\n"):
            sites.setdefault(line.strip(blank), set()).add(r[3])
    common = {x for x, s in sites.items() if x and len(s - {None}) >= min_sites}
    assert "shared footer line" in common
    want = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        left = [x for x in lines if x.strip(blank) not in common]
        want.append((r[0], None if r[1] is None else "\n".join(left), 0 if r[1] is None else len(lines), len(lines) - len(left)))
    got = line_dedup.remove_common_lines(docs, min_sites)
    assert as_rows(got, "doc_id", "text", "n_lines", "n_dropped") == sorted(want, key=key)
    assert line_dedup.remove_common_lines(none).count() == 0


def test_line_spread_far_above_and_near_the_threshold(spark):
    lines = spark.range(0, 300).select(F.lit(1).cast("long").alias("h1"), F.lit(1).cast("long").alias("h2"), F.col("id").cast("string").alias("site"))
    for k, n in ((2, 199), (3, 200), (4, 201), (5, 100)):
        lines = lines.unionByName(spark.range(0, n).select(F.lit(k).cast("long").alias("h1"), F.lit(1).cast("long").alias("h2"), F.col("id").cast("string").alias("site")))
    assert sorted(r.h1 for r in line_dedup.common_lines(lines, 200).collect()) == [1, 3, 4]


# --- 9: chat -------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, block string, kind string"


def chat_rows():
    rng = random.Random(8)
    out = []

    def talk(conv, n, size, system):
        for t in range(n):
            role = "system" if system and t == 0 else "user" if t % 2 else "assistant"
            out.append((conv, t, role, " ".join(rng.choice(["yes", "<s>", "</s>[INST]", "\\", "[/INST] ", "\n", "é🙂"]) for _ in range(rng.randint(0, size)))))

    talk(0, 8, 20, True)
    talk(1, 900, 40, True)
    talk(2, 600, 5, False)
    talk(3, 3, 4000, True)
    out += [(4, None, "user", None), (4, 1, None, "a"), (4, 1, "assistant", ""), (4, 1, "assistant", "b"), (4, 1, "assistant", "b"),
            (None, 0, "user", "x"), (5, 0, "system", "alone")]
    return out


def test_chat_windows_read_back(spark):
    rows = chat_rows()
    turns = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS).repartition(6)
    windows = stage(chat.format_conversations(turns, RANKS, public_tokenizers.PATTERN), run_folder(spark, "test-chat"), "w")
    got = {r.conv_id: r for r in chat.read_back(windows).collect()}
    by_conv = {}
    for r in sorted(rows, key=key):
        by_conv.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert set(got) == set(by_conv)
    chars = Counter()
    for w in windows.collect():
        chars[w.conv_id] += len(w.text)
        parsed = chat.parse_window(w.text)
        assert w.n_tokens <= chat.BUDGET or len(parsed) == w.n_repeat + 1
        system = by_conv[w.conv_id][0][0] == "system"
        assert not system or parsed[0] == by_conv[w.conv_id][0]
        assert w.n_repeat <= chat.HISTORY_TURNS + system
        if w.conv_id == 2 and (w.block, w.window) != (0, 0):
            assert w.n_repeat == 2
    for conv, said in by_conv.items():
        target = "".join(t for role, t in said if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(said), hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in said).encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256, r.formatted_chars) == (len(target), hashlib.sha256(target.encode()).hexdigest(), chars[conv])
    empty = chat.format_conversations(turns.limit(0), RANKS, public_tokenizers.PATTERN)
    assert chat.read_back(empty).count() == 0


def test_escaping_is_reversible_and_hides_controls():
    rng = random.Random(12)
    parts = ["<", "s", ">", "/", "[", "INST", "]", "\\", "<s>", "[/INST]", "\n", "ok"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        held = chat.escape(text)
        assert chat.unescape(held) == text and not any(c in held for c in chat.CONTROLS)
        assert chat.parse_window(chat.format_turn(text, text)[0]) == [(text, text)]


# --- the pipeline --------------------------------------------------------------------------


def test_pipeline_stages_equal_their_operators(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("kept", F.lit("mine"))
    first = pipeline.quality_rules(spark, docs, sf)
    assert first.columns == docs.columns
    good = {r.doc_id for r in kn_rules.quality_rules(docs).filter("kept").collect()}
    assert {r.doc_id for r in first.collect()} == good
    third = pipeline.exact_dedup(spark, docs, sf)
    texts = [(r.text or "").encode().lower() for r in docs.collect()]
    assert third.count() == len(set(texts)) and third.columns == docs.columns
    fourth = pipeline.near_dedup(spark, third, sf)
    want, _ = brute_components([(r.doc_id, r.text) for r in third.collect()])
    assert {r.doc_id for r in fourth.collect()} == set(want.values())


def test_pipeline_tells_rows_apart_without_ids(spark, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    rng = random.Random(13)
    vocabulary = ["".join(rng.choices("aeioubdglmnrst", k=rng.randint(2, 8))) for _ in range(300)]

    def prose():
        return " ".join(rng.choices(vocabulary, k=80))

    clean = [prose() for _ in range(40)]
    near = [clean[5] + " end", clean[6] + " end"]
    rows = [(k if k >= 10 else None, t) for k, t in enumerate(clean)]  # ten null ids
    rows += [(None, "too short"), (12, "too short"), (12, prose())]  # rejected with a null and a repeated id
    schema, whole = "doc_id long, text string, lang string, source string, n_chars long", [r[1] for r in rows if r[1] != "too short"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema).repartition(3)
    assert sorted(r.text for r in pipeline.quality_rules(spark, docs, "").collect()) == sorted(whole)

    rows = [(None, clean[0]), (None, clean[0]), (7, clean[0]), (None, clean[1]), (None, clean[1].upper()), (3, clean[2]), (3, clean[2]),
            (3, clean[3]), (4, clean[4]), (9, clean[4])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema).repartition(3)
    got = pipeline.exact_dedup(spark, docs, "")
    assert got.columns == docs.columns
    assert as_rows(got.selectExpr("doc_id", "lower(text) AS text"), "doc_id", "text") == sorted(
        [(7, clean[0]), (None, clean[1]), (3, clean[2]), (3, clean[3]), (9, clean[4])], key=key)

    rows = [(None, clean[5]), (None, near[0]), (None, clean[6]), (5, near[1]), (8, clean[7]), (8, clean[7]), (8, clean[8])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema).repartition(3)
    got = [(r.doc_id, r.text) for r in pipeline.near_dedup(spark, docs, "").collect()]
    assert len(got) == 4 and (5, near[1]) in got and (8, clean[7]) in got and (8, clean[8]) in got
    assert {t for i, t in got if i is None} < {clean[5], near[0]}

    noise = ["".join(rng.choice("#$%&*") for _ in range(6)) for _ in range(50)]
    rows = [(k, prose() if k % 2 else " ".join(rng.choices(noise, k=80))) for k in range(400)]
    labels = [(k, 1, 0) for k in range(1, 300, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows += [(None, clean[0]), (None, " ".join(rng.choices(noise, k=80))), (401, clean[1]), (401, " ".join(rng.choices(noise, k=80)))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema).repartition(3)
    got = [(r.doc_id, r.text) for r in pipeline.quality_classifier(spark, docs, str(tmp_path)).collect()]
    assert [t for i, t in got if i is None] == [clean[0]] and [t for i, t in got if i == 401] == [clean[1]]


def test_pipeline_runs_whole(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    out = pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = out.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n"))
    assert whole.count() > 100 and whole.filter("n <> doc_tokens").count() == 0


def test_queries_have_one_entry_an_operator():
    queries = importlib.import_module("zonewatch.llm.queries")
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES] == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
