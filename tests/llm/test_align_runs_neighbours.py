"""Operators 11 to 13 against brute-force versions on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from zonewatch.llm import periodic, queries, token_align, vptree

WORD = re.compile(r"[^\x20\x09-\x0D]+")
A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, slice long, pair long, words string, collapsed string"


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, v) for v in r))


def awkward_rows():
    rng = random.Random(23)
    vocabulary = ["".join(rng.choice("abcdeéß中") for _ in range(rng.randint(1, 8))) for _ in range(150)]

    def prose(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\n", ", ", ". ", "\t"]) for _ in range(n))

    phrase = prose(9) + " "
    texts = [None, "", " ", "\n", "   \n\n ", "x", "x " * 3000, "a b " * 40 + "c", phrase * 7, prose(30) + phrase * 12 + prose(30), prose(9000), "w" * 4000,
             "two  spaces \n here\n\n x \xa0 nb \x1c fs", " ▁x y", "a▁b", "<|endoftext|> <s> a</s> <unk> <0x0A>", "a　 b 🙂🙂 é ẛ̣ ﬁ", "\x00 a \x00b", "don't we'll  'tis"]
    texts += [prose(rng.randint(1, 90)) for _ in range(120)]
    rows = [(k, t, "en", 1, 2, "w", "c") for k, t in enumerate(texts)]
    return rows + [(None, "no id", "en", 1, 2, "w", "c"), (None, "x " * 40, None, 1, 2, "w", "c"), (5, "x", "en", 1, 2, "w", "c"), (-3, prose(40), "en", 1, 2, "w", "c")]


@pytest.fixture(scope="module")
def rows():
    return awkward_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


# --- 11: alignment -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in plain)}
    names = {i: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t, i in a.get_vocab().items()}

    def of_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    def encode(text):
        if not text:
            return [], []
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        x, y = [(i, names[i]) for i in x], [(i, of_b(i)) for i in y]
        return (x, y) if b"".join(t for _, t in x) == b"".join(t for _, t in y) == (" " + text).encode() else ([], [])
    return encode


def spans(tokens):
    out, at = [], 0
    for i, t in tokens:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def brute_alignment(rows, encode):
    found, counts = [], Counter()
    for doc_id, text, *_ in rows:
        a, b = map(spans, encode(text))
        links, j = [], 0
        for x, s, e in a:
            while j < len(b) and b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((x, b[k][0]))
                k += 1
        counts.update(links)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        group = {e: k for k, e in enumerate(ends)}
        texts = [[[] for _ in ends] for _ in range(2)]
        for held, side in zip(texts, (a, b), strict=True):
            k = 0
            for i, _, e in side:
                held[k].append(str(i))
                k += e in group
        groups = ["|".join(map(",".join, g)) for g in zip(*texts, strict=True)]
        found.append((doc_id, len(a), len(b), len(ends), links, groups))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [(doc_id, n_a, n_b, n, len(links), sum(counts[x, y] == best[y] for x, y in links), sum(counts[k] for k in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for doc_id, n_a, n_b, n, links, groups in found]


def test_alignment(docs, rows, libraries, spark):
    got = as_rows(token_align.align_tokenizers(docs, A_FILE, B_FILE))
    assert got == sorted(brute_alignment(rows, libraries), key=lambda r: tuple((v is not None, v) for v in r))
    none = token_align.align_tokenizers(spark.createDataFrame([], DOCS), A_FILE, B_FILE)
    assert none.count() == 0 and none.columns == [c.split()[0] for c in token_align.RESULT.split(", ")]


def test_alignment_over_many_slices(spark, rows, libraries, monkeypatch):
    short = [r for r in rows if 0 < len(r[1] or "") < 2000]
    pair = token_align.TokenizerPair(A_FILE, B_FILE)
    whole = token_align.aligned(pair.encode([r[1].encode() for r in short]), pair)
    parts = [token_align.aligned(pair.encode([r[1].encode()]), pair) for r in short]
    for c in ("n_a", "n_b", "n_groups", "n_links"):
        assert whole[c].tolist() == [int(p[c][0]) for p in parts]
    assert whole["groups"] == [p["groups"][0] for p in parts]
    sums = Counter()
    for p in parts:
        sums.update(dict(zip(p["pairs"].tolist(), p["sums"].tolist(), strict=True)))
    assert dict(zip(whole["pairs"].tolist(), whole["sums"].tolist(), strict=True)) == sums


def test_gallop_is_the_rank():
    rng = random.Random(1)
    for _ in range(300):
        short, long = (np.array(sorted(rng.sample(range(900), rng.randint(0, most))), np.int64) for most in (200, 500))
        assert token_align.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()


# --- 12: runs ------------------------------------------------------------------------------


def brute_runs(words, min_length=24, turns=3):
    found = {}
    for p in range(1, len(words) // turns + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            found.setdefault((i, j + p), p)  # the smallest period first
            i = j + 1
    return sorted(((s, e - s, p) for (s, e), p in found.items() if e - s >= max(min_length, turns * p)), key=lambda r: (r[0], r[2]))


def brute_digests(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    return (doc_id, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def test_runs_query(spark, rows, tmp_path):
    short = [r for r in rows if len(WORD.findall(r[1] or "")) < 4000]
    more = short + [(k, t, *r) for k, (_, t, *r) in enumerate(short * 3, 1000)]
    spark.createDataFrame(more, DOCS).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = as_rows(queries.op12_lyndon_runs(spark, str(tmp_path)))
    want = sorted((brute_digests(r[0], r[1]) for r in more), key=lambda r: tuple((v is not None, v) for v in r))
    assert got == want and sum(r[1] > 0 for r in want) > 30


def test_runs_operator(docs, spark):
    got = {r.doc_id: r for r in periodic.periodic_runs(docs.filter("doc_id in (6, 7, 8)")).collect()}
    assert [tuple(r) for r in got[6].runs] == [(0, 3000, 1)] and bytes(got[6].collapsed) == b"x"
    assert [tuple(r) for r in got[7].runs] == [(0, 80, 2)] and bytes(got[7].collapsed) == b"a b c"
    assert tuple(got[8].strongest) == (0, 63, 9)
    assert periodic.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0


def naive_lyndon(x):
    out = []
    for i in range(len(x)):
        j = i + 1
        while j < len(x) and x[j:] > x[i:]:
            j += 1
        out.append(j - i)
    return out


def test_lyndon_arrays_and_runs_of_random_strings():
    rng = random.Random(5)
    for _ in range(1500):
        n, k = rng.randint(0, 60), rng.choice([1, 2, 3, 5])
        x = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.5:
            p = rng.randint(1, max(1, n // 3))
            x = [x[i % p] if rng.random() < 0.98 else rng.randrange(k) for i in range(n)]
        ranks = np.unique(x, return_inverse=True)[1].tolist() if x else []
        assert periodic.lyndon_array(ranks) == naive_lyndon(ranks)
        for least, turns in ((4, 2), (6, 3), (24, 3)):
            assert periodic.find_runs(np.array(x, np.int64), least, turns) == brute_runs(x, least, turns)


def test_runs_survive_equal_names(monkeypatch):
    monkeypatch.setattr(periodic, "mix", lambda x: x & np.uint64(1))  # nearly all blocks get one name
    x = [0, 1, 2, 3] * 9 + [9, 9, 9] + list(range(10)) * 5
    assert set(periodic.find_runs(np.array(x))) <= set(brute_runs(x))
    assert periodic._plain(np.array([7, 1, 2, 1, 2, 1, 8]), 2, 2) == (1, 6)


# --- 13: neighbours ------------------------------------------------------------------------


def brute_neighbours(rows, k=20, step=20):
    ok = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    width = max(len(v) for _, v in ok)
    held = np.array([np.pad(v, (0, width - len(v))) for _, v in ok])
    out = []
    for q, (i, _) in enumerate(ok):
        if i is not None and i % step == 0:
            score = (held * held[q]).sum(1)
            order = sorted((c for c in range(len(ok)) if c != q), key=lambda c: (-score[c], ok[c][0] is None, ok[c][0] or 0))
            out += [(i, r, ok[c][0], score[c]) for r, c in enumerate(order[:k], 1)]
    return out


def same_neighbours(got, want):
    def shape(rows):
        return sorted((tuple(r[:3]) for r in rows), key=lambda r: tuple((v is not None, v) for v in r))
    assert shape(got) == shape(want)
    key = lambda r: tuple((v is not None, v) for v in r)
    assert np.allclose([r[3] for r in sorted(got, key=key)], [r[3] for r in sorted(want, key=key)], rtol=1e-12, atol=1e-12)


def vectors(n, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(n):
        v = rng.integers(-3, 4, 16).astype(float) if i % 5 == 0 else centres[i % 12] + 0.2 * rng.normal(size=16)
        rows.append((i, (v * (1 + i % 3)).tolist()))
    hot = rows[min(40, n - 1)][1]
    rows += [(i, list(hot)) for i in range(n, n + n // 2)]  # one vector holds a third of the rows
    rows += [(7 * n, None), (7 * n + 20, []), (60 * n, [0.0] * 16), (60 * n + 20, [float("nan")] + [1.0] * 15), (60 * n + 40, [float("inf")] * 16),
             (60 * n + 60, [None] + [1.0] * 15), (None, list(hot)), (None, [1.0] * 16), (20, rows[20 % n][1]), (20, rows[21 % n][1]), (-40, rows[3][1]), (80 * n, [1.0, 2.0])]
    return rows


VECTORS = "vec_id long, embedding array<double>"


def frame(spark, rows):
    return spark.createDataFrame(rows, VECTORS).withColumn("uid", F.lit(1)).withColumn("v", F.lit("x")).withColumn("cell", F.lit(2))


def test_neighbours_with_factor_one_are_exact(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 60)
    monkeypatch.setattr(vptree, "LEAF", 8)
    monkeypatch.setattr(vptree, "BLOCK_QUERIES", 10)
    rows = vectors(600)
    got = vptree.nearest(frame(spark, rows).repartition(3), F.col("vec_id") % 20 == 0, factor=1.0)
    same_neighbours([tuple(r) for r in got.collect()], brute_neighbours(rows))


def test_few_vectors_and_none(spark):
    rows = vectors(6)[:5]
    got = vptree.nearest(frame(spark, rows), F.col("vec_id") % 2 == 0)
    same_neighbours([tuple(r) for r in got.collect()], brute_neighbours(rows, step=2))
    for few in ([], [(0, None)], [(0, [0.0])]):
        none = vptree.nearest(frame(spark, few), F.col("vec_id") % 2 == 0)
        assert none.columns == ["query_id", "rank", "vec_id", "score"] and none.count() == 0
    alone = vptree.nearest(frame(spark, [(0, [1.0])]), F.col("vec_id") % 2 == 0)
    assert alone.count() == 0


def test_a_larger_factor_searches_less_and_finds_most():
    rng = np.random.default_rng(2)
    points = np.repeat(rng.normal(size=(40, 24)), 100, axis=0) + 0.3 * rng.normal(size=(4000, 24))
    space = vptree.Space(float(np.sqrt((points ** 2).sum(1)).max()), 24)
    ids = np.arange(4000)[:, None]
    tree = vptree.Tree.load(vptree.Tree.build(space, points, ids, np.ones(4000, np.int64), ids[:, 0]).save())
    queries_, seen, recall = points[::40], {}, {}
    exact = np.argsort(-(queries_ @ points.T), axis=1)[:, :10]
    for factor in (1.0, 1.5, 3.0):
        run = vptree._Search(tree, space, queries_, np.full(len(queries_), -np.inf), 10, factor)
        scanned, scan = [], run.scan
        run.scan = lambda node, who, scan=scan, scanned=scanned: (scanned.append(len(who)), scan(node, who))
        _, found = run.run()
        seen[factor] = sum(scanned)
        recall[factor] = np.mean([len(set(tree.first[f]) & set(e)) / 10 for f, e in zip(found, exact, strict=True)])
    assert recall[1.0] == 1 and recall[1.5] > 0.9 and seen[3.0] < seen[1.5] < seen[1.0] < 100 * 4000 / vptree.LEAF


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = {(r[0], r[2]) for r in brute_neighbours(rows)}
    got = {(r.query_id, r.vec_id) for r in queries.op13_vantage_trees(spark, sf).collect()}
    assert len(got & want) >= 0.9 * len(want) and len(got) == len(want)
