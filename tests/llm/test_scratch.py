"""What the training-data operators leave on disk."""

import importlib
import os
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from zonewatch.llm import kn_rules, kn_words
from zonewatch.llm.common import CLEANUP, run_folder, stage


def _shuffle_files(spark) -> set[str]:
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p.name for d in dirs for p in Path(d).rglob("shuffle_*.data")}


def test_staged_tables_leave_no_shuffle_files(spark):
    """op10, pipeline: the shuffles of every level of the word model lay on disk until the driver's next collection."""
    before = _shuffle_files(spark)
    df = spark.range(0, 100_000, 1, 4).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("n"))
    folder = run_folder(spark, "scratch-test")
    held = stage(df, folder, "counts")
    deadline = time.time() + 30
    while _shuffle_files(spark) - before and time.time() < deadline:  # the executors are told, not waited for
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(CLEANUP, None) in (None, "false")
    assert held.count() == 1000 and df.count() == 1000  # the frame itself can be asked again
    assert os.path.isdir(folder.removeprefix("file:") + "/counts")


def test_rows_of_files_are_keyed_without_a_copy(spark, tmp_path):
    """pipeline: every stage wrote all texts once more to number its rows, and these copies stayed."""
    pipeline = importlib.import_module("corpus_pipeline")
    rows = [(k % 7 or None, f"text {k}", "en") for k in range(60)] + [(1, "text 1", "en")] * 3
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5).write.parquet(f"{tmp_path}/many")
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/one")
    for name in ("many", "one"):
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        keyed = pipeline.keyed(spark, docs)
        key = pipeline.row_key(keyed)
        assert not any("/keyed/" in f for f in keyed.inputFiles())
        first = sorted((r[key], r.text) for r in keyed.collect())
        assert len({k for k, _ in first}) == len(rows) and sorted(t for _, t in first) == sorted(r[1] for r in rows)
        with_smaller_tasks = pipeline.keyed(spark, docs).select(key, "text").repartition(3)
        assert sorted(map(tuple, with_smaller_tasks.collect())) == first
        assert keyed.columns == [*docs.columns, key]
    # rows that are not one each of a file's, or not the same at every read, are written
    for other in (docs.withColumn("e", F.explode(F.array(F.lit(1), F.lit(2)))), docs.limit(5), docs.union(docs), docs.filter("rand() < 0.5")):
        assert any("/keyed/" in f for f in pipeline.keyed(spark, other).inputFiles())


def test_grams_of_one_block_are_not_sent_whole(tmp_path):
    """op10: every distinct gram of a block moved with its whole hash, though most lie in no other block."""
    short, bits = 12, 40
    keys = [np.array(sorted(k << 50 for k in ks), np.uint64) for ks in ((3, 900, 4000), (3, 1700, 9000))]
    places = [{"lang": "en", "block": b} for b in (0, 1)]
    sent = pa.concat_tables([kn_words._short_rows(p, 3, k, 1, short) for p, k in zip(places, keys, strict=True)])
    told = kn_words._filter(str(tmp_path))((pa.scalar("en"), pa.scalar(0)), sent).to_pylist()
    n, answers, whole = np.array([1, 2, 5]), [], []
    for b, k in enumerate(keys):
        flags = kn_words._shared(k, pa.Table.from_pylist([r for r in told if r["block"] == b], kn_words.MADE_ARROW), 3, short)
        assert flags.tolist() == [True, False, False]
        answers.append(flags)
        whole.append(kn_words._own_rows(places[b], k, n, flags, 1, bits))
    assert [len(kn_words.unpacked_keys(r["keys"])) for t in whole for r in t.to_pylist() if r["keys"]] == [1, 1]
    made = kn_words._count(3, str(tmp_path))((pa.scalar("en"), pa.scalar(0)), pa.concat_tables(whole)).to_pylist()
    tally = next(np.frombuffer(r["n"], np.int64) for r in made if r["kind"] == kn_words.TALLY)
    assert tally.tolist() == [0, 3, 0, 0, 2 + 5 + 2 + 5 + 2, 0, 3, 2]  # the shared gram counts 1 + 1, once
    got = [kn_words._with_unshared(answers[b], kn_words._figures(pa.Table.from_pylist(
        [r for r in made if r["kind"] == kn_words.ANSWER and r["block"] == b], kn_words.MADE_ARROW), 3, 2), n) for b in (0, 1)]
    assert sorted(g[0].tolist() for g in got) == [[2, 0], [2, 1]]  # one of them speaks for it
    assert all(g[1:].tolist() == [[2, 1], [5, 1]] for g in got)


def test_places_of_sorted_keys():
    rng = np.random.default_rng(5)
    for keys in (rng.integers(0, 50, 1000), rng.integers(0, 1 << 64, 1000, np.uint64), np.arange(1000, dtype=np.uint64) + np.uint64(1 << 63),
                 np.repeat(np.uint64(2**64 - 1) - np.arange(500, dtype=np.uint64), 3), np.zeros(0, np.int64), np.zeros(1, np.uint64)):
        assert kn_words.sorted_places(keys).tolist() == np.argsort(keys, kind="stable").tolist()
        held, first, at = kn_words.distinct(keys)
        want = np.unique(keys, return_index=True, return_inverse=True)
        assert all(a.tolist() == b.tolist() for a, b in zip((held, first, at), want, strict=True))
    for n in (np.array([0, 3, 255]), np.array([[1, 70_000], [2, 0]]), np.array([1 << 40]), np.zeros((0, 3), np.int64)):
        columns = n.shape[1] if n.ndim > 1 else 1
        assert kn_words.unpacked_counts(kn_words.packed_counts(n), columns).tolist() == n.reshape(len(n), columns).tolist()


def test_marks_inside_words_are_no_marks():
    assert kn_rules.fold([])[0].tolist() == []
    keys, owner = kn_rules.fold(kn_rules._clean([b"a\x00b", "hé".encode(), b"\xe2\x82"]))
    want, _ = kn_rules.fold([b"a?b"])
    assert keys[owner == 0].tolist() == want.tolist() and np.bincount(owner).tolist() == [4, 3, 2]
