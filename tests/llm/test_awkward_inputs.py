"""Repeated ids, foreign archives, clashing columns and empty tables."""

import gzip
import hashlib
import importlib
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm import shingle_set
from zonewatch.llm import minhash, warc_zip
from zonewatch.llm.common import run_folder


def components_of(rows):
    """Brute force: an id is one node, linked by any text of it."""
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    held = [(i, shingle_set(t)) for i, t in rows if i is not None]
    for k, (i, x) in enumerate(held):
        for j, y in held[k + 1:]:
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def same_components(spark, rows):
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = components_of(rows)
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id, r.kept) for r in got if r.doc_id is not None} == {(i, c, i == c) for i, c in want.items()}


def test_a_repeated_id_links_its_texts(spark):
    one, two = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    same_components(spark, [(5, one), (9, one), (3, two), (5, two)])


def test_random_repeated_ids(spark):
    rng = random.Random(6)
    texts = []
    for _ in range(25):
        base = [f"w{rng.randrange(10**6)}" for _ in range(80)]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 3])):
            own = list(base)
            own[rng.randrange(80)] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(own))
    rows = [(rng.randrange(45), t) for t in texts] + [(rng.randrange(45), rng.choice(texts)) for _ in range(12)] + [(1, None), (1, ""), (None, texts[0])]
    same_components(spark, rows)


def archive(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for name, data in members:
            z.writestr(zipfile.ZipInfo(name), data)


@pytest.mark.filterwarnings("ignore:Duplicate name")
def test_plain_and_repeated_members_are_read(spark):
    folder = run_folder(spark, "foreign")
    records = {k: warc_zip.make_record(k, f"http://x/{k}", f"page {k} ".encode() * (k + 1), None) for k in range(9)}
    path = folder.removeprefix("file:")
    archive(f"{path}/foreign.wacz", [
        ("archive/a.warc", b"".join(records[k] for k in (0, 1, 2))), ("archive/b.warc.gz", b"".join(gzip.compress(records[k]) for k in (3, 4))),
        ("archive/b.warc.gz", gzip.compress(records[5])), ("archive/empty.warc", b""), ("other/readme.txt", b"WARC"),
        ("archive/c.warc", records[6] + records[7] + records[8])])
    got = {r.page_id: bytes(r.payload) for r in warc_zip.read_archives(spark.createDataFrame([(f"{folder}/foreign.wacz",)], "path string")).collect()}
    assert got == {k: f"page {k} ".encode() * (k + 1) for k in range(9)}
    with zipfile.ZipFile(f"{path}/packed.wacz", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a.warc", records[0] * 5)
    with pytest.raises(Exception, match="not stored"):
        warc_zip.read_archives(spark.createDataFrame([(f"{folder}/packed.wacz",)], "path string")).collect()


CLASHES = ["_keep", "_pipeline_row", "_key", "_id", "_row", "_gone", "rank", "keep_id", "component_id", "m", "block", "kept"]


def test_pipeline_with_clashing_columns_and_without_rows(spark, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for c in CLASHES:
        docs = docs.withColumn(c, F.lit(7))
    for step in (pipeline.exact_dedup, pipeline.near_dedup):
        got = step(spark, docs, "")
        assert got.columns == docs.columns and 0 < got.count() < docs.count()
        assert got.where(" and ".join(f"{c} = 7" for c in CLASHES)).count() == got.count()
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    whole = pipeline.run(spark, str(tmp_path))
    plain = pipeline.run(spark, "/root/testdata/sf0.001")
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(columns).collect())) == sorted(map(tuple, plain.select(columns).collect()))
    empty = str(tmp_path / "empty")
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{empty}/labels.parquet")
    assert pipeline.run(spark, empty).count() == 0


def test_digest_of_a_read_record_is_checked():
    record = warc_zip.make_record(1, None, b"payload", None)
    assert warc_zip.parse_record(record)["payload_digest"] == hashlib.sha1(b"payload").hexdigest()
    with pytest.raises(ValueError):
        warc_zip.parse_record(record.replace(b"payload\r\n", b"changed\r\n"))
