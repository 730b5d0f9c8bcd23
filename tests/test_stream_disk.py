"""What the stream job leaves on disk: its outputs, and the shuffles of the micro-batch that runs."""

import base64
import datetime
import os
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from zonewatch.operators import detect as D
from zonewatch.plans import q_stream
from zonewatch.sources import fixtures as fx
from zonewatch.streaming import stream as ST

FRAMES = ("frame_id long, camera_id int, epoch_id long, row_idx int, w int, h int, timestamp timestamp, frame_b64 string")
BASE = datetime.datetime(2024, 1, 1)


def _shuffled(spark) -> dict[str, int]:
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    held = {}
    for p in (p for d in dirs for p in Path(d).rglob("shuffle_*.data")):
        try:
            held[p.name] = p.stat().st_size
        except FileNotFoundError:
            pass
    return held


def _new(spark, before: dict[str, int]) -> int:
    return sum(n for name, n in _shuffled(spark).items() if name not in before)


def _frames(spark, rows=400):
    """Frames whose payloads no codec of a shuffle makes small."""
    at = [(k, k % 3 if k % 7 else None, k // 5, k % 5, 640, 640, BASE + datetime.timedelta(seconds=k), base64.b64encode(os.urandom(6000)).decode())
          for k in range(rows)]
    return spark.createDataFrame(at, FRAMES).repartition(4)


def test_a_micro_batch_does_not_shuffle_its_payloads(spark, tmp_path):
    """the open cameras met the frames in a sort-merge join, payloads and all."""
    df = _frames(spark).localCheckpoint()
    payloads = df.agg(F.sum(F.length("frame_b64"))).first()[0]
    before = _shuffled(spark)
    ST.process_batch(df, 0, str(tmp_path), D.StubDetector())
    assert 0 < payloads and _new(spark, before) < payloads // 10
    saved = spark.read.parquet(f"{tmp_path}/evidence")
    want = df.join(saved.select("frame_id", "payload"), "frame_id")
    assert want.count() == saved.count() > 100 and want.where("payload <> frame_b64").count() == 0
    assert saved.where("camera_id IS NULL").count() > 0  # met by no breaker, and not lost


def test_evidence_is_written_compressed(spark, tmp_path):
    """it holds every saved payload, most of what the job leaves."""
    ST.process_batch(_frames(spark, 40), 0, str(tmp_path), D.StubDetector())
    files = [*Path(tmp_path, "evidence").rglob("*.parquet")]
    assert files and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)


@pytest.mark.parametrize("query", ["stream_batch_summary", "run_stream_keyed", "frame_log_capped", "stream_recovery", "run_stream", "progress_table"])
def test_streams_leave_few_shuffle_files(spark, query, monkeypatch):
    """The documents' shuffle of every micro-batch lay on disk until the driver's next collection."""
    spark.sparkContext._jvm.System.gc()
    before = _shuffled(spark)
    one = spark.read.parquet(f"{SF_SMALL}/documents.parquet").agg(F.sum(F.octet_length("text"))).first()[0]
    getattr(q_stream, query)(spark, SF_SMALL)
    deadline = time.time() + 20
    while _new(spark, before) > one // 4 and time.time() < deadline:  # executors are told, not waited for
        time.sleep(0.2)
    assert _new(spark, before) <= one // 4


def test_detections_move_once_to_the_staged_log(spark):
    """Nested by frame, they were moved by epoch, by frame again and by time."""
    plan = fx.stream_refs(spark, SF_SMALL)._jdf.queryExecution().explainString(
        spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moved = [part.splitlines() for part in plan.split("\n\n") if ") Exchange" in part]
    assert moved and not [part for part in moved if any("recorded#" in line for line in part)]
