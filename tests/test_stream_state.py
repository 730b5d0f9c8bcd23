"""State of the stream job: restarts, snapshots, the keyed breaker, late frames."""

import base64
import datetime
import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from zonewatch.operators import detect as D
from zonewatch.plans import q_stream
from zonewatch.streaming import stream as ST

FRAMES = ("frame_id long, camera_id int, epoch_id long, row_idx int, w int, h int, timestamp timestamp, frame_b64 string")
BASE = datetime.datetime(2024, 1, 1)


class FirstCameraFails(D.StubDetector):
    def infer(self, model, image, w, h):
        if image[:1] == b"1":
            raise RuntimeError("codec")
        return [("car", 0.9, 1, 1, 2, 2)]


def _batch(spark, batch, second):
    at = BASE + datetime.timedelta(seconds=second)
    rows = [(batch * 10 + cam, cam, batch, 0, 640, 640, at, base64.b64encode(str(cam).encode() * 1800).decode()) for cam in (1, 2)]
    return spark.createDataFrame(rows, FRAMES)


def test_breaker_snapshots_do_not_pile_up(spark, tmp_path):
    out = str(tmp_path / "out")
    for batch in range(6):
        ST.process_batch(_batch(spark, batch, batch), batch, out, FirstCameraFails())
        assert len(ST.snapshots(spark, f"{out}/breaker")) <= 2
    assert {r.camera_id: r.failures for r in ST.breaker_states(spark, out, 6).collect()} == {1: 5, 2: 0}


def test_keyed_breaker_keeps_its_state_in_the_checkpoint(spark, tmp_path):
    """Every micro-batch is a run of its own: five failures open camera 1 for 300 s."""
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    seconds = [0, 10, 20, 30, 40, 50, 340, 341]
    for batch, second in enumerate(seconds):
        _batch(spark, batch, second).coalesce(1).write.mode("append").parquet(src)
        raw = spark.readStream.schema(FRAMES).parquet(src)
        results = ST.B.detect_keyed(D.send(raw), FirstCameraFails())
        q = results.select("frame_id", "camera_id", "epoch_id", "status").writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
    got = {(r.camera_id, r.epoch_id): r.status for r in spark.read.parquet(out).collect()}
    assert [got[1, k] for k in range(8)] == ["ROW_ERROR"] * 5 + ["CIRCUIT_BREAKER_OPEN"] * 2 + ["ROW_ERROR"]
    assert all(got[2, k] == "DETECTED" for k in range(8))


def test_progress_goes_on_after_a_restart(spark, tmp_path):
    path = str(tmp_path / "progress")
    src = str(tmp_path / "src")
    told = []
    for turn in range(2):
        spark.range(turn * 10, turn * 10 + 10).write.mode("append").parquet(src)
        feed = ST.ProgressFeed(spark, path)
        spark.streams.addListener(feed)
        try:
            q = spark.readStream.schema("id long").parquet(src).writeStream.format("parquet").option(
                "path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
            q.awaitTermination()
            told.append(feed.table().agg(F.sum("num_input_rows"), F.countDistinct("run_id")).first())
        finally:
            spark.streams.removeListener(feed)
    assert [tuple(t) for t in told] == [(10, 1), (20, 2)]


def _verdicts(spark, *rows):
    return spark.createDataFrame([(i, 1, BASE + datetime.timedelta(minutes=m), v) for i, m, v in rows],
                                 "frame_id long, camera_id int, captured_at timestamp, violation boolean")


def test_late_frames_go_to_their_table_and_replays_change_nothing(spark, tmp_path):
    out = str(tmp_path)
    batches = [_verdicts(spark, (1, 5, True), (2, 59, False)), _verdicts(spark, (3, 69, False)),
               _verdicts(spark, (4, 30, True), (5, 140, False)),  # 69 - 10 < 60: still open
               _verdicts(spark, (6, 31, True), (7, 100, True), (8, 135, False))]
    for k, df in enumerate(batches):
        for _ in range(2):
            ST.window_batch(df, k, out)
    got = {r.window_start: (r.frames, r.violations, r.late, r.closed) for r in ST.window_table(spark, out).collect()}
    assert got == {BASE: (3, 2, 1, True), BASE + datetime.timedelta(hours=1): (1, 0, 1, True), BASE + datetime.timedelta(hours=2): (2, 0, 0, False)}
    late = spark.read.parquet(f"{out}/late")
    assert sorted(r.frame_id for r in late.collect()) == [6, 7]


def test_staged_files_follow_the_bytes(spark, tmp_path, monkeypatch):
    df = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).repartition(3)
    assert q_stream.stage_ordered(df, str(tmp_path / "a"), "id") == q_stream.LEAST_FILES
    monkeypatch.setattr(q_stream, "FILE_BYTES", 100_000)
    n = q_stream.stage_ordered(df, str(tmp_path / "b"), "id")
    assert 10 < n < 40 and spark.read.parquet(str(tmp_path / "b")).count() == 20_000
    assert len([f for f in os.listdir(tmp_path / "b") if f.startswith("part-")]) == n


def test_scratch_folders_are_removed_with_the_driver(tmp_path):
    import subprocess
    import sys
    code = (f"import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})\n"
            "from zonewatch.session import build_session, run_dir\n"
            f"s = build_session('local[1]', extra={{'spark.checkpoint.dir': {str(tmp_path)!r}}})\n"
            "p = run_dir(s, 'seq').removeprefix('file:'); s.range(3).write.parquet(p + '/rows'); print('HELD', len(__import__('os').listdir(p)), p); s.stop()")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, check=True).stdout
    folder = next(x for x in out.splitlines() if x.startswith("HELD")).split()
    assert folder[1] == "1" and not os.path.exists(folder[2])


def test_keyed_job_equals_the_plain_one(spark):
    plain = q_stream.run_stream(spark, SF_SMALL).select("frame_id", "verdict")
    keyed = q_stream.run_stream_keyed(spark, SF_SMALL).select("frame_id", "verdict")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, keyed.collect()))


def test_streams_kept_by_camera_have_two_state_partitions_a_core(spark):
    """with 200 shuffle partitions every micro-batch began 200 Python workers for a few cameras."""
    from zonewatch.session import run_dir, settings
    told = []

    class Feed(ST.StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            pass

        def onQueryProgress(self, event):
            told.extend(s.numShufflePartitions for s in event.progress.stateOperators)

    src = run_dir(spark, "camera-state")
    _batch(spark, 0, 0).withColumn("recorded", F.lit(None).cast(ST.RECORDED)).write.parquet(f"{src}/log")
    log = spark.readStream.schema(spark.read.parquet(f"{src}/log").schema).parquet(f"{src}/log").withColumnRenamed("frame_b64", "value")
    feed = Feed()
    spark.streams.addListener(feed)
    try:
        with settings(spark, **{"spark.sql.shuffle.partitions": 40}):
            ST.run_stream(log, f"{src}/out", f"{src}/ckpt", detector=D.RecordedDetector(), keyed=True).awaitTermination()
            assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(feed)
    assert spark.read.parquet(f"{src}/out/summary").count() == 1
    assert told and set(told) == {2 * spark.sparkContext.defaultParallelism}
