"""Streaming: option mapping, batch = stream, recovery without duplicates."""

import base64
import datetime

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from zonewatch.plans.catalog import QUERIES
from zonewatch.streaming import stream as ST


def test_kafka_options():
    o = ST.kafka_options("broker:9092", consumer={"session.timeout.ms": 60000,
                                                  "kafka.max.poll.records": 5})
    assert o["subscribe"] == "traffic_frames" and o["startingOffsets"] == "earliest"
    assert o["failOnDataLoss"] == "false" and "maxOffsetsPerTrigger" not in o
    assert ST.kafka_options("b", max_per_trigger=5)["maxOffsetsPerTrigger"] == "5"
    assert o["kafka.session.timeout.ms"] == "60000" and o["kafka.max.poll.records"] == "5"
    assert not any(k.startswith("kafka.consumer.") for k in o)
    p = ST.publish_options("broker:9092")
    assert p["kafka.acks"] == "all" and p["kafka.linger.ms"] == "10"


def test_recovery_no_duplicate_alerts(spark):
    out = QUERIES["stream_recovery"].build(spark, SF_SMALL)
    assert out.count() > 0
    assert out.where("copies <> 1").count() == 0


def test_breaker_stream_equals_batch(spark):
    stream = QUERIES["breaker_stream"].build(spark, SF_SMALL)
    batch = QUERIES["breaker_batch"].build(spark, SF_SMALL)
    assert stream.count() == batch.count()
    assert stream.exceptAll(batch).count() == 0


def _kafka(spark, rows, headers):
    schema = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
    return spark.createDataFrame(rows, schema + (", headers array<struct<key:string,value:binary>>" if headers else ""))


def test_kafka_rows_go_through_the_job(spark, tmp_path):
    """Published rows come back with their metadata and are processed."""
    from zonewatch.operators import detect as D
    image = base64.b64encode(b"x" * 4000).decode()
    at = datetime.datetime(2024, 1, 1, 12, 0, 3, 5)
    frames = spark.createDataFrame([(7, 3, 1, 2, at, 640, 360, image), (8, 3, 1, 3, at, 24, 24, image)],
                                   "frame_id long, camera_id int, epoch_id long, row_idx int, captured_at timestamp, w int, h int, frame_b64 string")
    sent = ST.kafka_rows(frames).collect()
    rows = [(bytes(r.key), bytes(r.value), "t", 1, k, datetime.datetime(2030, 1, 1), 0, r.headers) for k, r in enumerate(sent)]
    parsed = ST.parse_frames(_kafka(spark, rows, True))
    got = sorted((r.frame_id, r.camera_id, r.epoch_id, r.row_idx, r.w, r.h, r.timestamp) for r in parsed.collect())
    assert got == [(7, 3, 1, 2, 640, 360, at), (8, 3, 1, 3, 24, 24, at)]
    ST.process_batch(parsed, 4, str(tmp_path), D.StubDetector())
    saved = spark.read.parquet(str(tmp_path / "evidence")).collect()
    assert [(r.frame_id, r.batch_id) for r in saved] == [(7, 4)] and "_epoch1_frame2.jpg" in saved[0].file_name


def test_open_breaker_keeps_frames_from_the_detector(spark, tmp_path):
    """Five failing batches open camera 1's breaker: its next frames pass by, until one
    more than 300 s after the last failure; camera 2 is not touched."""
    from zonewatch.operators import detect as D
    calls = str(tmp_path / "calls")

    class Counting(D.StubDetector):
        def infer(self, model, image, w, h):
            with open(calls, "a") as f:
                f.write(image[:1].decode())
            if image[:1] == b"1":
                raise RuntimeError("codec")
            return [("car", 0.9, 1, 1, 2, 2)]

    seen = []
    for batch, second in enumerate([0, 10, 20, 30, 40, 50, 340, 341]):
        at = datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=second)
        rows = [(batch * 10 + cam, cam, batch, 0, 640, 640, at, base64.b64encode(str(cam).encode() * 1800).decode()) for cam in (1, 2)]
        df = spark.createDataFrame(rows, "frame_id long, camera_id int, epoch_id long, row_idx int, w int, h int, timestamp timestamp, frame_b64 string")
        for _ in range(2 if batch == 5 else 1):  # a replayed batch changes nothing
            ST.process_batch(df, batch, str(tmp_path / "out"), Counting())
        seen.append(open(calls).read())
        open(calls, "w").close()
    assert ["1" in s for s in seen] == [True] * 5 + [False, False, True]
    assert all("2" in s for s in seen)


def test_kafka_rows_without_headers_are_named_by_their_place(spark):
    at = datetime.datetime(2024, 1, 1)
    for headers in (False, True):
        rows = [(None, b"QUJD", "t", 2, 11, at, 0, *([None] if headers else []))]
        r = ST.parse_frames(_kafka(spark, rows, headers)).first()
        assert (r.frame_id, r.camera_id, r.epoch_id, r.row_idx, r.w, r.h) == (2 * 2**44 + 11, 2, 2, 1, 640, 640)
        assert r.timestamp == at and r.frame_b64 == "QUJD"


def test_capped_and_uncapped_streams_read_the_same(spark):
    capped = QUERIES["frame_log_capped"].build(spark, SF_SMALL)
    whole = QUERIES["frame_log_stream"].build(spark, SF_SMALL).groupBy("topic", "partition").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, capped.collect())) == sorted(map(tuple, whole.collect()))


def test_processing_time_trigger(spark, tmp_path):
    """The interval form of the job (I1): started, fed, stopped."""
    from zonewatch.plans.q_stream import _frame_log_files
    raw = ST.frame_stream(spark, "parquet", _frame_log_files(spark, SF_SMALL, str(tmp_path)))
    q = ST.run_stream(raw, str(tmp_path / "out"), str(tmp_path / "ckpt"), available_now=False, interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(str(tmp_path / "out" / "summary")).agg(F.sum("rows")).first()[0] > 0


def test_alert_replay_is_idempotent(spark):
    """Writing a batch's alerts twice (a replay) leaves one copy of each."""
    import os
    from zonewatch.operators import sinks as S
    from zonewatch.session import scratch_path
    ev = S.evidence(spark, SF_SMALL).withColumn("batch_id", F.lit(7).cast("long"))
    path = os.path.join(scratch_path(spark, "alert-replay"), "alerts")
    al = S.alerts(ev)
    S.write_alerts(al, path)
    S.write_alerts(al, path)
    out = spark.read.parquet(path)
    assert out.count() == al.count() > 0
    assert out.groupBy("alert_id").count().where("count > 1").count() == 0
