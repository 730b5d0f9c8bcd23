"""Inputs the fixtures do not contain: NULL and equal order keys, no failures, boxes without
an area, final line breaks, failing detectors."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from zonewatch import config
from zonewatch.functions import geometry
from zonewatch.functions import payload as P
from zonewatch.operators import breaker as B
from zonewatch.operators import detect as D
from zonewatch.operators import metrics as M
from zonewatch.operators import nms as N
from zonewatch.operators.ranking import sequence_number

RANKED = [
    [(1, 5, 1), (1, None, 2), (1, 3, 3), (None, 4, 4), (None, None, 5), (2, None, 6)],  # NULL keys and groups
    [(1, 7, k) for k in range(50)],  # one order value
    [],
    [(3, 1, 1)],
]


@pytest.mark.parametrize("rows", RANKED)
@pytest.mark.parametrize("slices", [1, 5])
def test_numbering_equals_a_plain_window(spark, rows, slices):
    df = spark.createDataFrame(rows, "g int, t long, id long")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("t", "id")).cast("long"))
    got = sequence_number(df, ["g"], ["t", "id"], out="n", slices=slices)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    whole = sequence_number(df, [], ["t", "id"], out="n", slices=slices).collect()
    assert sorted(r.n for r in whole) == list(range(1, len(rows) + 1))


def test_error_runs_without_errors(spark):
    schema = "batch_id long, error string"
    assert M.error_runs(spark.createDataFrame([(k, None) for k in range(9)], schema)).count() == 0
    assert M.error_runs(spark.createDataFrame([], schema)).count() == 0


def test_nms_of_boxes_without_an_area(spark):
    det = "array<struct<det_id:int,det_key:bigint,label:string,conf:double,x1:bigint,y1:bigint,x2:bigint,y2:bigint>>"
    rows = [(1, [(1, 1, "car", 0.9, 5, 5, 5, 5), (2, 2, "car", 0.8, 5, 5, 5, 5), (3, 3, "car", 0.7, 0, 0, 9, 9)])]
    kept = N.nms(spark.createDataFrame(rows, f"frame_id long, detections {det}")).first().kept
    assert [d.det_id for d in kept] == [1, 2, 3]


def test_integer_division_is_exact(spark):
    n = 2**60 + 7
    df = spark.createDataFrame([(n,), (-7,)], "n long").select(geometry.idiv(F.col("n"), 5))
    assert [r[0] for r in df.collect()] == [n // 5, -1]


@pytest.mark.parametrize("text,reason", [
    ("QUJD" * 400 + "\n", config.REASON_VALID),
    ("QUJD" * 400 + "\r\n", config.REASON_VALID),
    ("a" * 200 + "\u2028", config.REASON_CHARS),
])
def test_validation_of_final_line_breaks(spark, text, reason):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(P.validate_payload(F.col("s"))).first()[0] == reason


def test_closed_form_counts_samples(spark):
    rng = random.Random(1)
    rows = [(x := rng.randrange(0, 60), x + rng.randrange(0, 40), rng.choice([-2**63, rng.randrange(-20, 120)]),
             rng.choice([2**63 - 1, rng.randrange(-20, 120)])) for _ in range(4000)]
    df = spark.createDataFrame([(int(a), int(b), max(c, -2**63 + 1), d) for a, b, c, d in rows], "x1 long, x2 long, lo long, hi long")
    got = df.select("*", F.expr(geometry.interval_hits_sql("x1", "x2", "lo", "hi")).alias("n")).collect()
    assert all(r.n == sum(r.lo <= (10 * r.x1 + i * (r.x2 - r.x1)) // 10 <= r.hi for i in range(11)) for r in got)


class Fails(D.StubDetector):
    """Raises what codecs and model libraries raise."""

    def infer(self, model, image, w, h):
        if image[:1] == b"!":
            raise RuntimeError("codec")
        return [("car", 0.9, 1, 1, 2, 2)]


FRAME = "frame_id long, w int, h int, frame_b64 string"


def _frame(spark, *payloads):
    import base64
    return spark.createDataFrame([(k, 640, 640, None if p is None else base64.b64encode(p).decode()) for k, p in enumerate(payloads)], FRAME)


def test_a_failing_image_costs_one_row(spark):
    df = _frame(spark, b"ok" * 900, b"!" * 1800, b"ok" * 900, None).coalesce(1)
    got = {r.frame_id: r.status for r in D.detect(df, Fails()).collect()}
    assert got == {0: "DETECTED", 1: "ROW_ERROR", 2: "DETECTED", 3: "ROW_ERROR"}


def test_budget_and_crash(spark):
    df = _frame(spark, b"ok" * 900, b"ok" * 900).coalesce(1)
    assert {r.status for r in D.detect(df, Fails(), budget_s=-1.0).collect()} == {"BATCH_TIMEOUT"}

    class Crash(Fails):
        def load(self):
            raise OSError("no weights")

    assert {(r.status, r.error_msg) for r in D.detect(df, Crash()).collect()} == {("MODEL_UNAVAILABLE", "no weights")}


def test_rejected_rows_never_reach_the_detector(spark):
    class Refuses(D.StubDetector):
        def infer(self, model, image, w, h):
            if len(image) < config.MIN_DECODED_BYTES or h < config.MIN_SIDE:
                raise AssertionError("gated row")
            return [("car", 0.9, 1, 1, 2, 2)]

    df = _frame(spark, b"ok" * 900, b"tiny", b"ok" * 900).withColumn("h", F.when(F.col("frame_id") == 2, 24).otherwise(F.col("h")))
    got = {r.frame_id: (r.status, r.result) for r in D.predict(df, Refuses()).collect()}
    assert got[1] == (D.INVALID_PAYLOAD, "") and got[2] == (D.INVALID_SIZE, "")
    assert got[0][0] == "DETECTED" and got[0][1]


def _plain(f, last, ts, fails):
    out = []
    for t, fail in zip(ts, fails, strict=True):
        f, last, state = B.step(f, last, float(t), bool(fail))
        out.append((state, f))
    return f, last, out


def test_jumps_equal_single_steps():
    rng = np.random.default_rng(3)
    for _ in range(400):
        n = int(rng.integers(0, 60))
        ts = np.sort(rng.integers(0, int(rng.choice([50, 900, 9000])), n))
        fails = rng.random(n) < rng.choice([0.1, 0.5, 1.0])
        f = int(rng.integers(0, B.TH + 1))
        last = float(rng.integers(-400, 1)) if f else None
        want_f, want_last, rows = _plain(f, last, ts, fails)
        got_f, got_last, states, counts = B.run(f, last, ts, fails)
        assert (got_f, got_last, list(zip(states, counts, strict=True))) == (want_f, want_last, rows)
        assert B.run(f, last, ts, fails, fill=False)[:2] == (want_f, want_last)


@pytest.mark.parametrize("chunk_rows", [1, 3, 17, 4096])
def test_chunks_compose_to_the_sequence(spark, chunk_rows):
    rng = random.Random(chunk_rows)
    rows, t = [], {0: 0, 1: 0}
    for k in range(240):
        cam = k % 2
        t[cam] += rng.choice([0, 1, 40, 200, 400])
        rows.append((cam, k, t[cam], rng.random() < 0.6))
    df = spark.createDataFrame(rows, "camera_id int, epoch_id long, t long, fail boolean")
    got = {(r.camera_id, r.epoch_id): (r.state, r.failures) for r in B.breaker_batch(df, chunk_rows=chunk_rows).collect()}
    for cam in (0, 1):
        own = [r for r in rows if r[0] == cam]
        _, _, want = _plain(0, None, [r[2] for r in own], [r[3] for r in own])
        assert [got[cam, r[1]] for r in own] == want
