"""Scanlines, the zone index, the box sweep and the breaker's tree against plain versions."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.harness import duck  # noqa: F401  (path set-up)
from zonewatch.functions import geometry
from zonewatch.operators import breaker as B
from zonewatch.operators import nms as N
from zonewatch.operators import zones as Z


def inside(px, py, poly):
    on, cross = False, 0
    for (ax, ay), (bx, by) in zip(poly, poly[1:] + poly[:1], strict=True):
        cr = (bx - ax) * (py - ay) - (px - ax) * (by - ay)
        on |= cr == 0 and min(ax, bx) <= px <= max(ax, bx) and min(ay, by) <= py <= max(ay, by)
        cross += (ay > py) != (by > py) and (by > ay) == (cr > 0)
    return on or cross % 2 == 1


def samples(x1, x2):
    return [int((10 * x1 + i * (x2 - x1)) / 10) for i in range(11)]


def test_scanlines_of_any_polygon(spark):
    """Random polygons, self-crossing and degenerate ones included: every integer point of every line."""
    rng = random.Random(8)
    polys = [[(rng.randrange(-3, 14), rng.randrange(-3, 14)) for _ in range(rng.randint(1, 8))] for _ in range(150)]
    polys += [[(0, 0), (9, 0), (9, 9), (0, 9)], [(0, 0), (5, 0), (9, 0), (9, 4), (4, 4)], [(3, 3)] * 4]
    rows = [(k, y, poly) for k, poly in enumerate(polys) for y in range(-4, 15)]
    df = spark.createDataFrame(rows, "k int, y long, p array<struct<x:long,y:long>>").withColumn("e", F.expr(geometry.edges_of_array_sql("p")))
    for r in df.select("k", "y", F.expr(geometry.scanline_sql("e", "y")).alias("spans")).collect():
        got = {x for s in r.spans for x in range(s.lo, s.hi + 1)}
        assert got == {x for x in range(-5, 16) if inside(x, r.y, polys[r.k])}
        assert [s.lo for s in r.spans] == sorted(s.lo for s in r.spans)


def test_hits_of_boxes_in_any_zone(spark):
    rng = random.Random(9)
    zones = [[(0.0, 300.0), (320.0, 600.0), (640.0, 300.0), (320.0, 450.0)], [(10.0, 10.0), (600.0, 500.0), (600.0, 10.0), (10.0, 500.0)],
             [(rng.uniform(0, 640), rng.uniform(0, 640)) for _ in range(9)]]
    rows = [(w, h, x1, x1 + rng.randrange(-20, 300), rng.randrange(-2, h)) for w, h in ((640, 640), (641, 359), (33, 2000))
            for x1 in [rng.randrange(-30, w) for _ in range(60)]] + [(None, 5, 1, 2, 3), (640, 640, None, 2, 3)]
    df = spark.createDataFrame(rows, "w int, h int, x1 long, x2 long, y2 long")
    for zone in zones:
        for r in geometry.with_zone_hits(df, zone=zone).collect():
            if None in (r.w, r.x1):
                assert r.hits is None
                continue
            poly = [(int(x * (r.w / 640)), int(y * (r.h / 640))) for x, y in zone]
            assert r.hits == sum(inside(px, r.y2, poly) for px in samples(r.x1, r.x2)), r


ZONES = "zone_id int, camera_id int, vertex_no int, x double, y double"


def test_ten_thousand_zones_a_camera(spark):
    """The index finds what the plain test finds, and a box meets few of the zones."""
    rng = random.Random(10)
    polys = {k: [(x + rng.uniform(0, 9), y + rng.uniform(0, 9)) for _ in range(rng.choice([3, 4, 5]))]
             for k in range(10_000) for x, y in [(rng.uniform(0, 630), rng.uniform(0, 630))]}
    polys[3] = [(0.0, 0.0), (640.0, 0.0), (640.0, 640.0), (0.0, 640.0)]  # one over the whole frame
    camera = {k: None if k % 2 else 1 for k in polys}
    zones = spark.createDataFrame([(k, camera[k], i, x, y) for k, p in polys.items() for i, (x, y) in enumerate(p)], ZONES)
    rows = [(k, rng.choice([1, 2]), 640, 640, x1 := rng.randrange(0, 600), x1 + rng.randrange(0, 40), rng.randrange(0, 640)) for k in range(60)]
    rows += [(60, 1, 640, 360, 30, 20, 100), (61, 1, 640, 360, 30, 30, 100)]
    dets = spark.createDataFrame(rows, "det_id int, camera_id int, w int, h int, x1 long, x2 long, y2 long")
    got = {(r.det_id, r.zone_id): r.hits for r in Z.zone_hits_indexed(dets, zones).collect()}
    want = {}
    for d, cam, w, h, x1, x2, y2 in rows:
        px = samples(x1, x2)
        for k, p in polys.items():
            if camera[k] in (None, cam):
                scaled = [(int(x * (w / 640)), int(y * (h / 640))) for x, y in p]
                if min(y for _, y in scaled) <= y2 <= max(y for _, y in scaled) and (n := sum(inside(x, y2, scaled) for x in px)):
                    want[d, k] = n
    assert got == want and len(want) > 100
    index = Z.zone_index(zones, dets.select("camera_id", "w", "h").distinct())
    reach = F.explode(F.sequence(F.floor(F.col("x1") / Z.SLAB), F.floor(F.col("x2") / Z.SLAB)))
    met = Z._probes(dets.where("x2 >= x1")).select("det_id", "_zkey", "w", "h", F.col("y2").alias("_y"), reach.alias("_slab")).join(
        index, ["_zkey", "w", "h", "_y", "_slab"]).groupBy("det_id").agg(F.countDistinct("zone_id").alias("n"))
    assert met.agg(F.max("n")).first()[0] < 100  # of 5,000 or 10,000


def test_sweep_finds_every_overlapping_pair(spark):
    rng = random.Random(11)
    rows = []
    for frame in range(60):
        for d in range(rng.choice([0, 1, 2, 30])):
            x, y = rng.randrange(40), rng.randrange(40)
            rows.append((frame, d + 1, rng.choice("ab"), x, y, x + rng.choice([0, 1, 5, 20]), y + rng.choice([0, 3, 12])))
    df = spark.createDataFrame(rows, "frame_id long, det_id int, label string, x1 long, y1 long, x2 long, y2 long")
    for same in (True, False):
        want = {}
        for a in rows:
            for b in rows:
                if a[0] == b[0] and a[1] < b[1] and (a[2] == b[2] or not same):
                    iw, ih = min(a[5], b[5]) - max(a[3], b[3]), min(a[6], b[6]) - max(a[4], b[4])
                    if iw > 0 and ih > 0:
                        area = sum((r[5] - r[3]) * (r[6] - r[4]) for r in (a, b))
                        want[a[0], a[1], b[1]] = (a[2], iw * ih / (area - iw * ih))
        out = N.overlapping_pairs(df, same_class=same)
        got = out.collect()
        assert {(r.frame_id, r.det_a, r.det_b): (r.label, r.iou) for r in got} == want and len(got) == len(want)
        assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def _plain(rows):
    f, last, out = 0, None, []
    for t, fail in rows:
        f, last, state = B.step(f, last, float(t), fail)
        out.append((state, f))
    return out


@pytest.mark.parametrize("gaps,share", [([0, 1, 40, 200, 400], 0.6), ([1, 2], 0.9), ([60, 90, 299, 301], 1.0), ([0], 1.0)])
def test_breaker_tree_equals_the_sequence(spark, monkeypatch, gaps, share):
    """A long camera and a short one: no group of the tree holds more than its fan."""
    rng = random.Random(len(gaps))
    rows, t = [], 0
    for k in range(3000):
        t += rng.choice(gaps)
        rows.append((0, k, t, rng.random() < share))
    rows += [(1, k, 10 * k, True) for k in range(9)]
    df = spark.createDataFrame(rows, "camera_id int, epoch_id long, t long, fail boolean")
    for chunk_rows, fan in ((10, 4), (7, 64)):
        got = {(r.camera_id, r.epoch_id): (r.state, r.failures) for r in B.breaker_batch(df, chunk_rows, fan).collect()}
        for cam in (0, 1):
            own = [r for r in rows if r[0] == cam]
            assert [got[cam, r[1]] for r in own] == _plain([r[2:] for r in own])


def test_transfers_are_associative():
    rng = np.random.default_rng(5)
    for _ in range(60):
        ts = np.sort(rng.integers(0, 2500, 40))
        fails = rng.random(40) < rng.choice([0.3, 0.8, 1.0])
        parts = []
        for k in range(4):
            pdf = pd.DataFrame({"camera_id": 1, "chunk": k, "pos": range(10), "t": ts[10 * k:10 * k + 10], "fail": fails[10 * k:10 * k + 10]})
            parts.append(B._transfers(B._summarize(pdf))[0][1])
        a, b, c, d = parts
        ways = [a.then(b).then(c).then(d), a.then(b.then(c.then(d))), a.then(b).then(c.then(d))]
        for f, last in [(c, None) for c in range(B.TH)] + [(B.TH, float(x)) for x in rng.integers(-400, int(ts[0]) + 1, 8)]:
            want_f, want_last, _, _ = B.run(f, last, ts, fails, fill=False)
            for way in ways:
                got_f, got_last = way.leave(f, last)
                assert got_f == want_f and (got_f < B.TH or got_last == want_last)


# --- the detector's deadline and batches ----------------------------------------------------

FRAME = "frame_id long, w int, h int, frame_b64 string"


def _frames(spark, n):
    import base64
    return spark.createDataFrame([(k, 640, 640, base64.b64encode(b"%d" % k + b"x" * 40).decode()) for k in range(n)], FRAME).coalesce(1)


def test_a_call_that_never_ends_costs_its_budget(spark):
    import time

    from zonewatch.operators import detect as D

    class Sleeps:
        def load(self):
            return True

        def infer(self, model, image, w, h):
            if image.startswith(b"3x"):
                while True:
                    try:
                        time.sleep(3600)
                    except Exception:  # a detector that holds on to everything it can
                        pass
            return [("car", 0.9, 1, 1, 2, 2)]

    class SleepsInBatches(Sleeps):
        def infer_batch(self, model, images, ws, hs):
            return [self.infer(model, *x) for x in zip(images, ws, hs, strict=True)]

    began = time.time()
    got = {r.frame_id: r.status for r in D.detect(_frames(spark, 6), Sleeps(), budget_s=1.0).collect()}
    assert got == {0: "DETECTED", 1: "DETECTED", 2: "DETECTED", 3: "BATCH_TIMEOUT", 4: "BATCH_TIMEOUT", 5: "BATCH_TIMEOUT"}
    assert {r.status for r in D.detect(_frames(spark, 6), SleepsInBatches(), budget_s=1.0).collect()} == {"BATCH_TIMEOUT"}
    assert time.time() - began < 60


def test_one_bad_row_of_a_batch_stands_alone(spark, tmp_path):
    from zonewatch.operators import detect as D
    calls = str(tmp_path / "calls")

    class Batches:
        def load(self):
            return True

        def infer_batch(self, model, images, ws, hs):
            with open(calls, "a") as f:
                f.write(f"{len(images)}\n")
            if any(i.startswith(b"7777x") for i in images):
                raise RuntimeError("device lost")
            return [[("car", 0.9, 1, 1, 2, 2)]] * len(images)

    got = D.detect(_frames(spark, 10_000), Batches()).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in got} == {"DETECTED": 9_999, "UDF_CRITICAL_ERROR": 1}
    assert len(open(calls).read().split()) <= 2 * 14 + 3  # two calls a halving, and the batches


def test_frames_without_time_left(spark):
    from zonewatch.operators import detect as D
    df = _frames(spark, 4).withColumn("left", F.expr("CASE frame_id WHEN 1 THEN 0 WHEN 2 THEN -5 WHEN 3 THEN NULL ELSE 9 END"))
    got = {r.frame_id: r.status for r in D.detect(df, D.StubDetector(), left_col="left").collect()}
    assert got[1] == got[2] == got[3] == "BATCH_TIMEOUT" and got[0] in ("DETECTED", "NO_OBJECTS")


# --- frame containers ------------------------------------------------------------------------


def _packed(spark, path, rows, files):
    from zonewatch.sources import containers
    containers.register(spark)
    df = spark.createDataFrame(rows, "name string, content binary").repartition(files)
    df.write.format(containers.FORMAT).mode("append").save(path)


def test_containers_are_read_by_byte_range(spark, tmp_path):
    import os

    from zonewatch.streaming import stream as ST
    path = str(tmp_path / "frames")
    rng = random.Random(4)
    rows = [(f"f{k}", rng.randbytes(rng.choice([0, 0, 1, 700, 5000]))) for k in range(800)] + [(None, None), ("long", b"z" * 300_000)]
    _packed(spark, path, rows, 3)
    assert len([f for f in os.listdir(path) if f.endswith(".bin")]) == 3  # not one a frame
    want = sorted((n or "", len(c or b"")) for n, c in rows)
    for size in ("20000", str(32 << 20)):
        got = ST.frame_containers(spark, path, range_bytes=size)
        assert sorted((r.name, r.length) for r in got.collect()) == want
        assert (got.rdd.getNumPartitions() > 30) == (size == "20000")
    contents = spark.read.format("frame_container").load(path).where("name <> ''").collect()
    assert {r.name: bytes(r.content) for r in contents} == {n: c for n, c in rows if n}
    assert spark.read.format("frame_container").load(str(tmp_path / "nothing")).count() == 0


def test_containers_as_a_stream(spark, tmp_path):
    from zonewatch.streaming import stream as ST
    path, out, ckpt = (str(tmp_path / x) for x in ("frames", "out", "ckpt"))
    for turn in range(3):
        _packed(spark, path, [(f"{turn}-{k}", b"x" * k) for k in range(50)], 2)
        q = (ST.frame_containers(spark, path, stream=True).select("name", "length").writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).start())
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        names = [r.name for r in spark.read.parquet(out).collect()]
        assert sorted(names) == sorted(f"{t}-{k}" for t in range(turn + 1) for k in range(50))
