"""Golden rows of FIXTURES.md section 3 (geometry, base64, NMS, breaker, errors)."""

import pytest
from pyspark.sql import functions as F

from zonewatch import config
from zonewatch.functions import geometry, payload as P
from zonewatch.operators import breaker as B
from zonewatch.operators import nms as N


def _zone(spark, w, h):
    verts = geometry.scale_zone(F.lit(w), F.lit(h))
    row = spark.range(1).select(*[c for v in verts for c in v]).first()
    return [(row[2 * i], row[2 * i + 1]) for i in range(len(verts))]


@pytest.mark.parametrize("w,h,expected", [
    (640, 640, [(0, 522), (107, 578), (367, 446), (0, 332)]),
    (640, 360, [(0, 293), (107, 325), (367, 250), (0, 187)]),
    (1280, 720, [(0, 587), (215, 650), (734, 501), (0, 374)]),
    (640, 480, [(0, 391), (107, 433), (367, 334), (0, 249)]),
    (320, 240, [(0, 195), (53, 216), (183, 167), (0, 124)]),
])
def test_scaled_zone(spark, w, h, expected):
    assert _zone(spark, w, h) == expected


def test_points(spark):
    inside = [(0, 400), (0, 522), (0, 332), (107, 578), (367, 446), (100, 450)]
    outside = [(368, 446), (0, 331), (300, 300)]
    verts = geometry.scale_zone(F.lit(640), F.lit(640))
    rows = spark.createDataFrame(inside + outside, "x long, y long").select(
        "x", "y", geometry.point_in_polygon(F.col("x"), F.col("y"), verts).alias("inside")).collect()
    got = {(r.x, r.y): r.inside for r in rows}
    assert all(got[p] for p in inside)
    assert not any(got[p] for p in outside)


BOXES = [
    (640, 640, (318, 300, 418, 446), 5, False),
    (640, 640, (317, 300, 417, 446), 6, True),
    (640, 640, (50, 350, 150, 450), 11, True),
    (640, 640, (400, 100, 500, 300), 0, False),
    (640, 640, (100, 500, 200, 560), 5, False),
    (640, 360, (300, 200, 400, 250), 7, True),
    (640, 360, (317, 100, 417, 250), 6, True),
]


def test_boxes_staged_and_hof(spark):
    rows = [(w, h, x1, y1, x2, y2) for w, h, (x1, y1, x2, y2), _, _ in BOXES]
    df = spark.createDataFrame(rows, "w int, h int, x1 long, y1 long, x2 long, y2 long")
    staged = geometry.with_zone_hits(df, "hits").orderBy("w", "h", "x1", "y1").collect()
    by_box = {(r.w, r.h, r.x1, r.y1, r.x2, r.y2): r.hits for r in staged}
    # the same test through the table-driven (array polygon) form
    from zonewatch.operators import zones as Z
    from zonewatch.sources import fixtures as fx
    tbl = Z.zone_hits_from_table(df.withColumn("camera_id", F.lit(1)), fx.zones(spark)).collect()
    by_box2 = {(r.w, r.h, r.x1, r.y1, r.x2, r.y2): r.hits for r in tbl}
    for w, h, box, hits, inside in BOXES:
        assert by_box[(w, h) + box] == hits
        assert by_box2[(w, h) + box] == hits
        assert (hits * 2 > config.NUM_SAMPLE_STEPS) == inside


def test_downscale(spark):
    cases = [((1920, 1080), (640, 360)), ((800, 600), (640, 480)), ((1366, 768), (640, 359)),
             ((1077, 480), (639, 285)), ((640, 480), (640, 480))]
    df = spark.createDataFrame([c[0] for c in cases], "w int, h int")
    w, h = geometry.downscale_dims(F.col("w"), F.col("h"))
    got = [(r[0], r[1]) for r in df.select(w, h).collect()]
    assert got == [c[1] for c in cases]


def test_downscale_trap_count(spark):
    """45 widths in 641..4096 give 639; the first is 1077."""
    df = spark.range(641, 4097).select(F.col("id").cast("int").alias("w"))
    w, _ = geometry.downscale_dims(F.col("w"), F.lit(480))
    traps = df.where(w == 639).orderBy("w").collect()
    assert len(traps) == 45 and traps[0].w == 1077


B64 = [("QUJD", True, 3), ("QUJD\n", True, 3), ("QU\nJD", False, 3), ("QUI", True, None),
       ("QQ", True, None), ("Q", True, None), ("QUJDQ", True, None), ("QU=D", False, None),
       ("QUJD====", False, 3), ("BATCH_TIMEOUT", False, 9)]


def test_base64_table(spark):
    df = spark.createDataFrame([(s,) for s, _, _ in B64], "s string")
    rows = df.select("s", P.base64_gate(F.col("s")).alias("gate"),
                     P.decoded_length(F.col("s")).alias("n"),
                     F.hex(P.b64_decode(F.col("s"))).alias("hex")).collect()
    got = {r.s: (r.gate, r.n, r.hex) for r in rows}
    for s, gate, n in B64:
        assert got[s][0] == gate, s
        assert got[s][1] == n, s
    assert got["QUJD"][2] == "414243" and got["QUJD===="][2] == "414243"


def test_base64_matches_python(spark):
    """The non-strict decode rule equals CPython's ``base64.b64decode``."""
    import base64
    import random
    rng = random.Random(7)
    alphabet = "AB+/=\n-_ "
    samples = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    expect = {}
    for s in samples:
        try:
            expect[s] = base64.b64decode(s).hex().upper()
        except Exception:
            expect[s] = None
    df = spark.createDataFrame([(s,) for s in set(samples)], "s string")
    rows = df.select("s", F.hex(P.b64_decode(F.col("s"))).alias("hex")).collect()
    for r in rows:
        assert r.hex == expect[r.s], repr(r.s)


def test_validation_reasons(spark):
    import base64
    good = base64.b64encode(b"x" * 1500).decode()
    small = base64.b64encode(b"x" * 200).decode()
    cases = [(None, config.REASON_EMPTY), ("", config.REASON_EMPTY), ("QUJD", config.REASON_SHORT),
             ("a b" * 50, config.REASON_CHARS), (good, config.REASON_VALID), (small, config.REASON_SMALL),
             ("é" * 120, config.REASON_DECODE), ("QUJDQ" * 30, config.REASON_DECODE)]
    df = spark.createDataFrame(cases, "s string, want string")
    for r in df.select("want", P.validate_payload(F.col("s")).alias("got")).collect():
        assert r.got == r.want


def test_nms_golden(spark):
    boxes = [(1, "car", 0.9, 0, 0, 100, 100), (2, "car", 0.8, 0, 30, 100, 130),
             (3, "car", 0.7, 0, 60, 100, 160), (4, "car", 0.6, 0, 0, 100, 45),
             (5, "motorbike", 0.5, 0, 0, 100, 100)]
    df = spark.createDataFrame([(1,) + b for b in boxes],
                               "frame_id long, det_id int, label string, conf double, x1 long, y1 long, x2 long, y2 long")
    nested = df.groupBy("frame_id").agg(F.collect_list(F.struct("det_id", "label", "conf", "x1", "y1", "x2", "y2"))
                                        .alias("detections"))
    kept = N.nms(nested).select(F.transform("kept", lambda d: d["det_id"]).alias("ids")).first().ids
    assert sorted(kept) == [1, 3, 4, 5]


TRACE = [(0, .05, "CLOSED", 1), (60, 0, "CLOSED", 2), (120, .9, "CLOSED", 2), (180, .02, "CLOSED", 3),
         (240, .09, "CLOSED", 4), (300, .1, "CLOSED", 4), (360, 0, "CLOSED", 5), (420, .9, "OPEN", 5),
         (600, .9, "OPEN", 5), (660, .9, "OPEN", 5), (661, .9, "RESET", 0), (720, 0, "CLOSED", 1)]


def test_breaker_trace_python():
    _, _, states, counts = B.run(0, None, [t for t, *_ in TRACE], [r < 0.1 for _, r, *_ in TRACE])
    assert states == [s for *_, s, _ in TRACE]
    assert counts == [c for *_, c in TRACE]


@pytest.mark.parametrize("chunk", [1, 2, 3, 5, 100])
def test_breaker_trace_chunked(spark, chunk):
    rows = [(7, i, t, r < 0.1) for i, (t, r, _, _) in enumerate(TRACE)]
    df = spark.createDataFrame(rows, "camera_id int, epoch_id long, t long, fail boolean")
    got = B.breaker_batch(df, chunk_rows=chunk).orderBy("t").collect()
    assert [(r.state, r.failures) for r in got] == [(s, c) for *_, s, c in TRACE]


def test_error_classes(spark):
    from zonewatch.operators import metrics as M
    rows = [(1, "java.lang.OutOfMemoryError: x"), (2, "Arrow stream closed"), (3, "Socket timeout"),
            (4, "Topic not found")]
    df = spark.createDataFrame(rows, "batch_id long, error string")
    got = {r.batch_id: (r.error_class, r.disables_udf) for r in M.classify_errors(df).collect()}
    assert got == {1: ("resource", False), 2: ("resource", True), 3: ("resource", True), 4: ("other", False)}


def test_concave_zone_general_path(spark):
    """A concave zone takes the general ray-test branch; it must agree with
    the table-driven (array polygon) form and with a direct Python count."""
    from zonewatch.operators import zones as Z
    zone = [(0.0, 300.0), (320.0, 600.0), (640.0, 300.0), (320.0, 450.0)]  # arrow head, concave
    rows = [(640, 640, x1, 0, x1 + span, y2) for x1 in range(0, 600, 37) for span in (10, 80, 200)
            for y2 in (299, 300, 350, 449, 450, 451, 520, 599)]
    df = spark.createDataFrame(rows, "w int, h int, x1 long, y1 long, x2 long, y2 long")
    staged = {tuple(r[:6]): r.hits for r in geometry.with_zone_hits(df, "hits", zone=zone).collect()}
    zt = spark.createDataFrame([(0, None, i, x, y) for i, (x, y) in enumerate(zone)],
                               "zone_id int, camera_id int, vertex_no int, x double, y double")
    table = {tuple(r[:6]): r.hits for r in
             Z.zone_hits_from_table(df.withColumn("camera_id", F.lit(3)), zt).collect()}

    def inside(px, py, poly):
        on, cross = False, 0
        for k in range(len(poly)):
            (ax, ay), (bx, by) = poly[k], poly[(k + 1) % len(poly)]
            cr = (bx - ax) * (py - ay) - (px - ax) * (by - ay)
            if cr == 0 and min(ax, bx) <= px <= max(ax, bx) and min(ay, by) <= py <= max(ay, by):
                on = True
            if (ay > py) != (by > py) and (by > ay) == (cr > 0):
                cross += 1
        return on or cross % 2 == 1

    poly = [(int(x), int(y)) for x, y in zone]
    for r in rows:
        w, h, x1, y1, x2, y2 = r
        want = sum(inside((10 * x1 + i * (x2 - x1)) // 10, y2, poly) for i in range(11))
        assert staged[r] == want == table[r], r
