"""Queries over frames and detections: verdicts, geometry, joins, top-k."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from zonewatch import config
from zonewatch.functions import geometry
from zonewatch.operators import verdict as V
from zonewatch.operators import zones as Z
from zonewatch.plans.oracle_views import with_views as W
from zonewatch.plans.registry import register
from zonewatch.sources import fixtures as fx

T = config.CONF_THRESHOLD
VEH = "('car', 'motorbike')"


def _usable(spark, sf, with_det_id=True):
    """Detections of existing frames with conf >= threshold inside the size gate."""
    d = fx.detections(spark, sf, min_conf=T, with_det_id=with_det_id)
    return d.where(fx.size_ok(F.col("w"), F.col("h")))


# ------------------------------------------------------------------ E3 etc.
@register("frame_verdicts", "E3", W("verdicts") + "SELECT * FROM verdicts")
def frame_verdicts(spark, sf):
    return V.frame_verdicts(fx.frames(spark, sf), fx.raw_detections(spark, sf, min_conf=T))


@register("nested_frame_verdicts", "E3", W("verdicts") + "SELECT * FROM verdicts")
def nested_frame_verdicts(spark, sf):
    return V.nested_verdicts(fx.frames_nested(spark, sf, min_conf=T))


@register("red_light_frames", "E1",
          W("verdicts") + "SELECT frame_id, camera_id FROM verdicts WHERE red_light")
def red_light_frames(spark, sf):
    return frame_verdicts(spark, sf).where("red_light").select("frame_id", "camera_id")


@register("zone_frames", "E2",
          W("verdicts") + "SELECT frame_id, camera_id FROM verdicts WHERE vehicle_in_zone")
def zone_frames(spark, sf):
    return frame_verdicts(spark, sf).where("vehicle_in_zone").select("frame_id", "camera_id")


@register("empty_frames", "E4/F4", W("frames", "usable") + """
SELECT f.frame_id, f.camera_id FROM frames f
WHERE NOT EXISTS (SELECT 1 FROM usable u WHERE u.frame_id = f.frame_id)""")
def empty_frames(spark, sf):
    usable = fx.raw_detections(spark, sf, min_conf=T).where(fx.size_ok(F.col("w"), F.col("h")))
    return (fx.frames(spark, sf).select("frame_id", "camera_id")
            .join(usable.select("frame_id"), "frame_id", "left_anti"))


@register("vehicle_verdicts", "E5", W("usable", "vehicle_hits") + f"""
SELECT u.frame_id, u.det_id, u.label, u.conf, u.x1, u.y1, u.x2, u.y2,
       vh.hits * 2 > {config.NUM_SAMPLE_STEPS} AS in_zone,
       vh.hits * 2 > {config.NUM_SAMPLE_STEPS}
         AND EXISTS (SELECT 1 FROM usable r WHERE r.frame_id = u.frame_id AND r.label = 'red_light') AS violator
FROM usable u JOIN vehicle_hits vh ON vh.frame_id = u.frame_id AND vh.det_id = u.det_id
WHERE u.label IN {VEH}""")
def vehicle_verdicts(spark, sf):
    return V.vehicle_verdicts(fx.detections(spark, sf, min_conf=T))


@register("red_semi_join", "F1", W("usable") + f"""
SELECT u.frame_id, u.det_id, u.label FROM usable u
WHERE u.label IN {VEH}
  AND EXISTS (SELECT 1 FROM usable r WHERE r.frame_id = u.frame_id AND r.label = 'red_light')""")
def red_semi_join(spark, sf):
    u = _usable(spark, sf)
    flagged = V.with_frame_red(u.withColumn("is_red", V.is_red_light(F.col("label"))))
    return flagged.where(V.is_vehicle(F.col("label")) & F.col("frame_red")).select("frame_id", "det_id", "label")


@register("frame_report", "E15", W("verdicts", "frames") + """
SELECT camera_id, frame_no, frame_id,
       CASE WHEN red_light THEN 'ON' ELSE 'OFF' END AS red_light,
       CASE WHEN violation THEN 'DETECTED' ELSE 'NONE' END AS violation,
       'frame_' || frame_no || '_' || CASE WHEN violation THEN 'VIOLATION' ELSE 'NORMAL' END
         || '_' || CASE WHEN red_light THEN 'RED' ELSE 'GREEN' END || '.jpg' AS file_name
FROM (SELECT v.*, row_number() OVER (PARTITION BY f.camera_id ORDER BY f.captured_at, f.frame_id) - 1 AS frame_no
      FROM verdicts v JOIN frames f USING (frame_id, camera_id)) t
WHERE frame_no = 100""")
def frame_report(spark, sf):
    """The single-frame report of frame 100 of every camera (B14 + C8)."""
    from zonewatch.operators import frames_ops
    numbered = frames_ops.frame_numbers(fx.frames(spark, sf).select("frame_id", "camera_id", "captured_at"))
    one = frames_ops.frame_seek(numbered, 100)
    # the frames are chosen first: the zone test runs on their detections only
    ids = one.select("frame_id")
    fv = V.frame_verdicts(fx.frames(spark, sf).join(ids, "frame_id", "left_semi"),
                          fx.raw_detections(spark, sf, min_conf=T).join(ids, "frame_id", "left_semi"))
    one = one.join(fv.select("frame_id", "red_light", "violation"), "frame_id")
    return one.select(
        "camera_id", "frame_no", "frame_id",
        F.when(F.col("red_light"), "ON").otherwise("OFF").alias("red_light"),
        F.when(F.col("violation"), "DETECTED").otherwise("NONE").alias("violation"),
        frames_ops.frame_label_name(F.col("frame_no"), F.col("violation"), F.col("red_light")).alias("file_name"))


# ------------------------------------------------------------- B9-B11 filters
@register("vehicles_only", "B9", W("dets") + f"SELECT frame_id, det_id, label FROM dets WHERE label IN {VEH}")
def vehicles_only(spark, sf):
    d = fx.detections(spark, sf)
    return d.where(V.is_vehicle(F.col("label"))).select("frame_id", "det_id", "label")


@register("conf_filter", "B10", W("dets") + f"SELECT frame_id, det_id, conf FROM dets WHERE conf >= {T}")
def conf_filter(spark, sf):
    return fx.detections(spark, sf, min_conf=T).select("frame_id", "det_id", "conf")


@register("size_gate", "B11", W("frames") + f"""
SELECT frame_id, w, h FROM frames
WHERE w BETWEEN {config.MIN_SIDE} AND {config.MAX_SIDE} AND h BETWEEN {config.MIN_SIDE} AND {config.MAX_SIDE}""")
def size_gate(spark, sf):
    fr = fx.frames(spark, sf)
    return fr.where(fx.size_ok(F.col("w"), F.col("h"))).select("frame_id", "w", "h")


# ------------------------------------------------------------- D1-D6 geometry
@register("downscale_dims", "D1", W("frames") + "SELECT frame_id, src_w, src_h, w, h FROM frames")
def downscale_dims(spark, sf):
    return fx.frames(spark, sf).select("frame_id", "src_w", "src_h", "w", "h")


@register("scale_zone", "D2", W("frames", "zone_ref") + """
SELECT f.frame_id, CAST(z.k AS INTEGER) AS vertex_no,
       CAST(trunc(z.x * (f.w / 640)) AS BIGINT) AS x, CAST(trunc(z.y * (f.h / 640)) AS BIGINT) AS y
FROM frames f, zone_ref z""")
def scale_zone(spark, sf):
    fr = fx.frames(spark, sf)
    return (fr.select("frame_id", F.posexplode(geometry.scale_zone_array(F.col("w"), F.col("h"))))
              .select("frame_id", F.col("pos").cast("int").alias("vertex_no"),
                      F.col("col.x").alias("x"), F.col("col.y").alias("y")))


def _samples(spark, sf):
    u = _usable(spark, sf).where(V.is_vehicle(F.col("label")))
    s = u.select("frame_id", "det_id", "x1", "x2", "y2", "w", "h",
                 F.explode(F.sequence(F.lit(0), F.lit(config.NUM_SAMPLE_STEPS))).alias("i"))
    px = geometry.idiv(F.col("x1") * config.NUM_SAMPLE_STEPS + F.col("i") * (F.col("x2") - F.col("x1")),
                       config.NUM_SAMPLE_STEPS)
    return s.select("frame_id", "det_id", F.col("i").cast("int").alias("i"), px.alias("x"),
                    F.col("y2").alias("y"), "w", "h")


@register("bottom_samples", "D3", W("sample_tests") +
          "SELECT frame_id, det_id, CAST(i AS INTEGER) AS i, px AS x, py AS y FROM sample_tests")
def bottom_samples(spark, sf):
    return _samples(spark, sf).select("frame_id", "det_id", "i", "x", "y")


@register("point_in_zone", "D4", W("sample_tests") + """
SELECT frame_id, det_id, CAST(i AS INTEGER) AS i, on_edge OR crossings % 2 = 1 AS inside FROM sample_tests""")
def point_in_zone(spark, sf):
    s = _samples(spark, sf)
    verts = geometry.scale_zone(F.col("w"), F.col("h"))
    return s.select("frame_id", "det_id", "i",
                    geometry.point_in_polygon(F.col("x"), F.col("y"), verts).alias("inside"))


@register("box_in_zone", "D5", W("vehicle_hits") + f"""
SELECT frame_id, det_id, hits, hits * 2 > {config.NUM_SAMPLE_STEPS} AS in_zone FROM vehicle_hits""")
def box_in_zone(spark, sf):
    u = _usable(spark, sf).where(V.is_vehicle(F.col("label")))
    h = geometry.with_zone_hits(u, "hits")
    return h.select("frame_id", "det_id", F.col("hits").cast("long").alias("hits"),
                    (F.col("hits") * 2 > config.NUM_SAMPLE_STEPS).alias("in_zone"))


@register("trunc_boxes", "D6", W("dets") + """
SELECT frame_id, det_id,
       CAST(trunc(x1 + conf / 2) AS INTEGER) AS x1, CAST(trunc(y1 + conf / 2) AS INTEGER) AS y1,
       CAST(trunc(x2 + conf / 2) AS INTEGER) AS x2, CAST(trunc(y2 + conf / 2) AS INTEGER) AS y2
FROM dets""")
def trunc_boxes(spark, sf):
    """Detector boxes are floats; ``map(int, xyxy)`` truncates toward zero.
    The fixture's float boxes are the integer box plus conf/2 (< 1 px)."""
    d = fx.detections(spark, sf)
    off = F.col("conf") / 2
    return d.select("frame_id", "det_id",
                    *[(F.col(c) + off).cast("int").alias(c) for c in ["x1", "y1", "x2", "y2"]])


# ------------------------------------------------------------- F2/F3 joins
@register("label_lookup", "F3", W("dets") + """
SELECT d.frame_id, d.det_id, d.class_id, c.label, c.is_vehicle, c.is_signal
FROM dets d JOIN (VALUES (0, 'car', true, false), (1, 'motorbike', true, false), (2, 'person', false, false),
                         (3, 'red_light', false, true), (4, 'stop_line', false, false))
     c(class_id, label, is_vehicle, is_signal) ON c.class_id = d.class_id""")
def label_lookup(spark, sf):
    d = fx.detections(spark, sf).select("frame_id", "det_id", "class_id")
    return Z.lookup_classes(d, fx.classes(spark))


@register("zone_broadcast_join", "F2", W("vehicle_hits") + f"""
SELECT frame_id, det_id, 0 AS zone_id, hits, hits * 2 > {config.NUM_SAMPLE_STEPS} AS in_zone FROM vehicle_hits""")
def zone_broadcast_join(spark, sf):
    u = _usable(spark, sf).where(V.is_vehicle(F.col("label")))
    cams = fx.frames(spark, sf).select("frame_id", "camera_id")
    u = u.join(cams, "frame_id")
    out = Z.zone_hits_from_table(u, fx.zones(spark))
    return out.select("frame_id", "det_id", "zone_id", F.col("hits").cast("long").alias("hits"),
                      (F.col("hits") * 2 > config.NUM_SAMPLE_STEPS).alias("in_zone"))


# fixed values: a grid of overlapping rectangles per camera, in the reference space
GRID, PITCH, SIDE = 10, 64, 80


def grid_zones(spark, sf):
    """Many zones a camera: a grid of rectangles, moved by the camera's number."""
    cams = fx.frames(spark, sf).select("camera_id").distinct()
    cells = cams.select("camera_id", F.explode(F.sequence(F.lit(0), F.lit(GRID * GRID - 1))).alias("k"))
    left, top = F.col("k") % GRID * PITCH + F.col("camera_id"), F.floor(F.col("k") / GRID) * PITCH
    corners = F.array(*[F.struct((left + dx).cast("double").alias("x"), (top + dy).cast("double").alias("y"))
                        for dx, dy in ((0, 0), (SIDE, 0), (SIDE, SIDE), (0, SIDE))])
    at = cells.select((F.col("camera_id") * GRID * GRID + F.col("k")).cast("int").alias("zone_id"), "camera_id",
                      F.posexplode(corners).alias("vertex_no", "c"))
    return at.select("zone_id", "camera_id", "vertex_no", "c.x", "c.y")


@register("zone_index_hits", "F2", W("usable", "frames") + f""", v AS (
  SELECT u.frame_id, u.det_id, f.camera_id AS cam, u.w AS w, u.h AS h, u.x1 AS x1, u.x2 AS x2, u.y2 AS py
  FROM usable u JOIN frames f ON f.frame_id = u.frame_id WHERE u.label IN {VEH}),
z AS (SELECT v.*, k.k AS k FROM v CROSS JOIN (SELECT unnest(range({GRID * GRID})) AS k) k),
b AS (SELECT frame_id, det_id, cam, k, x1, x2, py,
             CAST(trunc((k % {GRID} * {PITCH} + cam) * (w / 640)) AS BIGINT) AS lo,
             CAST(trunc((k % {GRID} * {PITCH} + cam + {SIDE}) * (w / 640)) AS BIGINT) AS hi,
             CAST(trunc((k // {GRID} * {PITCH}) * (h / 640)) AS BIGINT) AS top,
             CAST(trunc((k // {GRID} * {PITCH} + {SIDE}) * (h / 640)) AS BIGINT) AS bottom FROM z),
n AS (SELECT frame_id, det_id, cam, k, {" + ".join(
    f"CASE WHEN ({config.NUM_SAMPLE_STEPS} * x1 + {i} * (x2 - x1)) // {config.NUM_SAMPLE_STEPS} BETWEEN lo AND hi THEN 1 ELSE 0 END"
    for i in range(config.NUM_SAMPLE_STEPS + 1))} AS hits FROM b WHERE py BETWEEN top AND bottom)
SELECT frame_id, det_id, CAST(cam * {GRID * GRID} + k AS INTEGER) AS zone_id, CAST(hits AS BIGINT) AS hits FROM n WHERE hits > 0""")
def zone_index_hits(spark, sf):
    """F2 with a hundred zones a camera, through the zone index."""
    u = _usable(spark, sf).where(V.is_vehicle(F.col("label")))
    u = u.join(fx.frames(spark, sf).select("frame_id", "camera_id").hint("merge"), "frame_id")
    return Z.zone_hits_indexed(u, grid_zones(spark, sf)).select("frame_id", "det_id", "zone_id", "hits")


# ------------------------------------------------------------- E11/E13/G3
@register("class_histogram", "E11", W("usable") + """
SELECT frame_id, label, count(*) AS n, min(conf) AS min_conf, max(conf) AS max_conf
FROM usable GROUP BY frame_id, label""")
def class_histogram(spark, sf):
    u = fx.raw_detections(spark, sf, min_conf=T).where(fx.size_ok(F.col("w"), F.col("h")))
    u = u.join(fx.frames(spark, sf).select("frame_id"), "frame_id", "left_semi")
    return u.groupBy("frame_id", "label").agg(F.count(F.lit(1)).alias("n"),
                                              F.min("conf").alias("min_conf"),
                                              F.max("conf").alias("max_conf"))


@register("nest_detections", "E13", W("dets") + """
SELECT frame_id, count(*) AS n_detections,
       string_agg(det_id || ':' || label, ',' ORDER BY det_id) AS det_list
FROM dets GROUP BY frame_id""")
def nest_detections(spark, sf):
    n = fx.nest(fx.detections(spark, sf))
    return n.select("frame_id", F.size("detections").cast("long").alias("n_detections"),
                    F.array_join(F.transform("detections",
                                             lambda d: F.concat(d["det_id"].cast("string"), F.lit(":"), d["label"])),
                                 ",").alias("det_list"))


@register("max_det_topk", "G3", W("usable") + """
SELECT frame_id, det_id, conf, CAST(rk AS INTEGER) AS rank FROM (
  SELECT frame_id, det_id, conf, row_number() OVER (PARTITION BY frame_id ORDER BY conf DESC, det_key, x1, y1, x2, y2) AS rk
  FROM usable) t WHERE rk <= 3""")
def max_det_topk(spark, sf):
    """G3 with k = 3 (the detector's max_det is 50; fixtures have <= 17 per frame)."""
    from zonewatch.operators import nms
    return nms.top_k(_usable(spark, sf), 3).select("frame_id", "det_id", "conf", "rank")


@register("detection_lines", "C13", W("usable") + """
SELECT frame_id, det_id, printf('%s: %.2f', label, conf) AS line FROM usable""")
def detection_lines(spark, sf):
    u = _usable(spark, sf)
    return u.select("frame_id", "det_id", F.format_string("%s: %.2f", "label", "conf").alias("line"))


@register("annotation_manifest", "D10", W("usable", "vehicle_hits") + f"""
SELECT u.frame_id, u.det_id, u.x1, u.y1, u.x2, u.y2,
       CASE WHEN u.label NOT IN {VEH} THEN 'detector'
            WHEN vh.hits * 2 > {config.NUM_SAMPLE_STEPS} AND fr.red THEN 'red' ELSE 'green' END AS colour,
       CASE WHEN u.label NOT IN {VEH} THEN printf('%s %.2f', u.label, u.conf)
            WHEN vh.hits * 2 > {config.NUM_SAMPLE_STEPS} AND fr.red THEN 'VIOLATION! ' || printf('%s %.2f', u.label, u.conf)
            ELSE printf('%s %.2f', u.label, u.conf) END AS caption
FROM usable u
LEFT JOIN vehicle_hits vh ON vh.frame_id = u.frame_id AND vh.det_id = u.det_id
JOIN (SELECT frame_id, bool_or(label = 'red_light') AS red FROM usable GROUP BY frame_id) fr ON fr.frame_id = u.frame_id""")
def annotation_manifest(spark, sf):
    """Per-detection drawing instructions (box, colour, caption) instead
    of drawn pixels: violators red, other vehicles green, the rest as the
    detector draws them."""
    u = _usable(spark, sf)
    j = V.with_frame_red(V.with_flags(u))
    veh = V.is_vehicle(F.col("label"))
    viol = veh & F.col("in_zone") & F.col("frame_red")
    cap = F.format_string("%s %.2f", "label", "conf")
    return j.select("frame_id", "det_id", "x1", "y1", "x2", "y2",
                    F.when(~veh, "detector").when(viol, "red").otherwise("green").alias("colour"),
                    F.when(viol, F.concat(F.lit("VIOLATION! "), cap)).otherwise(cap).alias("caption"))


@register("frame_label_name", "C8", W("verdicts", "frames") + """
SELECT frame_id,
       'frame_' || frame_no || '_' || CASE WHEN violation THEN 'VIOLATION' ELSE 'NORMAL' END
         || '_' || CASE WHEN red_light THEN 'RED' ELSE 'GREEN' END || '.jpg' AS file_name
FROM (SELECT v.frame_id, v.violation, v.red_light,
             row_number() OVER (PARTITION BY f.camera_id ORDER BY f.captured_at, f.frame_id) - 1 AS frame_no
      FROM verdicts v JOIN frames f USING (frame_id, camera_id)) t""")
def frame_label_name(spark, sf):
    """The single-frame check's file name for every frame (frame number
    within its camera, verdict, light)."""
    from zonewatch.operators import frames_ops
    fv = frame_verdicts(spark, sf).select("frame_id", "red_light", "violation")
    numbered = frames_ops.frame_numbers(fx.frames(spark, sf).select("frame_id", "camera_id", "captured_at"))
    j = numbered.join(fv, "frame_id")
    return j.select("frame_id", frames_ops.frame_label_name(F.col("frame_no"), F.col("violation"),
                                                            F.col("red_light")).alias("file_name"))
