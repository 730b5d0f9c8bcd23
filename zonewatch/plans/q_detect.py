"""Detector post-processing and the detector itself."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from zonewatch import config
from zonewatch.functions import payload as P
from zonewatch.operators import detect as D
from zonewatch.operators import nms as N
from zonewatch.plans.oracle_views import decoded_len_sql
from zonewatch.plans.oracle_views import with_views as W
from zonewatch.plans.q_frames import _usable
from zonewatch.plans.q_payload import gate_sql
from zonewatch.plans.registry import register
from zonewatch.sources import fixtures as fx

_IOU = ("CAST(greatest(least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1), 0) * "
        "greatest(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1), 0) AS DOUBLE) / "
        "(({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1) + ({b}.x2 - {b}.x1) * ({b}.y2 - {b}.y1) - "
        "greatest(least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1), 0) * "
        "greatest(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1), 0))")


@register("pairwise_iou", "D7/F5", W("usable") + f"""
SELECT a.frame_id, a.det_id AS det_a, b.det_id AS det_b, a.label, {_IOU.format(a='a', b='b')} AS iou
FROM usable a JOIN usable b ON a.frame_id = b.frame_id AND a.label = b.label AND a.det_id < b.det_id
WHERE least(a.x2, b.x2) > greatest(a.x1, b.x1) AND least(a.y2, b.y2) > greatest(a.y1, b.y1)""")
def pairwise_iou(spark, sf):
    return N.overlapping_pairs(_usable(spark, sf))


_NMS_SQL = W("usable").replace("WITH ", "WITH RECURSIVE ", 1) + f""", ranked AS (
  SELECT frame_id, label, det_id, x1, y1, x2, y2,
         row_number() OVER (PARTITION BY frame_id, label ORDER BY conf DESC, det_id) AS k
  FROM usable),
fold(frame_id, label, k, kept) AS (
  SELECT frame_id, label, k, [{{'det_id': det_id, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}]
  FROM ranked WHERE k = 1
  UNION ALL
  SELECT d.frame_id, d.label, d.k,
         CASE WHEN len(list_filter(f.kept, lambda q: {_IOU.format(a='q', b='d')} > {config.IOU_THRESHOLD})) > 0
              THEN f.kept
              ELSE list_append(f.kept, {{'det_id': d.det_id, 'x1': d.x1, 'y1': d.y1, 'x2': d.x2, 'y2': d.y2}}) END
  FROM fold f JOIN ranked d ON d.frame_id = f.frame_id AND d.label = f.label AND d.k = f.k + 1),
last AS (
  SELECT frame_id, label, kept FROM fold
  QUALIFY k = max(k) OVER (PARTITION BY frame_id, label))
SELECT frame_id, label, CAST(unnest(kept).det_id AS INTEGER) AS det_id FROM last"""


@register("nms", "D8", _NMS_SQL)
def nms(spark, sf):
    nested = fx.nest(_usable(spark, sf))
    kept = N.nms(nested)
    return kept.select("frame_id", F.explode("kept").alias("d")).select(
        "frame_id", F.col("d.label").alias("label"), F.col("d.det_id").alias("det_id"))


# ----------------------------------------------------------- J1-J4 and B6
def _recorded(spark, sf):
    return fx.recorded_frames(spark, sf).select("frame_id", "camera_id", "epoch_id", "w", "h", "recorded")


def frames_with_payload(spark, sf, base=None):
    """Frames (``base``: the recorded ones, with more columns) with their payload and the detections recorded for them."""
    base = base if base is not None else _recorded(spark, sf)
    return fx.frame_payloads(spark, sf, base=base)


# what the detector run says of each frame, ungated: an image that does not decode fails alone
_RUN = W("payloads", "dets", "frames") + f""", run AS (
  SELECT p.frame_id, coalesce(d.n, 0) AS found,
         CASE WHEN p.frame_b64 IS NULL OR (p.frame_b64 <> '' AND {decoded_len_sql('p.frame_b64')} IS NULL) THEN 'ROW_ERROR'
              WHEN coalesce(d.n, 0) > 0 THEN 'DETECTED' ELSE 'NO_OBJECTS' END AS status
  FROM payloads p
  LEFT JOIN (SELECT frame_id, count(*) AS n FROM dets WHERE conf >= {config.CONF_THRESHOLD} GROUP BY frame_id) d
    ON d.frame_id = p.frame_id)
"""


def _run(spark, sf):
    return D.detect(frames_with_payload(spark, sf), D.RecordedDetector(), keep=["frame_id"])


@register("detect_recorded", "J1", _RUN + f"""
SELECT frame_id, status, CASE WHEN status = 'DETECTED' THEN least(found, {config.MAX_DET}) ELSE 0 END AS n_objects FROM run""")
def detect_recorded(spark, sf):
    """The detector over every frame payload; typed detections."""
    return _run(spark, sf).select(
        "frame_id", "status", F.coalesce(F.size("detections"), F.lit(0)).cast("long").alias("n_objects"))


@register("row_faults", "J2", _RUN + "SELECT frame_id, status FROM run WHERE status = 'ROW_ERROR'")
def row_faults(spark, sf):
    """Rows whose payload cannot be decoded fail alone (ROW_ERROR)."""
    return _run(spark, sf).where(F.col("status") == "ROW_ERROR").select("frame_id", "status")


@register("detect_budget", "J3", _RUN + f"""
SELECT run.frame_id, epoch_us(max(f.captured_at) OVER (PARTITION BY f.epoch_id)) // 1000000 - epoch_us(f.captured_at) // 1000000
       >= {config.BATCH_TIME_BUDGET_SECONDS} AS timed_out
FROM run JOIN frames f ON f.frame_id = run.frame_id""")
def detect_budget(spark, sf):
    """Frames the time budget left out: a frame waits from its capture to the last one of its
    micro-batch, and what it has waited is no longer there for the detector.  The waits are worked out
    on the narrow rows; the payloads are attached afterwards and not shuffled."""
    frames = _recorded(spark, sf).join(
        fx.frames(spark, sf).select("frame_id", F.unix_timestamp("captured_at").alias("_t")).hint("merge"), "frame_id")
    waited = F.max("_t").over(Window.partitionBy("epoch_id")) - F.col("_t")
    timed = frames.withColumn("left_s", F.lit(config.BATCH_TIME_BUDGET_SECONDS) - waited).drop("_t")
    out = D.detect(frames_with_payload(spark, sf, timed), D.RecordedDetector(), left_col="left_s", keep=["frame_id"])
    return out.select("frame_id", (F.col("status") == "BATCH_TIMEOUT").alias("timed_out"))


@register("detect_faults", "J4", _RUN + """
, flat AS (SELECT DISTINCT frame_id FROM dets WHERE x2 <= x1 OR y2 <= y1)
SELECT CASE WHEN run.status <> 'ROW_ERROR' AND flat.frame_id IS NOT NULL THEN 'UDF_CRITICAL_ERROR' ELSE run.status END AS status,
       count(*) AS n
FROM run LEFT JOIN flat ON flat.frame_id = run.frame_id GROUP BY 1""")
def detect_faults(spark, sf):
    """Frames per status when whole Arrow batches go to the detector and a box without an area fails the
    call: the frames that hold one stand alone, the others of their batches are detected."""
    return D.detect(frames_with_payload(spark, sf), D.RecordedBatchDetector(), keep=[]).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register("predict_conditional", "B6/B7", W("verdicts", "reasons", "payloads") + f"""
SELECT v.frame_id, 'DETECTED' AS status, v.violation,
       md5(CASE WHEN v.violation THEN '{config.VIOLATION_PREFIX}' ELSE '' END || p.frame_b64) AS result_md5
FROM verdicts v JOIN payloads p ON p.frame_id = v.frame_id JOIN reasons r ON r.frame_id = v.frame_id
WHERE p.frame_b64 <> '' AND {gate_sql('p.frame_b64')} AND r.reason = '{config.REASON_VALID}' AND v.n_objects > 0""")
def predict_conditional(spark, sf):
    """Gates first, then the detector once per remaining row; the result
    string keeps the reference's encoding.  Empty results are dropped (B7)."""
    gated = frames_with_payload(spark, sf).where(P.input_gate("frame_b64"))
    out = P.once(D.predict(gated, D.RecordedDetector()), "result", F.col("result"))
    return out.where(F.col("result") != "").select(
        "frame_id", "status", "violation", F.md5("result").alias("result_md5"))
