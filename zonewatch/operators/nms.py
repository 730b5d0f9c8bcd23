"""Detector post-processing: overlapping pairs (D7/F5), greedy class-aware
non-max suppression (D8) and per-frame top-k (G3).

Boxes interact only inside one frame, and a frame's candidates are bounded by
the detector (its anchor grid before NMS, ``max_det`` after), so per-frame
work is small and frames are processed in parallel.

Pairs are found by a sweep inside the frame's row: boxes in the order of their left
edges, with an active list of those whose right edge is not passed yet.  A box
meets the active ones only; there is no self-join and nothing is exploded before
pairs are known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonewatch import config

_BOX = ("x1", "x2", "y1", "y2", "det_id", "label")


def _iou_sql(a: str, b: str) -> str:
    """Intersection over union of two boxes that overlap, areas as (x2 - x1) * (y2 - y1)."""
    inter = (f"((least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * (least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)))")
    areas = " + ".join(f"({d}.x2 - {d}.x1) * ({d}.y2 - {d}.y1)" for d in (a, b))
    return f"CAST({inter} AS DOUBLE) / ({areas} - {inter})"


def sweep_pairs_sql(boxes: str, same_class: bool = True) -> str:
    """Overlapping pairs of ``boxes``, an array of structs sorted by x1 (``_BOX``), as
    array<struct<det_a,det_b,label,iou>>.  The fold holds the active list and the pairs found."""
    meets = "least(_a.y2, _d.y2) > greatest(_a.y1, _d.y1) AND _a.x2 > greatest(_a.x1, _d.x1) AND _d.x2 > _d.x1"
    if same_class:
        meets += " AND _a.label = _d.label"
    pair = ("named_struct('det_a', least(_a.det_id, _d.det_id), 'det_b', greatest(_a.det_id, _d.det_id), "
            f"'label', CASE WHEN _a.det_id < _d.det_id THEN _a.label ELSE _d.label END, 'iou', {_iou_sql('_a', '_d')})")
    found = f"transform(filter(_live, _a -> {meets}), _a -> {pair})"
    none = (f"transform(slice({boxes}, 1, 0), _d -> named_struct('det_a', _d.det_id, 'det_b', _d.det_id, 'label', _d.label, "
            "'iou', CAST(0 AS DOUBLE)))")
    # the list of one names the boxes still active for both uses
    step = (f"transform(array(filter(_s.active, _a -> _a.x2 > _d.x1)), _live -> named_struct('active', concat(_live, array(_d)), "
            f"'found', concat(_s.found, {found})))[0]")
    return f"aggregate({boxes}, named_struct('active', slice({boxes}, 1, 0), 'found', {none}), (_s, _d) -> {step}, _s -> _s.found)"


def overlapping_pairs(dets: DataFrame, same_class: bool = True) -> DataFrame:
    """(frame_id, det_a, det_b, label, iou) for boxes of one frame (and
    class) whose intersection has positive area; det_a < det_b, and the label is det_a's."""
    frames = dets.groupBy("frame_id").agg(F.array_sort(F.collect_list(F.struct(*_BOX))).alias("_boxes"))
    pairs = frames.where(F.size("_boxes") > 1).select("frame_id", F.explode(F.expr(sweep_pairs_sql("_boxes", same_class))).alias("p"))
    return pairs.select("frame_id", "p.det_a", "p.det_b", "p.label", "p.iou")


def nms(nested: DataFrame, iou_threshold: float = config.IOU_THRESHOLD,
        col: str = "detections", out: str = "kept") -> DataFrame:
    """Greedy class-aware NMS per frame row, as a fold over the frame's
    detections in (conf desc, det_id) order: a box is kept unless it overlaps
    a kept box of its class with IoU > threshold.  Pure Catalyst (higher-
    order functions), one frame per row, no shuffle."""
    t = float(iou_threshold)
    # two boxes without an area have no union: their IoU is 0, as in ``geometry.iou``
    iou = ("coalesce(try_divide(CAST(greatest(least(k.x2, d.x2) - greatest(k.x1, d.x1), 0) * "
           "greatest(least(k.y2, d.y2) - greatest(k.y1, d.y1), 0) AS DOUBLE), "
           "((k.x2 - k.x1) * (k.y2 - k.y1) + (d.x2 - d.x1) * (d.y2 - d.y1) - "
           "greatest(least(k.x2, d.x2) - greatest(k.x1, d.x1), 0) * "
           "greatest(least(k.y2, d.y2) - greatest(k.y1, d.y1), 0))), 0D)")
    ordered = (f"array_sort({col}, (l, r) -> CASE WHEN l.conf > r.conf THEN -1 WHEN l.conf < r.conf THEN 1 "
               f"WHEN l.det_id < r.det_id THEN -1 WHEN l.det_id > r.det_id THEN 1 ELSE 0 END)")
    fold = (f"aggregate({ordered}, slice({col}, 1, 0), (kept, d) -> "
            f"CASE WHEN exists(kept, k -> k.label = d.label AND {iou} > {t!r}D) THEN kept "
            f"ELSE concat(kept, array(d)) END)")
    return nested.withColumn(out, F.expr(fold))


def top_k(dets: DataFrame, k: int = config.MAX_DET) -> DataFrame:
    """The k most confident detections of each frame (``rank`` 1..k)."""
    w = Window.partitionBy("frame_id").orderBy(F.col("conf").desc(), "det_key", "x1", "y1", "x2", "y2")
    return dets.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)
