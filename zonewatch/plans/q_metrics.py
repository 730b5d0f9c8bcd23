"""Queries over batches, cameras and progress records
(B14, B15, D9, E6-E10, E12, C12, G1, G2, G4-G6, H1, I7)."""

from __future__ import annotations


from pyspark.sql import functions as F

from zonewatch import config
from zonewatch.operators import frames_ops as FO
from zonewatch.operators import metrics as M
from zonewatch.operators import results as R
from zonewatch.operators import sinks as S
from zonewatch.plans.oracle_views import with_views as W
from zonewatch.plans.registry import register
from zonewatch.session import run_dir
from zonewatch.sources import fixtures as fx

SAVED = "('VIOLATION', 'NORMAL')"
ERRS = "(" + ", ".join(f"'{x}'" for x in config.ERROR_STATUSES) + ")"
NONBLANK = "status <> 'EMPTY'"


def _status(spark, sf):
    return R.frame_results(spark, sf, with_payload=False)


@register("batch_summary", "E6", W("statuses") + f"""
SELECT epoch_id, count(*) AS rows,
       count(*) FILTER (WHERE trim(result) <> '') AS processed,
       count(*) FILTER (WHERE status IN {SAVED}) AS saved,
       count(*) FILTER (WHERE starts_with(result, '{config.VIOLATION_PREFIX}')) AS violations
FROM statuses GROUP BY epoch_id""")
def batch_summary(spark, sf):
    return M.batch_summary(_status(spark, sf))


@register("batch_success", "E7", W("statuses") + f"""
SELECT epoch_id, count(*) AS n, count(*) FILTER (WHERE status IN {SAVED}) AS successes,
       CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE status IN {SAVED}) / count(*) ELSE 0.0 END AS success_rate
FROM statuses GROUP BY epoch_id""")
def batch_success(spark, sf):
    return M.batch_success(_status(spark, sf))


@register("low_success_batches", "E8", W("statuses") + f"""
SELECT * FROM (
  SELECT epoch_id, count(*) AS n, count(*) FILTER (WHERE status IN {SAVED}) AS successes,
         count(*) FILTER (WHERE status IN {SAVED}) / count(*) AS success_rate
  FROM statuses GROUP BY epoch_id) t WHERE success_rate < {config.LOW_SUCCESS_RATE}""")
def low_success_batches(spark, sf):
    return M.low_success(M.batch_success(_status(spark, sf)))


@register("error_limit_batches", "E9", W("statuses") + f"""
SELECT * FROM (
  SELECT epoch_id, count(*) AS n, count(*) FILTER (WHERE status IN {ERRS}) AS n_errors
  FROM statuses GROUP BY epoch_id) t WHERE n_errors > n * {config.ERROR_RATIO_LIMIT}""")
def error_limit_batches(spark, sf):
    return M.error_limit(_status(spark, sf))


@register("status_histogram", "E12", W("statuses") +
          "SELECT status, count(*) AS n FROM statuses GROUP BY status")
def status_histogram(spark, sf):
    return M.status_histogram(_status(spark, sf))


@register("publish_totals", "E10", W("payloads") + """
SELECT camera_id, count(*) AS attempted, count(frame_b64) AS sent FROM payloads GROUP BY camera_id""")
def publish_totals(spark, sf):
    return M.publish_totals(fx.frame_payloads(spark, sf))


@register("batch_row_index", "G1", W("frames") + """
SELECT frame_id, epoch_id, CAST(row_number() OVER (PARTITION BY epoch_id ORDER BY frame_id) - 1 AS INTEGER) AS row_idx
FROM frames""")
def batch_row_index(spark, sf):
    return R.batch_row_index(fx.frames(spark, sf).select("frame_id", "epoch_id"))


_NUMBERED = W("frames") + """, numbered AS (
  SELECT frame_id, camera_id, row_number() OVER (PARTITION BY camera_id ORDER BY captured_at, frame_id) - 1 AS frame_no
  FROM frames)
"""


def _numbered(spark, sf):
    return FO.frame_numbers(fx.frames(spark, sf).select("frame_id", "camera_id", "captured_at")) \
        .select("frame_id", "camera_id", "frame_no")


@register("frame_numbers", "G2", _NUMBERED + "SELECT * FROM numbered")
def frame_numbers(spark, sf):
    return _numbered(spark, sf)


@register("frame_seek", "B14", _NUMBERED + "SELECT * FROM numbered WHERE frame_no = 100")
def frame_seek(spark, sf):
    return FO.frame_seek(_numbered(spark, sf), 100)


@register("frame_seek_outcome", "B14", W("frames") + """
SELECT camera_id, count(*) AS total, max(frame_id) FILTER (WHERE frame_no = 1250) AS frame_id,
       CASE WHEN count(*) > 1250 THEN 'FOUND' ELSE 'PAST_END' END AS outcome
FROM (SELECT camera_id, frame_id, row_number() OVER (PARTITION BY camera_id ORDER BY captured_at, frame_id) - 1 AS frame_no
      FROM frames) t GROUP BY camera_id""")
def frame_seek_outcome(spark, sf):
    """Frame 1250 of every camera: at sf 0.01 some have fewer frames."""
    return FO.seek_outcome(FO.frame_numbers(fx.frames(spark, sf).select("frame_id", "camera_id", "captured_at")), 1250)


@register("sample_stride", "B15/G5", _NUMBERED + "SELECT * FROM numbered WHERE frame_no % 3 = 0")
def sample_stride(spark, sf):
    """Keep every 3rd frame (30 fps -> 10 fps)."""
    return FO.sample_stride(_numbered(spark, sf), 3)


@register("milestones", "G4", _NUMBERED +
          "SELECT frame_id, camera_id, frame_no, frame_no + 1 AS sent_count FROM numbered WHERE (frame_no + 1) % 10 = 0")
def milestones(spark, sf):
    return FO.milestones(_numbered(spark, sf), 10)


@register("camera_fps", "D9", W("frames") + """
SELECT camera_id, n_frames, span_s, CASE WHEN span_s > 0 THEN n_frames / span_s END AS fps,
       CASE WHEN span_s > 0 THEN n_frames / span_s END / 3 AS effective_fps
FROM (SELECT camera_id, count(*) AS n_frames,
             (max(epoch_us(captured_at)) - min(epoch_us(captured_at))) / 1e6 AS span_s
      FROM frames GROUP BY camera_id) t""")
def camera_fps(spark, sf):
    return FO.camera_fps(fx.frames(spark, sf), stride=3)


@register("classify_errors", "C12", W("progress") + f"""
SELECT batch_id, error,
       CASE WHEN {" OR ".join(f"contains(lower(error), '{m}')" for m in config.RESOURCE_ERROR_MARKERS)}
            THEN 'resource' ELSE 'other' END AS error_class,
       {" OR ".join(f"contains(lower(error), '{m}')" for m in config.DISABLE_UDF_MARKERS)} AS disables_udf
FROM progress WHERE error IS NOT NULL""")
def classify_errors(spark, sf):
    return M.classify_errors(fx.progress(spark, sf))


@register("error_runs", "G6", W("progress") + f"""
SELECT min(batch_id) AS run_start, max(batch_id) AS run_end, count(*) AS run_length FROM (
  SELECT batch_id, error, row_number() OVER (ORDER BY batch_id)
         - row_number() OVER (PARTITION BY error IS NULL ORDER BY batch_id) AS island
  FROM progress) t
WHERE error IS NOT NULL GROUP BY island HAVING count(*) >= {config.MAX_CONSECUTIVE_ERRORS}""")
def error_runs(spark, sf):
    return M.error_runs(fx.progress(spark, sf))


@register("route_partition", "H1", W("statuses") + """
SELECT route, count(*) AS n FROM (
  SELECT CASE WHEN status = 'VIOLATION' THEN 'output_violation' WHEN status = 'NORMAL' THEN 'output_processed'
              ELSE 'skipped' END AS route FROM statuses) t GROUP BY route
UNION ALL SELECT 'missing', 0 UNION ALL SELECT 'extra', 0""")
def route_partition(spark, sf):
    """The evidence is written first and the routes are read off it.  The results are written
    once, without payloads: the evidence is made from them and has to account for them."""
    path = run_dir(spark, "h1")
    results = R.frame_results(spark, sf, with_doc=True)
    results.write.parquet(f"{path}/results")
    results = spark.read.schema(results.schema).parquet(f"{path}/results")
    S.evidence(spark, sf, results).drop("payload").write.partitionBy("verdict").parquet(f"{path}/evidence")
    return M.route_partition(results, spark.read.parquet(f"{path}/evidence"))


@register("violations_per_window", "I7", W("verdicts", "frames") + """
SELECT date_trunc('hour', f.captured_at) AS window_start,
       date_trunc('hour', f.captured_at) + INTERVAL 1 HOUR AS window_end,
       f.camera_id, count(*) AS frames, count(*) FILTER (WHERE v.violation) AS violations
FROM verdicts v JOIN frames f ON f.frame_id = v.frame_id
GROUP BY 1, 2, 3""")
def violations_per_window(spark, sf):
    from zonewatch.plans.q_frames import frame_verdicts
    return M.violations_per_window(frame_verdicts(spark, sf), fx.frames(spark, sf))
