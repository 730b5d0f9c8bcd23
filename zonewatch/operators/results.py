"""Per-frame detector results (the M4 result string and its typed status).

The fixture stands in for the detector's output: ``''`` when the payload is
invalid, the frame is outside the size gate or nothing usable was detected;
otherwise the payload, tagged when the frame violates.  Whole micro-batches
(or their tails) carry the health sentinels of the batch function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonewatch import config
from zonewatch.functions import payload
from zonewatch.operators import verdict
from zonewatch.sources import fixtures as fx

# fixed values: sentinel of a whole micro-batch by ``epoch_id % 40``, and of
# the tail of a batch from a row index on
EPOCH_SENTINELS = {7: "CIRCUIT_BREAKER_OPEN", 13: "MODEL_UNAVAILABLE",
                   21: "INSUFFICIENT_MEMORY", 29: "UDF_CRITICAL_ERROR"}
TAIL_SENTINELS = {33: ("BATCH_TIMEOUT", 3), 37: ("MEMORY_CRITICAL", 2)}


def batch_row_index(frames: DataFrame) -> DataFrame:
    """G1: 0-based position of a frame in its micro-batch, by frame_id.

    A micro-batch is bounded by the source's rate cap, so the per-epoch
    window is small."""
    w = Window.partitionBy("epoch_id").orderBy("frame_id")
    return frames.withColumn("row_idx", (F.row_number().over(w) - 1).cast("int"))


def sentinel(epoch_id, row_idx):
    m = epoch_id % 40
    expr = None
    for k, (code, start) in TAIL_SENTINELS.items():
        cond = (m == k) & (row_idx >= start)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    for k, code in EPOCH_SENTINELS.items():
        expr = expr.when(m == k, F.lit(code))
    return expr


def frame_results(spark: SparkSession, sf_dir: str, with_payload: bool = False, with_doc: bool = False) -> DataFrame:
    """frame_id, epoch_id, camera_id, captured_at, row_idx, status, violation
    [, result | doc_id].

    The light frame rows meet the documents' validation reasons (each document
    is validated once, its text stays where it is) and are then partitioned by
    epoch for the row index, a partitioning that per-epoch aggregates reuse.
    Document text is joined last, and only when payloads are asked for.
    """
    frames = fx.frames(spark, sf_dir)
    dets = fx.raw_detections(spark, sf_dir, min_conf=config.CONF_THRESHOLD)
    fv = verdict.frame_verdicts(frames, dets, keep=["captured_at"])
    fv = fv.withColumn("doc_id", fx.doc_index(spark, sf_dir, F.col("frame_id")))
    j = batch_row_index(fv.join(fx.document_reasons(spark, sf_dir).hint("merge"), "doc_id", "left"))
    ov = fx.payload_override(F.col("frame_id"))
    reason = (F.when((ov == 47) | (ov == 48), F.lit(config.REASON_EMPTY))
                .when(ov == 49, F.col("reason_raw"))
                .otherwise(F.col("reason_b64")))
    gate = fx.size_ok(F.col("w"), F.col("h"))
    empty = (~gate) | (reason != config.REASON_VALID) | (F.col("n_objects") == 0)
    sent = sentinel(F.col("epoch_id"), F.col("row_idx"))
    status = (F.when(sent.isNotNull(), sent)
                .when(empty, F.lit("EMPTY"))
                .when(F.col("violation"), F.lit("VIOLATION"))
                .otherwise(F.lit("NORMAL")))
    cols = ["frame_id", "epoch_id", "camera_id", "captured_at", "row_idx"]
    j = j.select(*cols, status.alias("status"), "violation", "doc_id")
    return with_result(spark, sf_dir, j) if with_payload else j if with_doc else j.drop("doc_id")


def with_result(spark: SparkSession, sf_dir: str, results: DataFrame) -> DataFrame:
    """``frame_results`` with their document's id, plus the result string in its place."""
    j = fx.with_payload(spark, sf_dir, results)
    cols = [c for c in results.columns if c not in ("status", "violation", "doc_id")]
    result = (F.when(F.col("status").isin(*config.SENTINELS), F.col("status"))
                .when(F.col("status") == "EMPTY", F.lit(""))
                .otherwise(payload.encode_result(F.col("violation"), F.col("frame_b64"))))
    return j.select(*cols, "status", "violation", result.alias("result"))
