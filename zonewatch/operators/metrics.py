"""Batch health and counting operators.

Every aggregate here is a plain ``groupBy().agg()`` of combinable functions,
so Spark pre-aggregates map-side and a hot key (one camera, one status)
costs one row per task in the shuffle, not one row per frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch import config
from zonewatch.operators.ranking import sequence_number

SAVED = ["VIOLATION", "NORMAL"]


def _count_if(cond):
    return F.count_if(cond).cast("long")


def batch_summary(results: DataFrame) -> DataFrame:
    """Per micro-batch: rows, non-blank results (``processed`` - counts
    sentinels too, as the reference does), frames actually saved, violations."""
    st = F.col("status")
    return results.groupBy("epoch_id").agg(
        F.count(F.lit(1)).alias("rows"),
        _count_if(st != "EMPTY").alias("processed"),
        _count_if(st.isin(*SAVED)).alias("saved"),
        _count_if(st == "VIOLATION").alias("violations"))


def batch_success(results: DataFrame) -> DataFrame:
    """Share of rows the detector turned into a result; 0 when empty."""
    agg = results.groupBy("epoch_id").agg(
        F.count(F.lit(1)).alias("n"), _count_if(F.col("status").isin(*SAVED)).alias("successes"))
    rate = F.when(F.col("n") > 0, F.col("successes") / F.col("n")).otherwise(F.lit(0.0))
    return agg.withColumn("success_rate", rate)


def low_success(success: DataFrame, threshold: float = config.LOW_SUCCESS_RATE) -> DataFrame:
    """Batches recorded as failures by the breaker (rate < 0.1)."""
    return success.where(F.col("success_rate") < threshold)


def error_limit(results: DataFrame, ratio: float = config.ERROR_RATIO_LIMIT) -> DataFrame:
    """Batches whose error statuses exceed ``ratio`` of their rows."""
    agg = results.groupBy("epoch_id").agg(
        F.count(F.lit(1)).alias("n"), _count_if(F.col("status").isin(*config.ERROR_STATUSES)).alias("n_errors"))
    return agg.where(F.col("n_errors") > F.col("n") * ratio)


def status_histogram(results: DataFrame) -> DataFrame:
    """Rows per status."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def publish_totals(payloads: DataFrame) -> DataFrame:
    """Frames read vs frames encoded and sent, per camera."""
    return payloads.groupBy("camera_id").agg(
        F.count(F.lit(1)).alias("attempted"), _count_if(F.col("frame_b64").isNotNull()).alias("sent"))


def classify_errors(progress: DataFrame) -> DataFrame:
    """Error class of a failed batch's text; Arrow/socket errors also
    switch the detector off (degrade to passthrough)."""
    low = F.lower(F.col("error"))
    resource = None
    for m in config.RESOURCE_ERROR_MARKERS:
        c = low.contains(m)
        resource = c if resource is None else resource | c
    disable = None
    for m in config.DISABLE_UDF_MARKERS:
        c = low.contains(m)
        disable = c if disable is None else disable | c
    return progress.where(F.col("error").isNotNull()).select(
        "batch_id", "error", F.when(resource, "resource").otherwise("other").alias("error_class"),
        disable.alias("disables_udf"))


def error_runs(progress: DataFrame, min_run: int = config.MAX_CONSECUTIVE_ERRORS) -> DataFrame:
    """Runs of consecutive failed batches (reset by any success) of at
    least ``min_run``.  Gaps-and-islands: among failed batches,
    (position among all batches) - (position among failed batches) is
    constant within a run.  Both positions come from the sliced sequence
    helper, so one global order never lands in one task."""
    all_seq = sequence_number(progress.select("batch_id", "error"), [], ["batch_id"], out="pos_all")
    failed = all_seq.where(F.col("error").isNotNull())
    fail_seq = sequence_number(failed, [], ["batch_id"], out="pos_fail")
    runs = fail_seq.groupBy((F.col("pos_all") - F.col("pos_fail")).alias("island")).agg(
        F.min("batch_id").alias("run_start"), F.max("batch_id").alias("run_end"),
        F.count(F.lit(1)).alias("run_length"))
    return runs.where(F.col("run_length") >= min_run).drop("island")


def route_partition(results: DataFrame, written: DataFrame) -> DataFrame:
    """H1: rows per route, plus the invariant that the routes partition the
    input.  ``written`` (frame_id, out_dir) is the evidence as it was saved;
    with the rows the saver skips it must account for every result row once:
    ``missing`` rows are in no route, ``extra`` ones in more than the input
    has.  One pass over both."""
    skipped = results.where(F.col("status").isNull() | ~F.col("status").isin(*SAVED)).select(
        "frame_id", F.lit("skipped").alias("route"))
    routed = written.select("frame_id", F.col("out_dir").alias("route")).unionByName(skipped)
    told = results.select("frame_id", F.lit(None).cast("string").alias("route")).unionByName(routed)
    frames = told.groupBy("frame_id").agg(
        _count_if(F.col("route").isNull()).alias("given"), F.count("route").alias("found"),
        *[_count_if(F.col("route") == r).alias(r) for r in ("output_violation", "output_processed", "skipped")])
    sums = frames.agg(*[F.sum(r).alias(r) for r in ("output_violation", "output_processed", "skipped")],
                      F.sum(F.greatest(F.col("given") - F.col("found"), F.lit(0))).alias("missing"),
                      F.sum(F.greatest(F.col("found") - F.col("given"), F.lit(0))).alias("extra"))
    return sums.selectExpr("stack(5, 'output_violation', output_violation, 'output_processed', output_processed, "
                           "'skipped', skipped, 'missing', missing, 'extra', extra) AS (route, n)").where(
        "n > 0 OR route IN ('missing', 'extra')")


def violations_per_window(verdicts: DataFrame, frames: DataFrame, width: str = "1 hour") -> DataFrame:
    """I7 (batch twin): frames and violations per camera per tumbling
    event-time window."""
    j = verdicts.select("frame_id", "violation").join(frames.select("frame_id", "captured_at", "camera_id"),
                                                       "frame_id")
    agg = j.groupBy(F.window("captured_at", width).alias("w"), "camera_id").agg(
        F.count(F.lit(1)).alias("frames"), _count_if(F.col("violation")).alias("violations"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "camera_id", "frames", "violations")
