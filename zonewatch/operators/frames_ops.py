"""Per-camera frame order: numbering, seek, stride sampling, milestones, rate
(B14, B15, C8, D9, G2, G4, G5).

A camera is a low-cardinality key that may hold a large share of all frames,
so the per-camera position comes from the range-sliced sequence helper and
never from a window partitioned by camera.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewatch.operators.ranking import sequence_number


def frame_numbers(frames: DataFrame, group: str = "camera_id") -> DataFrame:
    """``frame_no`` = 0-based position of a frame in its camera's capture
    order (ties on time broken by frame_id)."""
    out = sequence_number(frames, [group], ["captured_at", "frame_id"], out="_seq")
    return out.withColumn("frame_no", F.col("_seq") - 1).drop("_seq")


def frame_seek(numbered: DataFrame, n: int) -> DataFrame:
    """Frame ``n`` of each camera; cameras with fewer frames give no row."""
    return numbered.where(F.col("frame_no") == n)


def seek_outcome(numbered: DataFrame, n: int) -> DataFrame:
    """What seeking frame ``n`` gives for each camera: its frame, or
    ``PAST_END`` where the camera has no more than ``n`` frames."""
    found = numbered.groupBy("camera_id").agg(
        F.count(F.lit(1)).alias("total"), F.max(F.when(F.col("frame_no") == n, F.col("frame_id"))).alias("frame_id"))
    return found.select("camera_id", "total", "frame_id",
                        F.when(F.col("total") > n, F.lit("FOUND")).otherwise(F.lit("PAST_END")).alias("outcome"))


def sample_stride(numbered: DataFrame, k: int) -> DataFrame:
    """Keep every k-th frame of each camera, starting with the first."""
    return numbered.where(F.col("frame_no") % k == 0)


def milestones(numbered: DataFrame, every: int = 10) -> DataFrame:
    """Frames at which the running per-camera count reaches a multiple
    of ``every`` (the producer's progress log)."""
    return numbered.where((F.col("frame_no") + 1) % every == 0) \
                   .withColumn("sent_count", F.col("frame_no") + 1)


def frame_label_name(frame_no: Column, violation: Column, red: Column) -> Column:
    """``frame_{n}_{VIOLATION|NORMAL}_{RED|GREEN}.jpg``."""
    return F.format_string("frame_%d_%s_%s.jpg", frame_no,
                           F.when(violation, "VIOLATION").otherwise("NORMAL"),
                           F.when(red, "RED").otherwise("GREEN"))


def camera_fps(frames: DataFrame, stride: int = 1) -> DataFrame:
    """Frames per second of each camera from capture times, and the
    effective rate after keeping every ``stride``-th frame."""
    agg = frames.groupBy("camera_id").agg(
        F.count(F.lit(1)).alias("n_frames"),
        ((F.max(F.unix_micros("captured_at")) - F.min(F.unix_micros("captured_at"))) / 1e6).alias("span_s"))
    fps = F.when(F.col("span_s") > 0, F.col("n_frames") / F.col("span_s"))
    return agg.select("camera_id", "n_frames", "span_s", fps.alias("fps"),
                      (fps / stride).alias("effective_fps"))
