"""Per-detection, per-vehicle and per-frame verdicts.

Two equivalent forms:

* flat  - one row per detection; per-detection flags are map-side
          projections, the per-frame result is a partial+final aggregation
          (``bool_or``/``count``) keyed by frame, joined to the frame table;
* nested - one row per frame with a ``detections`` array; the verdict is a
          per-row expression (no shuffle at all).

A hot frame does not hurt the flat form: partial aggregation collapses it
map-side before the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewatch import config
from zonewatch.functions import geometry
from zonewatch.sources.fixtures import size_ok


def is_vehicle(label: Column) -> Column:
    """Label in {car, motorbike}."""
    return label.isin(*config.VEHICLE_LABELS)


def is_red_light(label: Column) -> Column:
    return label == config.RED_LIGHT_LABEL


def with_flags(dets: DataFrame, min_conf: float = config.CONF_THRESHOLD, zone=None) -> DataFrame:
    """Per-detection flags: usable (conf + size gate), red light, vehicle in zone."""
    usable = (F.col("conf") >= min_conf) & size_ok(F.col("w"), F.col("h"))
    vehicles = ", ".join(f"'{v}'" for v in config.VEHICLE_LABELS)
    staged = geometry.with_zone_hits(dets, "_hits", zone=zone, where=f"label IN ({vehicles})")
    in_zone = is_vehicle(F.col("label")) & (F.col("_hits") * 2 > config.NUM_SAMPLE_STEPS)
    return staged.select(*dets.columns, usable.alias("usable"),
                         is_red_light(F.col("label")).alias("is_red"),
                         in_zone.alias("in_zone"))


def frame_flags(dets: DataFrame, min_conf: float = config.CONF_THRESHOLD, zone=None) -> DataFrame:
    """E1/E2 aggregated per frame over usable detections only."""
    flagged = with_flags(dets, min_conf, zone).where("usable")
    return flagged.groupBy("frame_id").agg(
        F.count(F.lit(1)).alias("n_objects"),
        F.bool_or("is_red").alias("red_light"),
        F.bool_or("in_zone").alias("vehicle_in_zone"))


def frame_verdicts(frames: DataFrame, dets: DataFrame, min_conf: float = config.CONF_THRESHOLD,
                   zone=None, keep: list[str] | None = None) -> DataFrame:
    """E3 (flagship): violation = red light present and a vehicle in the zone.

    Frames without a usable detection get n_objects 0 and false flags.
    ``keep`` passes extra frame columns through.
    """
    flags = frame_flags(dets, min_conf, zone)
    fr = frames.select("frame_id", "camera_id", "epoch_id", "w", "h", *(keep or []))
    j = fr.join(flags.hint("merge"), "frame_id", "left")
    red = F.coalesce(F.col("red_light"), F.lit(False))
    zone_hit = F.coalesce(F.col("vehicle_in_zone"), F.lit(False))
    return j.select("frame_id", "camera_id", "epoch_id", "w", "h", *(keep or []),
                    F.coalesce(F.col("n_objects"), F.lit(0)).cast("long").alias("n_objects"),
                    red.alias("red_light"), zone_hit.alias("vehicle_in_zone"),
                    (red & zone_hit).alias("violation"))


def with_nested_flags(df: DataFrame, min_conf: float = config.CONF_THRESHOLD,
                      zone=None) -> DataFrame:
    """Add n_objects, red_light, vehicle_in_zone, violation to rows holding a
    ``detections`` array and the frame size (w, h); other columns are kept.

    Per frame row the scaled zone's edges, per vehicle (one ``transform``) the intervals of
    the zone on the line of its bottom edge, then a closed form for the samples in them.
    """
    zone = zone or config.ZONE_640
    steps = config.NUM_SAMPLE_STEPS
    vehicles = ", ".join(f"'{v}'" for v in config.VEHICLE_LABELS)
    usable = (f"CASE WHEN w BETWEEN {config.MIN_SIDE} AND {config.MAX_SIDE} "
              f"AND h BETWEEN {config.MIN_SIDE} AND {config.MAX_SIDE} "
              f"THEN filter(detections, d -> d.conf >= {float(min_conf)!r}D) "
              f"ELSE slice(detections, 1, 0) END")
    step = df.selectExpr("*", f"{geometry.edges_sql(geometry.zone_vertex_sql('w', 'h', zone))} AS _edges", f"{usable} AS _usable")
    line = "CAST(d.y2 AS BIGINT)"
    veh = (f"transform(filter(_usable, d -> d.label IN ({vehicles})), d -> named_struct('x1', d.x1, 'x2', d.x2, "
           f"'spans', {geometry.scanline_sql('_edges', line)}))")
    step = step.selectExpr("*", f"{veh} AS _veh")
    in_zone = f"exists(_veh, v -> {geometry.scanline_hits_sql('v.spans', 'v.x1', 'v.x2', steps)} * 2 > {steps})"
    out = step.selectExpr(
        *[f"`{c}`" for c in df.columns],
        "CAST(size(_usable) AS BIGINT) AS n_objects",
        f"exists(_usable, d -> d.label = '{config.RED_LIGHT_LABEL}') AS red_light",
        f"{in_zone} AS vehicle_in_zone")
    return out.withColumn("violation", F.col("red_light") & F.col("vehicle_in_zone"))


def nested_verdicts(frames_nested: DataFrame, min_conf: float = config.CONF_THRESHOLD,
                    zone=None) -> DataFrame:
    """E3 on the nested form: ``filter``/``exists`` over the detection array,
    one frame per row, no shuffle."""
    out = with_nested_flags(frames_nested, min_conf, zone)
    return out.select("frame_id", "camera_id", "epoch_id", "w", "h", "n_objects",
                      "red_light", "vehicle_in_zone", "violation")


def with_frame_red(flagged: DataFrame) -> DataFrame:
    """``frame_red`` = the frame of the row has a red light."""
    return flagged.withColumn("frame_red", F.bool_or("is_red").over(Window.partitionBy("frame_id")))


def vehicle_verdicts(dets: DataFrame, min_conf: float = config.CONF_THRESHOLD, zone=None) -> DataFrame:
    """E5: each usable vehicle is a violator when it is in the zone and its
    frame has a red light.  The frame flag is a window over the frame, by
    which the rows are partitioned already: one scan, no join."""
    flagged = with_flags(dets, min_conf, zone).where("usable")
    vehicles = with_frame_red(flagged).where(is_vehicle(F.col("label")))
    return vehicles.select("frame_id", "det_id", "label", "conf", "x1", "y1", "x2", "y2",
                    F.col("in_zone"), (F.col("in_zone") & F.col("frame_red")).alias("violator"))
