"""Dimension lookups: zone polygons per camera (F2) and class labels.

Both dimensions are usually small (a polygon per camera, a label per model
class), but nothing bounds them: the planner broadcasts them below its own
byte threshold and shuffles them above it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch import config
from zonewatch.functions import geometry

ALL_CAMERAS = -1  # lookup key of zones whose camera_id is NULL
SLAB = 64  # pixels across of a cell of the zone index


def lookup_classes(dets: DataFrame, classes: DataFrame) -> DataFrame:
    """class id -> label (plus vehicle / signal flags)."""
    return dets.join(classes, "class_id", "inner")


def polygons(zones: DataFrame) -> DataFrame:
    """One row per zone: ``poly`` = vertices in vertex order."""
    return (zones.groupBy("zone_id", "camera_id")
                 .agg(F.array_sort(F.collect_list(F.struct("vertex_no", "x", "y"))).alias("poly")))


def zone_hits_from_table(dets: DataFrame, zones: DataFrame, ref: int = config.REF_SIZE) -> DataFrame:
    """join detections (with camera_id, w, h) to the zone table and count
    bottom-edge hits per (detection, zone).  A zone with NULL camera applies
    to every camera.  The join is an equi-join on a lookup key (the camera, or "all
    cameras"); the test runs on the zone's vertex array (any vertex count).  One row per
    pair, those without a hit included; ``zone_hits_indexed`` is for many zones."""
    polys = polygons(zones).select(F.coalesce(F.col("camera_id"), F.lit(ALL_CAMERAS)).alias("_zkey"), "zone_id", "poly")
    j = _probes(dets).join(polys, "_zkey", "inner").drop("_zkey")
    j = j.withColumn("_p", F.expr(_scaled_sql(ref))).withColumn("_edges", F.expr(geometry.edges_of_array_sql("_p")))
    j = j.withColumn("_spans", F.expr(geometry.scanline_sql("_edges", "CAST(y2 AS BIGINT)")))
    return j.withColumn("hits", F.expr(geometry.scanline_hits_sql("_spans", "x1", "x2"))).drop("_p", "_edges", "_spans", "poly")


def _probes(dets: DataFrame) -> DataFrame:
    """Every detection under its own camera and under "all cameras"."""
    return dets.withColumn("_zkey", F.explode(F.array(F.col("camera_id"), F.lit(ALL_CAMERAS))))


def _scaled_sql(ref: int) -> str:
    return (f"transform(poly, v -> named_struct("
            f"'x', CAST(v.x * (CAST(w AS DOUBLE) / {float(ref)!r}D) AS BIGINT), "
            f"'y', CAST(v.y * (CAST(h AS DOUBLE) / {float(ref)!r}D) AS BIGINT)))")


def zone_index(zones: DataFrame, sizes: DataFrame, slab: int = SLAB, ref: int = config.REF_SIZE) -> DataFrame:
    """Scanline table of all zones for the frame sizes met (``sizes``: camera_id, w, h): a row per
    (zone key, size, line y) and slab of ``slab`` pixels across that a zone's interval reaches, with the
    interval cut to nothing else: _zkey, w, h, _y, _slab, zone_id, spans, first (the zone's first slab on that line)."""
    keyed = polygons(zones).select(F.coalesce(F.col("camera_id"), F.lit(ALL_CAMERAS)).alias("_zkey"), "zone_id", "poly")
    met = sizes.select(F.explode(F.array("camera_id", F.lit(ALL_CAMERAS))).alias("_zkey"), "w", "h").distinct()
    scaled = keyed.join(met, "_zkey").withColumn("_p", F.expr(_scaled_sql(ref)))
    lines = scaled.select("_zkey", "w", "h", "zone_id", F.expr(geometry.edges_of_array_sql("_p")).alias("_edges"),
                          F.explode(F.expr("sequence(array_min(transform(_p, v -> v.y)), array_max(transform(_p, v -> v.y)))")).alias("_y"))
    spans = lines.select("_zkey", "w", "h", "zone_id", "_y", F.expr(geometry.scanline_sql("_edges", "_y")).alias("spans"))
    slabs = F.expr(f"array_distinct(flatten(transform(spans, s -> sequence(floor(s.lo / {slab}), floor(s.hi / {slab})))))")
    return spans.where(F.size("spans") > 0).withColumn("_slabs", F.array_sort(slabs)).select(
        "_zkey", "w", "h", "_y", F.explode("_slabs").alias("_slab"), "zone_id", "spans", "_slabs")


def zone_hits_indexed(dets: DataFrame, zones: DataFrame, slab: int = SLAB, ref: int = config.REF_SIZE) -> DataFrame:
    """F2 for many zones a camera: the (detection, zone) pairs with at least one sample inside the
    zone, with ``hits``.  A box meets the zones whose intervals on its own line share a slab with it,
    not every zone of its camera; a pair that shares several is counted in the first of them."""
    sizes = dets.select("camera_id", "w", "h").distinct()
    index = zone_index(zones, sizes, slab, ref)
    left, right = F.least("x1", "x2"), F.greatest("x1", "x2")
    reach = F.sequence(F.floor(left / slab).cast("long"), F.floor(right / slab).cast("long"))
    probes = _probes(dets).withColumn("_y", F.col("y2").cast("long")).withColumn("_slab", F.explode(reach))
    j = probes.join(index, ["_zkey", "w", "h", "_y", "_slab"])
    first = F.array_min(F.filter("_slabs", lambda s: s >= F.floor(left / slab)))
    j = j.where(first == F.col("_slab"))
    hits = F.expr(geometry.scanline_hits_sql("spans", "x1", "x2"))
    return j.withColumn("hits", hits).where("hits > 0").select(*dets.columns, "zone_id", "hits")
