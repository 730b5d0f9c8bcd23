"""Frame-analytics tables derived from the driver's tables.

The mapping (documented in FIXTURES.md) turns ``events`` into camera frames,
``lineitem`` into object detections, and ``documents`` into frame payloads.
Every derived table grows with its source: nothing here samples, caps or
subsets rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonewatch import config
from zonewatch.functions import geometry, payload
from zonewatch.operators.ranking import sequence_number
from zonewatch.sources.tables import table

# fixed values: source frame sizes by ``frame_id % 5`` (the last one fails
# the size gate)
SRC_SIZES = [(640, 640), (640, 360), (1280, 720), (1920, 1080), (24, 24)]
# fixed values: class index -> label of the detection fixture by
# ``l_partkey % 10``
LABEL_BY_DIGIT = ["car", "car", "car", "motorbike", "motorbike", "motorbike",
                  "person", "red_light", "red_light", "stop_line"]
N_CAMERAS = 8
N_LOG_PARTITIONS = 4
FRAMES_PER_EPOCH = 5
FRAME_TOPIC = "frames"


def _pick(key, values):
    expr = None
    for i, v in enumerate(values):
        expr = F.when(key == i, F.lit(v)) if expr is None else expr.when(key == i, F.lit(v))
    return expr


def frame_dims(frame_id):
    """(src_w, src_h, w, h) of a frame: source size by id, then D1."""
    k = (frame_id % len(SRC_SIZES)).cast("int") + 1
    src_w = F.element_at(F.array(*[F.lit(w) for w, _ in SRC_SIZES]), k)
    src_h = F.element_at(F.array(*[F.lit(h) for _, h in SRC_SIZES]), k)
    w, h = geometry.downscale_dims(src_w, src_h)
    return src_w, src_h, w, h


def size_ok(w, h):
    """32 <= h, w <= 2048."""
    return w.between(config.MIN_SIDE, config.MAX_SIDE) & h.between(config.MIN_SIDE, config.MAX_SIDE)


# ------------------------------------------------------------------ frames
def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per frame: id, camera, capture time, micro-batch, sizes."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    fid = F.col("event_id")
    src_w, src_h, w, h = frame_dims(fid)
    return ev.select(
        fid.alias("frame_id"),
        (F.col("user_id") % N_CAMERAS).cast("int").alias("camera_id"),
        F.col("ts").cast("timestamp").alias("captured_at"),
        geometry.idiv(fid, FRAMES_PER_EPOCH).alias("epoch_id"),
        src_w.alias("src_w"), src_h.alias("src_h"), w.alias("w"), h.alias("h"))


# -------------------------------------------------------------- detections
def raw_detections(spark: SparkSession, sf_dir: str, min_conf: float | None = None) -> DataFrame:
    """Detections straight from ``lineitem`` (no frame-existence check).

    Box coordinates live in the frame's pixel space (w, h), which the fixture
    derives from the frame id.  ``min_conf`` adds the confidence threshold
    and its equivalent on the source column so Parquet can skip row groups.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    if min_conf is not None:
        li = li.where(F.col("l_quantity") >= F.lit(min_conf * 50.0))
    # frame size first (own projection: referenced by every coordinate)
    _, _, w, h = frame_dims(F.col("l_orderkey"))
    li = li.select("*", w.alias("w"), h.alias("h"))
    fid = F.col("l_orderkey")
    w, h = F.col("w"), F.col("h")
    pk, sk, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber").cast("long")
    digit = pk % 10
    bx = (pk * 37 + ln * 71) % 560
    by = (sk * 53 + ln * 17) % 480
    e = F.floor(F.col("l_extendedprice")).cast("long")
    bw = e % 200 + 20
    bh = geometry.idiv(e, 7) % 160 + 20
    df = li.select(
        fid.alias("frame_id"),
        (ln * 100000000 + pk * 1000 + sk).alias("det_key"),
        _pick(digit, [config.CLASS_LABELS.index(lbl) for lbl in LABEL_BY_DIGIT]).cast("int").alias("class_id"),
        _pick(digit, LABEL_BY_DIGIT).alias("label"),
        (F.col("l_quantity") / 50.0).alias("conf"),
        geometry.idiv(bx * w, 640).alias("x1"),
        geometry.idiv(by * h, 640).alias("y1"),
        geometry.idiv(F.least(bx + bw, F.lit(639)) * w, 640).alias("x2"),
        geometry.idiv(F.least(by + bh, F.lit(639)) * h, 640).alias("y2"),
        w, h)
    if min_conf is not None:
        df = df.where(F.col("conf") >= min_conf)
    return df


def det_order():
    """Total order of a frame's detections: conf desc, then key and box."""
    return [F.col("conf").desc(), F.col("det_key"), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")]


def detections(spark: SparkSession, sf_dir: str, min_conf: float | None = None,
               with_det_id: bool = True) -> DataFrame:
    """Flat detections of existing frames, ``det_id`` 1.. per frame by
    (conf desc, det_key, box).  A frame's detections are bounded by the
    detector (max_det after NMS), so the per-frame window is small."""
    dets = raw_detections(spark, sf_dir, min_conf)
    fr = frames(spark, sf_dir).select("frame_id")
    dets = dets.join(fr.hint("merge"), "frame_id", "left_semi")
    if with_det_id:
        w = Window.partitionBy("frame_id").orderBy(*det_order())
        dets = dets.withColumn("det_id", F.row_number().over(w).cast("int"))
    return dets


DET_STRUCT_FIELDS = ["det_id", "det_key", "label", "conf", "x1", "y1", "x2", "y2"]


def nest(dets: DataFrame) -> DataFrame:
    """One row per frame with ``detections`` sorted by det_id."""
    return (dets.groupBy("frame_id")
                .agg(F.array_sort(F.collect_list(F.struct(*DET_STRUCT_FIELDS))).alias("detections")))


def frames_nested(spark: SparkSession, sf_dir: str, min_conf: float | None = None) -> DataFrame:
    """Frames with their detection array (empty array when none)."""
    fr = frames(spark, sf_dir)
    nested = nest(detections(spark, sf_dir, min_conf))
    out = fr.join(nested.hint("merge"), "frame_id", "left")
    empty = F.array().cast(nested.schema["detections"].dataType)
    return out.withColumn("detections", F.coalesce(F.col("detections"), empty))


def recorded_frames(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """Frames (``base``: the frame table, or rows of it with other columns) with the detections recorded
    for them (NULL when none), most confident first: what a recorded detector replays."""
    dets = raw_detections(spark, sf_dir)
    entry = F.struct((-F.col("conf")).alias("o1"), F.col("det_key").alias("o2"), "x1", "y1", "x2", "y2", "label", "conf")
    nested = dets.groupBy("frame_id").agg(F.transform(
        F.array_sort(F.collect_list(entry)),
        lambda d: F.struct(d["label"].alias("label"), d["conf"].alias("conf"), d["x1"].alias("x1"), d["y1"].alias("y1"),
                           d["x2"].alias("x2"), d["y2"].alias("y2"))).alias("recorded"))
    base = frames(spark, sf_dir) if base is None else base
    return base.join(nested.hint("merge"), "frame_id", "left")


# -------------------------------------------------------- dimension tables
def zones(spark: SparkSession) -> DataFrame:
    """The stop zone as rows (zone 0 applies to every camera)."""
    rows = [(0, None, i, float(x), float(y)) for i, (x, y) in enumerate(config.ZONE_640)]
    return spark.createDataFrame(rows, "zone_id int, camera_id int, vertex_no int, x double, y double")


def classes(spark: SparkSession) -> DataFrame:
    rows = [(i, lbl, lbl in config.VEHICLE_LABELS, lbl == config.RED_LIGHT_LABEL)
            for i, lbl in enumerate(config.CLASS_LABELS)]
    return spark.createDataFrame(rows, "class_id int, label string, is_vehicle boolean, is_signal boolean")


# ---------------------------------------------------------------- payloads
def doc_index(spark: SparkSession, sf_dir: str, frame_id):
    """Document of a frame: ``frame_id % count(documents)`` (scalar subquery)."""
    n_docs = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
    return frame_id % n_docs


def payload_override(frame_id):
    """Frames whose payload is replaced: 47 -> NULL, 48 -> '', 49 -> raw text."""
    return frame_id % 50


def frame_payloads(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """Frame rows plus doc_id and frame_b64 - the heavy form.  ``base``
    (default: the frame table's id, camera, epoch and time) is kept as is."""
    fr = base if base is not None else \
        frames(spark, sf_dir).select("frame_id", "camera_id", "epoch_id", "captured_at")
    return with_payload(spark, sf_dir, fr.withColumn("doc_id", doc_index(spark, sf_dir, F.col("frame_id"))))


def with_payload(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """``rows`` (frame_id, doc_id and more, a batch or a stream) plus frame_b64.  In a batch every
    frame is there, so a document is encoded once, before it meets its frames; a micro-batch
    meets few of the documents and encodes its own messages."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    if rows.isStreaming:
        j = rows.join(docs.hint("merge"), "doc_id", "left")
        return j.select(*rows.columns, payload_column(F.col("frame_id"), F.col("text")).alias("frame_b64"))
    j = rows.join(docs.withColumn("_b64", text_b64(F.col("text"))).hint("merge"), "doc_id", "left")
    return j.select(*rows.columns, payload_column(F.col("frame_id"), F.col("text"), F.col("_b64")).alias("frame_b64"))


def payload_bytes(spark: SparkSession, sf_dir: str, rows: DataFrame) -> int:
    """About the bytes of the payloads ``with_payload`` adds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("n"))
    held = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    total = held.join(docs.hint("merge"), "doc_id").agg(F.sum(F.col("rows") * F.col("n"))).first()[0]
    return (total or 0) * 4 // 3


def text_b64(text):
    return payload.b64_encode(F.encode(text, "UTF-8"))


def payload_column(frame_id, text, encoded=None):
    """The frame payload: base64 of the document (``encoded``, where it is known), or an override."""
    ov = payload_override(frame_id)
    return (F.when(ov == 47, F.lit(None).cast("string"))
             .when(ov == 48, F.lit(""))
             .when(ov == 49, text)
             .otherwise(text_b64(text) if encoded is None else encoded))


def document_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation reason of every document, as base64 payload and as raw text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select(
        "doc_id",
        payload.validate_payload(payload.b64_encode(F.encode(F.col("text"), "UTF-8"))).alias("reason_b64"),
        payload.validate_payload(F.col("text")).alias("reason_raw"))


def frame_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 per frame without moving payloads: validate each document once,
    then join the (doc_id, reason) pairs to frames."""
    fr = frames(spark, sf_dir).select("frame_id", "camera_id", "epoch_id", "w", "h")
    fr = fr.withColumn("doc_id", doc_index(spark, sf_dir, F.col("frame_id")))
    reasons = document_reasons(spark, sf_dir)
    j = fr.join(reasons.hint("merge"), "doc_id", "left")
    ov = payload_override(F.col("frame_id"))
    reason = (F.when((ov == 47) | (ov == 48), F.lit(config.REASON_EMPTY))
                .when(ov == 49, F.col("reason_raw"))
                .otherwise(F.col("reason_b64")))
    return j.select("frame_id", "camera_id", "epoch_id", "w", "h", "doc_id", reason.alias("reason"))


# --------------------------------------------------------------- frame log
def log_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of the frame topic by reference: all but the value, which
    ``messages`` gets from the document ``doc_id``.

    Partition = camera % 4, offsets numbered per partition in capture order.
    A topic partition is a low-cardinality group holding a large share of all
    rows, so the numbering uses the sliced sequence helper rather than a
    window over the partition.
    """
    fr = frames(spark, sf_dir).select(
        "frame_id", (F.col("camera_id") % N_LOG_PARTITIONS).cast("int").alias("partition"), "captured_at")
    numbered = sequence_number(fr, ["partition"], ["captured_at", "frame_id"], out="_seq")
    return numbered.select(
        F.lit(None).cast("binary").alias("key"),
        F.lit(FRAME_TOPIC).alias("topic"),
        F.col("partition"),
        (F.col("_seq") - 1).alias("offset"),
        F.col("captured_at").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.col("frame_id"),
        doc_index(spark, sf_dir, F.col("frame_id")).alias("doc_id"))


def messages(spark: SparkSession, sf_dir: str, refs: DataFrame) -> DataFrame:
    """Messages given by reference, a batch or a stream, with their value."""
    rest = [c for c in refs.columns if c not in ("key", "doc_id")]
    return with_payload(spark, sf_dir, refs).select("key", F.col("frame_b64").cast("binary").alias("value"), *rest)


def frame_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frame topic as Kafka-source rows (plus ``frame_id``).  Payloads are
    attached to the narrow rows last."""
    return messages(spark, sf_dir, log_refs(spark, sf_dir))


def stream_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frame log by reference, with the metadata and recorded detections of its frames.  The narrow
    rows are numbered before they meet the detections, which move once, by frame."""
    w = Window.partitionBy("epoch_id").orderBy("frame_id")
    meta = frames(spark, sf_dir).select(
        "frame_id", "camera_id", "epoch_id", (F.row_number().over(w) - 1).cast("int").alias("row_idx"), "w", "h")
    return log_refs(spark, sf_dir).join(recorded_frames(spark, sf_dir, meta).hint("merge"), "frame_id")


def stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frame log with the metadata and recorded detections of its frames."""
    return messages(spark, sf_dir, stream_refs(spark, sf_dir))


# ---------------------------------------------------------------- progress
# fixed values: error texts of failed micro-batches (by epoch_id % 4)
ERROR_TEXTS = ["java.lang.OutOfMemoryError: Java heap space", "Arrow stream closed",
               "Socket timeout", "Topic not found"]


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One progress record per micro-batch: rows, input rate at the 60 s
    trigger, and an error text when the batch's first event is an error."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type")
    agg = ev.groupBy(geometry.idiv(F.col("event_id"), FRAMES_PER_EPOCH).alias("batch_id")).agg(
        F.count(F.lit(1)).alias("num_input_rows"),
        F.min_by("event_type", "event_id").alias("_first"))
    texts = F.array(*[F.lit(t) for t in ERROR_TEXTS])
    err = F.when(F.col("_first") == "error",
                 F.element_at(texts, (F.col("batch_id") % len(ERROR_TEXTS) + 1).cast("int")))
    return agg.select("batch_id", "num_input_rows",
                      (F.col("num_input_rows") / 60.0).alias("input_rows_per_second"),
                      err.alias("error"))
