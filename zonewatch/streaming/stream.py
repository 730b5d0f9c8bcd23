"""Structured Streaming: frame-log source and sink, the micro-batch job,
progress feed, recovery (A1-A3, A5, A8, I1-I4, I7 stream).

The Kafka path keeps the reference's options, mapped to keys Spark actually
passes to the consumer (``kafka.`` + consumer property).  Where the Kafka
connector is not on the classpath the same schema is streamed from Parquet
files (``maxFilesPerTrigger`` standing in for ``maxOffsetsPerTrigger``).

Every write in the micro-batch job is idempotent per ``batch_id``: evidence,
summaries and alerts (content-hash ids) overwrite their batch partition.  A
replayed batch therefore produces no duplicates, and a failing batch fails
the query (no swallowed errors) so the checkpoint never commits a batch
whose outputs are missing.
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from zonewatch import config
from zonewatch.functions import geometry
from zonewatch.functions import payload as P
from zonewatch.operators import breaker as B
from zonewatch.operators import detect as D
from zonewatch.operators import sinks as S
from zonewatch.session import SHUFFLES_END, settings
from zonewatch.sources import containers

KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])
# Frame metadata: columns of a Parquet log, headers (decimal text) on a Kafka topic.
META = {"frame_id": "long", "camera_id": "int", "epoch_id": "long", "row_idx": "int",
        "captured_us": "long", "w": "int", "h": "int"}
RECORDED = T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("conf", T.DoubleType()),
    *[T.StructField(c, T.LongType()) for c in ("x1", "y1", "x2", "y2")]]))
FRAME_FIELDS = [T.StructField("frame_id", T.LongType()), T.StructField("camera_id", T.IntegerType()),
                T.StructField("epoch_id", T.LongType()), T.StructField("row_idx", T.IntegerType()),
                T.StructField("w", T.IntegerType()), T.StructField("h", T.IntegerType()),
                T.StructField("recorded", RECORDED)]
FRAME_LOG_SCHEMA = T.StructType(KAFKA_SCHEMA.fields + FRAME_FIELDS)
# messages by reference: the value is that of the document
FRAME_REF_SCHEMA = T.StructType([f for f in FRAME_LOG_SCHEMA.fields if f.name != "value"] + [T.StructField("doc_id", T.LongType())])


# ------------------------------------------------------------ A1/A2 source
def kafka_options(bootstrap: str, topic: str = config.FRAME_TOPIC,
                  max_per_trigger: int | None = None,
                  consumer: dict | None = None) -> dict:
    """Source options: earliest start, tolerate deleted offsets.  No rate cap
    unless one is asked for (the reference's is ``config.MAX_OFFSETS_PER_TRIGGER``):
    with a cap below the feed's rate, retention deletes what was never read.
    Consumer properties need the ``kafka.`` prefix only (``kafka.consumer.x``
    would reach the client as the unknown property ``consumer.x``)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": "earliest", "failOnDataLoss": "false",
            "includeHeaders": "true"}
    if max_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
    for k, v in (consumer or {}).items():
        opts[k if k.startswith("kafka.") else f"kafka.{k}"] = str(v)
    return opts


def frame_stream(spark: SparkSession, source: str = "parquet", path: str | None = None,
                 max_per_trigger: int | None = None, schema: T.StructType = FRAME_LOG_SCHEMA, **kafka) -> DataFrame:
    """A1/A2: the frame topic as a streaming DataFrame with the Kafka schema
    (a Parquet log may hold ``schema`` instead)."""
    if source == "kafka":
        return spark.readStream.format("kafka").options(**kafka_options(**kafka)).load()
    reader = spark.readStream.schema(schema).format("parquet")
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    return reader.load(path)


def frame_meta(raw: DataFrame) -> DataFrame:
    """Frame metadata of Kafka rows as columns, from the headers where the
    publisher set them.  A message without them is named by its place in the
    topic: frame_id = partition * 2^44 + offset, camera = partition, epoch and
    row index by offset (five frames an epoch), size = the reference size the
    producer scales to.  A Parquet log has the columns already."""
    if "frame_id" in raw.columns:
        return raw
    if "headers" in raw.columns:
        raw = raw.withColumn("_h", F.map_from_entries(F.transform(
            F.coalesce("headers", F.array().cast(raw.schema["headers"].dataType)),
            lambda h: F.struct(h["key"], h["value"].cast("string")))))
        meta = {c: F.col("_h")[c].try_cast(t) for c, t in META.items()}
    else:
        meta = {c: F.lit(None).cast(t) for c, t in META.items()}
    per_epoch = config.MAX_OFFSETS_PER_TRIGGER
    place = {"frame_id": F.col("partition").cast("long") * (1 << 44) + F.col("offset"), "camera_id": F.col("partition"),
             "epoch_id": geometry.idiv(F.col("offset"), per_epoch), "row_idx": (F.col("offset") % per_epoch).cast("int"),
             "w": F.lit(config.REF_SIZE), "h": F.lit(config.REF_SIZE)}
    taken = F.coalesce(F.timestamp_micros(meta["captured_us"]), F.col("timestamp"))
    out = raw.select(*[c for c in raw.columns if c not in ("timestamp", "headers", "_h")], taken.alias("timestamp"),
                     *[F.coalesce(meta[c], v).cast(META[c]).alias(c) for c, v in place.items()])
    return out


def parse_frames(raw: DataFrame) -> DataFrame:
    """B1-B4 on a stream: metadata and value as text, then the input gate."""
    raw = frame_meta(raw)
    cols = [c for c in raw.columns if c not in ("key", "value")]
    return raw.select(*cols, P.cast_value("value").alias("frame_b64")).where(P.input_gate("frame_b64"))


# ------------------------------------------------------------ A3 publish
def publish_options(bootstrap: str, topic: str = config.FRAME_TOPIC) -> dict:
    """Producer settings of the reference (acks=all, 3 retries, 16 KiB
    batches, 10 ms linger, 32 MiB buffer) as Spark Kafka sink options."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": "all",
            "kafka.retries": "3", "kafka.batch.size": "16384", "kafka.linger.ms": "10",
            "kafka.buffer.memory": str(32 * 1024 * 1024)}


def publish_frames(frames: DataFrame, sink: str = "parquet", path: str | None = None,
                   bootstrap: str | None = None) -> None:
    """A3: publish frames keyed by camera (so per-camera order survives the
    topic's partitioning); value = base64 payload."""
    out = frames.select(F.col("camera_id").cast("string").cast("binary").alias("key"),
                        F.col("frame_b64").cast("binary").alias("value"),
                        *[c for c in frames.columns if c not in ("frame_b64",)])
    if sink == "kafka":
        kafka_rows(frames).write.format("kafka").options(**publish_options(bootstrap)).save()
    else:
        out.write.mode("append").parquet(path)


def kafka_rows(frames: DataFrame) -> DataFrame:
    """key, value and headers of the messages; metadata that is NULL has no header."""
    if "captured_us" not in frames.columns and "captured_at" in frames.columns:
        frames = frames.withColumn("captured_us", F.unix_micros("captured_at"))
    headers = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").cast("binary").alias("value"))
                        for c in META if c in frames.columns])
    return frames.select(F.col("camera_id").cast("string").cast("binary").alias("key"),
                         F.col("frame_b64").cast("binary").alias("value"),
                         F.filter(headers, lambda h: h["value"].isNotNull()).alias("headers"))


# ------------------------------------------------------------ A5 file ingest
def frame_files(spark: SparkSession, path: str, glob: str = "*", stream: bool = False) -> DataFrame:
    """A5: frames stored one per file, read as binary; ``frame_b64`` is the
    file content in base64 (the image source decodes instead)."""
    reader = (spark.readStream.format("binaryFile") if stream else spark.read.format("binaryFile"))
    df = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return df.select("path", "length", P.b64_encode(F.col("content")).alias("frame_b64"))


def frame_containers(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """A5 for many small frames: container files read by byte range (``sources.containers``)."""
    containers.register(spark)
    reader = (spark.readStream if stream else spark.read).format(containers.FORMAT).options(**options)
    return reader.load(path).select("path", "name", "length", P.b64_encode(F.col("content")).alias("frame_b64"))


# ------------------------------------------------------- A8/I1/I2 the job
RESULT = ["batch_id", "epoch_id", "frame_id", "camera_id", "row_idx", "timestamp", "result"]  # what is written of a frame


def process_batch(df: DataFrame, batch_id: int, out_dir: str, detector=None) -> None:
    """One micro-batch: results, evidence, alerts and a summary row, all
    written idempotently for ``batch_id``.  Errors propagate (the batch is
    retried from the checkpoint instead of being committed half-done)."""
    # the micro-batch is read once: a second read would count its rows again in the progress
    df = df.withColumn("batch_id", F.lit(batch_id).cast("long")).persist()
    res = met = None
    try:
        if df.isEmpty():  # E14
            return
        keyed = "status" in df.columns  # the detector has run inside the stateful operator
        if keyed:
            res = D.finish(df)
        else:
            gated = df
            if detector is not None:
                states = breaker_states(df.sparkSession, out_dir, batch_id)
                met = B.open_cameras(states, df.groupBy("camera_id").agg(F.max(F.unix_timestamp("timestamp")).alias("t"))).persist()
                met.count()  # held, so that the planner knows its few bytes and need not shuffle the payloads to join it
                # Frames of a camera whose breaker is open pass by the detector
                shut = met.where("open").select("camera_id", F.lit("CIRCUIT_BREAKER_OPEN").alias(D.GATE))
                gated = df.join(shut, "camera_id", "left")
            res = D.predict(gated, detector)
        res = res.select(*RESULT).persist()  # the payload once, in the result
        status = P.status_decode(F.col("result"))
        summary = res.groupBy("batch_id", "epoch_id").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(P.nonblank(F.col("result"))).cast("long").alias("processed"),
            F.count_if(status.isin("VIOLATION", "NORMAL")).cast("long").alias("saved"),
            F.count_if(status == "VIOLATION").cast("long").alias("violations"))
        (summary.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch_id").parquet(os.path.join(out_dir, "summary")))
        saved = res.where(status.isin("VIOLATION", "NORMAL"))
        viol, pl, out_route = P.parse_result(F.col("result"))
        ev = saved.select("frame_id", "camera_id", "epoch_id", "batch_id",
                          F.when(viol, "VIOLATION").otherwise("NORMAL").alias("verdict"),
                          out_route.alias("out_dir"),
                          F.format_string("epoch%d_frame%d", "epoch_id", "row_idx").alias("short_name"),
                          S.evidence_name(F.unix_timestamp("timestamp"), viol, F.col("epoch_id"),
                                          F.col("row_idx")).alias("file_name"),
                          F.col("timestamp").alias("captured_at"), pl.alias("payload"))
        (ev.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
           .partitionBy("batch_id", "verdict").parquet(os.path.join(out_dir, "evidence")))
        S.write_alerts(S.alerts(ev), os.path.join(out_dir, "alerts"))
        if detector is not None and not keyed:
            outcomes = res.groupBy("camera_id").agg(
                (F.count_if(status.isin("VIOLATION", "NORMAL")) / F.count(F.lit(1)) < config.LOW_SUCCESS_RATE).alias("fail"))
            (B.next_states(states, met, outcomes).withColumn("batch_id", F.lit(batch_id).cast("long"))
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("batch_id").parquet(os.path.join(out_dir, "breaker")))
            forget(df.sparkSession, os.path.join(out_dir, "breaker"), batch_id - 1)
    finally:
        for held in (df, met, res):
            if held is not None:
                held.unpersist()


def snapshots(spark: SparkSession, folder: str) -> dict[int, str]:
    """Folders of a table partitioned by batch_id, from their names alone."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return {int(n.removeprefix("batch_id=")): f"{folder}/{n}" for n in names if n.startswith("batch_id=")}


def forget(spark: SparkSession, folder: str, before: int) -> None:
    """Remove the snapshots of micro-batches earlier than ``before``: a replay needs the last one only."""
    for batch, path in snapshots(spark, folder).items():
        if batch < before:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def latest_snapshot(spark: SparkSession, folder: str, batch_id: int, schema: str) -> DataFrame:
    """What the last micro-batch before ``batch_id`` wrote (a replayed batch reads the same)."""
    earlier = {k: v for k, v in snapshots(spark, folder).items() if k < batch_id}
    return spark.read.schema(schema).parquet(earlier[max(earlier)]) if earlier else spark.createDataFrame([], schema)


def breaker_states(spark: SparkSession, out_dir: str, batch_id: int) -> DataFrame:
    """Breaker state of every camera before ``batch_id``."""
    return latest_snapshot(spark, os.path.join(out_dir, "breaker"), batch_id, B.STATE)


def run_stream(raw: DataFrame, out_dir: str, checkpoint: str, detector=None,
               available_now: bool = True, interval: str = config.TRIGGER_INTERVAL, keyed: bool = False, lanes: int = 1):
    """Start the micro-batch job with a stable checkpoint (restarts
    resume instead of re-reading from the earliest offset).  ``keyed`` runs the detector inside
    the stateful breaker (``breaker.detect_keyed``): the state is the checkpoint's, in two partitions
    a core at most, and a camera's frames meet in ``lanes`` tasks.  Otherwise the detector runs on the frames as they come, over
    all tasks, and the job keeps one snapshot of the breaker's state."""
    parsed = parse_frames(raw)
    if keyed:
        parsed = B.detect_keyed(D.send(parsed), detector, lanes=lanes, ttl_ms=None if available_now else B.DAY_MS)
    w = (parsed.writeStream.foreachBatch(lambda df, bid: process_batch(df, bid, out_dir, detector))
               .outputMode("append").option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return start(raw.sparkSession, w, **(B.state_partitions(raw.sparkSession) if keyed else {}))


def start(spark: SparkSession, writer, **values):
    """Start a stream with the SQL settings ``values``; a micro-batch's shuffles end with it."""
    with settings(spark, **SHUFFLES_END, **values):
        return writer.start()


# ------------------------------------------------------------ I4 progress
class ProgressFeed(StreamingQueryListener):
    """I4: a row (batch id, input rows, rate, error) per progress event, appended
    to a JSON-lines table in the shared folder as it arrives; the driver keeps
    nothing but the number of its next file."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.n = spark, path, 0
        self.ended = threading.Event()

    def _append(self, row: tuple) -> None:
        self.n += 1
        name = f"event={row[0]}-{self.n:09d}"  # by run, so that a feed started again goes on beside the earlier one's
        self.spark.createDataFrame([row], PROGRESS_SCHEMA).coalesce(1).write.json(f"{self.path}/{name}")

    def onQueryStarted(self, event):
        self.ended.clear()

    def onQueryProgress(self, event):
        p = event.progress
        self._append((str(p.runId), int(p.batchId), int(p.numInputRows), float(p.inputRowsPerSecond or 0.0), None))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            self._append((str(event.runId), -1, 0, 0.0, str(event.exception)))
        self.ended.set()

    def table(self) -> DataFrame:
        """All events of the queries that have ended (events come in order, the
        end last, so waiting for it misses none)."""
        self.ended.wait()
        return self.spark.read.schema(PROGRESS_SCHEMA).json(self.path).drop("event")


PROGRESS_SCHEMA = "run_id string, batch_id long, num_input_rows long, input_rows_per_second double, error string"


# ------------------------------------------------------------ I7 windows
def violations_per_window_stream(verdict_stream: DataFrame, width: str = "1 hour",
                                 delay: str = "10 minutes") -> DataFrame:
    """Tumbling event-time counts per camera; the watermark closes a
    window ``delay`` after its end and drops later frames."""
    return (verdict_stream.withWatermark("captured_at", delay)
            .groupBy(F.window("captured_at", width).alias("w"), "camera_id")
            .agg(F.count(F.lit(1)).alias("frames"), F.count_if(F.col("violation")).cast("long").alias("violations"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "camera_id", "frames", "violations"))


# ------------------------------------------------------------ I7 with late rows
MARK = "high long"  # the latest event time seen, microseconds


def window_batch(df: DataFrame, batch_id: int, out_dir: str, width: str = "1 hour", delay: str = "10 minutes") -> None:
    """One micro-batch of event-time counts that keeps what the watermark shuts out.  The watermark is
    ``delay`` behind the latest event of earlier micro-batches; frames of windows that end
    no later go to the table ``late``, the others are added up for this micro-batch in ``windows``.
    Every write is a partition of the micro-batch, so a replay changes nothing."""
    spark = df.sparkSession
    marks = os.path.join(out_dir, "marks")
    high = latest_snapshot(spark, marks, batch_id, MARK).agg(F.max("high")).first()[0]
    df = df.withColumn("w", F.window("captured_at", width)).withColumn("batch_id", F.lit(batch_id).cast("long")).persist()
    try:
        shut = F.lit(False) if high is None else F.col("w.end") <= F.timestamp_micros(F.lit(high)) - F.expr(f"INTERVAL {delay}")
        counts = df.where(~shut).groupBy("batch_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "camera_id").agg(
            F.count(F.lit(1)).alias("frames"), F.count_if(F.col("violation")).cast("long").alias("violations"))
        late = df.where(shut).select("batch_id", "frame_id", "camera_id", "captured_at", "violation",
                                     F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
        mark = df.agg(F.greatest(F.max(F.unix_micros("captured_at")), F.lit(high).cast("long")).alias("high")).withColumn(
            "batch_id", F.lit(batch_id).cast("long"))
        for name, rows in (("windows", counts), ("late", late), ("marks", mark)):
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(
                os.path.join(out_dir, name))
        forget(spark, marks, batch_id - 1)
    finally:
        df.unpersist()


WINDOWS = "window_start timestamp, window_end timestamp, camera_id int, frames long, violations long, batch_id long"
LATE = ("frame_id long, camera_id int, captured_at timestamp, violation boolean, window_start timestamp, window_end timestamp, "
        "batch_id long")


def window_table(spark: SparkSession, out_dir: str, delay: str = "10 minutes") -> DataFrame:
    """Windows so far: frames and violations counted, frames that came too late, and whether the
    watermark has closed the window."""
    done = {name: spark.read.schema(schema).parquet(os.path.join(out_dir, name)) for name, schema in (("windows", WINDOWS), ("late", LATE))}
    high = latest_snapshot(spark, os.path.join(out_dir, "marks"), 1 << 62, MARK).agg(F.max("high")).first()[0]
    key = ["window_start", "window_end", "camera_id"]
    zero = F.lit(0).cast("long")
    told = done["windows"].select(*key, "frames", "violations", zero.alias("late")).unionByName(
        done["late"].select(*key, zero.alias("frames"), zero.alias("violations"), F.lit(1).cast("long").alias("late")))
    closed = F.col("window_end") <= F.timestamp_micros(F.lit(high).cast("long")) - F.expr(f"INTERVAL {delay}")
    return told.groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("frames", "violations", "late")]).withColumn("closed", closed)


def run_windows(verdicts: DataFrame, out_dir: str, checkpoint: str, width: str = "1 hour", delay: str = "10 minutes"):
    """I7 with a side table of late frames, over a stream of verdicts."""
    return (verdicts.writeStream.foreachBatch(lambda df, bid: window_batch(df, bid, out_dir, width, delay))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
