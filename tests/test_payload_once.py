"""A payload is computed once a row, and neither staged nor shuffled."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from zonewatch.functions import payload as P
from zonewatch.operators import detect as D
from zonewatch.plans import q_detect, q_stream
from zonewatch.plans.catalog import QUERIES
from zonewatch.sources import fixtures as fx
from zonewatch.streaming import stream as ST


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_gates_and_filters_encode_a_payload_once(spark):
    for name in ("gate_non_empty", "gate_base64", "passthrough", "gate_report", "drop_empty", "parse_result", "skip_rule"):
        plan = _optimized(QUERIES[name].build(spark, SF_SMALL))
        gates = [line for line in plan.splitlines() if "Filter" in line and "Base64.encode" in line]
        assert not gates, (name, gates)


def test_decode_names_its_input_once(spark):
    df = spark.createDataFrame([("QUJD",), ("QUI=x",), (None,), ("é",)], "s string")
    plan = _optimized(df.select(P.b64_decode("s").alias("b")).where(F.lit(True)))
    assert plan.count("s#") <= 4, plan
    got = [r.h for r in df.select(F.hex(P.b64_decode("s")).alias("h")).collect()]
    assert got == ["414243", "4142", None, None]
    assert [r.n for r in df.select(P.decoded_length("s").alias("n")).collect()] == [3, 2, None, None]


def test_gate_of_one_expression(spark):
    cases = [(None, False), ("", False), ("A", True), ("\n", True), ("QUJD==", True), ("QUJD===", False), ("A B", False), ("QUJD\n", True), ("é", False)]
    df = spark.createDataFrame(cases, "s string, kept boolean")
    assert all(r.g == r.kept for r in df.select("kept", P.input_gate("s").alias("g")).collect())


def test_staged_log_holds_no_payload(spark, tmp_path):
    q_stream._stage_refs(spark, SF_SMALL, str(tmp_path / "log"))
    staged = spark.read.parquet(str(tmp_path / "log"))
    assert "value" not in staged.columns and "doc_id" in staged.columns
    cols = ["frame_id", "partition", "offset", "timestamp", "epoch_id", "row_idx", F.md5("value").alias("m")]
    got = fx.messages(spark, SF_SMALL, spark.read.schema(ST.FRAME_REF_SCHEMA).parquet(str(tmp_path / "log"))).select(*cols)
    want = fx.stream_log(spark, SF_SMALL).select(*cols)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_files_follow_the_bytes_of_the_messages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(q_stream, "PAYLOAD_BYTES", 100_000)
    n = q_stream._stage_refs(spark, SF_SMALL, str(tmp_path / "log"))
    assert n > q_stream.LEAST_FILES


def test_budget_waits_are_worked_out_without_payloads(spark):
    plan = _optimized(QUERIES["detect_budget"].build(spark, SF_SMALL)).splitlines()
    at = next(i for i, line in enumerate(plan) if "Window [" in line)
    depth = len(plan[at]) - len(plan[at].lstrip(" :+-"))
    below = [line for k, line in enumerate(plan[at:]) if k == 0 or len(line) - len(line.lstrip(" :+-")) > depth]
    under = below[: next((k for k, line in enumerate(plan[at + 1:], 1) if len(line) - len(line.lstrip(" :+-")) <= depth), len(below))]
    assert not any("text#" in line for line in under), under


def test_batch_encodes_a_document_before_it_meets_its_frames(spark):
    """once a document, not once a frame."""
    base = fx.frames(spark, SF_SMALL).select("frame_id", "camera_id")
    lines = _optimized(fx.frame_payloads(spark, SF_SMALL, base=base)).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join LeftOuter" in line)
    coded = [i for i, line in enumerate(lines) if "Base64.encode" in line]
    assert coded and min(coded) > join, lines


def test_detected_frames_come_back_without_what_nobody_asks_for(spark):
    """the recorded boxes go to the detector's task, not back."""
    frames = q_detect.frames_with_payload(spark, SF_SMALL)
    all_columns = D.detect(frames, D.RecordedDetector())
    assert "recorded" in all_columns.columns and "frame_b64" not in all_columns.columns
    few = D.detect(frames, D.RecordedDetector(), keep=["frame_id"])
    assert few.columns == ["frame_id", "status", "error_msg", "detections"]
    key = ["frame_id", "status", "error_msg", F.to_json("detections")]
    assert few.select(*key).exceptAll(all_columns.select(*key)).count() == 0 and few.count() == frames.count()
    assert q_detect._run(spark, SF_SMALL).columns == few.columns


def test_failing_batch_call_ends_at_the_box_without_an_area():
    """the frames behind it are not gone through."""
    asked = []

    class Counts(D.RecordedBatchDetector):
        def infer(self, model, image, w, h, recorded):
            asked.append(image)
            return super().infer(model, image, w, h, recorded)

    box = {"label": "car", "conf": 0.9, "x1": 1, "y1": 1, "x2": 5, "y2": 5}
    try:
        Counts().infer_batch(True, [b"a", b"b", b"c", b"d"], [9] * 4, [9] * 4, [[box], [box, {**box, "x2": 1}], None, [box]])
    except ValueError as exc:
        assert str(exc) == "box without an area"
    assert asked == [b"a", b"b"]


def test_routes_are_read_off_results_written_once(spark):
    """detections and frames are gone through once, for the evidence and for what it must account for."""
    df = QUERIES["route_partition"].build(spark, SF_SMALL)
    assert not any("lineitem" in f or "events" in f for f in df.inputFiles()), df.inputFiles()
    n = {r.route: r.n for r in df.collect()}
    assert n["missing"] == n["extra"] == 0 and sum(n.values()) == fx.frames(spark, SF_SMALL).count()
