"""Queries over frame payloads, the frame log and result strings
(A4, A6, A7, B1-B8, B12, B13, C1-C7, C9, C11, C15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewatch import config
from zonewatch.functions import payload as P
from zonewatch.operators import results as R
from zonewatch.operators import sinks as S
from zonewatch.plans.oracle_views import decoded_len_sql, validate_sql
from zonewatch.plans.oracle_views import with_views as W
from zonewatch.plans.registry import register
from zonewatch.sources import fixtures as fx
from zonewatch.sources.tables import table

# Java's `$` also matches before one final line terminator
_GATE_SQL = r"regexp_matches({s}, '^[A-Za-z0-9+/]*={{0,2}}(?:\r\n|[\n\r\x{{85}}\x{{2028}}\x{{2029}}])?$')"


def gate_sql(s: str) -> str:
    return _GATE_SQL.format(s=s)


_LOG_CAST = W("frame_log") + """, cast_log AS (
  SELECT topic, partition, "offset", decode(value) AS frame_b64 FROM frame_log)
"""


def _cast_log(spark, sf):
    log = fx.frame_log(spark, sf)
    return P.once(log.select("topic", "partition", "offset", "value"), "frame_b64", P.cast_value("value")).drop("value")


@register("cast_value", "B1", _LOG_CAST + "SELECT * FROM cast_log")
def cast_value(spark, sf):
    return _cast_log(spark, sf)


@register("gate_not_null", "B2", _LOG_CAST +
          'SELECT topic, partition, "offset" FROM cast_log WHERE frame_b64 IS NOT NULL')
def gate_not_null(spark, sf):
    return _cast_log(spark, sf).where(F.col("frame_b64").isNotNull()).select("topic", "partition", "offset")


@register("gate_non_empty", "B3", _LOG_CAST +
          'SELECT topic, partition, "offset" FROM cast_log WHERE frame_b64 IS NOT NULL AND frame_b64 <> \'\'')
def gate_non_empty(spark, sf):
    c = _cast_log(spark, sf)
    return c.where(F.col("frame_b64").isNotNull() & (F.col("frame_b64") != "")).select("topic", "partition", "offset")


@register("gate_base64", "B4", _LOG_CAST +
          f'SELECT topic, partition, "offset" FROM cast_log WHERE frame_b64 IS NOT NULL AND frame_b64 <> \'\' '
          f'AND {gate_sql("frame_b64")}')
def gate_base64(spark, sf):
    return _cast_log(spark, sf).where(P.input_gate("frame_b64")).select("topic", "partition", "offset")


@register("gate_report", "B5", _LOG_CAST + f"""
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN frame_b64 IS NULL THEN 'null' WHEN frame_b64 = '' THEN 'empty'
              WHEN NOT {gate_sql('frame_b64')} THEN 'not_base64' ELSE 'kept' END AS reason
  FROM cast_log) t GROUP BY reason""")
def gate_report(spark, sf):
    c = _cast_log(spark, sf)
    reason = F.coalesce(P.reject_reason(F.col("frame_b64")), F.lit("kept"))
    return c.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@register("passthrough", "B8", _LOG_CAST + f"""
SELECT topic, partition, "offset", '{config.PASSTHROUGH}' AS result FROM cast_log
WHERE frame_b64 IS NOT NULL AND frame_b64 <> '' AND {gate_sql('frame_b64')}""")
def passthrough(spark, sf):
    from zonewatch.operators import detect
    gated = _cast_log(spark, sf).where(P.input_gate("frame_b64"))
    return detect.predict(gated, detector=None).select("topic", "partition", "offset", "result")


@register("topic_inventory", "A4", W("frame_log") + """
SELECT topic, partition, max("offset") + 1 AS end_offset, count(*) AS retained
FROM frame_log GROUP BY topic, partition""")
def topic_inventory(spark, sf):
    return S.topic_inventory(fx.frame_log(spark, sf))


@register("topic_total", "A4", W("frame_log") + """
SELECT t.topic, coalesce(i.total, 0) AS total, coalesce(i.held, 0) AS held
FROM (VALUES ('frames'), ('idle')) t(topic)
LEFT JOIN (SELECT topic, sum(end_offset) AS total, sum(retained) AS held FROM (
             SELECT topic, partition, max("offset") + 1 AS end_offset, count(*) AS retained
             FROM frame_log GROUP BY topic, partition) GROUP BY topic) i ON i.topic = t.topic""")
def topic_total(spark, sf):
    """The frame topic's total, and that of a topic no message was sent to."""
    topics = spark.createDataFrame([(fx.FRAME_TOPIC,), ("idle",)], "topic string")
    return S.topic_total(fx.frame_log(spark, sf), topics)


@register("parse_offsets", "C11", W("frame_log") + """
SELECT line, CAST(split_part(line, ':', -1) AS BIGINT) AS end_offset FROM (
  SELECT topic || ':' || partition || ':' || (max("offset") + 1) AS line FROM frame_log GROUP BY topic, partition
  UNION ALL SELECT 'no offsets reported' AS line) t
WHERE contains(line, ':')""")
def parse_offsets(spark, sf):
    """C11: offset-shell lines ``topic:partition:end`` -> end offset; lines
    without ':' are ignored (the summed total is ``sum(end_offset)``)."""
    lines = S.offset_lines(fx.frame_log(spark, sf))
    return S.parse_offset_lines(lines)


# ------------------------------------------------------------- C1-C4 base64
@register("b64_encode", "C1", "SELECT doc_id, to_base64(encode(text)) AS b64 FROM documents")
def b64_encode(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return docs.select("doc_id", P.b64_encode(F.encode("text", "UTF-8")).alias("b64"))


def _decode_oracle():
    s = "frame_b64"
    s2 = f"regexp_replace({s}, '[^A-Za-z0-9+/=]', '', 'g')"
    n = decoded_len_sql(s)
    d = f"(({n}) * 4 + 2) // 3"  # data characters consumed
    padded = f"left(replace({s2}, '=', ''), CAST({d} AS INTEGER)) || repeat('=', CAST((4 - {d} % 4) % 4 AS INTEGER))"
    return (W("payloads") + f"""
SELECT frame_id, octet_length(bin) AS decoded_bytes, md5(bin) AS decoded_md5 FROM (
  SELECT frame_id, CASE WHEN {n} IS NOT NULL THEN from_base64({padded}) END AS bin FROM payloads) t""")


@register("b64_decode", "C2", _decode_oracle())
def b64_decode(spark, sf):
    p = fx.frame_payloads(spark, sf)
    return P.once(p, "b", P.b64_decode("frame_b64")).select(
        "frame_id", F.octet_length("b").cast("long").alias("decoded_bytes"), F.md5("b").alias("decoded_md5"))


@register("validate_payload", "C3", W("reasons") + "SELECT frame_id, reason FROM reasons")
def validate_payload(spark, sf):
    return fx.frame_reasons(spark, sf).select("frame_id", "reason")


@register("validate_documents", "C3", f"""
SELECT doc_id, {validate_sql("to_base64(encode(text))")} AS reason_b64, {validate_sql("text")} AS reason_raw
FROM documents""")
def validate_documents(spark, sf):
    return fx.document_reasons(spark, sf)


@register("reason_counts", "C4", W("reasons") + "SELECT reason, count(*) AS n FROM reasons GROUP BY reason")
def reason_counts(spark, sf):
    r = fx.frame_reasons(spark, sf)
    return r.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------- results and codecs
def _results(spark, sf):
    return P.once(R.frame_results(spark, sf, with_payload=True), "result", F.col("result"))


@register("encode_result", "C5", W("results") + "SELECT frame_id, result FROM results")
def encode_result(spark, sf):
    return _results(spark, sf).select("frame_id", "result")


@register("status_decode", "C15", W("statuses") + "SELECT frame_id, status FROM statuses")
def status_decode(spark, sf):
    return _results(spark, sf).select("frame_id", P.status_decode(F.col("result")).alias("status"))


@register("parse_result", "C6", W("results") + f"""
SELECT frame_id, starts_with(result, '{config.VIOLATION_PREFIX}') AS violation,
       md5(replace(result, '{config.VIOLATION_PREFIX}', '')) AS payload_md5,
       CASE WHEN starts_with(result, '{config.VIOLATION_PREFIX}') THEN 'output_violation'
            ELSE 'output_processed' END AS out_dir
FROM results WHERE result <> ''""")
def parse_result(spark, sf):
    r = _results(spark, sf).where(F.col("result") != "")
    violation, pl, out_dir = P.parse_result(F.col("result"))
    return r.select("frame_id", violation.alias("violation"), F.md5(pl).alias("payload_md5"),
                    out_dir.alias("out_dir"))


_PY_WS = r"[^\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


@register("nonblank_results", "B12", W("statuses") +
          f"SELECT frame_id, status FROM statuses WHERE regexp_matches(result, '{_PY_WS}')")
def nonblank_results(spark, sf):
    r = _results(spark, sf)
    return r.where(P.nonblank(F.col("result"))).select("frame_id", "status")


@register("drop_empty", "B7", W("statuses") + "SELECT frame_id, status FROM statuses WHERE result <> ''")
def drop_empty(spark, sf):
    r = _results(spark, sf)
    return r.where(F.col("result") != "").select("frame_id", "status")


def _skip_oracle():
    pl = f"replace(result, '{config.VIOLATION_PREFIX}', '')"
    skipped = ", ".join(f"'{x}'" for x in config.SKIPPED_RESULTS)
    return W("results") + f"""
SELECT frame_id, {pl} IN ({skipped}) AS skipped, {decoded_len_sql(pl)} IS NOT NULL AS decodable
FROM results WHERE regexp_matches(result, '{_PY_WS}')"""


@register("skip_rule", "B13", _skip_oracle())
def skip_rule(spark, sf):
    r = _results(spark, sf).where(P.nonblank(F.col("result")))
    _, pl, _ = P.parse_result("result")
    return r.select("frame_id", P.skipped(F.col("result")).alias("skipped"),
                    P.decoded_length(pl).isNotNull().alias("decodable"))


# ------------------------------------------------------------- A6/A7/C7/C9
_EVIDENCE = W("statuses", "frames") + f""", evidence AS (
  SELECT s.frame_id, s.epoch_id, s.camera_id, f.captured_at,
         CASE WHEN s.status = 'VIOLATION' THEN 'VIOLATION' ELSE 'NORMAL' END AS verdict,
         CASE WHEN s.status = 'VIOLATION' THEN 'output_violation' ELSE 'output_processed' END AS out_dir,
         'epoch' || s.epoch_id || '_frame' || s.row_idx AS short_name,
         (epoch_us(f.captured_at) // 1000000) || '_' || CASE WHEN s.status = 'VIOLATION' THEN 'VIOLATION' ELSE 'NORMAL' END
           || '_epoch' || s.epoch_id || '_frame' || s.row_idx || '.jpg' AS file_name,
         replace(s.result, '{config.VIOLATION_PREFIX}', '') AS payload
  FROM statuses s JOIN frames f ON f.frame_id = s.frame_id
  WHERE s.status IN ('VIOLATION', 'NORMAL'))
"""


@register("evidence_rows", "A6", _EVIDENCE +
          "SELECT frame_id, epoch_id, verdict, out_dir, file_name, md5(payload) AS payload_md5 FROM evidence")
def evidence_rows(spark, sf):
    ev = S.evidence(spark, sf)
    return ev.select("frame_id", "epoch_id", "verdict", "out_dir", "file_name",
                     F.md5("payload").alias("payload_md5"))


@register("evidence_name", "C7/C14", _EVIDENCE + "SELECT frame_id, file_name FROM evidence")
def evidence_name(spark, sf):
    return S.evidence(spark, sf).select("frame_id", "file_name")


@register("basename", "C9", _EVIDENCE +
          "SELECT frame_id, regexp_extract(out_dir || '/' || file_name, '[^/]+$', 0) AS base_name FROM evidence")
def basename(spark, sf):
    ev = S.evidence(spark, sf)
    return ev.select("frame_id", S.basename(F.concat_ws("/", "out_dir", "file_name")).alias("base_name"))


@register("alert_outbox", "A7/C10", _EVIDENCE + f"""
SELECT sha256(CAST(camera_id AS VARCHAR) || ':' || CAST(frame_id AS VARCHAR)) AS alert_id, frame_id,
       '{config.ALERT_CHANNEL}' AS channel,
       json_object('channel', '{config.ALERT_CHANNEL}',
                   'text', '{config.ALERT_MESSAGE}' || short_name || chr(10) || '\U0001F4C1 File: ' || file_name,
                   'username', '{config.ALERT_USERNAME}', 'icon_emoji', '{config.ALERT_ICON}')::VARCHAR AS body_json,
       captured_at AS created_at
FROM evidence WHERE verdict = 'VIOLATION'""")
def alert_outbox(spark, sf):
    return S.alerts(S.evidence(spark, sf))
