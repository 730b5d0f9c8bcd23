"""SQL (DuckDB dialect) definitions of the fixture views, for the oracle.

These are written independently of the DataFrame code: the detections get
their frame size through a join with ``frames`` (not from the id), and the
polygon test is relational (detections x samples x edges, then grouped).
Each oracle query is ``WITH <needed views> SELECT ...``.
"""

from __future__ import annotations

from zonewatch import config

# fixed values shared with the DataFrame fixtures (see FIXTURES.md)
_ZONE_VALUES = ", ".join(f"({k}, CAST({x!r} AS DOUBLE), CAST({y!r} AS DOUBLE))"
                         for k, (x, y) in enumerate(config.ZONE_640))
_NV = len(config.ZONE_640)
_SENT = {7: "CIRCUIT_BREAKER_OPEN", 13: "MODEL_UNAVAILABLE", 21: "INSUFFICIENT_MEMORY",
         29: "UDF_CRITICAL_ERROR"}

VIEWS: dict[str, tuple[list[str], str]] = {}


def view(name: str, deps: list[str], sql: str) -> None:
    VIEWS[name] = (deps, sql)


view("frames", [], """
SELECT frame_id, camera_id, captured_at, epoch_id, src_w, src_h,
       CASE WHEN src_w > 640 THEN CAST(trunc(src_w * (CAST(640 AS DOUBLE) / src_w)) AS INTEGER) ELSE src_w END AS w,
       CASE WHEN src_w > 640 THEN CAST(trunc(src_h * (CAST(640 AS DOUBLE) / src_w)) AS INTEGER) ELSE src_h END AS h
FROM (
  SELECT event_id AS frame_id, CAST(user_id % 8 AS INTEGER) AS camera_id,
         CAST(ts AS TIMESTAMP) AS captured_at, event_id // 5 AS epoch_id,
         CAST(CASE event_id % 5 WHEN 0 THEN 640 WHEN 1 THEN 640 WHEN 2 THEN 1280 WHEN 3 THEN 1920 ELSE 24 END AS INTEGER) AS src_w,
         CAST(CASE event_id % 5 WHEN 0 THEN 640 WHEN 1 THEN 360 WHEN 2 THEN 720 WHEN 3 THEN 1080 ELSE 24 END AS INTEGER) AS src_h
  FROM events) ev""")

view("dets", ["frames"], """
SELECT frame_id, det_key, class_id, label, conf, x1, y1, x2, y2, w, h,
       CAST(row_number() OVER (PARTITION BY frame_id ORDER BY conf DESC, det_key, x1, y1, x2, y2) AS INTEGER) AS det_id
FROM (
  SELECT frame_id, det_key, class_id, label, conf, w, h,
         bx * w // 640 AS x1, by_ * h // 640 AS y1,
         least(bx + 20 + e % 200, 639) * w // 640 AS x2,
         least(by_ + 20 + (e // 7) % 160, 639) * h // 640 AS y2
  FROM (
    SELECT l.l_orderkey AS frame_id,
           CAST(l.l_linenumber AS BIGINT) * 100000000 + l.l_partkey * 1000 + l.l_suppkey AS det_key,
           CAST(CASE WHEN l.l_partkey % 10 < 3 THEN 0 WHEN l.l_partkey % 10 < 6 THEN 1
                     WHEN l.l_partkey % 10 = 6 THEN 2 WHEN l.l_partkey % 10 < 9 THEN 3 ELSE 4 END AS INTEGER) AS class_id,
           CASE WHEN l.l_partkey % 10 < 3 THEN 'car' WHEN l.l_partkey % 10 < 6 THEN 'motorbike'
                WHEN l.l_partkey % 10 = 6 THEN 'person' WHEN l.l_partkey % 10 < 9 THEN 'red_light'
                ELSE 'stop_line' END AS label,
           l.l_quantity / 50.0 AS conf,
           (l.l_partkey * 37 + CAST(l.l_linenumber AS BIGINT) * 71) % 560 AS bx,
           (l.l_suppkey * 53 + CAST(l.l_linenumber AS BIGINT) * 17) % 480 AS by_,
           CAST(floor(l.l_extendedprice) AS BIGINT) AS e, f.w, f.h
    FROM lineitem l JOIN frames f ON f.frame_id = l.l_orderkey) a) b""")

view("usable", ["dets"], f"""
SELECT * FROM dets
WHERE conf >= {config.CONF_THRESHOLD} AND w BETWEEN {config.MIN_SIDE} AND {config.MAX_SIDE}
  AND h BETWEEN {config.MIN_SIDE} AND {config.MAX_SIDE}""")

view("zone_ref", [], f"SELECT * FROM (VALUES {_ZONE_VALUES}) z(k, x, y)")

# scaled vertices per frame size, and edges a -> b
view("zone_edges", ["frames", "zone_ref"], f"""
SELECT s.w, s.h, a.k,
       CAST(trunc(a.x * (s.w / 640)) AS BIGINT) AS ax, CAST(trunc(a.y * (s.h / 640)) AS BIGINT) AS ay,
       CAST(trunc(b.x * (s.w / 640)) AS BIGINT) AS bx, CAST(trunc(b.y * (s.h / 640)) AS BIGINT) AS by_
FROM (SELECT DISTINCT w, h FROM frames) s, zone_ref a JOIN zone_ref b ON b.k = (a.k + 1) % {_NV}""")

# samples of every usable vehicle, tested against every edge
view("sample_tests", ["usable", "zone_edges"], f"""
SELECT frame_id, det_id, i, px, py,
       bool_or(cr = 0 AND px BETWEEN least(ax, bx) AND greatest(ax, bx)
                      AND py BETWEEN least(ay, by_) AND greatest(ay, by_)) AS on_edge,
       count(*) FILTER (WHERE (ay > py) <> (by_ > py) AND ((by_ > ay) = (cr > 0))) AS crossings
FROM (
  SELECT d.frame_id, d.det_id, g.i, (10 * d.x1 + g.i * (d.x2 - d.x1)) // 10 AS px, d.y2 AS py,
         e.ax, e.ay, e.bx, e.by_,
         (e.bx - e.ax) * (d.y2 - e.ay) - ((10 * d.x1 + g.i * (d.x2 - d.x1)) // 10 - e.ax) * (e.by_ - e.ay) AS cr
  FROM usable d
  JOIN zone_edges e ON e.w = d.w AND e.h = d.h
  CROSS JOIN (SELECT range AS i FROM range(0, {config.NUM_SAMPLE_STEPS + 1})) g
  WHERE d.label IN ('car', 'motorbike')) t
GROUP BY frame_id, det_id, i, px, py""")

view("vehicle_hits", ["sample_tests"], f"""
SELECT frame_id, det_id, CAST(count(*) FILTER (WHERE on_edge OR crossings % 2 = 1) AS BIGINT) AS hits
FROM sample_tests GROUP BY frame_id, det_id""")

view("frame_flags", ["usable", "vehicle_hits"], f"""
SELECT u.frame_id, count(*) AS n_objects,
       bool_or(u.label = 'red_light') AS red_light,
       coalesce(bool_or(vh.hits * 2 > {config.NUM_SAMPLE_STEPS}), false) AS vehicle_in_zone
FROM usable u LEFT JOIN vehicle_hits vh ON vh.frame_id = u.frame_id AND vh.det_id = u.det_id
GROUP BY u.frame_id""")

view("verdicts", ["frames", "frame_flags"], """
SELECT f.frame_id, f.camera_id, f.epoch_id, f.w, f.h,
       coalesce(ff.n_objects, 0) AS n_objects,
       coalesce(ff.red_light, false) AS red_light,
       coalesce(ff.vehicle_in_zone, false) AS vehicle_in_zone,
       coalesce(ff.red_light, false) AND coalesce(ff.vehicle_in_zone, false) AS violation
FROM frames f LEFT JOIN frame_flags ff ON ff.frame_id = f.frame_id""")

# payload of every frame: documents round-robin, with NULL / '' / raw overrides
view("payloads", ["frames"], """
SELECT f.frame_id, f.camera_id, f.epoch_id, f.captured_at, d.doc_id,
       CASE f.frame_id % 50 WHEN 47 THEN NULL WHEN 48 THEN ''
            WHEN 49 THEN d.text ELSE to_base64(encode(d.text)) END AS frame_b64
FROM frames f LEFT JOIN documents d ON d.doc_id = f.frame_id % (SELECT count(*) FROM documents)""")

# Non-strict base64 rule written with RE2 patterns: Q is a quad that does not
# end the input; the decoder stops at the first '==' after 2 data chars of a
# quad or '=' after 3; else all data chars must fill whole quads.
_D = "[A-Za-z0-9+/]"
_Q = f"(?:=*{_D}=*{_D}=?{_D}{_D})"
B64_TERMINATED = f"^({_Q}*=*{_D}=*{_D}(?:==|=?{_D}=))"
B64_COMPLETE = f"^{_Q}*=*$"


def decoded_len_sql(s: str) -> str:
    """Bytes the non-strict decoder returns for ``s``; NULL when it fails.
    Non-alphabet ASCII characters are discarded, non-ASCII input fails."""
    s2 = f"regexp_replace({s}, '[^A-Za-z0-9+/=]', '', 'g')"
    term = f"regexp_extract({s2}, '{B64_TERMINATED}', 1)"
    dchars = (f"CASE WHEN {term} <> '' THEN length(replace({term}, '=', '')) "
              f"WHEN regexp_matches({s2}, '{B64_COMPLETE}') THEN length(replace({s2}, '=', '')) END")
    return f"(CASE WHEN NOT regexp_matches({s}, '[^\\x00-\\x7F]') THEN ({dchars}) * 3 // 4 END)"


def validate_sql(s: str) -> str:
    """C3 validation cascade in DuckDB SQL over expression ``s``."""
    dlen = decoded_len_sql(s)
    return f"""CASE
  WHEN {s} IS NULL OR {s} = '' THEN '{config.REASON_EMPTY}'
  WHEN length({s}) < {config.MIN_B64_CHARS} THEN '{config.REASON_SHORT}'
  WHEN length({s}) > {config.MAX_B64_CHARS} THEN '{config.REASON_LONG}'
  WHEN NOT regexp_full_match(regexp_replace({s}, '[+/=\\r\\n]', '', 'g'), '[\\p{{L}}\\p{{N}}]+') THEN '{config.REASON_CHARS}'
  WHEN {dlen} IS NULL THEN '{config.REASON_DECODE}'
  WHEN {dlen} < {config.MIN_DECODED_BYTES} THEN '{config.REASON_SMALL}'
  WHEN {dlen} > {config.MAX_DECODED_BYTES} THEN '{config.REASON_LARGE}'
  ELSE '{config.REASON_VALID}' END"""


view("reasons", ["payloads"], f"""
SELECT frame_id, camera_id, epoch_id, doc_id, {validate_sql('frame_b64')} AS reason FROM payloads""")

_SENT_CASE = " ".join(f"WHEN {k} THEN '{v}'" for k, v in _SENT.items())
view("results", ["verdicts", "reasons", "payloads"], f"""
SELECT v.frame_id, v.epoch_id, v.camera_id, r.row_idx,
       CASE WHEN s.sentinel IS NOT NULL THEN s.sentinel
            WHEN NOT (v.w BETWEEN {config.MIN_SIDE} AND {config.MAX_SIDE} AND v.h BETWEEN {config.MIN_SIDE} AND {config.MAX_SIDE})
                 OR rs.reason <> '{config.REASON_VALID}' OR v.n_objects = 0 THEN ''
            WHEN v.violation THEN '{config.VIOLATION_PREFIX}' || p.frame_b64
            ELSE p.frame_b64 END AS result,
       v.violation
FROM verdicts v
JOIN reasons rs ON rs.frame_id = v.frame_id
JOIN payloads p ON p.frame_id = v.frame_id
JOIN (SELECT frame_id, CAST(row_number() OVER (PARTITION BY epoch_id ORDER BY frame_id) - 1 AS INTEGER) AS row_idx
      FROM frames) r ON r.frame_id = v.frame_id
CROSS JOIN LATERAL (SELECT CASE
      WHEN v.epoch_id % 40 = 33 AND r.row_idx >= 3 THEN 'BATCH_TIMEOUT'
      WHEN v.epoch_id % 40 = 37 AND r.row_idx >= 2 THEN 'MEMORY_CRITICAL'
      ELSE CASE v.epoch_id % 40 {_SENT_CASE} END END AS sentinel) s""")

view("statuses", ["results"], f"""
SELECT frame_id, epoch_id, camera_id, row_idx, result,
       CASE WHEN result IS NULL OR result = '' THEN 'EMPTY'
            WHEN result IN ({", ".join(f"'{x}'" for x in config.SENTINELS)}) THEN result
            WHEN starts_with(result, '{config.VIOLATION_PREFIX}') THEN 'VIOLATION'
            ELSE 'NORMAL' END AS status
FROM results""")

view("frame_log", ["frames", "payloads"], """
SELECT CAST(NULL AS BLOB) AS key, encode(p.frame_b64) AS value, 'frames' AS topic,
       CAST(f.camera_id % 4 AS INTEGER) AS partition,
       row_number() OVER (PARTITION BY f.camera_id % 4 ORDER BY f.captured_at, f.frame_id) - 1 AS "offset",
       f.captured_at AS "timestamp", 0 AS timestampType, f.frame_id
FROM frames f JOIN payloads p ON p.frame_id = f.frame_id""")


view("progress", [], """
SELECT event_id // 5 AS batch_id, count(*) AS num_input_rows, count(*) / 60.0 AS input_rows_per_second,
       CASE WHEN min_by(event_type, event_id) = 'error' THEN
         CASE (event_id // 5) % 4 WHEN 0 THEN 'java.lang.OutOfMemoryError: Java heap space'
              WHEN 1 THEN 'Arrow stream closed' WHEN 2 THEN 'Socket timeout' ELSE 'Topic not found' END
       END AS error
FROM events GROUP BY event_id // 5""")


def with_views(*names: str) -> str:
    """``WITH`` clause defining ``names`` and everything they depend on."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order) + "\n"
