"""Frame payload and result-string expressions.

The payload is base64 text of an encoded image.  Validation follows the
decoder's non-strict rules exactly but never decodes: the decoded length is
derived from the count of base64 data characters, so a 10 MB frame costs two
regex scans instead of a decode and a copy.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewatch import config

# written out: Java's regex looks single characters up in a table, ranges one by one
_DATA = string.ascii_letters + string.digits + "+/"
_GATE = config.BASE64_GATE_PATTERN.replace("A-Za-z0-9+/", _DATA)
_CLEAN = f"^[{_DATA}]*=*\\z"  # \z: a final line break is not data


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often ``body`` names it."""
    return F.transform(F.array(_c(value)), body)[0]


def once(df: DataFrame, name: str, value) -> DataFrame:
    """``df`` with the column ``name``, computed once a row: it comes out of a one-row
    generator, so that filters on it are not pushed below and do not compute it again."""
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(_c(value))).alias(name))


# ---------------------------------------------------------------- B1-B5 gate
def cast_value(value) -> Column:
    """B1: ``CAST(value AS STRING)``."""
    return _c(value).cast("string")


def base64_gate(s) -> Column:
    """The pattern gate ``^[A-Za-z0-9+/]*={0,2}$`` (Java ``$`` semantics)."""
    return _c(s).rlike(_GATE)


def input_gate(s) -> Column:
    """B2 and B3 and B4 as one predicate (NULL-safe: NULL -> false), which names
    ``s`` once: the pattern gate behind a look for any character."""
    return F.coalesce(_c(s).rlike(r"^(?=[\s\S])" + _GATE.removeprefix("^")), F.lit(False))


def reject_reason(s) -> Column:
    """Why the input gate drops a row (NULL when it is kept)."""
    s = _c(s)
    return (F.when(s.isNull(), F.lit("null"))
            .when(s == "", F.lit("empty"))
            .when(~base64_gate(s), F.lit("not_base64")))


# ------------------------------------------------------------ C1/C2 base64
def b64_encode(b) -> Column:
    """base64 text without line breaks (Spark may wrap every 76 chars)."""
    return F.replace(F.base64(_c(b)), F.lit("\r\n"), F.lit(""))


def _data_chars(s) -> Column:
    """Characters before the first '='."""
    return (F.instr(F.concat(s, F.lit("=")), "=") - 1).cast("long")


def _ends(d, pads) -> Column:
    """Whether ``pads`` '=' after ``d`` data characters complete a quad and so end the input."""
    return ((d % 4 == 2) & (pads >= 2)) | ((d % 4 == 3) & (pads >= 1))


def _clean_decode(s) -> Column:
    """The decode rule (ok, d) for the common case, a string of data characters then
    '=' padding (checked by one anchored scan): no regex replace needed."""
    return let(_data_chars(s), lambda d: let(F.length(s).cast("long") - d, lambda pads: F.struct(
        ((d % 4 == 0) | _ends(d, pads)).alias("ok"), d.alias("d"))))


def _decode_plan(s) -> Column:
    """The non-strict decode rule as a struct (ok, d, s2), every step computed once.

    ``d`` is the number of base64 data characters the decoder consumes before it
    stops, ``ok`` says the input decodes, ``s2`` is the input without what the decoder
    discards.  Rule: non-alphabet characters are discarded; '=' is ignored until two data
    characters of a quad are seen; a run of '=' completing the quad ends the
    input; otherwise the data characters must fill whole quads.  Non-ASCII
    characters are an error.
    """
    def step(acc, seg):
        def add(data):
            pads = F.length(seg).cast("long") - data
            return let(acc["d"] + data, lambda d: F.struct(d.alias("d"), _ends(d, pads).alias("done")))
        return F.when(acc["done"], acc).otherwise(let(_data_chars(seg), add))

    def general(s2):  # fold over (data run, '=' run) segments
        init = F.struct(F.lit(0).cast("long").alias("d"), F.lit(False).alias("done"))
        folded = F.aggregate(F.regexp_extract_all(s2, F.lit(f"[{_DATA}]+=*"), F.lit(0)), init, step)
        return let(folded, lambda f: F.struct((f["done"] | (f["d"] % 4 == 0)).alias("ok"), f["d"].alias("d")))

    def discard(s):
        ascii_only = F.octet_length(s) == F.length(s)
        # characters outside the alphabet (CR/LF, '-', '_', ...) are discarded
        return let(F.regexp_replace(s, f"[^{_DATA}=]", ""), lambda s2: let(
            F.when(s2.rlike(_CLEAN), _clean_decode(s2)).otherwise(general(s2)),
            lambda r: F.struct((ascii_only & r["ok"]).alias("ok"), r["d"].alias("d"), s2.alias("s2"))))

    return let(s, lambda s: F.when(s.rlike(_CLEAN), let(_clean_decode(s), lambda r: F.struct(
        r["ok"].alias("ok"), r["d"].alias("d"), s.alias("s2")))).otherwise(discard(s)))


def _decoded(r) -> Column:
    return F.when(r["ok"], ((r["d"] * 3) - (r["d"] * 3) % 4) / 4).cast("long")


def decoded_length(s) -> Column:
    """Length in bytes the non-strict decoder returns; NULL when it fails."""
    return let(_decode_plan(s), _decoded)


def b64_decode(s) -> Column:
    """Safe decode with the non-strict rule; NULL where decoding fails."""
    def decode(r):
        data = F.substring(F.replace(r["s2"], F.lit("="), F.lit("")), F.lit(1), r["d"].cast("int"))
        npad = (F.lit(4) - r["d"] % 4) % 4
        padded = F.concat(data, F.when(npad == 2, F.lit("==")).when(npad == 1, F.lit("=")).otherwise(F.lit("")))
        return F.when(r["ok"], F.try_to_binary(padded, F.lit("base64")))
    return let(_decode_plan(s), decode)


# --------------------------------------------------------- C3 validation
def validate_payload(s) -> Column:
    """Reason text of the first failing check, or ``Valid``.

    Clean strings (``[A-Za-z0-9+/]*=*``, i.e. every real payload) take a fast
    path: the character check reduces to "has a letter or digit" and the
    decoded length is arithmetic on the count of data characters.  Anything
    else takes the general rule (Unicode letter/digit check, non-strict
    decode with discarded characters)."""
    def tail(alnum, length):
        return F.when(~alnum, F.lit(config.REASON_CHARS)).otherwise(let(
            length, lambda n: F.when(n.isNull(), F.lit(config.REASON_DECODE))
                               .when(n < config.MIN_DECODED_BYTES, F.lit(config.REASON_SMALL))
                               .when(n > config.MAX_DECODED_BYTES, F.lit(config.REASON_LARGE))
                               .otherwise(F.lit(config.REASON_VALID))))

    def check(s):
        stripped = F.regexp_replace(s, "[+/=\r\n]", "")
        return (F.when(s.isNull() | (s == ""), F.lit(config.REASON_EMPTY))
                .otherwise(let(F.length(s), lambda n: F.when(n < config.MIN_B64_CHARS, F.lit(config.REASON_SHORT))
                               .when(n > config.MAX_B64_CHARS, F.lit(config.REASON_LONG))
                               .when(s.rlike(_CLEAN), tail(s.rlike("[A-Za-z0-9]"), let(_clean_decode(s), _decoded)))
                               .otherwise(tail(stripped.rlike("^[\\p{L}\\p{N}]+\\z"), decoded_length(s))))))

    return let(s, check)


# ---------------------------------------------------- C5/C6 result codec
def encode_result(violation, payload) -> Column:
    """``[VIOLATION]|`` + payload when the frame violates."""
    return F.concat(F.when(_c(violation), F.lit(config.VIOLATION_PREFIX)).otherwise(F.lit("")),
                    _c(payload))


def parse_result(result):
    """(violation, payload, output dir) of a result string."""
    r = _c(result)
    violation = r.startswith(config.VIOLATION_PREFIX)
    payload = F.replace(r, F.lit(config.VIOLATION_PREFIX), F.lit(""))
    out_dir = F.when(violation, F.lit("output_violation")).otherwise(F.lit("output_processed"))
    return violation, payload, out_dir


# fixed values: the whitespace set of Python's str.strip()
PY_WHITESPACE = ("\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x85\\xA0\\u1680\\u2000-\\u200A"
                 "\\u2028\\u2029\\u202F\\u205F\\u3000")


def nonblank(result) -> Column:
    """``result and result.strip()`` - something besides whitespace."""
    r = _c(result)
    return F.coalesce(r.rlike(f"[^{PY_WHITESPACE}]"), F.lit(False))


def skipped(result) -> Column:
    """Results the evidence saver skips."""
    _, payload, _ = parse_result(result)
    return F.coalesce(payload.isin(*config.SKIPPED_RESULTS), F.lit(True))


def status_decode(result) -> Column:
    """One status per result string."""
    r = _c(result)
    return (F.when(r.isNull() | (r == ""), F.lit("EMPTY"))
            .when(r.isin(*config.SENTINELS), r)
            .when(r.startswith(config.VIOLATION_PREFIX), F.lit("VIOLATION"))
            .otherwise(F.lit("NORMAL")))
