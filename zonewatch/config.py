"""Fixed values of the frame-analytics model.

Everything in this module is a constant that must equal the behaviour being
reproduced (thresholds, the stop-zone polygon, the result vocabulary).  They
are grouped here so that operators never hard-code them.
"""

from __future__ import annotations

# --- fixed values: stop-zone polygon in the 640x640 reference space --------
# (x, y) vertices in drawing order.
ZONE_640 = [
    (0.0, 522.642),
    (107.5, 578.182),
    (367.458, 446.087),
    (0.0, 332.872),
]
REF_SIZE = 640  # side of the reference space the zone is drawn in

# --- fixed values: detector post-processing parameters ---------------------
CONF_THRESHOLD = 0.25
IOU_THRESHOLD = 0.45
MAX_DET = 50

# --- fixed values: frame gates ---------------------------------------------
MIN_SIDE = 32
MAX_SIDE = 2048
DOWNSCALE_WIDTH = 640  # frames wider than this are scaled to this width

# --- fixed values: bottom-edge sampling rule --------------------------------
NUM_SAMPLE_STEPS = 10  # 11 points i = 0..10; a box is "in" when hits > 5

# --- fixed values: label vocabulary -----------------------------------------
VEHICLE_LABELS = ["car", "motorbike"]
RED_LIGHT_LABEL = "red_light"
CLASS_LABELS = ["car", "motorbike", "person", "red_light", "stop_line"]

# --- fixed values: result string grammar ------------------------------------
VIOLATION_PREFIX = "[VIOLATION]|"
PASSTHROUGH = "PASSTHROUGH - UDF DISABLED"
SENTINELS = [
    "PASSTHROUGH - UDF DISABLED",
    "CIRCUIT_BREAKER_OPEN",
    "INSUFFICIENT_MEMORY",
    "MODEL_UNAVAILABLE",
    "BATCH_TIMEOUT",
    "MEMORY_CRITICAL",
    "BATCH_ERROR_LIMIT",
    "UDF_CRITICAL_ERROR",
]
# Codes the evidence saver skips (besides the empty string).  The remaining
# sentinels are handed to the decoder and fail there.
SKIPPED_RESULTS = ["", "PASSTHROUGH - UDF DISABLED", "MODEL_UNAVAILABLE",
                   "CIRCUIT_BREAKER_OPEN"]
# Sentinels that stand for a failed (not merely skipped) batch row.
ERROR_STATUSES = ["CIRCUIT_BREAKER_OPEN", "INSUFFICIENT_MEMORY",
                  "MODEL_UNAVAILABLE", "BATCH_TIMEOUT", "MEMORY_CRITICAL",
                  "BATCH_ERROR_LIMIT", "UDF_CRITICAL_ERROR", "ROW_ERROR"]

# --- fixed values: base64 input gate -----------------------------------------
BASE64_GATE_PATTERN = "^[A-Za-z0-9+/]*={0,2}$"

# --- fixed values: payload validation cascade ---------------------------------
MIN_B64_CHARS = 100
MAX_B64_CHARS = 10_000_000
MIN_DECODED_BYTES = 1000
MAX_DECODED_BYTES = 50_000_000
REASON_EMPTY = "Empty or null input"
REASON_SHORT = "String too short to be valid image"
REASON_LONG = "String too large (>10MB)"
REASON_CHARS = "Invalid base64 characters"
REASON_DECODE = "Base64 decode error"
REASON_SMALL = "Decoded data too small"
REASON_LARGE = "Decoded data too large (>50MB)"
REASON_VALID = "Valid"

# --- fixed values: batch health rules -----------------------------------------
LOW_SUCCESS_RATE = 0.1
ERROR_RATIO_LIMIT = 0.8
BREAKER_THRESHOLD = 5
BREAKER_RESET_SECONDS = 300
MAX_CONSECUTIVE_ERRORS = 3
BATCH_TIME_BUDGET_SECONDS = 300

# --- fixed values: error text classification ------------------------------------
RESOURCE_ERROR_MARKERS = ["outofmemoryerror", "connection abort", "socket", "arrow"]
DISABLE_UDF_MARKERS = ["arrow", "socket"]

# --- fixed values: alert message ------------------------------------------------
ALERT_CHANNEL = "#traffic_violation_notification"
ALERT_USERNAME = "Traffic Violation Bot"
ALERT_ICON = ":warning:"
ALERT_MESSAGE = "🚨 Traffic Violation: "
ALERT_FILE_LINE = "\n📁 File: "

# --- fixed values: stream source defaults ----------------------------------------
FRAME_TOPIC = "traffic_frames"
MAX_OFFSETS_PER_TRIGGER = 5
TRIGGER_INTERVAL = "60 seconds"
PROGRESS_INTERVAL_SECONDS = 30
