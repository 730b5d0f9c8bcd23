"""All registered queries (importing the modules fills the registry)."""

from zonewatch.plans import q_frames  # noqa: F401
from zonewatch.plans.registry import QUERIES  # noqa: F401
from zonewatch.plans import q_payload  # noqa: F401,E402
from zonewatch.plans import q_metrics  # noqa: F401,E402
from zonewatch.plans import q_detect  # noqa: F401,E402
from zonewatch.plans import q_stream  # noqa: F401,E402
