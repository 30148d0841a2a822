"""Column-level helpers (all built-in Spark expressions, no Python UDFs)."""

from tidepool.functions.timecols import (  # noqa: F401
    MICROS, day_in_zone, epoch_us, floor_div, ms_of, ntz_of, pane_end, parse_duration_us,
    timestamp_text, with_event_time,
)
from tidepool.functions.text import ranking_text  # noqa: F401
from tidepool.functions.hashing import poly_hash  # noqa: F401
