"""Column expressions shared by the operators (all built-in, JVM side)."""

from tillflow.functions.time import (  # noqa: F401
    as_time_literal,
    instant_to_ntz,
    iso_millis,
    micros,
    ntz_to_instant,
    parse_iso,
    week_bounds,
    window_max_timestamp,
)
from tillflow.functions.checks import (  # noqa: F401
    REASON_BAD_TIME,
    REASON_NO_PRICE,
    REASON_NO_TIME,
    REASON_NO_USER,
    event_reject_reason,
    is_blank,
)
