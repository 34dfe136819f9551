"""tillflow: weekly sales totals and user sessions as Spark DataFrame jobs.

Batch: scan sales tables for a time range, drop incomplete rows, total each
user's spending across the tables with a full outer join, append the result to
an existing table.

Stream: union event feeds, quarantine invalid events with a reason, group each
user's events into gap-based sessions, and publish an open pane as events arrive
and a closed pane when the watermark passes the end of the session.
"""

__version__ = "0.1.0"

from tillflow.operators import (  # noqa: E402,F401
    quarantined_events,
    running_totals,
    session_event_rows,
    session_panes,
    sessions,
    side_totals,
    valid_events,
    valid_sales,
    weekly_sales,
    weekly_sales_union,
)
from tillflow.plans import run_weekly_job, start_session_job  # noqa: E402,F401
from tillflow.runtime import build_session  # noqa: E402,F401
from tillflow.streaming import as_messages, closed_sessions, session_panes_stream  # noqa: E402,F401
