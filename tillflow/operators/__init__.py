"""Batch and stream operators, each a function of DataFrames."""

from tillflow.operators.cleaning import (  # noqa: F401
    quarantined_events,
    validate_events,
    valid_events,
    valid_sales,
)
from tillflow.operators.weekly import side_totals, weekly_sales, weekly_sales_union  # noqa: F401
from tillflow.operators.sessions import (  # noqa: F401
    running_totals,
    session_event_rows,
    session_panes,
    sessions,
)
