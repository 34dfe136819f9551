"""Validity rules for sale rows and events."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Quarantine reasons, in the order the rules are checked.
REASON_NO_USER = "no user id"
REASON_NO_TIME = "no event time"
REASON_NO_PRICE = "no price"
REASON_BAD_TIME = "bad event time"
REASON_BAD_MESSAGE = "bad message"
REASON_NO_SESSION_TIME = "no session time"
REASON_LATE = "late"


def is_blank(col: Column) -> Column:
    """Empty text. A missing field reads as "" on the feeds, so null counts as empty too."""
    return col.isNull() | (col == F.lit(""))


def event_reject_reason(user: Column, event_time: Column, price: Column, ts: Column) -> Column:
    """Why an event is rejected, or null when it is valid.

    Checked in order: user id, event time, price, then the time text itself.
    ``price <= 0`` rejects (a missing price reads as 0); NaN is kept, as NaN <= 0
    is false. The text is tested exactly, without trimming.
    """
    return (
        F.when(is_blank(user), F.lit(REASON_NO_USER))
        .when(is_blank(event_time), F.lit(REASON_NO_TIME))
        .when(price.isNull() | (price <= F.lit(0.0)), F.lit(REASON_NO_PRICE))
        .when(ts.isNull(), F.lit(REASON_BAD_TIME))
    )
