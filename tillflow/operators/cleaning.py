"""Row validation: sale rows (batch) and events (feeds), with a quarantine output."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillflow.functions.checks import REASON_BAD_MESSAGE, REASON_NO_SESSION_TIME, event_reject_reason
from tillflow.functions.time import parse_iso


def valid_sales(rows: DataFrame, user_col: str = "user_id", price_col: str = "price") -> DataFrame:
    """Sale rows keyed by user: rows with a null user or a null price are dropped.

    Unlike the feed rule, an empty user id and a price <= 0 are kept.
    """
    return rows.where(F.col(user_col).isNotNull() & F.col(price_col).isNotNull()).select(
        F.col(user_col).alias("user_id"), F.col(price_col).alias("price")
    )


def validate_events(events: DataFrame, time_col: str = "event_time", session_time: str | None = None) -> DataFrame:
    """Every event with its parsed time ``ts`` and ``reason`` (null when valid).

    Messages kept by ``decode_events(..., keep_payload=True)`` that could not be decoded
    are "bad message"; with ``session_time`` (a message-time column) an event without
    one is "no session time". One pass, no shuffle; split it with
    :func:`valid_events` / :func:`quarantined_events` or write both from one ``foreachBatch``.
    """
    ts = parse_iso(F.col(time_col))
    reason = event_reject_reason(F.col("user_id"), F.col(time_col), F.col("price"), F.col("ts"))
    if session_time:
        reason = F.coalesce(reason, F.when(F.col(session_time).isNull(), F.lit(REASON_NO_SESSION_TIME)))
    if "bad_payload" in events.columns:
        reason = F.when(F.col("bad_payload").isNotNull(), F.lit(REASON_BAD_MESSAGE)).otherwise(reason)
    return events.withColumn("ts", ts).withColumn("reason", reason)


def valid_events(events: DataFrame, session_time: str | None = None) -> DataFrame:
    """Events that pass every rule, unchanged, with their parsed time ``ts``."""
    checked = validate_events(events, session_time=session_time)
    return checked.where(F.col("reason").isNull()).drop("reason", "bad_payload")


def quarantined_events(events: DataFrame, session_time: str | None = None) -> DataFrame:
    """Events that fail a rule, unchanged (with the payload of those that could not be
    decoded, where it was kept), with the first failing rule as ``reason``."""
    checked = validate_events(events, session_time=session_time)
    return checked.where(F.col("reason").isNotNull()).drop("ts")
