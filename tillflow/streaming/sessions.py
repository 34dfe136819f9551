"""Closed sessions on a stream with Spark's own ``session_window`` (the fast path).

Append mode: one row per session, written once the watermark passes the
session's end. State and merging are Spark's; with
``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` set,
sessions are pre-merged in each input partition before the shuffle, so a hot
user sends its merged sessions, not its rows.

Watermark: on the event time with delay ``gap + lateness``. Spark drops a row
whose time is at or below the watermark, i.e. with ``ts + gap <= max_ts -
lateness``: the rows whose own window is already behind the event-time
progress, which is the late rule of the reference job (applied one micro-batch
late, see below). A session is written when ``end <= watermark``, one gap after
the newest event could still have reached it.

Boundary: ``session_window`` merges windows that only touch, so it is asked for
``gap - 1 µs`` and the microsecond is added back to the end; events exactly one
gap apart then start a new session, events closer than that share one.

Known differences from :mod:`tillflow.streaming.panes` (the exact path), both
tested:

* Late rows: Spark's stateful operators filter late input with the previous
  micro-batch's watermark and evict with the current one. In the first batch
  after the watermark moves, a late row can still join a session and stretch
  it (a session [00:01, 00:15) becomes [00:01, 00:22) with a row at 00:12 once
  the watermark is at 00:40). The exact path checks lateness itself against the
  current watermark and drops it, as the reference does.
* Closing: this path closes a session one gap later, so a row that is not late
  but comes after the exact path closed its session still joins it here; the
  exact path, like the reference whose closed window state is gone, starts a
  new session.

With in-order input the two agree. No early (open) panes are produced here;
use the exact path for those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tillflow.functions.time import micros, window_max_timestamp
from tillflow.operators.sessions import SESSION_GAP, gap_micros
from tillflow.schemas import EVENT
from tillflow.streaming.panes import with_heartbeats, without_heartbeats

LOCAL_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def mark_feed_time(events: DataFrame, gap: str | int = SESSION_GAP, lateness: str | int = "0 seconds", time_col: str = "ts",
                   heartbeats: DataFrame | None = None) -> DataFrame:
    """One feed with its own watermark, for the union given to ``closed_sessions(..., marked=True)``:
    the slowest feed then holds the watermark. ``heartbeats`` (instants ``ts``) move it when the feed is silent."""
    feed = events if heartbeats is None else with_heartbeats(events, heartbeats, time_col)
    marked = feed.withWatermark(time_col, f"{gap_micros(gap) + gap_micros(lateness)} microseconds")
    return marked if heartbeats is None else without_heartbeats(marked, micros(F.col(time_col)))


def closed_panes(sessions: DataFrame) -> DataFrame:
    """Closed sessions in the shape of the exact path's panes: window_end is the last
    instant (end - 1 ms), the total is narrowed to float; ``events`` is null."""
    return sessions.select(
        "window_id", "user_id", "window_start", window_max_timestamp("window_end").alias("window_end"),
        F.col("total_price").cast("float").alias("total_price"), F.lit(False).alias("window_open"), "event_count",
        F.lit(None).cast(T.ArrayType(EVENT)).alias("events"),
    )


def closed_sessions(
    events: DataFrame,
    gap: str | int = SESSION_GAP,
    lateness: str | int = "0 seconds",
    key: str = "user_id",
    time_col: str = "ts",
    id_col: str = "event_id",
    price_col: str = "price",
    order_col: str | None = None,
    marked: bool = False,
) -> DataFrame:
    """Sessions of a streaming frame of valid events with an instant ``time_col``.

    It also runs on a batch frame, but there Spark's session window puts each
    user in one task; for batches use :func:`tillflow.operators.sessions.sessions`.

    Columns: user_id, window_id, window_start, window_end (exclusive), last_event_time,
    total_price (double), event_count. ``time_col`` places events in sessions;
    ``order_col`` (default: the same) names them and gives window_start and
    last_event_time, as the message time and the payload's event time do in the
    reference. ``marked``: the events come from feeds marked with ``mark_feed_time``.
    """
    order = F.col(order_col or time_col)
    spark = events.sparkSession
    if spark.conf.get(LOCAL_MERGE, "false") != "true":
        spark.conf.set(LOCAL_MERGE, "true")  # pre-merge sessions before the shuffle
    gap_us = gap_micros(gap)
    watched = events if marked else mark_feed_time(events, gap, lateness, time_col)
    window = F.session_window(F.col(time_col), f"{gap_us - 1} microseconds")
    agg = watched.groupBy(F.col(key), window.alias("session")).agg(
        F.min(F.struct(order.alias("o"), F.col(id_col).alias("id"))).alias("head"),
        F.max(order).alias("last_event_time"),
        F.sum(F.col(price_col).cast("double")).alias("total_price"),
        F.count(F.lit(1)).alias("event_count"),
    )
    return agg.select(
        F.col(key).alias("user_id"),
        F.col("head.id").alias("window_id"),
        F.col("head.o").alias("window_start"),
        (F.col("session.end") + F.expr("INTERVAL 1 MICROSECOND")).alias("window_end"),
        "last_event_time",
        "total_price",
        "event_count",
    )
