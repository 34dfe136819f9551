"""Session job: two event feeds -> union -> validate -> panes, plus a quarantine sink."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillflow.operators.cleaning import quarantined_events, valid_events
from tillflow.operators.sessions import SESSION_GAP
from tillflow.schemas import EVENT, HEARTBEAT
from tillflow.sinks.streams import write_batches_idempotent, write_files, write_kafka
from tillflow.sources.streams import clock_heartbeats, heartbeat_times, read_event_feed, read_heartbeats, read_kafka_feed, read_kafka_messages, union_feeds
from tillflow.streaming.panes import BUCKETS, as_messages, mark_feed, session_panes_stream, with_rejects
from tillflow.streaming.sessions import closed_panes, closed_sessions, mark_feed_time


@dataclass
class SessionJob:
    panes: StreamingQuery
    quarantine: StreamingQuery

    def await_termination(self, timeout: float | None = None) -> None:
        """Waits until both queries have ended, or ``timeout`` seconds; raises as soon as
        either has failed, and stops the other then."""
        end = None if timeout is None else time.monotonic() + timeout
        queries = [self.panes, self.quarantine]
        while any(q.isActive for q in queries) and (end is None or time.monotonic() < end):
            for q in queries:
                if not q.isActive and q.exception() is not None:
                    self.stop()
                    raise q.exception()
            next(q for q in queries if q.isActive).awaitTermination(1)
        for q in queries:
            if q.exception() is not None:
                raise q.exception()

    def stop(self) -> None:
        self.panes.stop()
        self.quarantine.stop()


def start_session_job(
    spark: SparkSession,
    book_feed: str,
    grocery_feed: str,
    panes_path: str,
    quarantine_path: str,
    checkpoint: str,
    gap: str = SESSION_GAP,
    lateness: str = "0 seconds",
    early_panes: bool = True,
    per_event: bool = True,
    include_events: bool = False,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = 100,
    trigger: dict | None = None,
    session_time: str | None = None,
    engine: str = "group_state",
    schema=None,
    kafka: str | None = None,
    max_offsets_per_trigger: int | None = None,
    allowed_lateness: str = "0 seconds",
    late_rows: bool = False,
    heartbeats: str | None = None,
    idle_after: str | None = None,
    buckets: int | None = BUCKETS,
) -> SessionJob:
    """Start the two streaming queries and return their handles (does not wait).

    Both paths publish panes in one shape and the message form (window bounds as
    ISO text); ``early_panes=False`` writes only closed ones, with Spark's own
    session window (cheaper; exact when no row arrives late). Each feed carries its
    own watermark and the slower one holds the job's, so a feed that lags behind
    loses nothing. ``max_files_per_trigger`` (or ``max_offsets_per_trigger``) bounds
    every micro-batch, and so what one user can bring to one task at once.
    ``session_time`` names a message-time column (timestamp) that places events in
    sessions while the payload's event time orders and names them, as in the
    reference; by default both are the event time. ``schema`` is the feed schema
    (default: the event schema). With ``kafka`` (bootstrap servers; needs Spark's
    Kafka connector) the feeds and ``panes_path`` are topics; ``session_time`` may
    then be "message_time".

    A feed without traffic holds all sessions open. ``heartbeats`` names a folder (with
    ``kafka``: a topic) of (feed, event_time) rows, feed "books" or "groceries", up to which the
    feed is complete; or ``idle_after`` lets a feed that has been silent for this long follow the
    clock. ``allowed_lateness`` keeps closed sessions for corrected panes (column ``timing``). With
    ``late_rows`` late events go to the quarantine with the reason "late", and one query writes both:
    below ``panes_path``, read back with ``read_output`` as "panes" and "quarantine"
    (``quarantine_path`` is not used, and each feed is read by one query only). ``buckets``: state
    keys of the panes (``session_panes_stream``), fixed for the life of ``checkpoint``.
    """
    if not early_panes and (late_rows or allowed_lateness != "0 seconds"):
        raise ValueError("late rows and allowed lateness need the stateful panes (early_panes)")
    if kafka and late_rows:
        raise ValueError("late rows are written to files, not topics")
    if heartbeats and idle_after:
        raise ValueError("give heartbeats or idle_after, not both")

    def feed(source: str):
        if kafka:
            return read_kafka_feed(spark, kafka, source, max_offsets_per_trigger)
        return read_event_feed(spark, source, fmt, max_files_per_trigger, schema=schema or EVENT)

    feeds = (book_feed, grocery_feed)
    time_col = session_time or "ts"
    mark = mark_feed if early_panes else mark_feed_time

    def beats(name: str):
        if idle_after:
            return clock_heartbeats(spark, idle_after)
        if heartbeats and kafka:
            return heartbeat_times(read_kafka_messages(spark, kafka, heartbeats, HEARTBEAT), name)
        return read_heartbeats(spark, heartbeats, name, fmt, max_files_per_trigger) if heartbeats else None

    names = ("books", "groceries")
    raw = [feed(f) for f in feeds]
    valid = union_feeds(*[mark(valid_events(f, session_time), gap, lateness, time_col, beats(name)) for name, f in zip(names, raw)])
    rejected = quarantined_events(union_feeds(*raw), session_time)
    if early_panes:
        out = session_panes_stream(valid, gap, lateness, per_event, include_events, time_col=time_col, engine=engine, order_col="ts",
                                   marked=True, allowed_lateness=allowed_lateness, late_rows=late_rows, buckets=buckets)
    else:
        out = closed_panes(closed_sessions(valid, gap, lateness, time_col=time_col, order_col="ts", marked=True))
    if late_rows:
        both = with_rejects(as_messages(out), rejected)
        query = write_batches_idempotent(both, panes_path, f"{checkpoint}/panes", trigger=trigger, partition_by=("kind",))
        return SessionJob(query, query)
    if kafka:
        panes = write_kafka(as_messages(out), kafka, panes_path, f"{checkpoint}/panes", trigger=trigger)
    else:
        panes = write_files(as_messages(out), panes_path, f"{checkpoint}/panes", trigger=trigger)
    quarantine = write_files(rejected, quarantine_path, f"{checkpoint}/quarantine", trigger=trigger)
    return SessionJob(panes, quarantine)


def main(argv: list[str] | None = None) -> None:
    """``python -m tillflow.plans.session_job --books P1 --groceries P2 --panes P3 --quarantine P4 --checkpoint P5``"""
    import argparse

    from tillflow.runtime import build_session

    ap = argparse.ArgumentParser(description="Sessionise two event feeds into open and closed panes.")
    ap.add_argument("--books", required=True, help="books feed folder")
    ap.add_argument("--groceries", required=True, help="groceries feed folder")
    ap.add_argument("--panes", required=True, help="output folder for panes")
    ap.add_argument("--quarantine", required=True, help="output folder for rejected events")
    ap.add_argument("--checkpoint", required=True, help="checkpoint folder (shared storage)")
    ap.add_argument("--format", default="parquet", choices=["parquet", "json"])
    ap.add_argument("--gap", default=SESSION_GAP)
    ap.add_argument("--lateness", default="0 seconds")
    ap.add_argument("--include-events", action="store_true")
    ap.add_argument("--closed-only", action="store_true", help="only closed sessions (Spark's session window)")
    ap.add_argument("--trigger", default="availableNow", help="'availableNow' or a processing-time interval")
    ap.add_argument("--engine", default="group_state", choices=["group_state", "transform_with_state"])
    ap.add_argument("--session-time", default=None, help="message-time column that places events in sessions")
    ap.add_argument("--per-session", action="store_true", help="one open pane per touched session and batch, not per event")
    ap.add_argument("--max-files", type=int, default=100, help="files of each feed in a micro-batch")
    ap.add_argument("--kafka", default=None, help="bootstrap servers; the feeds and --panes are then topics")
    ap.add_argument("--allowed-lateness", default="0 seconds", help="keep closed sessions this long for corrected panes")
    ap.add_argument("--late-rows", action="store_true", help="late events to the quarantine, both outputs below --panes")
    ap.add_argument("--heartbeats", default=None, help="folder or topic of (feed, event_time) rows")
    ap.add_argument("--idle-after", default=None, help="a feed silent this long follows the clock")
    ap.add_argument("--max-offsets", type=int, default=None, help="messages of each topic in a micro-batch")
    args = ap.parse_args(argv)
    schema = EVENT
    if args.session_time and not args.kafka:
        schema = T.StructType([*EVENT, T.StructField(args.session_time, T.TimestampType())])
    trigger = {"availableNow": True} if args.trigger == "availableNow" else {"processingTime": args.trigger}
    spark = build_session()
    job = start_session_job(spark, args.books, args.groceries, args.panes, args.quarantine, args.checkpoint,
                            gap=args.gap, lateness=args.lateness, early_panes=not args.closed_only,
                            include_events=args.include_events, fmt=args.format, trigger=trigger,
                            engine=args.engine, session_time=args.session_time, per_event=not args.per_session,
                            max_files_per_trigger=args.max_files, schema=schema, kafka=args.kafka,
                            max_offsets_per_trigger=args.max_offsets, allowed_lateness=args.allowed_lateness,
                            late_rows=args.late_rows, heartbeats=args.heartbeats, idle_after=args.idle_after)
    job.await_termination()


if __name__ == "__main__":
    main()
