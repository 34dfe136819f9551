"""The job's operators run over the driver's test tables, one callable per check.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Results are shaped for comparison with the SQL in
:mod:`tillflow.plans.oracle`: times as UTC wall clock (``timestamp_ntz``) and
money rounded to cents (sums of doubles differ in the last bits by order).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tillflow.functions.time import instant_to_ntz, week_bounds
from tillflow.operators.cleaning import quarantined_events, valid_events, valid_sales
from tillflow.operators.sessions import running_totals, session_event_rows, session_panes, sessions
from tillflow.operators.weekly import side_totals, weekly_sales, weekly_sales_union
from tillflow.runtime import checkpoint_root, scratch_path, ship_package
from tillflow.schemas import WEEKLY_SALES
from tillflow.sinks.streams import read_output, write_batches_idempotent, write_files
from tillflow.sources import testdata as td
from tillflow.plans.weekly_job import run_weekly_job
from tillflow.sources.streams import decode_events, heartbeat_times, read_event_feed, union_feeds
from tillflow.sources.tables import range_scan
from tillflow.streaming.panes import as_messages, events_of_closed_panes, mark_feed, session_panes_stream, with_rejects
from tillflow.streaming.sessions import closed_panes, closed_sessions

# Gaps of the session checks. The reference job's gap is 10
# minutes; at that gap nearly every test event is its own session, so 24 hours
# is checked as well to exercise merging.
GAP = "10 minutes"
LONG_GAP = "24 hours"
ALLOWED_LATENESS = "48 hours"
#: Least number of time slices of a replay; rows of a slice, and of a file of it, when there are more.
REPLAY_SLICES, REPLAY_ROWS, REPLAY_FILE_ROWS = 4, 20_000_000, 1_000_000


def _ready(spark: SparkSession) -> None:
    checkpoint_root(spark)
    ship_package(spark)


def _shape(df: DataFrame, money: tuple[str, ...] = ()) -> DataFrame:
    """Instants as UTC wall clock; money columns as doubles rounded to cents."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = instant_to_ntz(c)
        elif f.name in money:
            c = F.round(c.cast("double"), 2)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return td.load(spark, sf_dir, "events")


def _feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return union_feeds(td.book_feed(ev), td.grocery_feed(ev))


def _week():
    return week_bounds(td.EVENTS_WEEK_AS_OF)


# -- batch: sales ---------------------------------------------------------

def sales_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    start, end = _week()
    books = td.sales_table(_events(spark, sf_dir), td.BOOKS_EVENT_TYPE)
    return range_scan(books, start, end, "date_time", ("user_id", "price"))


def valid_sales_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return valid_sales(td.raw_sale_rows(_events(spark, sf_dir)))


def _week_side(events: DataFrame, event_type: str) -> DataFrame:
    start, end = _week()
    return valid_sales(range_scan(td.sales_table(events, event_type), start, end))


def book_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    side = _week_side(_events(spark, sf_dir), td.BOOKS_EVENT_TYPE)
    return _shape(side_totals(side, "total"), ("total",))


def grocery_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    side = _week_side(_events(spark, sf_dir), td.GROCERIES_EVENT_TYPE)
    return _shape(side_totals(side, "total"), ("total",))


def exact_book_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A week's totals bit by bit, not rounded."""
    _ready(spark)
    return side_totals(_week_side(_events(spark, sf_dir), td.BOOKS_EVENT_TYPE), "total")


def exact_session_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions' totals bit by bit, not rounded."""
    _ready(spark)
    return sessions(_valid(spark, sf_dir), LONG_GAP).select("user_id", "window_id", "total_price")


def weekly_sales_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    start, end = _week()
    ev = _events(spark, sf_dir)
    b, g = _week_side(ev, td.BOOKS_EVENT_TYPE), _week_side(ev, td.GROCERIES_EVENT_TYPE)
    return _shape(weekly_sales(b, g, start, end, T.TimestampNTZType()), ("TotalSalesInWeek",))


def weekly_sales_events_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    start, end = _week()
    ev = _events(spark, sf_dir)
    b, g = _week_side(ev, td.BOOKS_EVENT_TYPE), _week_side(ev, td.GROCERIES_EVENT_TYPE)
    return _shape(weekly_sales_union(b, g, start, end, T.TimestampNTZType()), ("TotalSalesInWeek",))


def weekly_sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    start, end = td.ORDERS_PERIOD
    orders = td.load(spark, sf_dir, "orders")
    b = valid_sales(range_scan(td.order_sales(orders, td.ORDERS_BOOKS_PRIORITY), start, end))
    g = valid_sales(range_scan(td.order_sales(orders, td.ORDERS_GROCERIES_PRIORITY), start, end))
    return _shape(weekly_sales(b, g, start, end, T.TimestampNTZType()), ("TotalSalesInWeek",))


def appended_weekly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole weekly job: two sales tables by name -> existing output table; read it back."""
    _ready(spark)
    location = scratch_path(spark, "weekly_table")
    suffix = os.path.basename(location)
    ev = _events(spark, sf_dir)
    books, groceries, table = f"books_{suffix}", f"groceries_{suffix}", f"tillflow_weekly_{suffix}"
    td.sales_table(ev, td.BOOKS_EVENT_TYPE).createOrReplaceTempView(books)
    td.sales_table(ev, td.GROCERIES_EVENT_TYPE).createOrReplaceTempView(groceries)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in WEEKLY_SALES)
    spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet LOCATION '{location}'")
    run_weekly_job(spark, books, groceries, table, as_of=td.EVENTS_WEEK_AS_OF)
    return _shape(spark.table(table), ("TotalSalesInWeek",))


# -- feeds: validation and union ------------------------------------------

def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return _shape(_feeds(spark, sf_dir), ("price",))


def valid_feed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return _shape(valid_events(_feeds(spark, sf_dir)), ("price",))


def quarantined_feed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return _shape(quarantined_events(_feeds(spark, sf_dir)), ("price",))


def decoded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed rows as JSON messages (as a message source would carry them), decoded and validated."""
    _ready(spark)
    feed = _feeds(spark, sf_dir)
    messages = feed.select(F.to_json(F.struct(*feed.columns)).alias("value"))
    return _shape(valid_events(decode_events(messages)), ("price",))


def quarantined_dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected events of a feed that also holds malformed event times."""
    _ready(spark)
    return _shape(quarantined_events(td.dirty_times(_feeds(spark, sf_dir))), ("price",))


def quarantined_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected messages, with the payload of those that can't be decoded."""
    _ready(spark)
    return _shape(quarantined_events(decode_events(td.messages(_feeds(spark, sf_dir)), keep_payload=True)), ("price",))


# -- batch sessions -------------------------------------------------------

def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_events(_feeds(spark, sf_dir))


def user_sessions(spark: SparkSession, sf_dir: str, gap: str = GAP) -> DataFrame:
    _ready(spark)
    return _shape(sessions(_valid(spark, sf_dir), gap), ("total_price",))


def user_sessions_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_sessions(spark, sf_dir, LONG_GAP)


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    rows = session_event_rows(_valid(spark, sf_dir), LONG_GAP, extra=("event_type",))
    return _shape(rows, ("price", "running_total"))


def running_session_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return _shape(running_totals(_valid(spark, sf_dir), LONG_GAP), ("total_price",))


def session_panes_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return _shape(session_panes(_valid(spark, sf_dir), LONG_GAP), ("total_price",))


def hot_user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions with a third of all rows on one user."""
    _ready(spark)
    return _shape(sessions(valid_events(td.hot_user(_feeds(spark, sf_dir))), GAP), ("total_price",))


def hot_user_session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    rows = session_event_rows(valid_events(td.hot_user(_feeds(spark, sf_dir))), LONG_GAP, extra=("event_type",))
    return _shape(rows, ("price", "running_total"))


# -- streams over the events file -----------------------------------------

def _feed_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two feeds as streams over the events file (one data batch each)."""
    path = f"{sf_dir}/events.parq*"
    raw_schema = td.EVENTS_SCHEMA
    books = td.book_feed(read_event_feed(spark, path, schema=raw_schema))
    groceries = td.grocery_feed(read_event_feed(spark, path, schema=raw_schema))
    return union_feeds(books, groceries)


def _run_to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    base = scratch_path(spark, name)
    q = write_files(stream, f"{base}/out", f"{base}/checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sessions from the append-mode stream (Spark's session window)."""
    _ready(spark)
    out = closed_sessions(valid_events(_feed_streams(spark, sf_dir)), GAP)
    return _shape(_run_to_table(spark, out, "streamed_sessions"), ("total_price",))


def streamed_pane_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panes as published: window bounds as ISO-8601 text with milliseconds and Z."""
    _ready(spark)
    out = as_messages(session_panes_stream(valid_events(_feed_streams(spark, sf_dir)), GAP, per_event=True))
    return _shape(_run_to_table(spark, out.drop("events"), "streamed_pane_messages"), ("total_price",))


def streamed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine side of the session job, run as a stream into the file sink."""
    _ready(spark)
    out = quarantined_events(_feed_streams(spark, sf_dir))
    return _shape(_run_to_table(spark, out, "streamed_quarantine"), ("price",))


def streamed_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open pane per event and closed panes from the stateful stream."""
    _ready(spark)
    out = session_panes_stream(valid_events(_feed_streams(spark, sf_dir)), GAP, per_event=True).drop("events")
    return _shape(_run_to_table(spark, out, "streamed_panes"), ("total_price",))


def _replay(spark: SparkSession, sf_dir: str, types: str, empty_first: int = 0, held: str | None = None) -> DataFrame:
    """The events for which ``types`` holds as a stream of time slices, one for each
    trigger, after ``empty_first`` slices without rows; those for which ``held`` holds come
    in a slice of their own after all others. Slices and the files of each
    follow the input's size; a file is one task's, and each slice has as many."""
    path = scratch_path(spark, "replay")
    events = td.load(spark, sf_dir, "events")
    lo, hi, rows = events.agg(F.min("ts"), F.max("ts"), F.count("*")).first()
    slices = max(REPLAY_SLICES, -(-rows // REPLAY_ROWS)) if rows else 1
    files = max(1, -(-rows // (slices * REPLAY_FILE_ROWS)))
    at = lambda k: F.lit(lo + (hi - lo) * k / slices).cast("timestamp_ntz")
    inside = lambda k: (F.col("ts") >= at(k)) & ((F.col("ts") < at(k + 1)) | F.lit(k == slices - 1)) if rows else F.lit(False)
    late = F.expr(held) if held else F.lit(False)
    parts = [F.lit(False)] * empty_first + [inside(k) & ~late for k in range(slices)] + ([late] if held else [])
    for written, part in enumerate(parts):
        events.where(F.expr(types) & part).repartition(files).write.mode("append").parquet(path)
        # tasks without rows write no file: empty ones keep the next slice out of this one's trigger
        for _ in range((written + 1) * files - len(spark.read.schema(td.EVENTS_SCHEMA).parquet(path).inputFiles())):
            events.limit(0).coalesce(1).write.mode("append").parquet(path)
    return read_event_feed(spark, path, max_files_per_trigger=files, schema=td.EVENTS_SCHEMA)


def streamed_panes_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open and closed panes over several micro-batches, with a gap that merges events."""
    _ready(spark)
    out = session_panes_stream(valid_events(td.feed_rows(_replay(spark, sf_dir, "true"))), LONG_GAP).drop("events")
    return _shape(_run_to_table(spark, out, "streamed_panes_24h"), ("total_price",))


def streamed_session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events array of the closed panes, with each event's place in it."""
    _ready(spark)
    stream = session_panes_stream(valid_events(td.feed_rows(_replay(spark, sf_dir, "true"))), LONG_GAP, per_event=False, include_events=True)
    closed = _run_to_table(spark, stream, "streamed_session_events").where(~F.col("window_open"))
    return _shape(closed.select("window_id", "user_id", F.posexplode("events").alias("place", "e")).select("window_id", "user_id", (F.col("place") + 1).alias("position"), "e.event_id", "e.event_time", "e.price", "e.event_type"), ("price",))


def streamed_event_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closed sessions' events, rebuilt from panes that carry each event once."""
    _ready(spark)
    stream = session_panes_stream(valid_events(td.feed_rows(_replay(spark, sf_dir, "true"))), LONG_GAP, per_event=False, event_deltas=True)
    rows = events_of_closed_panes(_run_to_table(spark, stream, "streamed_event_deltas"), LONG_GAP)
    return _shape(rows.select("window_id", "user_id", "position", "event_id", "event_time", "price", "event_type"), ("price",))


def streamed_panes_two_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed panes of two feeds, one of which lags a micro-batch behind: nothing is late."""
    _ready(spark)
    books = td.feed_rows(_replay(spark, sf_dir, f"event_type = '{td.BOOKS_EVENT_TYPE}'"))
    groceries = td.feed_rows(_replay(spark, sf_dir, f"event_type <> '{td.BOOKS_EVENT_TYPE}'", empty_first=1))
    valid = union_feeds(*[mark_feed(valid_events(feed), LONG_GAP) for feed in (books, groceries)])
    out = session_panes_stream(valid, LONG_GAP, per_event=False, marked=True).drop("events")
    return _shape(_run_to_table(spark, out, "streamed_two_feeds").where(~F.col("window_open")), ("total_price",))


def streamed_panes_idle_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed panes of a books feed beside a groceries feed that has heartbeats only."""
    _ready(spark)
    books = td.feed_rows(_replay(spark, sf_dir, f"event_type = '{td.BOOKS_EVENT_TYPE}'"))
    groceries = td.feed_rows(_replay(spark, sf_dir, "false"))
    beats = heartbeat_times(td.heartbeats(_replay(spark, sf_dir, f"event_type = '{td.NO_PAYLOAD_EVENT_TYPE}'")), "groceries")
    valid = union_feeds(mark_feed(valid_events(books), LONG_GAP), mark_feed(valid_events(groceries), LONG_GAP, heartbeats=beats))
    out = session_panes_stream(valid, LONG_GAP, per_event=False, marked=True).drop("events")
    return _shape(_run_to_table(spark, out, "streamed_idle_feed").where(~F.col("window_open")), ("total_price",))


def streamed_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine of one query that writes panes and quarantine together, over a replay
    that delivers a tenth of the events after all others: invalid and late events."""
    _ready(spark)
    feed = td.feed_rows(_replay(spark, sf_dir, "true", held=td.LATE_DELIVERY))
    panes = session_panes_stream(valid_events(feed), LONG_GAP, per_event=False, late_rows=True).drop("events")
    both = with_rejects(panes, quarantined_events(feed))
    base = scratch_path(spark, "streamed_late_events")
    q = write_batches_idempotent(both, f"{base}/out", f"{base}/checkpoint", partition_by=("kind",))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return _shape(read_output(spark, f"{base}/out", "quarantine", both), ("price",))


def streamed_panes_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed panes, and the corrected panes that events within the allowed lateness give, over the same replay."""
    _ready(spark)
    feed = td.feed_rows(_replay(spark, sf_dir, "true", held=td.LATE_DELIVERY))
    out = session_panes_stream(valid_events(feed), LONG_GAP, per_event=False, allowed_lateness=ALLOWED_LATENESS).drop("events")
    return _shape(_run_to_table(spark, out, "streamed_lateness").where("timing <> 'EARLY'"), ("total_price",))


def streamed_closed_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sessions of the fast path, in the shape of panes."""
    _ready(spark)
    out = closed_panes(closed_sessions(valid_events(_feed_streams(spark, sf_dir)), GAP)).drop("events")
    return _shape(_run_to_table(spark, out, "streamed_closed_panes"), ("total_price",))


QUERIES = {
    "sales_range_scan": sales_range_scan,
    "valid_sales": valid_sales_rows,
    "book_totals": book_totals,
    "grocery_totals": grocery_totals,
    "exact_book_totals": exact_book_totals,
    "exact_session_totals": exact_session_totals,
    "weekly_sales": weekly_sales_events,
    "weekly_sales_union": weekly_sales_events_union,
    "weekly_sales_orders": weekly_sales_orders,
    "appended_weekly_sales": appended_weekly_sales,
    "all_events": all_events,
    "valid_events": valid_feed_events,
    "quarantined_events": quarantined_feed_events,
    "decoded_events": decoded_events,
    "user_sessions": user_sessions,
    "user_sessions_24h": user_sessions_24h,
    "session_events": session_events,
    "running_session_totals": running_session_totals,
    "session_panes": session_panes_batch,
    "streamed_sessions": streamed_sessions,
    "streamed_quarantine": streamed_quarantine,
    "streamed_panes": streamed_panes,
    "streamed_pane_messages": streamed_pane_messages,
    "quarantined_dirty_events": quarantined_dirty_events,
    "quarantined_messages": quarantined_messages,
    "hot_user_sessions": hot_user_sessions,
    "hot_user_session_events": hot_user_session_events,
    "streamed_panes_24h": streamed_panes_24h,
    "streamed_session_events": streamed_session_events,
    "streamed_event_deltas": streamed_event_deltas,
    "streamed_panes_two_feeds": streamed_panes_two_feeds,
    "streamed_closed_panes": streamed_closed_panes,
    "streamed_panes_idle_feed": streamed_panes_idle_feed,
    "streamed_late_events": streamed_late_events,
    "streamed_panes_lateness": streamed_panes_lateness,
}
