import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import at, event, replay_dir
from tillflow.operators.cleaning import valid_events
from tillflow.operators.sessions import sessions
from tillflow.plans.session_job import start_session_job
from tillflow.sinks.streams import write_batches_idempotent, write_files
from tillflow.sources.streams import read_event_feed
from tillflow.streaming.panes import session_panes_stream
from tillflow.streaming.sessions import closed_sessions

GOLDEN = [
    event("a1", at(1), price=0.6),
    event("b1", at(2), price=4.0),
    event("b2", at(3), price=30.2),
    event("b3", at(4), price=11.4),
]
FLUSH = event("zz", at(60), user="flush", price=1.0)


def _run(spark, workdir, batches, build, name="out"):
    src = replay_dir(spark, os.path.join(workdir, "src"), batches)
    stream = read_event_feed(spark, src, max_files_per_trigger=1)
    out, chk = os.path.join(workdir, name), os.path.join(workdir, name + "_chk")
    q = write_files(build(valid_events(stream)), out, chk)
    q.awaitTermination()
    assert q.exception() is None
    return spark.read.parquet(out)


def _panes(spark, workdir, batches, **kw):
    return _run(spark, workdir, batches, lambda v: session_panes_stream(v, per_event=True, include_events=True, **kw))


@pytest.mark.parametrize("engine", ["group_state", "transform_with_state"])
def test_golden_replay(spark, workdir, engine):
    out = _panes(spark, workdir, [[e] for e in GOLDEN] + [[FLUSH]], engine=engine).where("user_id = '2'")
    rows = out.orderBy("window_open", "window_end").collect()
    closed, opens = rows[0], rows[1:]
    assert [r.window_end for r in opens] == [at(1), at(2), at(3), at(4)]
    assert [np.float32(r.total_price) for r in opens] == [np.float32(x) for x in (0.6, 4.6, 34.8, 46.2)]
    assert [[e.event_id for e in r.events] for r in opens] == [["a1"], ["a1", "b1"], ["a1", "b1", "b2"],
                                                                ["a1", "b1", "b2", "b3"]]
    assert all(r.window_id == "a1" and r.window_start == at(1) and r.window_open for r in opens)
    assert closed.window_open is False and closed.window_end == at(13, 59, 999_000)
    assert np.float32(closed.total_price) == np.float32(46.2)
    assert [e.event_id for e in closed.events] == ["a1", "b1", "b2", "b3"]
    assert closed.events[0].event_time == "1970-01-01T00:01:00.000Z"


def _final(df):
    rows = df.where("user_id = '2' AND NOT window_open").collect()
    assert len(rows) == 1
    return rows[0]


def test_out_of_order_gives_the_same_final_pane(spark, workdir):
    shuffled = [GOLDEN[2], GOLDEN[0], GOLDEN[3], GOLDEN[1]]
    one_batch = _final(_panes(spark, os.path.join(workdir, "a"), [shuffled, [FLUSH]]))
    per_event = _final(_panes(spark, os.path.join(workdir, "b"), [[e] for e in shuffled] + [[FLUSH]]))
    for r in (one_batch, per_event):
        assert r.window_id == "a1" and r.window_start == at(1) and r.window_end == at(13, 59, 999_000)
        assert np.float32(r.total_price) == np.float32(46.2) and r.event_count == 4


@pytest.mark.parametrize("engine", ["group_state", "transform_with_state"])
def test_late_rows(spark, workdir, engine):
    batches = [
        [event("s1", at(1), user="u")],
        [event("w", at(40), user="clock")],  # watermark -> 00:40
        [event("ok", at(32), user="late")],  # 00:32 + 10 min > 00:40: still in reach
        [event("no", at(29), user="later")],  # 00:29 + 10 min <= 00:40: late, dropped
    ]
    out = _panes(spark, workdir, batches, engine=engine)
    users = {r.user_id for r in out.collect()}
    assert "late" in users and "later" not in users
    closed = out.where("user_id = 'u' AND NOT window_open").collect()
    assert len(closed) == 1 and closed[0].window_end == at(10, 59, 999_000)


def test_bad_event_time_is_quarantined_and_the_session_kept(spark, workdir):
    rows = [event("g1", at(1)), event("bad", "not-a-time"), event("g2", at(2))]
    out = _panes(spark, workdir, [rows, [FLUSH]])
    final = _final(out)
    assert final.event_count == 2 and [e.event_id for e in final.events] == ["g1", "g2"]


def test_stream_closed_sessions_equal_batch_sessions(spark, workdir):
    rng = np.random.default_rng(3)
    rows, t = [], 0.0
    for i in range(300):
        t += float(rng.choice([0.5, 2, 6, 15, 40]))
        rows.append(event(f"e{i:04d}", at(t), user=f"u{rng.integers(0, 5)}", price=float(rng.integers(1, 100))))
    batches = [rows[i:i + 50] for i in range(0, len(rows), 50)]
    fast = _run(spark, os.path.join(workdir, "f"), batches, closed_sessions)
    exact = _panes(spark, os.path.join(workdir, "x"), batches).where("NOT window_open")
    df = valid_events(spark.createDataFrame(rows, "event_id string, event_time string, user_id string, "
                                                  "price float, event_type string"))
    batch = sessions(df).toPandas()
    max_ts = at(t)
    wm_exact = batch[batch.window_end <= max_ts]
    wm_fast = batch[batch.window_end <= max_ts - (at(10) - at(0))]
    key = lambda d: sorted(zip(d.user_id, d.window_id, d.event_count))
    assert key(fast.toPandas()) == key(wm_fast)
    assert key(exact.toPandas()) == key(wm_exact)


def test_restart_from_checkpoint_neither_loses_nor_repeats(spark, workdir):
    src = os.path.join(workdir, "src")
    out, chk = os.path.join(workdir, "out"), os.path.join(workdir, "chk")

    def run(batches):
        feed = replay_dir(spark, src, batches)
        q = write_files(session_panes_stream(valid_events(read_event_feed(spark, feed, max_files_per_trigger=1))),
                        out, chk)
        q.awaitTermination()
        assert q.exception() is None

    run([[GOLDEN[0]], [GOLDEN[1]]])
    first = spark.read.parquet(out).count()
    assert first == 2
    # new files arrive; the restarted query reads only them, from the same checkpoint
    os.makedirs(os.path.join(workdir, "more"))
    more = replay_dir(spark, os.path.join(workdir, "more"), [[GOLDEN[2]], [GOLDEN[3]], [FLUSH]])
    feed = os.path.join(src, "feed")
    for i, name in enumerate(sorted(os.listdir(more))):
        dst = os.path.join(feed, f"later{i:04d}.parquet")
        os.link(os.path.join(more, name), dst)
        os.utime(dst, (2_000_000 + i, 2_000_000 + i))
    q = write_files(session_panes_stream(valid_events(read_event_feed(spark, feed, max_files_per_trigger=1))), out, chk)
    q.awaitTermination()
    res = spark.read.parquet(out).where("user_id = '2'")
    assert res.count() == 5  # 4 open panes + 1 closed, none repeated
    assert res.where("NOT window_open").first().event_count == 4


def test_idempotent_batches_and_session_job(spark, workdir):
    # both feeds must pass the session's end: the slower one holds the watermark
    books = replay_dir(spark, os.path.join(workdir, "books"), [[GOLDEN[0], GOLDEN[2]], [FLUSH]])
    groceries = replay_dir(spark, os.path.join(workdir, "groc"),
                           [[GOLDEN[1], GOLDEN[3], event("q", "", user="x")], [FLUSH]])
    job = start_session_job(spark, books, groceries, os.path.join(workdir, "panes"),
                            os.path.join(workdir, "quarantine"), os.path.join(workdir, "chk"))
    job.await_termination()
    panes = spark.read.parquet(os.path.join(workdir, "panes"))
    assert panes.where("user_id = '2' AND window_open").count() == 4
    final = panes.where("user_id = '2' AND NOT window_open").collect()
    assert len(final) == 1
    assert (final[0].window_id, final[0].window_start, final[0].window_end) == (
        "a1", "1970-01-01T00:01:00.000Z", "1970-01-01T00:13:59.999Z")
    first = panes.where("user_id = '2' AND window_open").orderBy("event_count").first()
    assert first.window_end == "1970-01-01T00:01:00.000Z"
    quarantine = spark.read.parquet(os.path.join(workdir, "quarantine")).collect()
    assert [(r.event_id, r.reason) for r in quarantine] == [("q", "no event time")]
    # foreachBatch delivery, one folder per batch id
    feed = replay_dir(spark, os.path.join(workdir, "fb"), [[GOLDEN[0]], [GOLDEN[1]]])
    q = write_batches_idempotent(valid_events(read_event_feed(spark, feed, max_files_per_trigger=1)),
                                 os.path.join(workdir, "fb_out"), os.path.join(workdir, "fb_chk"))
    q.awaitTermination()
    parts = sorted(os.listdir(os.path.join(workdir, "fb_out")))
    assert [p for p in parts if p.startswith("batch_id=")] == ["batch_id=0", "batch_id=1"]
    assert spark.read.parquet(os.path.join(workdir, "fb_out")).select(F.count("*")).first()[0] == 2


@pytest.mark.parametrize("engine", ["group_state", "transform_with_state"])
def test_hot_user_is_applied_chunk_by_chunk(spark, workdir, engine):
    """A user's micro-batch arrives in many small Arrow chunks; results are unchanged."""
    rows = [event(f"e{i:03d}", at(i * 0.5), user="hot", price=1.0) for i in range(60)]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = _run(spark, workdir, [rows, [FLUSH]],
                   lambda v: session_panes_stream(v, per_event=True, engine=engine)).where("user_id = 'hot'")
        opens = sorted(r.event_count for r in out.where("window_open").collect())
        closed = out.where("NOT window_open").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert opens == list(range(1, 61))
    assert len(closed) == 1 and closed[0].event_count == 60 and closed[0].total_price == 60.0
    assert closed[0].window_end == at(29.5 + 10) - (at(0, 0, 1000) - at(0))


def test_arrival_order_does_not_change_closed_panes(spark, workdir):
    """Events cut into time-ordered micro-batches (so none is late), each batch shuffled:
    the closed panes equal those of one in-order delivery and of the batch sessions."""
    rng = np.random.default_rng(17)
    rows, t = [], 0.0
    for i in range(240):
        t += float(rng.choice([0.2, 1, 4, 9.9, 10, 25]))
        rows.append(event(f"r{i:04d}", at(t), user=f"u{rng.integers(0, 4)}", price=float(rng.integers(1, 50))))
    cuts = sorted(rng.choice(np.arange(1, len(rows)), size=7, replace=False))
    batches = [list(b) for b in np.split(np.array(rows, dtype=object), cuts)]
    for b in batches:
        rng.shuffle(b)
    flush = event("zz", at(t + 100), user="flush")  # moves the watermark past every session
    batches = [[tuple(x) for x in b] for b in batches] + [[flush]]
    shuffled = _panes(spark, os.path.join(workdir, "s"), batches).where("NOT window_open")
    in_order = _panes(spark, os.path.join(workdir, "o"), [rows, [flush]]).where("NOT window_open")
    key = lambda d: sorted((r.user_id, r.window_id, r.event_count, round(r.total_price, 3), r.window_end)
                           for r in d.collect())
    assert key(shuffled) == key(in_order)
    df = valid_events(spark.createDataFrame(rows, "event_id string, event_time string, user_id string, "
                                                  "price float, event_type string"))
    batch = sorted((r.user_id, r.window_id, r.event_count) for r in sessions(df).collect())
    assert sorted(x[:3] for x in key(in_order) if x[0] != "flush") == batch


def test_fast_and_exact_paths_differ_only_after_a_session_closed(spark, workdir):
    """A row that is not late but comes after the exact path closed its session:
    the exact path (like the reference, whose closed window state is gone) starts a
    new session; the fast path, which closes one gap later, still merges it."""
    batches = [
        [event("a", at(10), user="u"), event("b", at(19), user="u")],
        [event("w", at(35), user="clock")],  # exact path closes [00:10, 00:29) here
        [event("c", at(28), user="u")],  # 00:28 + 10 min > 00:35: not late
        [event("z", at(120), user="flush")],
    ]
    exact = _panes(spark, os.path.join(workdir, "x"), batches).where("user_id = 'u' AND NOT window_open")
    fast = _run(spark, os.path.join(workdir, "f"), batches, closed_sessions).where("user_id = 'u'")
    assert sorted((r.window_id, r.event_count) for r in exact.collect()) == [("a", 2), ("c", 1)]
    assert sorted((r.window_id, r.event_count) for r in fast.collect()) == [("a", 3)]


def test_late_row_next_batch_exact_drops_fast_path_stretches(spark, workdir):
    """Session [00:01, 00:15), watermark 00:40, then an event at 00:12 in the next batch:
    00:12 + 10 min <= 00:40, so it is late. The exact path drops it. Spark's own session
    window filters late rows with the previous batch's watermark, so in this one batch
    the row gets in and stretches the session to 00:22 (the documented band)."""
    batches = [
        [event("s1", at(1), user="u"), event("s2", at(5), user="u")],
        [event("w", at(40), user="clock")],
        [event("late", at(12), user="u")],
        [event("z", at(120), user="flush")],
    ]
    exact = _panes(spark, os.path.join(workdir, "x"), batches).where("user_id = 'u'")
    fast = _run(spark, os.path.join(workdir, "f"), batches, closed_sessions).where("user_id = 'u'")
    closed = exact.where("NOT window_open").collect()
    assert [(r.window_id, r.event_count, r.window_end) for r in closed] == [("s1", 2, at(14, 59, 999_000))]
    assert exact.where("window_open").count() == 2  # no pane for the late row
    assert [(r.window_id, r.event_count, r.window_end) for r in fast.collect()] == [("s1", 3, at(22))]


def test_message_time_places_sessions_payload_time_names_them(spark, workdir):
    """Sessions follow the message (publish) time; order, name and pane bounds follow the
    payload's event time, as in the reference (two parameters, both the event time by default)."""
    from pyspark.sql import types as T

    from tillflow.functions.time import parse_iso
    from tillflow.schemas import EVENT

    schema = T.StructType(list(EVENT.fields) + [T.StructField("publish_time", T.StringType())])
    rows = [("p1", "1970-01-01T00:10:00.000Z", "u", 1.0, "BOOK_SALE", "1970-01-01T00:01:00.000Z"),
            ("p2", "1970-01-01T00:09:00.000Z", "u", 2.0, "BOOK_SALE", "1970-01-01T00:02:00.000Z"),
            ("p3", "1970-01-01T00:08:00.000Z", "u", 4.0, "BOOK_SALE", "1970-01-01T00:03:00.000Z")]
    flush = ("z", "1970-01-01T02:00:00.000Z", "flush", 1.0, "BOOK_SALE", "1970-01-01T02:00:00.000Z")
    src = replay_dir(spark, os.path.join(workdir, "src"), [rows, [flush]], schema=schema)
    stream = read_event_feed(spark, src, max_files_per_trigger=1, schema=schema)
    valid = valid_events(stream).withColumn("publish_ts", parse_iso(F.col("publish_time")))

    def run(df, name):
        q = write_files(df, os.path.join(workdir, name), os.path.join(workdir, name + "_chk"))
        q.awaitTermination()
        assert q.exception() is None
        return spark.read.parquet(os.path.join(workdir, name)).where("user_id = 'u'")

    panes = run(session_panes_stream(valid, time_col="publish_ts", order_col="ts", include_events=True), "exact")
    closed = panes.where("NOT window_open").collect()
    assert len(closed) == 1
    c = closed[0]
    assert (c.window_id, c.window_start, c.window_end, c.event_count) == ("p3", at(8), at(12, 59, 999_000), 3)
    assert [e.event_id for e in c.events] == ["p3", "p2", "p1"]
    opens = panes.where("window_open").orderBy("event_count").collect()
    assert [(r.window_id, r.window_start, r.window_end) for r in opens] == [
        ("p1", at(10), at(10)), ("p2", at(9), at(10)), ("p3", at(8), at(10))]
    fast = run(closed_sessions(valid, time_col="publish_ts", order_col="ts"), "fast").collect()
    assert [(r.window_id, r.window_start, r.last_event_time, r.window_end, r.event_count) for r in fast] == [
        ("p3", at(8), at(10), at(13), 3)]


def test_pane_output_matches_the_declared_schema(spark, workdir):
    from tillflow.schemas import SESSION_PANE

    src = replay_dir(spark, os.path.join(workdir, "src"), [GOLDEN])
    out = session_panes_stream(valid_events(read_event_feed(spark, src)), include_events=True)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in SESSION_PANE]


def test_allowed_lateness_moves_the_late_line(spark, workdir):
    """lateness=5 min: the watermark trails the newest event by 5 minutes."""
    batches = [
        [event("w", at(40), user="clock")],
        [event("in", at(28), user="a"), event("out", at(24), user="b")],
        [event("z", at(200), user="flush")],
    ]
    out = _panes(spark, workdir, batches, lateness="5 minutes")
    users = {r.user_id for r in out.collect()}
    assert "a" in users and "b" not in users
    closed = out.where("user_id = 'clock' AND NOT window_open").collect()
    assert len(closed) == 1 and closed[0].window_end == at(49, 59, 999_000)


def test_session_job_reads_json_lines_feeds(spark, workdir):
    from tillflow.schemas import EVENT

    books, groceries = os.path.join(workdir, "books"), os.path.join(workdir, "groceries")
    spark.createDataFrame(GOLDEN[:2] + [FLUSH], EVENT).coalesce(1).write.json(books)
    spark.createDataFrame(GOLDEN[2:] + [FLUSH], EVENT).coalesce(1).write.json(groceries)
    job = start_session_job(spark, books, groceries, os.path.join(workdir, "panes"),
                            os.path.join(workdir, "quarantine"), os.path.join(workdir, "chk"), fmt="json")
    job.await_termination()
    panes = spark.read.parquet(os.path.join(workdir, "panes")).where("user_id = '2'")
    assert panes.where("window_open").count() == 4
    final = panes.where("NOT window_open").first()
    assert (final.window_id, final.event_count, final.window_end) == ("a1", 4, "1970-01-01T00:13:59.999Z")


def test_nan_price_gives_a_nan_total(spark, workdir):
    out = _panes(spark, workdir, [[event("n", at(1), user="u", price=float("nan")), event("m", at(2), user="u")],
                                  [FLUSH]]).where("user_id = 'u' AND NOT window_open").collect()
    assert len(out) == 1 and math.isnan(out[0].total_price) and out[0].event_count == 2


def test_session_job_with_message_time(spark, workdir):
    """The job places events by a message-time column and names sessions by payload time."""
    import datetime as dt

    from pyspark.sql import types as T

    from tillflow.schemas import EVENT

    schema = T.StructType(list(EVENT.fields) + [T.StructField("message_time", T.TimestampType())])
    m = lambda minutes: dt.datetime(1970, 1, 1) + dt.timedelta(minutes=minutes)
    rows = [("p1", "1970-01-01T00:10:00.000Z", "u", 1.0, "BOOK_SALE", m(1)),
            ("p2", "1970-01-01T00:09:00.000Z", "u", 2.0, "BOOK_SALE", m(2)),
            ("p3", "1970-01-01T00:08:00.000Z", "u", 4.0, "BOOK_SALE", m(3))]
    flush = ("z", "1970-01-01T02:00:00.000Z", "flush", 1.0, "BOOK_SALE", m(120))
    books = replay_dir(spark, os.path.join(workdir, "b"), [rows, [flush]], schema=schema)
    groceries = replay_dir(spark, os.path.join(workdir, "g"), [[flush]], schema=schema)
    job = start_session_job(spark, books, groceries, os.path.join(workdir, "panes"), os.path.join(workdir, "q"),
                            os.path.join(workdir, "chk"), session_time="message_time", schema=schema)
    job.await_termination()
    final = spark.read.parquet(os.path.join(workdir, "panes")).where("user_id = 'u' AND NOT window_open").collect()
    assert [(r.window_id, r.window_start, r.window_end, r.event_count) for r in final] == [
        ("p3", "1970-01-01T00:08:00.000Z", "1970-01-01T00:12:59.999Z", 3)]


@pytest.mark.parametrize("engine", ["group_state", "transform_with_state", "session_window"])
def test_the_slower_feed_loses_nothing(spark, workdir, engine):
    """Books are an hour ahead of groceries: each feed has its own watermark."""
    from tillflow.sources.streams import union_feeds
    from tillflow.streaming import closed_panes, closed_sessions, mark_feed, mark_feed_time

    books = replay_dir(spark, os.path.join(workdir, "b"), [[event("b1", at(1))], [event("b2", at(60))], [event("b3", at(300))]])
    groceries = replay_dir(spark, os.path.join(workdir, "g"), [[event(f"g{i}", at(i))] for i in (2, 3, 4, 5)] + [[event("g9", at(300))]])
    mark = mark_feed_time if engine == "session_window" else mark_feed
    valid = union_feeds(*[mark(valid_events(read_event_feed(spark, f, max_files_per_trigger=1))) for f in (books, groceries)])
    if engine == "session_window":
        out = closed_panes(closed_sessions(valid, marked=True))
    else:
        out = session_panes_stream(valid, engine=engine, marked=True)
    path = os.path.join(workdir, "out")
    write_files(out, path, os.path.join(workdir, "chk")).awaitTermination()
    rows = spark.read.schema(out.schema).parquet(path)
    closed = rows.where("NOT window_open").orderBy("window_start").collect()
    assert [(r.window_id, r.event_count) for r in closed] == [("b1", 5), ("b2", 1)]
    if engine != "session_window":
        assert rows.where("window_open").count() == 8


@pytest.mark.parametrize("engine", ["group_state", "transform_with_state"])
def test_panes_do_not_depend_on_arrow_batches_or_partitions(spark, workdir, engine):
    rng = np.random.default_rng(5)
    rows = [event(f"e{i:03d}", at(float(rng.choice([0.5, 3, 12])) * i), user="ab"[i % 2], price=float(i)) for i in range(40)]
    rng.shuffle(rows)
    seen = set()
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(k) for k in keys]
    try:
        for n, (size, parts) in enumerate([("1", "4"), ("7", "1"), ("10000", "8")]):
            spark.conf.set(keys[0], size)
            spark.conf.set(keys[1], parts)
            folder = os.path.join(workdir, str(n))
            os.makedirs(folder)
            out = _run(spark, folder, [[tuple(r) for r in rows], [event("zz", at(9999), user="flush")]], lambda v: session_panes_stream(v, engine=engine))
            seen.add(repr(sorted(map(repr, out.drop("events").where("user_id <> 'flush'").collect()))))
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    assert len(seen) == 1


def test_runs_as_arrays_equal_events_one_by_one():
    """The array path against the event-by-event path over random batches and lateness."""
    import pandas as pd

    from tillflow.streaming.panes import _SessionBook

    class EachOne(_SessionBook):
        def add(self, key, batch, wm_us, sessions, events, out):
            order = np.lexsort((batch["event_id"].to_numpy(), batch["t_us"].to_numpy()))
            run = [i for i in order if batch["t_us"].to_numpy()[i] + self.gap_us > wm_us]
            sessions = sorted(sessions, key=lambda s: s[0])
            touched = {}
            self._add_each(key, batch, run, wm_us, sessions, [s[0] for s in sessions], touched, events, out)
            if not self.per_event:
                out.extend(self.pane(key, s, True, events) for s in touched.values())
            return sessions, events

    rng = np.random.default_rng(11)
    for trial in range(200):
        books = [cls(10, bool(trial % 2), False) for cls in (_SessionBook, EachOne)]
        open_ = [[], []]
        for b in range(4):
            n = int(rng.integers(1, 12))
            t = rng.integers(b * 20, b * 20 + 60, n)
            batch = pd.DataFrame({"t_us": t, "o_us": t if trial % 3 else t + rng.integers(-3, 4, n), "event_id": [f"{b}-{i}" for i in rng.permutation(n)],
                                  "price": np.where(rng.random(n) < 0.1, np.nan, rng.integers(1, 9, n)).astype(np.float32)})
            outs = [[], []]
            for i, book in enumerate(books):
                open_[i], _ = book.add("u", batch, b * 15, open_[i], [], outs[i])
            assert repr(sorted(outs[0], key=repr)) == repr(sorted(outs[1], key=repr))
            assert repr(sorted(open_[0])) == repr(sorted(open_[1]))


def test_job_flags_and_failing_query(spark, workdir):
    from tillflow.plans.session_job import SessionJob, main

    schema = "event_id string, event_time string, user_id string, price float, event_type string, sent timestamp"
    rows = [(*event("p1", at(10)), at(1)), (*event("p2", at(9)), at(2)), (*event("p3", at(8)), None), (*event("z", at(500), user="flush"), at(500))]
    feeds = []
    for name in ("b", "g"):
        feeds.append(os.path.join(workdir, name))
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(feeds[-1])
    for extra, opens in (["--closed-only"], 0), (["--per-session"], None):
        base = os.path.join(workdir, extra[0].strip("-"))
        main(["--books", feeds[0], "--groceries", feeds[1], "--panes", f"{base}/p", "--quarantine", f"{base}/q", "--checkpoint", f"{base}/c",
              "--session-time", "sent", "--max-files", "1", *extra])
        panes = spark.read.parquet(f"{base}/p").where("user_id = '2'")
        closed = panes.where("NOT window_open").collect()
        assert [(r.window_id, r.event_count, r.window_end) for r in closed] == [("p2", 4, "1970-01-01T00:11:59.999Z")]
        assert opens is None or panes.where("window_open").count() == opens
        assert {(r.event_id, r.reason) for r in spark.read.parquet(f"{base}/q").collect()} == {("p3", "no session time")}

    def fail(batch, _):
        raise RuntimeError("no")

    source = lambda: read_event_feed(spark, feeds[0])
    bad = source().writeStream.foreachBatch(fail).option("checkpointLocation", os.path.join(workdir, "bad")).start()
    good = write_files(source(), os.path.join(workdir, "ok"), os.path.join(workdir, "okc"), trigger={"processingTime": "1 second"})
    with pytest.raises(Exception, match="no"):
        SessionJob(good, bad).await_termination(60)
    assert not good.isActive


def test_replayed_slices_are_written_by_many_tasks(spark, monkeypatch):
    from tillflow.plans import queries

    whole = queries.streamed_panes_two_feeds(spark, "/root/testdata/sf0.001").collect()
    monkeypatch.setattr(queries, "REPLAY_FILE_ROWS", 50)
    seen = []
    feed = queries.read_event_feed
    monkeypatch.setattr(queries, "read_event_feed", lambda spark, path, **kw: seen.append((path, kw["max_files_per_trigger"])) or feed(spark, path, **kw))
    dealt = queries.streamed_panes_two_feeds(spark, "/root/testdata/sf0.001").collect()
    assert whole and sorted(map(repr, dealt)) == sorted(map(repr, whole))
    for (path, files), slices in zip(seen, (4, 5)):
        assert files > 1 and len(spark.read.parquet(path).inputFiles()) == files * slices
