"""Panes that carry each event once, and the sessions' events rebuilt from them."""

import os

import numpy as np
import pandas as pd
import pytest

from helpers import at, event, iso, replay_dir
from test_late_and_idle import GAP_MIN, PlainSessions, random_batches
from tillflow.operators.cleaning import valid_events
from tillflow.sinks.streams import write_files
from tillflow.sources.streams import read_event_feed
from tillflow.streaming.panes import _SessionBook, events_of_closed_panes, session_panes_stream


@pytest.mark.parametrize("per_event", [False, True])
def test_each_event_is_carried_once(per_event):
    for seed in range(60):
        plain, book = PlainSessions(GAP_MIN, 0), _SessionBook(GAP_MIN, per_event, False, deltas=True)
        sessions, events, got, mark = [], [], [], 0
        for rows in random_batches(seed, 1):
            plain.batch([(t, i, "u0") for t, i, _ in rows], mark)
            sessions, events = book.close_due("u0", mark, sessions, events, got)
            frame = pd.DataFrame({"event_id": [i for _, i, _ in rows], "event_time": "", "user_id": "u0", "price": np.float32(1), "event_type": "x",
                                  "t_us": [t for t, _, _ in rows], "o_us": [t for t, _, _ in rows]})
            sessions, events = book.add("u0", frame, mark, sessions, events, got)
            mark = max(mark, max(t for t, _, _ in rows))
        late = {x[1] for x in plain.out if x[0] == "late"}
        accepted = sorted(i for b in random_batches(seed, 1) for _, i, _ in b if i not in late)
        assert sorted(e["event_id"] for r in got for e in r[7]) == accepted
        assert not events and all(r[7] == [] for r in got if not r[5])  # nothing in the state, nothing in closed panes
        assert not per_event or all(len(r[7]) == 1 for r in got if r[5])


@pytest.mark.parametrize("engine", ["group_state", "transform_with_state"])
def test_rebuilt_events(spark, workdir, engine):
    batches = random_batches(7, 3, size=40)
    batches[2] += [(t, i + "again", u) for t, i, u in batches[2][:5]]  # ties in time
    rows = [[event(i, at(t), user=u, price=0.5) for t, i, u in b] for b in batches]
    feed = read_event_feed(spark, replay_dir(spark, os.path.join(workdir, "src"), rows), max_files_per_trigger=1)
    stream = session_panes_stream(valid_events(feed), per_event=False, event_deltas=True, engine=engine)
    q = write_files(stream, f"{workdir}/out", f"{workdir}/chk", trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    panes = spark.read.schema(stream.schema).parquet(f"{workdir}/out")
    plain, mark = PlainSessions(GAP_MIN, 0), 0
    for b in batches:
        plain.batch(b, mark)
        mark = max(mark, max(t for t, _, _ in b))
    plain.batch([], mark)
    times = {i: iso(at(t)) for b in batches for t, i, _ in b}
    want = [(x[2][0], x[1], n, i, times[i], 0.5, n * 0.5) for x in plain.out if x[0] == "ON_TIME" for n, i in enumerate(x[2], 1)]
    got = events_of_closed_panes(panes).collect()
    assert len(want) > 50
    assert sorted((r.window_id, r.user_id, r.position, r.event_id, r.event_time, r.price, r.running_total) for r in got) == sorted(want)
    assert events_of_closed_panes(panes.limit(0)).collect() == []


def test_rebuilding_meets_long_sessions_and_neighbours(spark):
    """A session of many gaps, another user's at the same time, and events of a session that is still open."""
    e = lambda i, m, u: dict(zip(("event_id", "event_time", "user_id", "price", "event_type"), event(i, at(m), user=u, etype="t")))
    long = [e(f"{k:03d}", 5 * k, "a") for k in range(100)]
    schema = "window_id string, user_id string, window_start timestamp, window_end timestamp, window_open boolean, events array<struct<event_id string, event_time string, user_id string, price float, event_type string>>"
    rows = [("000", "a", at(0), at(5 * k), True, long[k : k + 10]) for k in range(0, 100, 10)]
    rows += [("000", "a", at(0), at(495 + GAP_MIN, micros=-1000), False, [])]
    rows += [("next", "a", at(506), at(506), True, [e("next", 506, "a")]), ("b0", "b", at(20), at(20), True, [e("b0", 20, "b")]), ("b0", "b", at(20), at(20 + GAP_MIN, micros=-1000), False, [])]
    got = events_of_closed_panes(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.user_id, r.position, r.event_id) for r in got) == [*(("a", k + 1, f"{k:03d}") for k in range(100)), ("b", 1, "b0")]


def test_deltas_need_one_time_and_no_corrected_panes(spark, workdir):
    feed = valid_events(read_event_feed(spark, replay_dir(spark, os.path.join(workdir, "src"), [[event("a", at(1))]])))
    for options in ({"include_events": True}, {"order_col": "event_time"}, {"allowed_lateness": "1 minute"}):
        with pytest.raises(ValueError):
            session_panes_stream(feed, event_deltas=True, **options)
