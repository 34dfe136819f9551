"""Early and closed session panes on a stream (the exact path).

Spark's ``session_window`` cannot run in update mode, so early panes come from
one stateful operator keyed by user, with one event-time timer per user (at the
earliest end among its open sessions). Two engines run the same rules:
``applyInPandasWithState`` (default; the state travels with the Arrow batches, and
the users are dealt into buckets, see below) and ``transformWithStateInPandas`` (list
state and timers through the state server, needs the RocksDB state store; one user a key). Output:

* an **open** pane for every new event (``per_event=True``) or for every session
  a micro-batch touched: window_end is the newest event time so far;
* a **closed** pane when the watermark reaches the session's end
  (last event + gap): window_end is the window's last instant, end - 1 ms.

Panes accumulate: each holds the whole session so far. The session is named by
its oldest event (ties in time: smaller id); the total is summed in double and
narrowed to float.

Late rule: an event is late when ``ts + gap + allowed lateness <= watermark`` (its own
window is already behind), checked here against the current watermark; Spark's own
filter uses the previous batch's. The watermark column is ``close_ts = ts + gap`` with
delay ``gap + lateness``, which makes the watermark the newest event time minus
the lateness. Late events are dropped, or come out as rows of their own with
``late_rows``.

Allowed lateness: a closed session stays in the state until its end plus
``allowed_lateness``. An event that reaches it until then, or whose own window is past
but not by that much, gives a corrected pane of the whole session. As in the
reference such a pane is marked open (only the pane at the watermark isn't); its
``timing`` is LATE. A session that such an event joins to one still open is open again
and closes once more.

Silent feeds: a feed without rows holds the watermark. ``mark_feed(..., heartbeats=...)``
adds rows that carry only a time; they move the feed's watermark and leave before the state.

State per user: the open sessions (a handful: they close as the watermark
moves) and, only with ``include_events``, their events. Keyed state puts one
user on one task; what that task holds is bounded by the user's open sessions,
and what it reads per batch by the trigger size (``maxFilesPerTrigger`` /
``maxOffsetsPerTrigger``).

Buckets: a call of the stateful function costs milliseconds, whatever it gets, so the
default engine's key is one of ``buckets`` hash buckets of users, not the user: calls
per micro-batch are bounded however many users there are. Inside a call each user has
sessions, rows and due time of their own, as if alone. A bucket's state is read and
written as a whole when one of its users gets rows or is due, so a stream of small
triggers over many open users wants more buckets, or ``buckets=None`` (one user a key). The
number is fixed for the life of a checkpoint.
 A user's rows of one micro-batch are sorted as a whole
before they are applied, so panes don't depend on how Arrow cuts them. Rows that
follow the open sessions in time are applied as arrays; only a run that reaches
into or bridges open sessions is applied event by event. The events array
re-sends the whole session on every pane, quadratic in session length, so it is
off unless asked for.

Several feeds: mark each with :func:`mark_feed` before the union and pass
``marked=True``. Each feed then has its own watermark and the slowest holds the
job's (Spark's ``multipleWatermarkPolicy`` is "min" by default), so rows of a feed
that lags behind another are not late.

Two times per event: ``time_col`` places it in a session (the message time in
the reference) and ``order_col`` orders and names (the payload's event time);
both default to the event time. A NaN price gives a NaN total.
"""

from __future__ import annotations

import bisect
import itertools
import sys
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tillflow.functions.checks import REASON_LATE
from tillflow.functions.time import iso_millis, micros, parse_iso
from tillflow.operators.sessions import SESSION_GAP, gap_micros, session_event_rows
from tillflow.schemas import EVENT

_SESSION_STATE = T.StructType(
    [
        T.StructField("start_us", T.LongType()),  # session time: merging, lateness, timers
        T.StructField("last_us", T.LongType()),
        T.StructField("first_id", T.StringType()),  # oldest event by (order time, id)
        T.StructField("total", T.DoubleType()),
        T.StructField("n", T.LongType()),
        T.StructField("first_o_us", T.LongType()),  # order time: naming and pane bounds
        T.StructField("last_o_us", T.LongType()),
        T.StructField("closed", T.BooleanType()),  # its closed pane is out; kept for allowed lateness
    ]
)
_EVENT_STATE = T.StructType(list(EVENT.fields) + [T.StructField("t_us", T.LongType()),
                                                  T.StructField("o_us", T.LongType())])

_RAW_PANE = T.StructType(
    [
        T.StructField("window_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("start_us", T.LongType()),
        T.StructField("end_us", T.LongType()),
        T.StructField("total_price", T.DoubleType()),
        T.StructField("window_open", T.BooleanType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("events", T.ArrayType(EVENT), True),
        T.StructField("timing", T.StringType()),
        T.StructField("late", EVENT, True),  # a late event; no pane then
        T.StructField("total_nan", T.BooleanType()),  # pandas -> Arrow turns NaN into null
    ]
)
_PANE_COLS = [f.name for f in _RAW_PANE.fields][:-1]

# The processor is also unpickled by the driver-side Python runner that Spark
# starts for stateful operators, which does not see ``--py-files``; ship this
# module's code by value so that runner needs no import of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
_EVENT_COLS = [f.name for f in EVENT.fields]

#: Keys of the default engine's state. Fixed value: a checkpoint holds the users by it.
BUCKETS = 4096


_QUIET = []


def _quiet_pandas_concat() -> None:
    """Silence, once per worker, the pandas warning about concatenating an all-null
    column (the ``events`` column when events are not requested)."""
    if not _QUIET:
        warnings.filterwarnings("ignore", category=FutureWarning, message=".*concatenation with empty or all-NA.*")
        _QUIET.append(True)


def _py(v):
    """A plain Python value (state is pickled for the JVM, which knows no numpy scalars)."""
    return v.item() if isinstance(v, np.generic) else v


def _columns(batch) -> dict[str, np.ndarray]:
    """The rows' columns as arrays (pandas costs more than the work on a user's few rows)."""
    return batch if isinstance(batch, dict) else {c: batch[c].to_numpy() for c in batch.columns}


class _SessionBook:
    """The session rules, shared by both stateful engines below.

    A session is ``[start, last, first_id, total, n, first_o, last_o, closed]``. Two
    times per event, as in the reference: the *session time* ``t`` (the message
    time there) places it in a session, drives lateness and the timer; the
    *order time* ``o`` (the payload's event time) orders the events, names the
    session and gives the pane bounds. By default both are the event time.
    Events are applied in (t, id) order; an event joins every open session whose
    window ``[start, last + gap)`` overlaps its own ``[t, t + gap)``, merging them.
    """

    def __init__(self, gap_us: int, per_event: bool, include_events: bool, allowed_us: int = 0, late_rows: bool = False,
                 deltas: bool = False):
        self.gap_us = gap_us
        self.per_event = per_event
        self.include_events = include_events
        self.allowed_us = allowed_us
        self.late_rows = late_rows
        self.deltas = deltas

    def due(self, s: list) -> int:
        """When a session closes, or when a closed one leaves the state."""
        return s[1] + self.gap_us + (self.allowed_us if s[7] else 0)

    def timer_ms(self, sessions: list[list]) -> int | None:
        """Earliest time at which a session is due, in ms rounded up (the one timer of a user)."""
        if not sessions:
            return None
        return -(-min(map(self.due, sessions)) // 1000)

    def pane(self, key, s: list, is_open: bool, events: list[dict], fresh: list[dict] | None = None) -> tuple:
        start, last, first_id, total, n, first_o, last_o, closed = s
        # open: newest order time so far; closed: the window's last instant (end - 1 ms)
        end_us = last_o if is_open else last + self.gap_us - 1000
        evs = (fresh or []) if self.deltas else None
        if self.include_events:
            mine = [e for e in events if start <= e["t_us"] <= last]
            mine.sort(key=lambda e: (e["o_us"], e["event_id"]))
            evs = [{c: e[c] for c in _EVENT_COLS} for e in mine]
        timing = ("LATE" if closed else "EARLY") if is_open else "ON_TIME"
        return (first_id, key, first_o, end_us, total, is_open, n, evs, timing, None)

    def close_due(self, key, due_us: int, sessions: list[list], events: list[dict], out: list[tuple]):
        """Emit a closed pane for every open session whose end is at or before ``due_us``;
        closed ones stay until the allowed lateness is over as well."""
        keep = []
        for s in sorted(sessions, key=lambda s: s[0]):
            if not s[7] and s[1] + self.gap_us <= due_us:
                out.append(self.pane(key, s, False, events))
                s[7] = True
            if self.due(s) > due_us:
                keep.append(s)
        if self.include_events and len(keep) != len(sessions):
            events = [e for e in events if any(s[0] <= e["t_us"] <= s[1] for s in keep)]
        return keep, events

    def add(self, key, batch: pd.DataFrame | dict[str, np.ndarray], wm_us: int, sessions: list[list], events: list[dict],
            out: list[tuple]):
        """Apply a user's events of one micro-batch in (time, id) order; late ones
        (``t + gap + allowed lateness <= wm``) are dropped or put out as they are.

        Open sessions never overlap, so they are kept sorted by start. The events are
        cut into runs (local sessions); a run that meets no open session, or only
        the one it continues in time, is applied as arrays.
        """
        gap, batch = self.gap_us, _columns(batch)
        t_all, o_all, ids_all, prices = (batch[c] for c in ("t_us", "o_us", "event_id", "price"))
        in_time = t_all + gap + self.allowed_us > wm_us
        keep_rows = np.flatnonzero(in_time)
        if self.late_rows and len(keep_rows) < len(in_time):
            out.extend((None, key, *[None] * 7, row) for row in self._records(batch, np.flatnonzero(~in_time)))
        if not len(keep_rows):
            return sessions, events
        order = keep_rows[np.lexsort((ids_all[keep_rows], t_all[keep_rows]))]
        times = t_all[order]
        sessions = sorted(sessions, key=lambda x: x[0])
        starts = [x[0] for x in sessions]
        touched: dict[int, list] = {}
        fresh: dict[int, list[int]] = {}  # with deltas: the rows that each touched session got
        cuts = np.flatnonzero(np.diff(times) >= gap) + 1
        for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(order)]):
            run = order[lo:hi]
            j = bisect.bisect_left(starts, int(times[hi - 1]) + gap)  # sessions[:j] start before the run's end
            met = [s for s in sessions[max(0, j - 2) : j] if s[1] + gap > times[lo]]
            later = len(met) > 1 or met and (met[0][1] > times[lo] or met[0][6] > o_all[run[0]] or met[0][7]) or times[lo] + gap <= wm_us
            if self.include_events or later or (o_all[run] != t_all[run]).any():
                self._add_each(key, batch, run, wm_us, sessions, starts, touched, events, out, fresh)
                continue
            if met:
                s = met[0]
            else:
                first = int(times[lo])
                s = [first, first, _py(ids_all[run[0]]), 0.0, 0, first, first, False]
                k = bisect.bisect_left(starts, first)
                sessions.insert(k, s)
                starts.insert(k, first)
            if met and (int(o_all[run[0]]), _py(ids_all[run[0]])) < (s[5], s[2]):
                s[5], s[2] = int(o_all[run[0]]), _py(ids_all[run[0]])
            totals = np.cumsum(np.r_[s[3], prices[run].astype(np.float64)])[1:]
            if self.per_event:
                counts = range(s[4] + 1, s[4] + 1 + len(run))
                carried = ([e] for e in self.rows(batch, run)) if self.deltas else itertools.repeat(None)
                out.extend((s[2], key, s[5], t, total, True, n, e, "EARLY", None) for t, total, n, e in zip(times[lo:hi].tolist(), totals.tolist(), counts, carried))
            elif self.deltas:
                fresh.setdefault(id(s), []).extend(run.tolist())
            last = int(times[hi - 1])
            s[1], s[6], s[3], s[4] = max(s[1], last), max(s[6], last), float(totals[-1]), s[4] + len(run)
            touched[id(s)] = s
        if not self.per_event:
            out.extend(self.pane(key, s, True, events, self.rows(batch, fresh.get(k, []))) for k, s in touched.items())
        return sessions, events

    @staticmethod
    def _records(batch: dict[str, np.ndarray], at: np.ndarray) -> list[dict]:
        return [dict(zip(_EVENT_COLS, row)) for row in zip(*(batch[c][at].tolist() for c in _EVENT_COLS))]

    @classmethod
    def rows(cls, batch: dict[str, np.ndarray], at) -> list[dict]:
        """The events in the given rows, in (time, id) order."""
        if not len(at):
            return []
        at = np.asarray(at)
        return cls._records(batch, at[np.lexsort((batch["event_id"][at], batch["o_us"][at]))])

    def _add_each(self, key, batch: pd.DataFrame | dict[str, np.ndarray], run: np.ndarray, wm_us: int, sessions: list[list],
                  starts: list, touched: dict, events: list[dict], out: list[tuple], fresh: dict | None = None) -> None:
        """Apply sorted events one by one; each can only touch the (at most two)
        open sessions next to it, found by binary search."""
        gap, batch, fresh = self.gap_us, _columns(batch), {} if fresh is None else fresh
        t_all, o_all, ids_all, prices = (batch[c] for c in ("t_us", "o_us", "event_id", "price"))
        for i in run:
            t, o = int(t_all[i]), int(o_all[i])
            merged = [t, t, _py(ids_all[i]), float(prices[i]), 1, o, o, False]
            j = bisect.bisect_left(starts, t + gap)  # sessions[:j] start before t + gap
            hits = [h for h in (j - 2, j - 1) if h >= 0 and sessions[h][1] + gap > t]
            mine = [int(i)]
            for h in hits:
                s = sessions[h]
                merged[0] = min(merged[0], s[0])
                merged[1] = max(merged[1], s[1])
                if (s[5], s[2]) < (merged[5], merged[2]):
                    merged[5], merged[2] = s[5], s[2]
                merged[6] = max(merged[6], s[6])
                merged[3] += s[3]
                merged[4] += s[4]
                touched.pop(id(s), None)
                mine += fresh.pop(id(s), [])
            for h in reversed(hits):
                del sessions[h]
                del starts[h]
            merged[7] = merged[1] + gap <= wm_us  # past already: what it gives is a late pane
            k = bisect.bisect_left(starts, merged[0])
            sessions.insert(k, merged)
            starts.insert(k, merged[0])
            touched[id(merged)] = merged
            if self.deltas and not self.per_event:
                fresh[id(merged)] = mine
            if self.include_events:
                events.append({**{c: _py(batch[c][i]) for c in _EVENT_COLS}, "t_us": t, "o_us": o})
            if self.per_event:
                out.append(self.pane(key, merged, True, events, self.rows(batch, mine[:1]) if self.deltas else None))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    pdf = pd.DataFrame.from_records(rows, columns=_PANE_COLS)
    pdf["total_nan"] = np.isnan(pdf["total_price"].to_numpy(dtype=np.float64))
    return pdf


def _frames(rows: list[tuple], size: int = 50_000) -> Iterator[pd.DataFrame]:
    """Output frames of bounded size; panes and late events apart, as an event has no pane's numbers."""
    for part in ([r for r in rows if r[-1] is None], [r for r in rows if r[-1] is not None]):
        for i in range(0, len(part), size):
            yield _frame(part[i : i + size])


def _whole(chunks) -> pd.DataFrame:
    """A user's rows of this micro-batch in one frame, however Arrow cut them (the trigger bounds them)."""
    parts = list(chunks)
    return parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)


class SessionPanes(StatefulProcessor):
    """``transformWithStateInPandas`` engine: list state per user and one event-time timer
    at the earliest end among its open sessions."""

    def __init__(self, book: _SessionBook):
        self.book = book

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open_sessions", _SESSION_STATE)
        if self.book.include_events:
            self.events = handle.getListState("session_events", _EVENT_STATE)

    def _load(self) -> tuple[list[list], list[dict]]:
        sessions = [list(row) for row in self.open.get()]
        events = []
        if self.book.include_events:
            events = [dict(zip(_EVENT_STATE.names, row)) for row in self.events.get()]
        return sessions, events

    def _save(self, sessions: list[list], events: list[dict], old_timer: int | None, fired: bool = False) -> None:
        if sessions:
            self.open.put([tuple(s) for s in sessions])
        else:
            self.open.clear()
        new_timer = self.book.timer_ms(sessions)
        if new_timer != old_timer or fired:
            if old_timer is not None and not fired:
                self.handle.deleteTimer(old_timer)
            if new_timer is not None:
                self.handle.registerTimer(new_timer)
        if self.book.include_events:
            if events:
                self.events.put([tuple(e[c] for c in _EVENT_STATE.names) for e in events])
            else:
                self.events.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        user = key[0]
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        sessions, events = self._load()
        old_timer = self.book.timer_ms(sessions)
        out: list[tuple] = []
        # input rows are handled before timers in a batch: close what is due first
        sessions, events = self.book.close_due(user, wm_us, sessions, events, out)
        sessions, events = self.book.add(user, _whole(rows), wm_us, sessions, events, out)
        self._save(sessions, events, old_timer)
        yield from _frames(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        user = key[0]
        sessions, events = self._load()
        out: list[tuple] = []
        due = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) * 1000
        before = [(len(sessions), s[7]) for s in sessions]
        sessions, events = self.book.close_due(user, due, sessions, events, out)
        if [(len(sessions), s[7]) for s in sessions] != before:
            self._save(sessions, events, None, fired=True)
        elif sessions:
            self.handle.registerTimer(self.book.timer_ms(sessions))
        yield from _frames(out)

    def close(self) -> None:
        pass


#: A bucket's sessions and events as one array for each of their fields, beside the sessions' users.
_GROUP_STATE = T.StructType(
    [T.StructField("owner", T.ArrayType(T.StringType()))]
    + [T.StructField(f.name, T.ArrayType(f.dataType)) for f in [*_SESSION_STATE, *_EVENT_STATE]]
)


def _from_state(columns: tuple) -> tuple[dict, dict]:
    """Each user's sessions and events."""
    sessions: dict = {}
    events: dict = {}
    n = len(_SESSION_STATE) + 1
    for user, *session in zip(*columns[:n]):
        sessions.setdefault(user, []).append(session)
    for event in zip(*columns[n:]):
        e = dict(zip(_EVENT_STATE.names, event))
        events.setdefault(e["user_id"], []).append(e)
    return sessions, events


def _to_state(sessions: dict, events: dict) -> tuple:
    rows = [(user, *s) for user, mine in sessions.items() for s in mine]
    kept = [e for mine in events.values() for e in mine]
    return (*map(list, zip(*rows)), *([e[c] for e in kept] for c in _EVENT_STATE.names))


def _by_user(batch: pd.DataFrame) -> dict:
    """Each user's rows, in the order they came, as column arrays."""
    codes, users = pd.factorize(batch["user_id"].to_numpy(), use_na_sentinel=False)
    order = np.argsort(codes, kind="stable")
    cuts = np.searchsorted(codes[order], np.arange(len(users) + 1))
    columns = {c: batch[c].to_numpy()[order] for c in [*_EVENT_COLS, "t_us", "o_us"]}
    return {u if isinstance(u, str) else None: {c: v[lo:hi] for c, v in columns.items()} for u, lo, hi in zip(users, cuts, cuts[1:])}


def _group_state_fn(book: _SessionBook):
    """``applyInPandasWithState`` engine: a key holds one bucket of users (or one user), the
    state travels with the Arrow batches and the event-time timeout is the first of the
    bucket's due times. Every user gets what they would get alone: their own rows, and
    without rows a call once the watermark is past (not at) their first due time."""

    def run(key, frames, state):
        _quiet_pandas_concat()
        sessions, events = _from_state(state.get) if state.exists else ({}, {})
        wm_ms = state.getCurrentWatermarkMs()
        rows = {} if state.hasTimedOut else _by_user(_whole(frames))
        out: list[tuple] = []
        for user in dict.fromkeys([*sessions, *rows]):
            mine, own = sessions.get(user, []), events.get(user, [])
            if user not in rows and book.timer_ms(mine) >= wm_ms:
                continue
            mine, own = book.close_due(user, wm_ms * 1000, mine, own, out)
            if user in rows:
                mine, own = book.add(user, rows[user], wm_ms * 1000, mine, own, out)
            sessions[user], events[user] = mine, own
        sessions = {user: mine for user, mine in sessions.items() if mine}
        if sessions:
            state.update(_to_state(sessions, events))
            state.setTimeoutTimestamp(min(map(book.timer_ms, sessions.values())))
        else:
            state.remove()
        yield from _frames(out)

    return run


def with_heartbeats(events: DataFrame, heartbeats: DataFrame, time_col: str = "ts") -> DataFrame:
    """A feed's events and its heartbeats (rows with an instant ``ts``), which have nothing but
    ``time_col``; ``beat_us`` is their time and null for events."""
    beat = F.col("ts")
    rows = heartbeats.select(*[(beat if f.name == time_col else F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema], micros(beat).alias("beat_us"))
    return events.withColumn("beat_us", F.lit(None).cast("long")).unionByName(rows)


def without_heartbeats(marked: DataFrame, time_us: Column) -> DataFrame:
    """The events alone. The test reads the watermark's column (``time_us`` comes from it), so
    the optimizer keeps it above the watermark, which has then seen the heartbeats."""
    return marked.where(~F.col("beat_us").eqNullSafe(time_us)).drop("beat_us")


def mark_feed(events: DataFrame, gap: str | int = SESSION_GAP, lateness: str | int = "0 seconds", time_col: str = "ts",
              heartbeats: DataFrame | None = None) -> DataFrame:
    """One feed of valid events with its own watermark, for the union given to
    ``session_panes_stream(..., marked=True)``.

    ``heartbeats`` is a stream of instants ``ts`` up to which the feed is known to be complete
    (``read_heartbeats``, ``clock_heartbeats``): they move the watermark when no events come."""
    gap_us = gap_micros(gap)
    close = F.col(time_col) + F.expr(f"INTERVAL {gap_us} MICROSECONDS")
    feed = events if heartbeats is None else with_heartbeats(events, heartbeats, time_col)
    marked = feed.withColumn("close_ts", close).withWatermark("close_ts", f"{gap_us + gap_micros(lateness)} microseconds")
    return marked if heartbeats is None else without_heartbeats(marked, micros(F.col("close_ts")) - gap_us)


def session_panes_stream(
    events: DataFrame,
    gap: str | int = SESSION_GAP,
    lateness: str | int = "0 seconds",
    per_event: bool = True,
    include_events: bool = False,
    time_col: str = "ts",
    engine: str = "group_state",
    order_col: str | None = None,
    marked: bool = False,
    allowed_lateness: str | int = "0 seconds",
    late_rows: bool = False,
    event_deltas: bool = False,
    buckets: int | None = BUCKETS,
) -> DataFrame:
    """Open and closed panes of a stream of valid events (feed columns plus an instant ``ts``).

    Columns: window_id, user_id, window_start, window_end, total_price (float),
    window_open, event_count, and ``events`` (array of events, null unless
    ``include_events``). Run it in append mode.

    With ``event_deltas``, ``events`` holds only those that came since the session's pane before
    (none in a closed pane), so that each event is put out once and none is kept in the state;
    ``events_of_closed_panes`` rebuilds the sessions' events from the panes.

    ``time_col`` is the session time (sessions, lateness, watermark; in the
    reference, the message's publish time) and ``order_col`` the order time
    (naming, pane bounds, event order; the payload's event time). ``order_col``
    defaults to ``time_col``. ``marked`` says that the events come from feeds marked
    with ``mark_feed`` (same gap, lateness and time column).

    ``lateness`` holds the watermark back for all; ``allowed_lateness`` keeps closed sessions
    for events that come after it, and adds the column ``timing`` (EARLY, ON_TIME, LATE).
    With ``late_rows`` events beyond that come out as rows of their own, whose column ``late``
    holds the event and whose pane columns but user_id are null.

    ``buckets`` is the number of state keys that the users are dealt to (None: one user a
    key); it can't change while a checkpoint lives. The results don't depend on it.
    """
    from tillflow.runtime import require_rocksdb_state

    if event_deltas and (include_events or (order_col or time_col) != time_col or gap_micros(allowed_lateness)):
        raise ValueError("event_deltas takes the place of include_events, with one time for sessions and order and no allowed lateness")
    require_rocksdb_state(events.sparkSession)
    gap_us = gap_micros(gap)
    prepared = (events if marked else mark_feed(events, gap, lateness, time_col)).select(
        *[F.col(c) for c in _EVENT_COLS],
        micros(F.col(time_col)).alias("t_us"),
        micros(F.col(order_col or time_col)).alias("o_us"),
        _unfiltered("close_ts") if late_rows or gap_micros(allowed_lateness) else F.col("close_ts"),
    )
    book = _SessionBook(gap_us, per_event, include_events, gap_micros(allowed_lateness), late_rows, event_deltas)
    if engine == "transform_with_state":
        raw = prepared.groupBy("user_id").transformWithStateInPandas(
            statefulProcessor=SessionPanes(book),
            outputStructType=_RAW_PANE,
            outputMode="Append",
            timeMode="EventTime",
        )
    else:
        key = F.col("user_id") if buckets is None else F.pmod(F.xxhash64("user_id"), F.lit(buckets))
        raw = prepared.withColumn("bucket", key).groupBy("bucket").applyInPandasWithState(
            _group_state_fn(book),
            outputStructType=_RAW_PANE,
            stateStructType=_GROUP_STATE,
            outputMode="append",
            timeoutConf="EventTimeTimeout",
        )
    return raw.select(
        "window_id",
        "user_id",
        F.timestamp_micros("start_us").alias("window_start"),
        F.timestamp_micros("end_us").alias("window_end"),
        F.when(F.col("total_nan"), F.lit(float("nan"))).otherwise(F.col("total_price")).cast("float")
        .alias("total_price"),
        "window_open",
        "event_count",
        "events",
        *(["timing"] if gap_micros(allowed_lateness) else []),
        *(["late"] if late_rows else []),
    )


def events_of_closed_panes(panes: DataFrame, gap: str | int = SESSION_GAP) -> DataFrame:
    """One row per event of each session that has a closed pane: window_id, user_id, window_start,
    event_id, event_time, event_type, price, position (1-based, in (time, id) order) and running_total.

    ``panes`` are all that a stream with ``event_deltas`` and this gap has written, read as a
    table; an empty one gives an empty result. An event meets its session by (user, time bucket
    of one gap); as a session has an event in each gap, it has about two buckets an event at most, and a hot user's
    are many keys. The batch scan then numbers the events, so no session is a single task's.
    """
    gap_us = gap_micros(gap)
    bucket = lambda us: F.floor(us / F.lit(gap_us))
    first, last = micros(F.col("window_start")), micros(F.col("window_end")) + 1000 - gap_us
    closed = panes.where(~F.col("window_open")).select("user_id", F.col("window_id").alias("head"), first.alias("first_us"), last.alias("last_us"))
    closed = closed.withColumn("bucket", F.explode(F.sequence(bucket(F.col("first_us")), bucket(F.col("last_us")))))
    carried = panes.select(F.explode("events").alias("e")).select("e.*").withColumn("ts", parse_iso(F.col("event_time")))
    carried = carried.withColumn("bucket", bucket(micros(F.col("ts"))))
    mine = carried.join(closed, ["user_id", "bucket"]).where(micros(F.col("ts")).between(F.col("first_us"), F.col("last_us")))
    mine = mine.withColumn("session", F.to_json(F.struct("user_id", "first_us", "head")))
    rows = session_event_rows(mine, gap, key="session", extra=("user_id", "event_time", "event_type"))
    return rows.select("window_id", "user_id", "window_start", "event_id", "event_time", "event_type", "price", "position", "running_total")


def _unfiltered(close: str) -> Column:
    """A null column that stands for the watermark's: the stateful operator knows of the
    watermark by it, but Spark's filter finds no row late, so that all rows reach the operator,
    which tells late ones by the current watermark."""
    return F.lit(None).cast("timestamp").alias(close, metadata={"spark.watermarkDelayMs": 0})


def with_rejects(panes: DataFrame, rejected: DataFrame) -> DataFrame:
    """Panes, late events (``session_panes_stream(..., late_rows=True)``) and rejected events
    as one stream for one sink: kind ("panes" or "quarantine"), pane, event, reason."""
    late = F.col("late").isNotNull()
    pane = F.struct(*[c for c in panes.columns if c != "late"])
    out = panes.select(
        F.when(late, "quarantine").otherwise("panes").alias("kind"), F.when(~late, pane).alias("pane"),
        F.col("late").alias("event"), F.when(late, REASON_LATE).alias("reason"),
    )
    others = rejected.select(
        F.lit("quarantine").alias("kind"), F.lit(None).cast(out.schema["pane"].dataType).alias("pane"),
        F.struct(*_EVENT_COLS).alias("event"), "reason",
    )
    return out.unionByName(others)


def as_messages(panes: DataFrame) -> DataFrame:
    """Panes in the published message form: window bounds as ISO-8601 text with
    milliseconds and ``Z`` (``1970-01-01T00:13:59.999Z``), other fields unchanged."""
    return panes.withColumn("window_start", iso_millis(F.col("window_start"))).withColumn(
        "window_end", iso_millis(F.col("window_end"))
    )
