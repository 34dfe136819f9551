import datetime as dt
import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import at, brute_sessions
from tillflow.operators.sessions import gap_micros, session_event_rows, session_panes, sessions

EV = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("price", T.DoubleType()),
    ]
)


def _events(spark, rows):
    return spark.createDataFrame(rows, EV)


def test_gap_parsing():
    assert gap_micros("10 minutes") == 600_000_000
    assert gap_micros("24 hours") == 86_400_000_000
    assert gap_micros("1 minute 30 seconds") == 90_000_000
    assert gap_micros(5) == 5


def test_events_exactly_one_gap_apart_are_two_sessions(spark):
    df = _events(spark, [("a", "u", at(0), 1.0), ("b", "u", at(10), 2.0)])
    assert sessions(df, "10 minutes").count() == 2


def test_events_just_under_one_gap_apart_are_one_session(spark):
    df = _events(spark, [("a", "u", at(10), 1.0), ("b", "u", at(19, 59, 999_999), 2.0)])
    rows = sessions(df, "10 minutes").collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.window_id == "a" and r.event_count == 2 and r.total_price == 3.0
    assert r.window_start == at(10) and r.window_end == at(29, 59, 999_999)


def test_ties_in_time_name_the_session_by_smaller_id(spark):
    df = _events(spark, [("b", "u", at(1), 1.0), ("a", "u", at(1), 1.0)])
    assert sessions(df).collect()[0].window_id == "a"


def _hot_user_events(seed=7, n_hot=4000, n_cold=600):
    """One user with most of the rows (several long sessions), plus small users; some tied times."""
    rng = np.random.default_rng(seed)
    hot_t = np.cumsum(rng.choice([0, 30, 90, 240, 700, 1500], size=n_hot, p=[.05, .4, .3, .15, .07, .03]))
    cold_u = rng.integers(0, 40, size=n_cold)
    cold_t = rng.integers(0, hot_t[-1], size=n_cold)
    users = np.r_[np.full(n_hot, "hot"), np.char.add("u", cold_u.astype(str))]
    ts = np.r_[hot_t, cold_t] * 1_000_000
    ids = np.char.add("e", np.arange(n_hot + n_cold).astype(str))
    prices = np.round(rng.uniform(0.5, 50, n_hot + n_cold), 2)
    return pd.DataFrame({"event_id": ids, "user_id": users, "ts": ts, "price": prices})


def _to_spark(spark, pdf):
    rows = [(r.event_id, r.user_id, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(r.ts)), float(r.price))
            for r in pdf.itertuples(index=False)]
    return _events(spark, rows)


@pytest.mark.parametrize("parts", [1, 3, 16, 64])
def test_sessions_match_brute_force_with_a_hot_user(spark, parts):
    pdf = _hot_user_events()
    gap = "10 minutes"
    want = brute_sessions(pdf, gap_micros(gap))
    got = sessions(_to_spark(spark, pdf), gap, partitions=parts).toPandas()
    assert len(got) == len(want)
    got = got.sort_values(["user_id", "window_start"]).reset_index(drop=True)
    want = want.sort_values(["user_id", "first"]).reset_index(drop=True)
    assert list(got.user_id) == list(want.user_id)
    assert list(got.window_id) == list(want.window_id)
    assert list(got.event_count) == list(want.n)
    assert np.allclose(got.total_price, want.total, atol=1e-6)
    epoch = pd.Timestamp("1970-01-01")
    start_us = ((got.window_start - epoch) // pd.Timedelta(microseconds=1)).to_numpy()
    assert list(start_us) == list(want["first"])
    # the hot user really is cut into many partitions' worth of fragments
    assert (got.user_id == "hot").sum() > 5


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_event_rows_match_brute_force_with_a_hot_user(spark, parts):
    pdf = _hot_user_events(seed=11)
    gap = "10 minutes"
    want = brute_sessions(pdf, gap_micros(gap))
    expect = {}
    for s in want.itertuples(index=False):
        for eid, pos, run in s.pos:
            expect[eid] = (s.window_id, pos, run)
    got = session_event_rows(_to_spark(spark, pdf), gap, partitions=parts).toPandas()
    assert len(got) == len(pdf)
    for r in got.itertuples(index=False):
        wid, pos, run = expect[r.event_id]
        assert (r.window_id, r.position) == (wid, pos)
        assert abs(r.running_total - run) < 1e-6


def test_golden_panes_as_a_batch(spark):
    rows = [("a1", "2", at(1), 0.6), ("b1", "2", at(2), 4.0), ("b2", "2", at(3), 30.2), ("b3", "2", at(4), 11.4)]
    df = _events(spark, rows).withColumn("price", F.col("price").cast("float"))
    got = session_panes(df).orderBy("window_open", "window_end").collect()
    closed, opens = got[0], got[1:]
    assert [p.window_end for p in opens] == [at(1), at(2), at(3), at(4)]
    assert np.allclose([p.total_price for p in opens], [0.6, 4.6, 34.8, 46.2], atol=1e-5)
    assert all(p.window_id == "a1" and p.window_start == at(1) and p.window_open for p in opens)
    assert not closed.window_open and closed.window_end == at(13, 59, 999_000)
    assert abs(closed.total_price - 46.2) < 1e-5 and closed.event_count == 4
    assert np.float32(closed.total_price) == np.float32(46.2)


def test_session_plan_shuffles_events_once(spark):
    """Events move once (range exchange, in the written scan); afterwards only edge
    fragments are shuffled, keyed by user, at any number of partitions."""
    from tillflow.operators.sessions import _fragment_scan, _fragment_schema, _narrow, _ranged

    pdf = _hot_user_events(n_hot=50, n_cold=50)
    df = _to_spark(spark, pdf)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        narrow = _narrow(df, "user_id", "ts", "event_id", "price", ())
        scan = _ranged(narrow, 8).mapInArrow(_fragment_scan(600_000_000), _fragment_schema(narrow))
        scan_plan = scan._jdf.queryExecution().executedPlan().toString()
        final_plan, event_plan, pane_plan = (out._jdf.queryExecution().executedPlan().toString()
                                             for out in (sessions(df), session_event_rows(df), session_panes(df)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert scan_plan.count("Exchange rangepartitioning") == 1 and "MapInArrow" in scan_plan
    for plan in (final_plan, event_plan, pane_plan):
        assert "FileScan parquet" in plan and "rangepartitioning" not in plan and "SortMergeJoin" not in plan
    # only edges move, by user: once, or once for each of the two kinds of pane
    assert final_plan.count("Exchange hashpartitioning") == event_plan.count("Exchange hashpartitioning") == 1
    assert pane_plan.count("Exchange hashpartitioning") <= 2 and "Aggregate" not in pane_plan
    for plan in (event_plan, pane_plan):
        kinds = re.findall(r"PushedFilters: \[IsNotNull\(kind\), EqualTo\(kind,(\d)\)", plan)
        assert set(kinds) == ({"0", "1"} if plan is event_plan else {"0", "1", "2"})


def test_session_aggregates_are_hash_based(spark):
    """String-valued fields ride as grouping keys, so no aggregate sorts the events."""
    pdf = _hot_user_events(n_hot=40, n_cold=40)
    df = _to_spark(spark, pdf)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = sessions(df)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan
        for out in (session_event_rows(df), session_panes(df)):
            assert "Aggregate" not in out._jdf.queryExecution().executedPlan().toString()  # the scan sums up
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_copies_of_one_event_spread_over_partitions(spark):
    """A third of all rows (and more) are copies of one event: range partitioning must
    still cut them, and every copy is counted in the one session."""
    from tillflow.operators.sessions import _narrow, _ranged

    rows = [("dup", "hot", at(5), 1.0)] * 3000 + [(f"e{i}", f"u{i % 7}", at(i % 50), 2.0) for i in range(1500)]
    df = _events(spark, rows)
    sizes = (_ranged(_narrow(df, "user_id", "ts", "event_id", "price", ()), 8)
             .groupBy("pid").count().toPandas()["count"])
    assert sizes.max() <= 0.3 * len(rows)
    hot = sessions(df, partitions=8).where("user_id = 'hot'").collect()
    assert [(r.window_id, r.event_count, r.total_price) for r in hot] == [("dup", 3000, 3000.0)]
    pos = sorted(r.position for r in session_event_rows(df, partitions=8).where("user_id = 'hot'").collect())
    assert pos == list(range(1, 3001))


@pytest.mark.parametrize("batch_rows", [1, 7, 64])
def test_sessions_carry_across_arrow_batches(spark, batch_rows):
    """Partitions arrive in many Arrow batches; an open session is carried from one to the next."""
    pdf = _hot_user_events(seed=5, n_hot=600, n_cold=150)
    gap = "10 minutes"
    want = brute_sessions(pdf, gap_micros(gap))
    expect = {eid: (s.window_id, pos, run) for s in want.itertuples(index=False) for (eid, pos, run) in s.pos}
    df = _to_spark(spark, pdf)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    try:
        got = sessions(df, gap, partitions=3).toPandas()
        rows = session_event_rows(df, gap, partitions=3).toPandas()
        panes = session_panes(df, gap, partitions=3).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    closed = panes[~panes.window_open]
    assert sorted(zip(closed.user_id, closed.window_id, closed.event_count)) == sorted(zip(want.user_id, want.window_id, want.n))
    last = panes[panes.window_open].sort_values("event_count").groupby(["user_id", "window_id"]).tail(1)
    assert sorted(zip(closed.user_id, closed.window_id, closed.total_price)) == sorted(zip(last.user_id, last.window_id, last.total_price))
    assert sorted(zip(got.user_id, got.window_id, got.event_count)) == sorted(zip(want.user_id, want.window_id, want.n))
    assert np.allclose(sorted(got.total_price), sorted(want.total), atol=1e-6)
    for r in rows.itertuples(index=False):
        wid, pos, run = expect[r.event_id]
        assert (r.window_id, r.position) == (wid, pos) and abs(r.running_total - run) < 1e-6


def test_degenerate_inputs(spark):
    empty = _events(spark, [])
    assert sessions(empty).count() == 0 and session_event_rows(empty).count() == 0
    one = _events(spark, [("x", "u", at(0), 2.5)])
    r = sessions(one).collect()
    assert [(s.window_id, s.event_count, s.window_start, s.window_end) for s in r] == [("x", 1, at(0), at(10))]
    early = _events(spark, [("a", "u", dt.datetime(1969, 12, 31, 23, 55), 1.0), ("b", "u", at(2), 1.0)])
    assert [(s.window_id, s.event_count) for s in sessions(early).collect()] == [("a", 2)]
    nulls = _events(spark, [("n1", None, at(1), 1.0), ("n2", "u", None, 1.0), ("ok", "u", at(1), 1.0)])
    assert [s.window_id for s in sessions(nulls).collect()] == ["ok"]


def test_null_price_counts_as_zero_nan_propagates(spark):
    df = _events(spark, [("a", "u", at(1), 2.0), ("b", "u", at(2), None), ("c", "v", at(1), float("nan"))])
    got = {r.user_id: r.total_price for r in sessions(df).collect()}
    assert got["u"] == 2.0 and math.isnan(got["v"])
    rows = {r.event_id: r for r in session_event_rows(df).collect()}
    assert rows["a"].running_total == 2.0 and rows["b"].running_total == 2.0
    assert math.isnan(rows["c"].price) and math.isnan(rows["c"].running_total)


@pytest.mark.parametrize("batch_rows", [1, 2, 10_000])
def test_nan_stays_in_the_running_total(spark, batch_rows):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(batch_rows))
    try:
        df = _events(spark, [("a", "u", at(1), 1.0), ("b", "u", at(2), float("nan")), ("c", "u", at(3), 2.0), ("d", "v", at(3), 5.0)])
        running = {r.event_id: r.running_total for r in session_event_rows(df, partitions=2).collect()}
        closed = {r.user_id: r.total_price for r in session_panes(df).where("not window_open").collect()}
        whole = {r.user_id: r.total_price for r in sessions(df).collect()}
    finally:
        spark.conf.set(key, before)
    assert running["a"] == 1.0 and math.isnan(running["b"]) and math.isnan(running["c"]) and running["d"] == 5.0
    assert math.isnan(closed["u"]) and math.isnan(whole["u"]) and closed["v"] == whole["v"] == 5.0


@pytest.mark.parametrize("batch_rows", [1, 10_000])
def test_large_ids_and_nulls_survive(spark, batch_rows):
    big = 9007199254740993
    rows = [(big, 1, at(1), 1.0, big + 2), (None, 1, at(2), 1.0, None), (big + 2, 1, at(3), 1.0, big), (None, big, at(3), 1.0, big), (5, big, at(3), 1.0, None)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, price double, n long")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(batch_rows))
    try:
        got = session_event_rows(df, extra=("n",), partitions=3).collect()
        whole = {r.user_id: (r.window_id, r.event_count) for r in sessions(df, partitions=3).collect()}
    finally:
        spark.conf.set(key, before)
    assert sorted(((r.event_id, r.user_id, r.n) for r in got), key=repr) == sorted(((r[0], r[1], r[4]) for r in rows), key=repr)
    assert {(r.user_id, r.window_id) for r in got} == {(1, big), (big, None)}
    assert whole == {1: (big, 3), big: (None, 2)}
