"""Randomised checks: batch sessions equal a brute-force loop for any input and partition count."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from helpers import brute_sessions
from tillflow.operators.sessions import session_event_rows, sessions

EV = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("price", T.DoubleType()),
    ]
)
GAP_US = 600_000_000

events = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c"]),
        # minutes with a sub-second part; many collisions and exact-gap pairs
        st.integers(0, 90).map(lambda m: m * 60_000_000) | st.integers(0, 5_400_000_000),
        st.integers(1, 9999).map(lambda c: c / 100),
    ),
    min_size=1,
    max_size=80,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=events, parts=st.integers(1, 12))
def test_sessions_equal_brute_force(spark, rows, parts):
    pdf = pd.DataFrame(
        [(f"e{i:03d}", u, t, p) for i, (u, t, p) in enumerate(rows)], columns=["event_id", "user_id", "ts", "price"]
    )
    df = spark.createDataFrame(
        [(r.event_id, r.user_id, dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=int(r.ts)), float(r.price))
         for r in pdf.itertuples(index=False)],
        EV,
    )
    want = brute_sessions(pdf, GAP_US)
    got = sessions(df, "10 minutes", partitions=parts).toPandas()
    assert sorted(zip(got.user_id, got.window_id, got.event_count)) == sorted(zip(want.user_id, want.window_id, want.n))
    expect = {eid: (wid, pos) for s in want.itertuples(index=False) for (eid, pos, _r) in s.pos for wid in [s.window_id]}
    rows_got = session_event_rows(df, "10 minutes", partitions=parts).collect()
    assert {r.event_id: (r.window_id, r.position) for r in rows_got} == expect
