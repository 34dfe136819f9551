"""Totals with the same bits at every partitioning, against exact rational sums."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import at
from tillflow.functions.sums import LIMIT, exact_sum, joined_of, parts_of
from tillflow.operators.sessions import running_totals, session_event_rows, session_panes, sessions
from tillflow.operators.weekly import side_totals, weekly_sales, weekly_sales_union


def prices(n, seed=5):
    """Prices of very different sizes and both signs, whose plain sums depend on the order."""
    rng = np.random.default_rng(seed)
    return np.round(rng.normal(size=n) * 10.0 ** rng.integers(-1, 9, n), 2)


def nearest(values):
    return float(sum(map(Fraction, values), Fraction(0)))


def bits(rows):
    return sorted(tuple(x.hex() if isinstance(x, float) else x for x in r) for r in rows)


def test_parts_give_the_value_back():
    values = np.r_[prices(5000), 0.0, -0.01, 0.1, 2.0**-60, -(2.0**-60), LIMIT - 0.25, -LIMIT + 0.25, 1.0, -1.0]
    cut, beside = parts_of(values)
    assert joined_of(cut).tolist() == values.tolist() and not beside.any()
    cut, beside = parts_of(np.array([math.nan, math.inf, LIMIT, -LIMIT]))
    assert not cut.any() and np.isnan(beside[0]) and beside[1:].tolist() == [math.inf, LIMIT, -LIMIT]


def test_sums_in_any_order(spark):
    values = prices(4000)
    want = nearest(values)
    assert len({float(np.cumsum(np.random.default_rng(s).permutation(values))[-1]) for s in range(20)}) > 1  # a plain sum would not do
    for s in range(20):
        mixed = np.random.default_rng(s).permutation(values)
        assert math.isclose(float(joined_of(parts_of(mixed)[0].sum(axis=1, keepdims=True))[0]), want, rel_tol=2**-52)
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = {frame.repartition(n).agg(exact_sum(F.col("v"))).first()[0].hex() for n in (1, 3, 16, 64)}
    assert got == {float(joined_of(parts_of(values)[0].sum(axis=1, keepdims=True))[0]).hex()}  # the same in both forms


def test_sums_of_nulls_and_values_beside_the_grid(spark):
    rows = [("null", None), ("one", 0.1), ("one", None), ("nan", 1.0), ("nan", math.nan), ("inf", math.inf), ("inf", 2.0), ("big", LIMIT * 4), ("big", 0.5), ("minus", -0.1), ("zero", 0.5), ("zero", -0.5)]
    got = dict(map(tuple, spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(exact_sum(F.col("v"))).collect()))
    assert math.isnan(got.pop("nan"))
    assert got == {"null": None, "one": 0.1, "inf": math.inf, "big": LIMIT * 4 + 0.5, "minus": -0.1, "zero": 0.0}
    assert spark.createDataFrame([], "v float").agg(exact_sum(F.col("v"))).first()[0] is None


def test_weekly_totals_have_the_same_bits(spark):
    values = prices(3000)
    rows = [(f"u{i % 3}", float(v)) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "user_id string, price double")
    start, end = at(0), at(10)
    forms = [lambda f: side_totals(f), lambda f: weekly_sales(f, f, start, end).select("UserID", "TotalSalesInWeek"), lambda f: weekly_sales_union(f, f, start, end).select("UserID", "TotalSalesInWeek")]
    for form in forms:
        got = [bits(form(frame.orderBy(F.rand(n)).repartition(n)).collect()) for n in (1, 4, 64)]
        assert got[0] == got[1] == got[2]
    decimals = spark.createDataFrame(rows, "user_id string, price double").withColumn("price", F.col("price").cast("decimal(20,2)"))
    assert side_totals(decimals).schema["total"].dataType.simpleString() == "decimal(30,2)"


@pytest.mark.parametrize("odd", [False, True])
def test_session_totals_have_the_same_bits(spark, odd):
    """A hot user whose sessions cross many partitions, with and without prices beside the grid."""
    values = prices(1500)
    if odd:
        values[[40, 900]] = math.nan, LIMIT * 2
    rows = [(f"e{i:04d}", at(i if i % 200 else i + 0.5), "hot" if i % 5 else "b", float(v)) for i, v in enumerate(values)]
    rows = [(e, t if i % 300 else at(i + 9_000), u, v) for i, (e, t, u, v) in enumerate(rows)]
    frame = spark.createDataFrame(rows, "event_id string, ts timestamp, user_id string, price double")
    one = {}
    for n in (1, 4, 64):
        got = {
            "sessions": bits(sessions(frame, partitions=n).select("user_id", "window_id", "event_count", "total_price").collect()),
            "events": bits(session_event_rows(frame, partitions=n).select("event_id", "window_id", "position", "running_total").collect()),
            "running": bits(running_totals(frame, partitions=n).select("window_id", "event_count", "total_price").collect()),
            "panes": bits(session_panes(frame, partitions=n).select("window_id", "window_open", "event_count", "total_price").collect()),
        }
        one = one or got
        assert got == one
    if not odd:
        price = {e: v for e, _, _, v in rows}
        for s in sessions(frame, partitions=7).collect():
            mine = [price[r.event_id] for r in session_event_rows(frame, partitions=3).where((F.col("window_id") == s.window_id) & (F.col("user_id") == s.user_id)).collect()] if s.event_count > 400 else None
            assert mine is None or math.isclose(s.total_price, nearest(mine), rel_tol=2**-52)
