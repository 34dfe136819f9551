import os

import duckdb
import pytest

import __spark_entry__ as entry

SMOKE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test tables not present")

FAST = ["sales_range_scan", "valid_sales", "weekly_sales", "weekly_sales_union", "weekly_sales_orders",
        "valid_events", "quarantined_events", "user_sessions_24h", "session_events", "session_panes"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["UserID", "TotalSalesInWeek", "StartOfWeek", "EndOfWeek"]


def test_every_query_has_an_oracle():
    own = {n for n in entry.queries() if n not in entry.LLM_QUERIES}
    assert own <= set(entry.oracle_sql()) <= set(entry.queries())


def _norm(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted(tuple(str(v) for v in row) for row in pdf.itertuples(index=False))


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_on_smoke_tables(spark, name):
    con = duckdb.connect()
    for t in ("events", "orders"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    got = entry.queries()[name](spark, SMOKE).toPandas()
    want = con.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    for c in got.columns:
        if str(got[c].dtype).startswith("datetime"):
            got[c] = got[c].astype("datetime64[us]")
            want[c] = want[c].astype("datetime64[us]")
    assert _norm(got) == _norm(want)
