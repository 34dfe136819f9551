"""The same checks written as plain SQL for DuckDB over the raw test tables.

Every statement derives its input from the tables exactly as the Spark side's
adapters do (:mod:`tillflow.sources.testdata`), then applies the operator's rule
the obvious, row-at-a-time way: sessions by gaps and islands with ``lag`` and a
running count, panes by running sums.
"""

from __future__ import annotations

WEEK_START = "TIMESTAMP '2024-01-10 00:00:00'"
WEEK_END = "TIMESTAMP '2024-01-17 00:00:00'"
ORDERS_START = "TIMESTAMP '1996-01-01 00:00:00'"
ORDERS_END = "TIMESTAMP '1997-01-01 00:00:00'"
GAP = "INTERVAL 10 MINUTE"
LONG_GAP = "INTERVAL 24 HOUR"

# Feed rows, validation reason and valid events, as CTEs.
_FEED = """
feed AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CASE WHEN event_type = 'error' THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS event_time,
         CASE WHEN event_type = 'signup' THEN '' ELSE CAST(user_id AS VARCHAR) END AS user_id,
         CAST(CASE WHEN event_type = 'click' THEN 0.0 ELSE value END AS FLOAT) AS price,
         CASE event_type WHEN 'purchase' THEN 'BOOK_SALE' WHEN 'view' THEN 'GROCERY_SALE' ELSE event_type END
           AS event_type,
         ts
  FROM events),
checked AS (
  SELECT *,
         CASE WHEN user_id IS NULL OR user_id = '' THEN 'no user id'
              WHEN event_time IS NULL OR event_time = '' THEN 'no event time'
              WHEN price IS NULL OR price <= 0 THEN 'no price'
              WHEN ts IS NULL THEN 'bad event time' END AS reason
  FROM feed),
valid AS (SELECT event_id, event_time, user_id, price, event_type, ts FROM checked WHERE reason IS NULL)"""


# The same with a third of the rows on one user.
_HOT_FEED = _FEED.replace(
    "ELSE CAST(user_id AS VARCHAR) END AS user_id",
    "WHEN event_id % 3 = 0 THEN '1' ELSE CAST(user_id AS VARCHAR) END AS user_id",
)
# The same with malformed event times, and no time where they are.
_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
_DIRTY_FEED = _FEED.replace(
    f"ELSE {_TIME} END AS event_time",
    f"""WHEN event_id % 20 = 0 THEN ' ' || {_TIME} WHEN event_id % 20 = 1 THEN substr({_TIME}, 12, 8)
              WHEN event_id % 20 = 2 THEN substr({_TIME}, 1, 4) WHEN event_id % 20 = 3 THEN rtrim({_TIME}, 'Z')
              ELSE {_TIME} END AS event_time""",
).replace("WHEN ts IS NULL THEN", "WHEN CAST(event_id AS BIGINT) % 20 < 3 THEN")

# Only the books feed.
_BOOK_FEED = _FEED.replace("WHERE reason IS NULL)", "WHERE reason IS NULL AND event_type = 'BOOK_SALE')")
_HELD = "CAST(event_id AS BIGINT) % 10 = 3"
ALLOWED = "INTERVAL 48 HOUR"


def _late_panes_sql(gap: str, allowed: str) -> str:
    """Closed panes and corrected ones when the held events come after all others: sessions of
    the others, then those still kept together with the held events that are not too late."""
    sessions = f"""SELECT user_id, sid, first(event_id ORDER BY ts, event_id) AS window_id, min(ts) AS window_start,
         max(ts) AS last, max(ts) + {gap} AS ends, sum(CAST(price AS DOUBLE)) AS total, count(*) AS event_count, bool_or(held) AS held"""

    def islands(rows: str, name: str) -> str:
        return f"""{name}_marked AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= {gap} THEN 1 ELSE 0 END AS starts
  FROM {rows} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
{name}_rows AS (
  SELECT * EXCLUDE (starts), sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM {name}_marked),
{name} AS ({sessions} FROM {name}_rows GROUP BY user_id, sid)"""

    pane = "SELECT window_id, user_id, window_start, {} AS window_end, round(CAST(CAST(total AS FLOAT) AS DOUBLE), 2) AS total_price, {} AS window_open, event_count, {} AS timing"
    closed = pane.format("ends - INTERVAL 1 MILLISECOND", "false", "'ON_TIME'")
    return f"""WITH {_FEED},
dealt AS (SELECT *, {_HELD} AS held FROM valid),
marks AS (SELECT date_trunc('millisecond', max(ts) FILTER (NOT held)) AS w1, date_trunc('millisecond', max(ts)) AS w2 FROM dealt),
others AS (SELECT * FROM dealt WHERE NOT held),
{islands("others", "early")},
kept AS (
  SELECT r.* EXCLUDE (sid) FROM early_rows r JOIN early s USING (user_id, sid), marks WHERE s.ends + {allowed} > w1
  UNION ALL SELECT dealt.* FROM dealt, marks WHERE held AND ts + {gap} + {allowed} > w1),
{islands("kept", "final")}
{closed} FROM early, marks WHERE ends <= w1
UNION ALL {pane.format("last", "true", "'LATE'")} FROM final, marks WHERE held AND ends <= w1
UNION ALL {closed} FROM final, marks WHERE ends > w1 AND ends <= w2"""


def _exact(value: str) -> str:
    """The sum of a double in the bits that ``functions.sums`` gives: whole numbers on its grid, joined once."""
    amount = f"abs(CAST({value} AS DOUBLE))"
    parts = [f"floor({amount})"]
    left = f"({amount} - {parts[0]})"
    for _ in range(3):
        parts.append(f"floor({left} * 1048576)")
        left = f"({left} * 1048576 - {parts[-1]})"
    sums = [f"coalesce(sum(CAST(sign({value}) * {p} AS HUGEINT)), 0)" for p in parts]
    units = " + ".join(f"{x} * CAST({1 << 20 * (3 - j)} AS HUGEINT)" for j, x in enumerate(sums))
    one = f"CAST({1 << 60} AS HUGEINT)"
    return f"sign({units}) * (CAST(abs({units}) // {one} AS DOUBLE) + CAST(abs({units}) % {one} AS DOUBLE) / {float(1 << 60)!r})"


def _islands(gap: str, feed: str = _FEED) -> str:
    return f"""{feed},
marked AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= {gap} THEN 1 ELSE 0 END AS starts
  FROM valid WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM marked),
sess AS (
  SELECT user_id, sid,
         first(event_id ORDER BY ts, event_id) AS window_id,
         min(ts) AS window_start,
         max(ts) + {gap} AS window_end,
         max(ts) AS last_event_time,
         sum(CAST(price AS DOUBLE)) AS total,
         count(*) AS event_count
  FROM numbered GROUP BY user_id, sid),
ev AS (
  SELECT user_id, sid, event_id, ts, price, event_type,
         first_value(event_id) OVER s AS window_id,
         min(ts) OVER (PARTITION BY user_id, sid) AS window_start,
         row_number() OVER s AS position,
         sum(CAST(price AS DOUBLE)) OVER (PARTITION BY user_id, sid ORDER BY ts, event_id
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total
  FROM numbered WINDOW s AS (PARTITION BY user_id, sid ORDER BY ts, event_id))"""


def _sessions_sql(gap: str, where: str = "", feed: str = _FEED) -> str:
    return f"""WITH {_islands(gap, feed)}
SELECT user_id, window_id, window_start, window_end, last_event_time,
       round(total, 2) AS total_price, event_count
FROM sess {where}"""


def _open_panes_sql(gap: str) -> str:
    return f"""WITH {_islands(gap)}
SELECT window_id, user_id, window_start, ts AS window_end,
       round(CAST(CAST(running_total AS FLOAT) AS DOUBLE), 2) AS total_price,
       true AS window_open, position AS event_count
FROM ev"""


def _panes_sql(gap: str, closed_where: str = "") -> str:
    return f"""{_open_panes_sql(gap)}
UNION ALL
SELECT window_id, user_id, window_start, window_end - INTERVAL 1 MILLISECOND AS window_end,
       round(CAST(CAST(total AS FLOAT) AS DOUBLE), 2) AS total_price,
       false AS window_open, event_count
FROM sess {closed_where}"""


def _pane_messages_sql(gap: str, closed_where: str) -> str:
    iso = "strftime({}, '%Y-%m-%dT%H:%M:%S.%gZ')"
    return f"""WITH {_islands(gap)}
SELECT window_id, user_id, {iso.format("window_start")} AS window_start, {iso.format("ts")} AS window_end,
       round(CAST(CAST(running_total AS FLOAT) AS DOUBLE), 2) AS total_price,
       true AS window_open, position AS event_count
FROM ev
UNION ALL
SELECT window_id, user_id, {iso.format("window_start")} AS window_start,
       {iso.format("window_end - INTERVAL 1 MILLISECOND")} AS window_end,
       round(CAST(CAST(total AS FLOAT) AS DOUBLE), 2) AS total_price,
       false AS window_open, event_count
FROM sess {closed_where}"""


def _side(event_type: str, total: str = "sum(value)") -> str:
    return f"""SELECT user_id, {total} AS t FROM events
  WHERE event_type = '{event_type}' AND ts >= {WEEK_START} AND ts < {WEEK_END}
    AND user_id IS NOT NULL AND value IS NOT NULL
  GROUP BY user_id"""


def _weekly(user_expr: str = "coalesce(b.user_id, g.user_id)") -> str:
    return f"""WITH b AS ({_side('purchase')}), g AS ({_side('view')})
SELECT {user_expr} AS UserID,
       round(coalesce(b.t, 0) + coalesce(g.t, 0), 2) AS TotalSalesInWeek,
       {WEEK_START} AS StartOfWeek, {WEEK_END} AS EndOfWeek
FROM b FULL OUTER JOIN g ON b.user_id = g.user_id"""


def _orders_side(priority: str) -> str:
    return f"""SELECT o_custkey AS user_id, sum(o_totalprice) AS t FROM orders
  WHERE o_orderpriority = '{priority}' AND o_orderdate >= {ORDERS_START} AND o_orderdate < {ORDERS_END}
    AND o_custkey IS NOT NULL AND o_totalprice IS NOT NULL
  GROUP BY o_custkey"""


_MAX_TS = "(SELECT max(ts) FROM valid)"

SQL = {
    "sales_range_scan": f"""SELECT user_id, value AS price FROM events
WHERE event_type = 'purchase' AND ts >= {WEEK_START} AND ts < {WEEK_END}""",
    "valid_sales": """WITH raw AS (
  SELECT CASE WHEN event_type <> 'signup' THEN user_id END AS user_id,
         CASE WHEN event_type <> 'error' THEN value END AS price
  FROM events)
SELECT user_id, price FROM raw WHERE user_id IS NOT NULL AND price IS NOT NULL""",
    "book_totals": f"SELECT user_id, round(t, 2) AS total FROM ({_side('purchase')})",
    "grocery_totals": f"SELECT user_id, round(t, 2) AS total FROM ({_side('view')})",
    "exact_book_totals": f"SELECT user_id, t AS total FROM ({_side('purchase', _exact('value'))})",
    "exact_session_totals": f"""WITH {_islands(LONG_GAP)}
SELECT user_id, window_id, {_exact('price')} AS total_price FROM ev GROUP BY user_id, sid, window_id""",
    "weekly_sales": _weekly(),
    "weekly_sales_union": _weekly(),
    "weekly_sales_orders": f"""WITH b AS ({_orders_side('1-URGENT')}), g AS ({_orders_side('2-HIGH')})
SELECT coalesce(b.user_id, g.user_id) AS UserID,
       round(coalesce(b.t, 0) + coalesce(g.t, 0), 2) AS TotalSalesInWeek,
       {ORDERS_START} AS StartOfWeek, {ORDERS_END} AS EndOfWeek
FROM b FULL OUTER JOIN g ON b.user_id = g.user_id""",
    "appended_weekly_sales": _weekly("CAST(coalesce(b.user_id, g.user_id) AS VARCHAR)"),
    "all_events": f"""WITH {_FEED}
SELECT event_id, event_time, user_id, round(CAST(price AS DOUBLE), 2) AS price, event_type FROM feed""",
    "valid_events": f"""WITH {_FEED}
SELECT event_id, event_time, user_id, round(CAST(price AS DOUBLE), 2) AS price, event_type, ts FROM valid""",
    "quarantined_events": f"""WITH {_FEED}
SELECT event_id, event_time, user_id, round(CAST(price AS DOUBLE), 2) AS price, event_type, reason
FROM checked WHERE reason IS NOT NULL""",
    "decoded_events": f"""WITH {_FEED}
SELECT event_id, event_time, user_id, round(CAST(price AS DOUBLE), 2) AS price, event_type, ts FROM valid""",
    "streamed_quarantine": f"""WITH {_FEED}
SELECT event_id, event_time, user_id, round(CAST(price AS DOUBLE), 2) AS price, event_type, reason
FROM checked WHERE reason IS NOT NULL""",
    "user_sessions": _sessions_sql(GAP),
    "user_sessions_24h": _sessions_sql(LONG_GAP),
    "session_events": f"""WITH {_islands(LONG_GAP)}
SELECT user_id, window_id, window_start, event_id, ts, round(CAST(price AS DOUBLE), 2) AS price,
       position, round(running_total, 2) AS running_total, event_type
FROM ev""",
    "running_session_totals": _open_panes_sql(LONG_GAP),
    "session_panes": _panes_sql(LONG_GAP),
    "streamed_sessions": _sessions_sql(GAP, f"WHERE window_end <= {_MAX_TS} - {GAP}"),
    "streamed_panes": _panes_sql(GAP, f"WHERE window_end <= {_MAX_TS}"),
    "streamed_pane_messages": _pane_messages_sql(GAP, f"WHERE window_end <= {_MAX_TS}"),
    "quarantined_dirty_events": f"""WITH {_DIRTY_FEED}
SELECT event_id, event_time, user_id, round(CAST(price AS DOUBLE), 2) AS price, event_type, reason
FROM checked WHERE reason IS NOT NULL""",
    "quarantined_messages": f"""WITH {_FEED},
cut AS (SELECT *, CAST(event_id AS BIGINT) % 13 IN (5, 6) AS bad FROM checked)
SELECT CASE WHEN NOT bad THEN event_id END AS event_id, CASE WHEN NOT bad THEN event_time END AS event_time,
       CASE WHEN NOT bad THEN user_id END AS user_id, CASE WHEN NOT bad THEN round(CAST(price AS DOUBLE), 2) END AS price,
       CASE WHEN NOT bad THEN event_type END AS event_type,
       CASE CAST(event_id AS BIGINT) % 13 WHEN 5 THEN '{{"event_id":"' || event_id WHEN 6 THEN '' END AS bad_payload,
       CASE WHEN bad THEN 'bad message' ELSE reason END AS reason
FROM cut WHERE bad OR reason IS NOT NULL""",
    "hot_user_sessions": _sessions_sql(GAP, feed=_HOT_FEED),
    "hot_user_session_events": f"""WITH {_islands(LONG_GAP, _HOT_FEED)}
SELECT user_id, window_id, window_start, event_id, ts, round(CAST(price AS DOUBLE), 2) AS price,
       position, round(running_total, 2) AS running_total, event_type
FROM ev""",
    "streamed_panes_24h": _panes_sql(LONG_GAP, f"WHERE window_end <= {_MAX_TS}"),
    "streamed_session_events": f"""WITH {_islands(LONG_GAP)}
SELECT ev.window_id, ev.user_id, position, event_id, event_time, round(CAST(price AS DOUBLE), 2) AS price, event_type
FROM (SELECT ev.*, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time FROM ev) ev JOIN sess USING (user_id, sid)
WHERE window_end <= {_MAX_TS}""",
    "streamed_event_deltas": f"""WITH {_islands(LONG_GAP)}
SELECT ev.window_id, ev.user_id, position, event_id, event_time, round(CAST(price AS DOUBLE), 2) AS price, event_type
FROM (SELECT ev.*, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time FROM ev) ev JOIN sess USING (user_id, sid)
WHERE window_end <= {_MAX_TS}""",
    "streamed_panes_two_feeds": f"""WITH {_islands(LONG_GAP)}
SELECT window_id, user_id, window_start, window_end - INTERVAL 1 MILLISECOND AS window_end,
       round(CAST(CAST(total AS FLOAT) AS DOUBLE), 2) AS total_price, false AS window_open, event_count
FROM sess WHERE window_end <= least((SELECT max(ts) FROM valid WHERE event_type = 'BOOK_SALE'),
                                    (SELECT max(ts) FROM valid WHERE event_type <> 'BOOK_SALE'))""",
    "streamed_closed_panes": f"""WITH {_islands(GAP)}
SELECT window_id, user_id, window_start, window_end - INTERVAL 1 MILLISECOND AS window_end,
       round(CAST(CAST(total AS FLOAT) AS DOUBLE), 2) AS total_price, false AS window_open, event_count
FROM sess WHERE window_end <= {_MAX_TS} - {GAP}""",
    "streamed_panes_idle_feed": f"""WITH {_islands(LONG_GAP, _BOOK_FEED)}
SELECT window_id, user_id, window_start, window_end - INTERVAL 1 MILLISECOND AS window_end,
       round(CAST(CAST(total AS FLOAT) AS DOUBLE), 2) AS total_price, false AS window_open, event_count
FROM sess WHERE window_end <= least({_MAX_TS}, (SELECT max(ts) FROM events WHERE event_type = 'error'))""",
    "streamed_late_events": f"""WITH {_FEED},
mark AS (SELECT date_trunc('millisecond', max(ts)) AS w FROM valid WHERE NOT {_HELD})
SELECT event_id, event_time, user_id, round(CAST(price AS DOUBLE), 2) AS price, event_type, coalesce(reason, 'late') AS reason
FROM checked, mark WHERE reason IS NOT NULL OR ({_HELD} AND ts + {LONG_GAP} <= w)""",
    "streamed_panes_lateness": _late_panes_sql(LONG_GAP, ALLOWED),
}
