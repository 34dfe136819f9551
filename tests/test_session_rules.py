"""The stream's session rules (pure Python) against a plain quadratic loop."""

import random

import pandas as pd

from tillflow.streaming.panes import _SessionBook


def _plain(gap, sessions, rows):
    out = []
    for t, o, eid, p in sorted(rows, key=lambda r: (r[0], r[2])):
        merged = [t, t, eid, p, 1, o, o, False]
        rest = []
        for s in sessions:
            if s[0] - gap < t < s[1] + gap:
                merged[0], merged[1] = min(merged[0], s[0]), max(merged[1], s[1])
                if (s[5], s[2]) < (merged[5], merged[2]):
                    merged[5], merged[2] = s[5], s[2]
                merged[6] = max(merged[6], s[6])
                merged[3] += s[3]
                merged[4] += s[4]
            else:
                rest.append(s)
        sessions = rest + [merged]
        out.append(tuple(merged))
    return sorted(map(tuple, sessions)), out


def test_sorted_merge_equals_plain_loop():
    rng = random.Random(3)
    for _ in range(300):
        gap = rng.choice([5, 10, 30])
        book = _SessionBook(gap, True, False)
        sessions = []
        for _chunk in range(rng.randint(1, 4)):
            rows = [(rng.randint(0, 300), rng.randint(0, 300), f"e{rng.randint(0, 999):03d}", float(rng.randint(1, 9)))
                    for _ in range(rng.randint(1, 40))]
            batch = pd.DataFrame(rows, columns=["t_us", "o_us", "event_id", "price"])
            want_sessions, want_panes = _plain(gap, [list(x) for x in sessions], rows)
            out = []
            sessions, _ = book.add("u", batch, -10**9, [list(x) for x in sessions], [], out)
            assert sorted(map(tuple, sessions)) == want_sessions
            assert [(p[0], p[2], p[3], p[4], p[6]) for p in out] == [(m[2], m[5], m[6], m[3], m[4]) for m in want_panes]


def test_many_open_sessions_stay_fast():
    """A hot user with 20,000 separate sessions in one chunk (a backfill)."""
    import time

    n = 20_000
    batch = pd.DataFrame({"t_us": [i * 100 for i in range(n)], "o_us": [i * 100 for i in range(n)],
                          "event_id": [f"e{i}" for i in range(n)], "price": 1.0})
    book = _SessionBook(10, True, False)
    t0 = time.perf_counter()
    sessions, _ = book.add("u", batch, -10**9, [], [], [])
    assert len(sessions) == n
    assert time.perf_counter() - t0 < 5.0
