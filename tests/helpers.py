"""Test helpers: brute-force sessions and file replay for streams."""

from __future__ import annotations

import datetime as dt
import os

import pandas as pd

from tillflow.schemas import EVENT

BASE = dt.datetime(1970, 1, 1)


def at(minutes: float = 0, seconds: float = 0, micros: int = 0) -> dt.datetime:
    return BASE + dt.timedelta(minutes=minutes, seconds=seconds, microseconds=micros)


def iso(t: dt.datetime) -> str:
    return t.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


def event(eid: str, t: dt.datetime | str, user: str = "2", price: float = 1.0, etype: str = "GROCERY_SALE"):
    return (eid, t if isinstance(t, str) else iso(t), user, price, etype)


def brute_sessions(pdf: pd.DataFrame, gap_us: int) -> pd.DataFrame:
    """Reference sessions by a plain sort and loop (user_id, ts as int micros, event_id, price)."""
    rows = []
    pdf = pdf.sort_values(["user_id", "ts", "event_id"]).reset_index(drop=True)
    cur = None
    for r in pdf.itertuples(index=False):
        if cur is not None and cur["user_id"] == r.user_id and r.ts - cur["last"] < gap_us:
            cur["last"] = r.ts
            cur["n"] += 1
            cur["total"] += r.price
            cur["pos"].append((r.event_id, cur["n"], cur["total"]))
        else:
            if cur is not None:
                rows.append(cur)
            cur = {"user_id": r.user_id, "first": r.ts, "last": r.ts, "window_id": r.event_id, "n": 1,
                   "total": r.price, "pos": [(r.event_id, 1, r.price)]}
    if cur is not None:
        rows.append(cur)
    return pd.DataFrame(rows)


def replay_dir(spark, root: str, batches: list[list[tuple]], schema=EVENT) -> str:
    """One Parquet file per micro-batch, with increasing modification times."""
    src = os.path.join(root, "feed")
    os.makedirs(src, exist_ok=True)
    for i, rows in enumerate(batches):
        tmp = os.path.join(root, f"stage{i}")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(tmp)
        for name in sorted(os.listdir(tmp)):
            if name.endswith(".parquet"):
                dst = os.path.join(src, f"batch{i:04d}.parquet")
                os.link(os.path.join(tmp, name), dst)
                os.utime(dst, (1_000_000 + i, 1_000_000 + i))
    return src
