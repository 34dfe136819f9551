"""Print the formatted physical plan of registered batch queries.

Usage: python scripts/show_plans.py [sf_dir] [name ...]

Shows what reaches the Parquet scan (PushedFilters, ReadSchema), the exchanges
and the aggregate strategy. Stream queries run when built, so they are skipped.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillflow.plans.queries import QUERIES  # noqa: E402
from tillflow.runtime import build_session  # noqa: E402

STREAMED = {"streamed_sessions", "streamed_panes", "streamed_quarantine", "appended_weekly_sales"}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or [n for n in QUERIES if n not in STREAMED]
    spark = build_session("local[8]")
    for name in names:
        print("=" * 30, name)
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
