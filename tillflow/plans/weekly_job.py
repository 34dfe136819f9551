"""Weekly sales job: scan two sales tables for the week, clean, total, append."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tillflow.functions.time import week_bounds
from tillflow.operators.cleaning import valid_sales
from tillflow.operators.weekly import weekly_sales
from tillflow.sinks.tables import append_to_table
from tillflow.sources.tables import range_scan, read_table


def weekly_result(books: DataFrame, groceries: DataFrame, start: dt.datetime, end: dt.datetime,
                  time_col: str = "date_time", user_col: str = "user_id", price_col: str = "price") -> DataFrame:
    """The weekly rows for two raw sales tables with the given user, price and time columns."""
    time_type = books.schema[time_col].dataType
    side = lambda rows: valid_sales(range_scan(rows, start, end, time_col, (user_col, price_col)), user_col, price_col)
    b, g = side(books), side(groceries)
    return weekly_sales(b, g, start, end, time_type)


def run_weekly_job(spark: SparkSession, books_source: str, groceries_source: str, output_table: str,
                   as_of: dt.date | dt.datetime | None = None, days: int = 7, time_col: str = "date_time",
                   user_col: str = "user_id", price_col: str = "price") -> None:
    """Total last week's sales per user and append them to ``output_table``.

    The week ends (exclusive) at midnight of ``as_of`` (default: today, UTC) and
    starts ``days`` earlier. The output table must already exist. ``user_col``,
    ``price_col`` and ``time_col`` name the sales tables' columns.
    """
    start, end = week_bounds(as_of, days)
    books = read_table(spark, books_source)
    groceries = read_table(spark, groceries_source)
    append_to_table(weekly_result(books, groceries, start, end, time_col, user_col, price_col), output_table)


def main(argv: list[str] | None = None) -> None:
    """``python -m tillflow.plans.weekly_job --books T1 --groceries T2 --output T3 [--as-of YYYY-MM-DD]``"""
    import argparse

    from tillflow.runtime import build_session

    ap = argparse.ArgumentParser(description="Append last week's sales per user to an existing table.")
    ap.add_argument("--books", required=True, help="book sales table name or path")
    ap.add_argument("--groceries", required=True, help="grocery sales table name or path")
    ap.add_argument("--output", required=True, help="existing weekly sales table")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, default=None, help="week ends at this midnight (UTC)")
    ap.add_argument("--days", type=int, default=7)
    ap.add_argument("--time-col", default="date_time")
    ap.add_argument("--user-col", default="user_id", help="the sales tables' user column, such as UserID")
    ap.add_argument("--price-col", default="price", help="the sales tables' price column, such as Price")
    args = ap.parse_args(argv)
    spark = build_session()
    run_weekly_job(spark, args.books, args.groceries, args.output, args.as_of, args.days, args.time_col,
                   args.user_col, args.price_col)


if __name__ == "__main__":
    main()
