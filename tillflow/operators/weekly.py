"""Weekly sales per user over two sales tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tillflow.functions.sums import exact_sum
from tillflow.functions.time import as_time_literal


def _total(sales: DataFrame) -> Column:
    """Sum of the prices: doubles and floats in the same bits at every partitioning; other types as Spark adds them."""
    floating = isinstance(sales.schema["price"].dataType, (T.DoubleType, T.FloatType))
    return exact_sum(F.col("price")) if floating else F.sum("price")


def side_totals(sales: DataFrame, total_col: str = "total") -> DataFrame:
    """Total price per user of one table.

    Plans as partial ``sum`` per input partition, one exchange on ``user_id``,
    final ``sum``: a user with a third of all rows sends one partial row per
    input partition, never its rows.
    """
    return sales.groupBy("user_id").agg(_total(sales).alias(total_col))


def _bound(value, dtype: T.DataType) -> Column:
    return as_time_literal(value, dtype)


def _weekly_row(user: Column, total: Column, start, end, time_type: T.DataType) -> list[Column]:
    return [
        user.alias("UserID"),
        total.alias("TotalSalesInWeek"),
        _bound(start, time_type).alias("StartOfWeek"),
        _bound(end, time_type).alias("EndOfWeek"),
    ]


def weekly_sales(
    books: DataFrame,
    groceries: DataFrame,
    start: dt.datetime | Column,
    end: dt.datetime | Column,
    time_type: T.DataType = T.TimestampType(),
) -> DataFrame:
    """Per user: total of both tables for the week, with the week bounds.

    Each side is aggregated first, then the two are full-outer joined on the
    user; a side with no rows counts as 0. The sort-merge join reuses both
    aggregates' hash partitioning on ``user_id``, so there is no third exchange.
    Users with rows on one side only are kept; users with rows on neither are absent.
    """
    b = side_totals(books, "books_total")
    g = side_totals(groceries, "groceries_total")
    joined = b.join(g, "user_id", "full_outer")
    total = F.coalesce(F.col("books_total"), F.lit(0.0)) + F.coalesce(F.col("groceries_total"), F.lit(0.0))
    return joined.select(*_weekly_row(F.col("user_id"), total, start, end, time_type))


def weekly_sales_union(
    books: DataFrame,
    groceries: DataFrame,
    start: dt.datetime | Column,
    end: dt.datetime | Column,
    time_type: T.DataType = T.TimestampType(),
) -> DataFrame:
    """Same result as :func:`weekly_sales` with one exchange: union, then one grouped sum."""
    both = books.select("user_id", "price").unionByName(groceries.select("user_id", "price"))
    totals = both.groupBy("user_id").agg(_total(both).alias("total"))
    return totals.select(*_weekly_row(F.col("user_id"), F.col("total"), start, end, time_type))
