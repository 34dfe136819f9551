"""Batch sources: a sales table scanned for a half-open time range."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillflow.functions.time import as_time_literal


def read_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or files by path (anything with a slash or a scheme)."""
    if "/" in source or ":" in source:
        return spark.read.format(fmt).load(source)
    return spark.table(source)


def range_scan(
    df: DataFrame,
    start: dt.datetime | str | Column,
    end: dt.datetime | str | Column,
    time_col: str = "date_time",
    columns: Sequence[str] = ("user_id", "price"),
) -> DataFrame:
    """Rows with ``start <= time_col < end``, keeping only ``columns``.

    Both bounds are literals of the column's own type, so the two comparisons
    reach the Parquet reader as pushed filters and only ``columns`` plus the time
    column are read (check ``ReadSchema`` / ``PushedFilters`` in ``explain``).
    """
    dtype = df.schema[time_col].dataType
    lo = as_time_literal(start, dtype)
    hi = as_time_literal(end, dtype)
    t = F.col(time_col)
    return df.where((t >= lo) & (t < hi)).select(*columns)
