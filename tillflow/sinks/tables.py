"""Append to an existing table with a fixed schema; never create it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tillflow.functions.time import ntz_to_instant
from tillflow.schemas import WEEKLY_SALES


def _to(col: Column, src: T.DataType, dst: T.DataType) -> Column:
    if isinstance(src, T.TimestampNTZType) and isinstance(dst, T.TimestampType):
        return ntz_to_instant(col)  # wall clock read as UTC, not as the session zone
    return col.cast(dst)


def conform(df: DataFrame, schema: T.StructType = WEEKLY_SALES) -> DataFrame:
    """Columns of ``schema``, in its order and types, taken from ``df`` by name."""
    return df.select(*[_to(F.col(f.name), df.schema[f.name].dataType, f.dataType).alias(f.name) for f in schema])


def append_to_table(df: DataFrame, table: str, schema: T.StructType = WEEKLY_SALES) -> None:
    """Append ``df`` to the existing ``table``.

    The table is never created: a missing table fails with
    ``TABLE_OR_VIEW_NOT_FOUND``. Re-running for the same period appends again
    (no deduplication). Columns are matched by name, whatever the table's order.
    """
    df.sparkSession.sql("INSERT INTO IDENTIFIER(:target) BY NAME SELECT * FROM {rows}", args={"target": table}, rows=conform(df, schema))
