import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions.time import week_bounds
from tillflow.operators.cleaning import valid_sales
from tillflow.operators.weekly import weekly_sales, weekly_sales_union
from tillflow.plans.weekly_job import run_weekly_job, weekly_result
from tillflow.schemas import WEEKLY_SALES
from tillflow.sinks.tables import append_to_table
from tillflow.sources.tables import range_scan

SALE = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("price", T.DoubleType())])
RAW = T.StructType(list(SALE.fields) + [T.StructField("date_time", T.TimestampType())])


def test_week_bounds_end_at_midnight_exclusive():
    start, end = week_bounds(dt.datetime(2024, 1, 17, 15, 30))
    assert end == dt.datetime(2024, 1, 17) and start == dt.datetime(2024, 1, 10)


def test_golden_weekly_total(spark):
    end = dt.datetime.combine(dt.date.today(), dt.time())
    start = end - dt.timedelta(days=7)
    books = valid_sales(spark.createDataFrame([("1", 20.1), ("1", 20.0)], SALE))
    groceries = valid_sales(spark.createDataFrame([("1", 85.0)], SALE))
    rows = weekly_sales(books, groceries, start, end).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.UserID == "1" and abs(r.TotalSalesInWeek - 125.1) < 1e-9
    assert r.StartOfWeek == start and r.EndOfWeek == end


def test_one_sided_users_are_kept(spark):
    start, end = week_bounds(dt.date(2024, 1, 17))
    books = spark.createDataFrame([("a", 1.0)], SALE)
    groceries = spark.createDataFrame([("b", 2.0)], SALE)
    got = {r.UserID: r.TotalSalesInWeek for r in weekly_sales(books, groceries, start, end).collect()}
    assert got == {"a": 1.0, "b": 2.0}
    got_union = {r.UserID: r.TotalSalesInWeek for r in weekly_sales_union(books, groceries, start, end).collect()}
    assert got_union == got


def test_join_form_needs_no_exchange_beyond_the_two_aggregates(spark):
    start, end = week_bounds(dt.date(2024, 1, 17))
    books = spark.range(1000).select(F.col("id").cast("string").alias("user_id"), F.lit(1.0).alias("price"))
    groceries = spark.range(500).select(F.col("id").cast("string").alias("user_id"), F.lit(2.0).alias("price"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = weekly_sales(books, groceries, start, end)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_sum" in plan


def test_range_scan_is_half_open_and_pushed_down(spark, workdir):
    rows = [("1", 1.0, dt.datetime(2024, 1, 9, 23, 59)), ("1", 2.0, dt.datetime(2024, 1, 10)),
            ("2", 4.0, dt.datetime(2024, 1, 16, 23, 59)), ("2", 8.0, dt.datetime(2024, 1, 17))]
    path = os.path.join(workdir, "books")
    spark.createDataFrame(rows, RAW).write.parquet(path)
    df = spark.read.parquet(path)
    start, end = week_bounds(dt.date(2024, 1, 17))
    scan = range_scan(df, start, end)
    assert sorted(r.price for r in scan.collect()) == [2.0, 4.0]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(date_time), GreaterThanOrEqual(date_time" in plan
    assert "LessThan(date_time" in plan
    assert "ReadSchema: struct<user_id:string,price:double,date_time:timestamp>" in plan


def test_weekly_job_appends_to_existing_table(spark, workdir):
    rows = [("1", 20.1, dt.datetime(2024, 1, 12)), ("1", 20.0, dt.datetime(2024, 1, 13)),
            (None, 5.0, dt.datetime(2024, 1, 13)), ("3", 7.0, dt.datetime(2024, 1, 2))]
    books, groceries = os.path.join(workdir, "b"), os.path.join(workdir, "g")
    spark.createDataFrame(rows, RAW).write.parquet(books)
    spark.createDataFrame([("1", 85.0, dt.datetime(2024, 1, 16))], RAW).write.parquet(groceries)
    table = "weekly_" + os.path.basename(workdir).replace("-", "_")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in WEEKLY_SALES)
    spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet LOCATION '{os.path.join(workdir, 'out')}'")
    run_weekly_job(spark, books, groceries, table, as_of=dt.date(2024, 1, 17))
    run_weekly_job(spark, books, groceries, table, as_of=dt.date(2024, 1, 17))  # appends again
    out = spark.table(table).collect()
    assert len(out) == 2
    assert all(r.UserID == "1" and abs(r.TotalSalesInWeek - 125.1) < 1e-9 for r in out)
    assert out[0].EndOfWeek == dt.datetime(2024, 1, 17) and out[0].StartOfWeek == dt.datetime(2024, 1, 10)


def test_append_to_missing_table_fails(spark):
    start, end = week_bounds(dt.date(2024, 1, 17))
    df = weekly_result(
        spark.createDataFrame([("1", 1.0, dt.datetime(2024, 1, 12))], RAW),
        spark.createDataFrame([("2", 1.0, dt.datetime(2024, 1, 12))], RAW),
        start, end,
    )
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_NOT_FOUND"):
        append_to_table(df, "no_such_weekly_table")


def test_default_week_ends_at_todays_midnight_utc():
    start, end = week_bounds()
    today = dt.datetime.now(dt.timezone.utc).date()
    assert end == dt.datetime(today.year, today.month, today.day)
    assert end - start == dt.timedelta(days=7)


def test_append_matches_columns_by_name(spark, workdir):
    table = "weekly_order_" + os.path.basename(workdir).replace("-", "_")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in WEEKLY_SALES)
    spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet LOCATION '{os.path.join(workdir, 't')}'")
    start, end = week_bounds(dt.date(2024, 1, 17))
    df = spark.createDataFrame([(end, start, 3.5, "u1")], "EndOfWeek timestamp, StartOfWeek timestamp, "
                                                          "TotalSalesInWeek double, UserID string")
    append_to_table(df, table)
    r = spark.table(table).first()
    assert (r.UserID, r.TotalSalesInWeek, r.StartOfWeek, r.EndOfWeek) == ("u1", 3.5, start, end)


def test_weekly_job_command_line(spark, workdir):
    from tillflow.plans.weekly_job import main

    rows = [("1", 20.1, dt.datetime(2024, 1, 12)), ("1", 20.0, dt.datetime(2024, 1, 13))]
    books, groceries = os.path.join(workdir, "b"), os.path.join(workdir, "g")
    spark.createDataFrame(rows, RAW).write.parquet(books)
    spark.createDataFrame([("1", 85.0, dt.datetime(2024, 1, 16))], RAW).write.parquet(groceries)
    table = "weekly_cli_" + os.path.basename(workdir).replace("-", "_")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in WEEKLY_SALES)
    spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet LOCATION '{os.path.join(workdir, 'out')}'")
    main(["--books", books, "--groceries", groceries, "--output", table, "--as-of", "2024-01-17"])
    r = spark.table(table).collect()
    assert [(x.UserID, round(x.TotalSalesInWeek, 6)) for x in r] == [("1", 125.1)]


def test_append_by_name_to_a_table_with_other_column_order(spark, workdir):
    table = "weekly_permuted_" + os.path.basename(workdir).replace("-", "_")
    spark.sql(f"CREATE TABLE {table} (UserID string, TotalSalesInWeek double, EndOfWeek timestamp, StartOfWeek timestamp) "
              f"USING parquet LOCATION '{os.path.join(workdir, 't')}'")
    start, end = week_bounds(dt.date(2024, 1, 17))
    df = spark.createDataFrame([(end, start, 3.5, "u1")], "EndOfWeek timestamp, StartOfWeek timestamp, TotalSalesInWeek double, UserID string")
    append_to_table(df, table)
    append_to_table(df, table)
    assert [(r.UserID, r.StartOfWeek, r.EndOfWeek) for r in spark.table(table).collect()] == [("u1", start, end)] * 2


def test_sales_columns_of_other_names(spark):
    start, end = week_bounds(dt.date(2024, 1, 17))
    rows = [("1", 2.0, dt.datetime(2024, 1, 12)), (None, 1.0, dt.datetime(2024, 1, 12)), ("1", None, dt.datetime(2024, 1, 12))]
    sales = spark.createDataFrame(rows, "UserID string, Price double, SoldAt timestamp")
    got = weekly_result(sales, sales, start, end, "SoldAt", "UserID", "Price").collect()
    assert [(r.UserID, r.TotalSalesInWeek) for r in got] == [("1", 4.0)]
