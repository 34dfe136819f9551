"""Adapters that present the driver's test tables as the job's inputs.

The tables hold no nulls, no empty text and no non-positive values, so the
adapters derive the dirt the validators must remove from the rows' own
event type, the same way on the Spark side and in the SQL oracle:

* a ``signup`` event has no buyer yet: no user id;
* an ``error`` event lost its payload: no price (batch) / no event time (feed);
* a ``click`` is not a sale: price 0, the feed's reading of a missing price.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tillflow.functions.time import iso_micros_of_ntz
from tillflow.schemas import BOOK_SALE, GROCERY_SALE

# How the test tables stand in for the reference's inputs.
BOOKS_EVENT_TYPE = "purchase"
GROCERIES_EVENT_TYPE = "view"
NO_USER_EVENT_TYPE = "signup"
NO_PAYLOAD_EVENT_TYPE = "error"
NOT_A_SALE_EVENT_TYPE = "click"
EVENTS_WEEK_AS_OF = dt.date(2024, 1, 17)  # week [2024-01-10, 2024-01-17)
ORDERS_BOOKS_PRIORITY = "1-URGENT"
ORDERS_GROCERIES_PRIORITY = "2-HIGH"
LATE_DELIVERY = "event_id % 10 = 3"  # delivered after all other events
ORDERS_PERIOD = (dt.datetime(1996, 1, 1), dt.datetime(1997, 1, 1))


# Fixed value: schema of the driver's events table (a stream needs it up front).
EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales_table(events: DataFrame, event_type: str) -> DataFrame:
    """A sales table (user_id, price, date_time) from one event type."""
    return events.where(F.col("event_type") == event_type).select(
        "user_id", F.col("value").alias("price"), F.col("ts").alias("date_time")
    )


def raw_sale_rows(events: DataFrame) -> DataFrame:
    """All events as sale rows with nullable user and price (signup: no user, error: no price)."""
    etype = F.col("event_type")
    return events.select(
        F.when(etype != NO_USER_EVENT_TYPE, F.col("user_id")).alias("user_id"),
        F.when(etype != NO_PAYLOAD_EVENT_TYPE, F.col("value")).alias("price"),
        F.col("ts").alias("date_time"),
    )


def order_sales(orders: DataFrame, priority: str) -> DataFrame:
    """A sales table from the orders of one priority."""
    return orders.where(F.col("o_orderpriority") == priority).select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("date_time"),
    )


def feed_rows(events: DataFrame) -> DataFrame:
    """Events as feed messages: text ids, ISO event time, float price, typed sale."""
    etype = F.col("event_type")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(etype == NO_PAYLOAD_EVENT_TYPE, F.lit("")).otherwise(iso_micros_of_ntz("ts")).alias("event_time"),
        F.when(etype == NO_USER_EVENT_TYPE, F.lit("")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(etype == NOT_A_SALE_EVENT_TYPE, F.lit(0.0)).otherwise(F.col("value")).cast("float").alias("price"),
        F.when(etype == BOOKS_EVENT_TYPE, F.lit(BOOK_SALE))
        .when(etype == GROCERIES_EVENT_TYPE, F.lit(GROCERY_SALE))
        .otherwise(etype)
        .alias("event_type"),
    )


def book_feed(events: DataFrame) -> DataFrame:
    """The books feed: purchase events."""
    return feed_rows(events.where(F.col("event_type") == BOOKS_EVENT_TYPE))


def grocery_feed(events: DataFrame) -> DataFrame:
    """The groceries feed: views, plus the non-sale noise the validator removes."""
    return feed_rows(events.where(F.col("event_type") != BOOKS_EVENT_TYPE))


def dirty_times(feed: DataFrame) -> DataFrame:
    """Feed rows some of whose event times are no full date and time, by event id:
    padded, a time alone, a year alone; and some without an offset, which are fine."""
    n, t = F.col("event_id").cast("long") % 20, F.col("event_time")
    dirty = F.when(n == 0, F.concat(F.lit(" "), t)).when(n == 1, F.substring(t, 12, 8)).when(n == 2, F.substring(t, 1, 4))
    clean = F.when(n == 3, F.regexp_replace(t, "Z$", "")).otherwise(t)
    return feed.withColumn("event_time", F.when(t == "", t).otherwise(F.coalesce(dirty, clean)))


def messages(feed: DataFrame) -> DataFrame:
    """Feed rows as JSON payloads, some cut off and some missing, by event id."""
    n = F.col("event_id").cast("long") % 13
    cut = F.concat(F.lit('{"event_id":"'), F.col("event_id"))
    return feed.select(F.when(n == 5, cut).when(n != 6, F.to_json(F.struct(*feed.columns))).alias("value"))


def hot_user(feed: DataFrame) -> DataFrame:
    """A third of the rows on one user."""
    return feed.withColumn("user_id", F.when((F.col("event_id").cast("long") % 3 == 0) & (F.col("user_id") != ""), F.lit("1")).otherwise(F.col("user_id")))


def heartbeats(events: DataFrame) -> DataFrame:
    """Heartbeats of the groceries feed: an ``error`` event lost its payload and tells the time only."""
    lost = events.where(F.col("event_type") == NO_PAYLOAD_EVENT_TYPE)
    return lost.select(F.lit("groceries").alias("feed"), iso_micros_of_ntz("ts").alias("event_time"))
