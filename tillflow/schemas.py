"""Fixed schemas of the inputs and outputs (nothing is inferred)."""

from pyspark.sql import types as T

# Raw sale row of a sales table. Every column is nullable.
SALE = T.StructType(
    [
        T.StructField("user_id", T.StringType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("date_time", T.TimestampType(), True),
    ]
)

# Weekly result appended to an existing table; column names and order are fixed.
WEEKLY_SALES = T.StructType(
    [
        T.StructField("UserID", T.StringType(), True),
        T.StructField("TotalSalesInWeek", T.DoubleType(), True),
        T.StructField("StartOfWeek", T.TimestampType(), True),
        T.StructField("EndOfWeek", T.TimestampType(), True),
    ]
)

# Event as published on a feed. Missing text reads as "" and a missing price as
# 0.0, as in the wire format the feeds carry; event_time is ISO-8601 text.
EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType(), True),
        T.StructField("event_time", T.StringType(), True),
        T.StructField("user_id", T.StringType(), True),
        T.StructField("price", T.FloatType(), True),
        T.StructField("event_type", T.StringType(), True),
    ]
)

# A feed's sign of life: no event before ``event_time`` (ISO-8601 text) is still to come on ``feed``.
HEARTBEAT = T.StructType([T.StructField("feed", T.StringType(), True), T.StructField("event_time", T.StringType(), True)])

# The two event types the feeds declare.
BOOK_SALE = "BOOK_SALE"
GROCERY_SALE = "GROCERY_SALE"


def pane_schema(key_type: T.DataType = T.StringType(), id_type: T.DataType = T.StringType(),
                include_events: bool = True) -> T.StructType:
    """Schema of one session pane (open or closed)."""
    fields = [
        T.StructField("window_id", id_type, True),
        T.StructField("user_id", key_type, True),
        T.StructField("window_start", T.TimestampType(), True),
        T.StructField("window_end", T.TimestampType(), True),
        T.StructField("total_price", T.FloatType(), True),
        T.StructField("window_open", T.BooleanType(), True),
        T.StructField("event_count", T.LongType(), True),
    ]
    if include_events:
        fields.append(T.StructField("events", T.ArrayType(EVENT, True), True))
    return T.StructType(fields)


SESSION_PANE = pane_schema()
