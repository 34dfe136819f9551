import math

from pyspark.sql import types as T

from tillflow.functions.checks import REASON_BAD_TIME, REASON_NO_PRICE, REASON_NO_TIME, REASON_NO_USER
from tillflow.operators.cleaning import quarantined_events, valid_events, valid_sales
from tillflow.schemas import EVENT

SALE = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("price", T.DoubleType())])


def test_rows_missing_a_field_are_dropped(spark):
    df = spark.createDataFrame([("22222", None), (None, 20.0)], SALE)
    assert valid_sales(df).count() == 0


def test_valid_rows_pass(spark):
    df = spark.createDataFrame([("22222", 20.1), ("22222", 20.0)], SALE)
    assert sorted(map(tuple, valid_sales(df).collect())) == [("22222", 20.0), ("22222", 20.1)]


def test_batch_rule_keeps_empty_user_and_negative_price(spark):
    df = spark.createDataFrame([("", -5.0)], SALE)
    assert [tuple(r) for r in valid_sales(df).collect()] == [("", -5.0)]


GOOD = ("a", "2019-01-01T12:22:22Z", "a1", 12.4, "GROCERY_SALE")


def test_valid_event_passes_unchanged(spark):
    out = valid_events(spark.createDataFrame([GOOD], EVENT)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.event_id, r.event_time, r.user_id, r.event_type) == ("a", "2019-01-01T12:22:22Z", "a1", "GROCERY_SALE")
    assert abs(r.price - 12.4) < 1e-6 and r.ts is not None


def _reasons(spark, rows):
    return {r.event_id: r.reason for r in quarantined_events(spark.createDataFrame(rows, EVENT)).collect()}


def test_invalid_events_are_quarantined_with_first_failing_rule(spark):
    rows = [
        ("u", "2019-01-01T12:22:22Z", "", 12.4, "GROCERY_SALE"),
        ("t", "", "a1", 12.4, "GROCERY_SALE"),
        ("p", "2019-01-01T12:22:22Z", "a1", 0.0, "GROCERY_SALE"),
        ("n", "2019-01-01T12:22:22Z", "a1", -3.0, "BOOK_SALE"),
        ("b", "not-a-time", "a1", 1.0, "BOOK_SALE"),
        ("all", "", "", 0.0, "BOOK_SALE"),
        ("null", None, None, None, None),
        GOOD,
    ]
    assert _reasons(spark, rows) == {
        "u": REASON_NO_USER,
        "t": REASON_NO_TIME,
        "p": REASON_NO_PRICE,
        "n": REASON_NO_PRICE,
        "b": REASON_BAD_TIME,
        "all": REASON_NO_USER,
        "null": REASON_NO_USER,
    }
    assert [r.event_id for r in valid_events(spark.createDataFrame(rows, EVENT)).collect()] == ["a"]


def test_nan_price_is_kept(spark):
    rows = [("x", "2019-01-01T12:22:22Z", "a1", float("nan"), "GROCERY_SALE")]
    out = valid_events(spark.createDataFrame(rows, EVENT)).collect()
    assert len(out) == 1 and math.isnan(out[0].price)


def test_unknown_event_type_is_kept(spark):
    rows = [("x", "2019-01-01T12:22:22Z", "a1", 1.0, "SOMETHING_NEW")]
    assert valid_events(spark.createDataFrame(rows, EVENT)).collect()[0].event_type == "SOMETHING_NEW"


def test_iso_text_is_the_same_in_any_session_zone(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from tillflow.functions.time import iso_micros_of_ntz, iso_millis, ntz_to_instant

    rows = [(dt.datetime(2024, 3, 10, 2, 30, 0, 120000),), (dt.datetime(1970, 1, 1, 0, 13, 59, 999000),),
            (dt.datetime(2024, 1, 1, 0, 0, 0),)]
    want = [("2024-03-10T02:30:00.120000Z", "2024-03-10T02:30:00.120Z"),
            ("1970-01-01T00:13:59.999000Z", "1970-01-01T00:13:59.999Z"),
            ("2024-01-01T00:00:00.000000Z", "2024-01-01T00:00:00.000Z")]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.createDataFrame(rows, "ts timestamp_ntz")
            got = df.select(iso_micros_of_ntz(F.col("ts")), iso_millis(ntz_to_instant(F.col("ts")))).collect()
            assert [tuple(r) for r in got] == want, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_event_times_are_full_and_zone_free(spark):
    from pyspark.sql import functions as F

    from tillflow.functions.time import parse_iso

    texts = {"2019-01-01T12:22:22Z": 1546345342, "2019-01-01T12:22:22": 1546345342, "2019-01-01 12:22:22.5+02:00": 1546338142.5,
             "12:22:22": None, "2019": None, "2019-01-01": None, " 2019-01-01T12:22:22Z": None, "2019-01-01T12:22:22Z ": None,
             "2019-13-01T12:22:22Z": None, "T12:22:22Z": None, "": None, None: None}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.createDataFrame([(t,) for t in texts], "t string")
            got = {r.t: r.s for r in df.select("t", (F.unix_micros(parse_iso("t")) / 1e6).alias("s")).collect()}
            assert got == texts, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_undecodable_messages_are_quarantined_with_their_payload(spark):
    from tillflow.functions.checks import REASON_BAD_MESSAGE, REASON_NO_SESSION_TIME
    from tillflow.sources.streams import decode_events

    good = '{"event_id":"a","event_time":"2019-01-01T12:22:22Z","user_id":"u","price":1.5,"event_type":"x"}'
    rows = [(good, None), ("{broken", None), (None, None), ('{"event_id":"b"}', None)]
    raw = spark.createDataFrame(rows, "value string, timestamp timestamp")
    events = decode_events(raw, keep={"timestamp": "message_time"}, keep_payload=True)
    assert [r.event_id for r in valid_events(events).collect()] == ["a"]
    assert "bad_payload" not in valid_events(events).columns
    bad = {(r.event_id, r.bad_payload, r.reason) for r in quarantined_events(events, "message_time").collect()}
    assert bad == {(None, "{broken", REASON_BAD_MESSAGE), (None, "", REASON_BAD_MESSAGE), ("b", None, REASON_NO_USER), ("a", None, REASON_NO_SESSION_TIME)}
