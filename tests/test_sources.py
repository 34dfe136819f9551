import json

from pyspark.sql import types as T

from tillflow.operators.cleaning import quarantined_events, valid_events
from tillflow.sources.streams import decode_events, union_feeds


def test_json_payloads_decode_to_events(spark):
    good = {"event_id": "a", "event_time": "2019-01-01T12:22:22Z", "user_id": "a1", "price": 12.4,
            "event_type": "GROCERY_SALE"}
    no_user = dict(good, event_id="b", user_id="")
    raw = spark.createDataFrame([(json.dumps(good),), (json.dumps(no_user),), ("not json",)], "value string")
    events = decode_events(raw)
    assert [f.name for f in events.schema] == ["event_id", "event_time", "user_id", "price", "event_type"]
    assert isinstance(events.schema["price"].dataType, T.FloatType)
    assert [r.event_id for r in valid_events(events).collect()] == ["a"]
    reasons = sorted((str(r.event_id), r.reason) for r in quarantined_events(events).collect())
    assert reasons == [("None", "no user id"), ("b", "no user id")]


def test_union_keeps_duplicates(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    assert union_feeds(a, b).count() == 3


def test_kafka_source_is_gated_on_its_connector(spark):
    import pytest
    from pyspark.errors import AnalysisException

    from tillflow.sources.streams import read_kafka_feed

    with pytest.raises(AnalysisException, match="kafka"):
        read_kafka_feed(spark, "localhost:1", "events")


def test_kafka_sink_is_gated_on_its_connector(spark, workdir):
    import os

    import pytest
    from pyspark.errors import AnalysisException

    from tillflow.schemas import EVENT
    from tillflow.sinks.streams import write_kafka
    from tillflow.sources.streams import read_event_feed

    src = os.path.join(workdir, "src")
    spark.createDataFrame([("a", "2019-01-01T12:22:22Z", "a1", 1.0, "BOOK_SALE")], EVENT).write.parquet(src)
    with pytest.raises(AnalysisException, match="kafka"):
        write_kafka(read_event_feed(spark, src), "localhost:1", "panes", os.path.join(workdir, "chk"))


def test_replayed_batch_replaces_its_rows(spark, workdir):
    import os

    from tillflow.sinks.streams import batch_writer

    write = batch_writer(os.path.join(workdir, "out"))
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    write(batch, 7)
    write(batch, 7)  # the same micro-batch delivered again after a failure
    assert spark.read.parquet(os.path.join(workdir, "out")).count() == 2
