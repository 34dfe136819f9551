"""Event feeds: streaming reads with a fixed schema, payload decoding, union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tillflow.functions.time import parse_iso
from tillflow.schemas import EVENT, HEARTBEAT


def read_event_feed(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None,
                    schema=EVENT) -> DataFrame:
    """A stream of events from files (Parquet or JSON lines) with the fixed event schema.

    The schema is given, never inferred. ``max_files_per_trigger`` bounds each
    micro-batch, and so the rows a single key can bring to one task per batch.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path)


def decode_events(raw: DataFrame, payload_col: str = "value", keep: dict[str, str] | None = None,
                  keep_payload: bool = False) -> DataFrame:
    """Decode a text/bytes payload column (JSON) into the event columns.

    Used for message sources such as Kafka, whose ``value`` holds the message.
    Undecodable messages give a row of nulls, which the validator rejects; with
    ``keep_payload`` their text is kept in ``bad_payload`` (null for the others, "" for a
    missing payload). ``keep`` carries message columns along, renamed
    (``{"timestamp": "message_time"}``).
    """
    payload = F.col(payload_col).cast("string")
    kept = [F.col(src).alias(dst) for src, dst in (keep or {}).items()]
    schema = T.StructType([*EVENT, T.StructField("bad_payload", T.StringType())])
    decoded = F.from_json(payload, schema, {"columnNameOfCorruptRecord": "bad_payload"}).alias("e")
    out = raw.select(decoded, payload.alias("_payload"), *kept)
    bad = F.when(F.col("e").isNull(), F.coalesce("_payload", F.lit(""))).otherwise(F.col("e.bad_payload")).alias("bad_payload")
    return out.select(*[F.col(f"e.{c}") for c in EVENT.names], *([bad] if keep_payload else []), *(keep or {}).values())


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """One feed from several, duplicates kept; works on batch and streaming frames."""
    return reduce(lambda a, b: a.unionByName(b), feeds)


def read_kafka_feed(spark: SparkSession, bootstrap_servers: str, topic: str,
                    max_offsets_per_trigger: int | None = None, starting_offsets: str = "earliest") -> DataFrame:
    """Events from a Kafka topic whose messages are JSON events, with the message's
    own timestamp as ``message_time`` (the time sessions follow in the reference).

    Needs the Spark Kafka connector on the classpath (not bundled with PySpark);
    without it this raises ``DATA_SOURCE_NOT_FOUND``. ``max_offsets_per_trigger``
    bounds each micro-batch.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    return decode_events(reader.load(), "value", keep={"timestamp": "message_time"}, keep_payload=True)


def read_kafka_messages(spark: SparkSession, bootstrap_servers: str, topic: str, schema: T.StructType) -> DataFrame:
    """JSON messages of a topic in the given schema (needs the connector, as ``read_kafka_feed``)."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("subscribe", topic).option("startingOffsets", "earliest").load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("m")).select("m.*")


def read_heartbeats(spark: SparkSession, path: str, feed: str, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Heartbeats (instants ``ts``) that the producers of ``feed`` publish as files of
    (feed, event_time); those of other feeds or without a readable time are left out."""
    return heartbeat_times(read_event_feed(spark, path, fmt, max_files_per_trigger, HEARTBEAT), feed)


def heartbeat_times(beats: DataFrame, feed: str) -> DataFrame:
    """The instants ``ts`` of one feed's heartbeats."""
    return beats.where(F.col("feed") == feed).select(parse_iso(F.col("event_time")).alias("ts")).where(F.col("ts").isNotNull())


def clock_heartbeats(spark: SparkSession, idle_after: str, rows_per_second: int = 1) -> DataFrame:
    """Heartbeats by the clock, ``idle_after`` (an interval) behind it, for feeds whose events arrive
    within that time: a feed silent for longer no longer holds the watermark. Events that arrive
    later than ``idle_after`` may then be late, so it is not for replays of old events."""
    clock = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return clock.select((F.col("timestamp") - F.expr(f"INTERVAL {idle_after}")).alias("ts"))
