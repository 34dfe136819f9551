"""Stream sinks for session panes and quarantined events."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


def write_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: dict | None = None,
                query_name: str | None = None) -> StreamingQuery:
    """Append a stream to files. The file sink commits each micro-batch exactly once
    through its log, so a restart from ``checkpoint`` neither loses nor repeats rows."""
    w = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start()


def batch_writer(path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()):
    """The ``foreachBatch`` function: overwrite the folder of this batch id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.write.mode("overwrite").format(fmt)
        (out.partitionBy(*partition_by) if partition_by else out).save(os.path.join(path, f"batch_id={batch_id}"))

    return write


def write_batches_idempotent(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: dict | None = None,
                             partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """``foreachBatch`` delivery: each micro-batch overwrites its own ``batch_id=N``
    folder, so a batch replayed after a failure replaces, not duplicates, its rows.
    ``partition_by`` columns become folders below it: several outputs of one query, each
    batch of them written by one job and committed together."""

    w = df.writeStream.foreachBatch(batch_writer(path, fmt, partition_by)).option("checkpointLocation", checkpoint).outputMode("append")
    return _trigger(w, trigger).start()


def read_output(spark: SparkSession, path: str, kind: str, stream: DataFrame) -> DataFrame:
    """One output ("panes" or "quarantine") of a stream of ``with_rejects`` that
    ``write_batches_idempotent(..., partition_by=("kind",))`` wrote."""
    schema = T.StructType([*[f for f in stream.schema if f.name != "kind"], T.StructField("batch_id", T.LongType()), stream.schema["kind"]])
    rows = spark.read.schema(schema).parquet(path).where(F.col("kind") == kind)
    return rows.select("pane.*") if kind == "panes" else rows.select("event.*", "reason")


def write_kafka(df: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str, key_col: str = "user_id",
                trigger: dict | None = None) -> StreamingQuery:
    """Publish each row as a JSON message keyed by ``key_col`` (at-least-once, as Kafka
    sinks are). Needs the Spark Kafka connector on the classpath."""
    messages = df.select(F.col(key_col).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
    w = (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _trigger(w, trigger).start()
