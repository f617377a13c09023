"""Sinks: console and Kafka (the changelog table and view upserts are in
:mod:`bayline.streaming.jobs`)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from bayline.operators.changelog import SESSION_FIELDS, encode_changelog


def to_console(changes: DataFrame, trigger_seconds: int = 2, truncate: bool = False):
    """Console sink in update mode (for eyes, not for tests)."""
    return (changes.writeStream.format("console").option("truncate", truncate)
            .outputMode("update").trigger(processingTime=f"{trigger_seconds} seconds").start())


def console_batch_sink(rows: int = 20):
    """A ``foreachBatch`` sink printing each micro-batch (for eyes only)."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        print(f"-- batch {epoch_id}")
        batch.show(rows, truncate=False)
    return write


def kafka_batch_sink(servers: str, topic: str):
    """A ``foreachBatch`` sink writing session rows to a Kafka topic: key =
    plate, value = JSON of the session fields. Needs the Kafka connector."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        (encode_changelog(batch.select(*SESSION_FIELDS))
         .write.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("topic", topic)
         .save())
    return write


def wire_table_sink(path: str):
    """The rows of :func:`kafka_batch_sink` in a table instead of a topic:
    ``<path>/epoch_id=<n>`` with ``key`` and ``value``."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        (encode_changelog(batch.select(*SESSION_FIELDS))
         .write.mode("overwrite").parquet(f"{path.rstrip('/')}/epoch_id={epoch_id}"))
    return write


def to_kafka(changes: DataFrame, servers: str, topic: str, checkpoint: str,
             trigger_seconds: int = 2):
    """Streaming Kafka sink of session changes (update mode, stable
    checkpoint so a restart resumes instead of starting over)."""
    return (encode_changelog(changes.select(*SESSION_FIELDS))
            .writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint)
            .outputMode("update")
            .trigger(processingTime=f"{trigger_seconds} seconds")
            .start())
