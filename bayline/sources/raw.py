"""Raw camera messages: read, decode, quarantine; and the changelog source.

A raw frame has the columns of Spark's Kafka source (``key``, ``value``
binary, ``topic``, ``partition``, ``offset``, ``timestamp``,
``timestampType``); a JSON or text file source only needs ``value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.schemas import EVENT, SESSION

EVENT_FIELDS = [f.name for f in EVENT.fields]


def read_raw(spark: SparkSession, fmt: str, *, path: str | None = None,
             servers: str | None = None, topic: str | None = None,
             starting_offsets: str = "earliest", stream: bool = True,
             options: dict | None = None, schema=None,
             fail_on_data_loss: bool = True) -> DataFrame:
    """Raw messages from Kafka (``fmt="kafka"``), lines of JSON/text files, or
    parquet files of raw messages (``key``, ``value``, ``offset``, ...).

    Kafka needs the ``spark-sql-kafka`` connector on the class path. A new
    checkpoint starts at ``earliest``, and a topic that has lost offsets stops
    the query unless ``fail_on_data_loss`` is off. A
    parquet stream takes ``schema``, or the one in the files' footers.
    """
    reader = spark.readStream if stream else spark.read
    opts = dict(options or {})
    if fmt == "kafka":
        r = (reader.format("kafka")
             .option("kafka.bootstrap.servers", servers)
             .option("subscribe", topic)
             .option("startingOffsets", starting_offsets)
             .option("failOnDataLoss", str(fail_on_data_loss).lower()))
        for k, v in opts.items():
            r = r.option(k, v)
        return r.load()
    if fmt in ("json", "text"):
        r = reader.format("text")
        for k, v in opts.items():
            r = r.option(k, v)
        return r.load(path).select(F.col("value").cast("binary").alias("value"))
    if fmt == "parquet":
        r = reader.format("parquet")
        for k, v in opts.items():
            r = r.option(k, v)
        if stream:
            r = r.schema(schema or spark.read.parquet(path).schema)
        return r.load(path)
    raise ValueError(f"unknown raw format {fmt!r}")


def _reason():
    d = F.col("data")
    all_null = F.lit(True)
    for f in EVENT_FIELDS:
        all_null = all_null & d[f].isNull()
    return (F.when(F.col("raw").isNull(), F.lit("null_value"))
            .when(d.isNull() | all_null, F.lit("unparseable"))
            .when(d["license_plate"].isNull(), F.lit("missing_plate"))
            .when(d["location"].isNull(), F.lit("missing_location"))
            .when(d["timestamp_unix"].isNull(), F.lit("missing_time")))


def classified(raw: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Each message parsed once, with its fields and quarantine reason.

    The fields and the reason leave through ``inline`` of a one-element
    array: a filter on them cannot be pushed below the parse, so the optimizer
    does not copy ``from_json`` into the filter once per referenced field.
    """
    cols = raw.columns
    text = F.col("value").cast("string")
    seq = (F.col("offset").cast("long") if "offset" in cols
           else F.xxhash64(F.col("value")))
    p = raw.select(seq.alias("event_id"), text.alias("raw"),
                   F.from_json(text, EVENT).alias("data"))
    row = F.struct(
        F.col("event_id"), *[F.col("data")[f].alias(f) for f in EVENT_FIELDS],
        _reason().alias("reason"),
        *([F.col("raw")] if keep_raw else []))
    return p.select(F.inline(F.array(row)))


def decode_events(raw: DataFrame) -> DataFrame:
    """Valid events: ``event_id`` (offset, or a hash of the message) and the
    five event fields. Rows that cannot be keyed or placed in time are left
    out here and reported by :func:`bad_events`."""
    return classified(raw).where(F.col("reason").isNull()).drop("reason")


def bad_events(raw: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Quarantined messages with a reason: ``null_value``, ``unparseable``,
    ``missing_plate``, ``missing_location``, ``missing_time``."""
    cols = ["event_id", "reason"] + (["raw"] if keep_raw else [])
    return classified(raw, keep_raw).where(F.col("reason").isNotNull()).select(*cols)


def encode_for_wire(events: DataFrame) -> DataFrame:
    """Events as Kafka-style messages: key = plate, value = JSON of the five
    event fields (null fields are left out of the JSON)."""
    return events.select(
        F.col("license_plate").cast("binary").alias("key"),
        F.to_json(F.struct(*[F.col(f) for f in EVENT_FIELDS])).cast("binary").alias("value"),
        F.col("event_id").alias("offset"),
    )


def read_changelog(spark: SparkSession, fmt: str, *, path: str | None = None,
                   servers: str | None = None, topic: str | None = None,
                   stream: bool = False) -> DataFrame:
    """Session changelog back as rows: from the Kafka topic written by
    :func:`bayline.sources.sinks.to_kafka`, or from the changelog table."""
    if fmt == "kafka":
        return decode_changelog(read_raw(spark, "kafka", servers=servers, topic=topic,
                                         stream=stream))
    reader = spark.readStream if stream else spark.read
    return reader.format(fmt).load(path)


def decode_changelog(raw: DataFrame) -> DataFrame:
    """Session rows from their wire form (``value`` = JSON of the session
    fields, nulls left out); ``offset``, when present, orders the changes."""
    seq = F.col("offset").cast("long") if "offset" in raw.columns else F.lit(None).cast("long")
    return (raw.select(F.from_json(F.col("value").cast("string"), SESSION).alias("s"),
                       seq.alias("offset"))
            .select("s.*", "offset"))
