"""Spot conflicts of a live job: a stream-stream interval join.

:func:`ended_sink` keeps the sessions that end as a table, each with
``left_at``, the job's event clock when it was written: at or after the
session's end, and never going back from one epoch to the next, so no row of
the table is late for a query that reads it as a stream. Sessions that span at
most ``horizon_seconds`` from their start to ``left_at`` go to ``short``, the
others to ``long``.

:func:`conflict_stream` joins the stream ``short`` with itself. Two short
sessions that overlap have ``left_at`` at most the horizon apart: with ``a``
starting first, ``a.left_at <= a.start + horizon <= b.left_at + horizon`` and
``b.left_at <= b.start + horizon <= a.end + horizon <= a.left_at + horizon``.
That bound, stated on both sides, loses no pair, and lets Spark drop a session
from the join's state once the watermark is a horizon past it. The join's key
is the spot and a time bucket, so a busy spot's state lies in many partitions.

:func:`conflicts` reads the whole answer: the stream's pairs, and the pairs in
which a long session or one still open takes part, joined when read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.params import CLOSED, TIMEOUT, Settings
from bayline.streaming.epochs import drop_epochs, epoch_path
from bayline.streaming.jobs import BatchSink, start_changelog

SESSION = ["location", "license_plate", "start_event_id", "start_time", "end_time"]
ENDED = ("location string, license_plate string, start_event_id long, start_time long, end_time long, "
         "left_at timestamp")
# rows of a batch for each file of the sessions that ended in it
FILE_ROWS = 250_000
PAIR = ["location", "plate_a", "id_a", "start_a", "end_a", "plate_b", "id_b", "start_b", "end_b"]


def ended_sink(table: str, horizon_seconds: int) -> BatchSink:
    """``foreachBatch`` sink of session changes: the sessions that ended, in
    ``<table>/short`` and ``<table>/long``. A retried batch replaces its own
    folders; the clock of the batch before is one row. The number of files goes
    by the rows, not by the partitions of the job's state: a reader that takes
    some files a trigger would else run a batch of the join for a few rows."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        newest, n = batch.agg(F.max("end_time"), F.count(F.lit(1))).first()
        before = _clock(spark, table, epoch_id - 1)
        now = max((t for t in (newest, before) if t is not None), default=None)
        ended = batch.where(F.col("status").isin(CLOSED, TIMEOUT)).select(
            *SESSION, F.timestamp_seconds(F.lit(now).cast("long")).alias("left_at")).coalesce(n // FILE_ROWS + 1)
        is_long = F.lit(now).cast("long") - F.col("start_time") > F.lit(horizon_seconds)
        ended.where(~is_long).write.mode("overwrite").parquet(epoch_path(table, "short", epoch_id))
        ended.where(is_long).write.mode("overwrite").parquet(epoch_path(table, "long", epoch_id))
        (spark.range(1).select(F.lit(now).cast("long").alias("clock")).coalesce(1)
         .write.mode("overwrite").parquet(epoch_path(table, "clock", epoch_id)))
        drop_epochs(spark, f"{table}/clock", lambda k: k < epoch_id - 1)
    return write


def _clock(spark: SparkSession, table: str, epoch_id: int) -> int | None:
    try:
        row = spark.read.schema("clock long").parquet(epoch_path(table, "clock", epoch_id)).first()
    except AnalysisException:  # the first batch
        return None
    return row["clock"] if row is not None else None


def _overlaps(a: DataFrame, b: DataFrame, s: Settings, *more: Column) -> DataFrame:
    """Pairs of sessions of different cars on one spot, ``a`` the earlier one by
    start and plate, ``b`` starting before ``a`` has ended: an equi-join on the
    spot and the time bucket of ``b``'s start, which ``a`` must span."""
    width = F.lit(s.bucket_seconds)
    bucket = lambda c: F.floor(F.col(c) / width)
    named = lambda d, x: d.select(
        F.col("location").alias(f"location_{x}"), F.col("license_plate").alias(f"plate_{x}"),
        F.col("start_event_id").alias(f"id_{x}"), F.col("start_time").alias(f"start_{x}"),
        F.col("end_time").alias(f"end_{x}"), *([F.col("left_at").alias(f"left_{x}")] if more else []))
    a = named(a, "a")
    a = a.select("*", F.explode(F.sequence(bucket("start_a"), bucket("end_a"))).alias("bucket_a"))
    b = named(b, "b").withColumn("bucket_b", bucket("start_b"))
    first = (F.col("start_a") < F.col("start_b")) | (
        (F.col("start_a") == F.col("start_b")) & (F.col("plate_a") < F.col("plate_b")))
    on = [F.col("location_a") == F.col("location_b"), F.col("bucket_a") == F.col("bucket_b"),
          F.col("plate_a") != F.col("plate_b"), first, F.col("start_b") <= F.col("end_a"), *more]
    return a.join(b, on).select(F.col("location_a").alias("location"), *PAIR[1:])


def conflict_stream(spark: SparkSession, table: str, s: Settings, horizon_seconds: int,
                    max_files: int | None = None) -> DataFrame:
    """Conflicts among the short sessions of ``table``, as they end (append)."""
    def side() -> DataFrame:
        reader = spark.readStream.schema(ENDED).option("recursiveFileLookup", "true")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        # a second, as rows of the newest one may come with the next epoch
        return reader.parquet(f"{table}/short").withWatermark("left_at", "1 second")

    horizon = F.expr(f"interval {horizon_seconds} seconds")
    return _overlaps(side(), side(), s, F.col("left_b") >= F.col("left_a") - horizon,
                     F.col("left_b") <= F.col("left_a") + horizon)


def start_conflicts(spark: SparkSession, table: str, s: Settings, horizon_seconds: int, pairs: str, checkpoint: str, *,
                    max_files: int | None = None, available_now: bool = False, trigger_seconds: int = 2):
    """The query that writes each micro-batch's conflicts to ``<pairs>/epoch_id=<n>``."""
    return start_changelog(conflict_stream(spark, table, s, horizon_seconds, max_files), pairs, checkpoint,
                           available_now=available_now, trigger_seconds=trigger_seconds, output_mode="append")


def conflicts(spark: SparkSession, table: str, pairs: str, open_now: DataFrame, s: Settings) -> DataFrame:
    """:func:`bayline.operators.audit.spot_conflicts` of a live job: the pairs
    that the stream has written, once each though a batch of sessions may have
    been written twice, and those in which a session in ``long`` or one of
    ``open_now`` takes part. These few meet the others by spot and bucket."""
    read = lambda name: spark.read.schema(ENDED).parquet(f"{table}/{name}").select(*SESSION)
    short, rest = read("short"), read("long").unionByName(open_now.select(*SESSION))
    found = (spark.read.parquet(pairs).select(*PAIR).dropDuplicates()
             .unionByName(_overlaps(rest, rest.unionByName(short), s)).unionByName(_overlaps(short, rest, s)))
    return found.select(
        "location", "plate_a", "start_a", "end_a", "plate_b", "start_b", "end_b",
        F.col("start_b").alias("overlap_start"), F.least("end_a", "end_b").alias("overlap_end"))
