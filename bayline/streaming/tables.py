"""Live sessions with their state in tables: each micro-batch is a batch job.

Keyed state (:mod:`bayline.streaming.fold`) hands all rows of one key in a
micro-batch to one Python call. Here every micro-batch instead runs the
piecewise batch scan (:func:`bayline.operators.sessionize.session_scan`), so a
key holding a large share of a batch is split like in the batch job, and no
Python runs in the data path. What keyed state held lives in two tables
written by the batch: ``open/epoch_id=<n>`` (one row per open session:
start, last time, last event id, count, first event id) and
``clock/epoch_id=<n>`` (the event-time clock: latest event time seen).

Per batch ``n``:

1. read ``open``, ``held`` and ``clock`` of batch ``n - 1``. The horizon is the
   clock minus the allowed delay. Rows at or before the last horizon are late:
   they go to ``late/epoch_id=<n>`` and not into the sessions. Rows after the new
   horizon may still be overtaken by older ones: they wait in
   ``held/epoch_id=<n>``. The rows between come in time order, however they
   arrived;
2. scan those with the open sessions as seeds: a seed is session 1 of its
   key, later events extend it or follow it by the usual rules. The result is
   written once to ``rows/epoch_id=<n>``;
3. per session: CLOSED on an exit; TIMEOUT when a later session of the key
   follows or when silent for longer than the limit at the horizon; else
   ACTIVE. Changed sessions go to ``changelog/epoch_id=<n>``; open ones are the
   new ``open`` table. Seeds without new rows are re-checked against the
   horizon, so timeouts fire without new data for the key.

Accepted, held and late rows add up to the input; given raw messages, so do
those that can't be read, in ``bad/epoch_id=<n>`` with their reason. :func:`drain` takes in what
is held when no more input will come.

All writes overwrite their epoch folder, so a retried batch replaces
itself; the previous batch is found from the ``clock`` table (partition
pruning on ``epoch_id``), so a restart reads the last batch written.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from bayline.functions.pricing import block_cost
from bayline.operators.sessionize import KEY, T_COL, TIE_COL, session_scan, valid_events
from bayline.params import ACTIVE, CLOSED, TIMEOUT, Settings
from bayline.sources.raw import classified
from bayline.streaming.epochs import drop_epochs

OPEN = StructType([
    StructField("license_plate", StringType()), StructField("location", StringType()),
    StructField("start_time", LongType()), StructField("last_time", LongType()),
    StructField("last_event_id", LongType()), StructField("n_events", LongType()),
    StructField("start_event_id", LongType()),
])
CHANGE_FIELDS = ["license_plate", "location", "start_time", "end_time", "duration", "cost",
                 "status", "last_updated", "n_events", "start_event_id", "last_event_id"]
HELD = StructType([
    StructField("license_plate", StringType()), StructField("location", StringType()),
    StructField("timestamp_unix", LongType()), StructField("event_id", LongType()),
    StructField("status_code", StringType()),
])


def micro_batch_rows(batch: DataFrame, open_sessions: DataFrame, clock: int, s: Settings) -> DataFrame:
    """Sessions touched by one micro-batch or open before it (see the module
    doc); ``clock`` is the event time that silence is judged at."""
    T = s.timeout_seconds
    scan = session_scan(batch, s, seed=open_sessions)
    got = scan.groupBy(*KEY, "session_no").agg(
        F.min(T_COL).alias("b_start"), F.max(T_COL).alias("b_end"),
        F.count(F.lit(1)).alias("b_n"),
        F.max(F.col("is_exit").cast("int")).alias("closed"),
        F.min(F.struct(T_COL, TIE_COL)).alias("b_first"),
        F.max(F.struct(T_COL, TIE_COL)).alias("b_last"))
    seeds = open_sessions.select(*KEY, F.lit(1).cast("long").alias("session_no"),
                                 *[F.col(c).alias(f"o_{c}") for c in OPEN.names[2:]])
    full = got.join(seeds, [*KEY, "session_no"], "full_outer")
    seeded = F.col("o_start_time").isNotNull()
    touched = F.col("b_n").isNotNull()
    last_no = full.groupBy(*KEY).agg(F.max("session_no").alias("last_no"))
    full = full.join(last_no, KEY)
    start = F.coalesce(F.col("o_start_time"), F.col("b_start"))
    end = F.greatest(F.col("o_last_time"), F.col("b_end"))
    closed = F.coalesce(F.col("closed"), F.lit(0)) == 1
    status = (F.when(closed, F.lit(CLOSED))
              .when(F.col("session_no") < F.col("last_no"), F.lit(TIMEOUT))
              .when(F.lit(clock) - end > F.lit(T), F.lit(TIMEOUT))
              .otherwise(F.lit(ACTIVE)))
    n = F.coalesce(F.col("b_n"), F.lit(0)) + F.coalesce(F.col("o_n_events"), F.lit(0))
    rows = full.select(
        *KEY, start.alias("start_time"), end.alias("end_time"), status.alias("status"),
        n.cast("long").alias("n_events"),
        F.coalesce(F.col("o_start_event_id"), F.col(f"b_first.{TIE_COL}")).alias("start_event_id"),
        F.when(touched & ((~seeded) | (F.col(f"b_last.{T_COL}") >= F.col("o_last_time"))),
               F.col(f"b_last.{TIE_COL}")).otherwise(F.col("o_last_event_id"))
        .alias("last_event_id"),
        touched.alias("touched"), seeded.alias("seeded"))
    lone = (F.col("status") == CLOSED) & (F.col("n_events") == 1) & ~F.col("seeded")
    if s.lone_exit == "drop":
        rows = rows.where(~lone)
    return rows


def changes_and_open(rows: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """``(changes, open_after)`` of :func:`micro_batch_rows`."""
    d = (F.col("end_time") - F.col("start_time")).cast("long")
    changes = rows.where(F.col("touched") | (F.col("status") != ACTIVE)).select(
        *KEY, "start_time", "end_time", d.alias("duration"), block_cost(d, s).alias("cost"),
        "status", F.col("end_time").alias("last_updated"), "n_events", "start_event_id", "last_event_id",
    ).select(*CHANGE_FIELDS)
    open_after = rows.where(F.col("status") == ACTIVE).select(
        *KEY, "start_time", F.col("end_time").alias("last_time"), "last_event_id",
        "n_events", "start_event_id")
    return changes, open_after


def table_state_sink(base: str, s: Settings, retain_epochs: int = 10, raw: bool = False):
    """``foreachBatch`` function running :func:`micro_batch_rows`, with
    ``open``, ``held``, ``clock`` and ``changelog`` tables below ``base``. With
    ``raw`` the batches are messages, parsed once for both outcomes. State
    epochs (all but ``changelog`` and ``late``) older than the last
    ``retain_epochs`` are deleted, so a restart can't go back further than
    that; 0 keeps all."""
    base = base.rstrip("/")
    delay = s.delay_seconds

    def path(name: str, epoch: int) -> str:
        return f"{base}/{name}/epoch_id={epoch}"

    def previous(spark: SparkSession, epoch_id: int):
        """Clock and epoch of the last batch written before ``epoch_id``."""
        try:
            clocks = spark.read.parquet(f"{base}/clock")
        except AnalysisException:  # first batch: nothing written yet
            return None, None
        row = (clocks.where(F.col("epoch_id") < epoch_id)
               .agg(F.max(F.struct("epoch_id", "as_of")).alias("m")).first()["m"])
        return (None, None) if row is None else (row["as_of"], row["epoch_id"])

    def write(batch: DataFrame, epoch_id: int, wait: int = delay) -> None:
        spark = batch.sparkSession
        prev_clock, prev_epoch = previous(spark, epoch_id)
        source = classified(batch, keep_raw=True).persist() if raw else None
        ev = valid_events(batch if source is None else source.where("reason is null"))
        ev = ev.persist() if source is None else ev
        try:
            if source is not None:
                (source.where("reason is not null").select("event_id", "reason", "raw")
                 .write.mode("overwrite").parquet(path("bad", epoch_id)))
            if prev_epoch is not None:
                open_prev = spark.read.schema(OPEN).parquet(path("open", prev_epoch))
                held = spark.read.schema(HELD).parquet(path("held", prev_epoch))
                behind = F.col(T_COL) <= F.lit(prev_clock - delay)
                # late rows are kept for audit, not silently lost
                ev.where(behind).write.mode("overwrite").parquet(path("late", epoch_id))
                rows_in = ev.where(~behind).unionByName(held)
            else:
                open_prev, rows_in = spark.createDataFrame([], OPEN), ev
            seen = [c for c in (prev_clock, ev.agg(F.max(T_COL)).first()[0]) if c is not None]
            clock = max(seen, default=0)
            ready = F.col(T_COL) <= F.lit(clock - wait)
            rows_in.where(~ready).write.mode("overwrite").parquet(path("held", epoch_id))
            # the sessions are computed and written once; both results read them
            rows = micro_batch_rows(rows_in.where(ready), open_prev, clock - wait, s)
            rows.write.mode("overwrite").parquet(path("rows", epoch_id))
            rows = spark.read.schema(rows.schema).parquet(path("rows", epoch_id))
            changes, open_after = changes_and_open(rows, s)
            changes.write.mode("overwrite").parquet(path("changelog", epoch_id))
            open_after.write.mode("overwrite").parquet(path("open", epoch_id))
            spark.range(1).select(F.lit(clock).cast("long").alias("as_of")) \
                .write.mode("overwrite").parquet(path("clock", epoch_id))
        finally:
            (ev if source is None else source).unpersist()
        if retain_epochs:
            for name in ("open", "clock", "held", "rows"):
                drop_epochs(spark, f"{base}/{name}", lambda e: e <= epoch_id - retain_epochs)
    return write


def drain(spark: SparkSession, base: str, s: Settings) -> None:
    """Takes in the rows still held below ``base``, as one more epoch, when no
    more input will come."""
    last = spark.read.parquet(f"{base.rstrip('/')}/clock").agg(F.max("epoch_id")).first()[0]
    no_rows = spark.createDataFrame([], HELD)
    table_state_sink(base, s, retain_epochs=0)(no_rows, int(last) + 1, 0)


def start_table_sessions(events_stream: DataFrame, s: Settings, base: str, checkpoint: str,
                         *, available_now: bool = False, trigger_seconds: int = 2,
                         retain_epochs: int = 10, raw: bool = False):
    """Start the live job over events, or over messages if ``raw``; the
    changelog is ``<base>/changelog``."""
    w = (events_stream.writeStream.foreachBatch(table_state_sink(base, s, retain_epochs, raw))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()


def replay_table_sessions(spark: SparkSession, events: DataFrame, s: Settings,
                          n_slices: int = 4, cuts: list[int] | None = None,
                          arrival: Column | None = None) -> str:
    """Replay a table (its rows in time order, or by the seconds in
    ``arrival``) through :func:`start_table_sessions` in time slices (one
    ``availableNow`` run per slice on the same checkpoint); returns the
    changelog path."""
    from bayline.plans.runtime import scratch_path

    base = scratch_path(spark, "tables")
    ev = valid_events(events)
    at = F.col(T_COL) if arrival is None else arrival
    if cuts is None:
        lo, hi = ev.agg(F.min(at), F.max(at)).first()
        width = (hi - lo) // n_slices + 1 if lo is not None else 1
        piece = F.floor((at - F.lit(lo or 0)) / F.lit(width)).cast("long")
    else:
        piece = F.lit(0)
        for c in cuts:
            piece = piece + F.when(at >= F.lit(c), 1).otherwise(0)
        n_slices = len(cuts) + 1
    replay_table_slices(spark, [ev.where(piece == k) for k in range(n_slices)], s, base)
    return f"{base}/changelog"


def replay_table_slices(spark: SparkSession, slices: list[DataFrame], s: Settings, base: str, raw: bool = False) -> None:
    """Each slice (events, or messages if ``raw``) appended to an input folder
    and taken in by one ``availableNow`` run on the same checkpoint; what is
    held at the end is drained."""
    inp, ckpt = f"{base}/input", f"{base}/checkpoint"
    for part in slices:
        part.write.mode("append").parquet(inp)
        stream = spark.readStream.schema(part.schema).parquet(inp)
        q = start_table_sessions(stream, s, base, ckpt, available_now=True, raw=raw)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    if s.delay_seconds and slices:
        drain(spark, base, s)
