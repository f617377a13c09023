"""Views read from the keyed state itself: the checkpoint as a table.

The open sessions of a live keyed job are its state. Spark's state data source
reads the state of the last committed batch of a checkpoint as a batch
DataFrame, so live reads need neither the changelog nor the job: no history is
folded, and the read is as large as the open sessions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.operators import views
from bayline.operators.sessionize import KEY
from bayline.params import ACTIVE, CLOSED, TIMEOUT, Settings
from bayline.streaming.fold import GROUP_OPEN, WAITING


def _state(spark: SparkSession, checkpoint: str) -> DataFrame:
    return spark.read.format("statestore").load(checkpoint)


def open_sessions(spark: SparkSession, checkpoint: str, ordered: bool = False) -> DataFrame:
    """Open sessions of a keyed job's last batch: key, ``start_time``,
    ``end_time`` (the last event), ``n_events``, ``start_event_id``, ``status``.
    ``ordered``: the checkpoint is one of
    :func:`bayline.streaming.ordered.ordered_sessionize_stream`, which holds
    them in the same form; sessions whose rows all still wait aren't open yet."""
    rows = _state(spark, checkpoint)
    if KEY[0] in rows.schema["key"].dataType.names:  # a state of its own for each key
        rows = rows.select(*[F.col(f"key.{k}").alias(k) for k in KEY], "value.groupState.*")
    else:
        rows = _entries(rows, GROUP_OPEN.names)
    return rows.where(F.col("start_time").isNotNull()).select(
        *KEY, "start_time", F.col("last_time").alias("end_time"), "n_events", "start_event_id",
        F.lit(ACTIVE).alias("status"))


def _entries(rows: DataFrame, arrays: list[str]) -> DataFrame:
    """A row for each entry of a group's arrays."""
    of_group = F.arrays_zip(*[F.col(f"value.groupState.{c}").alias(c) for c in arrays])
    return rows.select(F.inline(of_group)).toDF(*arrays)


def waiting_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows that the ordered form still holds back: key, ``timestamp_unix``,
    ``event_id``, ``status_code``."""
    return _entries(_state(spark, checkpoint), list(WAITING)).toDF(*KEY, "timestamp_unix", "event_id", "status_code")


def active_sessions_from_state(spark: SparkSession, checkpoint: str, as_of: Column, s: Settings,
                               ordered: bool = False) -> DataFrame:
    """:func:`bayline.operators.views.active_sessions` of a live job. A session
    silent for longer than the limit at ``as_of`` is still open in the state
    until the watermark passes; it isn't shown."""
    live = open_sessions(spark, checkpoint, ordered).where(as_of - F.col("end_time") <= F.lit(s.timeout_seconds))
    return views.active_sessions(live, as_of, s)


def accepted_events(ended_in: DataFrame, open_now: DataFrame, waiting: DataFrame | None = None) -> DataFrame:
    """One row ``n``: the events that a job has taken into sessions: those of
    ended sessions (each ends once in the changelog), of open ones, and rows
    that wait."""
    parts = [ended_in.where(F.col("status").isin(CLOSED, TIMEOUT)).select("n_events"), open_now.select("n_events")]
    if waiting is not None:
        parts.append(waiting.select(F.lit(1).cast("long").alias("n_events")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.agg(F.coalesce(F.sum("n_events"), F.lit(0)).alias("n"))
