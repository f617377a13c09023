"""Session changelog: the rows a live session job emits, made in batch.

One row per event (the session as it stands after that event: ACTIVE, or
CLOSED for an exit) plus one TIMEOUT row per session that went silent. The
order of changes is ``(change_time, kind, event_id, location)``: an event
changes its session at its own time, a timeout at ``end_time + limit``
(after any event of that second); a TIMEOUT row carries the id of the
session's last event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayline.functions.clock import as_of_column
from bayline.functions.pricing import block_cost
from bayline.operators.pieces import hot_key_ids, split_hot_keys
from bayline.operators.sessionize import (
    KEY, T_COL, TIE_COL, piece_scan, session_scan, sessions_from_scan, valid_events,
    whole_key_scan)
from bayline.params import ACTIVE, CLOSED, TIMEOUT, Settings

CHANGELOG_COLUMNS = ["license_plate", "location", "session_no", "start_time", "end_time",
                     "duration", "cost", "status", "last_updated", "change_time",
                     "change_kind", "event_id"]
# Exit notification type and message (plate, then spot).
EXIT_TYPE = "EXIT"
EXIT_MESSAGE = "Xe %s đã rời vị trí %s"


def session_changelog(events: DataFrame, s: Settings,
                      as_of: int | Column | None = None) -> DataFrame:
    """Changelog of all sessions (see the module doc).

    Keys of at most about ``max_piece_rows`` rows take one sorted pass: the
    window that numbers sessions also sees the next event (``lead``), so the
    last event of a session that went silent emits its TIMEOUT row right
    there, next to its own row (``explode`` of a two-element array, empty
    slot dropped).
    Hot keys use the piecewise scan and a session aggregate for the TIMEOUT
    rows."""
    ev = valid_events(events)
    at = as_of_column(ev, as_of)
    if not s.max_piece_rows:
        return _changelog_of_scan(session_scan(ev, s), s, at)
    ids = hot_key_ids(ev, KEY, s)
    whole, hot = split_hot_keys(ev, KEY, s, ids)
    out = _changelog_whole_keys(whole, s, at)
    if hot is not None:
        out = out.unionByName(_changelog_of_scan(piece_scan(hot, s), s, at))
    return out


def _event_row(s: Settings) -> Column:
    duration = (F.col(T_COL) - F.col("session_start")).cast("long")
    return F.struct(
        *[F.col(k) for k in KEY], F.col("session_no"),
        F.col("session_start").alias("start_time"),
        F.col(T_COL).alias("end_time"),
        duration.alias("duration"),
        block_cost(duration, s).alias("cost"),
        F.when(F.col("is_exit"), F.lit(CLOSED)).otherwise(F.lit(ACTIVE)).alias("status"),
        F.col(T_COL).alias("last_updated"),
        F.col(T_COL).alias("change_time"),
        F.lit(0).cast("long").alias("change_kind"),
        F.col(TIE_COL).alias("event_id"),
    )


def _changelog_whole_keys(ev: DataFrame, s: Settings, as_of: Column) -> DataFrame:
    T = F.lit(s.timeout_seconds)
    scan = whole_key_scan(ev, s, keep_next=True)
    if s.lone_exit == "drop":
        scan = scan.where(~(F.col("starts") & F.col("is_exit")))
    nxt = F.col("next_t")
    # the last event of a session that went silent: the next event comes after
    # a gap, or none comes and the reading time is past the limit
    scan = scan.withColumn(
        "silent", ~F.col("is_exit") & F.when(nxt.isNull(), as_of - F.col(T_COL) > T)
        .otherwise(nxt - F.col(T_COL) > T))
    duration = (F.col(T_COL) - F.col("session_start")).cast("long")
    timeout_row = F.when(F.col("silent"), F.struct(
        *[F.col(k) for k in KEY], F.col("session_no"),
        F.col("session_start").alias("start_time"),
        F.col(T_COL).alias("end_time"),
        duration.alias("duration"),
        block_cost(duration, s).alias("cost"),
        F.lit(TIMEOUT).alias("status"),
        F.col(T_COL).alias("last_updated"),
        (F.col(T_COL) + T).cast("long").alias("change_time"),
        F.lit(1).cast("long").alias("change_kind"),
        F.col(TIE_COL).alias("event_id"),
    ))
    rows = F.array(_event_row(s), timeout_row)
    return (scan.select(F.explode(rows).alias("r"))
            .where(F.col("r").isNotNull()).select("r.*"))


def _changelog_of_scan(scan: DataFrame, s: Settings, as_of: Column) -> DataFrame:
    if s.lone_exit == "drop":
        scan = scan.where(~(F.col("starts") & F.col("is_exit")))
    event_rows = scan.select(F.col("*"), _event_row(s).alias("r")).select("r.*")
    sessions = sessions_from_scan(scan, s, as_of, last_event_id=True)
    timeout_rows = sessions.where(F.col("status") == TIMEOUT).select(
        *KEY, "session_no", "start_time", "end_time", "duration", "cost", "status",
        "last_updated",
        (F.col("end_time") + F.lit(s.timeout_seconds)).cast("long").alias("change_time"),
        F.lit(1).cast("long").alias("change_kind"),
        F.col("last_event_id").alias("event_id"),
    )
    return event_rows.unionByName(timeout_rows)


def change_order(*payload: str) -> Column:
    """Struct that sorts changes in the order they happen, carrying payload."""
    return F.struct(
        F.col("change_time").alias("o_time"), F.col("change_kind").alias("o_kind"),
        F.coalesce(F.col("event_id"), F.lit(0)).alias("o_id"),
        F.col("location").alias("o_loc"),
        *[F.col(p) for p in payload])


def with_change_order(rows: DataFrame, s: Settings) -> DataFrame:
    """Session rows of a live changelog (table or wire) with the columns that
    order changes: a row changes its session at its last event, a TIMEOUT row
    at ``end_time + limit``; within one second the last event's id decides, or
    what stands for it (``start_event_id``, the message's ``offset``)."""
    silent = F.col("status") == F.lit(TIMEOUT)
    ids = [F.col(c) for c in ("last_event_id", "start_event_id", "offset") if c in rows.columns]
    return rows.withColumns({
        "change_time": (F.col("end_time") + F.when(silent, F.lit(s.timeout_seconds)).otherwise(0)).cast("long"),
        "change_kind": silent.cast("long"),
        "event_id": F.coalesce(*ids, F.lit(0)).cast("long") if ids else F.lit(0).cast("long")})


def exit_notifications(sessions: DataFrame, include_timeouts: bool = False,
                       message: str = EXIT_MESSAGE) -> DataFrame:
    """One notification per ended session (CLOSED; TIMEOUT too on request)."""
    ended = [CLOSED, TIMEOUT] if include_timeouts else [CLOSED]
    return sessions.where(F.col("status").isin(ended)).select(
        F.when(F.col("status") == CLOSED, F.lit(EXIT_TYPE)).otherwise(F.col("status")).alias("type"),
        "license_plate", "location", "duration", "cost",
        F.col("end_time").alias("timestamp"),
        F.format_string(message, F.col("license_plate"), F.col("location")).alias("message"),
    )


SESSION_FIELDS = ["license_plate", "location", "start_time", "end_time", "duration",
                  "cost", "status", "last_updated"]


def encode_changelog(rows: DataFrame) -> DataFrame:
    """Wire form of session rows: key = plate, value = JSON of the session
    fields (the input of a Kafka sink)."""
    return rows.select(
        F.col("license_plate").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in SESSION_FIELDS])).alias("value"),
    )
