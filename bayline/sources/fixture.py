"""Adapter from the driver's ``events`` table to parking events (tests/bench).

The table has ``event_id, ts, user_id, event_type, value, props``. Each user
becomes one car that visits three spots; each spot column is shared by two
users, so both conflict audits have work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayline.functions.clock import TIME_TEXT
from bayline.params import Settings

# Inactivity limit for the fixture (two days) and the mapping
# of event types to camera statuses.
FIXTURE_TIMEOUT_SECONDS = 172800
STATUS_OF_EVENT_TYPE = {
    "signup": "ENTERING",
    "view": "PARKED",
    "click": "PARKED",
    "error": "MOVING",
    "purchase": "EXITING",
}
ROWS = "ABCDEF"


def fixture_settings(**kw) -> Settings:
    """Replays feed the table in time order unless a query says otherwise: no
    row needs waiting for."""
    kw.setdefault("watermark_delay", "0 seconds")
    return Settings(timeout_seconds=FIXTURE_TIMEOUT_SECONDS, rows=ROWS, **kw)


def _status(event_type: Column) -> Column:
    expr = None
    for src, dst in STATUS_OF_EVENT_TYPE.items():
        expr = (F.when(event_type == src, F.lit(dst)) if expr is None
                else expr.when(event_type == src, F.lit(dst)))
    return expr


def epoch_seconds_ntz(ts: Column) -> Column:
    """Whole seconds since 1970 of a TIMESTAMP_NTZ read as UTC.

    Built from field extractions only (day number, hour, minute, second), so
    no session time zone or daylight-saving rule takes part.
    """
    day = F.unix_date(ts.cast("date")).cast("long")
    return (day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("long")


def parking_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parking events from the driver's ``events`` table (narrow, no shuffle);
    ``keep`` names table columns to pass through."""
    uid = F.col("user_id")
    row = F.substr(F.lit(ROWS), (uid % 6 + 1).cast("int"), F.lit(1))
    col = (F.floor(uid / 12) * 3 + F.col("event_id") % 3 + 1).cast("long")
    return events.select(
        F.col("event_id"),
        F.date_format("ts", TIME_TEXT).alias("timestamp"),
        epoch_seconds_ntz(F.col("ts")).cast("long").alias("timestamp_unix"),
        F.concat(F.lit("P"), F.lpad(uid.cast("string"), 6, "0")).alias("license_plate"),
        F.concat(row, col.cast("string")).alias("location"),
        _status(F.col("event_type")).alias("status_code"),
        *[F.col(k) for k in keep],
    )


def fixture_n_cols(events: DataFrame) -> int:
    """Spot columns of the fixture: ``(max(user_id) div 12) * 3 + 4``. One
    scalar aggregate (partial max per task); the dimension size must be known
    on the driver to decide whether it may be broadcast."""
    row = events.agg((F.floor(F.max("user_id") / 12) * 3 + 4).cast("long").alias("n")).first()
    return int(row["n"] or 4)
