"""Reading time (``as_of``) for the views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_of_column(events: DataFrame, as_of: int | Column | None = None,
                 time_col: str = "timestamp_unix") -> Column:
    """``as_of`` as a column.

    ``None`` means the latest event time of ``events``: a scalar subquery, run
    once as its own small aggregate (partial max per task) and folded into the
    plan as a constant, so no cross join and no driver round trip in user code.
    """
    if as_of is None:
        return events.agg(F.max(time_col)).scalar()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(int(as_of)).cast("long")


def now_seconds() -> Column:
    """Wall clock in Unix seconds (for live durations instead of event time)."""
    return F.unix_timestamp()


# Fixed value: the text form of an event time.
TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def now_text() -> Column:
    """Wall clock as ``yyyy-MM-dd HH:mm:ss`` in the session time zone."""
    return F.date_format(F.current_timestamp(), TIME_TEXT)
