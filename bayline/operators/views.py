"""Read views over sessions and the changelog, all at one reading time.

``as_of`` is a column (by default the latest event time, see
:func:`bayline.functions.clock.as_of_column`), so one snapshot of several
views uses one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayline.functions.pricing import block_cost, live_duration
from bayline.operators.changelog import SESSION_FIELDS, change_order
from bayline.params import ACTIVE, CLOSED, TIMEOUT, Settings


def _live(start: Column, as_of: Column, s: Settings) -> list[Column]:
    d = live_duration(start, as_of)
    return [d.alias("duration"), block_cost(d, s).alias("cost")]


def active_sessions(sessions: DataFrame, as_of: Column, s: Settings) -> DataFrame:
    """Open sessions keyed by plate and spot, with live duration and cost."""
    return sessions.where(F.col("status") == ACTIVE).select(
        "license_plate", "location", "start_time", *_live(F.col("start_time"), as_of, s),
        F.lit(ACTIVE).alias("status"))


def _terminal(s: Settings) -> list[str]:
    return [ACTIVE, CLOSED, TIMEOUT] if s.timeout_is_terminal else [ACTIVE, CLOSED]


def active_by_plate(changelog: DataFrame, as_of: Column, s: Settings) -> DataFrame:
    """One row per plate whose latest change is ACTIVE (a car seen at two spots
    keeps the later one; an exit at any spot removes the plate)."""
    last = (changelog.where(F.col("status").isin(_terminal(s)))
            .groupBy("license_plate")
            .agg(F.max(change_order("status", "start_time")).alias("l")))
    return last.where(F.col("l.status") == ACTIVE).select(
        "license_plate", F.col("l.o_loc").alias("location"),
        F.col("l.start_time").alias("start_time"),
        *_live(F.col("l.start_time"), as_of, s),
        F.lit(ACTIVE).alias("status"))


def occupancy(changelog: DataFrame, s: Settings) -> DataFrame:
    """Per visited spot, its latest change: an ACTIVE change marks it
    occupied, an exit (or timeout) frees it."""
    last = (changelog.where(F.col("status").isin(_terminal(s)))
            .groupBy("location")
            .agg(F.max(change_order("license_plate", "status")).alias("l")))
    return last.select(
        "location", F.col("l.license_plate").alias("license_plate"),
        F.col("l.status").alias("last_status"),
        (F.col("l.status") == ACTIVE).alias("occupied"))


def busy_locations(sessions: DataFrame, ordered: bool = False) -> DataFrame:
    """Distinct spots with at least one open session (``ordered``: sorted by
    spot id as text, A1, A10, A2, like the reference's lists)."""
    df = sessions.where(F.col("status") == ACTIVE).select("location").distinct()
    return df.orderBy("location") if ordered else df


def free_locations(dim: DataFrame, sessions: DataFrame, ordered: bool = False) -> DataFrame:
    """Spots of the dimension with no open session."""
    df = dim.select("location").join(busy_locations(sessions), "location", "left_anti")
    return df.orderBy("location") if ordered else df


def location_info(dim: DataFrame, sessions: DataFrame, as_of: Column, s: Settings,
                  location_id: str | None = None) -> DataFrame:
    """Every spot (or the one named by ``location_id``, any case): OCCUPIED
    with the earliest-started open session there, or FREE with nulls. An id
    outside the dimension gives no row (see :func:`valid_locations`)."""
    if location_id is not None:
        wanted = F.lit(location_id.upper())
        dim = dim.where(F.col("location") == wanted)
        sessions = sessions.where(F.col("location") == wanted)
    occ = (sessions.where(F.col("status") == ACTIVE)
           .groupBy("location")
           .agg(F.min(F.struct("start_time", "license_plate")).alias("o")))
    return dim.select("location").join(occ, "location", "left").select(
        "location",
        F.when(F.col("o").isNotNull(), F.lit("OCCUPIED")).otherwise(F.lit("FREE")).alias("status"),
        F.col("o.license_plate").alias("license_plate"),
        F.col("o.start_time").alias("start_time"),
        *_live(F.col("o.start_time"), as_of, s))


def closed_history(sessions: DataFrame, limit: int, retention: int | None = None) -> DataFrame:
    """The ``limit`` most recent closed sessions, newest first (top-k per
    task, then a final top-k of those: no full sort). ``retention``, if given,
    is the number of sessions a bounded view store holds: a reader gets no
    more than that, whatever they ask for. There is no cap without it."""
    if limit < 0:
        raise ValueError("limit must be >= 0")
    if retention is not None:
        limit = min(limit, retention)
    return (sessions.where(F.col("status") == CLOSED)
            .select(*SESSION_FIELDS)
            .orderBy(F.col("end_time").desc(), "license_plate", "location", "start_time")
            .limit(limit))


def statistics(dim: DataFrame, sessions: DataFrame, s: Settings) -> DataFrame:
    """One row: total_locations, busy_count, free_count, active_sessions,
    closed_sessions_total.

    The sessions are read once: their per-spot flags and the grid's spots are
    unioned and counted per spot in one partially aggregated ``groupBy`` (a
    session at a spot outside the grid still counts), then one aggregate gives
    all five values.
    """
    flags = sessions.select(
        "location", F.lit(0).alias("in_grid"),
        (F.col("status") == ACTIVE).cast("long").alias("n_active"),
        (F.col("status") == CLOSED).cast("long").alias("n_closed"))
    grid = dim.select("location", F.lit(1).alias("in_grid"),
                      F.lit(0).cast("long").alias("n_active"),
                      F.lit(0).cast("long").alias("n_closed"))
    per_spot = grid.unionByName(flags).groupBy("location").agg(
        F.max("in_grid").alias("in_grid"), F.sum("n_active").alias("n_active"),
        F.sum("n_closed").alias("n_closed"))
    in_grid = F.col("in_grid") == 1
    total = F.count(F.when(in_grid, 1)).cast("long")
    n_busy = F.count(F.when(in_grid & (F.col("n_active") > 0), 1)).cast("long")
    return per_spot.agg(
        total.alias("total_locations"),
        n_busy.alias("busy_count"),
        (total - n_busy).alias("free_count"),
        F.coalesce(F.sum("n_active"), F.lit(0)).cast("long").alias("active_sessions"),
        F.coalesce(F.sum("n_closed"), F.lit(0)).cast("long").alias("closed_sessions_total"),
    )


def snapshot(dim: DataFrame, sessions: DataFrame, as_of: Column, s: Settings) -> dict:
    """The views a client gets on connect, all at one reading time: active
    sessions, statistics, free and busy spots (sorted)."""
    return {
        "active_sessions": active_sessions(sessions, as_of, s),
        "statistics": statistics(dim, sessions, s),
        "free_locations": free_locations(dim, sessions, ordered=True),
        "busy_locations": busy_locations(sessions, ordered=True),
    }
