"""Batch sessionization: events -> one row per parking session.

Rules (per key ``(license_plate, location)``, events ordered by
``(timestamp_unix, event_id)``):

* an event opens a session when the key has no open session: it is the key's
  first event, the previous event was an EXITING, or the silence since the
  previous event is longer than ``timeout_seconds``;
* every other event extends the open session (any status, also unknown or
  null ones);
* an EXITING closes the session (CLOSED); a session followed by a silence
  longer than the limit, or silent for longer than that at ``as_of``, is
  TIMEOUT and ends at its last event; any other session is ACTIVE.

Scale. A per-key window would send every event of one key to one task; one
car on one spot may hold a large share of a stream. The scan is therefore cut
into bounded ``(key, bucket, sub)`` pieces (:mod:`bayline.operators.pieces`:
time buckets of ``bucket_seconds``, hot ones cut again by a range split):

1. one shuffle on the piece; inside a piece ``lag`` and running sums
   find the session starts that do not depend on earlier pieces;
2. each piece is reduced to one summary row (first time, last event, number
   of starts, last start time): its last row, flagged by ``lead`` and kept
   by a filter, in the same partitioning, so no aggregation and no shuffle;
3. a window over the summaries of one key (one row per non-empty piece, not
   per event) decides whether a piece's first event starts a session and
   carries session number and session start forward;
4. the summaries join back on the piece; the event side keeps its
   partitioning, only the small side moves.

Sessions are then a ``groupBy`` with partial aggregation before the shuffle,
so even a session holding most events of the input is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bayline.functions.clock import as_of_column
from bayline.functions.pricing import block_cost, session_status
from bayline.operators.pieces import PIECE, hot_key_ids, scan_facts, split_hot_keys, with_pieces
from bayline.params import EXITING, Settings

KEY = ["license_plate", "location"]
T_COL, TIE_COL = "timestamp_unix", "event_id"


def valid_events(events: DataFrame) -> DataFrame:
    """Rows that can be keyed and placed in time (the rest is quarantined)."""
    cols = events.columns
    tie = F.col(TIE_COL) if TIE_COL in cols else F.lit(0).cast("long")
    return (
        events.where(F.col("license_plate").isNotNull()
                     & F.col("location").isNotNull()
                     & F.col(T_COL).isNotNull())
        .select(*KEY, F.col(T_COL).cast("long").alias(T_COL),
                tie.cast("long").alias(TIE_COL), "status_code")
    )


def _running(w) -> Window:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


SEED_BUCKET = -(2 ** 62)


SCAN_COLUMNS = [*KEY, T_COL, TIE_COL, "status_code", "is_exit", "starts", "session_no",
                "session_start"]


def session_scan(events: DataFrame, s: Settings, split_on_exit: bool = True,
                 seed: DataFrame | None = None,
                 hot_keys: list[tuple] | None = None) -> DataFrame:
    """Every valid event with ``session_no`` (1-based per key) and
    ``session_start`` (time of the session's first event).

    Keys of at most about ``max_piece_rows`` rows (found by a sampled count,
    :func:`bayline.operators.pieces.split_hot_keys`) are scanned whole: one
    sorted window pass, no join. Hot keys take the piecewise scan described in
    the module doc; the two parts are unioned.

    ``seed`` (key, ``start_time``, ``last_time``, ``last_event_id``) gives
    sessions still open from earlier input: each enters the carry as a piece
    before all others, so it is session 1 of its key and later events extend
    it or follow it by the same rules (all keys take the piecewise scan then).

    Output: key, ``timestamp_unix``, ``event_id``, ``status_code``,
    ``is_exit``, ``starts`` (the event opens its session), ``session_no``,
    ``session_start``.
    """
    ev = valid_events(events)
    if not s.max_piece_rows:
        return _piece_scan(ev, s, split_on_exit, seed)
    ids = hot_key_ids(ev, KEY, s, hot_keys)
    whole, hot = (ev, None) if ids is None else split_hot_keys(ev, KEY, s, ids)
    seed_whole, seed_hot = (split_hot_keys(seed, KEY, s, ids) if seed is not None and ids is not None
                            else (seed, None))
    out = _whole_key_scan(_with_exit(whole), s, split_on_exit, seed_whole)
    if hot is not None:
        out = out.unionByName(_piece_scan(hot, s, split_on_exit, seed_hot))
    return out


def _with_exit(ev: DataFrame) -> DataFrame:
    return ev.withColumn("is_exit",
                         F.coalesce(F.col("status_code") == F.lit(EXITING), F.lit(False)))


def _ends_previous(w, s: Settings, split_on_exit: bool) -> tuple[Column, Column]:
    prev_t = F.lag(T_COL).over(w)
    ends = F.col(T_COL) - prev_t > F.lit(s.timeout_seconds)
    if split_on_exit:
        ends = F.lag("is_exit").over(w) | ends
    return prev_t.isNotNull() & ends, prev_t


def _whole_key_scan(ev: DataFrame, s: Settings, split_on_exit: bool,
                    seed: DataFrame | None = None, keep_next: bool = False) -> DataFrame:
    """Session numbers with one window over the whole key (a key small enough
    for one task). A ``seed`` session enters as a leading row of its key (at
    its last event, carrying its start) and is left out of the output."""
    ev = ev.withColumn("seed_start", F.lit(None).cast("long"))
    if seed is not None:
        ev = ev.unionByName(seed.select(
            *KEY, F.col("last_time").cast("long").alias(T_COL),
            F.col("last_event_id").cast("long").alias(TIE_COL),
            F.lit(None).cast("string").alias("status_code"), F.lit(False).alias("is_exit"),
            F.col("start_time").cast("long").alias("seed_start")))
    is_seed = F.col("seed_start").isNotNull()
    order = [T_COL, TIE_COL] if seed is None else [(~is_seed).alias("o"), T_COL, TIE_COL]
    w = Window.partitionBy(*KEY).orderBy(*order)
    inner_start, prev_t = _ends_previous(w, s, split_on_exit)
    out = ev.withColumn("starts", prev_t.isNull() | inner_start)
    out = out.withColumn("session_no", F.sum(F.col("starts").cast("long")).over(_running(w)))
    start_value = F.coalesce(F.col("seed_start"), F.col(T_COL))
    out = out.withColumn(
        "session_start", F.max(F.when(F.col("starts"), start_value)).over(_running(w)))
    extra = []
    if keep_next:
        out = out.withColumn("next_t", F.lead(T_COL).over(w))
        extra = ["next_t"]
    if seed is not None:
        out = out.where(~is_seed)
    return out.select(*SCAN_COLUMNS, *extra)


def _piece_scan(ev: DataFrame, s: Settings, split_on_exit: bool,
                seed: DataFrame | None) -> DataFrame:
    """Session numbers for keys cut into pieces, carried across pieces."""
    T = F.lit(s.timeout_seconds)
    ev = _with_exit(with_pieces(ev, KEY, T_COL, [T_COL, TIE_COL], s))

    w_in = Window.partitionBy(*KEY, *PIECE).orderBy(T_COL, TIE_COL)
    prev_t = F.lag(T_COL).over(w_in)
    prev_exit = F.lag("is_exit").over(w_in)
    ends_prev = (F.col(T_COL) - prev_t > T)
    if split_on_exit:
        ends_prev = prev_exit | ends_prev
    # a start found inside the piece (the piece's first row is decided later)
    inner = ev.withColumn("inner_start", (prev_t.isNotNull() & ends_prev).cast("int"))
    inner = inner.withColumn("piece_first", prev_t.isNull())
    inner = inner.withColumn("inner_no", F.sum("inner_start").over(_running(w_in)))
    inner = inner.withColumn(
        "inner_start_t",
        F.max(F.when(F.col("inner_start") == 1, F.col(T_COL))).over(_running(w_in)))
    inner = inner.withColumn("piece_first_t", F.min(T_COL).over(_running(w_in)))
    inner = inner.withColumn("piece_last", F.lead(T_COL).over(w_in).isNull())

    # one row per piece: its last row carries the piece's totals (a filter in
    # the same partitioning, no aggregation and no shuffle)
    summary = inner.where(F.col("piece_last")).select(
        *KEY, *PIECE,
        F.col("piece_first_t").alias("first_t"),
        F.struct(F.col(T_COL).alias("t"), F.col(TIE_COL).alias("id"),
                 F.col("is_exit").alias("x")).alias("last"),
        F.col("inner_no").cast("long").alias("inner_total"),
        F.col("inner_start_t").alias("inner_last_start_t"),
    )
    if seed is not None:
        summary = summary.unionByName(seed.select(
            *KEY, F.lit(SEED_BUCKET).cast("long").alias("bucket"),
            F.lit(-1).cast("int").alias("sub"),
            F.col("last_time").cast("long").alias("first_t"),
            F.struct(F.col("last_time").cast("long").alias("t"),
                     F.col("last_event_id").cast("long").alias("id"),
                     F.lit(False).alias("x")).alias("last"),
            F.lit(0).cast("long").alias("inner_total"),
            F.col("start_time").cast("long").alias("inner_last_start_t")))
    w_b = Window.partitionBy(*KEY).orderBy(*PIECE)
    before = w_b.rowsBetween(Window.unboundedPreceding, -1)
    prev_last = F.lag("last").over(w_b)
    first_ends = (F.col("first_t") - prev_last["t"] > T)
    if split_on_exit:
        first_ends = prev_last["x"] | first_ends
    carried = summary.withColumn(
        "first_start", F.when(prev_last.isNull() | first_ends, 1).otherwise(0))
    carried = carried.withColumn(
        "bucket_last_start_t",
        F.coalesce(F.col("inner_last_start_t"),
                   F.when(F.col("first_start") == 1, F.col("first_t"))))
    carried = carried.select(
        *KEY, *PIECE, "first_start", "first_t",
        F.coalesce(F.sum(F.col("first_start") + F.col("inner_total")).over(before),
                   F.lit(0)).cast("long").alias("carry_no"),
        F.last("bucket_last_start_t", ignorenulls=True).over(before).alias("carry_start_t"),
    )

    out = inner.join(carried, [*KEY, *PIECE], "inner")
    starts = (F.col("inner_start") == 1) | (F.col("piece_first") & (F.col("first_start") == 1))
    return out.select(
        *KEY, T_COL, TIE_COL, "status_code", "is_exit", starts.alias("starts"),
        (F.col("carry_no") + F.col("first_start") + F.col("inner_no")).cast("long").alias("session_no"),
        F.coalesce(F.col("inner_start_t"),
                   F.when(F.col("first_start") == 1, F.col("first_t")),
                   F.col("carry_start_t")).cast("long").alias("session_start"),
    )


def sessions_from_scan(scan: DataFrame, s: Settings, as_of: Column,
                       split_on_exit: bool = True, last_event_id: bool = False) -> DataFrame:
    extra = [F.max(F.struct(T_COL, TIE_COL))[TIE_COL].alias("last_event_id")] if last_event_id else []
    g = scan.groupBy(*KEY, "session_no").agg(
        F.min(T_COL).alias("start_time"),
        F.max(T_COL).alias("end_time"),
        F.count(F.lit(1)).alias("n_events"),
        F.max(F.col("is_exit").cast("int")).alias("closed"),
        *extra,
    )
    if split_on_exit and s.lone_exit == "drop":
        g = g.where(~((F.col("n_events") == 1) & (F.col("closed") == 1)))
    closed = (F.col("closed") == 1) if split_on_exit else F.lit(False)
    duration = (F.col("end_time") - F.col("start_time")).cast("long")
    return g.select(
        *KEY, "session_no", "start_time", "end_time",
        duration.alias("duration"),
        block_cost(duration, s).alias("cost"),
        session_status(closed, F.col("end_time"), as_of, s).alias("status"),
        F.col("end_time").alias("last_updated"),
        F.col("n_events").cast("long").alias("n_events"),
        *([F.col("last_event_id")] if last_event_id else []),
    )


def event_facts(events: DataFrame, s: Settings) -> tuple[int | None, list[tuple]]:
    """``(as_of, hot_keys)`` of ``events`` in one pass, for
    :func:`parking_sessions` and :func:`gap_sessions`."""
    return scan_facts(valid_events(events), KEY, T_COL, s)


def parking_sessions(events: DataFrame, s: Settings, as_of: int | Column | None = None,
                     hot_keys: list[tuple] | None = None) -> DataFrame:
    """One row per session: key, ``session_no``, ``start_time``, ``end_time``,
    ``duration``, ``cost``, ``status``, ``last_updated``, ``n_events``. With
    ``as_of`` and ``hot_keys`` given (:func:`event_facts`) the events are read
    once and, unless a key is hot, no job runs while the query is built."""
    scan = session_scan(events, s, hot_keys=hot_keys)
    return sessions_from_scan(scan, s, as_of_column(valid_events(events), as_of))


def gap_sessions(events: DataFrame, s: Settings, as_of: int | Column | None = None,
                 hot_keys: list[tuple] | None = None) -> DataFrame:
    """Sessions split by silence only (no exit rule); status TIMEOUT or ACTIVE."""
    scan = session_scan(events, s, split_on_exit=False, hot_keys=hot_keys)
    return sessions_from_scan(scan, s, as_of_column(valid_events(events), as_of),
                              split_on_exit=False)


def with_previous(events: DataFrame, s: Settings) -> DataFrame:
    """Every valid event with ``has_prev`` and ``prev_status`` (the status of
    the key's previous event), computed piecewise like :func:`session_scan`:
    ``lag`` inside a piece, and for a piece's first event the
    last event of the key's previous non-empty piece."""
    ev = valid_events(events)
    if not s.max_piece_rows:
        return _previous_in_pieces(ev, s)
    whole, hot = split_hot_keys(ev, KEY, s)
    w = Window.partitionBy(*KEY).orderBy(T_COL, TIE_COL)
    out = whole.select(
        *KEY, T_COL, TIE_COL, "status_code",
        F.lag(T_COL).over(w).isNotNull().alias("has_prev"),
        F.lag("status_code").over(w).alias("prev_status"))
    if hot is not None:
        out = out.unionByName(_previous_in_pieces(hot, s))
    return out


def _previous_in_pieces(ev: DataFrame, s: Settings) -> DataFrame:
    ev = with_pieces(ev, KEY, T_COL, [T_COL, TIE_COL], s)
    w_in = Window.partitionBy(*KEY, *PIECE).orderBy(T_COL, TIE_COL)
    inner = ev.select(
        "*", F.lag(T_COL).over(w_in).isNotNull().alias("has_inner_prev"),
        F.lag("status_code").over(w_in).alias("inner_prev_status"),
        F.lead(T_COL).over(w_in).isNull().alias("piece_last"))
    # a piece's last row is its summary (a filter, no aggregation)
    last = inner.where(F.col("piece_last")).select(
        *KEY, *PIECE, F.struct(F.col("status_code").alias("status")).alias("last"))
    w_b = Window.partitionBy(*KEY).orderBy(*PIECE)
    carried = last.select(*KEY, *PIECE, F.lag("last").over(w_b).alias("prev_piece_last"))
    out = inner.join(carried, [*KEY, *PIECE], "inner")
    return out.select(
        *KEY, T_COL, TIE_COL, "status_code",
        (F.col("has_inner_prev") | F.col("prev_piece_last").isNotNull()).alias("has_prev"),
        F.when(F.col("has_inner_prev"), F.col("inner_prev_status"))
        .otherwise(F.col("prev_piece_last.status")).alias("prev_status"),
    )


def whole_key_scan(ev: DataFrame, s: Settings, split_on_exit: bool = True,
                   keep_next: bool = False) -> DataFrame:
    """:func:`session_scan` for valid events of keys small enough for one task;
    ``keep_next`` adds ``next_t``, the time of the key's next event."""
    out = _whole_key_scan(_with_exit(ev), s, split_on_exit, keep_next=keep_next)
    return out


def piece_scan(ev: DataFrame, s: Settings, split_on_exit: bool = True) -> DataFrame:
    """:func:`session_scan` for valid events of hot keys (piecewise)."""
    return _piece_scan(ev, s, split_on_exit, None)
