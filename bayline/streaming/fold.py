"""The keyed session fold run by ``applyInPandasWithState``.

A call per key costs some milliseconds, whatever the key's rows: a stream of
many keys spent its time there. So keys are dealt to ``state_groups`` groups by
their hash (:func:`key_group`), a call gets the rows of all keys of a group, and
numpy folds them together (:func:`fold_keys`, the rules of :func:`fold_runs`).
The state of a group is one row of arrays, an entry for each open session; its
timer is the earliest of their timers, and each call ends all that are due. On
processing time (:func:`make_fold`) a key still has a state of its own.

State per ``(license_plate, location)`` is four numbers of the open session
(start, last event time, number of events, id of the first event), never a
list of events. ``(key, start_time, start_event_id)`` names a session even
when two sessions of a key start in the same second. Rows of
one key in one trigger arrive in several Arrow chunks and in no promised
order; they are concatenated (bounded by the trigger size:
``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``), sorted by
``(timestamp_unix, event_id)`` and folded with numpy, not row by row.

The same rules as the batch job (:mod:`bayline.operators.sessionize`):
a gap longer than the limit or an EXITING splits; an EXITING closes (CLOSED);
a session followed by a long gap is TIMEOUT at its last event. Timeouts run
on event time: the timer is ``(last + limit)`` seconds and fires when the
watermark passes it, so a replay gives the same answer as the live run.

No row is dropped: a row at or behind the watermark doesn't touch the state but
leaves as a row of its own (``side`` is ``late``, ``note`` its status), which
:func:`bayline.streaming.jobs.start_changelog` writes to the late table.

What is folded are runs: pieces of one session (start, end, number of events,
first id, whether an EXITING ends it) in time order. An event is a run of one;
:mod:`bayline.streaming.salted` folds rows to longer runs before the state.
Runs of adjacent pieces join by the same two rules as events do, so folding is
associative: any cut into pieces gives the same sessions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from bayline.operators.sessionize import KEY
from bayline.params import ACTIVE, CLOSED, EXITING, TIMEOUT, Settings

OUTPUT = StructType([
    StructField("license_plate", StringType()),
    StructField("location", StringType()),
    StructField("start_time", LongType()),
    StructField("end_time", LongType()),
    StructField("duration", LongType()),
    StructField("cost", LongType()),
    StructField("status", StringType()),
    StructField("last_updated", LongType()),
    StructField("n_events", LongType()),
    StructField("start_event_id", LongType()),
])
# a row that is no session: "late" (``note``: the event's status) or "bad"
# (``note``: the reason, ``raw``: the message)
SIDE = [StructField("side", StringType()), StructField("note", StringType()), StructField("raw", StringType())]
FOLD_OUTPUT = StructType([*OUTPUT.fields, *SIDE])
LATE, BAD = "late", "bad"
STATE = StructType([
    StructField("start_time", LongType()),
    StructField("last_time", LongType()),
    StructField("n_events", LongType()),
    StructField("start_event_id", LongType()),
])
OUT_COLS = [f.name for f in OUTPUT.fields]
GROUP = "key_group"
# of a group: the open sessions, and the rows that wait for the watermark
GROUP_OPEN = StructType([StructField(k, ArrayType(StringType())) for k in KEY]
                        + [StructField(f.name, ArrayType(LongType())) for f in STATE.fields])
WAITING = {"waiting_plate": StringType(), "waiting_location": StringType(), "waiting_t": LongType(),
           "waiting_id": LongType(), "waiting_status": StringType()}
GROUP_WAITING = StructType([*GROUP_OPEN.fields, *[StructField(k, ArrayType(v)) for k, v in WAITING.items()]])
# an ordered form's timer lies half a second ahead of the row it waits for, so
# that "behind the watermark" takes in the row at it
HALF = 500


def _frame(plate, loc, start, end, status, n, first_id, s: Settings) -> pd.DataFrame:
    """Session rows of one key, or of the keys in the arrays ``plate`` and ``loc``."""
    start = np.asarray(start, dtype="int64")
    end = np.asarray(end, dtype="int64")
    dur = end - start
    cost = (np.ceil(dur / float(s.block_seconds)) * s.block_price).astype("int64")
    k = len(start)
    return pd.DataFrame({
        "license_plate": [plate] * k if isinstance(plate, str) else plate,
        "location": [loc] * k if isinstance(loc, str) else loc,
        "start_time": start, "end_time": end, "duration": dur, "cost": cost,
        "status": status, "last_updated": end,
        "n_events": np.asarray(n, dtype="int64"),
        "start_event_id": np.asarray(first_id, dtype="int64"),
        "side": None, "note": None, "raw": None,
    }, columns=FOLD_OUTPUT.names, copy=False)


def late_frame(plate, loc, t, ids, notes, s: Settings, end=None, n=None) -> pd.DataFrame:
    """Rows (or runs) that came behind the watermark."""
    out = _frame(plate, loc, t, t if end is None else end, None, np.ones(len(t)) if n is None else n, ids, s)
    out["side"], out["note"] = LATE, notes
    return out


def fold_sorted(t: np.ndarray, ids: np.ndarray, is_exit: np.ndarray, open_state, wm_ms: int,
                s: Settings):
    """:func:`fold_runs` of time-ordered events."""
    return fold_runs(t, t, np.ones(len(t), dtype="int64"), ids, is_exit, open_state, wm_ms, s)


def fold_runs(start: np.ndarray, end: np.ndarray, n: np.ndarray, ids: np.ndarray, is_exit: np.ndarray,
              open_state, wm_ms: int, s: Settings):
    """Fold time-ordered runs of one key into its open session.

    ``open_state`` is ``(start, last, n, first_id)`` or ``None``. Returns the
    finished sessions as ``(start, end, status, n, first_id)`` tuples, the
    open session after the fold (or ``None``), and its timeout timer in ms.
    """
    T = int(s.timeout_seconds)
    out = []
    if len(start) == 0:
        return out, open_state, None
    open_ = open_state is not None
    if open_ and start[0] < open_state[0]:
        # runs from before the open session: up to their last break they are
        # sessions of their own, what follows joins the open one
        pre = int(np.searchsorted(start, open_state[0]))
        ends = is_exit[:pre] | (np.append(start[1:pre], open_state[0]) - end[:pre] > T)
        own = int(np.flatnonzero(ends)[-1]) + 1 if ends.any() else 0
        if own:
            older, last, _ = fold_runs(*(x[:own] for x in (start, end, n, ids, is_exit)), None, 0, s)
            out = older if last is None else [*older, (last[0], last[1], TIMEOUT, last[2], last[3])]
            if own == len(start):
                return out, open_state, (open_state[1] + T) * 1000
            more, new_open, timer = fold_runs(*(x[own:] for x in (start, end, n, ids, is_exit)), open_state, wm_ms, s)
            return [*out, *more], new_open, timer
    if open_:
        start0, last0, n0, id0 = open_state
    brk = np.empty(len(start), dtype=bool)
    brk[1:] = is_exit[:-1] | (start[1:] - end[:-1] > T)
    brk[0] = (not open_) or (start[0] - last0 > T)
    bounds = np.flatnonzero(brk)
    first_is_old = open_ and not brk[0]
    if first_is_old:
        bounds = np.r_[0, bounds]
    ends = np.r_[bounds[1:], len(start)] - 1
    starts_t, ends_t, first_ids = start[bounds], end[ends], ids[bounds]
    counts = np.add.reduceat(n, bounds)
    closed = is_exit[ends]
    if first_is_old:
        if (starts_t[0], first_ids[0]) > (start0, id0):
            starts_t[0], first_ids[0] = start0, id0
        ends_t[0] = max(ends_t[0], last0)
        counts[0] += n0
    lone = closed & (counts == 1)
    if first_is_old:
        lone[0] = False
    keep = ~lone if s.lone_exit == "drop" else np.ones(len(bounds), dtype=bool)
    status = np.where(closed, CLOSED, TIMEOUT).astype(object)
    if open_ and not first_is_old:
        # the stored session went silent for longer than the limit
        out.append((start0, last0, TIMEOUT, n0, id0))
    new_open, timer = None, None
    if not closed[-1]:
        timer = (int(ends_t[-1]) + T) * 1000
        if wm_ms > 0 and timer < wm_ms:
            timer = None  # already silent for longer than the limit
        else:
            keep[-1] = False
            new_open = (int(starts_t[-1]), int(ends_t[-1]), int(counts[-1]), int(first_ids[-1]))
    for i in np.flatnonzero(keep):
        out.append((starts_t[i], ends_t[i], status[i], counts[i], first_ids[i]))
    return out, new_open, timer


def _no_open(n_keys: int) -> tuple[np.ndarray, ...]:
    return (np.zeros(n_keys, dtype=bool), *np.zeros((4, n_keys), dtype="int64"))


def _joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(c) for c in zip(*parts))


def fold_keys(key: np.ndarray, runs: tuple[np.ndarray, ...], opened: tuple[np.ndarray, ...], wm_ms: int, s: Settings):
    """:func:`fold_runs` of many keys at once.

    ``key`` numbers the keys from 0; the runs ``(start, end, n, ids, is_exit)``
    come by key, then in time order. ``opened`` is ``(is_open, start, last, n,
    first_id)`` by key number. Returns the finished sessions as arrays ``(key,
    start, end, closed, n, first_id)`` and the open ones after the fold; those of
    keys without runs stay as they are."""
    T = int(s.timeout_seconds)
    is_open, o_start, o_last, o_n, o_id = opened
    start, end, n, ids, is_exit = runs
    if len(key) == 0:
        none = np.empty(0, dtype="int64")
        return (none, none, none, none.astype(bool), none, none), opened
    new_key = np.append(True, key[1:] != key[:-1])
    pre = is_open[key] & (start < o_start[key])
    if pre.any():
        # runs from before a key's open session: up to their last break they
        # are sessions of their own, what follows joins the open one
        last_pre = pre & np.append(~pre[1:] | new_key[1:], True)
        following = np.where(last_pre, o_start[key], np.append(start[1:], 0))
        ends = np.flatnonzero(pre & (is_exit | (following - end > T)))
        cut = np.full(len(is_open), -1)
        cut[key[ends]] = ends
        own = np.arange(len(key)) <= cut[key]
        if own.any():
            older, left = fold_keys(key[own], tuple(x[own] for x in runs), _no_open(len(is_open)), 0, s)
            at = np.flatnonzero(left[0])
            silent = (at, left[1][at], left[2][at], np.zeros(len(at), dtype=bool), left[3][at], left[4][at])
            more, opened = fold_keys(key[~own], tuple(x[~own] for x in runs), opened, wm_ms, s)
            return _joined([older, silent, more]), opened
    brk = np.append(True, is_exit[:-1] | (start[1:] - end[:-1] > T))
    firsts, touched = np.flatnonzero(new_key), key[new_key]
    brk[firsts] = ~is_open[touched] | (start[firsts] - o_last[touched] > T)
    bounds = np.flatnonzero(brk | new_key)
    ends = np.append(bounds[1:], len(key)) - 1
    of, joins = key[bounds], ~brk[bounds]  # joins: goes on with the open session
    starts_t, ends_t, first_ids, closed = start[bounds], end[ends], ids[bounds], is_exit[ends]
    counts = np.add.reduceat(n, bounds) + np.where(joins, o_n[of], 0)
    older = joins & ((starts_t > o_start[of]) | ((starts_t == o_start[of]) & (first_ids > o_id[of])))
    starts_t, first_ids = np.where(older, o_start[of], starts_t), np.where(older, o_id[of], first_ids)
    ends_t = np.where(joins, np.maximum(ends_t, o_last[of]), ends_t)
    keep = ~(closed & (counts == 1) & ~joins) if s.lone_exit == "drop" else np.ones(len(bounds), dtype=bool)
    stays = ~closed & np.append(of[1:] != of[:-1], True)
    if wm_ms > 0:
        stays &= (ends_t + T) * 1000 >= wm_ms  # else already silent for longer than the limit
    keep &= ~stays
    # the stored sessions that went silent for longer than the limit
    gone = touched[is_open[touched] & brk[firsts]]
    out = _joined([(gone, o_start[gone], o_last[gone], np.zeros(len(gone), dtype=bool), o_n[gone], o_id[gone]),
                   tuple(x[keep] for x in (of, starts_t, ends_t, closed, counts, first_ids))])
    after = tuple(x.copy() for x in opened)
    after[0][touched] = False
    at = of[stays]
    for col, new in zip(after, (True, starts_t[stays], ends_t[stays], counts[stays], first_ids[stays])):
        col[at] = new
    return out, after


def _key_numbers(plates: np.ndarray, spots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's key, and of each key a row that holds it."""
    spot, known = pd.factorize(spots)
    key, pairs = pd.factorize(pd.factorize(plates)[0] * (len(known) + 1) + spot)
    row = np.empty(len(pairs), dtype="int64")
    row[key[::-1]] = np.arange(len(key) - 1, -1, -1)
    return key, row


def key_group(s: Settings) -> Column:
    """The group of a key's state."""
    return F.pmod(F.xxhash64(*KEY), F.lit(s.state_groups)).cast("int")


def fold_groups(runs: DataFrame, s: Settings, ordered: bool = False) -> DataFrame:
    """Session changes of a stream of runs (or of events, each a run of one)
    on event time. ``ordered``: events wait for the watermark (see
    :mod:`bayline.streaming.ordered`)."""
    return runs.withColumn(GROUP, key_group(s)).groupBy(GROUP).applyInPandasWithState(
        make_group_fold(s, ordered), FOLD_OUTPUT, GROUP_WAITING if ordered else GROUP_OPEN, "update",
        GroupStateTimeout.EventTimeTimeout)


def make_group_fold(s: Settings, ordered: bool = False):
    T = int(s.timeout_seconds)
    schema = GROUP_WAITING if ordered else GROUP_OPEN
    kinds = [object if f.dataType.elementType == StringType() else "int64" for f in schema.fields]
    n_open = len(GROUP_OPEN.fields)

    def rows_of(pdf: pd.DataFrame):
        """``(plate, location, start, end, n, id, status, is_exit)`` of events or runs."""
        plates, spots = (pdf[k].to_numpy(dtype=object) for k in KEY)
        if "status_code" in pdf.columns:
            # valid_events() upstream guarantees a time on every row
            t, status = pdf["timestamp_unix"].to_numpy(dtype="int64"), pdf["status_code"].to_numpy(dtype=object)
            return [plates, spots, t, t, np.ones(len(t), dtype="int64"), pdf["event_id"].to_numpy(dtype="int64"),
                    status, status == EXITING]
        is_exit = pdf["is_exit"].to_numpy(dtype=bool)
        start, end, n, ids = (pdf[c].to_numpy(dtype="int64") for c in ("start_time", "end_time", "n_events", "start_event_id"))
        return [plates, spots, start, end, n, ids, np.where(is_exit, EXITING, None), is_exit]

    def fold(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [np.array(x, dtype=k) for x, k in zip(state.get if state.exists else [[]] * len(kinds), kinds)]
        opened, waiting = held[:n_open], held[n_open:]
        parts = [] if state.hasTimedOut else [p for p in chunks if len(p)]
        wm = state.getCurrentWatermarkMs()
        frames, rows = [], None
        if parts:
            rows = rows_of(parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True))
            late = (rows[3] * 1000 <= wm) & (wm > 0)
            if late.any():
                plates, spots, start, end, n, ids, status, _ = (x[late] for x in rows)
                frames.append(late_frame(plates, spots, start, ids, status, s, end, n))
                rows = [x[~late] for x in rows]
        if ordered:
            plates, spots, t, ids, status = (
                waiting if rows is None else [np.concatenate(p) for p in zip(waiting, [rows[i] for i in (0, 1, 2, 5, 6)])])
            ready = t * 1000 <= wm
            waiting = [x[~ready] for x in (plates, spots, t, ids, status)]
            plates, spots, t, ids, status = (x[ready] for x in (plates, spots, t, ids, status))
            rows = [plates, spots, t, t, np.ones(len(t), dtype="int64"), ids, status, status == EXITING]
        if rows is None:
            rows = [np.array([], dtype=k) for k in (object, object, *["int64"] * 4, object, bool)]

        n_held = len(opened[0])
        plates, spots = (np.concatenate([a, b]) for a, b in zip(opened[:2], rows[:2]))
        number, row = _key_numbers(plates, spots)
        names = plates[row], spots[row]
        before = _no_open(len(row))
        for col, was in zip(before, (True, *opened[2:])):
            col[number[:n_held]] = was
        of = number[n_held:]
        start, end, n, ids, _, is_exit = rows[2:]
        order = np.lexsort((ids, start, of))
        out, after = fold_keys(of[order], tuple(x[order] for x in (start, end, n, ids, is_exit)), before, wm, s)
        # all that are due end, whether or not their key has rows
        is_open, o_start, o_last, o_n, o_id = after
        due = np.flatnonzero(is_open & ((o_last + T) * 1000 < wm)) if wm > 0 else np.empty(0, dtype="int64")
        is_open[due] = False
        touched = np.zeros(len(row), dtype=bool)
        touched[of] = True
        live = np.flatnonzero(is_open & touched)
        at, start, end, n, ids = (np.concatenate(x) for x in zip(
            [out[i] for i in (0, 1, 2, 4, 5)], *[(a, o_start[a], o_last[a], o_n[a], o_id[a]) for a in (due, live)]))
        if len(at):
            status = np.array([TIMEOUT, CLOSED, ACTIVE], dtype=object)[
                np.concatenate([out[3].astype("int64"), np.zeros(len(due), "int64"), np.full(len(live), 2)])]
            frames.append(_frame(names[0][at], names[1][at], start, end, status, n, ids, s))

        at = np.flatnonzero(is_open)
        if len(at) or (ordered and len(waiting[0])):
            kept = [names[0][at], names[1][at], o_start[at], o_last[at], o_n[at], o_id[at], *waiting]
            timers = [(int(o_last[at].min()) + T) * 1000] if len(at) else []
            if ordered and len(waiting[2]):
                timers.append(int(waiting[2].min()) * 1000 - HALF)
            state.update(tuple(x.tolist() for x in kept))
            state.setTimeoutTimestamp(max(min(timers), wm, 1))
        elif state.exists:
            state.remove()
        if frames:
            yield frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)

    return fold


def rows_frame(plate: str, loc: str, rows: list, s: Settings) -> pd.DataFrame:
    return _frame(plate, loc, [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows],
                  [r[3] for r in rows], [r[4] for r in rows], s)


def make_fold(s: Settings):
    event_time = s.timeout_mode == "event"

    def fold(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        plate, loc = key
        if state.hasTimedOut:
            start0, last0, n0, id0 = state.get
            state.remove()
            yield _frame(plate, loc, [start0], [last0], [TIMEOUT], [n0], [id0], s)
            return

        parts = list(chunks)
        pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        if len(pdf) == 0:
            return
        # valid_events() upstream guarantees a time on every row
        t = pdf["timestamp_unix"].to_numpy(dtype="int64")
        ids = pdf["event_id"].to_numpy(dtype="int64")
        codes = pdf["status_code"].to_numpy()
        order = np.lexsort((ids, t))
        t, ids, is_exit = t[order], ids[order], codes[order] == EXITING

        open_state = state.get if state.exists else None
        wm = state.getCurrentWatermarkMs() if event_time else 0
        n_late = int(np.searchsorted(t * 1000, wm, "right")) if wm > 0 else 0
        if n_late:
            yield late_frame(plate, loc, t[:n_late], ids[:n_late], codes[order][:n_late], s)
            t, ids, is_exit = t[n_late:], ids[n_late:], is_exit[n_late:]
            if len(t) == 0:
                if open_state is not None:
                    # the timer must be set again in each call
                    state.update(open_state)
                    state.setTimeoutTimestamp((open_state[1] + int(s.timeout_seconds)) * 1000)
                return
        out, new_open, timer = fold_sorted(t, ids, is_exit, open_state, wm, s)
        if new_open is None:
            state.remove()
        else:
            state.update(new_open)
            if event_time:
                state.setTimeoutTimestamp(timer)
            else:
                state.setTimeoutDuration(int(s.timeout_seconds) * 1000)
            out.append((new_open[0], new_open[1], ACTIVE, new_open[2], new_open[3]))
        if out:
            yield rows_frame(plate, loc, out, s)

    return fold
