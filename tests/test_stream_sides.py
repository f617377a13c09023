"""Nothing a stream reads is lost: late rows, bad messages, hot keys, live state."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from util import events as _events
from util import sessions_list as _sessions_list

from bayline.operators import sessionize
from bayline.operators.sessionize import valid_events
from bayline.params import Settings
from bayline.plans.runtime import scratch_path
from bayline.streaming import fold, jobs, salted, state_views
from bayline.streaming.ordered import ordered_sessionize_stream
from bayline.streaming.tables import replay_table_slices, table_state_sink

S = Settings(timeout_seconds=3600, bucket_seconds=600, watermark_delay="100 seconds")
OFF = 1_000_000
FORMS = {"keyed": jobs.sessionize_stream, "salted": salted.salted_sessionize_stream, "ordered": ordered_sessionize_stream}


def events(spark, rows, **kw):
    return _events(spark, rows, offset=OFF, **kw)


def test_a_stream_needs_a_delay(spark):
    s = S.with_(watermark_delay=None)
    stream = spark.readStream.format("rate").load().selectExpr(
        "value as event_id", "value as timestamp_unix", "'p' as license_plate", "'A1' as location", "'PARKED' as status_code")
    for build in (*FORMS.values(), jobs.gap_sessions_stream):
        with pytest.raises(ValueError, match="watermark_delay"):
            build(stream, s)
    with pytest.raises(ValueError, match="watermark_delay"):
        table_state_sink("x", s)


@pytest.mark.parametrize("text,seconds", [("0 seconds", 0), ("10 minutes", 600), ("1 day", 86400), ("1 hours 30 minutes", 5400),
                                          ("INTERVAL 2 weeks", 1209600), ("5 sec", 5), ("3min", 180)])
def test_delay_texts(text, seconds):
    assert Settings(watermark_delay=text).delay_seconds == seconds


@pytest.mark.parametrize("text", ["", "soon", "5", "5 parsecs", "1 day later"])
def test_bad_delay_texts(text):
    with pytest.raises(ValueError):
        _ = Settings(watermark_delay=text).delay_seconds


def disordered(seed):
    """Three batches of events; many lie far behind the newest of the batch before."""
    r = random.Random(seed)
    batches, at = [], 0
    for _ in range(3):
        batches.append([(max(0, at + r.randrange(-3000, 1500)), r.choice(["PARKED", "PARKED", "ENTERING", "EXITING"]),
                         r.choice(["A1", "B1"])) for _ in range(40)])
        at += 2000
    return batches


def split_by_clock(batches, delay):
    accepted, late, clock = [], [], None
    for b in batches:
        for row in b:
            behind = clock is not None and row[0] <= clock - delay
            (late if behind else accepted).append(row)
        clock = max([r[0] for r in b] + ([clock] if clock is not None else []))
    return accepted, late


@pytest.mark.parametrize("form", [*FORMS, "table"])
def test_accepted_and_late_add_up_to_the_input(spark, form):
    batches = disordered(4)
    accepted, late = split_by_clock(batches, 100)
    assert len(late) > 20
    base = scratch_path(spark, f"sides-{form}")
    slices = [valid_events(events(spark, b)) for b in batches]
    if form == "table":
        replay_table_slices(spark, slices, S, base)
        gone = spark.read.parquet(f"{base}/late")
        clock = spark.read.parquet(f"{base}/clock").agg(F.max("epoch_id")).first()[0]
        taken = state_views.accepted_events(spark.read.parquet(f"{base}/changelog"),
                                            spark.read.parquet(f"{base}/open/epoch_id={clock}"))
        got_late = [(r.timestamp_unix - OFF, r.status_code, r.location) for r in gone.collect()]
    else:
        table = jobs.replay_slices(spark, slices, lambda s: FORMS[form](s, S), base=base)
        ckpt, ordered = f"{base}/checkpoint", form == "ordered"
        taken = state_views.accepted_events(
            spark.read.parquet(table), state_views.open_sessions(spark, ckpt, ordered),
            state_views.waiting_rows(spark, ckpt) if ordered else None)
        gone = spark.read.parquet(f"{table}-late")
        got_late = [(r.timestamp_unix - OFF, r.status_code, r.location) for r in gone.collect()]
    if form == "salted":
        # runs are late as a whole: their events are counted, not listed
        n_late = gone.agg(F.sum("n_events")).first()[0]
        assert n_late > 20 and taken.first().n + n_late == sum(map(len, batches))
        assert all(r.last_time - OFF <= 4000 for r in gone.collect())
    else:
        assert sorted(got_late) == sorted((t, c, spot) for t, c, spot in late)
        assert taken.first().n == len(accepted)


def test_bad_messages_leave_by_the_same_query(spark):
    import json
    from bayline.sources import raw
    good = [json.dumps({"timestamp_unix": OFF + t, "license_plate": "p", "location": "A1", "status_code": "PARKED"}) for t in (1, 5, 9)]
    src = scratch_path(spark, "msgs")
    frame = spark.createDataFrame([(x, i) for i, x in enumerate([*good, "not json", '{"license_plate": "q"}', None])], "value string, offset long")
    frame.select(F.col("value").cast("binary").alias("value"), "offset").write.parquet(src)
    stream = raw.read_raw(spark, "parquet", path=src)
    table, ckpt = scratch_path(spark, "t"), scratch_path(spark, "c")
    jobs.live_job(spark, stream, S, table, ckpt, available_now=True).awaitTermination()
    bad = sorted((r.event_id, r.reason, r.raw) for r in spark.read.parquet(f"{table}-bad").collect())
    assert [b[:2] for b in bad] == [(3, "unparseable"), (4, "missing_location"), (5, "null_value")] and bad[0][2] == "not json"
    rows = spark.read.parquet(table)
    assert [r.n_events for r in rows.collect()] == [3] and "side" not in rows.columns


ROWS = st.lists(st.tuples(st.integers(0, 400), st.booleans()), min_size=1, max_size=40)


@settings(max_examples=200, deadline=None)
@given(ROWS, st.lists(st.integers(0, 40), max_size=6), st.sampled_from(["emit", "drop"]))
def test_folding_is_associative(rows, cuts, lone):
    """Runs of any adjacent pieces fold to the sessions of the rows."""
    s = Settings(timeout_seconds=30, lone_exit=lone)
    rows = sorted(rows)
    t = np.array([r[0] for r in rows], "int64")
    x = np.array([r[1] for r in rows])
    ids = np.arange(len(rows), dtype="int64")
    want = fold.fold_sorted(t, ids, x, None, 0, s)
    edges = sorted({0, len(rows), *(c for c in cuts if c < len(rows))})
    wide = s.with_(bucket_seconds=10**9)
    runs = []
    for lo, hi in zip(edges, edges[1:]):
        one = pa.array(["k"] * (hi - lo))
        _, *cols = salted.runs_of(one, one, t[lo:hi], ids[lo:hi], x[lo:hi], wide)
        runs.append(cols)
    start, end, n, first, closed = (np.concatenate(c) for c in zip(*runs))
    got = fold.fold_runs(start, end, n, first, closed, None, 0, s)
    plain = lambda r: ([tuple(map(str, o)) for o in r[0]], r[1], r[2])
    assert plain(got) == plain(want)


@settings(max_examples=100, deadline=None)
@given(ROWS, ROWS)
def test_state_joins_runs_as_it_joins_rows(before, after):
    s = Settings(timeout_seconds=30)
    arrays = lambda rows, k: (np.array([r[0] for r in sorted(rows)], "int64"), np.arange(k, k + len(rows), dtype="int64"),
                              np.array([r[1] for r in sorted(rows)]))
    t0, i0, x0 = arrays(before, 0)
    state = fold.fold_sorted(t0, i0, x0, None, 0, s)[1]
    t, ids, x = arrays([(a + int(t0[-1]), b) for a, b in after], 100)
    key = pa.array(["k"] * len(t))
    _, *runs = salted.runs_of(key, key, t, ids, x, s.with_(bucket_seconds=7))
    a = fold.fold_sorted(t, ids, x, state, 0, s)
    b = fold.fold_runs(*runs, state, 0, s)
    assert [tuple(map(str, o)) for o in a[0]] == [tuple(map(str, o)) for o in b[0]] and a[1:] == b[1:]


def test_hot_key_of_a_trigger_is_dealt_over_tasks(spark):
    """One key with 90 % of the rows: no task holds more than a few of its
    buckets, and the sessions are the batch job's."""
    s = S.with_(watermark_delay="0 seconds", bucket_seconds=600, timeout_seconds=40)
    hot = spark.range(60_000).selectExpr("id as event_id", f"{OFF} + id as timestamp_unix", "'HOT' as license_plate", "'A1' as location",
                                         "case when id % 997 = 0 then 'EXITING' else 'PARKED' end as status_code")
    rest = spark.range(6_000).selectExpr("id + 60000 as event_id", f"{OFF} + id * 9 as timestamp_unix", "concat('P', id % 50) as license_plate",
                                         "'B1' as location", "'PARKED' as status_code")
    ev = hot.unionByName(rest)
    dealt = ev.repartition(8, "license_plate", "location", F.floor(F.col("timestamp_unix") / s.bucket_seconds))
    assert max(r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()) < 66_000 * 0.3
    base = scratch_path(spark, "hot")
    table = jobs.replay(spark, ev, lambda st: salted.salted_sessionize_stream(st, s), n_slices=1, base=base)
    got = jobs.sessions_from_changelog(spark.read.parquet(table))
    assert _sessions_list(got) == _sessions_list(sessionize.parking_sessions(ev, s))


def test_gap_sessions_with_open_ones(spark):
    """Exits don't split; sessions that are still open are in the result."""
    rows = [(0, "ENTERING"), (5, "EXITING"), (9, "PARKED"), (9000, "PARKED"), (9001, "EXITING"), (20, "EXITING", "B1")]
    ev, s = events(spark, rows), S.with_(watermark_delay="0 seconds")
    table = jobs.replay(spark, ev, lambda st: jobs.live_gap_sessions_stream(st, s), cuts=[OFF + 7, OFF + 9000])
    got = _sessions_list(jobs.sessions_from_changelog(spark.read.parquet(table)))
    assert got == _sessions_list(sessionize.gap_sessions(ev, s)) and {r[-1] for r in got} == {"ACTIVE", "TIMEOUT"}


def test_ordered_state_is_read_as_a_table(spark):
    ev = events(spark, [(0, "ENTERING"), (50, "PARKED"), (2000, "PARKED", "B1"), (2050, "PARKED", "B1")])
    base = scratch_path(spark, "ordered-state")
    jobs.replay(spark, ev, lambda st: ordered_sessionize_stream(st, S), n_slices=1, base=base)
    ckpt = f"{base}/checkpoint"
    rows = [(r.location, r.start_time - OFF, r.end_time - OFF, r.n_events) for r in state_views.open_sessions(spark, ckpt, True).collect()]
    assert rows == [("A1", 0, 50, 2)]
    assert sorted(r.timestamp_unix - OFF for r in state_views.waiting_rows(spark, ckpt).collect()) == [2000, 2050]
    shown = state_views.active_sessions_from_state(spark, ckpt, F.lit(OFF + 5000), S, ordered=True)
    assert shown.collect() == []  # silent for longer than the limit
