"""Streaming fold: same answer as the batch job, wherever the batches are cut."""

import os

import pytest
from util import PLATE, SPOT
from util import events as _events
from util import sessions_list as _sessions_list

from bayline.operators import sessionize
from bayline.params import Settings
from bayline.plans.runtime import scratch_path
from bayline.streaming import jobs

S = Settings(timeout_seconds=3600, bucket_seconds=600, watermark_delay="0 seconds")
# a stream drops rows at or before the watermark, which starts at 0: keep
# test times away from the epoch
OFF = 1_000_000


def events(spark, rows, **kw):
    return _events(spark, rows, offset=OFF, **kw)


def sessions_list(df):
    return _sessions_list(df, offset=OFF)


def stream_sessions(spark, ev, s=S, cuts=None, n_slices=4):
    table = jobs.replay(spark, ev, lambda st: jobs.sessionize_stream(st, s),
                        n_slices=n_slices, cuts=cuts)
    return jobs.sessions_from_changelog(spark.read.parquet(table))


def test_g4_exit_in_later_batch(spark):
    ev = events(spark, [(0, "ENTERING"), (100, "EXITING"), (105, "EXITING")])
    got = sessions_list(stream_sessions(spark, ev, cuts=[OFF + 101]))
    assert got == [(PLATE, SPOT, 0, 100, 100, 10000, "CLOSED"), (PLATE, SPOT, 105, 105, 0, 0, "CLOSED")]


def test_g5_timeout_fires_on_watermark(spark):
    # a second key moves the watermark past 30 + 3600
    ev = events(spark, [(0, "ENTERING"), (30, "PARKED"), (3631, "ENTERING", "B1")])
    got = sessions_list(stream_sessions(spark, ev, cuts=[OFF + 100]))
    assert (PLATE, SPOT, 0, 30, 30, 10000, "TIMEOUT") in got


def test_g6_gap_in_one_batch_and_across(spark):
    rows = [(0, "ENTERING"), (5000, "PARKED")]
    want = [(PLATE, SPOT, 0, 0, 0, 0, "TIMEOUT"), (PLATE, SPOT, 5000, 5000, 0, 0, "ACTIVE")]
    assert sessions_list(stream_sessions(spark, events(spark, rows), cuts=[])) == want
    assert sessions_list(stream_sessions(spark, events(spark, rows), cuts=[OFF + 10])) == want


def test_g10_no_loss_after_exit(spark):
    ev = events(spark, [(0, "ENTERING"), (10, "EXITING"), (20, "ENTERING")])
    got = sessions_list(stream_sessions(spark, ev, cuts=[]))
    assert got == [(PLATE, SPOT, 0, 10, 10, 10000, "CLOSED"), (PLATE, SPOT, 20, 20, 0, 0, "ACTIVE")]


@pytest.mark.parametrize("cuts", [[], [700], [5, 702, 9000], [1, 2, 3, 4, 5, 6, 7, 8]])
def test_stream_equals_batch_any_cut(spark, cuts):
    rows = [(0, "ENTERING"), (5, "PARKED"), (700, "PARKED"), (701, "EXITING"), (702, "PARKED"),
            (5000, "PARKED"), (5001, "MOVING"), (9000, "EXITING"), (9001, "EXITING"),
            (20000, "ENTERING"), (3, "ENTERING", "B1"), (8, "EXITING", "B1")]
    ev = events(spark, rows)
    batch = sessions_list(sessionize.parking_sessions(ev, S))
    assert sessions_list(stream_sessions(spark, ev, cuts=[OFF + c for c in cuts])) == batch


def test_changelog_fan_out_and_retry(spark):
    """Two sinks from one batch; re-running a batch overwrites its epoch."""
    ev = events(spark, [(0, "ENTERING"), (10, "EXITING")])
    other = scratch_path(spark, "fanout")
    seen = []

    def second(batch, epoch_id):
        seen.append((epoch_id, batch.count()))
        batch.write.mode("overwrite").parquet(f"{other}/epoch_id={epoch_id}")

    inp = scratch_path(spark, "in")
    sessionize.valid_events(ev).write.parquet(inp)
    st = spark.readStream.schema(sessionize.valid_events(ev).schema).parquet(inp)
    table, ckpt = scratch_path(spark, "tbl"), scratch_path(spark, "ck")
    q = jobs.start_changelog(jobs.sessionize_stream(st, S), table, ckpt,
                             extra_sinks=(second,), available_now=True)
    q.awaitTermination()
    a = sorted(map(tuple, spark.read.parquet(table).drop("epoch_id").collect()))
    b = sorted(map(tuple, spark.read.parquet(other).drop("epoch_id").collect()))
    assert a == b and len(a) == 1 and seen[0][1] == 1
    # retry of epoch 0 replaces, never appends
    sink = jobs.epoch_table_sink(table)
    again = spark.read.parquet(table).drop("epoch_id")
    sink(spark.createDataFrame(again.collect(), again.schema), 0)
    assert spark.read.parquet(table).count() == 1
    assert os.path.isdir(ckpt.replace("file:", ""))


def test_live_job_over_raw_json_files(spark):
    """Raw JSON lines -> decode -> fold -> changelog and a view snapshot."""
    import json

    from bayline.operators import views
    from bayline.sources import raw

    lines = [json.dumps({"timestamp": "x", "timestamp_unix": OFF + t, "license_plate": "29A-1",
                         "location": loc, "status_code": st})
             for t, loc, st in [(0, "A1", "ENTERING"), (5, "B2", "ENTERING"), (9, "A1", "EXITING")]]
    lines.append("not json")
    src = scratch_path(spark, "rawjson")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(src)
    stream = raw.read_raw(spark, "json", path=src, stream=True)
    table, ckpt, vpath = (scratch_path(spark, n) for n in ("tbl", "ck", "views"))
    other = scratch_path(spark, "views-tbl")
    sink = jobs.upsert_views(other, vpath, lambda sess: {"busy": views.busy_locations(sess)})
    w = jobs.live_job(spark, stream, S, table, ckpt, extra_sinks=(sink,), available_now=True)
    w.awaitTermination()
    got = sorted((r.location, r.status) for r in spark.read.parquet(table).collect())
    assert got == [("A1", "CLOSED"), ("B2", "ACTIVE")]
    assert [r.location for r in spark.read.parquet(f"{vpath}/busy").collect()] == ["B2"]
    bad = raw.bad_events(raw.read_raw(spark, "json", path=src, stream=False)).collect()
    assert [b.reason for b in bad] == ["unparseable"]


def _batches(spark, batches, build):
    from bayline.operators.sessionize import valid_events
    frames = [valid_events(events(spark, b)) for b in batches]
    table = jobs.replay_slices(spark, frames, build)
    return sessions_list(jobs.sessions_from_changelog(spark.read.parquet(table)))


def test_ordered_fold_handles_rows_out_of_order(spark):
    from bayline.streaming.ordered import ordered_sessionize_stream
    s = S.with_(watermark_delay="100 seconds")
    b1 = [(0, "ENTERING"), (50, "EXITING")]
    b2 = [(30, "PARKED")]                       # 20 s late, within the delay
    b3 = [(10_000, "ENTERING", "Z9", "FLUSH")]  # moves the watermark past all
    def mine(rows):
        return [r for r in rows if r[0] == PLATE]

    want = mine(sessions_list(sessionize.parking_sessions(events(spark, b1 + b2 + b3), s)))
    assert want == [(PLATE, SPOT, 0, 50, 50, 10000, "CLOSED")]
    got = _batches(spark, [b1, b2, b3], lambda st: ordered_sessionize_stream(st, s))
    assert mine(got) == want
    # the flush row itself stays pending: the watermark ends 100 s behind it
    assert not [r for r in got if r[0] == "FLUSH"]
    # the fold without buffering closes at 50 and opens a new session at 30
    plain = _batches(spark, [b1, b2, b3], lambda st: jobs.sessionize_stream(st, s))
    assert mine(plain) != want


@pytest.mark.parametrize("cuts", [[], [700, 5000]])
def test_ordered_fold_equals_batch_in_order(spark, cuts):
    from bayline.streaming.ordered import ordered_sessionize_stream
    rows = [(0, "ENTERING"), (5, "PARKED"), (700, "PARKED"), (701, "EXITING"), (702, "PARKED"),
            (5000, "PARKED"), (5001, "MOVING"), (9000, "EXITING"), (9001, "EXITING"),
            (20000, "ENTERING"), (3, "ENTERING", "B1"), (8, "EXITING", "B1")]
    ev = events(spark, rows)
    batch = sessions_list(sessionize.parking_sessions(ev, S))
    table = jobs.replay(spark, ev, lambda st: ordered_sessionize_stream(st, S),
                        cuts=[OFF + c for c in cuts])
    assert sessions_list(jobs.sessions_from_changelog(spark.read.parquet(table))) == batch


@pytest.mark.parametrize("cuts,limit", [([], 4_000_000), ([700], 4_000_000),
                                        ([5, 702, 9000], 4_000_000),
                                        ([1, 2, 3, 4, 5, 6, 7, 8], 4_000_000),
                                        ([700, 5001], 2), ([3, 9000], 1)])
def test_table_state_stream_equals_batch(spark, cuts, limit):
    """Also with tiny limits: seeded keys then take the piecewise path."""
    from bayline.streaming.tables import replay_table_sessions
    rows = [(0, "ENTERING"), (5, "PARKED"), (700, "PARKED"), (701, "EXITING"), (702, "PARKED"),
            (5000, "PARKED"), (5001, "MOVING"), (9000, "EXITING"), (9001, "EXITING"),
            (20000, "ENTERING"), (3, "ENTERING", "B1"), (8, "EXITING", "B1")]
    ev = events(spark, rows)
    s = S.with_(max_piece_rows=limit)
    batch = sessions_list(sessionize.parking_sessions(ev, S))
    table = replay_table_sessions(spark, ev, s, cuts=[OFF + c for c in cuts])
    got = jobs.sessions_from_changelog(spark.read.parquet(table))
    assert sessions_list(got) == batch


def test_table_state_keeps_late_rows_for_audit(spark):
    from bayline.operators.sessionize import valid_events
    from bayline.streaming.tables import start_table_sessions
    b1 = [(0, "ENTERING"), (500, "PARKED")]
    b2 = [(100, "PARKED"), (600, "EXITING")]  # 100 is behind the clock (500)
    base, ckpt, inp = (scratch_path(spark, n) for n in ("tb", "ck", "in"))
    for b in (b1, b2):
        valid_events(events(spark, b)).write.mode("append").parquet(inp)
        st = spark.readStream.schema(valid_events(events(spark, b1)).schema).parquet(inp)
        q = start_table_sessions(st, S, base, ckpt, available_now=True)
        q.awaitTermination()
    late = spark.read.parquet(f"{base}/late").collect()
    assert [r.timestamp_unix - OFF for r in late] == [100]
    got = sessions_list(jobs.sessions_from_changelog(spark.read.parquet(f"{base}/changelog")))
    assert got == [(PLATE, SPOT, 0, 600, 600, 10000, "CLOSED")]


def test_processing_time_timeout(spark):
    """Wall-clock timeout: the session times out after the limit with no data."""
    import time

    from bayline.operators.sessionize import valid_events
    s = S.with_(timeout_seconds=2, timeout_mode="processing")
    inp, table, ckpt = (scratch_path(spark, n) for n in ("pin", "ptbl", "pck"))
    ev = valid_events(events(spark, [(0, "ENTERING"), (1, "PARKED")]))
    ev.write.parquet(inp)
    st = spark.readStream.schema(ev.schema).parquet(inp)
    q = jobs.start_changelog(jobs.sessionize_stream(st, s), table, ckpt, trigger_seconds=1)
    try:
        deadline = time.time() + 60
        seen = set()
        while time.time() < deadline and "TIMEOUT" not in seen:
            time.sleep(1)
            try:
                seen = {r.status for r in spark.read.parquet(table).collect()}
            except Exception:  # noqa: BLE001 - table not written yet
                pass
    finally:
        q.stop()
    assert {"ACTIVE", "TIMEOUT"} <= seen


def test_lone_exit_drop_in_all_stream_forms(spark):
    from bayline.streaming.ordered import ordered_sessionize_stream
    from bayline.streaming.tables import replay_table_sessions
    s = S.with_(lone_exit="drop")
    rows = [(0, "ENTERING"), (100, "EXITING"), (105, "EXITING"), (200, "EXITING", "B1"),
            (300, "PARKED", "B1"), (9000, "EXITING", "C1")]
    ev = events(spark, rows)
    batch = sessions_list(sessionize.parking_sessions(ev, s))
    assert [r[2] - 0 for r in batch] == [0, 300]  # lone exits at 105, 200, 9000 are gone
    cuts = [OFF + 103, OFF + 250]
    keyed = jobs.replay(spark, ev, lambda st: jobs.sessionize_stream(st, s), cuts=cuts)
    ordered = jobs.replay(spark, ev, lambda st: ordered_sessionize_stream(st, s), cuts=cuts)
    tables = replay_table_sessions(spark, ev, s, cuts=cuts)
    for path in (keyed, ordered, tables):
        got = sessions_list(jobs.sessions_from_changelog(spark.read.parquet(path)))
        assert got == batch, path


def test_table_state_keeps_only_recent_state_epochs(spark):
    import os

    from bayline.operators.sessionize import valid_events
    from bayline.streaming.tables import start_table_sessions
    base, ckpt, inp = (scratch_path(spark, n) for n in ("keep", "keepck", "keepin"))
    schema = valid_events(events(spark, [(0, "ENTERING")])).schema
    for t in (0, 100, 200, 300):
        valid_events(events(spark, [(t, "PARKED")])).write.mode("append").parquet(inp)
        q = start_table_sessions(spark.readStream.schema(schema).parquet(inp), S, base, ckpt,
                                 available_now=True, retain_epochs=2)
        q.awaitTermination()
    local = base.replace("file:", "")
    assert sorted(os.listdir(f"{local}/open")) == ["epoch_id=2", "epoch_id=3"]
    assert len([d for d in os.listdir(f"{local}/changelog") if d.startswith("epoch_id=")]) == 4
    got = sessions_list(jobs.sessions_from_changelog(spark.read.parquet(f"{base}/changelog")))
    assert got == [(PLATE, SPOT, 0, 300, 300, 10000, "ACTIVE")]


def test_incremental_view_store_equals_batch_views(spark):
    from conftest import SF0001

    from bayline.operators import views
    from bayline.sources.fixture import fixture_settings, parking_events
    from bayline.streaming.live_views import latest_views_state, live_views_sink
    s = fixture_settings(closed_retention=50)
    ev = parking_events(spark.read.parquet(f"{SF0001}/events.parquet"))
    base = scratch_path(spark, "liveviews")
    jobs.replay(spark, ev, lambda st: jobs.sessionize_stream(st, s),
                extra_sinks=(live_views_sink(base, s),))
    open_now, closed_now, closed_total = latest_views_state(spark, base)
    sess = sessionize.parking_sessions(ev, s)
    cols = ["license_plate", "location", "start_time", "end_time", "n_events"]
    want_open = sorted(map(tuple, sess.where("status = 'ACTIVE'").select(*cols).collect()))
    assert sorted(map(tuple, open_now.select(*cols).collect())) == want_open
    assert closed_total == sess.where("status = 'CLOSED'").count()
    want_top = sorted(map(tuple, views.closed_history(sess, 50).select(*cols[:4]).collect()))
    assert sorted(map(tuple, closed_now.select(*cols[:4]).collect())) == want_top


def test_fold_splits_rows_from_long_before_the_open_session():
    import numpy as np

    from bayline.streaming.fold import fold_sorted
    s = S.with_(timeout_seconds=3600)
    arr = lambda *x: np.array(x, dtype="int64")
    no = np.array([False])
    out, open_, timer = fold_sorted(arr(0), arr(9), no, (10_000, 10_500, 2, 1), 0, s)
    assert [tuple(map(str, o)) for o in out] == [("0", "0", "TIMEOUT", "1", "9")]
    assert open_ == (10_000, 10_500, 2, 1) and timer == (10_500 + 3600) * 1000
    out, open_, _ = fold_sorted(arr(0, 9_000), arr(9, 10), np.array([False, False]), (10_000, 10_500, 2, 1), 0, s)
    assert len(out) == 1 and open_ == (9_000, 10_500, 3, 10)
