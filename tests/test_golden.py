"""Hand-worked cases (FIXTURES.md section 3): price 10000 per 600 s, T = 3600 s."""

import pytest
from util import PLATE, SPOT, events, sessions_list

from bayline.operators import audit, changelog, sessionize, views
from bayline.params import Settings

S = Settings(timeout_seconds=3600, bucket_seconds=600)


def run(spark, rows, s=S, as_of=None):
    return sessions_list(sessionize.parking_sessions(events(spark, rows), s, as_of=as_of))


def test_g1_full_stay(spark):
    got = run(spark, [(0, "ENTERING"), (60, "PARKED"), (600, "MOVING"), (601, "EXITING")])
    assert got == [(PLATE, SPOT, 0, 601, 601, 20000, "CLOSED")]


def test_g2_exact_block(spark):
    assert run(spark, [(0, "ENTERING"), (600, "EXITING")]) == [(PLATE, SPOT, 0, 600, 600, 10000, "CLOSED")]


def test_g3_lone_exit(spark):
    assert run(spark, [(50, "EXITING")]) == [(PLATE, SPOT, 50, 50, 0, 0, "CLOSED")]
    assert run(spark, [(50, "EXITING")], s=S.with_(lone_exit="drop")) == []


def test_g4_second_exit(spark):
    got = run(spark, [(0, "ENTERING"), (100, "EXITING"), (105, "EXITING")])
    assert got == [(PLATE, SPOT, 0, 100, 100, 10000, "CLOSED"), (PLATE, SPOT, 105, 105, 0, 0, "CLOSED")]


def test_g5_silence_is_free(spark):
    rows = [(0, "ENTERING"), (30, "PARKED")]
    assert run(spark, rows, as_of=3630) == [(PLATE, SPOT, 0, 30, 30, 10000, "ACTIVE")]
    assert run(spark, rows, as_of=3631) == [(PLATE, SPOT, 0, 30, 30, 10000, "TIMEOUT")]


def test_g6_gap_splits(spark):
    got = run(spark, [(0, "ENTERING"), (5000, "PARKED")])
    assert got == [(PLATE, SPOT, 0, 0, 0, 0, "TIMEOUT"), (PLATE, SPOT, 5000, 5000, 0, 0, "ACTIVE")]


def test_g7_out_of_order(spark):
    assert run(spark, [(100, "ENTERING"), (50, "PARKED")]) == [(PLATE, SPOT, 50, 100, 50, 10000, "ACTIVE")]


def test_g9_two_spots(spark):
    ev = events(spark, [(0, "ENTERING", "A1"), (10, "ENTERING", "B2")])
    sess = sessionize.parking_sessions(ev, S)
    assert len(sess.collect()) == 2
    chg = changelog.session_changelog(ev, S)
    from pyspark.sql import functions as F
    abp = views.active_by_plate(chg, F.lit(10), S).collect()
    assert [(r.license_plate, r.location) for r in abp] == [(PLATE, "B2")]
    assert sorted(r.location for r in views.busy_locations(sess).collect()) == ["A1", "B2"]
    pc = audit.plate_conflicts(sess).collect()
    assert [(r.license_plate, r.n_locations) for r in pc] == [(PLATE, 2)]


def test_g10_exit_then_enter_same_batch(spark):
    got = run(spark, [(0, "ENTERING"), (10, "EXITING"), (20, "ENTERING")])
    assert got == [(PLATE, SPOT, 0, 10, 10, 10000, "CLOSED"), (PLATE, SPOT, 20, 20, 0, 0, "ACTIVE")]


def test_g11_unknown_and_null_status(spark):
    rows = [(0, "ENTERING"), (10, "FOO"), (20, None)]
    assert run(spark, rows) == [(PLATE, SPOT, 0, 20, 20, 10000, "ACTIVE")]
    aud = audit.transition_audit(events(spark, rows), S).collect()
    pairs = {(r.from_status, r.to_status) for r in aud}
    assert ("ENTERING", "FOO") in pairs and ("FOO", None) in pairs


@pytest.mark.parametrize("bucket", [1, 7, 600, 10**9])
def test_bucket_width_does_not_change_sessions(spark, bucket):
    rows = [(0, "ENTERING"), (5, "PARKED"), (700, "PARKED"), (701, "EXITING"), (702, "PARKED"),
            (5000, "PARKED"), (5001, "MOVING"), (9000, "EXITING"), (9001, "EXITING"),
            (20000, "ENTERING")]
    base = run(spark, rows, s=S.with_(bucket_seconds=10**9))
    assert run(spark, rows, s=S.with_(bucket_seconds=bucket)) == base
    # 0-701 CLOSED, 702 TIMEOUT, 5000-5001 TIMEOUT, 9000 and 9001 lone exits, 20000 ACTIVE
    assert [r[-1] for r in base] == ["CLOSED", "TIMEOUT", "TIMEOUT", "CLOSED", "CLOSED", "ACTIVE"]
