"""View semantics: shared spots, terminal timeouts, limits, wire round trip."""

import pytest
from pyspark.sql import functions as F
from util import PLATE, events

from bayline.operators import changelog, dims, sessionize, views
from bayline.params import Settings
from bayline.sources import raw

S = Settings(timeout_seconds=3600, bucket_seconds=600, rows="AB", n_cols=2, n_zones=2)


def _views(spark, rows, s=S, as_of=None):
    ev = events(spark, rows)
    sess = sessionize.parking_sessions(ev, s, as_of=as_of)
    chg = changelog.session_changelog(ev, s, as_of=as_of)
    at = F.lit(as_of if as_of is not None else max(r[0] for r in rows)).cast("long")
    return ev, sess, chg, at


def test_two_cars_one_spot(spark):
    rows = [(0, "ENTERING", "A1", "X"), (10, "ENTERING", "A1", "Y"), (20, "EXITING", "A1", "Y")]
    _, sess, chg, at = _views(spark, rows)
    # X still parks: the spot is busy in the session view ...
    assert [r.location for r in views.busy_locations(sess).collect()] == ["A1"]
    # ... while the reference-style occupancy fold frees it on Y's exit
    occ = views.occupancy(chg, S).collect()
    assert [(r.location, r.occupied, r.last_status) for r in occ] == [("A1", False, "CLOSED")]
    info = views.location_info(dims.location_dim(spark, S), sess, at, S).collect()
    a1 = [r for r in info if r.location == "A1"][0]
    assert (a1.status, a1.license_plate, a1.duration) == ("OCCUPIED", "X", 20)
    assert sorted(r.location for r in info if r.status == "FREE") == ["A2", "B1", "B2"]


def test_timeout_is_terminal_or_not(spark):
    rows = [(0, "ENTERING", "A1"), (5000, "ENTERING", "B2", "OTHER")]
    _, sess, chg, at = _views(spark, rows)
    assert [r.license_plate for r in views.active_by_plate(chg, at, S).collect()] == ["OTHER"]
    keep = S.with_(timeout_is_terminal=False)
    got = sorted(r.license_plate for r in views.active_by_plate(chg, at, keep).collect())
    assert got == sorted(["OTHER", PLATE])  # the reference keeps a timed-out car active


def test_statistics_and_zones(spark):
    rows = [(0, "ENTERING", "A1"), (1, "ENTERING", "B2", "Q"), (2, "EXITING", "B2", "Q")]
    _, sess, _, _ = _views(spark, rows)
    dim = dims.location_dim(spark, S)
    st = views.statistics(dim, sess, S).first()
    assert (st.total_locations, st.busy_count, st.free_count, st.active_sessions,
            st.closed_sessions_total) == (4, 1, 3, 1, 1)
    z = {r.zone: (r.n_locations, r.busy_count) for r in
         __import__("bayline.operators.audit", fromlist=["x"]).zone_occupancy(dim, sess, S).collect()}
    assert z == {0: (2, 1), 1: (2, 0)}


def test_closed_history_limits(spark):
    rows = [(i * 10, "ENTERING" if i % 2 == 0 else "EXITING") for i in range(10)]
    _, sess, _, _ = _views(spark, rows)
    assert views.closed_history(sess, 0).count() == 0
    top = views.closed_history(sess, 2).collect()
    assert [r.end_time for r in top] == [90, 70]
    assert views.closed_history(sess, 50, retention=3).count() == 3
    with pytest.raises(ValueError):
        views.closed_history(sess, -1)


def test_changelog_wire_round_trip(spark):
    rows = [(0, "ENTERING"), (700, "EXITING"), (800, "PARKED")]
    _, sess, _, _ = _views(spark, rows)
    wire = changelog.encode_changelog(sess).select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    back = raw.decode_changelog(wire).drop("offset")
    cols = changelog.SESSION_FIELDS
    assert sorted(map(tuple, back.select(*cols).collect())) == \
        sorted(map(tuple, sess.select(*cols).collect()))


def test_dimension_zones_follow_the_reference_split(spark):
    # 60 spots in 3 zones of 20, rows A-F columns 1-10, row-major order
    d = dims.location_dim(spark, Settings()).collect()
    assert len(d) == 60
    z = {r.location: r.zone for r in d}
    assert (z["A1"], z["B10"], z["C1"], z["D10"], z["E1"], z["F10"]) == (0, 0, 1, 1, 2, 2)
    # 7 spots in 3 zones: 2, 2 and the remainder 3
    d7 = dims.location_dim(spark, Settings(rows="A", n_cols=7)).collect()
    assert [r.zone for r in sorted(d7, key=lambda r: r.idx)] == [0, 0, 1, 1, 2, 2, 2]


def test_location_info_for_one_spot(spark):
    rows = [(0, "ENTERING", "A1", "X")]
    _, sess, _, at = _views(spark, rows)
    dim = dims.location_dim(spark, S)
    one = views.location_info(dim, sess, at, S, location_id="a1").collect()
    assert [(r.location, r.status, r.license_plate) for r in one] == [("A1", "OCCUPIED", "X")]
    assert views.location_info(dim, sess, at, S, location_id="b2").first().status == "FREE"
    assert views.location_info(dim, sess, at, S, location_id="Z9").count() == 0


def test_snapshot_uses_one_reading_time(spark):
    rows = [(0, "ENTERING", "A1", "X"), (30, "ENTERING", "B2", "Y"), (40, "EXITING", "B2", "Y")]
    _, sess, _, _ = _views(spark, rows)
    snap = views.snapshot(dims.location_dim(spark, S), sess, F.lit(100).cast("long"), S)
    assert [(r.license_plate, r.duration) for r in snap["active_sessions"].collect()] == [("X", 100)]
    assert [r.location for r in snap["busy_locations"].collect()] == ["A1"]
    assert [r.location for r in snap["free_locations"].collect()] == ["A2", "B1", "B2"]
    assert snap["statistics"].first().closed_sessions_total == 1


def test_small_public_helpers(spark, capsys):
    from bayline.functions.clock import now_seconds, now_text
    from bayline.sources.sinks import console_batch_sink
    row = spark.range(1).select(now_seconds().alias("n"), now_text().alias("t")).first()
    assert row.n > 1_700_000_000 and len(row.t) == 19
    console_batch_sink(5)(spark.range(3), 7)
    assert "-- batch 7" in capsys.readouterr().out
