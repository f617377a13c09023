"""Properties against a brute-force statement of the session rules."""

import math
import random

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from util import EV

from bayline.operators import sessionize
from bayline.params import Settings
from bayline.streaming.fold import make_fold

T = 100
S = Settings(timeout_seconds=T, block_seconds=60, block_price=7, watermark_delay="0 seconds")
STATUSES = ["ENTERING", "PARKED", "MOVING", "EXITING", None, "FOO"]


def brute(rows, s=S, as_of=None):
    """rows: (event_id, t, plate, loc, status). One pass per key, as written."""
    out = []
    as_of = max(r[1] for r in rows) if as_of is None else as_of
    keys = sorted({(r[2], r[3]) for r in rows})
    for k in keys:
        evs = sorted((r for r in rows if (r[2], r[3]) == k), key=lambda r: (r[1], r[0]))
        cur = None
        prev = None
        for e in evs:
            new = cur is None or prev[4] == "EXITING" or e[1] - prev[1] > s.timeout_seconds
            if new:
                if cur is not None:
                    out.append(cur)
                cur = {"start": e[1], "end": e[1], "n": 0, "closed": False}
            cur["end"] = e[1]
            cur["n"] += 1
            if e[4] == "EXITING":
                cur["closed"] = True
            prev = e
        out.append(cur)
        for c in out:
            c.setdefault("key", k)
    res = []
    for c in out:
        d = c["end"] - c["start"]
        status = ("CLOSED" if c["closed"] else
                  "TIMEOUT" if as_of - c["end"] > s.timeout_seconds else "ACTIVE")
        res.append((*c["key"], c["start"], c["end"], d,
                    int(math.ceil(d / s.block_seconds) * s.block_price), status, c["n"]))
    return sorted(res)


def gen_rows(rng, n, keys=3, span=600):
    rows = []
    for i in range(n):
        k = rng.randrange(keys)
        rows.append((i, 10_000 + rng.randrange(span), f"P{k % 2}", f"A{k}", rng.choice(STATUSES)))
    return rows


def spark_sessions(spark, rows, s):
    df = sessionize.parking_sessions(spark.createDataFrame(rows, EV), s)
    return sorted((r.license_plate, r.location, r.start_time, r.end_time, r.duration, r.cost,
                   r.status, r.n_events) for r in df.collect())


def test_batch_equals_brute_force(spark):
    rng = random.Random(7)
    for trial in range(8):
        rows = gen_rows(rng, rng.randrange(1, 60))
        bucket = rng.choice([1, 13, 50, 100, 1000, 10**9])
        assert spark_sessions(spark, rows, S.with_(bucket_seconds=bucket)) == brute(rows), trial


def test_every_event_in_one_session(spark):
    rows = gen_rows(random.Random(3), 200, keys=5, span=3000)
    scan = sessionize.session_scan(spark.createDataFrame(rows, EV), S.with_(bucket_seconds=37))
    got = scan.select("event_id", "session_no").collect()
    assert sorted(r.event_id for r in got) == list(range(200))
    sess = sessionize.parking_sessions(spark.createDataFrame(rows, EV), S.with_(bucket_seconds=37))
    agg = sess.agg({"n_events": "sum"}).first()[0]
    assert agg == 200
    assert all(r.end_time >= r.start_time for r in sess.collect())


# --- the streaming fold, driven without Spark -------------------------------

class FakeState:
    """Just enough of GroupState for the fold, with event-time timers."""

    def __init__(self):
        self.value = None
        self.timer = None
        self.hasTimedOut = False
        self.wm = 0

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, v):
        self.value = tuple(v)

    def remove(self):
        self.value = None
        self.timer = None

    def setTimeoutTimestamp(self, ms):
        assert ms >= self.wm
        self.timer = ms

    def getCurrentWatermarkMs(self):
        return self.wm


def run_stream(rows, cuts, s=S):
    """Feed rows in time slices; watermark = max time seen (delay 0), applied
    to the next batch; timers fire when the watermark passes them."""
    fold = make_fold(s)
    states: dict = {}
    emitted = []
    wm = 0
    batches = []
    edges = [-math.inf, *cuts, math.inf]
    for lo, hi in zip(edges, edges[1:]):
        batches.append([r for r in rows if lo <= r[1] < hi])
    batches.append([])  # the no-data batch that delivers the last timeouts
    epoch = 0
    for batch in batches:
        by_key: dict = {}
        for r in batch:
            if r[1] * 1000 > wm:  # rows at or behind the watermark are late
                by_key.setdefault((r[2], r[3]), []).append(r)
        for k, st_ in states.items():
            st_.wm = wm
        for k, rs in by_key.items():
            st_ = states.setdefault(k, FakeState())
            st_.wm, st_.hasTimedOut = wm, False
            pdf = pd.DataFrame(rs, columns=["event_id", "timestamp_unix", "license_plate",
                                            "location", "status_code"])
            for out in fold(k, iter([pdf]), st_):
                emitted += [(epoch, *t) for t in out.itertuples(index=False)]
        for k, st_ in states.items():
            if k in by_key or st_.timer is None or not st_.timer < wm:
                continue
            st_.hasTimedOut = True
            for out in fold(k, iter([]), st_):
                emitted += [(epoch, *t) for t in out.itertuples(index=False)]
            st_.hasTimedOut = False
        if batch:
            wm = max(wm, max(r[1] for r in batch) * 1000)
        epoch += 1
    last = {}
    for e in emitted:
        last[(e[1], e[2], e[3], e[10])] = e[1:10]
    return sorted((p, l, st_, en, d, c, s_, n) for (p, l, st_, en, d, c, s_, lu, n) in last.values())


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.lists(st.integers(10_000, 10_600), max_size=5))
def test_stream_fold_equals_brute_force(seed, n, cuts):
    rows = gen_rows(random.Random(seed), n)
    got = run_stream(rows, sorted(set(cuts)))
    assert got == brute(rows)


def test_fold_handles_chunks_out_of_order():
    fold = make_fold(S)
    rows = [(0, 10_050, "P", "A", "PARKED"), (1, 10_000, "P", "A", "ENTERING"),
            (2, 10_100, "P", "A", "EXITING")]
    cols = ["event_id", "timestamp_unix", "license_plate", "location", "status_code"]
    chunks = [pd.DataFrame([r], columns=cols) for r in rows]
    out = pd.concat(list(fold(("P", "A"), iter(chunks), FakeState())))
    assert out[["start_time", "end_time", "status"]].values.tolist() == [[10_000, 10_100, "CLOSED"]]
    assert np.issubdtype(out["cost"].dtype, np.integer)


def test_hot_pieces_are_split_and_results_stay(spark):
    """One key holds most rows; pieces over max_piece_rows are range-split."""
    rng = random.Random(11)
    rows = gen_rows(rng, 30, keys=3)
    rows += [(100 + i, 10_000 + rng.randrange(50), "HOT", "H1", rng.choice(STATUSES))
             for i in range(120)]
    want = brute(rows)
    for limit, bucket in [(1, 10**9), (3, 60), (7, 1000), (50, 13)]:
        s = S.with_(bucket_seconds=bucket, max_piece_rows=limit)
        assert spark_sessions(spark, rows, s) == want, (limit, bucket)


def test_split_pieces_are_bounded_and_ordered(spark):
    from pyspark.sql import functions as F

    from bayline.operators.pieces import with_pieces
    rows = [(i, 10_000 + i // 4, "HOT", "H1", "PARKED") for i in range(400)]
    s = S.with_(bucket_seconds=10**9, max_piece_rows=50)
    df = with_pieces(spark.createDataFrame(rows, EV), ["license_plate", "location"],
                     "timestamp_unix", ["timestamp_unix", "event_id"], s)
    per = df.groupBy("sub").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("lo"),
                                F.max("event_id").alias("hi")).orderBy("sub").collect()
    assert len(per) > 1 and max(r.n for r in per) <= 100  # sampled bounds: about the limit
    assert all(a.hi < b.lo for a, b in zip(per, per[1:]))  # contiguous, in order


def test_spot_conflicts_split_pieces_equal_brute_force(spark):
    from bayline.operators import audit
    rng = random.Random(5)
    rows = [(i, 10_000 + rng.randrange(2000), f"P{rng.randrange(6)}", "A1",
             rng.choice(STATUSES)) for i in range(150)]
    sess = sessionize.parking_sessions(spark.createDataFrame(rows, EV), S).collect()
    want = set()
    for x in sess:
        for y in sess:
            kx = (x.start_time, x.license_plate, x.session_no)
            ky = (y.start_time, y.license_plate, y.session_no)
            if (x.location == y.location and kx < ky and y.start_time <= x.end_time
                    and x.license_plate != y.license_plate):
                want.add((x.license_plate, x.start_time, y.license_plate, y.start_time))
    assert want
    for limit in (0, 4):
        s = S.with_(bucket_seconds=300, max_piece_rows=limit)
        got = audit.spot_conflicts(sessionize.parking_sessions(spark.createDataFrame(rows, EV), s), s)
        assert {(r.plate_a, r.start_a, r.plate_b, r.start_b) for r in got.collect()} == want


def test_changelog_same_on_every_path(spark):
    from bayline.operators import changelog
    rng = random.Random(23)
    rows = gen_rows(rng, 120, keys=4, span=900)
    ev = spark.createDataFrame(rows, EV)
    cols = changelog.CHANGELOG_COLUMNS

    def run(**kw):
        return sorted(map(tuple, changelog.session_changelog(ev, S.with_(**kw)).select(*cols)
                          .collect()), key=repr)

    whole = run()
    assert any(r[7] == "TIMEOUT" for r in whole) and any(r[7] == "CLOSED" for r in whole)
    assert run(max_piece_rows=0, bucket_seconds=37) == whole
    assert run(max_piece_rows=20, bucket_seconds=50) == whole
    assert run(lone_exit="drop", max_piece_rows=20) == run(lone_exit="drop")


def test_table_state_stream_equals_brute_force(spark):
    """Random events and cuts through the micro-batch-as-batch-job stream."""
    from bayline.operators.sessionize import valid_events
    from bayline.streaming import jobs
    from bayline.streaming.tables import replay_table_sessions
    for seed in (3, 8):
        rng = random.Random(seed)
        rows = gen_rows(rng, 45, keys=3, span=500)
        cuts = sorted(rng.sample(range(10_001, 10_500), 3))
        s = S.with_(max_piece_rows=rng.choice([0, 4, 4_000_000]), bucket_seconds=60)
        ev = valid_events(spark.createDataFrame(rows, EV))
        table = replay_table_sessions(spark, ev, s, cuts=cuts)
        got = jobs.sessions_from_changelog(spark.read.parquet(table))
        cols = ["license_plate", "location", "start_time", "end_time", "duration", "cost",
                "status", "n_events"]
        assert sorted(map(tuple, got.select(*cols).collect())) == brute(rows), seed


def test_ordered_stream_any_arrival_order_equals_brute_force(spark):
    """Rows arrive in random order within the watermark delay."""
    from bayline.operators.sessionize import valid_events
    from bayline.streaming import jobs
    from bayline.streaming.ordered import ordered_sessionize_stream
    s = S.with_(watermark_delay="1000 seconds")
    for seed in (5, 9):
        rng = random.Random(seed)
        rows = gen_rows(rng, 40, keys=3, span=500)
        shuffled = rows[:]
        rng.shuffle(shuffled)
        parts = [shuffled[:13], shuffled[13:27], shuffled[27:]]
        flush = [(10_000, 20_000, "FLUSH", "Z9", "PARKED")]  # moves the watermark past all
        frames = [valid_events(spark.createDataFrame(p, EV)) for p in (*parts, flush)]
        table = jobs.replay_slices(spark, frames, lambda st: ordered_sessionize_stream(st, s))
        got = jobs.sessions_from_changelog(spark.read.parquet(table))
        cols = ["license_plate", "location", "start_time", "end_time", "duration", "cost",
                "status", "n_events"]
        got = sorted(r for r in map(tuple, got.select(*cols).collect()) if r[0] != "FLUSH")
        assert got == brute(rows, as_of=20_000 - 1000), seed
