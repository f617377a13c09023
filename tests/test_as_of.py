"""Requests as of their time: by hand, brute force, hot spots."""

import random

import pytest
from util import events

from bayline.operators.as_of import location_info_at
from bayline.operators.changelog import session_changelog
from bayline.params import Settings

S = Settings(timeout_seconds=100, block_seconds=60, block_price=7)
REQUEST = "request_id long, location string, at long"


def answers(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((v is not None, v) for v in r))


def test_by_hand(spark):
    log = session_changelog(events(spark, [(10, "ENTERING"), (50, "PARKED"), (60, "EXITING"), (200, "ENTERING"), (900, "PARKED", "B1")]), S)
    ask = [(1, "A1", 9), (2, "A1", 10), (3, "A1", 59), (4, "A1", 60), (5, "A1", 300), (6, "A1", 299), (7, "Z9", 60), (8, None, 5),
           (9, "A1", None), (None, "A1", 59), (3, "A1", 59)]
    got = answers(location_info_at(spark.createDataFrame(ask, REQUEST), log, S))
    plate = "29A-12345"
    free = lambda i, spot, at: (i, spot, at, "FREE", None, None, None, None)
    busy = lambda i, at, start, cost: (i, "A1", at, "OCCUPIED", plate, start, at - start, cost)
    want = [busy(None, 59, 10, 7), free(1, "A1", 9), busy(2, 10, 10, 0), busy(3, 59, 10, 7), busy(3, 59, 10, 7), free(4, "A1", 60),
            free(5, "A1", 300), busy(6, 299, 200, 14), free(7, "Z9", 60)]
    assert got == answers_of(want)
    assert location_info_at(spark.createDataFrame([], REQUEST), log, S).collect() == []
    assert [r.status for r in location_info_at(spark.createDataFrame([(1, "A1", 5)], REQUEST), log.limit(0), S).collect()] == ["FREE"]


def answers_of(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("limit", [4_000_000, 20, 1, 0])
def test_hot_spot_in_pieces_gives_the_brute_answers(spark, limit):
    """Most rows lie on one spot; any cut into pieces gives the same answers."""
    r = random.Random(5)
    rows = [(r.randrange(2000), r.choice(["PARKED", "PARKED", "EXITING"]), r.choice(["A1"] * 5 + ["B1"]), r.choice(["p", "q", "r"]))
            for _ in range(150)]
    s = S.with_(max_piece_rows=limit, bucket_seconds=300)
    log = session_changelog(events(spark, rows), S)
    changes = [(x.location, x.change_time, x.change_kind, x.event_id, x.license_plate, x.status, x.start_time) for x in log.collect()]
    ask = [(i, r.choice(["A1", "A1", "B1", "C1"]), r.randrange(-10, 2300)) for i in range(200)]
    want = []
    for i, spot, at in ask:
        past = [c for c in changes if c[0] == spot and c[1] <= at]
        last = max(past, key=lambda c: (c[1], c[2], c[3], c[4], c[5])) if past else None
        if last and last[5] == "ACTIVE":
            d = at - last[6]
            want.append((i, spot, at, "OCCUPIED", last[4], last[6], d, -(-d // 60) * 7))
        else:
            want.append((i, spot, at, "FREE", None, None, None, None))
    assert answers(location_info_at(spark.createDataFrame(ask, REQUEST), log, s)) == answers_of(want)
