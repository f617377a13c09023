"""Keys of a stream are folded together, a group of them in one call."""

import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from util import events, sessions_list
from test_properties import FakeState

from bayline.operators import sessionize
from bayline.params import Settings
from bayline.plans.runtime import scratch_path
from bayline.streaming import fold, jobs, salted, state_views
from bayline.streaming.ordered import ordered_sessionize_stream

S = Settings(timeout_seconds=30, watermark_delay="0 seconds")
RUNS = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 300), st.integers(0, 20), st.booleans()), min_size=1, max_size=40)
OPEN = st.lists(st.one_of(st.none(), st.tuples(st.integers(0, 300), st.integers(0, 60), st.integers(1, 5))), min_size=4, max_size=4)


@settings(max_examples=400, deadline=None)
@given(RUNS, OPEN, st.sampled_from([0, 100_000, 250_000]), st.sampled_from(["emit", "drop"]))
def test_keys_folded_together_are_as_each_alone(runs, opened, wm, lone):
    """Runs in any place to the open sessions: before, within and after them."""
    s = S.with_(lone_exit=lone)
    runs = sorted((k, t, i, t + d, x) for i, (k, t, d, x) in enumerate(runs))
    key, start, ids, end, is_exit = (np.array(c) for c in zip(*runs))
    n = ids % 2 + 1
    states = [None if o is None else (o[0], o[0] + o[1], o[2], 1000 + k) for k, o in enumerate(opened)]
    arrays = (np.array([o is not None for o in states]), *(np.array([o[i] if o else 0 for o in states], "int64") for i in range(4)))
    got, after = fold.fold_keys(key, (start, end, n, ids, is_exit), arrays, wm, s)
    for k in range(4):
        of = key == k
        rows, left, _ = fold.fold_runs(*(x[of] for x in (start, end, n, ids, is_exit)), states[k], wm, s)
        mine = [(int(a), int(b), "CLOSED" if c else "TIMEOUT", int(d), int(e)) for q, a, b, c, d, e in zip(*got) if q == k]
        assert sorted(mine) == sorted((int(a), int(b), c, int(d), int(e)) for a, b, c, d, e in rows)
        assert (tuple(int(c[k]) for c in after[1:]) if after[0][k] else None) == left


def batches_of(seed):
    r = random.Random(seed)
    return [[(i * 1000 + j, 10_000 + i * 60 + r.randrange(90), f"P{r.randrange(5)}", f"A{r.randrange(2)}",
              r.choice(["PARKED", "PARKED", "EXITING"])) for j in range(r.randrange(1, 30))] for i in range(6)]


COLS = ["event_id", "timestamp_unix", "license_plate", "location", "status_code"]


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**6))
def test_a_group_changes_as_its_keys_do(seed):
    """Batch by batch the changes of a group are those of its keys, late rows
    and timeouts included (after each batch one without data, as Spark runs)."""
    one, all_ = fold.make_fold(S), fold.make_group_fold(S)
    states, group, wm = {}, FakeState(), 0
    for batch in [b for rows in batches_of(seed) for b in (rows, [])]:
        want, got = [], []
        by_key = {}
        for row in batch:
            by_key.setdefault(row[2:4], []).append(row)
        for k, rows in by_key.items():
            state = states.setdefault(k, FakeState())
            state.wm, state.hasTimedOut = wm, False
            want += one(k, iter([pd.DataFrame(rows, columns=COLS)]), state)
        for k, state in states.items():
            if k not in by_key and state.timer is not None and state.timer < wm:
                state.wm, state.hasTimedOut = wm, True
                want += one(k, iter([]), state)
        due = group.timer is not None and group.timer < wm
        group.wm, group.hasTimedOut = wm, due and not batch
        if batch or due:
            got += all_((0,), iter([pd.DataFrame(batch[i::2], columns=COLS) for i in (1, 0)] if batch else []), group)
        plain = lambda frames: sorted(map(str, (r for f in frames for r in f.astype(object).where(f.notna(), None).itertuples(index=False, name=None))))
        assert plain(got) == plain(want)
        wm = max([wm, *(r[1] * 1000 for r in batch)])


@pytest.mark.parametrize("build", [jobs.sessionize_stream, salted.salted_sessionize_stream, ordered_sessionize_stream])
def test_many_keys_few_calls(spark, build):
    """The state has a row for a group, not for a key, and the sessions are the
    batch job's."""
    s = S.with_(state_groups=4, timeout_seconds=500)
    r = random.Random(3)
    rows = [(r.randrange(3000), r.choice(["ENTERING", "PARKED", "EXITING"]), f"A{k}") for k in range(200) for _ in range(4)]
    ev = events(spark, rows)
    base = scratch_path(spark, "groups")
    table = jobs.replay(spark, ev, lambda x: build(x, s), n_slices=2, base=base)
    got = sessions_list(jobs.sessions_from_changelog(spark.read.parquet(table)))
    assert got == sessions_list(sessionize.parking_sessions(ev, s)) and len(got) > 400
    ckpt = f"{base}/checkpoint"
    assert spark.read.format("statestore").load(ckpt).count() <= 4
    assert state_views.open_sessions(spark, ckpt).count() == sum(x[-1] == "ACTIVE" for x in got) > 20
