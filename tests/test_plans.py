"""Plan checks: no Python in batch plans, pruned scans, one shuffle of events."""

import re

import pytest
from conftest import SF0001

from bayline.plans.queries import QUERIES

BATCH = sorted(n for n in QUERIES if not n.startswith("stream"))


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_batch_plans(spark, name):
    plan = QUERIES[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"EvalPython|InPandas|MapInArrow|PythonUDF", plan), name


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["parking_sessions"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))
    assert schemas, plan
    for sch in schemas:
        assert "value" not in sch and "props" not in sch, sch


def _final(df):
    plan = _executed(df)
    final = plan.split("\n+- == Initial Plan ==")[0]  # the top-level final plan
    return final, "\n".join(x for x in final.split("\n") if "ReusedExchange" not in x)


def test_events_are_shuffled_once(spark):
    from bayline.operators.sessionize import parking_sessions
    from bayline.sources.fixture import fixture_settings, parking_events
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ev = parking_events(spark.read.parquet(f"{SF0001}/events.parquet"))
        # no hot key: one shuffle on the key; windows and both aggregation
        # phases run in the same stage, no join
        final, own = _final(parking_sessions(ev, fixture_settings()))
        assert len(re.findall(r"Exchange hashpartitioning\(license_plate", own)) == 1
        assert "SortMergeJoin" not in final and "ReusedExchange" not in final
        # the piecewise path (every key cut into pieces): the event shuffle on
        # (key, bucket) is written once and reused by both branches
        final, own = _final(parking_sessions(ev, fixture_settings(max_piece_rows=0)))
        assert "ReusedExchange" in final
        keyed = re.findall(
            r"Exchange hashpartitioning\(license_plate#\d+, location#\d+, bucket#\d+L", own)
        assert len(keyed) == 2  # events once, the small carried summaries once
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spot_conflicts_compute_sessions_once(spark):
    """One scan of the events and one shuffle of them by key feed both sides of
    the overlap join."""
    final, own = _final(QUERIES["spot_conflicts"](spark, SF0001))
    assert own.count("FileScan") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(license_plate", own)) == 1


def test_dimension_broadcast_only_under_bound(spark):
    from bayline.operators import dims
    from bayline.params import Settings
    small = Settings(n_cols=10)
    big = Settings(n_cols=10, broadcast_max_rows=10)
    d = dims.location_dim(spark, small)
    assert "ResolvedHint" in dims.dim_for_join(d, small)._jdf.queryExecution().analyzed().toString() \
        or "broadcast" in dims.dim_for_join(d, small)._jdf.queryExecution().analyzed().toString()
    assert dims.dim_for_join(d, big) is d
