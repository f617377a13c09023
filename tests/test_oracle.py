"""Every registered query against its DuckDB SQL on the driver's tables."""

import pytest
from conftest import SF0001, SF001
from oracle import compare, duck

import __spark_entry__ as entry
from bayline.plans.queries import QUERIES

# the corpus operators have their own tests
SQL = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle_sf0001(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF0001), SQL[name], con)
    assert ok, msg


@pytest.mark.parametrize("name", ["parking_sessions", "session_changelog", "spot_conflicts",
                                  "active_by_plate", "occupancy", "transition_audit"])
def test_matches_oracle_sf001(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF001), SQL[name], duck(SF001))
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 388
    assert df.columns == ["license_plate", "location", "session_no", "start_time", "end_time",
                          "duration", "cost", "status", "last_updated", "n_events"]


def test_stream_changelog_last_rows_equal_sessions(spark):
    """The latest change of each session (most events; a final status wins a
    tie with ACTIVE) is the batch session."""
    from pyspark.sql import functions as F
    chg = QUERIES["stream_changelog"](spark, SF0001)
    last = (chg.groupBy("license_plate", "location", "start_time", "start_event_id")
            .agg(F.max(F.struct("n_events", (F.col("status") != "ACTIVE").alias("final"),
                                "end_time", "status")).alias("l"))
            .select("license_plate", "location", "start_time", "l.end_time", "l.status",
                    "l.n_events"))
    batch = QUERIES["parking_sessions"](spark, SF0001)
    cols = ["license_plate", "location", "start_time", "end_time", "status", "n_events"]
    a = sorted(map(tuple, last.select(*cols).collect()))
    b = sorted(map(tuple, batch.select(*cols).collect()))
    assert a == b
