"""Results do not depend on partitioning, Arrow chunking or input files."""

from conftest import SF0001

from bayline.operators import dims, sessionize, views
from bayline.sources.fixture import fixture_n_cols, fixture_settings, parking_events

COLS = ["license_plate", "location", "session_no", "start_time", "end_time", "status", "n_events"]


def _events(spark):
    return parking_events(spark.read.parquet(f"{SF0001}/events.parquet"))


def _rows(df, cols=COLS):
    return sorted(map(tuple, df.select(*cols).collect()))


def test_busy_and_free_partition_the_dimension(spark):
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    s = fixture_settings(n_cols=fixture_n_cols(ev))
    sess = sessionize.parking_sessions(parking_events(ev), s)
    dim = {r.location for r in dims.location_dim(spark, s).collect()}
    busy = {r.location for r in views.busy_locations(sess).collect()}
    free = {r.location for r in views.free_locations(dims.location_dim(spark, s), sess).collect()}
    assert busy and free and not (busy & free) and busy | free == dim


def test_shuffle_partitions_do_not_matter(spark):
    s = fixture_settings()
    base = _rows(sessionize.parking_sessions(_events(spark), s))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert _rows(sessionize.parking_sessions(_events(spark), s)) == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_input_files_do_not_matter(spark):
    from bayline.plans.runtime import scratch_path
    s = fixture_settings()
    base = _rows(sessionize.parking_sessions(_events(spark), s))
    path = scratch_path(spark, "split-input")
    spark.read.parquet(f"{SF0001}/events.parquet").repartition(7).write.parquet(path)
    split = parking_events(spark.read.parquet(path))
    assert _rows(sessionize.parking_sessions(split, s)) == base


def test_arrow_chunks_do_not_matter_for_the_fold(spark):
    from bayline.streaming.jobs import replay, sessionize_stream, sessions_from_changelog
    s = fixture_settings()
    want = _rows(sessionize.parking_sessions(_events(spark), s), COLS[:2] + COLS[3:])
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        # every group of a trigger arrives in chunks of at most 2 rows
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
        table = replay(spark, _events(spark), lambda st: sessionize_stream(st, s), n_slices=2)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    got = sessions_from_changelog(spark.read.parquet(table),
                                  ["end_time", "status", "n_events"])
    assert _rows(got, COLS[:2] + COLS[3:]) == want
