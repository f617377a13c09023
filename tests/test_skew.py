"""A key holding a third of all rows, inside one time bucket."""

import pytest
from pyspark.sql import functions as F

from bayline.operators import audit, changelog, sessionize
from bayline.operators.pieces import with_pieces
from bayline.params import Settings

N, HOT = 300_000, 100_000
LIMIT = 20_000


def skewed(spark):
    r = spark.range(N)
    hot = F.col("id") < HOT
    statuses = F.array(*[F.lit(x) for x in ("ENTERING", "PARKED", "PARKED", "MOVING", "EXITING")])
    return r.select(
        F.col("id").alias("event_id"),
        # the hot key: 100k rows within one hour; the rest spread over 20 days
        F.when(hot, F.lit(1_700_000_000) + F.col("id") % 3600)
        .otherwise(F.lit(1_700_000_000) + (F.col("id") * 7919) % (20 * 86400))
        .cast("long").alias("timestamp_unix"),
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("P"), (F.col("id") % 997).cast("string")))
        .alias("license_plate"),
        F.when(hot, F.lit("H1")).otherwise(F.concat(F.lit("L"), (F.col("id") % 13).cast("string")))
        .alias("location"),
        F.element_at(statuses, (F.col("id") % 5 + 1).cast("int")).alias("status_code"),
    )


def test_hot_bucket_is_cut_into_bounded_pieces(spark):
    s = Settings(timeout_seconds=600, max_piece_rows=LIMIT)
    ev = sessionize.valid_events(skewed(spark))
    p = with_pieces(ev, ["license_plate", "location"], "timestamp_unix",
                    ["timestamp_unix", "event_id"], s)
    sizes = p.groupBy("license_plate", "location", "bucket", "sub").count()
    biggest = sizes.agg(F.max("count")).first()[0]
    hot_pieces = sizes.where(F.col("license_plate") == "HOT").count()
    assert hot_pieces >= HOT // LIMIT
    assert biggest <= 2 * LIMIT, biggest


def test_results_do_not_depend_on_the_cut(spark):
    df = skewed(spark)
    cut = Settings(timeout_seconds=600, max_piece_rows=LIMIT)
    whole = Settings(timeout_seconds=600, bucket_seconds=10**12, max_piece_rows=0)
    cols = ["license_plate", "location", "session_no", "start_time", "end_time", "status",
            "n_events"]
    a = sessionize.parking_sessions(df, cut).select(*cols)
    b = sessionize.parking_sessions(df, whole).select(*cols)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_cut_of_a_hot_bucket_never_changes_a_result(spark, reuse):
    """One key with 120,000 rows in one bucket, limit 20,000: every operator
    that cuts equals the whole-key result, whatever exchanges are shared."""
    whole = Settings(timeout_seconds=30, max_piece_rows=10 ** 9)
    cut = whole.with_(max_piece_rows=LIMIT)
    statuses = F.array(*[F.lit(x) for x in ("ENTERING", "PARKED", "PARKED", "MOVING", "EXITING")])
    h = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n))
    ev = spark.range(120_000).select(
        F.col("id").alias("event_id"), h(1, 3500).alias("timestamp_unix"), F.lit("P").alias("license_plate"),
        F.lit("A1").alias("location"), F.element_at(statuses, (h(2, 5) + 1).cast("int")).alias("status_code"))
    sessions = spark.range(60_000).select(
        F.lit("A1").alias("location"), F.concat(F.lit("P"), F.col("id") % 500).alias("license_plate"),
        F.col("id").alias("session_no"), h(3, 3_500_000).alias("start_time")).withColumn(
        "end_time", F.col("start_time") + F.pmod(F.xxhash64("session_no", F.lit(4)), F.lit(200)))
    runs = {
        "sessions": lambda s: sessionize.parking_sessions(ev, s),
        "gap": lambda s: sessionize.gap_sessions(ev, s),
        "changelog": lambda s: changelog.session_changelog(ev, s),
        "transitions": lambda s: audit.transition_audit(ev, s),
        "conflicts": lambda s: audit.spot_conflicts(sessions, s.with_(bucket_seconds=10 ** 7)),
    }
    conf = {"spark.sql.exchange.reuse": reuse, "spark.sql.execution.rangeExchange.sampleSizePerPartition": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for name, run in runs.items():
            a, b = run(whole), run(cut)
            a = a.groupBy(F.xxhash64(*a.columns).alias("h")).count()
            b = b.groupBy(F.xxhash64(*run(whole).columns).alias("h")).count()
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_long_overlap_is_exploded_in_blocks(spark):
    """One session that overlaps 20,000 others, five blocks long."""
    others = spark.range(1, 20_001).select(
        F.lit("A1").alias("location"), F.concat(F.lit("P"), F.col("id")).alias("license_plate"),
        F.lit(1).cast("long").alias("session_no"), F.col("id").alias("start_time"), F.col("id").alias("end_time"))
    one = spark.createDataFrame([("A1", "Q", 1, 0, 20_000)], others.schema)
    assert audit.spot_conflicts(others.unionByName(one), Settings()).count() == 20_000


@pytest.mark.parametrize("limit", [LIMIT, 4_000_000])
def test_facts_in_one_pass_and_no_job_while_building(spark, limit):
    """The latest time and the hot keys come from one pass; with both given,
    building the sessions of a table without hot keys starts no job."""
    s = Settings(timeout_seconds=30, max_piece_rows=limit)
    ev = skewed(spark)
    as_of, hot = sessionize.event_facts(ev, s)
    assert as_of == ev.agg(F.max("timestamp_unix")).first()[0]
    assert len(hot) == (1 if limit == LIMIT else 0)
    got = sessionize.parking_sessions(ev, s, as_of, hot)
    want = sessionize.parking_sessions(ev, s)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    if not hot:
        sc = spark.sparkContext
        sc.setJobGroup("building", "no job is expected")
        try:
            sessionize.parking_sessions(ev, s, as_of, hot)
            assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
        finally:
            sc.setJobGroup("", "")
