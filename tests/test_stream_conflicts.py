"""Spot conflicts on the live stream: the batch answer, bounded state."""

import random

from pyspark.sql import functions as F

from bayline.operators import audit
from bayline.params import Settings
from bayline.plans.runtime import scratch_path
from bayline.streaming import conflicts
from bayline.streaming.fold import OUTPUT

S = Settings(timeout_seconds=3600, bucket_seconds=500, watermark_delay="0 seconds")
HORIZON = 1500


def epoch_rows(epoch, ident):
    """Sessions that end in an epoch of 1000 s, some long, some at equal times."""
    r, rows = random.Random(epoch), []
    for _ in range(12):
        end = 1000 * epoch + r.randrange(0, 1000, 50)
        start = max(0, end - r.choice([0, 50, 300, 700, 5000]))
        rows.append((f"P{r.randrange(6)}", f"A{r.randrange(2)}", start, end, end - start, 10000,
                     r.choice(["CLOSED", "TIMEOUT"]), end, 2, next(ident)))
    return rows


def test_equals_batch_and_state_shrinks(spark):
    """Epochs read a few at a time, one of them written again after it was
    read: each overlap once, and the state holds only the last horizon's."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        base, ident = scratch_path(spark, "conflicts-test"), iter(range(10**6))
        table, pairs = f"{base}/ended", f"{base}/pairs"
        sink, rows, held = conflicts.ended_sink(table, HORIZON), [], []
        for epoch in range(9):
            new = epoch_rows(epoch, ident) if epoch != 4 else []
            live = [("P9", "A0", 100, 1000 * epoch, 0, 0, "ACTIVE", 0, 2, -1)]
            rows += new
            sink(spark.createDataFrame(new + live, OUTPUT), epoch)
            if epoch == 5:
                sink(spark.createDataFrame(new + live, OUTPUT), epoch)
            if epoch % 2 == 0:
                q = conflicts.start_conflicts(spark, table, S, HORIZON, pairs, f"{base}/checkpoint", available_now=True)
                q.awaitTermination()
                assert q.exception() is None
                if epoch == 4:
                    sink(spark.createDataFrame(new + live, OUTPUT), epoch)
                last = [p for p in q.recentProgress if p.stateOperators]
                held.append(last[-1].stateOperators[0].numRowsTotal)
                assert all(o.numRowsDroppedByWatermark == 0 for p in last for o in p.stateOperators)
        open_now = spark.createDataFrame(live, OUTPUT)
        got = sorted(map(tuple, conflicts.conflicts(spark, table, pairs, open_now, S).collect()))
        every = spark.createDataFrame(rows + live, OUTPUT).withColumnRenamed("start_event_id", "session_no")
        want = sorted(map(tuple, audit.spot_conflicts(every, S).collect()))
        assert got == want and len(got) > 100
        read = spark.read.parquet(f"{table}/short").count(), spark.read.parquet(f"{table}/long").count()
        assert sum(read) == len(rows) and min(read) > 10
        # at the end the state holds the sessions of the last horizon, and no other
        kept, newest = spark.read.parquet(f"{table}/short"), max(r[3] for r in rows + live)
        sides = F.sum(2 + F.floor(F.col("end_time") / S.bucket_seconds) - F.floor(F.col("start_time") / S.bucket_seconds))
        of = lambda some: some.agg(F.coalesce(sides, F.lit(0))).first()[0]
        recent = of(kept.where(F.col("left_at").cast("long") >= newest - 1 - HORIZON))
        assert 0 < held[-1] <= recent and 3 * recent < of(kept), (held, recent)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_no_sessions(spark):
    base = scratch_path(spark, "conflicts-none")
    none = spark.createDataFrame([], OUTPUT)
    conflicts.ended_sink(f"{base}/ended", HORIZON)(none, 0)
    q = conflicts.start_conflicts(spark, f"{base}/ended", S, HORIZON, f"{base}/pairs", f"{base}/checkpoint", available_now=True)
    q.awaitTermination()
    assert conflicts.conflicts(spark, f"{base}/ended", f"{base}/pairs", none, S).collect() == []


def test_files_go_by_rows_not_by_partitions(spark):
    """A batch in many partitions leaves a file or two to read, and all its rows."""
    base, ident = scratch_path(spark, "conflicts-files"), iter(range(10**6))
    rows = [r for epoch in range(9) for r in epoch_rows(epoch, ident)]
    conflicts.ended_sink(f"{base}/ended", HORIZON)(spark.createDataFrame(rows, OUTPUT).repartition(40), 0)
    read = [spark.read.parquet(f"{base}/ended/{t}") for t in ("short", "long")]
    assert sum(r.count() for r in read) == len(rows) and all(len(r.inputFiles()) == 1 for r in read)
