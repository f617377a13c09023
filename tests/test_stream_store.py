"""View store, changelog compaction and sink ledger: bounded, retry-safe, readable meanwhile."""

import os
import random

import pytest
from util import events as _events
from util import sessions_list as _sessions_list

from bayline.operators import views
from bayline.operators.sessionize import valid_events
from bayline.params import Settings
from bayline.plans.runtime import scratch_path
from bayline.streaming import compaction, jobs, ledger, live_views
from bayline.streaming.fold import OUTPUT

S = Settings(timeout_seconds=3600, bucket_seconds=600, watermark_delay="0 seconds", closed_retention=5)
OFF = 1_000_000


def changes(spark, epoch, n_keys=6):
    """An epoch's changes: each key's session goes on, every fifth ends."""
    r = random.Random(epoch)
    rows = []
    for k in r.sample(range(n_keys), 3):
        number = sum(1 for e in range(epoch) if (e + k) % 5 == 0)
        status = "CLOSED" if (epoch + k) % 5 == 0 else "ACTIVE"
        start, end = 1000 * number, 1000 * number + epoch
        rows.append((f"P{k}", "A1", start, end, end - start, 10000, status, end, epoch + 1, number))
    return spark.createDataFrame(rows, OUTPUT), rows


def expected(history, retention):
    last = {}
    for rows in history:
        for r in rows:
            last[(r[0], r[1], r[2], r[9])] = r
    closed = sorted((r for rows in history for r in rows if r[6] == "CLOSED"), key=lambda r: (-r[3], r[0], r[1], r[2]))
    return sorted(r for r in last.values() if r[6] == "ACTIVE"), closed[:retention], len(closed)


def folders(path):
    return sum(len([d for d in os.listdir(os.path.join(path, t)) if d.startswith("epoch_id=")])
               for t in os.listdir(path) if os.path.isdir(os.path.join(path, t)))


def views_of(spark, base):
    open_now, closed_now, total = live_views.latest_views_state(spark, base, S.closed_retention)
    order = OUTPUT.names
    return sorted(map(tuple, open_now.select(*order).collect())), [tuple(r) for r in closed_now.select(*order).collect()], total


def test_view_store_stays_small_and_right(spark):
    """Many epochs, some retried: the views are those of the whole history,
    the number of folders doesn't grow."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        base = scratch_path(spark, "store")
        sink, history, sizes = live_views.live_views_sink(base, S, merge_every=4, keep=2), [], []
        for epoch in range(30):
            frame, rows = changes(spark, epoch)
            sink(frame, epoch)
            if epoch % 7 == 3:
                sink(frame, epoch)  # the batch runs again
            history.append(rows)
            sizes.append(folders(base))
            if epoch in (0, 2, 3, 4, 10, 11, 29):
                want = expected(history, S.closed_retention)
                got = views_of(spark, base)
                assert got[0] == want[0] and sorted(got[1]) == sorted(want[1]) and got[2] == want[2], epoch
        assert max(sizes[10:]) <= max(sizes[:10]) <= 2 + 2 * 4 + 2 * 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_reader_of_an_older_manifest_finishes(spark):
    base = scratch_path(spark, "store-reader")
    sink = live_views.live_views_sink(base, S, merge_every=2, keep=3)
    for epoch in range(3):
        sink(changes(spark, epoch)[0], epoch)
    open_then, _, _ = live_views.latest_views_state(spark, base, 5)
    want = expected([changes(spark, e)[1] for e in range(3)], 5)[0]
    for epoch in (3, 4):
        sink(changes(spark, epoch)[0], epoch)
    assert sorted(map(tuple, open_then.select(*OUTPUT.names).collect())) == want


@pytest.mark.parametrize("fan_in", [2, 3])
def test_compaction_keeps_sessions_and_bounds_folders(spark, fan_in):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        table, plain = scratch_path(spark, "lsm"), scratch_path(spark, "plain")
        sink, whole = compaction.compacted_sink(table, fan_in=fan_in, keep=2), jobs.epoch_table_sink(plain)
        reader = want_then = None
        for epoch in range(14):
            frame, _ = changes(spark, epoch)
            sink(frame, epoch)
            whole(frame, epoch)
            if epoch == 7:
                sink(frame, epoch)
            if epoch == 12:
                reader = compaction.read_compacted(spark, table)
                want_then = sessions(spark.read.parquet(plain))
        assert sessions(compaction.read_compacted(spark, table)) == sessions(spark.read.parquet(plain))
        assert sessions(reader) == want_then  # opened before the last batch
        assert folders(table) < 14
        low = compaction.manifests(spark, table)[13]["low_water"]
        after = compaction.changes_since(spark, table, low)
        assert sorted(r.epoch_id for r in after.select("epoch_id").distinct().collect()) == list(range(low + 1, 14))
        with pytest.raises(ValueError, match="merged"):
            compaction.changes_since(spark, table, low - 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def sessions(changelog):
    return sorted(map(tuple, jobs.sessions_from_changelog(changelog, ["end_time", "status", "n_events"]).collect()))


def test_retry_after_the_first_sink_writes_only_the_second(spark):
    """The query dies in its second sink; the restart leaves the first alone."""
    base = scratch_path(spark, "ledger")
    written, failures = [], [1]

    def first(batch, epoch_id):
        written.append(("first", epoch_id))
        jobs.epoch_table_sink(f"{base}/first")(batch, epoch_id)

    def second(batch, epoch_id):
        if epoch_id == 1 and failures:
            failures.pop()
            raise RuntimeError("sink is down")
        written.append(("second", epoch_id))
        jobs.epoch_table_sink(f"{base}/second")(batch, epoch_id)

    sink = ledger.ledgered(f"{base}/ledger", first=first, second=second)
    ev = valid_events(_events(spark, [(0, "ENTERING"), (10, "PARKED")], offset=OFF))
    more = valid_events(_events(spark, [(20, "PARKED"), (30, "EXITING")], offset=OFF))

    def run():
        stream = spark.readStream.schema(ev.schema).parquet(f"{base}/in")
        q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start()
        q.awaitTermination()

    ev.write.parquet(f"{base}/in")
    run()
    more.write.mode("append").parquet(f"{base}/in")
    with pytest.raises(Exception, match="sink is down"):
        run()
    run()
    assert written == [("first", 0), ("second", 0), ("first", 1), ("second", 1)]
    a, b = (sorted(map(tuple, spark.read.parquet(f"{base}/{n}").collect())) for n in ("first", "second"))
    assert a == b and len(a) == 4
    run()  # nothing new
    assert len(written) == 4


def test_ledger_keeps_few_marks(spark):
    base = scratch_path(spark, "marks")
    sink = ledger.ledgered(base, keep=2, only=lambda batch, epoch_id: None)
    for epoch in range(5):
        sink(spark.range(1), epoch)
    assert sorted(d for d in os.listdir(f"{base}/only") if d.startswith("epoch_id=")) == ["epoch_id=3", "epoch_id=4"]
    assert ledger.is_marked(spark, base, "only", 4) and not ledger.is_marked(spark, base, "only", 5)


def test_console_sink_prints_each_batch(spark, capsys):
    from bayline.sources.sinks import console_batch_sink
    console_batch_sink(5)(spark.createDataFrame([("29A-1", "ACTIVE")], "license_plate string, status string"), 3)
    out = capsys.readouterr().out
    assert "-- batch 3" in out and "29A-1" in out


def test_retention_below_the_asked_limit(spark):
    rows = [changes(spark, e)[1] for e in range(30)]
    frame = spark.createDataFrame([r for x in rows for r in x], OUTPUT)
    want = expected(rows, 5)[1]
    got = views.closed_history(frame, 50, retention=5)
    assert got.count() == 5 and [r.end_time for r in got.collect()] == [r[3] for r in want]
    assert _sessions_list(views.closed_history(frame, 3, retention=5)) == sorted((*r[:7],) for r in want[:3])
