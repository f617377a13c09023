"""Named queries over the driver's tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.functions.clock import as_of_column
from bayline.operators import audit, changelog, dims, sessionize, views
from bayline.params import Settings
from bayline.sources import raw
from bayline.sources.fixture import epoch_seconds_ntz, fixture_n_cols, fixture_settings, parking_events
from bayline.sources.fixture_raw import raw_messages
from bayline.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _pe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parking_events(_events(spark, sf_dir))


def settings_for(spark: SparkSession, sf_dir: str) -> Settings:
    """Fixture settings; the spot columns follow from the data (one scalar)."""
    return fixture_settings(n_cols=fixture_n_cols(_events(spark, sf_dir)))


def _sessions(spark, sf_dir, s):
    return sessionize.parking_sessions(_pe(spark, sf_dir), s)


def _as_of(spark, sf_dir):
    return as_of_column(sessionize.valid_events(_pe(spark, sf_dir)))


def q_parking_events(spark, sf_dir):
    return _pe(spark, sf_dir).select("event_id", "timestamp", "timestamp_unix",
                                     "license_plate", "location", "status_code")


def q_parking_sessions(spark, sf_dir):
    return _sessions(spark, sf_dir, fixture_settings())


def q_gap_sessions(spark, sf_dir):
    return sessionize.gap_sessions(_pe(spark, sf_dir), fixture_settings())


def q_decode_events(spark, sf_dir):
    return raw.decode_events(raw_messages(_events(spark, sf_dir)))


def q_bad_events(spark, sf_dir):
    return raw.bad_events(raw_messages(_events(spark, sf_dir)))


def q_encode_changelog(spark, sf_dir):
    return changelog.encode_changelog(_sessions(spark, sf_dir, fixture_settings()))


def q_session_changelog(spark, sf_dir):
    return changelog.session_changelog(_pe(spark, sf_dir), fixture_settings())


def q_exit_notifications(spark, sf_dir):
    return changelog.exit_notifications(_sessions(spark, sf_dir, fixture_settings()))


def q_location_dim(spark, sf_dir):
    return dims.location_dim(spark, settings_for(spark, sf_dir))


def q_valid_locations(spark, sf_dir):
    s = settings_for(spark, sf_dir)
    pe = parking_events(_events(spark, sf_dir), keep=("props",))
    req = pe.select(F.concat(F.lower(F.substr("location", F.lit(1), F.lit(1))),
                             F.get_json_object("props", "$.k")).alias("location_id"))
    return dims.valid_locations(req, dims.location_dim(spark, s), s)


def q_active_sessions(spark, sf_dir):
    s = fixture_settings()
    return views.active_sessions(_sessions(spark, sf_dir, s), _as_of(spark, sf_dir), s)


def q_active_by_plate(spark, sf_dir):
    s = fixture_settings()
    chg = changelog.session_changelog(_pe(spark, sf_dir), s)
    return views.active_by_plate(chg, _as_of(spark, sf_dir), s)


def q_occupancy(spark, sf_dir):
    s = fixture_settings()
    return views.occupancy(changelog.session_changelog(_pe(spark, sf_dir), s), s)


def q_busy_locations(spark, sf_dir):
    return views.busy_locations(_sessions(spark, sf_dir, fixture_settings()), ordered=True)


def q_free_locations(spark, sf_dir):
    s = settings_for(spark, sf_dir)
    return views.free_locations(dims.location_dim(spark, s), _sessions(spark, sf_dir, s),
                                ordered=True)


def q_location_info(spark, sf_dir):
    s = settings_for(spark, sf_dir)
    return views.location_info(dims.location_dim(spark, s), _sessions(spark, sf_dir, s),
                               _as_of(spark, sf_dir), s)


def q_location_info_at(spark, sf_dir):
    """What each event's spot holds an hour after the event."""
    from bayline.operators.as_of import location_info_at
    s = fixture_settings()
    pe = _pe(spark, sf_dir)
    requests = pe.select(F.col("event_id").alias("request_id"), "location", (F.col("timestamp_unix") + 3600).alias("at"))
    return location_info_at(requests, changelog.session_changelog(pe, s), s)


def q_closed_history(spark, sf_dir):
    s = fixture_settings()
    return views.closed_history(_sessions(spark, sf_dir, s), s.closed_limit, s.closed_retention)


def q_statistics(spark, sf_dir):
    s = settings_for(spark, sf_dir)
    return views.statistics(dims.location_dim(spark, s), _sessions(spark, sf_dir, s), s)


def q_transition_audit(spark, sf_dir):
    return audit.transition_audit(_pe(spark, sf_dir), fixture_settings())


def q_zone_occupancy(spark, sf_dir):
    s = settings_for(spark, sf_dir)
    return audit.zone_occupancy(dims.location_dim(spark, s), _sessions(spark, sf_dir, s), s)


def q_plate_conflicts(spark, sf_dir):
    return audit.plate_conflicts(_sessions(spark, sf_dir, fixture_settings()))


def q_spot_conflicts(spark, sf_dir):
    s = fixture_settings()
    pe = _pe(spark, sf_dir)
    as_of, hot = sessionize.event_facts(pe, s)
    return audit.spot_conflicts(sessionize.parking_sessions(pe, s, as_of, hot), s, audit.hot_spots_of_events(pe, s))


QUERIES: dict[str, Query] = {
    "parking_events": q_parking_events,
    "parking_sessions": q_parking_sessions,
    "gap_sessions": q_gap_sessions,
    "decode_events": q_decode_events,
    "bad_events": q_bad_events,
    "encode_changelog": q_encode_changelog,
    "session_changelog": q_session_changelog,
    "exit_notifications": q_exit_notifications,
    "location_dim": q_location_dim,
    "valid_locations": q_valid_locations,
    "active_sessions": q_active_sessions,
    "active_by_plate": q_active_by_plate,
    "occupancy": q_occupancy,
    "busy_locations": q_busy_locations,
    "free_locations": q_free_locations,
    "location_info": q_location_info,
    "location_info_at": q_location_info_at,
    "closed_history": q_closed_history,
    "statistics": q_statistics,
    "transition_audit": q_transition_audit,
    "zone_occupancy": q_zone_occupancy,
    "plate_conflicts": q_plate_conflicts,
    "spot_conflicts": q_spot_conflicts,
}


def _replayed(spark, sf_dir, build, output_mode="update"):
    from bayline.streaming.jobs import replay
    return spark.read.parquet(replay(spark, _pe(spark, sf_dir), build, output_mode=output_mode))


def q_stream_sessions(spark, sf_dir):
    from bayline.streaming.jobs import sessionize_stream, sessions_from_changelog
    s = fixture_settings()
    chg = _replayed(spark, sf_dir, lambda st: sessionize_stream(st, s))
    return sessions_from_changelog(
        chg, ["end_time", "duration", "cost", "status", "last_updated", "n_events"])


def q_stream_sessions_ordered(spark, sf_dir):
    from bayline.streaming.jobs import sessions_from_changelog
    from bayline.streaming.ordered import ordered_sessionize_stream
    s = fixture_settings()
    chg = _replayed(spark, sf_dir, lambda st: ordered_sessionize_stream(st, s))
    return sessions_from_changelog(
        chg, ["end_time", "duration", "cost", "status", "last_updated", "n_events"])


def q_stream_table_sessions(spark, sf_dir):
    from bayline.streaming.jobs import sessions_from_changelog
    from bayline.streaming.tables import replay_table_sessions
    s = fixture_settings()
    chg = spark.read.parquet(replay_table_sessions(spark, _pe(spark, sf_dir), s))
    return sessions_from_changelog(
        chg, ["end_time", "duration", "cost", "status", "last_updated", "n_events"])


def _table_changelog(spark, sf_dir, s):
    from bayline.streaming.tables import replay_table_sessions
    return changelog.with_change_order(
        spark.read.parquet(replay_table_sessions(spark, _pe(spark, sf_dir), s)), s)


def q_stream_active_by_plate(spark, sf_dir):
    """The last-value view per plate, read from the live changelog."""
    s = fixture_settings()
    return views.active_by_plate(_table_changelog(spark, sf_dir, s), _as_of(spark, sf_dir), s)


def q_stream_occupancy(spark, sf_dir):
    """The last-value view per spot, read from the live changelog."""
    s = fixture_settings()
    return views.occupancy(_table_changelog(spark, sf_dir, s), s)


def q_stream_unordered(spark, sf_dir):
    """Rows arriving up to an hour late and out of order, with a delay that
    allows for it: the sessions of the table in time order."""
    from bayline.streaming.jobs import sessions_from_changelog
    from bayline.streaming.tables import replay_table_sessions
    s = fixture_settings(watermark_delay="1 hours")
    arrival = F.col("timestamp_unix") + F.pmod(F.xxhash64("event_id"), F.lit(3600))
    chg = spark.read.parquet(replay_table_sessions(spark, _pe(spark, sf_dir), s, arrival=arrival))
    return sessions_from_changelog(
        chg, ["end_time", "duration", "cost", "status", "last_updated", "n_events"])


# Fixed values of the disordered replay: rows come up to two days late, six
# hours are waited for.
DISORDER_SECONDS, DISORDER_STEP, DISORDER_DELAY, DISORDER_SLICES = 172800, 7919, "6 hours", 3


def _disordered_messages(spark, sf_dir) -> list[DataFrame]:
    """The table as raw messages, some damaged, in slices by an arrival time
    that lags the event's by a part of two days."""
    ev = _events(spark, sf_dir)
    arrival = epoch_seconds_ntz(F.col("ts")) + F.pmod(F.col("event_id") * DISORDER_STEP, F.lit(DISORDER_SECONDS))
    lo, hi = ev.agg(F.min(arrival), F.max(arrival)).first()
    width = ((hi or 0) - (lo or 0)) // DISORDER_SLICES + 1
    piece = F.floor((arrival - F.lit(lo or 0)) / F.lit(width))
    return [raw_messages(ev.where(piece == k)) for k in range(DISORDER_SLICES)]


def q_stream_late_events(spark, sf_dir):
    """Every message of a disordered replay accounted for, by each streaming
    form: late rows and bad messages one by one, accepted rows by their number
    (``event_id`` null). ``n`` adds up to the table's rows in each form."""
    from bayline.plans.runtime import scratch_path
    from bayline.streaming import jobs, state_views, tables
    from bayline.streaming.ordered import ordered_sessionize_stream
    s = fixture_settings(watermark_delay=DISORDER_DELAY)
    slices = _disordered_messages(spark, sf_dir)
    forms = {}
    for name, build in (("keyed", jobs.sessionize_stream), ("ordered", ordered_sessionize_stream)):
        base, ordered = scratch_path(spark, f"late-{name}"), name == "ordered"
        chg = jobs.replay_slices(spark, slices, lambda st, build=build: jobs.with_bad_messages(
            build(raw.decode_events(st), s), st), base=base)
        ckpt = f"{base}/checkpoint"
        accepted = state_views.accepted_events(
            spark.read.parquet(chg), state_views.open_sessions(spark, ckpt, ordered),
            state_views.waiting_rows(spark, ckpt) if ordered else None)
        forms[name] = accepted, spark.read.parquet(f"{chg}-late"), spark.read.parquet(f"{chg}-bad")
    base = scratch_path(spark, "late-table")
    tables.replay_table_slices(spark, slices, s, base, raw=True)
    chg, clock = spark.read.parquet(f"{base}/changelog"), spark.read.parquet(f"{base}/clock")
    open_now = spark.read.parquet(f"{base}/open").where(F.col("epoch_id") == clock.agg(F.max("epoch_id")).scalar())
    forms["table"] = (state_views.accepted_events(chg, open_now), spark.read.parquet(f"{base}/late"),
                      spark.read.parquet(f"{base}/bad"))
    out = None
    for name, (accepted, late, bad) in forms.items():
        one = F.lit(1).cast("long")
        rows = (accepted.select(F.lit("accepted").alias("outcome"), F.lit(None).cast("long").alias("event_id"),
                                F.lit(None).cast("string").alias("detail"), F.col("n").cast("long").alias("n"))
                .unionByName(late.select(F.lit("late").alias("outcome"), "event_id", F.col("status_code").alias("detail"), one.alias("n")))
                .unionByName(bad.select(F.lit("bad").alias("outcome"), "event_id", F.col("reason").alias("detail"), one.alias("n")))
                .select(F.lit(name).alias("form"), "*"))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_stream_sessions_salted(spark, sf_dir):
    """The keyed fold with rows folded to runs before the state."""
    from bayline.streaming.jobs import sessions_from_changelog
    from bayline.streaming.salted import salted_sessionize_stream
    s = fixture_settings(bucket_seconds=86_400)
    chg = _replayed(spark, sf_dir, lambda st: salted_sessionize_stream(st, s))
    return sessions_from_changelog(
        chg, ["end_time", "duration", "cost", "status", "last_updated", "n_events"])


def q_state_active_sessions(spark, sf_dir):
    """The live view of open sessions, read from a replay's keyed state."""
    from bayline.streaming import state_views
    s = fixture_settings(bucket_seconds=86_400)
    base = _salted_replay(spark, sf_dir, s, 2)
    return state_views.active_sessions_from_state(spark, f"{base}/checkpoint", _as_of(spark, sf_dir), s)


def _salted_replay(spark, sf_dir, s, n_slices, *sinks) -> str:
    """The events replayed through the salted fold into ``sinks``; the base folder."""
    from bayline.plans.runtime import scratch_path
    from bayline.streaming.jobs import replay
    from bayline.streaming.salted import salted_sessionize_stream
    base = scratch_path(spark, "salted")
    replay(spark, _pe(spark, sf_dir), lambda st: salted_sessionize_stream(st, s), n_slices=n_slices, base=base,
           extra_sinks=sinks)
    return base


def q_stream_live_gap_sessions(spark, sf_dir):
    """Sessions split by silence from the live stream, open ones included."""
    from bayline.streaming.jobs import live_gap_sessions_stream, sessions_from_changelog
    s = fixture_settings(bucket_seconds=86_400)
    chg = _replayed(spark, sf_dir, lambda st: live_gap_sessions_stream(st, s))
    return sessions_from_changelog(
        chg, ["end_time", "duration", "cost", "status", "last_updated", "n_events"])


def q_stream_live_views(spark, sf_dir):
    """The view store after a replay of four slices, merged every second batch:
    open sessions, the latest closed ones up to a retention below their number,
    and how many closed (``n_events``)."""
    from bayline.plans.runtime import scratch_path
    from bayline.streaming.live_views import latest_views_state, live_views_sink
    s = fixture_settings(bucket_seconds=86_400, closed_retention=50)
    store = scratch_path(spark, "views")
    _salted_replay(spark, sf_dir, s, 4, live_views_sink(store, s, merge_every=2))
    open_now, closed_now, total = latest_views_state(spark, store, s.closed_retention)
    cols = ["license_plate", "location", "start_time", "end_time", "duration", "cost", "status", "n_events"]
    count = spark.range(1).select(F.lit("closed_total").alias("view"), *[
        F.lit(total if c == "n_events" else None).cast(closed_now.schema[c].dataType).alias(c) for c in cols])
    return (open_now.select(F.lit("active").alias("view"), *cols)
            .unionByName(closed_now.select(F.lit("closed").alias("view"), *cols)).unionByName(count))


def q_stream_compacted_changelog(spark, sf_dir):
    """Sessions folded from a changelog whose epochs have been merged."""
    from bayline.plans.runtime import scratch_path
    from bayline.streaming.compaction import compacted_sink, read_compacted
    from bayline.streaming.jobs import sessions_from_changelog
    table = scratch_path(spark, "compacted")
    _salted_replay(spark, sf_dir, fixture_settings(bucket_seconds=86_400), 4, compacted_sink(table, fan_in=2))
    return sessions_from_changelog(
        read_compacted(spark, table), ["end_time", "duration", "cost", "status", "last_updated", "n_events"])


def q_stream_fan_out(spark, sf_dir):
    """One replay into two sinks under the ledger, the changelog table and its
    wire form: the sessions that a reader of each gets."""
    from bayline.plans.runtime import scratch_path
    from bayline.sources.sinks import wire_table_sink
    from bayline.streaming.jobs import epoch_table_sink, sessions_from_changelog
    from bayline.streaming.ledger import ledgered
    base = scratch_path(spark, "fan-out")
    _salted_replay(spark, sf_dir, fixture_settings(bucket_seconds=86_400), 3, ledgered(
        f"{base}/ledger", table=epoch_table_sink(f"{base}/table"), wire=wire_table_sink(f"{base}/wire")))
    fields = ["end_time", "duration", "cost", "status", "last_updated"]
    wire = spark.read.parquet(f"{base}/wire")
    sent = raw.decode_changelog(wire.select("value", F.col("epoch_id").cast("long").alias("offset")))
    return (sessions_from_changelog(spark.read.parquet(f"{base}/table"), fields).select(F.lit("table").alias("sink"), "*")
            .unionByName(sessions_from_changelog(sent, fields).select(F.lit("wire").alias("sink"), "*")))


# Fixed value of the conflict replay: how long a session may take, in all, for
# the join's state (12 days; longer ones are joined when read).
CONFLICT_HORIZON = 1036800


def q_stream_spot_conflicts(spark, sf_dir):
    """Spot conflicts found as sessions end, by a stream-stream interval join
    over a replay, with those of long and of open sessions."""
    from bayline.streaming import conflicts, state_views
    from bayline.plans.runtime import scratch_path
    s = fixture_settings(bucket_seconds=86_400)
    base = scratch_path(spark, "conflicts")
    table, pairs = f"{base}/ended", f"{base}/pairs"
    live = _salted_replay(spark, sf_dir, s, 4, conflicts.ended_sink(table, CONFLICT_HORIZON))
    q = conflicts.start_conflicts(spark, table, s, CONFLICT_HORIZON, pairs, f"{base}/checkpoint",
                                  max_files=20, available_now=True)
    q.awaitTermination()
    return conflicts.conflicts(spark, table, pairs, state_views.open_sessions(spark, f"{live}/checkpoint"), s)


def q_changelog_round_trip(spark, sf_dir):
    """Session rows sent over the wire and decoded again."""
    sent = changelog.encode_changelog(_sessions(spark, sf_dir, fixture_settings()))
    return raw.decode_changelog(sent).drop("offset")


def q_stream_changelog(spark, sf_dir):
    """Every change the keyed-state stream emitted over a replay in four time
    slices (the ``epoch_id`` column is left out: which trigger carries a
    timeout depends on when the engine runs a no-data batch)."""
    from bayline.streaming.jobs import sessionize_stream
    s = fixture_settings()
    return _replayed(spark, sf_dir, lambda st: sessionize_stream(st, s)).drop("epoch_id")


def q_stream_gap_sessions(spark, sf_dir):
    from bayline.streaming.jobs import gap_sessions_stream, sessions_from_changelog
    s = fixture_settings()
    chg = _replayed(spark, sf_dir, lambda st: gap_sessions_stream(st, s), output_mode="append")
    return sessions_from_changelog(chg, ["end_time", "duration", "cost", "n_events"])


QUERIES.update({
    "stream_sessions": q_stream_sessions,
    "stream_sessions_ordered": q_stream_sessions_ordered,
    "stream_table_sessions": q_stream_table_sessions,
    "stream_active_by_plate": q_stream_active_by_plate,
    "stream_occupancy": q_stream_occupancy,
    "stream_unordered": q_stream_unordered,
    "changelog_round_trip": q_changelog_round_trip,
    "stream_changelog": q_stream_changelog,
    "stream_gap_sessions": q_stream_gap_sessions,
    "stream_late_events": q_stream_late_events,
    "stream_sessions_salted": q_stream_sessions_salted,
    "state_active_sessions": q_state_active_sessions,
    "stream_live_gap_sessions": q_stream_live_gap_sessions,
    "stream_live_views": q_stream_live_views,
    "stream_compacted_changelog": q_stream_compacted_changelog,
    "stream_fan_out": q_stream_fan_out,
    "stream_spot_conflicts": q_stream_spot_conflicts,
})
