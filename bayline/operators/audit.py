"""Data-quality audits: lifecycle, zones, spot and plate conflicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bayline.operators.pieces import PIECE, hot_key_ids, scan_facts, split_hot_keys, with_pieces
from bayline.operators.sessionize import KEY, T_COL, valid_events, with_previous
from bayline.operators.views import busy_locations
from bayline.params import ACTIVE, ALLOWED_TRANSITIONS, ENTERING, Settings


RANK_BLOCK = 4096


def _allowed(prev: F.Column, cur: F.Column, has_prev: F.Column) -> F.Column:
    pair_ok = F.lit(False)
    for a, b in ALLOWED_TRANSITIONS:
        pair_ok = pair_ok | ((prev == F.lit(a)) & (cur == F.lit(b)))
    first_ok = cur == F.lit(ENTERING)
    return F.coalesce(F.when(has_prev, pair_ok).otherwise(first_ok), F.lit(False))


def transition_audit(events: DataFrame, s: Settings) -> DataFrame:
    """Consecutive statuses of one key outside the camera lifecycle, counted
    per pair. ``at_start`` marks a key's first event (allowed only if it is
    ENTERING); unknown and null statuses are always reported."""
    p = with_previous(events, s)
    bad = p.where(~_allowed(F.col("prev_status"), F.col("status_code"), F.col("has_prev")))
    return bad.groupBy(
        (~F.col("has_prev")).alias("at_start"),
        F.col("prev_status").alias("from_status"),
        F.col("status_code").alias("to_status"),
    ).agg(
        F.count(F.lit(1)).cast("long").alias("n_transitions"),
        F.count_distinct(*KEY).cast("long").alias("n_keys"),
    )


def zone_occupancy(dim: DataFrame, sessions: DataFrame, s: Settings) -> DataFrame:
    """Per zone: spots, busy spots, free spots."""
    busy = busy_locations(sessions).withColumn("busy", F.lit(1))
    d = dim.select("location", "zone").join(busy, "location", "left")
    return d.groupBy("zone").agg(
        F.count(F.lit(1)).cast("long").alias("n_locations"),
        F.sum(F.coalesce(F.col("busy"), F.lit(0))).cast("long").alias("busy_count"),
        F.sum(F.when(F.col("busy").isNull(), 1).otherwise(0)).cast("long").alias("free_count"),
    )


def plate_conflicts(sessions: DataFrame) -> DataFrame:
    """Cars with open sessions on more than one spot."""
    return (sessions.where(F.col("status") == ACTIVE)
            .groupBy("license_plate")
            .agg(F.count_distinct("location").cast("long").alias("n_locations"),
                 F.min("location").alias("first_location"),
                 F.max("location").alias("last_location"))
            .where(F.col("n_locations") > 1))


def spot_conflicts(sessions: DataFrame, s: Settings, hot_spots: list[tuple] | None = None) -> DataFrame:
    """Pairs of sessions of different cars on one spot whose closed intervals
    ``[start_time, end_time]`` overlap; one row per pair, ``a`` being the
    earlier one in ``(start_time, license_plate, session_no)`` order.

    No pair is formed that doesn't overlap (pairs of one car with itself are
    then left out). Sessions of a spot are
    ranked in that order; a session ``a`` overlaps exactly the later sessions
    whose start lies in ``[a.start, a.end]``, i.e. ranks ``rank(a)+1 ..
    R(a)`` with ``R(a)`` = number of the spot's sessions starting at or
    before ``a.end``. Ranks and ``R`` come from one window per spot; a busy
    spot (over ``max_piece_rows`` points) is scanned in bounded pieces
    instead, piece totals carried forward (:mod:`bayline.operators.pieces`),
    so it is not one task. The rank range is exploded and joined to the ranked
    sessions on ``(spot, rank)``, a key with one row per value.

    ``hot_spots`` names the busy spots (:func:`hot_spots_of_events`); without it
    they are looked up over the sessions, which computes these once more.
    """
    sess = sessions.select("location", "license_plate", "session_no", "start_time", "end_time")
    # start points (kind 0) and end queries (kind 1) on one time line per spot,
    # both from the one row of a session, so the sessions are computed once;
    # both carry the session, so no join back to the sessions is needed
    point = lambda t, kind: F.struct(F.col(t).alias("t"), F.lit(kind).alias("kind"))
    pts = sess.select("*", F.inline(F.array(point("start_time", 0), point("end_time", 1))))
    order = ["t", "kind", "license_plate", "session_no"]
    starts = F.sum(F.when(F.col("kind") == 0, 1).otherwise(0))
    if s.max_piece_rows:
        ids = hot_key_ids(pts, ["location"], s, hot_spots)
        whole, hot = (pts, None) if ids is None else split_hot_keys(pts, ["location"], s, ids)
    else:
        whole, hot = None, pts
    parts = []
    if whole is not None:
        # a spot of at most about max_piece_rows points: one window, no carry
        w = (Window.partitionBy("location").orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        parts.append(whole.withColumn("n", starts.over(w).cast("long")))
    if hot is not None:
        parts.append(_ranks_in_pieces(hot, order, s))
    ranked_pts = parts[0] if len(parts) == 1 else parts[0].unionByName(
        parts[1].select(*parts[0].columns))
    ranked = ranked_pts.groupBy("location", "license_plate", "session_no").agg(
        F.first("start_time").alias("start_time"), F.first("end_time").alias("end_time"),
        F.max(F.when(F.col("kind") == 0, F.col("n"))).alias("rank"),
        F.max(F.when(F.col("kind") == 1, F.col("n"))).alias("reach"))
    # the range in blocks, so that no array is longer than a block or the
    # number of blocks
    a = ranked.where(F.col("reach") > F.col("rank")).select(
        "location",
        F.col("license_plate").alias("plate_a"), F.col("start_time").alias("start_a"),
        F.col("end_time").alias("end_a"), "reach",
        F.explode(F.sequence(F.col("rank") + 1, F.col("reach"), F.lit(RANK_BLOCK).cast("long"))).alias("from_rank"))
    a = a.select(
        "location", "plate_a", "start_a", "end_a",
        F.explode(F.sequence("from_rank", F.least(F.col("from_rank") + F.lit(RANK_BLOCK - 1), F.col("reach")))).alias("rank"))
    # every session reaches at least its own rank, so this filter keeps all
    # rows; it makes both sides read the same aggregate (one shared exchange)
    b = ranked.where(F.col("reach") >= F.col("rank")).select(
        "location", "rank",
        F.col("license_plate").alias("plate_b"), F.col("start_time").alias("start_b"),
        F.col("end_time").alias("end_b"))
    pairs = a.join(b, ["location", "rank"]).where(F.col("plate_a") != F.col("plate_b"))
    return pairs.select(
        "location", "plate_a", "start_a", "end_a", "plate_b", "start_b", "end_b",
        F.col("start_b").alias("overlap_start"),
        F.least("end_a", "end_b").alias("overlap_end"))


def hot_spots_of_events(events: DataFrame, s: Settings) -> list[tuple]:
    """Spots that may have more than ``max_piece_rows`` points, from a sampled
    count of their events: a session has two points and an event at least."""
    if not s.max_piece_rows:
        return []
    half = s.with_(max_piece_rows=max(1, s.max_piece_rows // 2))
    return scan_facts(valid_events(events), ["location"], T_COL, half)[1]


def _ranks_in_pieces(pts: DataFrame, order: list[str], s: Settings) -> DataFrame:
    """Running number of starts per spot for busy spots: counted inside
    bounded pieces, piece totals carried forward."""
    pts = with_pieces(pts, ["location"], "t", order, s)
    w_in = (Window.partitionBy("location", *PIECE).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pts = pts.withColumn("starts_so_far",
                         F.sum(F.when(F.col("kind") == 0, 1).otherwise(0)).over(w_in))
    last_in_piece = F.lead("t").over(Window.partitionBy("location", *PIECE).orderBy(*order))
    pts = pts.withColumn("piece_last", last_in_piece.isNull())
    # a piece's last row holds its number of starts (a filter, no aggregation)
    per_piece = pts.where(F.col("piece_last")).select(
        "location", *PIECE, F.col("starts_so_far").alias("n_starts"))
    w_b = (Window.partitionBy("location").orderBy(*PIECE)
           .rowsBetween(Window.unboundedPreceding, -1))
    per_piece = per_piece.select(
        "location", *PIECE,
        F.coalesce(F.sum("n_starts").over(w_b), F.lit(0)).alias("starts_before"))
    return pts.join(per_piece, ["location", *PIECE]).select(
        "location", "license_plate", "session_no", "start_time", "end_time", "t", "kind",
        (F.col("starts_before") + F.col("starts_so_far")).cast("long").alias("n"))
