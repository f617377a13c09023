"""What a spot held at a time: requests joined to the changelog as of their time.

Requests and changes are one scan per spot, ordered by time (at one time,
changes first, in the order they happen); each request takes the last change at
or before it. No request meets more than one change, so there is no join on
time and nothing grows with the product of the two.

A spot with up to about ``max_piece_rows`` rows is scanned whole. A busier one
is cut into pieces (:mod:`bayline.operators.pieces`): the last change inside the
piece where there is one, else the last change of the spot's earlier pieces,
carried over their summaries (one row a piece).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bayline.functions.pricing import block_cost, live_duration
from bayline.operators.pieces import PIECE, split_hot_keys, with_pieces
from bayline.params import ACTIVE, CLOSED, TIMEOUT, Settings

SPOT = ["location"]
ORDER = ["t", "is_request", "o_kind", "o_id", "license_plate", "o_status", "request_id"]


def _scan_rows(requests: DataFrame, changelog: DataFrame, s: Settings) -> DataFrame:
    ends = [ACTIVE, CLOSED, TIMEOUT] if s.timeout_is_terminal else [ACTIVE, CLOSED]
    no_long, no_text = F.lit(None).cast("long"), F.lit(None).cast("string")
    # the bounds of an order by structs need comparable values: no nulls in it
    chg = changelog.where(F.col("status").isin(ends) & F.col("location").isNotNull() & F.col("change_time").isNotNull()).select(
        "location", F.col("change_time").cast("long").alias("t"), F.lit(0).alias("is_request"),
        F.col("change_kind").cast("long").alias("o_kind"), F.coalesce("event_id", F.lit(0)).cast("long").alias("o_id"),
        F.coalesce("license_plate", F.lit("")).alias("license_plate"), F.col("status").alias("o_status"),
        F.lit(0).cast("long").alias("request_id"),
        F.struct("status", "license_plate", "start_time").alias("held"), no_long.alias("asked"))
    req = requests.where(F.col("location").isNotNull() & F.col("at").isNotNull()).select(
        "location", F.col("at").cast("long").alias("t"), F.lit(1).alias("is_request"), F.lit(0).cast("long").alias("o_kind"),
        F.lit(0).cast("long").alias("o_id"), F.lit("").alias("license_plate"), F.lit("").alias("o_status"),
        F.coalesce(F.col("request_id").cast("long"), F.lit(0)).alias("request_id"),
        F.struct(no_text.alias("status"), no_text.alias("license_plate"), no_long.alias("start_time")).alias("held"),
        F.col("request_id").cast("long").alias("asked"))
    rows = chg.unionByName(req)
    return rows.withColumn("held", F.when(F.col("is_request") == 0, F.col("held")))


def _last(w: Window) -> Column:
    return F.last("held", ignorenulls=True).over(w)


def _whole(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy(*SPOT).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("seen", _last(w)).where(F.col("is_request") == 1)


def _in_pieces(rows: DataFrame, s: Settings) -> DataFrame:
    rows = with_pieces(rows, SPOT, "t", ORDER, s)
    inside = Window.partitionBy(*SPOT, *PIECE).orderBy(*ORDER)
    inner = rows.select("*", _last(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("own"),
                        F.lead("t").over(inside).isNull().alias("piece_last"))
    # a piece's last row is its summary (a filter, no aggregation)
    before = Window.partitionBy(*SPOT).orderBy(*PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carried = inner.where("piece_last").select(
        *SPOT, *PIECE, F.last("own", ignorenulls=True).over(before).alias("carried"))
    return (inner.where(F.col("is_request") == 1).join(carried, [*SPOT, *PIECE], "left")
            .withColumn("seen", F.coalesce("own", "carried")))


def location_info_at(requests: DataFrame, changelog: DataFrame, s: Settings) -> DataFrame:
    """Each request (``request_id``, ``location``, ``at``) answered as of its
    time: OCCUPIED with plate, start, duration and cost where the spot's last
    change is ACTIVE, else FREE. ``changelog`` has the columns of
    :func:`bayline.operators.changelog.session_changelog`. A spot without any
    change is FREE, a request without spot or time gives no row, repeated
    requests are answered each."""
    rows = _scan_rows(requests, changelog, s)
    if s.max_piece_rows:
        whole, hot = split_hot_keys(rows, SPOT, s)
        cols = ["asked", "location", "t", "seen"]
        seen = _whole(whole).select(*cols)
        if hot is not None:
            seen = seen.unionByName(_in_pieces(hot, s).select(*cols))
    else:
        seen = _in_pieces(rows, s)
    taken = F.coalesce(F.col("seen.status") == ACTIVE, F.lit(False))
    start = F.when(taken, F.col("seen.start_time"))
    d = live_duration(start, F.col("t"))
    return seen.select(
        F.col("asked").alias("request_id"), "location", F.col("t").alias("at"),
        F.when(taken, F.lit("OCCUPIED")).otherwise(F.lit("FREE")).alias("status"),
        F.when(taken, F.col("seen.license_plate")).alias("license_plate"), start.alias("start_time"),
        d.alias("duration"), block_cost(d, s).alias("cost"))
