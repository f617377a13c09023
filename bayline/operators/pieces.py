"""Cutting an ordered scan into bounded pieces.

Several operators need, per key, a scan in time order (previous row, running
count). A window over the whole key puts all of a key's rows into one task:
fine for a key of at most about ``max_piece_rows`` rows, which is scanned
whole in one sorted pass (:func:`split_hot_keys`). The rows of a hot key are
cut into pieces ``(key, bucket, sub)``: ``bucket`` is a time bucket of
``bucket_seconds``; a bucket holding more than ``max_piece_rows`` rows (a hot
key in a busy hour, or even in one second) is cut again. Pieces of one key are
ordered by ``(bucket, sub)``.

``sub`` is a function of the row alone: a row is a boundary when a hash of its
key and order columns says so (one row in ``max_piece_rows / 2`` on average),
and a row's ``sub`` is the number of its bucket's boundaries at or before it,
found by binary search. Any two evaluations of a plan cut alike, whatever
exchanges they share, so summaries and rows always meet. Rows equal in all
order columns stay together.

Finding hot keys and hot buckets is a seeded Bernoulli sample of about 4000 rows per
``max_piece_rows`` rows, aggregated per group (exact when the limit is
small). A group is hot when its sampled count reaches half of its expected
share, so a group over the limit is found with near certainty, and a group
left whole holds at most about the limit. Only the hot groups' ids come back
to the driver: at most ``2 * rows / max_piece_rows`` of them. They are looked
up once while a query is built, and may be given instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayline.params import Settings

PIECE = ["bucket", "sub"]
SAMPLE_ROWS_PER_LIMIT = 4000
BOUNDARIES_PER_LIMIT = 2


def _heavy_groups(df: DataFrame, cols: list[str], limit: int) -> list[tuple]:
    """``(col values..., estimated_rows)`` of groups of ``cols`` holding more
    than ``limit`` rows, from a seeded sample."""
    frac = min(1.0, SAMPLE_ROWS_PER_LIMIT / limit)
    src = df if frac >= 1.0 else df.sample(fraction=frac, seed=17)
    need = limit + 1 if frac >= 1.0 else max(1, int(limit * frac / 2))
    counts = (src.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= F.lit(need)))
    return [(*r[:-1], int(r[-1] / frac)) for r in counts.collect()]


def _ids_frame(df: DataFrame, cols: list[str], groups: list[tuple], s: Settings) -> DataFrame:
    ids = df.sparkSession.createDataFrame([g[:-1] for g in groups], df.select(*cols).schema)
    # the list was bounded above (at most 2 * rows / limit entries); checked
    return F.broadcast(ids) if len(groups) <= s.broadcast_max_rows else ids


def scan_facts(df: DataFrame, keys: list[str], time_col: str, s: Settings) -> tuple[int | None, list[tuple]]:
    """``(latest time, hot keys)`` in one pass over ``df``: rows outside the
    sample share one group, so only sampled keys are shuffled. Both may be given
    to the operators, which then start no job while a query is built."""
    limit = s.max_piece_rows or 1
    frac = min(1.0, SAMPLE_ROWS_PER_LIMIT / limit)
    need = limit + 1 if frac >= 1.0 else max(1, int(limit * frac / 2))
    picked = F.rand(seed=17) < F.lit(frac)
    rows = df.select(F.col(time_col).alias("t"), picked.alias("picked"), F.struct(*keys).alias("k"))
    groups = rows.groupBy("picked", F.when(F.col("picked"), F.col("k")).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.max("t").alias("t"))
    hot = F.col("picked") & (F.col("n") >= F.lit(need))
    r = groups.agg(F.max("t"), F.collect_list(F.when(hot, F.struct("k", "n")))).first()
    found = [(*x.k, int(x.n / frac)) for x in r[1]] if s.max_piece_rows else []
    return r[0], [k[:-1] for k in found]


def hot_key_ids(df: DataFrame, keys: list[str], s: Settings,
                given: list[tuple] | None = None) -> DataFrame | None:
    """Ids of keys holding more than about ``max_piece_rows`` rows, or None;
    ``given`` (from :func:`scan_facts`) saves the look-up."""
    limit = s.max_piece_rows
    if given is not None:
        return _ids_frame(df, keys, [(*k, 0) for k in given], s) if given else None
    hot = _heavy_groups(df, keys, limit) if limit else []
    return _ids_frame(df, keys, hot, s) if hot else None


def split_hot_keys(df: DataFrame, keys: list[str], s: Settings,
                   ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """``(rows of keys with at most about max_piece_rows rows, rows of hot
    keys or None)``. A key under the limit is scanned whole in one task; a hot
    key is cut into pieces by :func:`with_pieces`. ``ids`` may be given (from
    :func:`hot_key_ids`) to split several frames the same way."""
    if ids is None:
        ids = hot_key_ids(df, keys, s)
    if ids is None:
        return df, None
    return df.join(ids, keys, "left_anti"), df.join(ids, keys, "left_semi")


def with_pieces(df: DataFrame, keys: list[str], time_col: str, order_cols: list[str],
                s: Settings) -> DataFrame:
    """``df`` with ``bucket`` and ``sub`` columns (see the module doc)."""
    df = df.withColumn("bucket", F.floor(F.col(time_col) / F.lit(s.bucket_seconds)).cast("long"))
    # stated here so both uses of a scan stay one plan (shuffle reuse)
    df = df.where(F.col("bucket").isNotNull())
    limit = s.max_piece_rows
    hot = _heavy_groups(df, [*keys, "bucket"], limit) if limit else []
    if not hot:
        return df.withColumn("sub", F.lit(0).cast("int"))
    on = [*keys, "bucket"]
    hot_ids = _ids_frame(df, on, hot, s)
    cold = df.join(hot_ids, on, "left_anti").withColumn("sub", F.lit(0).cast("int"))
    rows = df.join(hot_ids, on, "left_semi")
    place = F.struct(*order_cols)
    every = max(1, limit // BOUNDARIES_PER_LIMIT)
    bounds = (rows.where(F.pmod(F.xxhash64(*keys, *order_cols), F.lit(every)) == 0)
              .groupBy(*on).agg(F.array_sort(F.collect_set(place)).alias("bounds")))
    if sum(h[-1] for h in hot) / every <= s.broadcast_max_rows:
        # about one boundary for every max_piece_rows / 2 hot rows, checked
        bounds = F.broadcast(bounds)
    split = rows.join(bounds, on, "left").withColumn("sub", _at_or_before("bounds", place)).drop("bounds")
    return cold.unionByName(split)


def _at_or_before(bounds: str, place: Column) -> Column:
    """Number of entries of the sorted array ``bounds`` at or before ``place``,
    by binary search; 0 for a null array."""
    b = F.coalesce(F.size(F.col(bounds)), F.lit(0))
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(b, F.lit(0)) + F.lit(1))).cast("int"))
    mid = lambda r: F.floor((r["lo"] + r["hi"]) / 2).cast("int")
    low = lambda r: F.element_at(F.col(bounds), mid(r) + F.lit(1)) <= place
    return F.aggregate(
        steps, F.struct(F.lit(0).alias("lo"), F.greatest(b, F.lit(0)).alias("hi")),
        lambda r, _: F.when(r["lo"] < r["hi"], F.struct(
            F.when(low(r), mid(r) + F.lit(1)).otherwise(r["lo"]).alias("lo"),
            F.when(low(r), r["hi"]).otherwise(mid(r)).alias("hi"))).otherwise(r),
        lambda r: r["lo"])
