"""View store of a live job: a log of changes, merged into snapshots.

:func:`bayline.streaming.jobs.upsert_views` recomputes views from the whole
changelog, which grows without end. This store keeps what the reads need, below
``base``:

* ``delta/epoch_id=<n>``: the session changes of one batch, as they came;
* ``open/epoch_id=<n>`` and ``closed/epoch_id=<n>``: a snapshot, the open
  sessions and the ``closed_retention`` latest closed ones as of batch ``n``;
* ``manifest/epoch_id=<n>``: which snapshot and which deltas after it make up
  the views, and how many sessions have closed.

A batch costs one write of its own rows; only every ``merge_every`` batches the
deltas are merged into a new snapshot (open sessions plus some batches, never
the history). Readers merge the few deltas on read. Folders that are no longer
named go away (:mod:`bayline.streaming.epochs`), so their number is bounded
however long the job runs. The log is safe to retry: a batch overwrites its
delta, its snapshot and its manifest, and starts from the manifest before it.

Views are then the usual functions over these small tables, e.g.
``views.active_sessions(open, as_of, s)``, ``views.busy_locations(open)``,
``views.closed_history(closed, 50)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.operators.changelog import SESSION_FIELDS
from bayline.params import ACTIVE, CLOSED, Settings
from bayline.streaming.epochs import drop_epochs, epoch_path, manifests, read_epochs, write_manifest
from bayline.streaming.fold import OUTPUT

IDENT = ["license_plate", "location", "start_time", "start_event_id"]
ROW_FIELDS = [*SESSION_FIELDS, "n_events", "start_event_id"]
EMPTY = {"snapshot": None, "deltas": [], "closed_total": 0}


def merge_changes(open_prev: DataFrame, closed_prev: DataFrame, changes: DataFrame,
                  retention: int) -> tuple[DataFrame, DataFrame]:
    """``(open_now, closed_now)`` from a snapshot and later changes with their
    ``epoch_id`` (one row per session and epoch): a session's newest change
    replaces its older ones, one that ended leaves the open sessions, and of the
    closed ones the ``retention`` latest stay (top-k in each task, then of
    those: no full sort)."""
    merged = (open_prev.select(*ROW_FIELDS, F.lit(-1).cast("long").alias("epoch_id"))
              .unionByName(changes.select(*ROW_FIELDS, F.col("epoch_id").cast("long").alias("epoch_id"))))
    rest = [c for c in ROW_FIELDS if c not in IDENT]
    latest = merged.groupBy(*IDENT).agg(F.max(F.struct("epoch_id", *rest)).alias("l"))
    open_now = latest.select(*IDENT, *[F.col(f"l.{c}").alias(c) for c in rest]).where(F.col("status") == ACTIVE).select(*ROW_FIELDS)
    closed_now = (closed_prev.select(*ROW_FIELDS).unionByName(changes.where(F.col("status") == CLOSED).select(*ROW_FIELDS))
                  .orderBy(F.col("end_time").desc(), "license_plate", "location", "start_time").limit(retention))
    return open_now, closed_now


def _views_of(spark: SparkSession, base: str, state: dict, retention: int) -> tuple[DataFrame, DataFrame]:
    schema = OUTPUT.simpleString()[len("struct<"):-1].replace(":", " ")
    none = spark.createDataFrame([], schema)
    old = [none, none] if state["snapshot"] is None else [
        spark.read.schema(schema).parquet(epoch_path(base, t, state["snapshot"])) for t in ("open", "closed")]
    deltas = read_epochs(spark, base, "delta", state["deltas"], f"{schema},epoch_id bigint")
    if deltas is None:
        return old[0].select(*ROW_FIELDS), old[1].select(*ROW_FIELDS)
    return merge_changes(*old, deltas, retention)


def live_views_sink(base: str, s: Settings, merge_every: int = 8, keep: int = 3):
    """``foreachBatch`` function keeping the view store (see the module doc);
    feed it the session changes of
    :func:`bayline.streaming.jobs.sessionize_stream` (e.g. as an extra sink)."""
    base = base.rstrip("/")
    if merge_every < 1 or keep < 1:
        raise ValueError("merge_every and keep must be 1 or more")

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        known = manifests(spark, base)
        before = max((e for e in known if e < epoch_id), default=None)
        state = dict(EMPTY if before is None else known[before])
        batch.select(*OUTPUT.names).write.mode("overwrite").parquet(epoch_path(base, "delta", epoch_id))
        # counted from what was written: the batch is computed once
        delta = spark.read.schema(OUTPUT).parquet(epoch_path(base, "delta", epoch_id))
        state["closed_total"] += delta.where(F.col("status") == CLOSED).count()
        state["deltas"] = [*state["deltas"], epoch_id]
        if len(state["deltas"]) >= merge_every:
            for name, rows in zip(("open", "closed"), _views_of(spark, base, state, s.closed_retention)):
                rows.write.mode("overwrite").parquet(epoch_path(base, name, epoch_id))
            state["snapshot"], state["deltas"] = epoch_id, []
        write_manifest(spark, base, epoch_id, state)
        kept = {e: m for e, m in known.items() if epoch_id - keep < e < epoch_id} | {epoch_id: state}
        named = {m["snapshot"] for m in kept.values()}
        deltas = {d for m in kept.values() for d in m["deltas"]}
        drop_epochs(spark, f"{base}/manifest", lambda e: e < epoch_id and e not in kept)
        for name, wanted in (("delta", deltas), ("open", named), ("closed", named)):
            drop_epochs(spark, f"{base}/{name}", lambda e, w=wanted: e <= epoch_id and e not in w)
    return write


def latest_views_state(spark: SparkSession, base: str, retention: int = Settings.closed_retention) -> tuple[DataFrame, DataFrame, int]:
    """``(open, closed, closed_total)`` of the newest manifest."""
    base = base.rstrip("/")
    known = manifests(spark, base)
    state = known[max(known)]
    return (*_views_of(spark, base, state, retention), state["closed_total"])


__all__ = ["live_views_sink", "latest_views_state", "merge_changes"]
