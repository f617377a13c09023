"""Changelog of bounded size: old epochs merged into runs of last changes.

A changelog table gains a folder a batch, and folding it to sessions reads all
of it. Here the epochs are the lowest level of a log-structured table below
``<table>``: ``epoch/epoch_id=<n>`` holds a batch's changes; ``fan_in`` folders
of one level are merged into one of the next, ``level<k>/epoch_id=<n>``, that
keeps of each session only its last change and the epoch it came in. A row is
so rewritten once a level, ``log(epochs)`` times, and there are at most
``fan_in`` folders a level. The manifest names the folders that count and the
low-water mark: every epoch up to it has been merged, so a reader that asks for
single changes finds them only above it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.streaming.epochs import drop_epochs, epoch_path, manifests, read_epochs, write_manifest
from bayline.streaming.fold import OUTPUT
from bayline.streaming.live_views import IDENT

LAST = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in OUTPUT.fields) + ", changed_in bigint"
REST = [c for c in OUTPUT.names if c not in IDENT]


def _level(k: int) -> str:
    return "epoch" if k == 0 else f"level{k}"


def last_changes(rows: DataFrame) -> DataFrame:
    """Of each session its change of the newest epoch (``changed_in``)."""
    last = rows.groupBy(*IDENT).agg(F.max(F.struct("changed_in", *REST)).alias("l"))
    return last.select(*IDENT, *[F.col(f"l.{c}").alias(c) for c in ("changed_in", *REST)])


def _read(spark: SparkSession, table: str, levels: list[list[int]]) -> DataFrame | None:
    parts = [read_epochs(spark, table, _level(k), runs, f"{LAST}, epoch_id bigint") for k, runs in enumerate(levels)]
    parts = [p.drop("epoch_id") for p in parts if p is not None]
    return reduce(DataFrame.unionByName, parts) if parts else None


def compacted_sink(table: str, fan_in: int = 8, keep: int = 3):
    """``foreachBatch`` function that writes a batch's session changes and
    merges what has become due. A retried batch starts again from the manifest
    before it and overwrites its folders."""
    table = table.rstrip("/")
    if fan_in < 2 or keep < 1:
        raise ValueError("fan_in must be 2 or more, keep 1 or more")

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        known = manifests(spark, table)
        before = max((e for e in known if e < epoch_id), default=None)
        state = {"levels": [[]], "low_water": -1} if before is None else known[before]
        levels = [list(x) for x in state["levels"]]
        low_water = state["low_water"]
        (batch.select(*OUTPUT.names, F.lit(epoch_id).cast("long").alias("changed_in"))
         .write.mode("overwrite").parquet(epoch_path(table, _level(0), epoch_id)))
        levels[0].append(epoch_id)
        k = 0
        while len(levels[k]) >= fan_in:
            runs = [[] for _ in range(k)] + [levels[k]]
            last_changes(_read(spark, table, runs)).write.mode("overwrite").parquet(epoch_path(table, _level(k + 1), epoch_id))
            low_water = max(low_water, epoch_id)
            levels[k] = []
            if k + 1 == len(levels):
                levels.append([])
            levels[k + 1].append(epoch_id)
            k += 1
        state = {"levels": levels, "low_water": low_water}
        write_manifest(spark, table, epoch_id, state)
        kept = {e: m for e, m in known.items() if epoch_id - keep < e < epoch_id} | {epoch_id: state}
        drop_epochs(spark, f"{table}/manifest", lambda e: e < epoch_id and e not in kept)
        for k in range(len(levels)):
            wanted = {e for m in kept.values() if k < len(m["levels"]) for e in m["levels"][k]}
            drop_epochs(spark, f"{table}/{_level(k)}", lambda e, w=wanted: e <= epoch_id and e not in w)
    return write


def read_compacted(spark: SparkSession, table: str) -> DataFrame:
    """Last changes as of the newest manifest, at most one row a session and
    folder, with the epoch as ``epoch_id``: folded by
    :func:`bayline.streaming.jobs.sessions_from_changelog` like the changelog
    itself. The folders are named when this is called, so a reader isn't
    disturbed by batches written meanwhile."""
    table = table.rstrip("/")
    known = manifests(spark, table)
    rows = _read(spark, table, known[max(known)]["levels"])
    return rows.withColumnRenamed("changed_in", "epoch_id")


def changes_since(spark: SparkSession, table: str, epoch_id: int) -> DataFrame:
    """Single changes of the epochs after ``epoch_id``; an error below the
    low-water mark, where they have been merged."""
    table = table.rstrip("/")
    known = manifests(spark, table)
    state = known[max(known)]
    if epoch_id < state["low_water"]:
        raise ValueError(f"changes up to epoch {state['low_water']} have been merged")
    rows = _read(spark, table, [[e for e in state["levels"][0] if e > epoch_id]])
    if rows is None:
        rows = spark.createDataFrame([], LAST)
    return rows.withColumnRenamed("changed_in", "epoch_id")
