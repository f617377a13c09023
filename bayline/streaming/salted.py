"""Keyed sessions for hot keys: rows are folded to runs before the state.

In :func:`bayline.streaming.jobs.sessionize_stream` one Python call gets all
rows that a key has in a trigger. Here they take two steps:

1. rows are dealt by key and time bucket (``bucket_seconds``), so a key that
   holds most of a trigger is spread over as many tasks as it has buckets, and
   each task folds its rows, of all its keys together in numpy, to runs: pieces
   of one session, cut where an EXITING or a silence ends it and at the
   bucket's edge. No state takes part;
2. the keyed state joins a key's runs, some for each bucket, into its open
   session (:func:`bayline.streaming.fold.fold_groups`).

Runs of adjacent buckets join by the rules that events follow, so the sessions
are those of the plain fold. A run is late as a whole, when its newest event is
at or behind the watermark: it leaves with its events counted (``side``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.operators.sessionize import KEY, T_COL, TIE_COL, valid_events
from bayline.params import EXITING, Settings
from bayline.streaming.fold import fold_groups

RUN = ("license_plate string, location string, start_time long, end_time long, n_events long, "
       "start_event_id long, is_exit boolean")


def runs_of(plate: pa.Array, location: pa.Array, t: np.ndarray, ids: np.ndarray, is_exit: np.ndarray, s: Settings):
    """Runs of events of any keys: ``(row of the run's first event, start, end,
    n, first id, is_exit)``."""
    plates, spots = plate.dictionary_encode(), location.dictionary_encode()
    key = (plates.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(spots.dictionary)
           + spots.indices.to_numpy(zero_copy_only=False))
    order = np.lexsort((ids, t, key))
    key, t, ids, is_exit = key[order], t[order], ids[order], is_exit[order]
    bucket = t // s.bucket_seconds
    cut = ((key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1]) | is_exit[:-1] | (t[1:] - t[:-1] > s.timeout_seconds))
    first = np.flatnonzero(np.append(True, cut))
    last = np.append(first[1:], len(t)) - 1
    return order[first], t[first], t[last], last - first + 1, ids[first], is_exit[last]


def _fold_parts(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        # a task's share of the trigger, 25 bytes a row besides the names
        table = pa.Table.from_batches(rows).combine_chunks()
        plate, location = (pa.concat_arrays(table[c].chunks) for c in KEY)
        t, ids, is_exit = (table[c].to_numpy() for c in (T_COL, TIE_COL, "is_exit"))
        at, *cols = runs_of(plate, location, t, ids, is_exit.astype(bool), s)
        at = pa.array(at)
        yield pa.RecordBatch.from_arrays([plate.take(at), location.take(at), *map(pa.array, cols)],
                                         names=[c.split()[0] for c in RUN.split(", ")])
    return run


def salted_sessionize_stream(events: DataFrame, s: Settings, split_on_exit: bool = True) -> DataFrame:
    """Like :func:`bayline.streaming.jobs.sessionize_stream` (event time), with
    each task's rows bounded by its share of the time buckets, not by a key.
    Without ``split_on_exit`` only silence ends a session."""
    from bayline.streaming.jobs import with_event_time

    is_exit = F.coalesce(F.col("status_code") == F.lit(EXITING), F.lit(False)) if split_on_exit else F.lit(False)
    ev = with_event_time(valid_events(events), s).withColumn("is_exit", is_exit)
    dealt = ev.repartition(*KEY, F.floor(F.col(T_COL) / F.lit(s.bucket_seconds)))
    runs = dealt.select(*KEY, T_COL, TIE_COL, "is_exit").mapInArrow(_fold_parts(s), RUN)
    # the clock runs on the events above; no run is filtered by it
    tag = {"spark.watermarkDelayMs": s.delay_seconds * 1000}
    runs = runs.withColumn("event_time", F.lit(None).cast("timestamp").alias("event_time", metadata=tag))
    return fold_groups(runs, s)
