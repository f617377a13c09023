"""Session fold that waits for the watermark before folding (out-of-order input).

The plain keyed form folds each trigger's rows at once, so a row that
arrives in a later trigger but is older than rows already folded (allowed
within the watermark delay) cannot be put back in place. This variant keeps
such rows in the state until the watermark has reached them: a row
that comes at or behind the watermark is set aside as late (``side``), so what
waited is sorted and folded in order into the open session.

State per group of keys (:mod:`bayline.streaming.fold`): the open sessions and
the waiting rows (not yet behind the watermark, bounded by the delay times the
group's rate), each as arrays of one state row, so a call reads and writes its
state once; list state and timers of each key cost a round trip to the JVM a
call. The group's timer is the earliest of its oldest waiting row and of its
open sessions' inactivity limits. Event times are whole seconds, so the
watermark moves in whole seconds; the timer of a waiting row sits half a second
ahead of it, as timers fire strictly behind the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from bayline.operators.sessionize import valid_events
from bayline.params import Settings
from bayline.streaming.fold import fold_groups


def ordered_sessionize_stream(events: DataFrame, s: Settings) -> DataFrame:
    """Like :func:`bayline.streaming.jobs.sessionize_stream`, but rows may
    arrive out of order within the watermark delay."""
    from bayline.streaming.jobs import with_clock
    return fold_groups(with_clock(valid_events(events), s), s, ordered=True)
