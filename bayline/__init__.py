"""bayline: parking-session analytics as Spark DataFrame jobs.

Camera events (plate, spot, status, time) become billed sessions, a session
changelog, occupancy views and data-quality audits. The batch form uses only
built-in DataFrame operators; the streaming form keeps one small state per
(plate, spot) with ``applyInPandasWithState`` and event-time timeouts.
"""

import sys

from bayline.params import Settings

# Python workers unpickle the streaming fold and processors; pickling this
# package by value ships its code with each task, so workers need not find it
# on their path (a cluster job may still ship it with --py-files).
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: rely on --py-files
    pass

__all__ = ["Settings"]
