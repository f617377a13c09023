"""Column expressions for duration and block pricing (JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bayline.params import Settings


def block_cost(duration: Column, s: Settings) -> Column:
    """``ceil(duration / block_seconds) * block_price`` as bigint.

    Same rounding as Python's ``math.ceil`` on a float quotient: ``0 -> 0``,
    ``1 -> 1 block``, ``-700 -> -1 block``.
    """
    blocks = F.ceil(duration / F.lit(float(s.block_seconds)))
    return (blocks * F.lit(s.block_price)).cast("long")


def live_duration(start_time: Column, as_of: Column) -> Column:
    """Seconds from ``start_time`` to the reading time ``as_of``."""
    return (as_of - start_time).cast("long")


def session_status(closed: Column, end_time: Column, as_of: Column, s: Settings) -> Column:
    """CLOSED if ended by an exit, TIMEOUT if silent for longer than the limit
    at ``as_of``, else ACTIVE."""
    return (
        F.when(closed, F.lit("CLOSED"))
        .when(as_of - end_time > F.lit(s.timeout_seconds), F.lit("TIMEOUT"))
        .otherwise(F.lit("ACTIVE"))
    )
