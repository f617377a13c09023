"""Settings for every operator, passed as one frozen value."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

# Fixed values (must equal the reference's example configuration):
#   block_price 10000 per block_seconds 600; parking rows A-F with columns 1-10;
#   3 cameras, so 3 zones; closed history default 50, retention 1000;
#   session statuses ACTIVE, CLOSED, TIMEOUT; event statuses ENTERING, PARKED,
#   MOVING, EXITING.
ENTERING, PARKED, MOVING, EXITING = "ENTERING", "PARKED", "MOVING", "EXITING"
ACTIVE, CLOSED, TIMEOUT = "ACTIVE", "CLOSED", "TIMEOUT"

# The lifecycle the simulator follows (from -> to).
ALLOWED_TRANSITIONS = (
    (ENTERING, PARKED),
    (PARKED, PARKED),
    (PARKED, MOVING),
    (PARKED, EXITING),
    (MOVING, EXITING),
    (EXITING, ENTERING),
)

UNIT_SECONDS = {"second": 1, "sec": 1, "minute": 60, "min": 60, "hour": 3600, "day": 86400, "week": 604800}


@dataclass(frozen=True)
class Settings:
    block_price: int = 10000
    block_seconds: int = 600
    # inactivity limit in event-time seconds; a gap larger than this splits
    timeout_seconds: int = 30
    # width of the time buckets used to scan one key in parallel pieces
    bucket_seconds: int = 3600
    # keys of a keyed stream share this many state rows, folded together by
    # numpy; fixed for the life of a checkpoint, like its shuffle partitions
    state_groups: int = 512
    # a piece with more rows is cut again by a range split (0: no check)
    max_piece_rows: int = 4_000_000
    # "emit": an EXITING with no open session is a CLOSED 0 s row; "drop": none
    lone_exit: str = "emit"
    # a TIMEOUT row ends the session in the views (the reference ignores it)
    timeout_is_terminal: bool = True
    rows: str = "ABCDEF"
    n_cols: int = 10
    n_zones: int = 3
    closed_limit: int = 50
    closed_retention: int = 1000
    # largest dimension (rows x cols) that may be broadcast
    broadcast_max_rows: int = 2_000_000
    # how far behind the newest event a row may come; a stream has no default,
    # as what comes later leaves for the late table
    watermark_delay: str | None = None
    # "event": timeouts on event time (replay = live); "processing": the timer
    # is re-armed to now + limit on each trigger that touches the key
    timeout_mode: str = "event"

    def with_(self, **kw) -> "Settings":
        return replace(self, **kw)

    @property
    def stream_delay(self) -> str:
        if self.watermark_delay is None:
            raise ValueError("a stream needs watermark_delay, e.g. '10 minutes' or '0 seconds'")
        return self.watermark_delay

    @property
    def delay_seconds(self) -> int:
        """The delay in whole seconds, from the forms of an interval text."""
        text = re.sub(r"^\s*interval\b", "", self.stream_delay.lower())
        parts = re.findall(r"\s*(\d+)\s*([a-z]+)", text)
        if not parts or re.sub(r"\s*(\d+)\s*([a-z]+)", "", text).strip():
            raise ValueError(f"not a delay: {self.watermark_delay!r}")
        total = 0
        for n, unit in parts:
            if unit.rstrip("s") not in UNIT_SECONDS:
                raise ValueError(f"not a delay: {self.watermark_delay!r}")
            total += int(n) * UNIT_SECONDS[unit.rstrip("s")]
        return total

    @property
    def n_locations(self) -> int:
        return len(self.rows) * self.n_cols


DEFAULT = Settings()
