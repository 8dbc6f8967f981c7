"""Every editable assumption of the analysis, in one immutable object."""

from __future__ import annotations

import math
from dataclasses import dataclass, field, fields, replace
from datetime import date, timedelta

# Status and bucket labels are part of the published output.
MET = "Met"
MISSED = "Missed"
OPEN_WITHIN = "Open Within SLA"
OPEN_PAST = "Open Past SLA"
BUCKETS = ("0-7 days", "8-30 days", "31-90 days", "91-180 days", "180+ days")
AGED_BUCKETS = BUCKETS[2:]
UNSPECIFIED = "Unspecified"
ACTIVITY = "activity_q2_2026"
BACKLOG = "aged_open_backlog"


@dataclass(frozen=True)
class Weights:
    """Priority-model weights."""

    volume: float = 0.30
    backlog: float = 0.25
    miss: float = 0.25
    aged: float = 0.20

    def total(self) -> float:
        return sum(getattr(self, f.name) for f in fields(self))

    def require_unit_sum(self) -> "Weights":
        if not math.isclose(self.total(), 1.0, abs_tol=1e-9):
            raise ValueError(f"priority weights must sum to 100%, got {self.total():.2%}")
        return self


@dataclass(frozen=True)
class Params:
    """Snapshot, window, thresholds and weights of one analysis run."""

    snapshot_date: date = date(2026, 7, 5)
    window_start: date = date(2026, 4, 1)
    window_end: date = date(2026, 7, 1)  # exclusive
    backlog_start: date = date(2025, 1, 1)
    bucket_bounds: tuple[int, int, int, int] = (7, 30, 90, 180)
    default_sla_days: int = 14
    weights: Weights = field(default_factory=Weights)
    min_cell: int = 200
    volume_floor: int = 5_000

    def __post_init__(self) -> None:
        if list(self.bucket_bounds) != sorted(set(self.bucket_bounds)):
            raise ValueError(f"bucket bounds must increase: {self.bucket_bounds}")
        if not self.backlog_start <= self.window_start < self.window_end:
            raise ValueError("expected backlog_start <= window_start < window_end")

    @property
    def closed_before(self) -> date:
        """A closure counts as closed when it lies before this date (snapshot + 1 day)."""
        return self.snapshot_date + timedelta(days=1)

    def at(self, snapshot: date) -> "Params":
        """The same assumptions measured against another snapshot."""
        return replace(self, snapshot_date=snapshot)
