"""Settings that plans take as values; no plan reads the clock."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    as_of: dt.date = dt.date(2001, 11, 5)
    run_ts: dt.datetime = dt.datetime(2001, 11, 5)
    lookback_hours: int = 48
    default_threshold_days: int = 90
    spine_start: dt.date = dt.date(2015, 1, 1)
    spine_end: dt.date = dt.date(2030, 12, 31)
    par_edges: tuple[int, ...] = (0, 30, 60, 90, 180)
    mature_days: int = 180
    max_reject_ratio: float = 0.05
