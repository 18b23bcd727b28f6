"""The two batch rules that stand in for streaming (L1, L2).

L1 late data: each incremental run recomputes the last ``lookback_days`` days
(inclusive: 3 days back covers 4 dates), so rows arriving up to that late are
picked up; later arrivals stay missing until a full refresh.
L2 state bound: tables hold ``window_days`` days; older day partitions expire.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

# Lookback, fact window, staging window, expiry ages (days).
LOOKBACK_DAYS = 3
FACT_WINDOW_DAYS = 90
STAGING_WINDOW_DAYS = 95
FACT_EXPIRY_DAYS = 90
STAGING_EXPIRY_DAYS = 100
# Fixed value: days back that event ids are checked for repeats.
UNIQUE_CHECK_DAYS = 7


@dataclass(frozen=True)
class RefreshWindow:
    as_of: date
    days: int

    @property
    def cutoff(self) -> date:
        """First day recomputed (inclusive)."""
        return self.as_of - timedelta(days=self.days)

    def covers(self, day: date) -> bool:
        return day >= self.cutoff


def refresh_window(as_of: date, incremental: bool, lookback_days: int = LOOKBACK_DAYS,
                   window_days: int = FACT_WINDOW_DAYS) -> RefreshWindow:
    """Days an incremental (or full) run recomputes."""
    return RefreshWindow(as_of, lookback_days if incremental else window_days)


def expiry_cutoff(as_of: date, days: int) -> date:
    """Partitions dated before this day expire."""
    return as_of - timedelta(days=days)
