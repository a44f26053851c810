"""Study parameters shared by every operator."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class StudyWindow:
    """Follow-up window of a study.

    ``start``/``end`` bound the cohort, ``events_from`` is the lower bound used
    when linking or extracting event sources, ``age_max_days`` is the age limit
    at ``start`` (exclusive), ``gap_days`` the largest gap between two spells
    that still counts as continuous follow-up (exclusive).
    """

    start: dt.date
    end: dt.date
    events_from: dt.date
    age_max_days: int = 38325  # 105 years
    gap_days: int = 2

    @property
    def end_plus_one(self) -> dt.date:
        return self.end + dt.timedelta(days=1)


# Window used with the driver's test tables (their dates span 1995..2001).
DEFAULT_WINDOW = StudyWindow(
    start=dt.date(1997, 1, 1),
    end=dt.date(2000, 12, 31),
    events_from=dt.date(1995, 1, 1),
)
