from cohortwise.functions.dates import OPEN_END, clamp_after, days_between, full_years, open_end
from cohortwise.functions.rounding import round_to
from cohortwise.functions.study import DEFAULT_WINDOW, StudyWindow

__all__ = [
    "OPEN_END",
    "DEFAULT_WINDOW",
    "StudyWindow",
    "clamp_after",
    "days_between",
    "full_years",
    "open_end",
    "round_to",
]
