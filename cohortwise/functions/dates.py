"""Date helpers expressed with built-in Spark column functions (JVM side)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinel for an open-ended spell ("still resident").
OPEN_END = dt.date(9999, 1, 1)


def open_end(col: Column | str) -> Column:
    """Replace a missing spell end by the open-end sentinel."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(OPEN_END))


def full_years(event: Column | str, birth: Column | str) -> Column:
    """Completed years from ``birth`` to ``event`` (negative when event < birth).

    A year counts only once the birthday has been reached, so 2000-02-29 to
    2001-02-28 is 0 years. Written with year/month/day arithmetic so that it
    agrees with the same formula in SQL engines.
    """
    e = F.col(event) if isinstance(event, str) else event
    b = F.col(birth) if isinstance(birth, str) else birth
    e_md = F.month(e) * 100 + F.dayofmonth(e)
    b_md = F.month(b) * 100 + F.dayofmonth(b)
    forward = F.year(e) - F.year(b) - F.when(e_md < b_md, 1).otherwise(0)
    backward = -(F.year(b) - F.year(e) - F.when(b_md < e_md, 1).otherwise(0))
    return F.when(e >= b, forward).otherwise(backward).cast("int")


def days_between(a: Column | str, b: Column | str) -> Column:
    """``a - b`` in days (same sign convention as SQL DAYS_BETWEEN)."""
    return F.date_diff(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)


def clamp_after(col: Column | str, limit: dt.date, replacement: dt.date) -> Column:
    """``replacement`` when ``col > limit`` else ``col``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c > F.lit(limit), F.lit(replacement)).otherwise(c)
