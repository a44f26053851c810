"""Disclosure-control rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(col: Column | str, base: int = 10) -> Column:
    """Round a count to the nearest multiple of ``base`` (half up), as BIGINT."""
    c = F.col(col) if isinstance(col, str) else col
    if base == 10:
        return F.round(c, -1).cast("bigint")
    return (F.floor(c / F.lit(base) + F.lit(0.5)) * F.lit(base)).cast("bigint")
