"""Age expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stats import col


def age_band(age_col) -> Column:
    """Five-year age band 1..19: 0-4 -> 1, ..., 85-89 -> 18, 90-200 -> 19, else NULL."""
    a = col(age_col)
    return (F.when(a.between(0, 200), F.least(F.floor(a / 5) + 1, F.lit(19)))
            .cast("int"))


def in_age_range(age_col, lo: int | None = None, hi: int | None = None) -> Column:
    """Inclusive age restriction; either bound may be open."""
    a = col(age_col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (a >= lo)
    if hi is not None:
        cond = cond & (a <= hi)
    return cond
