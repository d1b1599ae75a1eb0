"""Column expressions for rates and confidence intervals.

All arithmetic stays JVM-side.  Divisions go through ``try_divide`` so ANSI
mode never raises: a zero denominator yields NULL where R yields Inf/NaN, and
the NULL is resolved by the same rules the reference applies afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The normal quantile used for 95% intervals, and Student-t
# 0.975 quantiles for 1, 2 and 3 degrees of freedom (SII with 3, 4, 5 points).
Z = 1.96
T975 = {1: 12.706204736174698, 2: 4.302652729749464, 3: 3.182446305284263}


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (never an ANSI error)."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def no_nan(c) -> Column:
    """NaN -> NULL, so later comparisons follow R's NA logic (NaN > 100 is NA, not TRUE)."""
    return F.nanvl(col(c), F.lit(None).cast("double"))


def byar_lower(n) -> Column:
    """Byar's approximation of the lower 95% Poisson limit of a count n.

    n = 0 has no lower limit (R gives NaN, here NULL).
    """
    n = col(n).cast("double")
    return n * F.pow(1 - div(F.lit(1.0), 9 * n) - div(F.lit(Z), 3 * F.sqrt(n)), 3)


def byar_upper(n) -> Column:
    n1 = col(n).cast("double") + 1
    return n1 * F.pow(1 - F.lit(1.0) / (9 * n1) + F.lit(Z) / (3 * F.sqrt(n1)), 3)


def wilson_bounds(n, d) -> tuple[Column, Column, Column]:
    """Percentage with Wilson score interval: (rate, lowci, upci), unclamped."""
    n = col(n).cast("double")
    d = col(d).cast("double")
    rate = div(n, d) * 100
    root = F.sqrt(Z * Z + 4 * n * (1 - rate / 100))
    denom = 2 * (d + Z * Z)
    low = div(2 * n + Z * Z - Z * root, denom) * 100
    up = div(2 * n + Z * Z + Z * root, denom) * 100
    return rate, low, up


def clamp_pct_low(c, round_to: int | None = None) -> Column:
    c = no_nan(c)
    kept = F.bround(c, round_to) if round_to is not None else c
    return F.when(c < 0, F.lit(0.0)).otherwise(kept)


def clamp_pct_up(c, round_to: int | None = None) -> Column:
    c = no_nan(c)
    kept = F.bround(c, round_to) if round_to is not None else c
    return F.when(c > 100, F.lit(100.0)).otherwise(kept)


def zero_if_missing(c) -> Column:
    """NULL / NaN -> 0 (the reference's final null policy)."""
    return F.coalesce(no_nan(c), F.lit(0.0))
