"""Multi-year periods: rolling means and period labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import period_labels as _labels
from ..functions.dates import time_fix


def rolling_mean(df: DataFrame, group_keys, time_agg: int,
                 cols=("numerator", "denominator"), required: str = "denominator",
                 year_col: str = "year", strict_years: bool = False) -> DataFrame:
    """Right-aligned mean over the last ``time_agg`` rows of each group.

    A window with fewer than ``time_agg`` rows, or with a null inside, is null
    (as RcppRoll's ``roll_meanr``); rows whose ``required`` mean is null are
    dropped, then the year moves to the centre of the window.  Rows, not
    calendar years, are counted (a missing year stretches the period); with
    ``strict_years`` the frame is ``time_agg`` calendar years and a period that
    misses one is null.  Each
    window partition is one area series - a few dozen years at most - so no
    partition can grow with the data.
    """
    tf = time_fix(time_agg)
    w = Window.partitionBy(*group_keys).orderBy(year_col)
    w = w.rangeBetween(-(time_agg - 1), 0) if strict_years else w.rowsBetween(-(time_agg - 1), 0)
    out = df.withColumns({c: F.when(F.count(c).over(w) == time_agg, F.avg(c).over(w))
                          for c in cols if c in df.columns})
    if required in out.columns:
        out = out.where(F.col(required).isNotNull())
    return out.withColumn(year_col, (F.col(year_col) - tf).cast("int"))


def add_period_labels(df: DataFrame, year_type: str, time_agg: int,
                      legacy_five_year: bool = False, year_col: str = "year") -> DataFrame:
    """Add ``trend_axis`` and ``def_period`` text from the (centre) year."""
    axis, period = _labels(year_col, year_type, time_agg, legacy_five_year)
    return df.withColumns({"trend_axis": axis, "def_period": period})


def latest_year(df: DataFrame, year_col: str = "year", by=()) -> DataFrame:
    """Rows of the latest year (overall, or per ``by`` group).

    The maximum is a scalar subquery (overall) or a grouped aggregate joined
    back (per group), never a single-partition window.
    """
    if not by:
        top = df.select(F.max(year_col)).scalar()
        return df.where(F.col(year_col) == top)
    mx = df.groupBy(*by).agg(F.max(year_col).alias("_max_year"))
    return (df.join(mx, list(by), "inner").where(F.col(year_col) == F.col("_max_year"))
            .drop("_max_year"))
