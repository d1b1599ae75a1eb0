"""Year / financial-year expressions and period labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stats import col


def fin_year(date_col) -> Column:
    """April-March financial year of a date: month > 3 ? year : year - 1."""
    d = col(date_col)
    return F.when(F.month(d) > 3, F.year(d)).otherwise(F.year(d) - 1).cast("int")


def clean_fin_year(text_col) -> Column:
    """Financial-year codes to the opening calendar year.

    "304" -> 2003, "1011" -> 2010, "2015/16" and "2015-16" -> 2015.  A four
    digit text whose halves are not consecutive is a plain year ("2015" ->
    2015); any other shape is NULL.
    """
    t = F.trim(col(text_col))
    two, next_two = F.substring(t, 1, 2), F.substring(t, 3, 2)
    pair = (two.try_cast("int") + 1) % 100 == next_two.try_cast("int")
    return (F.when(t.rlike("^[0-9]{3}$"), F.concat(F.lit("200"), F.substring(t, 1, 1)))
            .when(t.rlike("^[0-9]{4}[/-][0-9]{2}([0-9]{2})?$"), F.substring(t, 1, 4))
            .when(t.rlike("^[0-9]{4}$") & pair, F.concat(F.lit("20"), two))
            .when(t.rlike("^[0-9]{4}$"), t)).cast("int")


def year_end_to_start(year_end) -> Column:
    """Opening year of a financial year that is named by the year it ends in."""
    return (col(year_end).cast("int") - 1).cast("int")


def time_fix(time_agg: int) -> int:
    """Shift from the last year of a rolling window to its centre year."""
    if time_agg < 3:
        return 0
    if time_agg == 3:
        return 1
    if time_agg == 5:
        return 2
    raise ValueError(f"time_agg must be 1, 2, 3 or 5, got {time_agg}")


def _yy(year: Column) -> Column:
    """Last two digits of a year as text (2010 -> '10')."""
    return F.substring(year.cast("string"), 3, 2)


def period_labels(year_col, year_type: str, time_agg: int,
                  legacy_five_year: bool = False) -> tuple[Column, Column]:
    """(trend_axis, def_period) label expressions for an INT centre year.

    ``legacy_five_year`` reproduces the reference's opening label of financial
    5-year periods ("2008/10-..."); by default the correct "2008/09" is used.
    """
    y = col(year_col).cast("int")
    tf = time_fix(time_agg)
    s = lambda v: v.cast("string")
    if "snapshot" in year_type:
        return s(y), F.concat(s(y), F.lit(f" {year_type}"))
    if year_type == "survey" or (year_type == "calendar" and tf == 0 and time_agg != 2):
        return s(y), F.concat(s(y), F.lit(f" {year_type} year"))
    if year_type == "calendar" and time_agg == 2:
        axis = F.concat(s(y - 1), F.lit("-"), s(y))
        return axis, F.concat(s(y - 1), F.lit(" to "), s(y), F.lit(" calendar years; 2-year aggregates"))
    if year_type == "calendar":
        axis = F.concat(s(y - tf), F.lit("-"), s(y + tf))
        period = F.concat(s(y - tf), F.lit(" to "), s(y + tf),
                          F.lit(f" calendar years; {time_agg}-year aggregates"))
        return axis, period
    if year_type in ("financial", "school"):
        if tf == 0 and time_agg != 2:
            axis = F.concat(s(y), F.lit("/"), _yy(y + 1))
            return axis, F.concat(axis, F.lit(f" {year_type} year"))
        if time_agg == 2:
            first, last = F.concat(s(y - 1), F.lit("/"), _yy(y)), F.concat(s(y), F.lit("/"), _yy(y + 1))
            return (F.concat(first, F.lit("-"), last),
                    F.concat(first, F.lit(" to "), last, F.lit(f" {year_type} years; 2-year aggregates")))
        opening = _yy(y) if legacy_five_year else _yy(y - tf + 1)
        first = F.concat(s(y - tf), F.lit("/"), opening)
        last = F.concat(s(y + tf), F.lit("/"), _yy(y + tf + 1))
        return (F.concat(first, F.lit("-"), last),
                F.concat(first, F.lit(" to "), last,
                         F.lit(f" {year_type} years; {time_agg}-year aggregates")))
    raise ValueError(f"unknown year_type {year_type!r}")
