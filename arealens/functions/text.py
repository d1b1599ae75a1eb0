"""String cleaning expressions used at ingest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stats import col


def clean_numeric_text(c) -> Column:
    """'1,234' -> 1234.0, '-' -> 0.0, anything else unparsable -> NULL."""
    t = F.trim(col(c))
    stripped = F.regexp_replace(t, ",", "")
    return F.when(t == "-", F.lit(0.0)).otherwise(stripped.try_cast("double"))


def after_last(c, sep: str = ": ") -> Column:
    """Text after the last occurrence of ``sep`` (whole text when absent)."""
    return F.substring_index(col(c), sep, -1)


def ampersand_to_and(c) -> Column:
    return F.regexp_replace(col(c), "&", "and")


def trim_code(c, n: int = 9) -> Column:
    """Area codes arrive with trailing labels; keep the first ``n`` characters."""
    return F.substring(F.trim(col(c)), 1, n)


def pad_number(c, width: int = 3) -> Column:
    """Zero-padded to ``width``; longer numbers stay whole."""
    t = col(c).cast("string")
    return F.lpad(t, F.greatest(F.length(t), F.lit(width)), F.lit("0"))


def snake_case(name: str) -> str:
    """Column-name normalisation applied to CSV headers."""
    import re

    s = re.sub(r"[^0-9a-zA-Z]+", "_", name.strip()).strip("_")
    return s.lower()
