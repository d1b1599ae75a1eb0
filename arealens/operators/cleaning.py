"""Ingest cleaning: unknown areas, sentinel codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sentinel_to_null(df: DataFrame, col: str, sentinels) -> DataFrame:
    """Codes that mean 'unknown' become NULL."""
    return df.withColumn(col, F.when(F.col(col).isin(list(sentinels)), F.lit(None))
                         .otherwise(F.col(col)))


def drop_unknown_area(df: DataFrame, col: str, sentinels=(), prefix: str | None = None) -> DataFrame:
    """Remove rows whose area is null, blank, a sentinel, or outside ``prefix``."""
    c = F.col(col)
    keep = c.isNotNull() & (F.trim(c.cast("string")) != "")
    if sentinels:
        keep = keep & ~c.isin(list(sentinels))
    if prefix:
        keep = keep & c.cast("string").startswith(prefix)
    return df.where(keep)
