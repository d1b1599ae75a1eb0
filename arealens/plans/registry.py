"""Registry of named queries (the driver contract) and their DuckDB oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` over the base tables; its
oracle is independent SQL over the same tables.  Doubles are rounded to six
places on both sides at presentation only, because floating sums differ in
the last bits when the summation order differs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column for comparison; other columns untouched."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
