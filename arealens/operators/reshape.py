"""Reshapes: wide-to-long, long-to-wide, appends, first-per-group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wide_years_unpivot(df: DataFrame, ids, value_cols, prefix: str = "", value: str = "value",
                       drop_null: bool = False) -> DataFrame:
    """Year columns (``n1995``, ``2009``...) -> (ids, year, value) rows.

    ``drop_null`` is R's ``na.rm`` (nulls are kept by default).
    """
    out = df.unpivot(list(ids), list(value_cols), "_col", value)
    out = out.withColumn("year", F.regexp_replace("_col", f"^{prefix}", "").cast("int")).drop("_col")
    if drop_null:
        out = out.where(F.col(value).isNotNull())
    return out.select(*ids, "year", value)


def measure_pivot(df: DataFrame, keys, measure_col: str, values, value_col: str,
                  agg: str = "sum", names: dict | None = None) -> DataFrame:
    """Measure rows -> one column per listed measure value (explicit values: no extra job)."""
    fn = getattr(F, agg)
    out = df.groupBy(*keys).pivot(measure_col, list(values)).agg(fn(value_col))
    for v, n in (names or {}).items():
        out = out.withColumnRenamed(v, n)
    return out


def geo_pivot(df: DataFrame, keys=("year",), code: str = "code", types=("S00", "S08", "S12")) -> DataFrame:
    """Count of areas per geography type as columns."""
    t = df.withColumn("_geo", F.substring(code, 1, 3))
    return (t.groupBy(*keys).pivot("_geo", list(types)).agg(F.countDistinct(code))
            .fillna(0, subset=list(types)))


def union_all(frames, allow_missing: bool = True) -> DataFrame:
    """Row append by name; missing columns become null (``bind_rows``)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def first_per_group(df: DataFrame, keys, order_cols, cols) -> DataFrame:
    """First row per group in a stable order, as an aggregate (no global sort)."""
    order = F.struct(*[F.col(c) for c in order_cols])
    out = df.groupBy(*keys).agg(F.min_by(F.struct(*cols), order).alias("_f"))
    return out.select(*keys, *[F.col(f"_f.{c}").alias(c) for c in cols])


def match_slices(df: DataFrame, slices: DataFrame, keys, default: str = "All") -> DataFrame:
    """Every row of ``df`` with every slice it belongs to, in one join.

    ``slices`` holds one row per slice: its own columns and, for each key, the
    value it takes; a null value means ``default``, the pooled category.
    Slices may share rows (two indicators over the same category).
    """
    wanted = slices.withColumns({k: F.coalesce(F.col(k), F.lit(default)) for k in keys})
    return df.join(wanted, list(keys))
