"""Disclosure control: our own documented rule (the published method is not public).

Counts below ``k`` are suppressed; when a (parent, year) group has exactly one
suppressed cell, the next smallest cell of that group is suppressed too, so
the hidden value cannot be recovered from the parent total.  Each window is
one parent area in one year (a few dozen cells), never a data-sized group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def disclosure_control(df: DataFrame, parent: str, keys=("year",), value: str = "numerator",
                       k: float = 5, code: str = "code") -> DataFrame:
    g = Window.partitionBy(parent, *keys)
    small = F.col(value) < k
    ranked = (df.withColumn("_small", small)
              .withColumn("_n_small", F.sum(F.col("_small").cast("int")).over(g))
              .withColumn("_rank_big", F.row_number().over(
                  g.orderBy(F.col("_small").asc(), F.col(value).asc(), F.col(code).asc()))))
    # rows are ordered non-small first, so the next smallest non-suppressed cell is rank 1
    second = (F.col("_n_small") == 1) & ~F.col("_small") & (F.col("_rank_big") == 1)
    out = ranked.withColumn("suppressed", F.col("_small") | second)
    return (out.withColumn(value, F.when(F.col("suppressed"), F.lit(None)).otherwise(F.col(value)))
            .drop("_small", "_n_small", "_rank_big"))
