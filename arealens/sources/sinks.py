"""Sinks for published results."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans.indicator import INDICATOR_COLUMNS


def write_indicator(df: DataFrame, path: str, csv_path: str | None = None,
                    partition_by=("ind_id",)) -> None:
    """Write the fixed-layout result as parquet partitioned by indicator (and optionally CSV).

    Partitions are overwritten dynamically, so rerunning one indicator
    replaces only its own files, never another indicator's.
    """
    out = df.select(*INDICATOR_COLUMNS)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    if csv_path:
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True)
         .partitionBy(*partition_by).csv(csv_path))
