"""Run many indicators in one job.

Indicators that share a prepared source and run parameters are one plan
with ``ind_id`` as an extra group key (one scan, one roll-up, one window
pass for all of them); groups with different parameters are separate plans
unioned into one result, written in one action.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import union_all
from .indicator import INDICATOR_COLUMNS, run_indicator
from .spec import IndicatorSpec


def run_keyed(prepared: DataFrame, spec: IndicatorSpec, lookup: DataFrame, base_col: str, level_cols,
              key: str = "ind_id", population: DataFrame | None = None,
              ref_pop: DataFrame | None = None, ind_ids: list[int] | None = None) -> DataFrame:
    """Several indicators sharing ``spec``'s parameters: ``prepared`` carries the
    indicator id in ``key`` and every step groups by it.  A run with a population
    names the batch's indicators in ``ind_ids``, so each is zero-filled on its own."""
    if key != "ind_id":
        prepared = prepared.withColumnRenamed(key, "ind_id")
    prepared = prepared.withColumn("ind_id", F.col("ind_id").cast("int"))
    return run_indicator(prepared, spec, lookup, base_col, level_cols, population=population,
                         ref_pop=ref_pop, extra_keys=["ind_id"], key_values={"ind_id": list(ind_ids or [])})


@dataclass
class Job:
    """One indicator (or a keyed batch) with its inputs."""

    spec: IndicatorSpec
    prepared: DataFrame
    lookup: DataFrame
    base_col: str
    level_cols: list
    population: DataFrame | None = None
    ref_pop: DataFrame | None = None
    keep_base: bool = False
    keyed: bool = False
    ind_ids: list | None = None
    extra: dict = field(default_factory=dict)


def run_jobs(jobs: list[Job]) -> DataFrame:
    """Union of all jobs' results in the published 9-column layout."""
    outs = []
    for j in jobs:
        if j.keyed:
            outs.append(run_keyed(j.prepared, j.spec, j.lookup, j.base_col, j.level_cols,
                                  population=j.population, ref_pop=j.ref_pop, ind_ids=j.ind_ids))
        else:
            outs.append(run_indicator(j.prepared, j.spec, j.lookup, j.base_col, j.level_cols,
                                      population=j.population, ref_pop=j.ref_pop, keep_base=j.keep_base))
    return union_all([o.select(*INDICATOR_COLUMNS) for o in outs])
