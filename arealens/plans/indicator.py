"""The indicator run: prepared fact -> published indicator, as one lazy plan.

Stage one (``formatted``): restrict years at the scan, roll up to every area
level, join the population, zero-fill, filter levels, average over rolling
periods, attach standard-population weights.  Stage two (``finalised``):
rates and intervals by measure, null policy, period labels, the fixed output
columns.  Nothing is written in between; callers persist or checkpoint only
when several branches read the same stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import geography as G
from ..operators import periods as P
from ..operators import population as POP
from ..operators import rates as R
from ..sources.tables import read_prepared
from .spec import IndicatorSpec

INDICATOR_COLUMNS = ["code", "ind_id", "year", "numerator", "rate", "lowci", "upci",
                     "def_period", "trend_axis"]


def formatted(prepared: DataFrame, spec: IndicatorSpec, lookup: DataFrame, base_col: str,
              level_cols, population: DataFrame | None = None,
              keep_base: bool = False, extra_keys=(), key_values: dict[str, list] | None = None) -> DataFrame:
    """Stage one of an indicator run.

    ``extra_keys`` carry additional grouping columns (e.g. an indicator or
    category key) so several indicators run in one job.  With a population
    ``key_values`` lists each key's values: every one of them gets the whole
    population, so areas and years without events are zero-filled per value.
    """
    std = spec.measure == "stdrate"
    if std and population is None:
        raise ValueError(f"ind {spec.ind_id}: a standardised rate needs a population by sex and age band")
    strata = ["sex_grp", "age_grp"] if std else []
    keys = ["year", *strata, *extra_keys]
    # rows after yearend are dropped before rolling, so both bounds go to the scan
    data = read_prepared(prepared, spec.yearstart, spec.yearend)
    if spec.geography == "all":
        # the prepared fact already carries every area code: sum duplicates only
        measures = [m for m in ("numerator", "denominator") if m in data.columns]
        rolled = data.groupBy("code", *keys).agg(
            *[F.coalesce(F.sum(m), F.lit(0.0)).cast("double").alias(m) for m in measures])
    else:
        rolled = G.geo_rollup(data, lookup, base_col, level_cols, keys=keys,
                              keep_base=keep_base or spec.geography == "council")
    # partnership (S37) codes: dropped from the data only for council-based runs; from the
    # population also for 'all'-geography standardised runs
    hscp_filter = spec.hscp or spec.geography != "council"
    pop_hscp = spec.hscp or not (spec.geography == "council" or (std and spec.geography == "all"))
    if population is not None:
        pop = population.withColumn("year", F.col("year").cast("int"))
        for k in extra_keys:
            if not (key_values or {}).get(k):
                raise ValueError(f"a run keyed by {k} with a population needs the values of {k}")
            kind = dict(prepared.dtypes)[k]
            pop = pop.withColumn(k, F.explode(F.array(*[F.lit(v).cast(kind) for v in key_values[k]])))
        out = POP.join_population_full(rolled, pop, ["year", "code", *strata, *extra_keys], spec.yearstart,
                                       spec.yearend, adp=spec.adp, hscp=hscp_filter, pop_hscp=pop_hscp)
    else:
        out = rolled.where(F.col("year").between(spec.yearstart, spec.yearend))
        out = out.withColumn("numerator", F.coalesce(F.col("numerator"), F.lit(0.0)))
        out = G.level_filter(out, adp=spec.adp, hscp=hscp_filter)
    out = P.rolling_mean(out, ["code", *strata, *extra_keys], spec.time_agg, strict_years=spec.strict_years)
    if std and population is not None:
        out = R.add_epop(out, spec.epop_age)
    return out


def rates(df: DataFrame, spec: IndicatorSpec, ref_pop: DataFrame | None = None,
          extra_keys=(), round_percent_ci: int | None = 2) -> DataFrame:
    """Rates and intervals for the spec's measure."""
    if spec.measure == "stdrate":
        return R.rate_easr(df, spec.standard_total, group_keys=["year", "code", *extra_keys])
    if spec.measure == "percent":
        return R.rate_percent(df, round_ci=round_percent_ci)
    if spec.measure == "crude":
        return R.rate_crude(df, spec.crude_rate)
    if ref_pop is None:
        raise ValueError("perc_pcf needs a reference population")
    return R.rate_perc_pcf(df, ref_pop, spec.time_agg, keys=["code", *[k for k in extra_keys if k in ref_pop.columns]])


def finalised(df: DataFrame, spec: IndicatorSpec, ref_pop: DataFrame | None = None,
              extra_keys=()) -> DataFrame:
    """Stage two: rates, null policy, labels, fixed columns."""
    out = R.finalise_nulls(rates(df, spec, ref_pop, extra_keys))
    if "ind_id" not in extra_keys:  # a batch of indicators carries ind_id as a key
        out = out.withColumn("ind_id", F.lit(spec.ind_id))
    out = P.add_period_labels(out, spec.year_type, spec.time_agg, spec.legacy_five_year_labels)
    return out.select(*[k for k in extra_keys if k != "ind_id"], *INDICATOR_COLUMNS)


def run_indicator(prepared: DataFrame, spec: IndicatorSpec, lookup: DataFrame, base_col: str,
                  level_cols, population: DataFrame | None = None, ref_pop: DataFrame | None = None,
                  keep_base: bool = False, extra_keys=(), key_values: dict[str, list] | None = None) -> DataFrame:
    f = formatted(prepared, spec, lookup, base_col, level_cols, population, keep_base, extra_keys, key_values)
    return finalised(f, spec, ref_pop, extra_keys)
