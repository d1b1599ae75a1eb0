"""The inequality run: prepared fact -> per-quintile rates + SII/RII/PAR, one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import deprivation as D
from ..operators import inequality as I
from ..operators import periods as P
from ..operators import population as POP
from ..operators import rates as R
from ..sources.tables import read_prepared
from .spec import IndicatorSpec

INEQUALITY_COLUMNS = (["code", "year", "quintile", "quint_type", "numerator", "denominator",
                       "rate", "lowci", "upci"] + I.MEASURE_COLS + ["ind_id", "trend_axis", "def_period"])
QKEYS = ["code", "quintile", "quint_type"]


def formatted(prepared: DataFrame, spec: IndicatorSpec, lookup: DataFrame,
              population: DataFrame | None = None) -> DataFrame:
    """Quintile roll-up with totals, population join, rolling periods, weights."""
    std = spec.measure == "stdrate"
    if std and population is None:
        raise ValueError(f"ind {spec.ind_id}: a standardised rate needs a population by quintile, sex and age")
    strata = ["sex_grp", "age_grp"] if std else []
    data = read_prepared(prepared, spec.yearstart, spec.yearend)
    joined = D.join_simd_year(data, lookup)
    q = I.quintile_rollup(joined, keys=["year", *strata])
    if population is not None:
        pop = population if std else population.where(F.col("year") >= spec.yearstart)
        out = POP.join_population_right(q, pop, ["year", *QKEYS, *strata], spec.yearstart, spec.yearend)
    else:
        out = (q.where(F.col("year").between(spec.yearstart, spec.yearend))
               .withColumn("numerator", F.coalesce(F.col("numerator"), F.lit(0.0))))
    out = P.rolling_mean(out, [*QKEYS, *strata], spec.time_agg)
    if std and population is not None:
        out = R.add_epop(out, spec.epop_age)
    return out


def quintile_rates(df: DataFrame, spec: IndicatorSpec, ref_pop: DataFrame | None = None) -> DataFrame:
    if spec.measure == "stdrate":
        return R.rate_easr(df, spec.standard_total, group_keys=["year", *QKEYS])
    if spec.measure == "percent":
        return R.rate_percent(df, round_ci=None)
    if spec.measure == "crude":
        return R.rate_crude(df, spec.crude_rate)
    if ref_pop is None:
        raise ValueError("perc_pcf needs a reference population")
    return R.rate_perc_pcf(df, ref_pop, spec.time_agg, keys=QKEYS)


def run_deprivation(prepared: DataFrame, spec: IndicatorSpec, lookup: DataFrame,
                    population: DataFrame | None = None, ref_pop: DataFrame | None = None) -> DataFrame:
    rt = quintile_rates(formatted(prepared, spec, lookup, population), spec, ref_pop)
    rt = rt.select("code", "year", "quintile", "quint_type", "numerator", "denominator",
                   "rate", "lowci", "upci")
    out = I.attach_to_totals(rt)
    out = R.finalise_nulls(out).withColumn("ind_id", F.lit(spec.ind_id))
    out = P.add_period_labels(out, spec.year_type, spec.time_agg, spec.legacy_five_year_labels)
    return out.select(*INEQUALITY_COLUMNS)
