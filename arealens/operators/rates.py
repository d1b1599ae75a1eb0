"""Rates, percentages and their confidence intervals, plus the final null policy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats as S
from ..functions.dates import time_fix
from ..sources.refdata import epop_table


def rate_percent(df: DataFrame, round_ci: int | None = 2) -> DataFrame:
    """Percentage n/d*100 with Wilson 95% interval clamped to [0, 100].

    CIs are rounded half-even to ``round_ci`` places (indicator runs) or kept
    unrounded (``None``, inequality runs).
    """
    rate, low, up = S.wilson_bounds("numerator", "denominator")
    return df.withColumns({"rate": rate, "lowci": S.clamp_pct_low(low, round_ci),
                           "upci": S.clamp_pct_up(up, round_ci)})


def rate_crude(df: DataFrame, per: float = 100000) -> DataFrame:
    """Crude rate n/d*per with Byar's Poisson interval."""
    n, d = F.col("numerator"), F.col("denominator")
    return df.withColumns({"rate": S.div(n, d) * per, "lowci": S.div(S.byar_lower(n), d) * per,
                           "upci": S.div(S.byar_upper(n), d) * per})


def add_epop(df: DataFrame, epop_age: str) -> DataFrame:
    """Attach the standard-population weight of each age band (null outside the cut)."""
    w = F.broadcast(epop_table(df.sparkSession, epop_age).select("age_grp", "epop"))
    return df.join(w, "age_grp", "left")


def rate_easr(df: DataFrame, epop_total: float, group_keys=("year", "code")) -> DataFrame:
    """Directly age-sex standardised rate per 100,000 with Dobson/Byar interval.

    Input: one row per stratum (sex, age band) with numerator, denominator,
    epop.  Strata with a zero denominator or no weight contribute 0.  Output:
    one row per ``group_keys`` with summed numerator / denominator and rates.
    """
    n, d, w = F.col("numerator"), F.col("denominator"), F.col("epop")
    easr_first = F.coalesce(S.no_nan(S.div(n * w, d)), F.lit(0.0))
    var_dsr = F.coalesce(S.no_nan(S.div(n * w * w, d * d)), F.lit(0.0))
    agg = (df.groupBy(*group_keys)
           .agg(F.coalesce(F.sum("numerator"), F.lit(0.0)).alias("numerator"),
                F.coalesce(F.sum("denominator"), F.lit(0.0)).alias("denominator"),
                F.sum(easr_first).alias("_easr_first"),
                F.sum(var_dsr).alias("_var_dsr")))
    n = F.col("numerator")
    easr = F.col("_easr_first") / F.lit(float(epop_total))
    var = F.col("_var_dsr") / F.lit(float(epop_total) ** 2)
    spread = F.sqrt(S.div(var, n))
    return (agg.withColumns({"rate": easr * 100000,
                             "lowci": (easr + spread * (S.byar_lower(n) - n)) * 100000,
                             "upci": (easr + spread * (S.byar_upper(n) - n)) * 100000})
            .drop("_easr_first", "_var_dsr"))


def roll_reference_population(pop: DataFrame, time_agg: int, keys=("code",)) -> DataFrame:
    """Reference population averaged over the same periods as the indicator (``est_pop``)."""
    tf = time_fix(time_agg)
    w = Window.partitionBy(*keys).orderBy("year").rowsBetween(-(time_agg - 1), 0)
    return (pop.select(*keys, "year",
                       F.when(F.count("denominator").over(w) == time_agg,
                              F.avg("denominator").over(w)).alias("est_pop"))
            .where(F.col("est_pop").isNotNull())
            .withColumn("year", (F.col("year") - tf).cast("int")))


def rate_perc_pcf(df: DataFrame, ref_pop: DataFrame, time_agg: int, keys=("code",)) -> DataFrame:
    """Percentage with a finite-population-corrected normal interval.

    ``ref_pop`` (year, *keys, denominator) is rolled like the indicator; a
    missing reference population counts as 0 (factor 1); a denominator above
    the population means the whole population was assessed (zero-width CI).
    """
    est = roll_reference_population(ref_pop, time_agg, keys)
    out = df.join(est, ["year", *keys], "left")
    P = F.coalesce(F.col("est_pop"), F.lit(0.0))
    d = F.col("denominator")
    pcf = F.when(P > 0, F.sqrt(S.div(P - d, P - 1))).when(P == 0, F.lit(1.0))
    rate = S.div(F.col("numerator"), d) * 100
    ci = F.when(P < d, F.lit(0.0)).when(P >= d, S.Z * F.sqrt(S.div(rate * (100 - rate), d) * pcf))
    return (out.withColumns({"rate": rate, "lowci": S.clamp_pct_low(rate - ci),
                             "upci": S.clamp_pct_up(rate + ci)})
            .drop("est_pop"))


def finalise_nulls(df: DataFrame, cols=("rate", "lowci", "upci")) -> DataFrame:
    """Null / NaN rate and CIs -> 0, negative lower CI -> 0."""
    new = {c: S.zero_if_missing(c) for c in cols}
    if "lowci" in new:
        new["lowci"] = F.when(new["lowci"] < 0, F.lit(0.0)).otherwise(new["lowci"])
    return df.withColumns(new)


def count_only(df: DataFrame) -> DataFrame:
    """Numerator-only indicator: rate and CIs are published as NULL."""
    nul = F.lit(None).cast("double")
    return df.withColumn("rate", nul).withColumn("lowci", nul).withColumn("upci", nul)


def round_estimate(df: DataFrame, numerator_to: int = -1, rate_to: int = 0) -> DataFrame:
    """Published estimates: numerator to the nearest 10, rates to whole numbers (half-even)."""
    out = df.withColumn("numerator", F.bround("numerator", numerator_to))
    for c in ("rate", "lowci", "upci"):
        if c in df.columns:
            out = out.withColumn(c, F.bround(c, rate_to))
    return out


def zero_to_null(df: DataFrame, cols) -> DataFrame:
    """Zeros mean 'not available' in some published tables."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.nullif(F.col(c), F.lit(0).cast(df.schema[c].dataType)))
    return out
