"""Population joins and population-only indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .geography import level_filter


def join_population_full(df: DataFrame, pop: DataFrame, keys, yearstart: int, yearend: int,
                         adp: bool = False, hscp: bool = True, pop_hscp: bool | None = None) -> DataFrame:
    """Full outer join of area counts with the population on ``keys``.

    Areas/years with population but no events get numerator 0; events with no
    population keep a null denominator and are dropped later by the rolling
    step.  Join keys are coalesced (USING join).  Both sides are aggregated
    area-level tables, so the shuffle is on small data.  ``pop_hscp`` filters
    partnership codes of the population separately from the data (the
    reference's rules differ for the two sides).
    """
    keys = list(keys)
    pop_hscp = hscp if pop_hscp is None else pop_hscp
    pop = level_filter(pop.where(F.col("year") >= yearstart), adp=adp, hscp=pop_hscp)
    left = df.drop("denominator") if "denominator" in df.columns else df
    joined = left.join(pop.select(*keys, "denominator"), on=keys, how="full")
    out = joined.where(F.col("year").between(yearstart, yearend))
    out = out.withColumn("numerator", F.coalesce(F.col("numerator"), F.lit(0.0)))
    return level_filter(out, adp=adp, hscp=hscp)


def join_population_right(df: DataFrame, pop: DataFrame, keys, yearstart: int,
                          yearend: int) -> DataFrame:
    """Right outer join to the population (deprivation runs): every population
    cell is kept, cells without events get numerator 0."""
    keys = list(keys)
    left = df.drop("denominator") if "denominator" in df.columns else df
    out = (left.join(pop.select(*keys, "denominator"), on=keys, how="right")
           .where(F.col("year").between(yearstart, yearend)))
    return out.withColumn("numerator", F.coalesce(F.col("numerator"), F.lit(0.0)))


def share_of_population(pop: DataFrame, slices: dict[str, tuple[int, int]],
                        keys=("year", "code"), age_col: str = "age") -> DataFrame:
    """Share of the all-age population in each age slice, all slices in one pass.

    Output: one row per (keys, slice) with numerator = slice population,
    denominator = all-age population.
    """
    aggs = [F.sum("denominator").alias("_all")]
    for name, (lo, hi) in slices.items():
        aggs.append(F.sum(F.when(F.col(age_col).between(lo, hi), F.col("denominator"))
                          .otherwise(0.0)).alias(f"_s_{name}"))
    wide = pop.groupBy(*keys).agg(*aggs)
    stack = F.explode(F.array(*[F.struct(F.lit(n).alias("slice"), F.col(f"_s_{n}").alias("numerator"))
                                for n in slices]))
    return (wide.select(*keys, F.col("_all").alias("denominator"), stack.alias("_s"))
            .select(*keys, "_s.slice", "_s.numerator", "denominator"))
