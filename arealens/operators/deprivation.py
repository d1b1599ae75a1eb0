"""Deprivation lookups: population-weighted quintiles, joins to a lookup and
SIMD releases by year, access-deprived population, deprived young people.

Cumulative populations over the deprivation rank use the range-partitioned
running sum of :mod:`.sequence`, so neither the national ranking (one global
order) nor one large board or year is ever computed in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sequence


def quintile_cut(cum: Column, total: Column, lowest_label: int = 1) -> Column:
    """Right-closed cuts at 20/40/60/80% of the total population.

    ``lowest_label=1`` labels the lowest rank 1 (most deprived = 1, as the
    shared deprivation files do); ``lowest_label=5`` labels it 5.
    """
    q = (F.when(5 * cum <= total, 1).when(5 * cum <= 2 * total, 2).when(5 * cum <= 3 * total, 3)
         .when(5 * cum <= 4 * total, 4).otherwise(5))
    return q if lowest_label == 1 else (6 - q)


def weighted_quintile(df: DataFrame, pop: str, order_cols, by=(), out: str = "quintile",
                      lowest_label: int = 1) -> DataFrame:
    """Population-weighted quintile of a rank (not ``ntile``): cumulative population
    in rank order, cut at fifths of the total, per ``by`` group (or nationally)."""
    cum = f"_cum_{out}"
    ranked = sequence.running_sums(df, list(by), order_cols, {cum: F.col(pop)}, totals=True)
    return (ranked.withColumn(out, quintile_cut(F.col(cum), F.col(f"{cum}_total"), lowest_label))
            .drop(cum, f"{cum}_total"))


def join_simd_year(facts: DataFrame, lookup: DataFrame, keys=("datazone", "year")) -> DataFrame:
    """Left join to a lookup versioned by year: every fact keeps its row, unmatched ones get nulls.

    The lookup holds a row per datazone and year, so it grows with the input,
    but its few bytes in parquet pass for a small table (0.9 million datazones
    over 7 years: 11 MB of files, 1.2 GB as a broadcast in every executor).
    Both sides are therefore shuffled and merged, sorting within one partition.
    """
    return facts.join(lookup.hint("merge"), list(keys), "left")


def simd_versions(spark, versions) -> DataFrame:
    """(year, version) rows from (version, year_from, year_to) intervals.

    Expanding the intervals turns the interval join into an equi-join on
    year against a table of a few dozen rows.
    """
    v = spark.createDataFrame(versions, "version string, year_from int, year_to int")
    return v.select(F.explode(F.sequence("year_from", "year_to")).alias("year"), "version")


def simd_version_by_year(facts: DataFrame, versions: DataFrame, releases: DataFrame,
                         rank_cols: dict[str, str], key: str = "datazone") -> DataFrame:
    """Attach the rank of the SIMD release valid in each fact's year.

    ``releases`` has one row per area with one rank column per release;
    ``rank_cols`` maps version -> rank column.
    """
    f = facts.join(versions, "year", "left")
    f = f.join(releases, key, "left")
    pick = None
    for v, c in rank_cols.items():
        pick = (F.when(F.col("version") == v, F.col(c)) if pick is None
                else pick.when(F.col("version") == v, F.col(c)))
    return f.withColumn("rank", pick).drop(*rank_cols.values())


def access_deprived(pop_rank: DataFrame, share: float = 0.15, by=("year",), rank: str = "rank",
                    pop: str = "pop", tiebreak: str = "datazone") -> DataFrame:
    """Numerator = population of the areas that, in rank order, fit within
    ``share`` of the total population of their year; else 0."""
    ranked = sequence.running_sums(pop_rank, list(by), [rank, tiebreak], {"_cum": F.col(pop)},
                                   frame="rows", totals=True)
    limit = F.col("_cum_total") * share
    return (ranked.withColumn("numerator", F.when(limit - F.col("_cum") >= 0, F.col(pop))
                              .otherwise(F.lit(0)).cast("double"))
            .drop("_cum", "_cum_total"))


def deprived_population(pop: DataFrame, flags: DataFrame, key: str = "datazone") -> DataFrame:
    """Population rows of the areas listed in ``flags`` (semi join; no client-side lists)."""
    return pop.join(flags.select(key).distinct(), key, "left_semi")
