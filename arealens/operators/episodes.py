"""Hospital episodes -> continuous stays -> people.

Every collapse is a ``groupBy`` with ordered ``min_by`` / ``max_by``
aggregates: one shuffle on the stay or person key, with partial aggregation
in the map tasks, so a person or stay with a huge number of episodes never
lands whole in one task.  Ties are broken by a unique column (``uri``) so
"first" and "last" are deterministic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import fin_year
from . import sequence


def diag_match(cols, pattern: str, exclude: str | None = None) -> Column:
    """Regex (unanchored unless the pattern says ``^``) over one or more diagnosis columns."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    hit = reduce(lambda a, b: a | b, [F.coalesce(F.col(c).rlike(pattern), F.lit(False)) for c in cols])
    if exclude:
        hit = hit & ~reduce(lambda a, b: a | b,
                            [F.coalesce(F.col(c).rlike(exclude), F.lit(False)) for c in cols])
    return hit


def diag_in_range(cols, lo: str, hi: str) -> Column:
    """Lexicographic code range in any of the diagnosis columns."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return reduce(lambda a, b: a | b,
                  [F.coalesce(F.col(c).between(lo, hi), F.lit(False)) for c in cols])


def semi_stay(episodes: DataFrame, qualifies: Column, stay_keys=("link_no", "cis_marker")) -> DataFrame:
    """All episodes of every stay in which at least one episode qualifies.

    The per-stay flag is an aggregate (partial-aggregated, skew-safe) and the
    episodes are kept with a left-semi join, which AQE can split when one stay
    is skewed.
    """
    keys = list(stay_keys)
    flagged = (episodes.where(qualifies).select(*keys).distinct())
    return episodes.join(flagged, on=keys, how="left_semi")


def stay_collapse(episodes: DataFrame, stay_keys=("link_no", "cis_marker"),
                  order_cols=("admission_date", "discharge_date", "uri"),
                  first_cols=("age", "sex_grp", "pc7"), last_col: str = "discharge_date",
                  stay_year: str = "fin_last_discharge", qualifies: Column | None = None) -> DataFrame:
    """One row per stay: first attributes in episode order, last discharge, stay year.

    ``qualifies`` keeps the stays of which at least one episode qualifies, in
    the same aggregate (:func:`semi_stay` returns their episodes instead).

    ``stay_year``: ``fin_last_discharge`` (financial year of the last
    discharge), ``cal_last_discharge``, ``fin_first_admission``.
    """
    order = F.struct(*[F.col(c) for c in order_cols])
    aggs = [F.min_by(F.struct(*[F.col(c) for c in first_cols]), order).alias("_first"),
            F.max_by(F.col(last_col), order).alias("last_discharge"),
            F.min_by(F.col(order_cols[0]), order).alias("first_admission")]
    if qualifies is not None:
        aggs.append(F.bool_or(qualifies).alias("_qualifies"))
    out = episodes.groupBy(*stay_keys).agg(*aggs)
    if qualifies is not None:
        out = out.where("_qualifies")
    out = out.select(*stay_keys, *[F.col(f"_first.{c}").alias(c) for c in first_cols],
                     "first_admission", "last_discharge")
    year = {"fin_last_discharge": fin_year("last_discharge"),
            "cal_last_discharge": F.year("last_discharge"),
            "fin_first_admission": fin_year("first_admission")}[stay_year]
    return out.withColumn("year", year.cast("int"))


def stay_collapse_windowed(episodes: DataFrame, stay_keys=("link_no", "cis_marker"),
                           order_cols=("admission_date", "discharge_date", "uri"),
                           first_cols=("age", "sex_grp")) -> DataFrame:
    """``SELECT DISTINCT`` of FIRST_VALUE / MIN / MAX over a stay window, as one aggregate."""
    order = F.struct(*[F.col(c) for c in order_cols])
    out = (episodes.groupBy(*stay_keys)
           .agg(F.min_by(F.struct(*first_cols), order).alias("_f"),
                F.min("admission_date").alias("admission_date"),
                F.max("discharge_date").alias("discharge_date")))
    return out.select(*stay_keys, *[F.col(f"_f.{c}").alias(c) for c in first_cols],
                      "admission_date", "discharge_date")


def stay_collapse_min(episodes: DataFrame, stay_keys=("link_no", "cis_marker"),
                      min_cols=("age", "sex_grp", "pc7", "admission_date"),
                      max_cols=("discharge_date",)) -> DataFrame:
    """One row per stay by plain MIN / MAX of each attribute."""
    return episodes.groupBy(*stay_keys).agg(*[F.min(c).alias(c) for c in min_cols],
                                            *[F.max(c).alias(c) for c in max_cols])


def person_year_last(stays: DataFrame, person: str = "link_no", year_col: str = "year",
                     order_col: str = "discharge_date", attrs=("age", "sex_grp", "pc7")) -> DataFrame:
    """Per (person, year): each attribute from the latest discharge; ties -> the largest value."""
    return (stays.groupBy(person, year_col)
            .agg(*[F.max_by(F.col(a), F.struct(F.col(order_col), F.col(a))).alias(a) for a in attrs],
                 F.max(order_col).alias(order_col)))


def person_year_first(stays: DataFrame, person: str = "link_no", year_col: str = "year",
                      order_cols=("admission_date", "discharge_date", "uri"), attrs=None) -> DataFrame:
    """The first stay per (year, person) in ``order_cols`` order (unique tiebreak last)."""
    attrs = attrs or [c for c in stays.columns if c not in (person, year_col)]
    order = F.struct(*[F.col(c) for c in order_cols])
    first = stays.groupBy(year_col, person).agg(F.min_by(F.struct(*attrs), order).alias("_f"))
    return first.select(year_col, person, *[F.col(f"_f.{a}").alias(a) for a in attrs])


def stay_or_death_union(stays: DataFrame, deaths: DataFrame, keys=("link_no", "cis_marker", "year"),
                        order_cols=("admission_date", "uri"), attrs=("age", "sex_grp", "source")) -> DataFrame:
    """Deaths (null stay marker) appended to stays; the first row per (person, stay, year).

    ``groupBy`` treats the null stay marker as a key value, so each death
    year of a person collapses to one row as in the reference.
    """
    both = stays.unionByName(deaths, allowMissingColumns=True)
    order = F.struct(*[F.col(c) for c in order_cols])
    out = both.groupBy(*keys).agg(F.min_by(F.struct(*attrs), order).alias("_f"))
    return out.select(*keys, *[F.col(f"_f.{a}").alias(a) for a in attrs])


def washout_incidence(stays: DataFrame, person: str = "link_no", admission: str = "admission_date",
                      discharge: str = "discharge_date", tiebreak: str = "cis_marker",
                      washout: float = 10, unit_days: float = 365) -> DataFrame:
    """Flag new cases: no earlier stay, or ``days / unit_days >= washout`` since the
    *previous row's* discharge (10 years of 365 days in the reference).

    The previous row comes from :func:`sequence.previous_values`, so a person
    with a very long history is split across tasks.
    """
    prev = sequence.previous_values(stays, [person], [admission, tiebreak], [discharge], prefix="prev_")
    gap = F.datediff(F.col(admission), F.col(f"prev_{discharge}")) / F.lit(float(unit_days))
    return prev.withColumn("new_case", F.col(f"prev_{discharge}").isNull() | (gap >= washout))


def incidence(stays: DataFrame, deaths: DataFrame | None = None, person: str = "link_no",
              admission: str = "admission_date", discharge: str = "discharge_date", order_cols=("cis_marker",),
              washout_days: int = 3650, age: str = "age", older_than: int | None = 15, year: str = "year",
              after_year: int | None = 2001) -> DataFrame:
    """First admissions, or deaths, of people without a discharge in the ``washout_days`` before.

    ``deaths`` (the columns of ``stays`` without the discharge) are appended
    as stays of no length.  The gap runs from the latest of all earlier
    discharges, which a long stay that began earlier may hold, not from that
    of the previous row (:func:`washout_incidence` does that).  People of
    ``older_than`` years or less leave before the gaps are taken, rows of
    years up to ``after_year`` afterwards, as in the reference.
    """
    rows = stays
    if deaths is not None:
        rows = rows.unionByName(deaths.withColumn(discharge, F.col(admission)), allowMissingColumns=True)
    if older_than is not None:
        rows = rows.where(F.col(age) > older_than)
    rows = sequence.running_values(rows, [person], [admission, *order_cols], {"earlier_discharge": ("max", F.col(discharge))})
    gap = F.datediff(F.col(admission), F.col("earlier_discharge"))
    fresh = rows.where(F.col("earlier_discharge").isNull() | (gap >= washout_days))
    return fresh if after_year is None else fresh.where(F.col(year) > after_year)


def multi_admission(stays: DataFrame, area_cols, person: str = "link_no", year_col: str = "year",
                    order_cols=("admission_date", "cis_marker"), attrs=("sex_grp", "age"),
                    old_age: int = 65, min_admissions: int = 2) -> DataFrame:
    """Per (person, year, area at every level): admissions and first attributes.

    All area levels are unpivoted once, so the six per-level jobs of the
    reference become one aggregate.  Output adds ``ea`` (1 per person) and
    ``ma`` (1 when aged ``old_age``+ with ``min_admissions``+ admissions).
    """
    from .geography import geo_unpivot

    long = geo_unpivot(stays, area_cols).where(F.col("code").isNotNull())
    order = F.struct(*[F.col(c) for c in order_cols])
    per = (long.groupBy(person, year_col, "code")
           .agg(F.count(F.lit(1)).alias("admissions"), F.min_by(F.struct(*attrs), order).alias("_f")))
    per = per.select(person, year_col, "code", "admissions", *[F.col(f"_f.{a}").alias(a) for a in attrs])
    return (per.withColumn("ea", F.lit(1))
            .withColumn("ma", ((F.col("age") >= old_age) & (F.col("admissions") >= min_admissions))
                        .cast("int")))


def event_count(df: DataFrame, keys, weight: str | None = None) -> DataFrame:
    """Count events (or sum a pre-counted column) by ``keys`` as ``numerator``."""
    agg = F.count(F.lit(1)).cast("double") if weight is None else F.sum(weight).cast("double")
    return df.groupBy(*keys).agg(agg.alias("numerator"))
