"""Quality-assurance queries over published indicator frames.

Each check is an aggregate over the (small) indicator result, so the checks
are cheap and return tables instead of a rendered report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import stats as S
from ..sources.refdata import EXPECTED_AREAS, SCOTLAND

GEO_TYPES = ["S00", "S08", "S12", "S11", "S37", "S02"]
CONTRACT = ["code", "ind_id", "year", "numerator", "rate", "lowci", "upci", "def_period", "trend_axis"]


def qa_geo_coverage(ind: DataFrame, geo_types=GEO_TYPES) -> DataFrame:
    """Number of areas per (year, geography type), one column per type."""
    t = ind.select("year", "code", F.substring("code", 1, 3).alias("geo_type"))
    out = (t.groupBy("year").pivot("geo_type", list(geo_types)).agg(F.countDistinct("code"))
           .fillna(0, subset=list(geo_types)))
    ok = F.lit(True)
    for g in geo_types:
        if g in EXPECTED_AREAS:
            ok = ok & ((F.col(g) == 0) | (F.col(g) == EXPECTED_AREAS[g]))
    return out.withColumn("matches_expected", ok)


def qa_row_delta(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows in the new result, the old one, and rows added - one aggregate."""
    both = new.select(F.lit(1).alias("_n")).unionByName(old.select(F.lit(0).alias("_n")))
    return (both.agg(F.count_if(F.col("_n") == 1).alias("new_rows"),
                     F.count_if(F.col("_n") == 0).alias("old_rows"))
            .withColumn("rows_added", F.col("new_rows") - F.col("old_rows")))


def merge_versions(new: DataFrame, old: DataFrame, keys=("code", "year"),
                   cols=("numerator", "rate", "lowci", "upci")) -> DataFrame:
    """Inner merge of two result versions with ``_new`` / ``_old`` suffixes."""
    n = new.select(*keys, *[F.col(c).alias(f"{c}_new") for c in cols])
    o = old.select(*keys, *[F.col(c).alias(f"{c}_old") for c in cols])
    return n.join(o, list(keys), "inner")


def qa_compare_old(new: DataFrame, old: DataFrame, codes, cols=("numerator", "rate", "lowci", "upci"),
                   digits: int = 3) -> DataFrame:
    """Relative change (new - old) / new, rounded half-even, for the listed areas."""
    m = merge_versions(new.where(F.col("code").isin(list(codes))), old.where(F.col("code").isin(list(codes))),
                       cols=cols)
    for c in cols:
        m = m.withColumn(f"{c}_match",
                         F.bround(S.div(F.col(f"{c}_new") - F.col(f"{c}_old"), F.col(f"{c}_new")), digits))
    return m


def qa_ci_contains(ind: DataFrame) -> DataFrame:
    """Number of rows whose rate lies outside [lowci, upci]."""
    return ind.agg(F.count_if((F.col("rate") < F.col("lowci")) | (F.col("rate") > F.col("upci")))
                   .alias("ci_error_total"))


def qa_scot_vs_boards(ind: DataFrame) -> DataFrame:
    """Latest year, national and board rows, with the national rate as reference."""
    latest = ind.select(F.max("year")).scalar()
    rows = ind.where((F.col("year") == latest) & ((F.col("code") == SCOTLAND) | F.col("code").startswith("S08")))
    scot = ind.where((F.col("year") == latest) & (F.col("code") == SCOTLAND)).select(F.max("rate")).scalar()
    return rows.select("code", "year", "rate", "lowci", "upci", scot.alias("scot_rate"))


def qa_area_reconcile(ind: DataFrame, codes) -> DataFrame:
    """Numerators of areas that should agree, side by side per year, with differences to the first."""
    codes = list(codes)
    wide = (ind.where(F.col("code").isin(codes)).groupBy("year").pivot("code", codes)
            .agg(F.sum("numerator")))
    for c in codes[1:]:
        wide = wide.withColumn(f"diff_{c}", F.col(codes[0]) - F.col(c))
    return wide


def qa_small_numbers(ind: DataFrame, below: float = 5, share: float = 0.4) -> DataFrame:
    """(geo type, year) cells where more than ``share`` of the rows have a numerator below ``below``."""
    g = (ind.groupBy(F.substring("code", 1, 3).alias("geo_type"), "year")
         .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("numerator") < below).alias("small")))
    g = g.withColumn("small_share", F.col("small") / F.col("rows"))
    return g.where(F.col("small_share") > share)


def qa_missing(ind: DataFrame, contract=CONTRACT) -> DataFrame:
    """Nulls per column and whether the columns follow the published contract."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ind.columns]
    ok = list(ind.columns) == list(contract)
    return ind.agg(*aggs).withColumn("columns_ok", F.lit(ok))


def qa_level_totals(ind: DataFrame) -> DataFrame:
    """Numerator at national, board and council level side by side per year."""
    c = F.col("code")
    return (ind.groupBy("year")
            .agg(F.sum(F.when(c == SCOTLAND, F.col("numerator"))).alias("scotland"),
                 F.sum(F.when(c.startswith("S08"), F.col("numerator"))).alias("boards"),
                 F.sum(F.when(c.startswith("S12"), F.col("numerator"))).alias("councils")))


def qa_child_parent(ind: DataFrame, parent_map: DataFrame, child: str = "ca", parent: str = "hb") -> DataFrame:
    """Each parent's numerator against the sum of its children's."""
    kids = (ind.join(parent_map.select(F.col(child).alias("code"), F.col(parent).alias("_parent")).distinct(),
                     "code", "inner")
            .groupBy(F.col("_parent").alias("code"), "year").agg(F.sum("numerator").alias("children")))
    return (ind.select("code", "year", "numerator").join(kids, ["code", "year"], "inner")
            .withColumn("difference", F.col("numerator") - F.col("children")))


def qa_metadata(ind: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Per indicator: year span and CI widths, checked against the catalogue."""
    width = F.col("upci") - F.col("lowci")
    s = (ind.groupBy("ind_id")
         .agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"),
              F.min(width).alias("min_ci_width"), F.max(width).alias("max_ci_width"),
              F.count(F.lit(1)).alias("rows")))
    out = s.join(catalogue, "ind_id", "left")
    return out.withColumn("years_ok", (F.col("first_year") >= F.col("yearstart"))
                          & (F.col("last_year") <= F.col("yearend")))


def qa_area_completeness(ind: DataFrame, expected_years: int) -> DataFrame:
    """Areas that do not have the expected number of years."""
    return (ind.groupBy("code").agg(F.countDistinct("year").alias("n_years"))
            .where(F.col("n_years") != expected_years))


def qa_trend_slice(ind: DataFrame, codes) -> DataFrame:
    """Time series for chosen areas with the CI band."""
    return ind.where(F.col("code").isin(list(codes))).select("code", "year", "rate", "lowci", "upci")


def observed(ind: DataFrame, name: str = "qa") -> tuple[DataFrame, Observation]:
    """``ind`` with the counts of three checks gathered while it is written: rows, nulls by column
    (:func:`qa_missing`) and rates outside their interval (:func:`qa_ci_contains`).

    No check reads the result again; ``Observation.get`` has the numbers once
    the one action that writes the frame is over.
    """
    seen = Observation(name)
    counts = [F.count(F.lit(1)).alias("rows"),
              F.count_if((F.col("rate") < F.col("lowci")) | (F.col("rate") > F.col("upci"))).alias("ci_error_total"),
              *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ind.columns]]
    return ind.observe(seen, *counts), seen
