"""Smoking-attributable counts: relative-risk index, prevalence joins, SAF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stats as S


BANDS = 19          # five-year age bands; band 0 stands for an unknown age


def _code_number(code) -> Column:
    """A 3-character diagnosis code (letter and two digits) as a number in code order; null for others."""
    c = F.col(code) if isinstance(code, str) else code
    number = (F.ascii(c) - 65) * 100 + F.substring(c, 2, 2).try_cast("int")
    return F.when(c.rlike("^[A-Z][0-9]{2}$"), number)


def code_range_index(rules: DataFrame, name: str) -> DataFrame:
    """Range rules as rows of a key: (sex_grp, code_no, band, ``name``).

    The rules' code ranges are expanded to the 3-character codes and their age
    ranges to the bands they hold (band 0, an unknown age, is in a rule that
    is open at both ends), so a look-up is an equi-join.  At most 26 x 100
    codes x 20 bands x the sexes.  Rules of one table that overlap with
    different risks give no answer and are an error when the index is read.
    """
    codes = F.sequence(_code_number("diag_lo"), _code_number("diag_hi"))
    ages = F.sequence(F.coalesce("age_lo", F.lit(1)), F.coalesce("age_hi", F.lit(BANDS)))
    open_ = F.col("age_lo").isNull() & F.col("age_hi").isNull()
    long = (rules.withColumn("code_no", F.explode(codes))
            .withColumn("band", F.explode(F.when(open_, F.concat(F.array(F.lit(0)), ages)).otherwise(ages))))
    one = F.when(F.min("rr") == F.max("rr"), F.min("rr")).otherwise(
        F.raise_error(F.lit("relative-risk rules overlap")).cast("double"))
    return long.groupBy("sex_grp", "code_no", "band").agg(one.alias(name))


def smoking_relative_risk(events: DataFrame, current_rules: DataFrame, ex_rules: DataFrame,
                          diag: str = "diag", sex: str = "sex_grp", age: str = "age_grp") -> DataFrame:
    """Relative risks of current and ex-smokers from two rule tables.

    Rules: (sex_grp, diag_lo, diag_hi, age_lo, age_hi, rr), non-overlapping
    within a table; a null age bound is open.  Both tables become one index
    by sex, code and band (:func:`code_range_index`), which is joined once, by
    its key.  No rule for ex-smokers means risk 0; events whose current risk
    is not positive are dropped, as in the reference.  ``diag`` holds
    3-character codes; other texts meet no rule.
    """
    key = ["sex_grp", "code_no", "band"]
    index = (code_range_index(current_rules, "current").where(F.col("current") > 0)
             .join(code_range_index(ex_rules, "ex"), key, "left").withColumn("ex", F.coalesce("ex", F.lit(0.0))))
    index = index.select(F.col("sex_grp").alias("_s"), F.col("code_no").alias("_c"), F.col("band").alias("_b"),
                         "current", "ex")
    on = ((F.col(sex) == F.col("_s")) & (_code_number(diag) == F.col("_c"))
          & (F.coalesce(F.col(age), F.lit(0)) == F.col("_b")))
    return events.join(F.broadcast(index), on).drop("_s", "_c", "_b")


def join_prevalence(counts: DataFrame, area_prev: DataFrame, age_prev: DataFrame,
                    band_of_age=None) -> DataFrame:
    """Area prevalence on (code, year?, sex), then age prevalence on (coarse band, sex).

    ``band_of_age`` maps ``age_grp`` to the coarse bands of ``age_prev``
    (column ``age_grp2``).
    """
    akeys = [c for c in ("code", "year", "sex_grp") if c in area_prev.columns]
    # prevalence tables are area / band dimensions: no hint, AQE broadcasts them after measuring
    out = counts.join(area_prev, akeys, "left")
    out = out.withColumn("age_grp2", band_of_age if band_of_age is not None else F.col("age_grp"))
    gkeys = [c for c in ("age_grp2", "year", "sex_grp") if c in age_prev.columns]
    return out.join(age_prev, gkeys, "left")


def attributable_fraction(df: DataFrame, keys=("code", "year", "sex_grp", "age_grp")) -> DataFrame:
    """SAF = (pc(RRc-1) + pe(RRe-1)) / (1 + pc(RRc-1) + pe(RRe-1)); numerator = sum n * SAF.

    Prevalences: area share of the national prevalence times the age-band
    prevalence, as proportions.
    """
    pc = S.div(F.col("current_area"), F.col("scot_current")) * F.col("current_age") / 100
    pe = S.div(F.col("ex_area"), F.col("scot_ex")) * F.col("ex_age") / 100
    excess = pc * (F.col("current") - 1) + pe * (F.col("ex") - 1)
    saf = S.div(excess, 1 + excess)
    return (df.withColumn("saf", saf).groupBy(*keys)
            .agg(F.sum(F.col("n") * F.col("saf")).alias("numerator")))
