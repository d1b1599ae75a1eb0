"""Hand-computed micro-frames for every formula."""

import math

import pytest
from pyspark.sql import functions as F

from arealens.functions.age import age_band
from arealens.functions.dates import fin_year, period_labels
from arealens.operators import periods as P
from arealens.operators import rates as R
from arealens.sources.refdata import EPOP_WEIGHTS, epop_total


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_percent_ordinary(spark):
    df = spark.createDataFrame([(10.0, 100.0)], "numerator double, denominator double")
    (rate, low, up), = rows(R.rate_percent(df), "rate", "lowci", "upci")
    assert rate == pytest.approx(10.0)
    assert (low, up) == (5.52, 17.44)


def test_percent_edges_then_finalise(spark):
    df = spark.createDataFrame([(0.0, 50.0), (50.0, 50.0), (0.0, 0.0)], "numerator double, denominator double")
    out = rows(R.finalise_nulls(R.rate_percent(df)), "numerator", "denominator", "rate", "lowci", "upci")
    by = {(n, d): (r, lo, up) for n, d, r, lo, up in out}
    assert by[(0.0, 50.0)][1] == 0.0
    assert by[(50.0, 50.0)][2] == 100.0
    assert by[(0.0, 0.0)] == (0.0, 0.0, 0.0)


def test_crude_zero_numerator(spark):
    df = spark.createDataFrame([(0.0, 1000.0)], "numerator double, denominator double")
    (rate, low, up), = rows(R.finalise_nulls(R.rate_crude(df, 1000)), "rate", "lowci", "upci")
    assert rate == 0.0 and low == 0.0
    assert up == pytest.approx(1 * (1 - 1 / 9 + 1.96 / 3) ** 3, rel=1e-9)


def test_easr_zero_denominator_stratum_contributes_zero(spark):
    df = spark.createDataFrame(
        [(2000, "A", 1, 1, 5.0, 0.0, 5000.0), (2000, "A", 1, 2, 10.0, 1000.0, 5500.0)],
        "year int, code string, sex_grp int, age_grp int, numerator double, denominator double, epop double")
    (rate,), = rows(R.rate_easr(df, 10500), "rate")
    assert rate == pytest.approx(10.0 * 5500 / 1000 / 10500 * 1e5)


def test_easr_matches_hand_computation(spark):
    data = [(1, 1, 3.0, 200.0, 5000.0), (1, 2, 7.0, 300.0, 5500.0), (2, 1, 4.0, 250.0, 5000.0)]
    df = spark.createDataFrame([(2000, "A", *r) for r in data],
                               "year int, code string, sex_grp int, age_grp int, numerator double, "
                               "denominator double, epop double")
    T = 15500.0
    e = sum(n * w / d for _, _, n, d, w in data)
    v = sum(n * w * w / (d * d) for _, _, n, d, w in data)
    n = sum(r[2] for r in data)
    lo = n * (1 - 1 / (9 * n) - 1.96 / (3 * math.sqrt(n))) ** 3
    up = (n + 1) * (1 - 1 / (9 * (n + 1)) + 1.96 / (3 * math.sqrt(n + 1))) ** 3
    easr, var = e / T, v / T ** 2
    (rate, low, upp), = rows(R.rate_easr(df, T), "rate", "lowci", "upci")
    assert rate == pytest.approx(easr * 1e5)
    assert low == pytest.approx((easr + math.sqrt(var / n) * (lo - n)) * 1e5)
    assert upp == pytest.approx((easr + math.sqrt(var / n) * (up - n)) * 1e5)


def test_pcf_denominator_above_population(spark):
    df = spark.createDataFrame([(2000, "A", 5.0, 20.0)], "year int, code string, numerator double, denominator double")
    pop = spark.createDataFrame([(2000, "A", 10.0)], "year int, code string, denominator double")
    (rate, low, up), = rows(R.rate_perc_pcf(df, pop, 1), "rate", "lowci", "upci")
    assert rate == low == up == 25.0


def test_pcf_missing_population_is_factor_one(spark):
    df = spark.createDataFrame([(2000, "A", 5.0, 20.0)], "year int, code string, numerator double, denominator double")
    pop = spark.createDataFrame([(1990, "B", 10.0)], "year int, code string, denominator double")
    (rate, low, up), = rows(R.rate_perc_pcf(df, pop, 1), "rate", "lowci", "upci")
    # population 0 < denominator -> zero-width interval (the factor-1 branch only matters when d = 0)
    assert rate == low == up == 25.0


def test_rolling_gap_counts_rows(spark):
    df = spark.createDataFrame([("A", 1, 1.0, 10.0), ("A", 2, 2.0, 10.0), ("A", 4, 3.0, 10.0)],
                               "code string, year int, numerator double, denominator double")
    out = rows(P.rolling_mean(df, ["code"], 3), "year", "numerator")
    assert out == [(3, 2.0)]


def test_rolling_null_denominator_drops_row(spark):
    df = spark.createDataFrame([("A", 1, 1.0, 10.0), ("A", 2, 2.0, None), ("A", 3, 3.0, 10.0), ("A", 4, 3.0, 10.0),
                                ("A", 5, 3.0, 10.0)],
                               "code string, year int, numerator double, denominator double")
    out = sorted(rows(P.rolling_mean(df, ["code"], 3), "year"))
    assert out == [(4,)]  # windows ending at 3 and 4 contain the null; only 5 -> centre year 4


def test_rolling_mean_of_constant_is_constant(spark):
    df = spark.createDataFrame([("A", y, 7.0, 70.0) for y in range(2000, 2010)],
                               "code string, year int, numerator double, denominator double")
    for n in (1, 2, 3, 5):
        assert {r for r in rows(P.rolling_mean(df, ["code"], n), "numerator")} == {(7.0,)}


@pytest.mark.parametrize("agg,axis", [(1, "2010/11"), (2, "2009/10-2010/11"), (3, "2009/10-2011/12"),
                                      (5, "2008/09-2012/13")])
def test_financial_labels(spark, agg, axis):
    df = spark.createDataFrame([(2010,)], "year int")
    ta, dp = period_labels("year", "financial", agg)
    (got, period), = rows(df.select(ta.alias("a"), dp.alias("p")), "a", "p")
    assert got == axis
    assert period.startswith(axis.replace("-", " to "))


def test_financial_five_year_legacy_label(spark):
    df = spark.createDataFrame([(2010,)], "year int")
    ta, _ = period_labels("year", "financial", 5, legacy_five_year=True)
    assert rows(df.select(ta.alias("a")), "a") == [("2008/10-2012/13",)]


def test_calendar_and_snapshot_labels(spark):
    df = spark.createDataFrame([(2010,)], "year int")
    for yt, n, axis, period in [("calendar", 3, "2009-2011", "2009 to 2011 calendar years; 3-year aggregates"),
                                ("calendar", 2, "2009-2010", "2009 to 2010 calendar years; 2-year aggregates"),
                                ("calendar", 1, "2010", "2010 calendar year"),
                                ("survey", 3, "2010", "2010 survey year"),
                                ("July snapshot", 1, "2010", "2010 July snapshot")]:
        ta, dp = period_labels("year", yt, n)
        assert rows(df.select(ta.alias("a"), dp.alias("p")), "a", "p") == [(axis, period)]


def test_age_band(spark):
    ages = [-1, 0, 4, 5, 89, 90, 200, 201]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = dict(rows(df.select("age", age_band("age").alias("b")), "age", "b"))
    assert [got[a] for a in ages] == [None, 1, 1, 2, 18, 19, 19, None]


def test_financial_year(spark):
    df = spark.createDataFrame([("2019-03-31",), ("2019-04-01",)], "d string").select(F.to_date("d").alias("d"))
    assert sorted(rows(df.select(fin_year("d").alias("y")), "y")) == [(2018,), (2019,)]


def test_epop_totals_invariant():
    assert epop_total("normal") == 200000
    assert epop_total("normal", sexes=1) == 100000
    assert epop_total("16+") == 165800
    assert epop_total("<16") == 34200
    assert epop_total("11to25") == 34200
    assert epop_total("15to25") == 25400
    assert 2 * sum(w for b, w in EPOP_WEIGHTS["normal"].items() if b <= 15) == 182000


def test_simd_release_years_are_contiguous(spark):
    from arealens.operators.deprivation import simd_versions
    from arealens.sources.refdata import SIMD_RELEASES

    rows = simd_versions(spark, SIMD_RELEASES).collect()
    years = sorted(r["year"] for r in rows)
    assert years == list(range(2002, 2020))
    assert {r["version"] for r in rows if r["year"] == 2014} == {"simd2016"}
