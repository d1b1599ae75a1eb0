"""Geography operators by hand: merged partnerships, name matching, exclusions."""

from arealens.operators import geography as G
from arealens.sources.refdata import council_to_adp_table


def test_adp_rollup_merges_council_pairs(spark):
    df = spark.createDataFrame([("S12000010", 2000, 3.0, 10.0), ("S12000019", 2000, 4.0, 20.0),
                                ("S12000005", 2000, 1.0, 5.0), ("S08000001", 2000, 8.0, 35.0)],
                               "code string, year int, numerator double, denominator double")
    out = {r["code"]: (r["numerator"], r["denominator"])
           for r in G.adp_rollup(df, council_to_adp_table(spark)).collect()}
    assert out["S11000051"] == (7.0, 30.0)          # two councils, one partnership
    assert out["S11000005"] == (1.0, 5.0)
    assert out["S08000001"] == (8.0, 35.0)          # non-council rows pass through


def test_name_to_code_reports_unmatched(spark):
    names = spark.createDataFrame([("Glasgow City",), ("GLASGOW  city ",), ("Atlantis",)], "areaname string")
    aliases = spark.createDataFrame([("Glasgow City", "S12000049")], "alias string, code string")
    matched, unmatched = G.name_to_code(names, aliases)
    assert sorted(r["code"] for r in matched.collect()) == ["S12000049", "S12000049"]
    assert [r["areaname"] for r in unmatched.collect()] == ["Atlantis"]


def test_incomplete_area_filter_by_year_range(spark):
    df = spark.createDataFrame([("A", y) for y in range(2000, 2005)] + [("B", 2001)], "code string, year int")
    ex = spark.createDataFrame([("A", 2001, 2003)], "code string, year_from int, year_to int")
    kept = sorted((r["code"], r["year"]) for r in G.incomplete_area_filter(df, ex).collect())
    assert kept == [("A", 2000), ("A", 2004), ("B", 2001)]


def test_council_runs_drop_the_partnerships_not_asked_for(spark):
    from arealens.plans.indicator import run_indicator
    from arealens.plans.q_geography import COUNCIL_LEVELS, WITH_ADP, WITH_HSCP

    lookup = spark.createDataFrame([("S12000010", "S08000001", "S11000051", "S37000001"), ("S12000019", "S08000001", "S11000051", "S37000002"),
                                    ("S12000099", "S08000002", None, "S37000002")], "ca string, hb string, adp string, hscp string")
    prepared = spark.createDataFrame([(ca, y, float(n)) for y in range(1995, 2002) for ca, n in (("S12000010", 1), ("S12000019", 2), ("S12000099", 4))],
                                     "ca string, year int, numerator double")
    codes = ["S12000010", "S12000019", "S12000099", "S08000001", "S08000002", "S11000051", "S37000001", "S37000002", "S00000001"]
    people = spark.createDataFrame([(c, y, 100.0) for c in codes for y in range(1995, 2002)], "code string, year int, denominator double")
    got = {}
    for spec in (WITH_ADP, WITH_HSCP):
        run = run_indicator(prepared, spec, lookup, "ca", COUNCIL_LEVELS, population=people)
        got[spec.ind_id] = {r["code"]: r["numerator"] for r in run.where("year = 1998").collect()}
    assert got[99602] == {"S12000010": 1, "S12000019": 2, "S12000099": 4, "S08000001": 3, "S08000002": 4, "S11000051": 3, "S00000001": 7}
    assert got[99603] == {"S12000010": 1, "S12000019": 2, "S12000099": 4, "S08000001": 3, "S08000002": 4, "S37000001": 1, "S37000002": 6,
                          "S00000001": 7}
