"""Published relative-risk rules and the attributable fraction, by hand."""

import pytest

from arealens.operators import attributable as AT
from arealens.sources.refdata import RR_RULE_SCHEMA, smoking_rr_rules

EV = "uri int, diag string, sex_grp int, age_grp int"


def _rules(spark, kind):
    cur, ex = smoking_rr_rules(kind)
    return spark.createDataFrame(cur, RR_RULE_SCHEMA), spark.createDataFrame(ex, RR_RULE_SCHEMA)


def test_rule_lookup(spark):
    ev = spark.createDataFrame([(1, "C34", 1, 12), (2, "I60", 2, 14), (3, "K50", 1, 5), (4, "S72", 2, 11),
                                (5, "H25", 1, 9), (6, "Z99", 1, 10), (7, "I60", 1, 8)], EV)
    rc, rx = _rules(spark, "admissions")
    got = {r["uri"]: (r["current"], r["ex"]) for r in AT.smoking_relative_risk(ev, rc, rx).collect()}
    assert got == {1: (23.26, 8.70), 2: (2.60, 1.30), 3: (2.10, 1.0), 7: (4.40, 1.10)}


def test_deaths_drop_admission_only_rules(spark):
    ev = spark.createDataFrame([(1, "K50", 1, 5), (2, "C34", 2, 12)], EV)
    rc, rx = _rules(spark, "deaths")
    assert [r["uri"] for r in AT.smoking_relative_risk(ev, rc, rx).collect()] == [2]


def test_attributable_fraction_by_hand(spark):
    df = spark.createDataFrame([("A", 2000, 1, 12, 10.0, 23.26, 8.70, 20.0, 25.0, 20.0, 25.0, 30.0, 10.0)],
                               "code string, year int, sex_grp int, age_grp int, n double, current double, "
                               "ex double, current_area double, ex_area double, scot_current double, "
                               "scot_ex double, current_age double, ex_age double")
    pc, pe = 0.30, 0.10
    saf = (pc * 22.26 + pe * 7.70) / (1 + pc * 22.26 + pe * 7.70)
    (row,) = AT.attributable_fraction(df).collect()
    assert row["numerator"] == pytest.approx(10 * saf)
