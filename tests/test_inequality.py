"""SII / RII / PAR against NumPy weighted least squares, and edge cases."""

import numpy as np
import pytest

from arealens.operators.inequality import inequality_measures, quintile_rollup

SCHEMA = "code string, year int, quint_type string, quintile string, rate double, denominator double"


def _frame(spark, groups):
    data = []
    for g, (rates, dens, total_rate) in enumerate(groups):
        for q, (r, d) in enumerate(zip(rates, dens), start=1):
            data.append((f"A{g}", 2000, "sc_quin", str(q), r, d))
        data.append((f"A{g}", 2000, "sc_quin", "Total", total_rate, float(sum(dens))))
    return spark.createDataFrame(data, SCHEMA)


def _numpy_sii(rates, dens):
    p = np.array(dens) / np.sum(dens)
    x = np.cumsum(p) - p / 2
    y = np.array(rates)
    X = np.column_stack([np.sqrt(p), np.sqrt(p) * x])
    coef, res, *_ = np.linalg.lstsq(X, np.sqrt(p) * y, rcond=None)
    resid = np.sqrt(p) * y - X @ coef
    sigma2 = resid @ resid / (len(y) - 2)
    cov = sigma2 * np.linalg.inv(X.T @ X)
    return coef[1], np.sqrt(cov[1, 1])


def test_sii_matches_numpy_wls(spark):
    rng = np.random.default_rng(7)
    groups = []
    for _ in range(6):
        rates = [float(x) for x in rng.uniform(5, 80, 5)]
        dens = [float(x) for x in rng.integers(100, 5000, 5)]
        groups.append((rates, dens, float(np.mean(rates))))
    out = {r["code"]: r for r in inequality_measures(_frame(spark, groups)).collect()}
    for g, (rates, dens, total) in enumerate(groups):
        b, se = _numpy_sii(rates, dens)
        r = out[f"A{g}"]
        assert r["sii"] == pytest.approx(-b, rel=1e-9)
        assert r["lowci_sii"] == pytest.approx(-(b + 3.182446305284263 * se), rel=1e-9)
        assert r["upci_sii"] == pytest.approx(-(b - 3.182446305284263 * se), rel=1e-9)
        assert r["rii"] == pytest.approx(-b / total, rel=1e-9)
        assert r["abs_range"] == pytest.approx(rates[0] - rates[4])
        assert r["rel_range"] == pytest.approx(rates[0] / rates[4])
        p = np.array(dens) / np.sum(dens)
        rr = (np.array(rates) / rates[4] - 1) * p
        assert r["par"] == pytest.approx(rr.sum() / (rr.sum() + 1) * 100)


def test_equal_rates_give_zero_sii_and_par(spark):
    out = inequality_measures(_frame(spark, [([20.0] * 5, [100.0, 200.0, 300.0, 400.0, 500.0], 20.0)])).collect()[0]
    assert out["sii"] == pytest.approx(0.0, abs=1e-9)
    assert out["lowci_sii"] == pytest.approx(0.0, abs=1e-6)
    assert out["par"] == pytest.approx(0.0, abs=1e-12)


def test_four_quintiles_give_null(spark):
    df = _frame(spark, [([10.0, 20.0, 30.0, 40.0, 50.0], [1.0] * 5, 30.0)]).where("quintile <> '5'")
    out = inequality_measures(df).collect()[0]
    assert out["sii"] is None and out["par"] is None


def test_missing_total_row_gives_null_rii(spark):
    df = _frame(spark, [([10.0, 20.0, 30.0, 40.0, 50.0], [1.0] * 5, 30.0)]).where("quintile <> 'Total'")
    out = inequality_measures(df).collect()[0]
    assert out["sii"] is not None and out["rii"] is None


def test_quintile_totals_include_unknown_quintile(spark):
    df = spark.createDataFrame(
        [(2000, "S08000001", "S12000001", 1, 1, 1, 5.0, 10.0), (2000, "S08000001", "S12000001", None, None, None, 3.0, 4.0)],
        "year int, hb string, ca string, sc_quin int, hb_quin int, ca_quin int, numerator double, denominator double")
    out = {(r["code"], r["quint_type"], r["quintile"]): r["numerator"] for r in quintile_rollup(df).collect()}
    assert out[("S00000001", "sc_quin", "Total")] == 8.0
    assert out[("S00000001", "sc_quin", "1")] == 5.0
    assert not any(k[2] is None for k in out)


def test_deprivation_perc_pcf_uses_quintile_reference_population(spark):
    from arealens.plans.deprivation import quintile_rates
    from arealens.plans.spec import IndicatorSpec

    spec = IndicatorSpec(ind_id=5, measure="perc_pcf", time_agg=1, yearstart=2000, yearend=2000,
                         year_type="school")
    df = spark.createDataFrame([("A", "1", "sc_quin", 2000, 10.0, 40.0), ("A", "2", "sc_quin", 2000, 5.0, 50.0)],
                               "code string, quintile string, quint_type string, year int, numerator double, "
                               "denominator double")
    pop = spark.createDataFrame([("A", "1", "sc_quin", 2000, 100.0), ("A", "2", "sc_quin", 2000, 20.0)],
                                "code string, quintile string, quint_type string, year int, denominator double")
    out = {r["quintile"]: r for r in quintile_rates(df, spec, pop).collect()}
    rate = 25.0
    ci = 1.96 * ((rate * (100 - rate) / 40.0) * ((100 - 40) / (100 - 1)) ** 0.5) ** 0.5
    assert out["1"]["lowci"] == pytest.approx(rate - ci)
    assert out["2"]["lowci"] == out["2"]["upci"] == pytest.approx(10.0)   # population < denominator
