"""Deprivation and inequality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import deprivation as D
from ..operators import inequality as I
from ..sources import fixtures as FX
from ..sources.refdata import values_sql
from . import deprivation as DP
from . import oracle_sql as O
from .indicator import run_indicator
from .registry import present, register
from .spec import IndicatorSpec

DEPR_PCT = IndicatorSpec(ind_id=99101, measure="percent", time_agg=3, yearstart=1995, yearend=2001,
                         year_type="calendar")
DEPR_CRUDE = IndicatorSpec(ind_id=99102, measure="crude", time_agg=1, yearstart=1995, yearend=2001,
                           year_type="financial", crude_rate=100000)
QUINT_IND = IndicatorSpec(ind_id=99103, measure="percent", time_agg=1, yearstart=1995, yearend=2001,
                          year_type="financial")
VERSIONS = [("a", 1995, 1997), ("b", 1998, 1999), ("c", 2000, 2001)]
T975 = {1: 12.706204736174698, 2: 4.302652729749464, 3: 3.182446305284263}

_J = ("SELECT p.year, p.datazone, p.sex_grp, p.age_grp, p.numerator, p.denominator, l.pop, l.ca, l.hb, "
      "l.sc_quin, l.hb_quin, l.ca_quin FROM fx_prepared p LEFT JOIN fx_depr_lookup l "
      "ON p.datazone = l.datazone AND p.year = l.year")


def _lookup_and_prepared(spark, d):
    simd = FX.fx_simd(spark, d)
    return FX.fx_prepared(spark, d), FX.fx_depr_lookup(spark, d, simd)


@register("join_simd_year", sql=O.with_fx(body=_J))
def q_join_simd_year(spark, d):
    prep, lk = _lookup_and_prepared(spark, d)
    return present(D.join_simd_year(prep, lk))


@register("weighted_quintile", sql=O.with_fx(body=(
    "SELECT datazone, pop, simd_rank, sc_quin, hb_quin, ca_quin, 6 - sc_quin AS sc_quin_desc FROM fx_simd")))
def q_weighted_quintile(spark, d):
    s = FX.fx_simd(spark, d)
    s = D.weighted_quintile(s, "pop", ["simd_rank"], out="sc_quin_desc", lowest_label=5)
    return s.select("datazone", "pop", "simd_rank", "sc_quin", "hb_quin", "ca_quin", "sc_quin_desc")


@register("quintile_rollup", sql=O.with_fx(
    ("j", _J), body=O.quintile_rollup_sql("j", ["year"], ["numerator", "denominator"], totals=False)))
def q_quintile_rollup(spark, d):
    prep, lk = _lookup_and_prepared(spark, d)
    return present(I.quintile_rollup(D.join_simd_year(prep, lk), totals=False))


@register("quintile_totals", sql=O.with_fx(
    ("j", _J), body=O.quintile_rollup_sql("j", ["year"], ["numerator", "denominator"])))
def q_quintile_totals(spark, d):
    prep, lk = _lookup_and_prepared(spark, d)
    return present(I.quintile_rollup(D.join_simd_year(prep, lk)))


@register("join_population_right", sql=O.with_fx(
    ("j", _J),
    ("q", O.quintile_rollup_sql("j", ["year"], ["numerator"])),
    ("rj", "SELECT pp.code, pp.quintile, pp.quint_type, pp.year, coalesce(q.numerator, 0) AS numerator, "
           "pp.denominator FROM q RIGHT JOIN (SELECT * FROM fx_depr_population WHERE year >= 1995) pp "
           "ON q.year = pp.year AND q.code = pp.code AND q.quintile = pp.quintile AND q.quint_type = pp.quint_type "
           "WHERE pp.year BETWEEN 1995 AND 2001"),
    body=O.rolling_sql("rj", ["code", "quintile", "quint_type"], 1)))
def q_join_population_right(spark, d):
    prep, lk = _lookup_and_prepared(spark, d)
    f = DP.formatted(prep.drop("denominator"), DEPR_CRUDE, lk, FX.fx_depr_population(spark, d, lk))
    return present(f.select("code", "quintile", "quint_type", "year", "numerator", "denominator"))


def _measures_ctes(rt: str = "rt"):
    g = "PARTITION BY code, year, quint_type"
    v = "rate IS NOT NULL"
    tcase = "CASE m - 2 " + " ".join(f"WHEN {k} THEN {t!r}" for k, t in T975.items()) + " END"
    return [
        ("tot", f"SELECT code, year, quint_type, max(rate) AS overall_rate FROM {rt} WHERE quintile = 'Total' "
                "GROUP BY code, year, quint_type"),
        ("d1", f"SELECT *, denominator / nullif(sum(denominator) OVER ({g}), 0) AS p, count(*) OVER ({g}) AS cnt, "
               f"max(CASE WHEN quintile = '5' THEN rate END) OVER ({g}) AS least_rate, "
               f"max(CASE WHEN quintile = '1' THEN rate END) OVER ({g}) AS most_rate "
               f"FROM {rt} WHERE quintile <> 'Total'"),
        ("d2", f"SELECT *, sum(p) OVER ({g} ORDER BY CAST(quintile AS INT) ROWS BETWEEN UNBOUNDED PRECEDING "
               f"AND CURRENT ROW) - p / 2 AS x, sum(CASE WHEN {v} THEN p END) OVER ({g}) AS sw FROM d1"),
        ("d3", f"SELECT *, sum(CASE WHEN {v} THEN p * x END) OVER ({g}) / nullif(sw, 0) AS xbar, "
               f"sum(CASE WHEN {v} THEN p * rate END) OVER ({g}) / nullif(sw, 0) AS ybar FROM d2"),
        ("d4", f"SELECT *, sum(CASE WHEN {v} THEN p * (x - xbar) * (x - xbar) END) OVER ({g}) AS sxx, "
               f"sum(CASE WHEN {v} THEN p * (x - xbar) * (rate - ybar) END) OVER ({g}) AS sxy, "
               f"count(rate) OVER ({g}) AS m FROM d3"),
        ("d5", "SELECT *, sxy / nullif(sxx, 0) AS b FROM d4"),
        ("d6", f"SELECT *, sum(CASE WHEN {v} THEN p * (rate - ybar - b * (x - xbar)) * (rate - ybar - b * (x - xbar)) "
               f"END) OVER ({g}) AS rss, (rate / nullif(least_rate, 0) - 1) * p AS par_rr FROM d5"),
        ("grp", "SELECT code, year, quint_type, max(cnt) AS cnt, max(m) AS m, max(b) AS b, max(rss) AS rss, "
                "max(sxx) AS sxx, max(most_rate) AS most_rate, max(least_rate) AS least_rate, "
                "sum(par_rr) AS par_sum, count(par_rr) AS par_n FROM d6 GROUP BY code, year, quint_type"),
        ("g2", f"SELECT grp.*, tot.overall_rate, {tcase} AS t, sqrt(rss / nullif(m - 2, 0) / nullif(sxx, 0)) AS se, "
               "(cnt = 5 AND m >= 2 AND sxx > 0) AS has_sii, (cnt = 5 AND m >= 3 AND sxx > 0) AS has_ci "
               "FROM grp LEFT JOIN tot ON grp.code = tot.code AND grp.year = tot.year AND grp.quint_type = tot.quint_type"),
        ("g3", "SELECT code, year, quint_type, overall_rate, most_rate, least_rate, cnt, par_n, par_sum, "
               "CASE WHEN has_sii THEN -b END AS sii, CASE WHEN has_ci THEN -(b + t * se) END AS lowci_sii, "
               "CASE WHEN has_ci THEN -(b - t * se) END AS upci_sii FROM g2"),
        ("meas", "SELECT code, year, quint_type, sii, lowci_sii, upci_sii, "
                 "sii / nullif(overall_rate, 0) AS rii, lowci_sii / nullif(overall_rate, 0) AS lowci_rii, "
                 "upci_sii / nullif(overall_rate, 0) AS upci_rii, "
                 "sii / nullif(overall_rate, 0) * 0.5 * 100 AS rii_int, "
                 "lowci_sii / nullif(overall_rate, 0) * 0.5 * 100 AS lowci_rii_int, "
                 "upci_sii / nullif(overall_rate, 0) * 0.5 * 100 AS upci_rii_int, "
                 "CASE WHEN cnt = 5 AND par_n = cnt THEN par_sum / nullif(par_sum + 1, 0) * 100 END AS par, "
                 "most_rate - least_rate AS abs_range, most_rate / nullif(least_rate, 0) AS rel_range FROM g3"),
    ]


def _depr_pct_ctes(spec: IndicatorSpec):
    return [
        ("j", _J),
        ("q", O.quintile_rollup_sql("j", ["year"], ["numerator", "denominator"])),
        ("l", f"SELECT * FROM q WHERE year BETWEEN {spec.yearstart} AND {spec.yearend}"),
        ("m", O.rolling_sql("l", ["code", "quintile", "quint_type"], spec.time_agg, shift=spec.time_fix)),
        ("rt", f"SELECT code, year, quintile, quint_type, numerator, denominator, "
               f"{O.percent_sql(round_ci=False)} FROM m"),
        *_measures_ctes("rt"),
    ]


def _measure_sql(cols):
    sel = ", ".join(O.r6(c, c) for c in cols)
    return O.with_fx(*_depr_pct_ctes(DEPR_PCT), body=f"SELECT code, year, quint_type, {sel} FROM meas")


def _measures(spark, d):
    prep, lk = _lookup_and_prepared(spark, d)
    rt = DP.quintile_rates(DP.formatted(prep, DEPR_PCT, lk), DEPR_PCT)
    return I.inequality_measures(rt)


@register("sii", sql=_measure_sql(["sii", "lowci_sii", "upci_sii"]))
def q_sii(spark, d):
    return present(_measures(spark, d).select("code", "year", "quint_type", "sii", "lowci_sii", "upci_sii"))


@register("rii", sql=_measure_sql(["rii", "lowci_rii", "upci_rii", "rii_int", "lowci_rii_int", "upci_rii_int"]))
def q_rii(spark, d):
    return present(_measures(spark, d).select("code", "year", "quint_type", "rii", "lowci_rii", "upci_rii",
                                              "rii_int", "lowci_rii_int", "upci_rii_int"))


@register("par", sql=_measure_sql(["par"]))
def q_par(spark, d):
    return present(_measures(spark, d).select("code", "year", "quint_type", "par"))


@register("ranges", sql=_measure_sql(["abs_range", "rel_range"]))
def q_ranges(spark, d):
    return present(_measures(spark, d).select("code", "year", "quint_type", "abs_range", "rel_range"))


def _attach_sql():
    spec = DEPR_PCT
    mcols = ", ".join(O.r6(f"meas.{c}", c) for c in I.MEASURE_COLS)
    labels = O.labels_sql(spec.year_type, spec.time_agg, y="rt.year")
    low = f"CASE WHEN {O.nz('rt.lowci')} < 0 THEN 0 ELSE {O.nz('rt.lowci')} END"
    return O.with_fx(
        *_depr_pct_ctes(spec),
        body=(f"SELECT rt.code, rt.year, rt.quintile, rt.quint_type, {O.r6('rt.numerator', 'numerator')}, "
              f"{O.r6('rt.denominator', 'denominator')}, {O.r6(O.nz('rt.rate'), 'rate')}, "
              f"{O.r6(low, 'lowci')}, "
              f"{O.r6(O.nz('rt.upci'), 'upci')}, {mcols}, CAST({spec.ind_id} AS INT) AS ind_id, {labels} "
              "FROM rt LEFT JOIN meas ON rt.code = meas.code AND rt.year = meas.year "
              "AND rt.quint_type = meas.quint_type"))


@register("attach_to_totals", sql=_attach_sql())
def q_attach_to_totals(spark, d):
    prep, lk = _lookup_and_prepared(spark, d)
    return present(DP.run_deprivation(prep, DEPR_PCT, lk))


@register("quintile_filter_indicator", sql=O.with_fx(
    ("j", "SELECT p.year, CAST(s.sc_quin AS VARCHAR) AS quintile, p.numerator, p.denominator, a.ca, a.hb, "
          "'S00000001' AS scotland FROM fx_prepared p LEFT JOIN fx_area a ON p.datazone = a.datazone "
          "LEFT JOIN fx_simd s ON p.datazone = s.datazone WHERE p.year >= 1995"),
    ("r", O.rollup_sql("j", ["ca", "hb", "scotland"], ["year", "quintile"])),
    ("l", "SELECT * FROM r WHERE year BETWEEN 1995 AND 2001 AND code IS NOT NULL "
          "AND NOT starts_with(code, 'S11')"),
    ("q", f"SELECT code, quintile, year, numerator, {O.percent_sql()} FROM l"),
    ("f", O.finalise_sql("q")),
    body="SELECT quintile, " + O.INDICATOR_SELECT.format(ind=99103).replace(
        "def_period, trend_axis", O.labels_sql("financial", 1)) + " FROM f"))
def q_quintile_filter_indicator(spark, d):
    simd = FX.fx_simd(spark, d).select("datazone", F.col("sc_quin").cast("string").alias("quintile"))
    prep = FX.fx_prepared(spark, d).join(simd, "datazone", "left")
    out = run_indicator(prep, QUINT_IND, FX.fx_area(spark, d), "datazone", ["ca", "hb", "scotland"],
                        extra_keys=["quintile"])
    return present(out)


_VERSIONS_SQL = values_sql(VERSIONS, ["version", "year_from", "year_to"])
_VERSIONED_SQL = (
    "SELECT l.datazone, l.year, l.pop, v.version, CASE v.version WHEN 'a' THEN s.simd_rank "
    "WHEN 'b' THEN s.datazone WHEN 'c' THEN s.pop END AS rank FROM fx_depr_lookup l "
    "LEFT JOIN v ON l.year BETWEEN v.year_from AND v.year_to LEFT JOIN fx_simd s ON l.datazone = s.datazone")


def _versioned(spark, d):
    simd = FX.fx_simd(spark, d)
    facts = FX.fx_depr_lookup(spark, d, simd).select("datazone", "year", "pop")
    releases = simd.select("datazone", F.col("simd_rank").alias("rank_a"),
                           F.col("datazone").alias("rank_b"), F.col("pop").cast("long").alias("rank_c"))
    return D.simd_version_by_year(facts, D.simd_versions(spark, VERSIONS), releases,
                                  {"a": "rank_a", "b": "rank_b", "c": "rank_c"})


@register("simd_version_by_year", sql=O.with_fx(("v", _VERSIONS_SQL), body=_VERSIONED_SQL))
def q_simd_version_by_year(spark, d):
    return _versioned(spark, d).select("datazone", "year", "pop", "version", "rank")


@register("access_deprived", sql=O.with_fx(
    ("v", _VERSIONS_SQL), ("vr", _VERSIONED_SQL),
    ("c", "SELECT *, sum(pop) OVER (PARTITION BY year ORDER BY rank, datazone ROWS BETWEEN UNBOUNDED PRECEDING "
          "AND CURRENT ROW) AS cum, sum(pop) OVER (PARTITION BY year) * 0.15 AS lim FROM vr WHERE rank IS NOT NULL"),
    body="SELECT datazone, year, pop, rank, CAST(CASE WHEN lim - cum >= 0 THEN pop ELSE 0 END AS DOUBLE) "
         "AS numerator FROM c"))
def q_access_deprived(spark, d):
    v = _versioned(spark, d).where(F.col("rank").isNotNull()).select("datazone", "year", "pop", "rank")
    return present(D.access_deprived(v))


@register("deprived_youth", sql=O.with_fx(
    ("y", "SELECT datazone, ca, CAST(floor(pop * 0.3) AS DOUBLE) AS young, sc_quin FROM fx_simd"),
    body=("SELECT a.ca AS code, coalesce(b.numerator, 0) AS numerator, a.denominator FROM "
          "(SELECT ca, sum(young) AS denominator FROM y GROUP BY ca) a LEFT JOIN "
          "(SELECT ca, sum(young) AS numerator FROM y WHERE datazone IN (SELECT datazone FROM y WHERE sc_quin = 1) "
          "GROUP BY ca) b ON a.ca = b.ca")))
def q_deprived_youth(spark, d):
    s = FX.fx_simd(spark, d)
    young = s.select("datazone", "ca", F.floor(F.col("pop") * 0.3).cast("double").alias("young"))
    worst = s.where(F.col("sc_quin") == 1).select("datazone")
    num = D.deprived_population(young, worst).groupBy("ca").agg(F.sum("young").alias("numerator"))
    den = young.groupBy("ca").agg(F.sum("young").alias("denominator"))
    out = den.join(num, "ca", "left").select(F.col("ca").alias("code"),
                                             F.coalesce("numerator", F.lit(0.0)).alias("numerator"),
                                             "denominator")
    return present(out)


# ---- age-sex standardised inequality run (EASR per quintile) -----------------------------------------
DEPR_EASR = IndicatorSpec(ind_id=99104, measure="stdrate", time_agg=3, yearstart=1995, yearend=2001,
                          year_type="calendar", epop_age="normal", epop_total=200000)
_STRATA = ["year", "sex_grp", "age_grp"]


def _easr_depr_ctes(spec: IndicatorSpec):
    from .q_indicator import _epop_values

    T = float(spec.standard_total)
    lo, up = O.byar_lower("numerator"), O.byar_upper("numerator")
    spread = f"sqrt(var_dsr / {T * T} / nullif(numerator, 0))"
    keys = "code, quintile, quint_type, sex_grp, age_grp"
    return [
        ("j", _J),
        ("q", O.quintile_rollup_sql("j", _STRATA, ["numerator"])),
        ("ps", "SELECT l.year, l.ca, l.hb, l.sc_quin, l.hb_quin, l.ca_quin, s.sex_grp, g.age_grp, "
               "CAST(l.pop AS DOUBLE) AS denominator FROM fx_depr_lookup l, (SELECT DISTINCT sex_grp FROM "
               "fx_prepared) s, (SELECT DISTINCT age_grp FROM fx_prepared) g"),
        ("dp", O.quintile_rollup_sql("ps", _STRATA, ["denominator"])),
        ("rj", "SELECT dp.code, dp.quintile, dp.quint_type, dp.sex_grp, dp.age_grp, dp.year, "
               "coalesce(q.numerator, 0) AS numerator, dp.denominator FROM q RIGHT JOIN dp ON q.year = dp.year "
               "AND q.code = dp.code AND q.quintile = dp.quintile AND q.quint_type = dp.quint_type "
               "AND q.sex_grp = dp.sex_grp AND q.age_grp = dp.age_grp "
               f"WHERE dp.year BETWEEN {spec.yearstart} AND {spec.yearend}"),
        ("m", O.rolling_sql("rj", keys.split(", "), spec.time_agg, shift=spec.time_fix)),
        ("ep", _epop_values(spec.epop_age)),
        ("e", "SELECT m.*, ep.epop FROM m LEFT JOIN ep ON m.age_grp = ep.age_grp"),
        ("s", "SELECT year, code, quintile, quint_type, coalesce(sum(numerator), 0) AS numerator, "
              "coalesce(sum(denominator), 0) AS denominator, "
              f"sum({O.nz('numerator * epop / nullif(denominator, 0)')}) AS easr_first, "
              f"sum({O.nz('numerator * epop * epop / nullif(denominator * denominator, 0)')}) AS var_dsr "
              "FROM e GROUP BY year, code, quintile, quint_type"),
        ("rt", f"SELECT code, year, quintile, quint_type, numerator, denominator, easr_first / {T} * 100000 AS rate, "
               f"(easr_first / {T} + {spread} * ({lo} - numerator)) * 100000 AS lowci, "
               f"(easr_first / {T} + {spread} * ({up} - numerator)) * 100000 AS upci FROM s"),
        *_measures_ctes("rt"),
    ]


def _final_depr_sql(ctes, spec: IndicatorSpec) -> str:
    mcols = ", ".join(O.r6(f"meas.{c}", c) for c in I.MEASURE_COLS)
    labels = O.labels_sql(spec.year_type, spec.time_agg, y="rt.year")
    low = f"CASE WHEN {O.nz('rt.lowci')} < 0 THEN 0 ELSE {O.nz('rt.lowci')} END"
    return O.with_fx(
        *ctes,
        body=(f"SELECT rt.code, rt.year, rt.quintile, rt.quint_type, {O.r6('rt.numerator', 'numerator')}, "
              f"{O.r6('rt.denominator', 'denominator')}, {O.r6(O.nz('rt.rate'), 'rate')}, {O.r6(low, 'lowci')}, "
              f"{O.r6(O.nz('rt.upci'), 'upci')}, {mcols}, CAST({spec.ind_id} AS INT) AS ind_id, {labels} "
              "FROM rt LEFT JOIN meas ON rt.code = meas.code AND rt.year = meas.year "
              "AND rt.quint_type = meas.quint_type"))


@register("deprivation_easr", sql=_final_depr_sql(_easr_depr_ctes(DEPR_EASR), DEPR_EASR))
def q_deprivation_easr(spark, d):
    """Inequality run on age-sex standardised rates: strata carried through the quintile
    roll-up, the right join to the stratified population, rolling, and EASR per quintile."""
    prep, lk = _lookup_and_prepared(spark, d)
    # every (sex, age band) stratum has the same population here, so roll up first and
    # replicate the strata on the few aggregated rows (not on every datazone)
    pop = lk.select("year", "ca", "hb", "sc_quin", "hb_quin", "ca_quin",
                    F.col("pop").cast("double").alias("denominator"))
    dom = FX._domains(spark, d)
    dpop = (I.quintile_rollup(pop, keys=["year"], measures=["denominator"])
            .select("*", dom.alias("_dom"))
            .select("*", F.explode("_dom.sex_grp").alias("sex_grp"))
            .select("*", F.explode("_dom.age_grp").alias("age_grp")).drop("_dom"))
    return present(DP.run_deprivation(prep, DEPR_EASR, lk, population=dpop))
