"""Whole source flows and the operators they add: attributable rates, emergency and multiple admissions, incidence
with deaths, closures of areas and code histories, calendar periods, survey slices, checks gathered while writing.

The events' dates span a month, so flows that need years take them from the
event's keys; the oracles do the same.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from ..functions.age import age_band
from ..functions.dates import fin_year, year_end_to_start
from ..operators import attributable as AT
from ..operators import episodes as E
from ..operators import geography as G
from ..operators import periods as P
from ..operators import qa as Q
from ..operators import reshape as RS
from ..session import materialize, scratch_path
from ..sources import fixtures as FX
from ..sources.refdata import EPOP_WEIGHTS, SCOTLAND, values_sql
from ..sources.tables import read_table, read_tagged
from . import oracle_sql as O
from .indicator import INDICATOR_COLUMNS, run_indicator
from .q_attr import CURRENT_RR, EX_RR, _RULE_COND, _SAF
from .q_episodes import _FIN, _MIN_SQL, _STAYS_SQL
from .q_indicator import LEVELS, PCT1, _indicator_select
from .q_qa import NEW
from .registry import present, register
from .runner import Job, run_jobs
from .spec import IndicatorSpec
from ..sources.refdata import RR_RULE_SCHEMA

_BAND = "CAST(CASE WHEN {a} BETWEEN 0 AND 200 THEN least(floor({a} / 5) + 1, 19) END AS INT)"
CODE_LEVELS = ("ca", "hb", "scotland")


def population_grid(spark, d, spec: IndicatorSpec, least_band: int = 1):
    """40 residents per datazone, year, sex and age band, at every level."""
    years, bands = F.sequence(F.lit(spec.yearstart), F.lit(spec.yearend)), F.sequence(F.lit(least_band), F.lit(19))
    return (FX.area_counts(spark, d).select("code", "n", F.explode(years).alias("year"))
            .select("code", "n", "year", F.explode(F.array(F.lit(1), F.lit(2))).alias("sex_grp"))
            .select("code", "n", "year", "sex_grp", F.explode(bands).alias("age_grp"))
            .select("year", "code", "sex_grp", "age_grp", (F.col("n") * 40.0).alias("denominator")))


def std_sql(spec: IndicatorSpec, *ctes, counts: str, least_band: int = 1, tag: str = "") -> str:
    """Oracle of a standardised run: ``counts`` names a CTE of (code, year, sex_grp, age_grp, numerator)."""
    s, e, total = spec.yearstart, spec.yearend, float(spec.standard_total)
    spread = f"sqrt(var_dsr / {total * total} / nullif(numerator, 0))"
    lo, up = O.byar_lower("numerator"), O.byar_upper("numerator")
    epop = values_sql([(b, float(w)) for b, w in EPOP_WEIGHTS[spec.epop_age].items()], ["age_grp", "epop"])
    return O.with_fx(
        *ctes,
        ("pp", f"SELECT CAST(y.year AS INT) AS year, c.code, x.sex_grp, CAST(b.age_grp AS INT) AS age_grp, "
               f"CAST(40 * c.n AS DOUBLE) AS denominator FROM fx_counts c, (SELECT range AS year FROM range({s}, {e + 1})) y, "
               f"(SELECT 1 AS sex_grp UNION ALL SELECT 2) x, (SELECT range AS age_grp FROM range({least_band}, 20)) b"),
        ("fj", "SELECT coalesce(r.year, pp.year) AS year, coalesce(r.code, pp.code) AS code, "
               "coalesce(r.sex_grp, pp.sex_grp) AS sex_grp, coalesce(r.age_grp, pp.age_grp) AS age_grp, "
               f"coalesce(r.numerator, 0) AS numerator, pp.denominator FROM (SELECT * FROM {counts} WHERE year BETWEEN {s} AND {e}) r "
               "FULL JOIN pp ON r.year = pp.year AND r.code = pp.code AND r.sex_grp = pp.sex_grp AND r.age_grp = pp.age_grp"),
        ("l", f"SELECT * FROM fj WHERE year BETWEEN {s} AND {e} AND code IS NOT NULL"),
        ("m", O.rolling_sql("l", ["code", "sex_grp", "age_grp"], spec.time_agg, shift=spec.time_fix)),
        ("ep", epop), ("w", "SELECT m.*, ep.epop FROM m LEFT JOIN ep ON m.age_grp = ep.age_grp"),
        ("s", "SELECT year, code, coalesce(sum(numerator), 0) AS numerator, "
              f"sum({O.nz('numerator * epop / nullif(denominator, 0)')}) AS easr_first, "
              f"sum({O.nz('numerator * epop * epop / nullif(denominator * denominator, 0)')}) AS var_dsr FROM w GROUP BY year, code"),
        ("q", f"SELECT code, year, numerator, easr_first / {total} * 100000 AS rate, "
              f"(easr_first / {total} + {spread} * ({lo} - numerator)) * 100000 AS lowci, "
              f"(easr_first / {total} + {spread} * ({up} - numerator)) * 100000 AS upci FROM s"),
        ("f", O.finalise_sql("q")),
        body=f"SELECT {_indicator_select(spec.ind_id, spec.year_type, spec.time_agg)} FROM f")


# ---- smoking-attributable admissions, to the end -------------------------------------------------
ATTRIBUTABLE = IndicatorSpec(ind_id=1548, measure="stdrate", time_agg=2, yearstart=2012, yearend=2018, year_type="calendar",
                             geography="all", epop_age="normal", epop_total=120000)
# Test prevalence by coarse age band, sex and year: (age_grp2, year, sex, current_age, ex_age).
AGE_YEAR_PREV = [(b, y, s, 30.0 - 4 * b - s - (y - 2012) / 2, 6.0 * b + s) for b in (2, 3, 4, 5)
                 for y in range(2012, 2019) for s in (1, 2)]
_COARSE = "CASE WHEN {a} BETWEEN 8 AND 11 THEN 2 WHEN {a} BETWEEN 12 AND 13 THEN 3 WHEN {a} BETWEEN 14 AND 15 THEN 4 WHEN {a} >= 16 THEN 5 END"


def _attributable_sql() -> str:
    names = ["sex_grp", "diag_lo", "diag_hi", "age_lo", "age_hi", "rr"]
    whole = std_sql(
        ATTRIBUTABLE, ("rc", values_sql(CURRENT_RR, names)), ("rx", values_sql(EX_RR, names)),
        ("ev", "SELECT substr(e.main_condition, 1, 3) AS diag, e.sex_grp, " + _BAND.format(a="e.age") + " AS age_grp, "
               "CAST(2012 + e.uri % 7 AS INT) AS year, p.ca, p.hb, 'S00000001' AS scotland FROM fx_episode e JOIN fx_postcode p ON e.pc7 = p.pc7"),
        ("rj", "SELECT ev.*, c.rr AS current, coalesce(x.rr, 0) AS ex FROM ev JOIN rc c ON " + _RULE_COND.format(t="c")
               + " LEFT JOIN rx x ON " + _RULE_COND.format(t="x") + " WHERE c.rr > 0"),
        ("cnt", "SELECT code, year, sex_grp, age_grp, current, ex, CAST(count(*) AS DOUBLE) AS n FROM ("
                + " UNION ALL ".join(f"SELECT {c} AS code, year, sex_grp, age_grp, current, ex FROM rj" for c in CODE_LEVELS)
                + ") GROUP BY ALL"),
        ("ap", "SELECT code, CAST(y.range AS INT) AS year, x.sex_grp, CAST(15 + CAST(substr(code, 4) AS INT) % 10 + x.sex_grp AS DOUBLE) AS current_area, "
               "CAST(20 + y.range % 7 AS DOUBLE) AS ex_area, 19.0::DOUBLE AS scot_current, 22.0::DOUBLE AS scot_ex FROM fx_counts, "
               "range(2012, 2019) y, (SELECT 1 AS sex_grp UNION ALL SELECT 2) x"),
        ("gp", values_sql(AGE_YEAR_PREV, ["age_grp2", "year", "sex_grp", "current_age", "ex_age"])),
        ("jp", "SELECT c.*, ap.current_area, ap.ex_area, ap.scot_current, ap.scot_ex, gp.current_age, gp.ex_age FROM cnt c "
               "LEFT JOIN ap ON c.code = ap.code AND c.year = ap.year AND c.sex_grp = ap.sex_grp "
               f"LEFT JOIN gp ON {_COARSE.format(a='c.age_grp')} = gp.age_grp2 AND c.year = gp.year AND c.sex_grp = gp.sex_grp"),
        ("saf", f"SELECT code, year, sex_grp, age_grp, coalesce(sum(n * ({_SAF} / (1 + {_SAF}))), 0) AS numerator FROM jp GROUP BY 1, 2, 3, 4"),
        counts="saf")
    return (f"SELECT * REPLACE (round_even(numerator, -1) AS numerator, round_even(rate, 0) AS rate, "
            f"round_even(lowci, 0) AS lowci, round_even(upci, 0) AS upci) FROM ({whole})")


@register("attributable_rates", sql=_attributable_sql())
def q_attributable_rates(spark, d):
    """Episodes -> relative risks -> every level -> prevalence by year -> attributable counts -> EASR -> rounded."""
    ep = FX.fx_episode(spark, d).join(FX.fx_postcode(spark, d), "pc7", "inner").select(
        F.substring("main_condition", 1, 3).alias("diag"), "sex_grp", age_band("age").alias("age_grp"),
        (2012 + F.col("uri") % 7).cast("int").alias("year"), "ca", "hb", F.lit(SCOTLAND).alias("scotland"))
    risks = AT.smoking_relative_risk(ep, spark.createDataFrame(CURRENT_RR, RR_RULE_SCHEMA),
                                     spark.createDataFrame(EX_RR, RR_RULE_SCHEMA))
    counts = (G.geo_unpivot(risks, CODE_LEVELS).where(F.col("code").isNotNull())
              .groupBy("code", "year", "sex_grp", "age_grp", "current", "ex").agg(F.count(F.lit(1)).cast("double").alias("n")))
    years = F.explode(F.sequence(F.lit(2012), F.lit(2018))).alias("year")
    area = (FX.area_counts(spark, d).select("code", years)
            .select("code", "year", F.explode(F.array(F.lit(1), F.lit(2))).alias("sex_grp"))
            .select("code", "year", "sex_grp", (15 + F.substring("code", 4, 9).cast("int") % 10 + F.col("sex_grp")).cast("double").alias("current_area"),
                    (20 + F.col("year") % 7).cast("double").alias("ex_area"), F.lit(19.0).alias("scot_current"), F.lit(22.0).alias("scot_ex")))
    ages = spark.createDataFrame(AGE_YEAR_PREV, "age_grp2 int, year int, sex_grp int, current_age double, ex_age double")
    a = F.col("age_grp")
    coarse = (F.when(a.between(8, 11), 2).when(a.between(12, 13), 3).when(a.between(14, 15), 4).when(a >= 16, 5))
    prepared = AT.attributable_fraction(AT.join_prevalence(counts, area, ages, band_of_age=coarse))
    run = run_indicator(prepared, ATTRIBUTABLE, None, "code", [], population=population_grid(spark, d, ATTRIBUTABLE))
    # estimates are published rounded: numerators to 10, rates to whole numbers; the last bits of a sum do not matter
    near = lambda c, to: F.bround(F.round(c, 6), to)
    return present(run.withColumns({"numerator": near("numerator", -1), **{c: near(c, 0) for c in ("rate", "lowci", "upci")}}))


# ---- emergency and multiple admissions ---------------------------------------------------------------
EMERGENCY = IndicatorSpec(ind_id=20305, measure="stdrate", time_agg=3, yearstart=2002, yearend=2007, year_type="calendar",
                          geography="all", epop_age="normal", epop_total=200000, hscp=True)
MULTIPLE = dataclasses.replace(EMERGENCY, ind_id=20306, epop_total=39000)
_ADMISSIONS = (
    ("s0", _STAYS_SQL),
    ("sy", "SELECT * REPLACE (CAST(2002 + (link_no * 7 + day(first_admission)) % 6 AS INT) AS year) FROM s0"),
    ("g", "SELECT s.*, p.ca, p.hb, 'S00000001' AS scotland FROM sy s JOIN fx_postcode p ON s.pc7 = p.pc7"),
    ("lg", " UNION ALL ".join(f"SELECT link_no, year, {c} AS code, first_admission, cis_marker, sex_grp, age FROM g" for c in CODE_LEVELS)),
    ("per", "SELECT link_no, year, code, sex_grp, " + _BAND.format(a="age") + " AS age_grp, age, n FROM (SELECT *, count(*) OVER "
            "(PARTITION BY link_no, year, code) AS n, row_number() OVER (PARTITION BY link_no, year, code ORDER BY first_admission, "
            "cis_marker) AS rn FROM lg) WHERE rn = 1"),
    ("ea", "SELECT code, year, sex_grp, age_grp, CAST(count(*) AS DOUBLE) AS numerator FROM per GROUP BY 1, 2, 3, 4"),
    ("ma", "SELECT code, year, sex_grp, age_grp, CAST(count(*) AS DOUBLE) AS numerator FROM per WHERE age >= 65 AND n >= 2 GROUP BY 1, 2, 3, 4"))


def admissions(spark, d):
    """People by area at every level, year, sex and age band: admitted (``ea``), and 65+ admitted twice or more (``ma``).

    One aggregate per person, year and area feeds both.
    """
    stays = E.stay_collapse(FX.fx_episode(spark, d))
    stays = stays.withColumn("year", (2002 + (F.col("link_no") * 7 + F.dayofmonth("first_admission")) % 6).cast("int"))
    placed = stays.join(FX.fx_postcode(spark, d), "pc7", "inner").withColumn("scotland", F.lit(SCOTLAND))
    per = E.multi_admission(placed, list(CODE_LEVELS), order_cols=("first_admission", "cis_marker"))
    return (per.groupBy("code", "year", "sex_grp", age_band("age").alias("age_grp"))
            .agg(F.sum("ea").cast("double").alias("ea"), F.sum("ma").cast("double").alias("ma")))


def _admission_job(spark, d, counts, spec, column, least_band):
    prepared = counts.where(F.col(column) > 0).withColumn("numerator", F.col(column)).drop("ea", "ma")
    return Job(spec, prepared, None, "code", [], population=population_grid(spark, d, spec, least_band))


@register("emergency_rate", sql=std_sql(EMERGENCY, *_ADMISSIONS, counts="ea"))
def q_emergency_rate(spark, d):
    return present(run_jobs([_admission_job(spark, d, admissions(spark, d), EMERGENCY, "ea", 1)]))


@register("multi_admission_rate", sql=std_sql(MULTIPLE, *_ADMISSIONS, counts="ma", least_band=14))
def q_multi_admission_rate(spark, d):
    return present(run_jobs([_admission_job(spark, d, admissions(spark, d), MULTIPLE, "ma", 14)]))


@register("admission_rates", sql=f"SELECT * FROM ({std_sql(EMERGENCY, *_ADMISSIONS, counts='ea')}) UNION ALL "
                                 f"SELECT * FROM ({std_sql(MULTIPLE, *_ADMISSIONS, counts='ma', least_band=14)})")
def q_admission_rates(spark, d):
    """Both indicators from one person aggregate, written once (its rows are area strata) and read by both runs."""
    counts = materialize(admissions(spark, d), "admissions")
    return present(run_jobs([_admission_job(spark, d, counts, EMERGENCY, "ea", 1),
                             _admission_job(spark, d, counts, MULTIPLE, "ma", 14)]))


# ---- incidence with deaths -----------------------------------------------------------------------------
INCIDENCE = IndicatorSpec(ind_id=1550, measure="stdrate", time_agg=3, yearstart=2002, yearend=2019, year_type="financial",
                          geography="council", epop_age="16+", epop_total=165800)
_DATE = "CAST(DATE '1996-01-01' + CAST(datediff('day', DATE '2024-01-01', {a}) * 290 + link_no % 90 AS INT) AS DATE)"
_INCIDENT = (
    ("mn", _MIN_SQL.replace("FROM fx_episode", "FROM fx_episode WHERE event_type <> 'signup'")),
    ("st", "SELECT link_no, cis_marker, age, sex_grp, pc7, " + _DATE.format(a="admission_date") + " AS admission_date, "
           "CAST(" + _DATE.format(a="admission_date") + " + CAST(datediff('day', admission_date, discharge_date) AS INT) * 400 AS DATE) AS discharge_date FROM mn"),
    ("de", "SELECT link_no, 'death ' || uri AS cis_marker, age, sex_grp, pc7, " + _DATE.format(a="admission_date") + " AS admission_date, "
           + _DATE.format(a="admission_date") + " AS discharge_date FROM fx_episode WHERE event_type = 'signup'"),
    ("al", "SELECT * FROM (SELECT * FROM st UNION ALL SELECT * FROM de) WHERE age > 15"),
    ("pv", "SELECT *, max(discharge_date) OVER (PARTITION BY link_no ORDER BY admission_date, cis_marker ROWS BETWEEN UNBOUNDED "
           "PRECEDING AND 1 PRECEDING) AS earlier FROM al"),
    ("nw", "SELECT *, " + _FIN.format(d="discharge_date") + " AS year FROM pv WHERE earlier IS NULL OR "
           "datediff('day', earlier, admission_date) >= 3650"),
    ("cn", "SELECT n.year, p.ca, n.sex_grp, " + _BAND.format(a="n.age") + " AS age_grp, CAST(count(*) AS DOUBLE) AS numerator "
           "FROM nw n JOIN fx_postcode p ON n.pc7 = p.pc7 WHERE n.year > 2001 GROUP BY 1, 2, 3, 4"),
    ("lk", "SELECT DISTINCT ca, hb FROM fx_area"),
    ("cj", "SELECT cn.*, lk.hb, 'S00000001' AS scotland FROM cn LEFT JOIN lk ON cn.ca = lk.ca"),
    ("rl", O.rollup_sql("cj", CODE_LEVELS, ["year", "sex_grp", "age_grp"], measures=("numerator",))))


@register("washout_incidence_rate", sql=std_sql(INCIDENCE, *_INCIDENT, counts="rl", least_band=4))
def q_washout_incidence_rate(spark, d):
    """Stays and deaths -> people without a discharge in ten years -> council counts -> EASR of 16+."""
    def spread(date):
        return F.date_add(F.lit("1996-01-01").cast("date"), (
            F.datediff(date, F.lit("2024-01-01").cast("date")) * 290 + F.col("link_no") % 90).cast("int"))

    ep = FX.fx_episode(spark, d)
    stays = E.stay_collapse_min(ep.where(F.col("event_type") != "signup"))
    length = F.datediff("discharge_date", "admission_date") * 400
    stays = stays.select("link_no", "cis_marker", "age", "sex_grp", "pc7", spread(F.col("admission_date")).alias("admission_date"),
                         F.date_add(spread(F.col("admission_date")), length).alias("discharge_date"))
    deaths = ep.where(F.col("event_type") == "signup").select(
        "link_no", F.concat(F.lit("death "), F.col("uri").cast("string")).alias("cis_marker"), "age", "sex_grp", "pc7",
        spread(F.col("admission_date")).alias("admission_date"))
    year = fin_year("discharge_date").cast("int")
    rows = E.incidence(stays.withColumn("year", year), deaths.withColumn(
        "year", fin_year("admission_date").cast("int")))
    placed = rows.join(FX.fx_postcode(spark, d).select("pc7", "ca"), "pc7", "inner")
    prepared = E.event_count(placed.withColumn("age_grp", age_band("age")), ["year", "ca", "sex_grp", "age_grp"])
    lookup = FX.fx_area(spark, d).select("ca", "hb").distinct()
    return present(run_indicator(prepared, INCIDENCE, lookup, "ca", ["hb", "scotland"],
                                 population=population_grid(spark, d, INCIDENCE, 4)))


# ---- closures ---------------------------------------------------------------------------------------------
# Test history: a chain of three hops, one behind it, a cycle and a code behind the cycle.
CHAIN = [("S12000003", "S12000004"), ("S12000004", "S12000005"), ("S12000005", "S12000099"), ("S12000007", "S12000004"),
         ("S12000010", "S12000011"), ("S12000011", "S12000010"), ("S12000012", "S12000010")]


@register("recode_area_chain", sql=O.with_fx(
    ("h", values_sql(CHAIN, ["old_code", "new_code"])),
    ("w", "SELECT old_code, new_code, 1 AS hop FROM h UNION ALL SELECT a.old_code, b.new_code, 2 FROM h a JOIN h b ON a.new_code = b.old_code "
          "UNION ALL SELECT a.old_code, c.new_code, 3 FROM h a JOIN h b ON a.new_code = b.old_code JOIN h c ON b.new_code = c.old_code"),
    ("z", "SELECT old_code, new_code FROM w WHERE new_code NOT IN (SELECT old_code FROM h)"),
    body="SELECT a.datazone, coalesce(z.new_code, a.ca) AS ca, a.ca IN ('S12000010', 'S12000011', 'S12000012') AS unresolved "
         "FROM fx_area a LEFT JOIN z ON a.ca = z.old_code"))
def q_recode_area_chain(spark, d):
    resolved, cyclic = G.code_history_closure(spark.createDataFrame(CHAIN, "old_code string, new_code string"))
    a = FX.fx_area(spark, d).select("datazone", "ca")
    a = a.join(cyclic.select(F.col("code").alias("ca"), F.lit(True).alias("unresolved")), "ca", "left")
    return G.recode_area(a, resolved, "ca").select("datazone", "ca", F.coalesce("unresolved", F.lit(False)).alias("unresolved"))


# Excluded areas with open years: a board to 1996, another from 2000 on, one council.
OPEN_EXCLUSIONS = [("S08000001", None, 1996), ("S08000002", 2000, None), ("S12000017", 1998, 1998)]


@register("incomplete_area_closure", sql=O.with_fx(
    *NEW, ("ex", values_sql(OPEN_EXCLUSIONS, ["code", "year_from", "year_to"])),
    ("up", "SELECT DISTINCT ca AS code, hb AS above FROM fx_area UNION SELECT ca, ca FROM fx_area UNION SELECT hb, hb FROM fx_area"),
    body=("SELECT code, ind_id, year, " + ", ".join(O.r6(c, c) for c in ("numerator", "rate", "lowci", "upci"))
          + ", def_period, trend_axis FROM new n WHERE NOT EXISTS (SELECT 1 FROM ex JOIN up ON up.above = ex.code WHERE up.code = n.code "
          "AND n.year BETWEEN coalesce(ex.year_from, 0) AND coalesce(ex.year_to, 9999)) AND numerator > 4 "
          "AND (NOT starts_with(code, 'S08') OR numerator >= 50) AND code <> 'S00000001'")))
def q_incomplete_area_closure(spark, d):
    """Areas under an excluded board leave with it; then the screens of small counts, at all levels and at board level."""
    area = FX.fx_area(spark, d)
    ind = run_indicator(FX.fx_prepared(spark, d), PCT1, area, "datazone", LEVELS)
    closure = G.area_closure(area.select(F.col("ca").alias("code"), F.col("hb").alias("parent")).unionByName(
        area.select(F.col("hb").alias("code"), F.lit(SCOTLAND).alias("parent"))).distinct())
    ex = spark.createDataFrame(OPEN_EXCLUSIONS, "code string, year_from int, year_to int")
    out = G.incomplete_area_filter(ind, ex, closure=closure)
    return present(G.screen_small(out, {"numerator": 4}, {"S08": ("numerator", 50)}, without=("S00",)))


# ---- periods of calendar years --------------------------------------------------------------------------
STRICT = IndicatorSpec(ind_id=99501, measure="percent", time_agg=3, yearstart=1995, yearend=2001, year_type="calendar", strict_years=True)
_GAPPY = "SELECT * FROM r WHERE NOT (year = 1998 AND CAST(substr(code, 4) AS INT) % 3 = 1) AND NOT (year = 1996 AND starts_with(code, 'S08'))"


def _strict_sql() -> str:
    win = "(PARTITION BY code ORDER BY year RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)"
    mean = ", ".join(f"CASE WHEN count({c}) OVER {win} = 3 THEN avg({c}) OVER {win} END AS {c}" for c in ("numerator", "denominator"))
    return O.with_fx(
        ("j", "SELECT p.*, a.ca, a.hb, 'S00000001' AS scotland FROM fx_prepared p LEFT JOIN fx_area a ON p.datazone = a.datazone"),
        ("r", O.rollup_sql("j", LEVELS, ["year"])), ("gp", _GAPPY),
        ("m", f"SELECT code, CAST(year - 1 AS INT) AS year, numerator, denominator FROM (SELECT code, year, {mean} FROM gp) WHERE denominator IS NOT NULL"),
        ("q", f"SELECT code, year, numerator, {O.percent_sql()} FROM m"), ("f", O.finalise_sql("q")),
        body=f"SELECT {_indicator_select(99501, 'calendar', 3)} FROM f")


@register("rolling_mean_strict", sql=_strict_sql())
def q_rolling_mean_strict(spark, d):
    """Three calendar years on series with gaps: a period that misses a year is not published."""
    area = G.geo_rollup(FX.fx_prepared(spark, d), FX.fx_area(spark, d), "datazone", LEVELS, keys=["year"])
    number = F.substring("code", 4, 9).cast("int")
    gappy = area.where(~((F.col("year") == 1998) & (number % 3 == 1)) & ~((F.col("year") == 1996) & F.col("code").startswith("S08")))
    return present(run_indicator(gappy, dataclasses.replace(STRICT, geography="all"), None, "code", []))


# ---- survey slices ---------------------------------------------------------------------------------------
# The published slices of the survey (indicator, age range, sex); None is the pooled category.
SMOKING_SLICES = [(20202, None, None), (1563, None, None), (1568, None, "Male"), (1569, None, "Female"), (1564, "16-34", None),
                  (1565, "16-64", None), (1566, "35-64", None), (1567, "65 And Over", None)]
_AGES = ["All", "16-34", "16-64", "35-64", "65 And Over"]
_SEXES = ["All", "Male", "Female"]


def _pick(values, n):
    return "CASE " + " ".join(f"WHEN {n} % {len(values)} = {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


@register("survey_slices", sql=O.with_fx(
    ("sv", "SELECT 'S12' || lpad(CAST(doc_id // 15 AS VARCHAR), greatest(6, length(CAST(doc_id // 15 AS VARCHAR)))::INT, '0') AS code, "
           f"CAST(2010 + doc_id // 15 % 3 AS INT) AS year, {_pick(_AGES, 'doc_id')} AS age_grp, {_pick(_SEXES, 'doc_id')} AS sex_grp, "
           "CAST(50 + doc_id % 40 AS DOUBLE) AS rate, CAST(49 + doc_id % 40 - quality AS DOUBLE) AS lowci, CAST(51 + doc_id % 40 + toxic AS DOUBLE) AS upci FROM labels"),
    ("sl", values_sql([(i, a or "All", s or "All") for i, a, s in SMOKING_SLICES], ["ind_id", "age_grp", "sex_grp"])),
    body=("SELECT code, CAST(ind_id AS INT) AS ind_id, year, CAST(NULL AS DOUBLE) AS numerator, max(rate) AS rate, max(lowci) AS lowci, max(upci) AS upci, "
          f"{O.labels_sql('survey', 1)} FROM sv JOIN sl USING (age_grp, sex_grp) GROUP BY code, ind_id, year")))
def q_survey_slices(spark, d):
    """The eight slices of the survey by age range and sex, from one scan."""
    n = F.col("doc_id")
    lab = read_table(spark, d, "labels", ["doc_id", "quality", "toxic"])
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))
    measures = F.array(*[F.struct(F.lit(m).alias("measure"), v.cast("double").alias("value")) for m, v in (
        ("Percent", 50 + n % 40), ("95% Lower Confidence Limit, Percent", 49 + n % 40 - F.col("quality")),
        ("95% Upper Confidence Limit, Percent", 51 + n % 40 + F.col("toxic")))])
    survey = (lab.select(FX.area_code("S12", F.floor(n / 15)).alias("code"), (2010 + F.floor(n / 15) % 3).cast("int").alias("year"),
                         pick(_AGES).alias("age_grp"), pick(_SEXES).alias("sex_grp"), F.explode(measures).alias("m"))
              .select("code", "year", "age_grp", "sex_grp", "m.measure", "m.value"))
    slices = spark.createDataFrame(SMOKING_SLICES, "ind_id int, age_grp string, sex_grp string")
    names = {"Percent": "rate", "95% Lower Confidence Limit, Percent": "lowci", "95% Upper Confidence Limit, Percent": "upci"}
    wide = RS.measure_pivot(RS.match_slices(survey, slices, ["age_grp", "sex_grp"]), ["code", "ind_id", "year"], "measure",
                            list(names), "value", agg="max", names=names)
    out = wide.withColumn("numerator", F.lit(None).cast("double"))
    return P.add_period_labels(out, "survey", 1).select(*INDICATOR_COLUMNS)


# ---- checks gathered while the result is written -----------------------------------------------------------
@register("qa_observed", sql=O.with_fx(*NEW, body=(
    "SELECT count(*) AS rows, count(*) FILTER (WHERE rate < lowci OR rate > upci) AS ci_error_total, "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in Q.CONTRACT) + " FROM new")))
def q_qa_observed(spark, d):
    """Rows, nulls and interval faults of an indicator from the one job that writes it."""
    from ..sources.sinks import write_indicator

    ind, seen = Q.observed(run_indicator(FX.fx_prepared(spark, d), PCT1, FX.fx_area(spark, d), "datazone", LEVELS))
    write_indicator(ind, scratch_path(spark, "indicator"))
    got = seen.get
    return spark.createDataFrame([tuple(got.values())], ", ".join(f"{k} bigint" for k in got))


# ---- sources --------------------------------------------------------------------------------------------------
@register("union_files_tagged", sql=(
    "SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) = 1997 THEN o_orderpriority END AS priority, CAST(year(o_orderdate) AS INT) AS year "
    "FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997"))
def q_union_files_tagged(spark, d):
    """One scan over a file set per year, of which one has a further column; the year comes from the path."""
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"])
    folder, paths = scratch_path(spark, "yearly"), []
    for year in (1995, 1996, 1997):
        own = o.where(F.year("o_orderdate") == year)
        cols = ["o_orderkey", "o_custkey"] + ([F.col("o_orderpriority").alias("priority")] if year == 1997 else [])
        paths.append(f"{folder}/orders_{year}.parquet")
        own.select(*cols).write.parquet(paths[-1])
    return read_tagged(spark, paths, r"orders_(\d{4})\.parquet").select("o_orderkey", "o_custkey", "priority", "year")


@register("clean_year_end", sql=(
    "SELECT o_orderkey, 'Year ending March ' || year(o_orderdate) AS label, CAST(year(o_orderdate) - 1 AS INT) AS year FROM orders"))
def q_clean_year_end(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    label = F.concat(F.lit("Year ending March "), F.year("o_orderdate").cast("string"))
    return o.select("o_orderkey", label.alias("label")).withColumn(
        "year", year_end_to_start(F.regexp_extract("label", r"(\d{4})$", 1)))
