"""Attributable fractions, precomputed rates, disclosure and publication screens
(SURVEY B-11..B-14, C-13, F-11, F-15, F-16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.age import age_band
from ..operators import attributable as AT
from ..operators import disclosure as DC
from ..operators import geography as G
from ..operators import periods as P
from ..operators import rates as R
from ..operators import reshape as RS
from ..sources import fixtures as FX
from ..sources.refdata import RR_RULE_SCHEMA, smoking_rr_rules, values_sql
from ..sources.tables import read_table
from . import oracle_sql as O
from .indicator import INDICATOR_COLUMNS, run_indicator
from .q_indicator import CRUDE, LEVELS, PCT1, crude_indicator_sql, percent_indicator_sql
from .q_qa import NEW
from .registry import present, register

CURRENT_RR, EX_RR = smoking_rr_rules("admissions")
# Test prevalence by coarse age band and sex: (age_grp2, sex, current_age, ex_age).
AGE_PREV = [(1, 1, 24.0, 10.0), (1, 2, 21.0, 9.0), (2, 1, 22.0, 18.0), (2, 2, 20.0, 16.0),
            (3, 1, 18.0, 25.0), (3, 2, 16.0, 22.0), (4, 1, 12.0, 32.0), (4, 2, 11.0, 27.0)]
AGE_PREV_SCHEMA = "age_grp2 int, sex_grp int, current_age double, ex_age double"
_BAND_SQL = ("CASE WHEN age_grp <= 7 THEN 1 WHEN age_grp <= 11 THEN 2 WHEN age_grp <= 15 THEN 3 ELSE 4 END")


def _band():
    a = F.col("age_grp")
    return F.when(a <= 7, 1).when(a <= 11, 2).when(a <= 15, 3).otherwise(4)


_EV_SQL = ("SELECT e.uri, substr(e.main_condition, 1, 3) AS diag, e.sex_grp, "
           "CAST(CASE WHEN e.age BETWEEN 0 AND 200 THEN least(floor(e.age / 5) + 1, 19) END AS INT) AS age_grp, "
           "CAST(year(e.admission_date) AS INT) AS year, p.ca AS code FROM fx_episode e "
           "JOIN fx_postcode p ON e.pc7 = p.pc7")
_RULE_COND = ("ev.sex_grp = {t}.sex_grp AND ev.diag BETWEEN {t}.diag_lo AND {t}.diag_hi "
              "AND coalesce(ev.age_grp >= {t}.age_lo, {t}.age_lo IS NULL) "
              "AND coalesce(ev.age_grp <= {t}.age_hi, {t}.age_hi IS NULL)")
_RR_JOIN = ("SELECT ev.*, coalesce(c.rr, 0) AS current, coalesce(x.rr, 0) AS ex FROM ev "
            "LEFT JOIN rc c ON " + _RULE_COND.format(t="c") + " LEFT JOIN rx x ON " + _RULE_COND.format(t="x")
            + " WHERE coalesce(c.rr, 0) > 0")
_AREA_PREV = ("SELECT 'S12' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS code, s.sex_grp, "
              "CAST(15 + n_nationkey % 10 + s.sex_grp AS DOUBLE) AS current_area, "
              "CAST(20 + n_nationkey % 7 AS DOUBLE) AS ex_area, CAST(19 AS DOUBLE) AS scot_current, CAST(22 AS DOUBLE) AS scot_ex "
              "FROM nation, (SELECT 1 AS sex_grp UNION ALL SELECT 2) s")


def _events(spark, d):
    ep = FX.fx_episode(spark, d).join(FX.fx_postcode(spark, d).select("pc7", "ca"), "pc7", "inner")
    return ep.select("uri", F.substring("main_condition", 1, 3).alias("diag"), "sex_grp",
                     age_band("age").alias("age_grp"), F.year("admission_date").cast("int").alias("year"),
                     F.col("ca").alias("code"))


def _area_prev(spark, d):
    n = read_table(spark, d, "nation", ["n_nationkey"])
    sexes = F.explode(F.array(F.lit(1), F.lit(2)))
    return (n.select("n_nationkey", sexes.alias("sex_grp"))
            .select(FX.area_code("S12", "n_nationkey").alias("code"), "sex_grp",
                    (15 + F.col("n_nationkey") % 10 + F.col("sex_grp")).cast("double").alias("current_area"),
                    (20 + F.col("n_nationkey") % 7).cast("double").alias("ex_area"),
                    F.lit(19.0).alias("scot_current"), F.lit(22.0).alias("scot_ex")))


def _risks(spark, d):
    rc = spark.createDataFrame(CURRENT_RR, RR_RULE_SCHEMA)
    rx = spark.createDataFrame(EX_RR, RR_RULE_SCHEMA)
    return AT.smoking_relative_risk(_events(spark, d), rc, rx)


def _counts(spark, d):
    ev = _risks(spark, d)
    return ev.groupBy("code", "year", "sex_grp", "age_grp", "current", "ex").agg(
        F.count(F.lit(1)).cast("double").alias("n"))


def _sql(*ctes, body):
    names = ["sex_grp", "diag_lo", "diag_hi", "age_lo", "age_hi", "rr"]
    base = [("rc", values_sql(CURRENT_RR, names)), ("rx", values_sql(EX_RR, names)),
            ("ev", _EV_SQL), ("rj", _RR_JOIN),
            ("cnt", "SELECT code, year, sex_grp, age_grp, current, ex, CAST(count(*) AS DOUBLE) AS n FROM rj "
                    "GROUP BY 1, 2, 3, 4, 5, 6"),
            ("ap", _AREA_PREV),
            ("gp", values_sql(AGE_PREV, ["age_grp2", "sex_grp", "current_age", "ex_age"])),
            ("jp", f"SELECT c.*, ap.current_area, ap.ex_area, ap.scot_current, ap.scot_ex, {_BAND_SQL} AS age_grp2, "
                   "gp.current_age, gp.ex_age FROM cnt c LEFT JOIN ap ON c.code = ap.code AND c.sex_grp = ap.sex_grp "
                   f"LEFT JOIN gp ON {_BAND_SQL.replace('age_grp', 'c.age_grp')} = gp.age_grp2 AND c.sex_grp = gp.sex_grp")]
    return O.with_fx(*base, *ctes, body=body)


@register("relative_risk", sql=_sql(body="SELECT uri, diag, sex_grp, age_grp, current, ex FROM rj"))
def q_relative_risk(spark, d):
    return _risks(spark, d).select("uri", "diag", "sex_grp", "age_grp", "current", "ex")


@register("join_prevalence", sql=_sql(body=(
    "SELECT code, year, sex_grp, age_grp, current, ex, n, current_area, ex_area, scot_current, scot_ex, "
    "age_grp2, current_age, ex_age FROM jp")))
def q_join_prevalence(spark, d):
    ages = spark.createDataFrame(AGE_PREV, AGE_PREV_SCHEMA)
    out = AT.join_prevalence(_counts(spark, d), _area_prev(spark, d), ages, band_of_age=_band())
    return out.select("code", "year", "sex_grp", "age_grp", "current", "ex", "n", "current_area", "ex_area",
                      "scot_current", "scot_ex", "age_grp2", "current_age", "ex_age")


_SAF = ("((current_area / scot_current * current_age / 100) * (current - 1) + "
        "(ex_area / scot_ex * ex_age / 100) * (ex - 1))")


@register("attributable_fraction", sql=_sql(body=(
    f"SELECT code, year, sex_grp, age_grp, {O.r6(f'sum(n * ({_SAF} / (1 + {_SAF})))', 'numerator')} "
    "FROM jp GROUP BY 1, 2, 3, 4")))
def q_attributable_fraction(spark, d):
    ages = spark.createDataFrame(AGE_PREV, AGE_PREV_SCHEMA)
    j = AT.join_prevalence(_counts(spark, d), _area_prev(spark, d), ages, band_of_age=_band())
    return present(AT.attributable_fraction(j))


# ---- F-15 survey rates with supplied intervals ------------------------------------------------
_SURVEY_SQL = (
    "SELECT 'S12' || lpad(CAST(doc_id AS VARCHAR), greatest(6, length(CAST(doc_id AS VARCHAR)))::INT, '0') AS code, CAST(2010 + doc_id % 3 AS INT) AS year, "
    "CASE WHEN doc_id % 2 = 0 THEN 'Male' ELSE 'Female' END AS sex, m.measure, "
    "CAST(CASE m.measure WHEN 'percent' THEN 50 + doc_id % 40 WHEN 'lower' THEN 49 + doc_id % 40 - quality "
    "ELSE 51 + doc_id % 40 + toxic END AS DOUBLE) AS value FROM labels, "
    "(SELECT 'percent' AS measure UNION ALL SELECT 'lower' UNION ALL SELECT 'upper') m")


def _survey(spark, d):
    lab = read_table(spark, d, "labels", ["doc_id", "quality", "toxic"])
    ms = F.explode(F.array(F.lit("percent"), F.lit("lower"), F.lit("upper"))).alias("measure")
    x = lab.select("*", ms)
    base = 50 + F.col("doc_id") % 40
    value = (F.when(F.col("measure") == "percent", base)
             .when(F.col("measure") == "lower", base - 1 - F.col("quality"))
             .otherwise(base + 1 + F.col("toxic"))).cast("double")
    return x.select(FX.area_code("S12", "doc_id").alias("code"), (2010 + F.col("doc_id") % 3).cast("int").alias("year"),
                    F.when(F.col("doc_id") % 2 == 0, "Male").otherwise("Female").alias("sex"), "measure",
                    value.alias("value"))


@register("precomputed_indicator", sql=O.with_fx(
    ("s", _SURVEY_SQL),
    body=("SELECT code, CAST(99301 AS INT) AS ind_id, year, CAST(NULL AS DOUBLE) AS numerator, "
          "max(CASE WHEN measure = 'percent' THEN value END) AS rate, max(CASE WHEN measure = 'lower' THEN value END) "
          "AS lowci, max(CASE WHEN measure = 'upper' THEN value END) AS upci, "
          f"{O.labels_sql('survey', 1)} FROM s WHERE sex = 'Female' GROUP BY code, year")))
def q_precomputed_indicator(spark, d):
    s = _survey(spark, d).where(F.col("sex") == "Female")
    wide = RS.measure_pivot(s, ["code", "year"], "measure", ["percent", "lower", "upper"], "value", agg="max",
                            names={"percent": "rate", "lower": "lowci", "upper": "upci"})
    out = (wide.withColumn("ind_id", F.lit(99301)).withColumn("numerator", F.lit(None).cast("double")))
    return P.add_period_labels(out, "survey", 1).select(*INDICATOR_COLUMNS)


# ---- F-16 disclosure control -------------------------------------------------------------------
_DISC_SQL = (
    "SELECT a.ca AS code, a.hb, CAST(year(o_orderdate) AS INT) AS year, CAST(count(*) AS DOUBLE) AS numerator "
    "FROM orders JOIN fx_area a ON o_custkey = a.datazone GROUP BY 1, 2, 3")


@register("disclosure_control", sql=O.with_fx(
    ("c", _DISC_SQL),
    ("w", "SELECT *, numerator < 80 AS small, sum(CAST(numerator < 80 AS INT)) OVER (PARTITION BY hb, year) AS n_small, "
          "row_number() OVER (PARTITION BY hb, year ORDER BY numerator < 80, numerator, code) AS rk FROM c"),
    body=("SELECT code, hb, year, CASE WHEN small OR (n_small = 1 AND NOT small AND rk = 1) THEN NULL ELSE numerator "
          "END AS numerator, (small OR (n_small = 1 AND NOT small AND rk = 1)) AS suppressed FROM w")))
def q_disclosure_control(spark, d):
    o = read_table(spark, d, "orders", ["o_custkey", "o_orderdate"])
    a = FX.fx_area(spark, d).select("datazone", "ca", "hb")
    c = (o.join(a, o.o_custkey == a.datazone)
         .groupBy(F.col("ca").alias("code"), "hb", F.year("o_orderdate").cast("int").alias("year"))
         .agg(F.count(F.lit(1)).cast("double").alias("numerator")))
    return DC.disclosure_control(c, "hb", keys=["year"], k=80).select("code", "hb", "year", "numerator", "suppressed")


# ---- B-12..B-14 publication screens -------------------------------------------------------------
EXCLUSIONS = [("S12000003", 1995, 1996), ("S08000002", 1999, 2001), ("S12000017", 2001, 2001)]


@register("incomplete_area_filter", sql=O.with_fx(
    *NEW, ("ex", values_sql(EXCLUSIONS, ["code", "year_from", "year_to"])),
    body=("SELECT code, ind_id, year, " + ", ".join(O.r6(c, c) for c in ("numerator", "rate", "lowci", "upci"))
          + ", def_period, trend_axis FROM new n WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.code = n.code AND "
          "n.year BETWEEN ex.year_from AND ex.year_to) AND numerator > 4")))
def q_incomplete_area_filter(spark, d):
    ind = run_indicator(FX.fx_prepared(spark, d), PCT1, FX.fx_area(spark, d), "datazone", LEVELS)
    ex = spark.createDataFrame(EXCLUSIONS, "code string, year_from int, year_to int")
    return present(G.incomplete_area_filter(ind, ex).where(F.col("numerator") > 4))


def _round_sql():
    inner = crude_indicator_sql(CRUDE)
    return (f"SELECT code, ind_id, year, round_even(numerator / 10, 0) * 10 AS numerator, "
            "round_even(rate, 0) AS rate, round_even(lowci, 0) AS lowci, round_even(upci, 0) AS upci, "
            f"def_period, trend_axis FROM ({inner})")


@register("round_estimate", sql=_round_sql())
def q_round_estimate(spark, d):
    prep = FX.fx_prepared(spark, d).drop("denominator")
    ind = run_indicator(prep, CRUDE, FX.fx_area(spark, d), "datazone", LEVELS,
                        population=FX.fx_population_total(spark, d))
    return present(R.round_estimate(present(ind)))


def _zero_sql():
    inner = percent_indicator_sql(99006, 1, "financial")
    inner = inner.replace("SELECT * FROM r WHERE year BETWEEN",
                          "SELECT * REPLACE (CASE WHEN year % 2 = 0 THEN denominator ELSE 0 END AS denominator) "
                          "FROM r WHERE year BETWEEN")
    return (f"SELECT code, ind_id, year, numerator, nullif(rate, 0) AS rate, nullif(lowci, 0) AS lowci, "
            f"nullif(upci, 0) AS upci, def_period, trend_axis FROM ({inner})")


@register("zero_to_null", sql=_zero_sql())
def q_zero_to_null(spark, d):
    prep = FX.fx_prepared(spark, d)
    area = FX.fx_area(spark, d)
    r = G.geo_rollup(prep, area, "datazone", LEVELS, keys=["year"])
    r = r.withColumn("denominator", F.when(F.col("year") % 2 == 0, F.col("denominator")).otherwise(F.lit(0.0)))
    from .indicator import finalised
    f = G.level_filter(r.where(F.col("year").between(1995, 2001)))
    out = finalised(P.rolling_mean(f, ["code"], 1), PCT1)
    return present(R.zero_to_null(out, ["rate", "lowci", "upci"]))
