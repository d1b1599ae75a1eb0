"""Episode / stay / person queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.age import age_band, in_age_range
from ..functions.dates import fin_year
from ..operators import episodes as E
from ..sources import fixtures as FX
from ..sources.refdata import SCOTLAND
from ..sources.tables import read_table
from . import oracle_sql as O
from .registry import present, register

DIAG_COLS = ["main_condition"] + [f"other_condition_{k}" for k in range(1, 6)]
_FIN = "CAST(CASE WHEN month({d}) > 3 THEN year({d}) ELSE year({d}) - 1 END AS INT)"


@register("src_warehouse_extract", sql=O.with_fx(body=(
    "SELECT * FROM fx_episode WHERE admission_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' "
    "AND age BETWEEN 15 AND 80 AND sex_grp <> 9 AND regexp_matches(main_condition, 'C34|J4')")))
def q_src_warehouse_extract(spark, d):
    ep = FX.fx_episode(spark, d)
    return ep.where(F.col("admission_date").between(F.lit("2024-01-05").cast("date"),
                                                    F.lit("2024-01-25").cast("date"))
                    & in_age_range("age", 15, 80) & (F.col("sex_grp") != 9)
                    & E.diag_match("main_condition", "C34|J4"))


@register("diag_regex_filter", sql=O.with_fx(body=(
    "SELECT uri, link_no, main_condition FROM fx_episode WHERE regexp_matches(main_condition, '^C|J4') "
    "AND NOT regexp_matches(main_condition, 'C34[0-2]')")))
def q_diag_regex_filter(spark, d):
    ep = FX.fx_episode(spark, d)
    return (ep.where(E.diag_match("main_condition", "^C|J4", exclude="C34[0-2]"))
            .select("uri", "link_no", "main_condition"))


def _any_sql(pred: str) -> str:
    return " OR ".join(pred.format(c=c) for c in DIAG_COLS)


@register("diag_any_position", sql=O.with_fx(body=(
    f"SELECT uri, {', '.join(DIAG_COLS)} FROM fx_episode_wide WHERE "
    + _any_sql("coalesce(regexp_matches({c}, 'X85|Y0'), false)"))))
def q_diag_any_position(spark, d):
    ep = FX.fx_episode_wide(spark, d)
    return ep.where(E.diag_match(DIAG_COLS, "X85|Y0")).select("uri", *DIAG_COLS)


@register("diag_range_any", sql=O.with_fx(body=(
    "SELECT uri, link_no FROM fx_episode_wide WHERE "
    + _any_sql("coalesce({c} BETWEEN 'X850' AND 'Y099', false)"))))
def q_diag_range_any(spark, d):
    ep = FX.fx_episode_wide(spark, d)
    return ep.where(E.diag_in_range(DIAG_COLS, "X850", "Y099")).select("uri", "link_no")


@register("conditional_filter", sql=O.with_fx(body=(
    "SELECT uri, event_type, main_condition FROM fx_episode_wide WHERE event_type = 'purchase' "
    "OR (event_type = 'click' AND (" + _any_sql("coalesce(regexp_matches({c}, 'J44[0-4]'), false)") + "))")))
def q_conditional_filter(spark, d):
    ep = FX.fx_episode_wide(spark, d)
    cond = (F.col("event_type") == "purchase") | (
        (F.col("event_type") == "click") & E.diag_match(DIAG_COLS, "J44[0-4]"))
    return ep.where(cond).select("uri", "event_type", "main_condition")


@register("semi_stay", sql=O.with_fx(body=(
    "SELECT uri, link_no, cis_marker FROM fx_episode e WHERE EXISTS (SELECT 1 FROM fx_episode q "
    "WHERE q.link_no = e.link_no AND q.cis_marker = e.cis_marker AND regexp_matches(q.main_condition, '^F10'))")))
def q_semi_stay(spark, d):
    ep = FX.fx_episode(spark, d)
    return E.semi_stay(ep, E.diag_match("main_condition", "^F10")).select("uri", "link_no", "cis_marker")


_STAYS_SQL = (
    "SELECT f.link_no, f.cis_marker, f.age, f.sex_grp, f.pc7, f.admission_date AS first_admission, "
    "l.discharge_date AS last_discharge, " + _FIN.format(d="l.discharge_date") + " AS year "
    "FROM (SELECT *, row_number() OVER (PARTITION BY link_no, cis_marker ORDER BY admission_date, "
    "discharge_date, uri) AS rn FROM fx_episode) f JOIN (SELECT *, row_number() OVER (PARTITION BY "
    "link_no, cis_marker ORDER BY admission_date DESC, discharge_date DESC, uri DESC) AS rn FROM fx_episode) l "
    "ON f.link_no = l.link_no AND f.cis_marker = l.cis_marker AND f.rn = 1 AND l.rn = 1")


def _stays(spark, d):
    return E.stay_collapse(FX.fx_episode(spark, d))


@register("stay_collapse", sql=O.with_fx(body=_STAYS_SQL))
def q_stay_collapse(spark, d):
    return _stays(spark, d)


@register("stay_collapse_windowed", sql=O.with_fx(body=(
    "SELECT DISTINCT link_no, cis_marker, "
    "first_value(age) OVER w AS age, first_value(sex_grp) OVER w AS sex_grp, "
    "min(admission_date) OVER (PARTITION BY link_no, cis_marker) AS admission_date, "
    "max(discharge_date) OVER (PARTITION BY link_no, cis_marker) AS discharge_date "
    "FROM fx_episode WINDOW w AS (PARTITION BY link_no, cis_marker ORDER BY admission_date, discharge_date, uri "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")))
def q_stay_collapse_windowed(spark, d):
    return E.stay_collapse_windowed(FX.fx_episode(spark, d))


_MIN_SQL = ("SELECT link_no, cis_marker, min(age) AS age, min(sex_grp) AS sex_grp, min(pc7) AS pc7, "
            "min(admission_date) AS admission_date, max(discharge_date) AS discharge_date "
            "FROM fx_episode GROUP BY link_no, cis_marker")


@register("stay_collapse_min", sql=O.with_fx(body=_MIN_SQL))
def q_stay_collapse_min(spark, d):
    return E.stay_collapse_min(FX.fx_episode(spark, d))


@register("person_year_last", sql=O.with_fx(
    ("s", _STAYS_SQL),
    ("m", "SELECT link_no, year, max(last_discharge) AS md FROM s GROUP BY link_no, year"),
    body=("SELECT s.link_no, s.year, max(age) AS age, max(sex_grp) AS sex_grp, max(pc7) AS pc7, "
          "max(last_discharge) AS last_discharge FROM s JOIN m ON s.link_no = m.link_no AND s.year = m.year "
          "AND s.last_discharge = m.md GROUP BY s.link_no, s.year")))
def q_person_year_last(spark, d):
    return E.person_year_last(_stays(spark, d), order_col="last_discharge")


@register("person_year_first", sql=O.with_fx(
    ("s", _STAYS_SQL),
    body=("SELECT year, link_no, cis_marker, age, sex_grp, pc7, first_admission, last_discharge FROM "
          "(SELECT *, row_number() OVER (PARTITION BY year, link_no ORDER BY first_admission, last_discharge, "
          "cis_marker) AS rn FROM s) WHERE rn = 1")))
def q_person_year_first(spark, d):
    return E.person_year_first(_stays(spark, d), order_cols=("first_admission", "last_discharge", "cis_marker"),
                               attrs=["cis_marker", "age", "sex_grp", "pc7", "first_admission",
                                      "last_discharge"])


@register("stay_or_death_union", sql=O.with_fx(
    ("u", "SELECT link_no, cis_marker, CAST(year(admission_date) AS INT) AS year, admission_date, uri, age, "
          "sex_grp, 'stay' AS source FROM fx_episode WHERE event_type <> 'signup' UNION ALL "
          "SELECT link_no, CAST(NULL AS VARCHAR), CAST(year(admission_date) AS INT), admission_date, uri, age, "
          "sex_grp, 'death' FROM fx_episode WHERE event_type = 'signup'"),
    body=("SELECT link_no, cis_marker, year, age, sex_grp, source FROM (SELECT *, row_number() OVER "
          "(PARTITION BY link_no, cis_marker, year ORDER BY admission_date, uri) AS rn FROM u) WHERE rn = 1")))
def q_stay_or_death_union(spark, d):
    ep = FX.fx_episode(spark, d).withColumn("year", F.year("admission_date").cast("int"))
    cols = ["link_no", "cis_marker", "year", "admission_date", "uri", "age", "sex_grp"]
    stays = ep.where(F.col("event_type") != "signup").select(*cols).withColumn("source", F.lit("stay"))
    deaths = (ep.where(F.col("event_type") == "signup").select(*cols)
              .withColumn("cis_marker", F.lit(None).cast("string")).withColumn("source", F.lit("death")))
    return E.stay_or_death_union(stays, deaths)


@register("washout_incidence", sql=O.with_fx(
    ("s", _MIN_SQL),
    body=("SELECT link_no, cis_marker, admission_date, discharge_date, prev_discharge_date, "
          "(prev_discharge_date IS NULL OR datediff('day', prev_discharge_date, admission_date) >= 3) AS new_case "
          "FROM (SELECT *, lag(discharge_date) OVER (PARTITION BY link_no ORDER BY admission_date, cis_marker) "
          "AS prev_discharge_date FROM s)")))
def q_washout_incidence(spark, d):
    stays = E.stay_collapse_min(FX.fx_episode(spark, d)).select(
        "link_no", "cis_marker", "admission_date", "discharge_date")
    return E.washout_incidence(stays, washout=3, unit_days=1)


@register("multi_admission", sql=O.with_fx(
    ("s", _STAYS_SQL),
    ("g", "SELECT s.*, p.ca, p.hb, 'S00000001' AS scotland FROM s JOIN fx_postcode p ON s.pc7 = p.pc7"),
    ("l", " UNION ALL ".join(f"SELECT link_no, year, {c} AS code, first_admission, cis_marker, sex_grp, age "
                             "FROM g" for c in ("ca", "hb", "scotland"))),
    body=("SELECT link_no, year, code, admissions, sex_grp, age, 1 AS ea, "
          "CAST(age >= 65 AND admissions >= 2 AS INT) AS ma FROM (SELECT link_no, year, code, "
          "count(*) OVER (PARTITION BY link_no, year, code) AS admissions, sex_grp, age, row_number() OVER "
          "(PARTITION BY link_no, year, code ORDER BY first_admission, cis_marker) AS rn FROM l) WHERE rn = 1")))
def q_multi_admission(spark, d):
    stays = _stays(spark, d).join(FX.fx_postcode(spark, d), "pc7", "inner").withColumn("scotland", F.lit(SCOTLAND))
    return E.multi_admission(stays, ["ca", "hb", "scotland"], order_cols=("first_admission", "cis_marker"))


@register("join_postcode", sql=O.with_fx(body=(
    "SELECT e.uri, e.pc7, p.ca, p.hb FROM fx_episode e JOIN fx_postcode p ON e.pc7 = p.pc7")))
def q_join_postcode(spark, d):
    ep = FX.fx_episode(spark, d).select("uri", "pc7")
    return ep.join(FX.fx_postcode(spark, d), "pc7", "inner").select("uri", "pc7", "ca", "hb")


@register("event_count", sql=O.with_fx(body=(
    "SELECT CAST(year(e.admission_date) AS INT) AS year, p.ca, e.sex_grp, "
    "CAST(CASE WHEN e.age BETWEEN 0 AND 200 THEN least(floor(e.age / 5) + 1, 19) END AS INT) AS age_grp, "
    "CAST(count(*) AS DOUBLE) AS numerator FROM fx_episode e JOIN fx_postcode p ON e.pc7 = p.pc7 "
    "GROUP BY 1, 2, 3, 4")))
def q_event_count(spark, d):
    ep = FX.fx_episode(spark, d).join(FX.fx_postcode(spark, d), "pc7", "inner")
    ep = ep.select(F.year("admission_date").cast("int").alias("year"), "ca", "sex_grp",
                   age_band("age").alias("age_grp"))
    return present(E.event_count(ep, ["year", "ca", "sex_grp", "age_grp"]))


_AGE = "(p_size * 5 - 10)"


@register("age_band", sql=(
    f"SELECT p_partkey, {_AGE} AS age, CAST(CASE WHEN {_AGE} BETWEEN 0 AND 200 THEN "
    f"least(floor({_AGE} / 5) + 1, 19) END AS INT) AS age_grp FROM part"))
def q_age_band(spark, d):
    p = read_table(spark, d, "part", ["p_partkey", "p_size"])
    a = p.select("p_partkey", (F.col("p_size") * 5 - 10).alias("age"))
    return a.withColumn("age_grp", age_band("age"))


@register("age_subset", sql=f"SELECT p_partkey, {_AGE} AS age FROM part WHERE {_AGE} BETWEEN 11 AND 25")
def q_age_subset(spark, d):
    p = read_table(spark, d, "part", ["p_partkey", "p_size"])
    return p.select("p_partkey", (F.col("p_size") * 5 - 10).alias("age")).where(in_age_range("age", 11, 25))


@register("fin_year", sql="SELECT o_orderkey, " + _FIN.format(d="o_orderdate") + " AS fin_year FROM orders")
def q_fin_year(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    return o.select("o_orderkey", fin_year("o_orderdate").alias("fin_year"))


# ---- the whole source flow: episodes -> stays -> areas -> indicator --------------------------------
def _episode_rates_sql() -> str:
    any_hit = " OR ".join(f"coalesce(regexp_matches({c}, 'F10|K25'), false)" for c in DIAG_COLS)
    stays = _STAYS_SQL.replace("FROM fx_episode)", "FROM e2)").replace(
        _FIN.format(d="l.discharge_date"), "CAST(year(l.discharge_date) AS INT)")
    return O.with_fx(
        ("q", f"SELECT DISTINCT link_no, cis_marker FROM fx_episode_wide WHERE {any_hit}"),
        ("e2", "SELECT e.* FROM fx_episode e JOIN q ON e.link_no = q.link_no AND e.cis_marker = q.cis_marker"),
        ("s", stays),
        ("cnt", "SELECT s.year, p.ca, CAST(count(*) AS DOUBLE) AS numerator FROM s JOIN fx_postcode p "
                "ON s.pc7 = p.pc7 GROUP BY 1, 2"),
        ("lk", "SELECT DISTINCT ca, hb FROM fx_area"),
        ("j", "SELECT cnt.*, lk.hb, 'S00000001' AS scotland FROM cnt LEFT JOIN lk ON cnt.ca = lk.ca"),
        ("r", O.rollup_sql("j", ["ca", "hb", "scotland"], ["year"], measures=("numerator",))),
        ("pp", "SELECT CAST(y.year AS INT) AS year, c.code, CAST(20 * c.n AS DOUBLE) AS denominator FROM fx_counts c, "
               "(SELECT range AS year FROM range(2020, 2031)) y "
               "WHERE NOT starts_with(c.code, 'S11') AND NOT starts_with(c.code, 'S37')"),
        ("fj", "SELECT coalesce(r.year, pp.year) AS year, coalesce(r.code, pp.code) AS code, "
               "coalesce(r.numerator, 0) AS numerator, pp.denominator FROM r FULL JOIN pp "
               "ON r.year = pp.year AND r.code = pp.code"),
        ("l", "SELECT * FROM fj WHERE year BETWEEN 2020 AND 2030 AND code IS NOT NULL "
              "AND NOT starts_with(code, 'S11') AND NOT starts_with(code, 'S37') AND denominator IS NOT NULL"),
        ("qq", f"SELECT code, year, numerator, {O.crude_sql(100000)} FROM l"),
        ("f", O.finalise_sql("qq")),
        body=("SELECT " + O.INDICATOR_SELECT.format(ind=99401).replace(
            "def_period, trend_axis", O.labels_sql("calendar", 1)) + " FROM f"))


@register("episode_rates", sql=_episode_rates_sql())
def q_episode_rates(spark, d):
    """Stays with any qualifying diagnosis -> council counts -> crude rate per 100,000.

    One plan from one episode scan to the published rows: an aggregate
    collapses the stays and keeps those that qualify, a join places them, one
    roll-up reaches every level, and the population join and rates follow.
    """
    from .indicator import run_indicator
    from .spec import IndicatorSpec

    ep = FX.fx_episode_wide(spark, d)
    stays = E.stay_collapse(ep, stay_year="cal_last_discharge", qualifies=E.diag_match(DIAG_COLS, "F10|K25"))
    placed = stays.join(FX.fx_postcode(spark, d).select("pc7", "ca"), "pc7", "inner")
    prepared = E.event_count(placed, ["year", "ca"])
    spec = IndicatorSpec(ind_id=99401, measure="crude", time_agg=1, yearstart=2020, yearend=2030,
                         year_type="calendar", geography="council", crude_rate=100000)
    lookup = FX.fx_area(spark, d).select("ca", "hb").distinct()
    # population for every year of the run (no pass over the events to find their years)
    years = F.sequence(F.lit(spec.yearstart), F.lit(spec.yearend))
    pop = (FX.area_counts(spark, d).select("code", "n", F.explode(years).alias("year"))
           .select("year", "code", (F.col("n") * 20.0).alias("denominator")))
    return present(run_indicator(prepared, spec, lookup, "ca", ["hb", "scotland"], population=pop))
