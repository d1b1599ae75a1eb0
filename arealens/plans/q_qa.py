"""QA queries, version merge (C-14) and latest year (D-8).

'new' is an indicator over all orders, 'old' the same indicator from an
extract without pending orders, so the comparisons have real differences.
"""

from __future__ import annotations

from ..operators import periods as P
from ..operators import qa as Q
from ..session import materialize
from ..sources import fixtures as FX
from ..sources.refdata import EXPECTED_AREAS, values_sql
from . import oracle_sql as O
from .indicator import run_indicator
from .registry import present, register
from .q_indicator import LEVELS, PCT1

CHECK_CODES = ["S00000001", "S08000001", "S12000010"]
RECONCILE = ["S08000002", "S12000002", "S12000012"]


def _lazy(spark, d):
    """The published result, as a plan: for checks that read it once."""
    return run_indicator(FX.fx_prepared(spark, d), PCT1, FX.fx_area(spark, d), "datazone", LEVELS)


def _new(spark, d):
    """The published result written once to the shared folder: for checks that read it several times."""
    return materialize(_lazy(spark, d), "qa-new")


def _old(spark, d):
    return run_indicator(FX.fx_prepared(spark, d, exclude_status="P"), PCT1, FX.fx_area(spark, d), "datazone", LEVELS)


def _ind_ctes(name: str, where: str = "") -> list[tuple[str, str]]:
    prep = O.FX["fx_prepared"].replace("FROM orders", f"FROM orders {where}")
    return [
        (f"{name}_p", prep),
        (f"{name}_j", f"SELECT p.*, a.ca, a.hb, 'S00000001' AS scotland FROM {name}_p p "
                      "LEFT JOIN fx_area a ON p.datazone = a.datazone WHERE p.year >= 1995"),
        (f"{name}_r", O.rollup_sql(f"{name}_j", LEVELS, ["year"])),
        (f"{name}_l", f"SELECT * FROM {name}_r WHERE year BETWEEN 1995 AND 2001 AND code IS NOT NULL "
                      "AND NOT starts_with(code, 'S11') AND denominator IS NOT NULL"),
        (f"{name}_q", f"SELECT code, year, numerator, {O.percent_sql()} FROM {name}_l"),
        (f"{name}_f", O.finalise_sql(f"{name}_q")),
        (name, f"SELECT code, 99006 AS ind_id, year, numerator, rate, lowci, upci, "
               f"{O.labels_sql('financial', 1)} FROM {name}_f"),
    ]


NEW = _ind_ctes("new")
OLD = _ind_ctes("old", "WHERE o_orderstatus <> 'P'")


def _sql(body: str, *extra, old: bool = False) -> str:
    return O.with_fx(*NEW, *(OLD if old else []), *extra, body=body)


_GEO = ", ".join(f"count(DISTINCT CASE WHEN substr(code, 1, 3) = '{g}' THEN code END) AS {g}" for g in Q.GEO_TYPES)
_OK = " AND ".join(f"({g} = 0 OR {g} = {EXPECTED_AREAS[g]})" for g in Q.GEO_TYPES if g in EXPECTED_AREAS)


@register("qa_geo_coverage", sql=_sql(f"SELECT year, *, {_OK} AS matches_expected FROM "
                                      f"(SELECT year AS y, {_GEO} FROM new GROUP BY year) t, "
                                      "LATERAL (SELECT t.y AS year)".replace("SELECT year, *", "SELECT year, S00, S08, S12, S11, S37, S02")))
def q_qa_geo_coverage(spark, d):
    return Q.qa_geo_coverage(_lazy(spark, d))


@register("qa_row_delta", sql=_sql("SELECT (SELECT count(*) FROM new) AS new_rows, (SELECT count(*) FROM old) AS old_rows, "
                                   "(SELECT count(*) FROM new) - (SELECT count(*) FROM old) AS rows_added", old=True))
def q_qa_row_delta(spark, d):
    return Q.qa_row_delta(_lazy(spark, d), _old(spark, d))


_MERGE_COLS = ["numerator", "rate", "lowci", "upci"]
_MERGE_SEL = ", ".join(f"{O.r6(f'n.{c}', f'{c}_new')}, {O.r6(f'o.{c}', f'{c}_old')}" for c in _MERGE_COLS)


@register("merge_versions", sql=_sql(f"SELECT n.code, n.year, {_MERGE_SEL} FROM new n JOIN old o "
                                     "ON n.code = o.code AND n.year = o.year", old=True))
def q_merge_versions(spark, d):
    return present(Q.merge_versions(_lazy(spark, d), _old(spark, d)))


_CODES = ", ".join(f"'{c}'" for c in CHECK_CODES)
_MATCH = ", ".join(f"round_even((n.{c} - o.{c}) / nullif(n.{c}, 0), 3) AS {c}_match" for c in _MERGE_COLS)


@register("qa_compare_old", sql=_sql(f"SELECT n.code, n.year, {_MERGE_SEL}, {_MATCH} FROM new n JOIN old o "
                                     f"ON n.code = o.code AND n.year = o.year WHERE n.code IN ({_CODES})", old=True))
def q_qa_compare_old(spark, d):
    return present(Q.qa_compare_old(_lazy(spark, d), _old(spark, d), CHECK_CODES))


@register("qa_ci_contains", sql=_sql("SELECT count(*) FILTER (WHERE rate < lowci OR rate > upci) AS ci_error_total FROM new"))
def q_qa_ci_contains(spark, d):
    return Q.qa_ci_contains(_lazy(spark, d))


@register("qa_scot_vs_boards", sql=_sql(
    "SELECT code, year, " + ", ".join(O.r6(c, c) for c in ("rate", "lowci", "upci"))
    + ", " + O.r6("(SELECT max(rate) FROM new WHERE code = 'S00000001' AND year = (SELECT max(year) FROM new))", "scot_rate")
    + " FROM new WHERE year = (SELECT max(year) FROM new) AND (code = 'S00000001' OR starts_with(code, 'S08'))"))
def q_qa_scot_vs_boards(spark, d):
    return present(Q.qa_scot_vs_boards(_new(spark, d)))


_REC = ", ".join(f"{O.r6(f'sum(CASE WHEN code = {chr(39)}{c}{chr(39)} THEN numerator END)', c)}" for c in RECONCILE)


def _rec_sql():
    a = RECONCILE[0]
    diffs = ", ".join(O.r6(f"{a} - {c}", f"diff_{c}") for c in RECONCILE[1:])
    inner = "SELECT year, " + ", ".join(
        f"sum(CASE WHEN code = '{c}' THEN numerator END) AS {c}" for c in RECONCILE) + " FROM new GROUP BY year"
    return _sql(f"SELECT year, {', '.join(O.r6(c, c) for c in RECONCILE)}, {diffs} FROM ({inner})")


@register("qa_area_reconcile", sql=_rec_sql())
def q_qa_area_reconcile(spark, d):
    return present(Q.qa_area_reconcile(_lazy(spark, d), RECONCILE))


@register("qa_small_numbers", sql=_sql(
    "SELECT * FROM (SELECT substr(code, 1, 3) AS geo_type, year, count(*) AS rows, "
    "count(*) FILTER (WHERE numerator < 20) AS small, "
    "round(CAST(count(*) FILTER (WHERE numerator < 20) AS DOUBLE) / count(*), 6) AS small_share "
    "FROM new GROUP BY 1, 2) WHERE small_share > 0.2"))
def q_qa_small_numbers(spark, d):
    return present(Q.qa_small_numbers(_lazy(spark, d), below=20, share=0.2))


_NULLS = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in Q.CONTRACT)


@register("qa_missing", sql=_sql(f"SELECT {_NULLS}, true AS columns_ok FROM new"))
def q_qa_missing(spark, d):
    return Q.qa_missing(_lazy(spark, d))


@register("qa_level_totals", sql=_sql(
    "SELECT year, " + O.r6("sum(CASE WHEN code = 'S00000001' THEN numerator END)", "scotland") + ", "
    + O.r6("sum(CASE WHEN starts_with(code, 'S08') THEN numerator END)", "boards") + ", "
    + O.r6("sum(CASE WHEN starts_with(code, 'S12') THEN numerator END)", "councils") + " FROM new GROUP BY year"))
def q_qa_level_totals(spark, d):
    return present(Q.qa_level_totals(_lazy(spark, d)))


@register("qa_child_parent", sql=_sql(
    "SELECT n.code, n.year, " + O.r6("n.numerator", "numerator") + ", " + O.r6("k.children", "children") + ", "
    + O.r6("n.numerator - k.children", "difference") + " FROM new n JOIN (SELECT m.hb AS code, new.year, "
    "sum(new.numerator) AS children FROM new JOIN (SELECT DISTINCT ca, hb FROM fx_area) m ON new.code = m.ca "
    "GROUP BY m.hb, new.year) k ON n.code = k.code AND n.year = k.year"))
def q_qa_child_parent(spark, d):
    return present(Q.qa_child_parent(_new(spark, d), FX.fx_area(spark, d)))


_CAT = [(99006, "financial", 1995, 2001), (99001, "calendar", 1995, 2001)]


@register("qa_metadata", sql=_sql(
    "SELECT s.ind_id, s.first_year, s.last_year, " + O.r6("s.min_ci_width", "min_ci_width") + ", "
    + O.r6("s.max_ci_width", "max_ci_width") + ", s.rows, c.year_type, c.yearstart, c.yearend, "
    "(s.first_year >= c.yearstart AND s.last_year <= c.yearend) AS years_ok FROM "
    "(SELECT ind_id, min(year) AS first_year, max(year) AS last_year, min(upci - lowci) AS min_ci_width, "
    "max(upci - lowci) AS max_ci_width, count(*) AS rows FROM new GROUP BY ind_id) s LEFT JOIN cat c "
    "ON s.ind_id = c.ind_id", ("cat", values_sql(_CAT, ["ind_id", "year_type", "yearstart", "yearend"]))))
def q_qa_metadata(spark, d):
    cat = spark.createDataFrame(_CAT, "ind_id int, year_type string, yearstart int, yearend int")
    return present(Q.qa_metadata(_lazy(spark, d), cat))


def _flag_sql() -> str:
    from .q_indicator import percent_indicator_sql
    return (f"SELECT code, count(DISTINCT year) AS n_years FROM ({percent_indicator_sql(99001, 3, 'calendar')}) "
            "GROUP BY code HAVING count(DISTINCT year) <> 7")


@register("qa_area_completeness", sql=_flag_sql())
def q_qa_area_completeness(spark, d):
    from .q_indicator import flagship
    return Q.qa_area_completeness(flagship(spark, d), 7)


@register("qa_trend_slice", sql=_sql("SELECT code, year, " + ", ".join(O.r6(c, c) for c in ("rate", "lowci", "upci"))
                                     + f" FROM new WHERE code IN ({_CODES})"))
def q_qa_trend_slice(spark, d):
    return present(Q.qa_trend_slice(_lazy(spark, d), CHECK_CODES))


@register("latest_year", sql=_sql("SELECT code, ind_id, year, " + ", ".join(O.r6(c, c) for c in ("numerator", "rate", "lowci", "upci"))
                                  + ", def_period, trend_axis FROM new WHERE year = (SELECT max(year) FROM new)"))
def q_latest_year(spark, d):
    return present(P.latest_year(_new(spark, d)))
