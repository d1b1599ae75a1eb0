"""Runs over the whole area hierarchy: zones, localities, partnerships of both kinds, councils, boards, the nation.

The other queries stop at council, board and nation; here every published
kind of code occurs, and the rules that drop some of them take effect.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from ..operators import geography as G
from ..operators import qa as Q
from ..sources import fixtures as FX
from ..sources.refdata import COUNCIL_TO_ADP, EXPECTED_AREAS, council_to_adp_table, values_sql
from . import oracle_sql as O
from .indicator import run_indicator
from .q_indicator import _indicator_select, _lev
from .registry import present, register
from .runner import Job, run_jobs
from .spec import IndicatorSpec

ALL_LEVELS = ["iz", "locality", "hscp", "adp", "ca", "hb", "scotland"]
COUNCIL_LEVELS = ["hb", "adp", "hscp", "scotland"]
KINDS = [*Q.GEO_TYPES, "S99"]

ZONES = IndicatorSpec(ind_id=99601, measure="percent", time_agg=3, yearstart=1995, yearend=2001, year_type="financial", adp=True)
WITH_ADP = IndicatorSpec(ind_id=99602, measure="crude", time_agg=1, yearstart=1995, yearend=2001, year_type="calendar",
                         geography="council", crude_rate=1000, adp=True)
WITH_HSCP = dataclasses.replace(WITH_ADP, ind_id=99603, time_agg=3, adp=False, hscp=True)


def hierarchy(spark, d):
    """datazone -> every area it lies in.  Zones lie in councils and localities in partnerships; two councils share
    one partnership (hscp), and councils without a drug partnership (adp) have none."""
    council = F.substring("ca", 4, 9).cast("int")
    partnership = F.when(council == 6, 5).otherwise(council)
    return (FX.fx_area(spark, d).join(F.broadcast(council_to_adp_table(spark)), "ca", "left")
            .select("datazone", FX.area_code("S02", council * 10 + F.col("datazone") % 7).alias("iz"),
                    FX.area_code("S99", partnership * 10 + F.col("datazone") % 3).alias("locality"),
                    FX.area_code("S37", partnership).alias("hscp"), "adp", "ca", "hb", "scotland"))


def _code(prefix: str, number: str) -> str:
    return f"'{prefix}' || lpad(CAST({number} AS VARCHAR), 6, '0')"


_COUNCIL = "CAST(substr(a.ca, 4) AS INT)"
_PARTNERSHIP = f"CASE WHEN {_COUNCIL} = 6 THEN 5 ELSE {_COUNCIL} END"
HIERARCHY = (
    ("adp", values_sql(COUNCIL_TO_ADP, ["ca", "adp"])),
    ("hy", f"SELECT a.datazone, {_code('S02', _COUNCIL + ' * 10 + a.datazone % 7')} AS iz, "
           f"{_code('S99', '(' + _PARTNERSHIP + ') * 10 + a.datazone % 3')} AS locality, {_code('S37', _PARTNERSHIP)} AS hscp, "
           "adp.adp, a.ca, a.hb, 'S00000001' AS scotland FROM fx_area a LEFT JOIN adp ON a.ca = adp.ca"))


def _zones_sql(body: str) -> str:
    s, e, n = ZONES.yearstart, ZONES.yearend, ZONES.time_agg
    return O.with_fx(
        *HIERARCHY, ("j", f"SELECT p.year, p.numerator, p.denominator, hy.* FROM fx_prepared p LEFT JOIN hy ON p.datazone = hy.datazone "
                          f"WHERE p.year >= {s}"),
        ("r", O.rollup_sql("j", ALL_LEVELS, ["year"])), ("l", _lev("r", s, e, adp=True)),
        ("m", O.rolling_sql("l", ["code"], n, shift=O.time_fix(n))), ("q", f"SELECT code, year, numerator, {O.percent_sql()} FROM m"),
        ("f", O.finalise_sql("q")), body=body)


def zones(spark, d):
    return run_indicator(FX.fx_prepared(spark, d), ZONES, hierarchy(spark, d), "datazone", ALL_LEVELS)


@register("area_levels_rate", sql=_zones_sql(f"SELECT {_indicator_select(99601, 'financial', 3)} FROM f"))
def q_area_levels_rate(spark, d):
    """A run from datazones to every kind of area at once."""
    return present(zones(spark, d))


@register("area_levels_coverage", sql=_zones_sql(
    f"SELECT year, {', '.join(KINDS)}, "
    + " AND ".join(f"({k} = 0 OR {k} = {EXPECTED_AREAS[k]})" for k in KINDS if k in EXPECTED_AREAS) + " AS matches_expected FROM (SELECT year, "
    + ", ".join(f"count(DISTINCT CASE WHEN starts_with(code, '{k}') THEN code END) AS {k}" for k in KINDS) + " FROM f GROUP BY year)"))
def q_area_levels_coverage(spark, d):
    """Areas of every kind in each period of that run."""
    return Q.qa_geo_coverage(zones(spark, d), KINDS)


def _council_sql(spec: IndicatorSpec) -> str:
    s, e = spec.yearstart, spec.yearend
    wanted = ("" if spec.adp else " AND NOT starts_with(code, 'S11')") + ("" if spec.hscp else " AND NOT starts_with(code, 'S37')")
    levels = ["ca", *COUNCIL_LEVELS]
    return O.with_fx(
        *HIERARCHY, ("pc", "SELECT p.year, a.ca, sum(p.numerator) AS numerator FROM fx_prepared p JOIN fx_area a ON p.datazone = a.datazone GROUP BY 1, 2"),
        ("lk", "SELECT DISTINCT ca, hb, adp, hscp FROM hy"),
        ("j", f"SELECT pc.*, lk.hb, lk.adp, lk.hscp, 'S00000001' AS scotland FROM pc LEFT JOIN lk ON pc.ca = lk.ca WHERE pc.year >= {s}"),
        ("r", O.rollup_sql("j", levels, ["year"], measures=("numerator",))),
        ("pp", f"SELECT CAST(y.range AS INT) AS year, code, 20.0 * n AS denominator FROM (SELECT code, count(*) AS n FROM ("
               + " UNION ALL ".join(f"SELECT {c} AS code FROM hy" for c in levels)
               + f") GROUP BY code), range({s}, {e + 1}) y WHERE code IS NOT NULL{wanted}"),
        ("fj", "SELECT coalesce(r.year, pp.year) AS year, coalesce(r.code, pp.code) AS code, coalesce(r.numerator, 0) AS numerator, "
               "pp.denominator FROM r FULL JOIN pp ON r.year = pp.year AND r.code = pp.code"),
        ("l", f"SELECT * FROM fj WHERE year BETWEEN {s} AND {e} AND code IS NOT NULL{wanted}"),
        ("m", O.rolling_sql("l", ["code"], spec.time_agg, shift=spec.time_fix)),
        ("q", f"SELECT code, year, numerator, {O.crude_sql(spec.crude_rate)} FROM m"), ("f", O.finalise_sql("q")),
        body=f"SELECT {_indicator_select(spec.ind_id, spec.year_type, spec.time_agg)} FROM f")


@register("council_levels_rate", sql=f"SELECT * FROM ({_council_sql(WITH_ADP)}) UNION ALL SELECT * FROM ({_council_sql(WITH_HSCP)})")
def q_council_levels_rate(spark, d):
    """Council runs: one with drug partnerships and without the others, one the other way round."""
    area = hierarchy(spark, d)
    prepared = (FX.fx_prepared(spark, d).join(area.select("datazone", "ca"), "datazone")
                .groupBy("year", "ca").agg(F.sum("numerator").alias("numerator")))
    lookup = G.council_lookup(area, adp="adp", hscp="hscp")
    years = F.sequence(F.lit(WITH_ADP.yearstart), F.lit(WITH_ADP.yearend))
    people = (G.geo_unpivot(area.select("ca", *COUNCIL_LEVELS), ["ca", *COUNCIL_LEVELS]).groupBy("code").agg((20.0 * F.count("*")).alias("denominator"))
              .select("code", "denominator", F.explode(years).alias("year")))
    return present(run_jobs([Job(spec, prepared, lookup, "ca", COUNCIL_LEVELS, population=people) for spec in (WITH_ADP, WITH_HSCP)]))
