"""Indicator-run queries.

Every query reads the base tables through the fixture bindings; its oracle is
written independently in DuckDB SQL.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from ..operators import geography as G
from ..operators import periods as P
from ..operators import population as POP
from ..operators import rates as R
from ..session import scratch_path
from ..sources import fixtures as FX
from ..sources.refdata import EPOP_WEIGHTS, COUNCIL_TO_ADP, council_to_adp_table, values_sql
from ..sources.tables import read_table
from . import oracle_sql as O
from .indicator import INDICATOR_COLUMNS, finalised, formatted, run_indicator
from .runner import run_keyed
from .registry import present, register
from .spec import IndicatorSpec

LEVELS = ["ca", "hb", "scotland"]

# The flagship: % urgent orders, 3-year rolling, every area level.
FLAGSHIP = IndicatorSpec(ind_id=99001, measure="percent", time_agg=3, yearstart=1995,
                         yearend=2001, year_type="calendar", geography="datazone11")
CRUDE = IndicatorSpec(ind_id=99002, measure="crude", time_agg=1, yearstart=1995, yearend=2001,
                      year_type="calendar", geography="datazone11", crude_rate=1000)
EASR = IndicatorSpec(ind_id=99003, measure="stdrate", time_agg=3, yearstart=1995, yearend=2001,
                     year_type="financial", geography="datazone11", epop_age="normal",
                     epop_total=200000)
PCF = IndicatorSpec(ind_id=99004, measure="perc_pcf", time_agg=1, yearstart=1995, yearend=2001,
                    year_type="school", geography="datazone11")
SCALED = IndicatorSpec(ind_id=99005, measure="crude", time_agg=1, yearstart=1995, yearend=2001,
                       year_type="calendar", geography="datazone11", crude_rate=1000)
PCT1 = IndicatorSpec(ind_id=99006, measure="percent", time_agg=1, yearstart=1995, yearend=2001,
                     year_type="financial", geography="datazone11")
EPOP16 = IndicatorSpec(ind_id=99007, measure="stdrate", time_agg=1, yearstart=1996, yearend=2001,
                       year_type="calendar", geography="datazone11", epop_age="16+",
                       epop_total=165800)


def flagship(spark, d):
    return run_indicator(FX.fx_prepared(spark, d), FLAGSHIP, FX.fx_area(spark, d), "datazone", LEVELS)


# ---- SQL pieces shared by the indicator oracles ------------------------------
def _joined(start: int = 0) -> str:
    return ("SELECT p.*, a.ca, a.hb, 'S00000001' AS scotland FROM fx_prepared p "
            f"LEFT JOIN fx_area a ON p.datazone = a.datazone WHERE p.year >= {start}")


def _lev(src: str, start: int, end: int, adp: bool = False) -> str:
    s11 = "" if adp else " AND NOT starts_with(code, 'S11')"
    return f"SELECT * FROM {src} WHERE year BETWEEN {start} AND {end} AND code IS NOT NULL{s11}"


def _indicator_select(ind: int, year_type: str, n: int) -> str:
    return O.INDICATOR_SELECT.format(ind=ind).replace("def_period, trend_axis",
                                                      O.labels_sql(year_type, n))


def percent_indicator_sql(ind: int, n: int, year_type: str, start=1995, end=2001) -> str:
    return O.with_fx(
        ("j", _joined(start)),
        ("r", O.rollup_sql("j", LEVELS, ["year"])),
        ("l", _lev("r", start, end)),
        ("m", O.rolling_sql("l", ["code"], n, shift=O.time_fix(n))),
        ("q", f"SELECT code, year, numerator, {O.percent_sql()} FROM m"),
        ("f", O.finalise_sql("q")),
        body=f"SELECT {_indicator_select(ind, year_type, n)} FROM f")


def _epop_values(cut: str) -> str:
    return values_sql([(b, float(w)) for b, w in EPOP_WEIGHTS[cut].items()], ["age_grp", "epop"])


def _std_formatted_ctes(spec: IndicatorSpec):
    s, e = spec.yearstart, spec.yearend
    return [
        ("j", _joined(s)),
        ("r", O.rollup_sql("j", LEVELS, ["year", "sex_grp", "age_grp"], measures=("numerator",))),
        ("pp", f"SELECT * FROM fx_population WHERE year >= {s} AND NOT starts_with(code, 'S11')"),
        ("fj", "SELECT coalesce(r.year, pp.year) AS year, coalesce(r.code, pp.code) AS code, "
               "coalesce(r.sex_grp, pp.sex_grp) AS sex_grp, coalesce(r.age_grp, pp.age_grp) AS age_grp, "
               "coalesce(r.numerator, 0) AS numerator, pp.denominator FROM r FULL JOIN pp "
               "ON r.year = pp.year AND r.code = pp.code AND r.sex_grp = pp.sex_grp AND r.age_grp = pp.age_grp"),
        ("l", _lev("fj", s, e)),
        ("m", O.rolling_sql("l", ["code", "sex_grp", "age_grp"], spec.time_agg, shift=spec.time_fix)),
        ("ep", _epop_values(spec.epop_age)),
        ("e", "SELECT m.*, ep.epop FROM m LEFT JOIN ep ON m.age_grp = ep.age_grp"),
    ]


def easr_indicator_sql(spec: IndicatorSpec) -> str:
    T = float(spec.standard_total)
    lo, up = O.byar_lower("numerator"), O.byar_upper("numerator")
    spread = f"sqrt(var_dsr / {T * T} / nullif(numerator, 0))"
    return O.with_fx(
        *_std_formatted_ctes(spec),
        ("s", "SELECT year, code, coalesce(sum(numerator), 0) AS numerator, "
              "coalesce(sum(denominator), 0) AS denominator, "
              f"sum({O.nz('numerator * epop / nullif(denominator, 0)')}) AS easr_first, "
              f"sum({O.nz('numerator * epop * epop / nullif(denominator * denominator, 0)')}) AS var_dsr "
              "FROM e GROUP BY year, code"),
        ("q", f"SELECT code, year, numerator, easr_first / {T} * 100000 AS rate, "
              f"(easr_first / {T} + {spread} * ({lo} - numerator)) * 100000 AS lowci, "
              f"(easr_first / {T} + {spread} * ({up} - numerator)) * 100000 AS upci FROM s"),
        ("f", O.finalise_sql("q")),
        body=f"SELECT {_indicator_select(spec.ind_id, spec.year_type, spec.time_agg)} FROM f")


# ---- A: sources / sinks built on the indicator --------------------------------

@register("sink_indicator", sql=percent_indicator_sql(99001, 3, "calendar"))
def q_sink_indicator(spark, d):
    """Write the indicator partitioned by ind_id to the shared folder and read it back."""
    from ..sources.sinks import write_indicator

    path = scratch_path(spark, "indicator")
    write_indicator(flagship(spark, d), path, csv_path=path + "-csv")
    back = spark.read.parquet(path).select(*INDICATOR_COLUMNS)
    text = spark.read.schema(back.schema).option("header", True).csv(path + "-csv").select(*INDICATOR_COLUMNS)
    # every row has its twin in the CSV half, or the query fails: doubles are written with all their digits
    odd = back.withColumn("_n", F.lit(1)).unionByName(text.withColumn("_n", F.lit(-1))).groupBy(*INDICATOR_COLUMNS).agg(
        F.sum("_n").alias("_n")).where("_n != 0")
    if not odd.isEmpty():
        raise ValueError("the parquet and CSV halves of the sink differ")
    return present(back)


@register("sink_checkpoint", sql=percent_indicator_sql(99001, 3, "calendar"))
def q_sink_checkpoint(spark, d):
    """Stage one is checkpointed (reliable, shared folder) and stage two reads it."""
    f = formatted(FX.fx_prepared(spark, d), FLAGSHIP, FX.fx_area(spark, d), "datazone", LEVELS)
    f = f.checkpoint(eager=True)
    return present(finalised(f, FLAGSHIP))


# ---- F: roll-up, periods, rates ---------------------------------------------------

@register("geo_unpivot", sql=O.with_fx(
    ("j", _joined()),
    body="\nUNION ALL\n".join(
        f"SELECT year, datazone, sex_grp, age_grp, numerator, denominator, {lvl} AS code FROM j"
        for lvl in LEVELS)))
def q_geo_unpivot(spark, d):
    j = G.join_geography(FX.fx_prepared(spark, d), FX.fx_area(spark, d), "datazone")
    return present(G.geo_unpivot(j, LEVELS))


@register("geo_rollup", sql=O.with_fx(("j", _joined()), body=O.rollup_sql("j", LEVELS, ["year"])))
def q_geo_rollup(spark, d):
    return present(G.geo_rollup(FX.fx_prepared(spark, d), FX.fx_area(spark, d), "datazone",
                                LEVELS, keys=["year"]))


def _area_with_adp(spark, d):
    a = FX.fx_area(spark, d)
    return a.join(F.broadcast(council_to_adp_table(spark)), "ca", "left")


@register("level_filter", sql=O.with_fx(
    ("adp", values_sql(COUNCIL_TO_ADP, ["ca", "adp"])),
    ("j", "SELECT p.*, a.ca, a.hb, adp.adp, 'S00000001' AS scotland FROM fx_prepared p "
          "LEFT JOIN fx_area a ON p.datazone = a.datazone LEFT JOIN adp ON a.ca = adp.ca"),
    ("r", O.rollup_sql("j", ["ca", "hb", "adp", "scotland"], ["year"])),
    body="SELECT * FROM r WHERE code IS NOT NULL AND NOT starts_with(code, 'S11') "
         "AND NOT starts_with(code, 'S37')"))
def q_level_filter(spark, d):
    r = G.geo_rollup(FX.fx_prepared(spark, d), _area_with_adp(spark, d), "datazone",
                     ["ca", "hb", "adp", "scotland"], keys=["year"])
    return present(G.level_filter(r, adp=False, hscp=False))


@register("adp_rollup", sql=O.with_fx(
    ("adp", values_sql(COUNCIL_TO_ADP, ["ca", "adp"])),
    ("j", "SELECT p.*, a.ca FROM fx_prepared p JOIN fx_area a ON p.datazone = a.datazone"),
    ("c", O.rollup_sql("j", ["ca"], ["year"])),
    body="SELECT code, year, numerator, denominator FROM c UNION ALL "
         "SELECT adp.adp AS code, year, coalesce(sum(numerator), 0), coalesce(sum(denominator), 0) "
         "FROM c JOIN adp ON c.code = adp.ca GROUP BY adp.adp, year"))
def q_adp_rollup(spark, d):
    councils = G.geo_rollup(FX.fx_prepared(spark, d), FX.fx_area(spark, d).select("datazone", "ca"),
                            "datazone", ["ca"], keys=["year"])
    return present(G.adp_rollup(councils, council_to_adp_table(spark)))


@register("rolling_mean", sql=O.with_fx(
    ("j", _joined()), ("r", O.rollup_sql("j", LEVELS, ["year"])), ("l", _lev("r", 1995, 2001)),
    body=O.rolling_sql("l", ["code"], 3, shift=1)))
def q_rolling_mean(spark, d):
    r = G.geo_rollup(FX.fx_prepared(spark, d), FX.fx_area(spark, d), "datazone", LEVELS, keys=["year"])
    r = G.level_filter(r.where(F.col("year").between(1995, 2001)))
    return present(P.rolling_mean(r, ["code"], 3))


@register("rate_percent", sql=O.with_fx(
    ("j", _joined()), ("r", O.rollup_sql("j", LEVELS, ["year"])),
    body=f"SELECT code, year, numerator, denominator, {O.percent_sql()} FROM r"))
def q_rate_percent(spark, d):
    r = G.geo_rollup(FX.fx_prepared(spark, d), FX.fx_area(spark, d), "datazone", LEVELS, keys=["year"])
    return present(R.rate_percent(r))


def _odd_years_empty(df):
    """Denominator zeroed in odd years: exercises the zero-denominator path."""
    return df.withColumn("denominator", F.when(F.col("year") % 2 == 0, F.col("denominator"))
                         .otherwise(F.lit(0.0)))


@register("finalise_nulls", sql=O.with_fx(
    ("p0", "SELECT * REPLACE (CASE WHEN year % 2 = 0 THEN denominator ELSE 0 END AS denominator) "
           "FROM fx_prepared"),
    ("j", "SELECT p.*, a.ca, a.hb, 'S00000001' AS scotland FROM p0 p LEFT JOIN fx_area a "
          "ON p.datazone = a.datazone"),
    ("r", O.rollup_sql("j", LEVELS, ["year"])),
    ("q", f"SELECT code, year, numerator, {O.percent_sql()} FROM r"),
    body=O.finalise_sql("q")))
def q_finalise_nulls(spark, d):
    r = G.geo_rollup(_odd_years_empty(FX.fx_prepared(spark, d)), FX.fx_area(spark, d), "datazone",
                     LEVELS, keys=["year"])
    out = R.finalise_nulls(R.rate_percent(r)).drop("denominator")
    return present(out)


LABEL_CASES = [("financial", 5), ("financial", 3), ("school", 2), ("financial", 1), ("survey", 1),
               ("July snapshot", 1), ("calendar", 1), ("calendar", 2), ("calendar", 5)]


def _label_name(kind: str, yt: str, n: int) -> str:
    return f"{kind}_{yt.split()[-1]}_{n}"


@register("period_labels", sql=O.with_fx(
    ("j", _joined()), ("r", O.rollup_sql("j", LEVELS, ["year"])),
    body="SELECT code, year, " + ", ".join(
        O.labels_sql(yt, n).replace("AS trend_axis", f"AS {_label_name('axis', yt, n)}")
        .replace("AS def_period", f"AS {_label_name('period', yt, n)}") for yt, n in LABEL_CASES)
    + " FROM r"))
def q_period_labels(spark, d):
    r = G.geo_rollup(FX.fx_prepared(spark, d), FX.fx_area(spark, d), "datazone", LEVELS, keys=["year"])
    out = r.select("code", "year")
    for yt, n in LABEL_CASES:
        out = (P.add_period_labels(out, yt, n)
               .withColumnRenamed("trend_axis", _label_name("axis", yt, n))
               .withColumnRenamed("def_period", _label_name("period", yt, n)))
    return out


@register("join_population_full", sql=O.with_fx(
    *_std_formatted_ctes(EASR)[:5],
    body="SELECT code, year, sex_grp, age_grp, numerator, denominator FROM l"))
def q_join_population_full(spark, d):
    std = G.geo_rollup(FX.fx_prepared(spark, d).where(F.col("year") >= 1995), FX.fx_area(spark, d),
                       "datazone", LEVELS, keys=["year", "sex_grp", "age_grp"], measures=["numerator"])
    out = POP.join_population_full(std, FX.fx_population(spark, d), ["year", "code", "sex_grp", "age_grp"],
                                   1995, 2001, adp=False, hscp=True)
    return present(out.select("code", "year", "sex_grp", "age_grp", "numerator", "denominator"))


@register("european_pop", sql=O.with_fx(
    *_std_formatted_ctes(EPOP16),
    body="SELECT code, year, sex_grp, age_grp, numerator, denominator, epop FROM e"))
def q_european_pop(spark, d):
    f = formatted(FX.fx_prepared(spark, d), EPOP16, FX.fx_area(spark, d), "datazone", LEVELS,
                  population=FX.fx_population(spark, d))
    return present(f.select("code", "year", "sex_grp", "age_grp", "numerator", "denominator", "epop"))


@register("rate_easr", sql=easr_indicator_sql(EASR))
def q_rate_easr(spark, d):
    return present(run_indicator(FX.fx_prepared(spark, d), EASR, FX.fx_area(spark, d), "datazone",
                                 LEVELS, population=FX.fx_population(spark, d)))


def crude_indicator_sql(spec: IndicatorSpec, prepared_cte: str | None = None) -> str:
    s, e = spec.yearstart, spec.yearend
    joined = _joined(s) if prepared_cte is None else (
        "SELECT p.*, a.ca, a.hb, 'S00000001' AS scotland FROM pr p "
        f"LEFT JOIN fx_area a ON p.datazone = a.datazone WHERE p.year >= {s}")
    ctes = [("pr", prepared_cte)] if prepared_cte else []
    return O.with_fx(
        *ctes,
        ("j", joined),
        ("r", O.rollup_sql("j", LEVELS, ["year"], measures=("numerator",))),
        ("pp", f"SELECT * FROM fx_population_total WHERE year >= {s} AND NOT starts_with(code, 'S11')"),
        ("fj", "SELECT coalesce(r.year, pp.year) AS year, coalesce(r.code, pp.code) AS code, "
               "coalesce(r.numerator, 0) AS numerator, pp.denominator FROM r FULL JOIN pp "
               "ON r.year = pp.year AND r.code = pp.code"),
        ("l", _lev("fj", s, e)),
        ("m", O.rolling_sql("l", ["code"], spec.time_agg, shift=spec.time_fix)),
        ("q", f"SELECT code, year, numerator, {O.crude_sql(spec.crude_rate)} FROM m"),
        ("f", O.finalise_sql("q")),
        body=f"SELECT {_indicator_select(spec.ind_id, spec.year_type, spec.time_agg)} FROM f")


@register("rate_crude", sql=crude_indicator_sql(CRUDE))
def q_rate_crude(spark, d):
    prep = FX.fx_prepared(spark, d).drop("denominator")
    return present(run_indicator(prep, CRUDE, FX.fx_area(spark, d), "datazone", LEVELS,
                                 population=FX.fx_population_total(spark, d)))


_SCALED_PREP = ("SELECT CAST(year(l_shipdate) AS INT) AS year, o_custkey AS datazone, "
                "sum(l_quantity) / 365.0 AS numerator FROM lineitem JOIN orders "
                "ON l_orderkey = o_orderkey GROUP BY 1, 2")


@register("scaled_numerator", sql=crude_indicator_sql(SCALED, _SCALED_PREP))
def q_scaled_numerator(spark, d):
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_quantity", "l_shipdate"])
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    prep = (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy(F.year("l_shipdate").cast("int").alias("year"), F.col("o_custkey").alias("datazone"))
            .agg((F.sum("l_quantity") / 365.0).alias("numerator")))
    return present(run_indicator(prep, SCALED, FX.fx_area(spark, d), "datazone", LEVELS,
                                 population=FX.fx_population_total(spark, d)))


def _pcf_sql() -> str:
    spec = PCF
    return O.with_fx(
        ("j", _joined(spec.yearstart)),
        ("r", O.rollup_sql("j", LEVELS, ["year"])),
        ("l", _lev("r", spec.yearstart, spec.yearend)),
        ("m", O.rolling_sql("l", ["code"], 1)),
        ("est", "SELECT code, year, denominator AS est_pop FROM fx_population_total"),
        ("x", "SELECT m.*, coalesce(est.est_pop, 0) AS P FROM m LEFT JOIN est "
              "ON m.year = est.year AND m.code = est.code"),
        ("y", "SELECT *, numerator / nullif(denominator, 0) * 100 AS rate, "
              "CASE WHEN P > 0 THEN sqrt((P - denominator) / nullif(P - 1, 0)) WHEN P = 0 THEN 1 END AS pcf "
              "FROM x"),
        ("z", "SELECT *, CASE WHEN P < denominator THEN 0 WHEN P >= denominator THEN "
              "1.96 * sqrt(rate * (100 - rate) / nullif(denominator, 0) * pcf) END AS ci FROM y"),
        ("q", f"SELECT code, year, numerator, rate, "
              f"CASE WHEN {O.nonan('rate - ci')} < 0 THEN 0 ELSE {O.nonan('rate - ci')} END AS lowci, "
              f"CASE WHEN {O.nonan('rate + ci')} > 100 THEN 100 ELSE {O.nonan('rate + ci')} END AS upci "
              "FROM z"),
        ("f", O.finalise_sql("q")),
        body=f"SELECT {_indicator_select(spec.ind_id, spec.year_type, spec.time_agg)} FROM f")


@register("rate_perc_pcf", sql=_pcf_sql())
def q_rate_perc_pcf(spark, d):
    return present(run_indicator(FX.fx_prepared(spark, d), PCF, FX.fx_area(spark, d), "datazone",
                                 LEVELS, ref_pop=FX.fx_population_total(spark, d)))


SLICES = {"under16": (1, 3), "16plus": (4, 19), "65plus": (14, 19), "11to25": (3, 5)}


@register("share_of_population", sql=O.with_fx(
    ("w", "SELECT year, code, sum(denominator) AS d, " + ", ".join(
        f"sum(CASE WHEN age_grp BETWEEN {lo} AND {hi} THEN denominator ELSE 0 END) AS s_{n}"
        for n, (lo, hi) in SLICES.items()) + " FROM fx_population GROUP BY year, code"),
    body="\nUNION ALL\n".join(
        f"SELECT year, code, '{n}' AS slice, {O.r6(f's_{n}', 'numerator')}, {O.r6('d', 'denominator')} FROM w"
        for n in SLICES)))
def q_share_of_population(spark, d):
    out = POP.share_of_population(FX.fx_population(spark, d), SLICES, age_col="age_grp")
    return present(out)


@register("count_only_indicator", sql=O.with_fx(
    ("j", _joined()), ("r", O.rollup_sql("j", LEVELS, ["year"], measures=("numerator",))),
    body="SELECT code, CAST(99008 AS INT) AS ind_id, year, " + O.r6("numerator", "numerator")
    + ", CAST(NULL AS DOUBLE) AS rate, CAST(NULL AS DOUBLE) AS lowci, CAST(NULL AS DOUBLE) AS upci, "
    + O.labels_sql("financial", 1) + " FROM r WHERE code IS NOT NULL"))
def q_count_only(spark, d):
    r = G.geo_rollup(FX.fx_prepared(spark, d), FX.fx_area(spark, d), "datazone", LEVELS,
                     keys=["year"], measures=["numerator"])
    out = R.count_only(G.level_filter(r)).withColumn("ind_id", F.lit(99008))
    out = P.add_period_labels(out, "financial", 1)
    return present(out.select(*INDICATOR_COLUMNS))


# ---- a keyed batch with a population: every indicator is zero-filled on its own ------------------
KEYED = {99401: "1-URGENT", 99402: "5-LOW", 99403: "2-HIGH", 99404: "3-MEDIUM", 99405: "4-NOT SPECIFIED"}


def _keyed_sql() -> str:
    one = [crude_indicator_sql(dataclasses.replace(CRUDE, ind_id=k), (
        "SELECT CAST(year(o_orderdate) AS INT) AS year, o_custkey AS datazone, CAST(count(*) AS DOUBLE) AS numerator "
        f"FROM orders WHERE o_orderpriority = '{v}' GROUP BY 1, 2")) for k, v in KEYED.items()]
    return " UNION ALL ".join(f"SELECT * FROM ({x})" for x in one)


@register("keyed_batch_rates", sql=_keyed_sql())
def q_keyed_batch_rates(spark, d):
    ids = F.create_map(*[x for k, v in KEYED.items() for x in (F.lit(v), F.lit(k))])
    o = read_table(spark, d, "orders", ["o_orderdate", "o_custkey", "o_orderpriority"])
    prep = (o.withColumn("ind_id", F.try_element_at(ids, F.col("o_orderpriority"))).where(F.col("ind_id").isNotNull())
            .groupBy(F.year("o_orderdate").cast("int").alias("year"), F.col("o_custkey").alias("datazone"), "ind_id")
            .agg(F.count(F.lit(1)).cast("double").alias("numerator")))
    return present(run_keyed(prep, CRUDE, FX.fx_area(spark, d), "datazone", LEVELS,
                             population=FX.fx_population_total(spark, d), ind_ids=list(KEYED)))


@register("split_by_category", sql=O.with_fx(
    ("pc", "SELECT CAST(year(o_orderdate) AS INT) AS year, o_custkey AS datazone, "
           "o_orderpriority AS category, "
           "CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) AS numerator, "
           "CAST(count(*) AS DOUBLE) AS denominator FROM orders GROUP BY 1, 2, 3"),
    ("j", "SELECT p.*, a.ca, a.hb, 'S00000001' AS scotland FROM pc p LEFT JOIN fx_area a "
          "ON p.datazone = a.datazone"),
    ("r", O.rollup_sql("j", LEVELS, ["year", "category"])),
    ("l", _lev("r", 1995, 2001)),
    ("q", f"SELECT code, category, year, numerator, {O.percent_sql()} FROM l"),
    ("f", O.finalise_sql("q")),
    body="SELECT category, " + _indicator_select(99006, "financial", 1) + " FROM f"))
def q_split_by_category(spark, d):
    o = read_table(spark, d, "orders", ["o_orderdate", "o_custkey", "o_orderpriority", "o_orderstatus"])
    prep = (o.groupBy(F.year("o_orderdate").cast("int").alias("year"), F.col("o_custkey").alias("datazone"),
                      F.col("o_orderpriority").alias("category"))
            .agg(F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).cast("double").alias("numerator"),
                 F.count(F.lit(1)).cast("double").alias("denominator")))
    out = run_indicator(prep, PCT1, FX.fx_area(spark, d), "datazone", LEVELS, extra_keys=["category"])
    return present(out)


def _stack_sql():
    old = percent_indicator_sql(99006, 1, "financial", 1995, 1997)
    new = percent_indicator_sql(99006, 1, "financial", 1998, 2001)
    return f"SELECT * FROM ({old}) UNION ALL SELECT * FROM ({new})"


@register("stack_history", sql=_stack_sql())
def q_stack_history(spark, d):
    import dataclasses

    prep, area = FX.fx_prepared(spark, d), FX.fx_area(spark, d)
    old = run_indicator(prep, dataclasses.replace(PCT1, yearend=1997), area, "datazone", LEVELS)
    new = run_indicator(prep, dataclasses.replace(PCT1, yearstart=1998), area, "datazone", LEVELS)
    return present(old.unionByName(new, allowMissingColumns=True))


@register("rate_percent_indicator", sql=percent_indicator_sql(99001, 3, "calendar"))
def q_flagship(spark, d):
    return present(flagship(spark, d))
