"""Deprivation quintile roll-ups and inequality measures (SII, RII, PAR, ranges).

The per-area regression of the reference becomes closed-form weighted least
squares: every (code, year, quint_type) group has at most five quintile rows,
so the group windows here are bounded by construction, whatever the data
size.  All five quintile schemes and the 'Total' rows come out of one
grouping-sets aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats as S
from ..sources.refdata import SCOTLAND

# The (area column, quintile column) schemes of the inequality run.
QUINTILE_SCHEMES = [("scotland", "sc_quin"), ("hb", "sc_quin"), ("hb", "hb_quin"),
                    ("ca", "sc_quin"), ("ca", "ca_quin")]
GROUP = ["code", "year", "quint_type"]


def quintile_unpivot(df: DataFrame, schemes=QUINTILE_SCHEMES) -> DataFrame:
    """One row per (scheme) with ``code``, ``quintile`` (text) and ``quint_type``."""
    if "scotland" not in df.columns:
        df = df.withColumn("scotland", F.lit(SCOTLAND))
    arr = F.array(*[F.struct(F.col(a).alias("code"), F.col(q).cast("string").alias("quintile"),
                             F.lit(q).alias("quint_type")) for a, q in schemes])
    used = {a for a, _ in schemes} | {q for _, q in schemes}
    rest = [c for c in df.columns if c not in used]
    return df.select(*rest, F.explode(arr).alias("_q")).select(*rest, "_q.code", "_q.quintile", "_q.quint_type")


def quintile_rollup(df: DataFrame, keys=("year",), measures=("numerator", "denominator"),
                    totals: bool = True, schemes=QUINTILE_SCHEMES) -> DataFrame:
    """Sum measures by (code, quintile, quint_type, keys), plus 'Total' rows.

    Totals include rows whose quintile is unknown; rows with no code or no
    quintile are dropped only after the totals are formed.
    """
    measures = [m for m in measures if m in df.columns]
    long = quintile_unpivot(df.select(*keys, *measures, *{c for s in schemes for c in s if c != "scotland"}),
                            schemes)
    base = ["code", "quint_type", *keys]
    aggs = [F.coalesce(F.sum(m), F.lit(0.0)).cast("double").alias(m) for m in measures]
    if totals:
        out = (long.groupingSets([[*base, "quintile"], base], *base, "quintile")
               .agg(*aggs, F.grouping("quintile").alias("_g")))
        out = out.withColumn("quintile", F.when(F.col("_g") == 1, F.lit("Total"))
                             .otherwise(F.col("quintile"))).drop("_g")
    else:
        out = long.groupBy(*base, "quintile").agg(*aggs)
    return out.where(F.col("code").isNotNull() & F.col("quintile").isNotNull())


def with_inequality_measures(rt: DataFrame, group=GROUP) -> DataFrame:
    """Attach SII / RII / PAR / ranges of its group to every row (quintiles and 'Total').

    ``rt``: rows (group..., quintile, rate, denominator).  Everything is a
    window over the group - at most six rows - so the input is read once,
    shuffled once, and no aggregate is joined back.
    """
    group = list(group)
    q = F.col("quintile")
    detail = q != "Total"
    wg = Window.partitionBy(*group)
    wo = wg.orderBy(q.try_cast("int")).rowsBetween(Window.unboundedPreceding, 0)
    valid = F.col("rate").isNotNull() & detail
    pw = F.when(valid, F.col("_p"))
    out = rt.withColumn("_d", F.when(detail, F.col("denominator")))
    out = out.withColumns({
        "_p": S.div(F.col("_d"), F.sum("_d").over(wg)),
        "_cnt": F.count(F.when(detail, 1)).over(wg),
        "_overall": F.max(F.when(~detail, F.col("rate"))).over(wg),
        "_least": F.max(F.when(q == "5", F.col("rate"))).over(wg),
        "_most": F.max(F.when(q == "1", F.col("rate"))).over(wg)})
    out = out.withColumns({"_x": F.sum("_p").over(wo) - F.col("_p") / 2, "_sw": F.sum(pw).over(wg)})
    out = out.withColumns({"_xbar": S.div(F.sum(pw * F.col("_x")).over(wg), F.col("_sw")),
                           "_ybar": S.div(F.sum(pw * F.col("rate")).over(wg), F.col("_sw"))})
    dx, dy = F.col("_x") - F.col("_xbar"), F.col("rate") - F.col("_ybar")
    out = out.withColumns({"_sxx": F.sum(pw * dx * dx).over(wg), "_sxy": F.sum(pw * dx * dy).over(wg),
                           "_m": F.count(F.when(valid, 1)).over(wg)})
    out = out.withColumn("_b", S.div(F.col("_sxy"), F.col("_sxx")))
    resid = dy - F.col("_b") * dx
    par_rr = F.when(detail, (S.div(F.col("rate"), F.col("_least")) - 1) * F.col("_p"))
    out = out.withColumns({"_rss": F.sum(pw * resid * resid).over(wg), "_par_sum": F.sum(par_rr).over(wg),
                           "_par_n": F.count(par_rr).over(wg)})
    tcol = F.element_at(F.create_map(*[x for k, v in S.T975.items() for x in (F.lit(k), F.lit(v))]),
                        (F.col("_m") - 2).cast("int"))
    se = F.sqrt(S.div(S.div(F.col("_rss"), F.col("_m") - 2), F.col("_sxx")))
    has_sii = (F.col("_cnt") == 5) & (F.col("_m") >= 2) & (F.col("_sxx") > 0)
    has_ci = has_sii & (F.col("_m") >= 3)
    sii = {"sii": F.when(has_sii, -F.col("_b")),
           "lowci_sii": F.when(has_ci, -(F.col("_b") + tcol * se)),
           "upci_sii": F.when(has_ci, -(F.col("_b") - tcol * se))}
    cols = dict(sii)
    for name, e in sii.items():
        rii = S.div(e, F.col("_overall"))
        cols[name.replace("sii", "rii")] = rii
        cols[name.replace("sii", "rii_int")] = rii * 0.5 * 100
    par_ok = (F.col("_cnt") == 5) & (F.col("_par_n") == F.col("_cnt"))
    cols["par"] = F.when(par_ok, S.div(F.col("_par_sum"), F.col("_par_sum") + 1) * 100)
    cols["abs_range"] = F.col("_most") - F.col("_least")
    cols["rel_range"] = S.div(F.col("_most"), F.col("_least"))
    out = out.withColumns(cols)
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def inequality_measures(rt: DataFrame, group=GROUP) -> DataFrame:
    """One row per group with its inequality measures (groups with no
    quintile rows are not reported)."""
    out = with_inequality_measures(rt, group).where(F.col("quintile") != "Total")
    return out.dropDuplicates(list(group)).select(*group, *MEASURE_COLS)


MEASURE_COLS = ["sii", "lowci_sii", "upci_sii", "rii", "lowci_rii", "upci_rii", "rii_int",
                "lowci_rii_int", "upci_rii_int", "par", "abs_range", "rel_range"]


def attach_to_totals(rt: DataFrame, group=GROUP) -> DataFrame:
    """Every quintile row and every 'Total' row carries its group's measures."""
    return with_inequality_measures(rt, group)
