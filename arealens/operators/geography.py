"""Geography operators: lookups, roll-up to every area level, code recoding.

The roll-up sums each prepared row into all the areas it belongs to in one
aggregate: the area columns are unpivoted with ``explode(array(...))`` (nulls
kept) and a single ``groupBy(code, ...)`` follows, so the partial aggregate in
each map task absorbs the national key that every row feeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.refdata import LEVEL_PREFIX, SCOTLAND


def geo_unpivot(df: DataFrame, level_cols, code_col: str = "code",
                drop=()) -> DataFrame:
    """Wide area columns -> one row per level in ``code_col``; null codes kept."""
    level_cols = list(level_cols)
    keep = [c for c in df.columns if c not in level_cols and c not in set(drop)]
    return df.select(*keep, F.explode(F.array(*[F.col(c) for c in level_cols])).alias(code_col))


def council_lookup(geo: DataFrame, ca: str = "ca", hb: str = "hb", adp: str | None = None,
                   hscp: str | None = None) -> DataFrame:
    """Council-based geography: the distinct (ca, hb[, adp][, hscp]) rows."""
    cols = [ca, hb] + [c for c in (adp, hscp) if c]
    return geo.select(*cols).distinct()


def join_geography(prepared: DataFrame, lookup: DataFrame, base_col: str,
                   lookup_key: str | None = None, national: bool = True) -> DataFrame:
    """Left join prepared rows to their areas; adds the national code column.

    Join strategy is left to the optimizer: the lookup has one row per base
    area, AQE broadcasts it after measuring it and otherwise sort-merges.
    """
    lookup_key = lookup_key or base_col
    if lookup_key != base_col:
        lookup = lookup.withColumnRenamed(lookup_key, base_col)
    out = prepared.join(lookup, on=base_col, how="left")
    if national and "scotland" not in out.columns:
        out = out.withColumn("scotland", F.lit(SCOTLAND))
    return out


def geo_rollup(prepared: DataFrame, lookup: DataFrame, base_col: str, level_cols,
               keys=("year",), measures=("numerator", "denominator"),
               keep_base: bool = False) -> DataFrame:
    """Sum measures to every geography level at once.

    ``level_cols`` are the lookup columns (plus ``scotland``) that become
    codes; when ``keep_base`` the base column itself is a level too (council
    geography).  Sum of an all-null group is 0, as in the reference.
    """
    measures = [m for m in measures if m in prepared.columns]
    joined = join_geography(prepared.select(base_col, *keys, *measures), lookup, base_col)
    levels = ([base_col] if keep_base else []) + [c for c in level_cols if c != base_col]
    long = geo_unpivot(joined.select(*keys, *measures, *levels), levels)
    return (long.groupBy("code", *keys)
            .agg(*[F.coalesce(F.sum(m), F.lit(0.0)).cast("double").alias(m) for m in measures]))


def level_filter(df: DataFrame, adp: bool = False, hscp: bool = True,
                 code_col: str = "code") -> DataFrame:
    """Drop ADP codes unless wanted, HSCP codes unless wanted, and null codes."""
    c = F.col(code_col)
    cond = c.isNotNull()
    if not adp:
        cond = cond & ~c.startswith(LEVEL_PREFIX["adp"])
    if not hscp:
        cond = cond & ~c.startswith(LEVEL_PREFIX["hscp"])
    return df.where(cond)


def recode_area(df: DataFrame, history: DataFrame, code_col: str = "code") -> DataFrame:
    """Retired codes -> current codes through a (small, literal) history table."""
    h = history.select(F.col("old_code").alias("_old"), F.col("new_code").alias("_new"))
    return (df.join(h, F.col(code_col) == F.col("_old"), "left")
            .withColumn(code_col, F.coalesce(F.col("_new"), F.col(code_col)))
            .drop("_old", "_new"))


def code_history_closure(history: DataFrame, hops: int = 5) -> tuple[DataFrame, DataFrame]:
    """Chains of retired codes resolved to their last code: (old_code, new_code), and the codes on or behind a cycle.

    Pointer jumping: each of ``hops`` self-joins of the (small) history doubles
    how far a code points, so chains of up to ``2 ** hops`` codes are resolved.
    A code that still points at a retired one then is on a cycle, or behind
    one (or in a longer chain); such codes are returned apart (``code``) and
    not in the first table, so a recode leaves them as they are.
    """
    old = history.select("old_code").distinct()
    now = history.select("old_code", "new_code").distinct()
    for _ in range(hops):
        step = now.select(F.col("old_code").alias("new_code"), F.col("new_code").alias("_next"))
        now = now.join(step, "new_code", "left").select("old_code", F.coalesce("_next", "new_code").alias("new_code"))
    ends = old.withColumnRenamed("old_code", "new_code")
    return now.join(ends, "new_code", "left_anti").select("old_code", "new_code"), now.join(
        ends, "new_code", "left_semi").select(F.col("old_code").alias("code"))


def area_closure(parents: DataFrame, child_col: str = "code", parent_col: str = "parent", depth: int = 4) -> DataFrame:
    """(area, ancestor, distance) for every area named in ``parents``, itself at distance 0 included.

    ``depth`` joins of the (small) parent table; an area reached on several
    ways keeps the shortest.  A cycle ends with the depth.
    """
    edge = parents.where(F.col(child_col).isNotNull() & F.col(parent_col).isNotNull()).select(
        F.col(child_col).alias("area"), F.col(parent_col).alias("ancestor")).distinct()
    areas = edge.select("area").unionByName(edge.select(F.col("ancestor").alias("area"))).distinct()
    out = areas.select("area", F.col("area").alias("ancestor"), F.lit(0).alias("distance"))
    level = edge.withColumn("distance", F.lit(1))
    up = edge.select(F.col("area").alias("ancestor"), F.col("ancestor").alias("_next"))
    for d in range(1, depth + 1):
        out = out.unionByName(level)
        if d < depth:
            level = level.join(up, "ancestor").select("area", F.col("_next").alias("ancestor"), F.lit(d + 1).alias("distance"))
    return out.groupBy("area", "ancestor").agg(F.min("distance").alias("distance"))


def name_to_code(df: DataFrame, aliases: DataFrame, name_col: str = "areaname",
                 code_col: str = "code") -> tuple[DataFrame, DataFrame]:
    """Area names (any listed spelling, case/space-insensitive) -> code.

    Returns (matched rows with ``code_col``, unmatched rows) so unmatched
    names are reported rather than silently dropped.
    """
    norm = lambda c: F.lower(F.regexp_replace(F.trim(c), r"\s+", " "))
    a = aliases.select(norm(F.col("alias")).alias("_key"), F.col("code").alias(code_col)).distinct()
    keyed = df.withColumn("_key", norm(F.col(name_col)))
    matched = keyed.join(a, "_key", "inner").drop("_key")
    unmatched = keyed.join(a, "_key", "left_anti").drop("_key")
    return matched, unmatched


def adp_rollup(df: DataFrame, council_to_adp: DataFrame, keys=("year",),
               measures=("numerator", "denominator"), code_col: str = "code") -> DataFrame:
    """Council rows summed into their alcohol & drug partnerships, appended.

    Several councils may map to one partnership; the sums are appended to the
    input rows.
    """
    measures = [m for m in measures if m in df.columns]
    councils = df.where(F.col(code_col).startswith(LEVEL_PREFIX["ca"]))
    m = council_to_adp.select(F.col("ca").alias(code_col), F.col("adp").alias("_adp"))
    adp = (councils.join(m, code_col, "inner")
           .groupBy(F.col("_adp").alias(code_col), *keys)
           .agg(*[F.coalesce(F.sum(x), F.lit(0.0)).alias(x) for x in measures]))
    return df.select(code_col, *keys, *measures).unionByName(adp)


def boundary_splice(old_col: str, new_col: str, year_col: str, first_new_year: int) -> Column:
    """Old boundaries before ``first_new_year``, new boundaries from it on."""
    return F.when(F.col(year_col) < first_new_year, F.col(old_col)).otherwise(F.col(new_col))


def join_parent_area(df: DataFrame, parents: DataFrame, child_col: str, parent_col: str,
                     missing: str = "x") -> DataFrame:
    """Attach the parent area of each child; children without a parent get ``missing``."""
    out = df.join(parents.select(child_col, parent_col), child_col, "left")
    return out.withColumn(parent_col, F.coalesce(F.col(parent_col), F.lit(missing)))


def incomplete_area_filter(df: DataFrame, exclusions: DataFrame, code_col: str = "code", year_col: str = "year",
                           closure: DataFrame | None = None, first_year: int = 1980, last_year: int = 2060) -> DataFrame:
    """Remove (area, year) rows listed as incomplete in ``exclusions(code, year_from, year_to)``.

    Exclusions are expanded to one row per (code, year) so the anti join is an
    equi-join (no range predicate, no nested loop); a null year is open and
    reaches ``first_year`` or ``last_year``.  With ``closure``
    (:func:`area_closure`) the areas under an excluded one leave too, in the
    same anti join.
    """
    years = F.sequence(F.coalesce(F.col("year_from").cast("int"), F.lit(first_year)),
                       F.coalesce(F.col("year_to").cast("int"), F.lit(last_year)))
    ex = exclusions.select(F.col("code").alias("_c"), F.explode(years).alias("_y"))
    if closure is not None:
        under = ex.join(closure.select(F.col("ancestor").alias("_c"), "area"), "_c").select(F.col("area").alias("_c"), "_y")
        ex = ex.unionByName(under).distinct()
    return df.join(ex, (F.col(code_col) == F.col("_c")) & (F.col(year_col) == F.col("_y")),
                   "left_anti")


def screen_small(df: DataFrame, above: dict[str, float], levels: dict[str, tuple[str, float]] | None = None,
                 without=(), code_col: str = "code") -> DataFrame:
    """Publication screens: rows whose measures exceed ``above``, at the levels wanted.

    ``above`` maps a measure to what it must exceed everywhere; ``levels``
    maps a code prefix to (measure, least value) for that level alone;
    ``without`` lists code prefixes that are not published.  A null measure
    does not exceed anything.
    """
    keep = F.lit(True)
    for measure, bound in above.items():
        keep = keep & (F.col(measure) > bound)
    for prefix, (measure, least) in (levels or {}).items():
        keep = keep & (~F.col(code_col).startswith(prefix) | (F.col(measure) >= least))
    for prefix in without:
        keep = keep & ~F.col(code_col).startswith(prefix)
    return df.where(F.coalesce(keep, F.lit(False)))
