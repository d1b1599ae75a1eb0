"""Ingest, cleaning, joins and reshape queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as DT
from ..functions import text as TX
from ..operators import cleaning as CL
from ..operators import geography as G
from ..operators import reshape as RS
from ..session import scratch_path
from ..sources import fixtures as FX
from ..sources.refdata import CODE_HISTORY, code_history_table, values_sql
from ..sources.tables import read_csv, read_table, stack_with_source
from . import oracle_sql as O
from .registry import present, register


# ---- A: sources -------------------------------------------------------------------

@register("src_table_read", sql=(
    "SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INT) AS year, o_orderpriority FROM orders "
    "WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'"))
def q_src_table_read(spark, d):
    o = read_table(spark, d, "orders", where=F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    return o.select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("int").alias("year"),
                    "o_orderpriority")


@register("src_csv_read", sql="SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_src_csv_read(spark, d):
    """Nation landed as CSV with display headers, read back with normalised names and types."""
    n = read_table(spark, d, "nation").select(F.col("n_nationkey").alias("N NationKey"),
                                              F.col("n_name").alias("N-Name"),
                                              F.col("n_regionkey").alias("N RegionKey"))
    path = scratch_path(spark, "csv")
    n.write.mode("overwrite").option("header", True).csv(path)
    return read_csv(spark, path, types={"n_nationkey": "int", "n_regionkey": "int"})


@register("union_files", sql=(
    "SELECT c_custkey AS key, c_nationkey AS nationkey, c_acctbal AS acctbal, 'customer' AS source FROM customer "
    "UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal, 'supplier' FROM supplier"))
def q_union_files(spark, d):
    c = read_table(spark, d, "customer").select(F.col("c_custkey").alias("key"),
                                                F.col("c_nationkey").alias("nationkey"),
                                                F.col("c_acctbal").alias("acctbal"))
    s = read_table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"),
                                                F.col("s_nationkey").alias("nationkey"),
                                                F.col("s_acctbal").alias("acctbal"))
    return present(stack_with_source({"customer": c, "supplier": s}))


_Y7 = "(CAST(year(o_orderdate) AS INT) + 7)"
_CODE_SQL = (
    f"CASE o_orderkey % 3 WHEN 0 THEN substr(CAST({_Y7} AS VARCHAR), 4, 1) || substr(CAST({_Y7} + 1 AS VARCHAR), 3, 2) "
    f"WHEN 1 THEN substr(CAST({_Y7} + 3 AS VARCHAR), 3, 2) || substr(CAST({_Y7} + 4 AS VARCHAR), 3, 2) "
    f"ELSE CAST({_Y7} AS VARCHAR) || '/' || substr(CAST({_Y7} + 1 AS VARCHAR), 3, 2) END")


@register("clean_fin_year", sql=(
    f"SELECT o_orderkey, code, CAST(CASE WHEN length(trim(code)) = 3 THEN '200' || substr(trim(code), 1, 1) "
    "WHEN contains(trim(code), '/') THEN substr(trim(code), 1, 4) ELSE '20' || substr(trim(code), 1, 2) END AS INT) "
    f"AS fin_year FROM (SELECT o_orderkey, {_CODE_SQL} AS code FROM orders)"))
def q_clean_fin_year(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    y = F.year("o_orderdate").cast("int") + 7
    s = lambda c: c.cast("string")
    code = (F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.substring(s(y), 4, 1), F.substring(s(y + 1), 3, 2)))
            .when(F.col("o_orderkey") % 3 == 1, F.concat(F.substring(s(y + 3), 3, 2), F.substring(s(y + 4), 3, 2)))
            .otherwise(F.concat(s(y), F.lit("/"), F.substring(s(y + 1), 3, 2))))
    t = o.select("o_orderkey", code.alias("code"))
    return t.withColumn("fin_year", DT.clean_fin_year("code"))


_NUM_TEXT = ("CASE WHEN o_orderkey % 7 = 0 THEN '-' ELSE CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) "
             "|| ',' || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0') END")


@register("clean_numeric_text", sql=(
    "SELECT o_orderkey, txt, CASE WHEN trim(txt) = '-' THEN 0.0 ELSE TRY_CAST(replace(trim(txt), ',', '') AS DOUBLE) END "
    f"AS value FROM (SELECT o_orderkey, {_NUM_TEXT} AS txt FROM orders)"))
def q_clean_numeric_text(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_totalprice"])
    txt = (F.when(F.col("o_orderkey") % 7 == 0, F.lit("-"))
           .otherwise(F.concat(F.floor(F.col("o_totalprice") / 1000).cast("string"), F.lit(","),
                               F.lpad((F.floor("o_totalprice") % 1000).cast("string"), 3, "0"))))
    t = o.select("o_orderkey", txt.alias("txt"))
    return t.withColumn("value", TX.clean_numeric_text("txt"))


@register("clean_label", sql=(
    "SELECT n_nationkey, replace(string_split(label, ': ')[-1], '&', 'and') AS label, "
    "substr(trim(raw_code), 1, 9) AS code, lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS entry FROM "
    "(SELECT n_nationkey, 'Area: ' || r_name || ': ' || n_name || ' & ' || r_name AS label, "
    "'S12' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') || ' ' || n_name AS raw_code "
    "FROM nation JOIN region ON n_regionkey = r_regionkey)"))
def q_clean_label(spark, d):
    n = read_table(spark, d, "nation")
    r = read_table(spark, d, "region")
    t = n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey",
        F.concat(F.lit("Area: "), "r_name", F.lit(": "), "n_name", F.lit(" & "), "r_name").alias("label"),
        F.concat(FX.area_code("S12", "n_nationkey"), F.lit(" "), "n_name").alias("raw_code"))
    return t.select("n_nationkey", TX.ampersand_to_and(TX.after_last("label", ": ")).alias("label"),
                    TX.trim_code("raw_code").alias("code"), TX.pad_number("n_nationkey").alias("entry"))


@register("drop_unknown_area", sql=O.with_fx(body=(
    "SELECT e.uri, p.ca FROM fx_episode e LEFT JOIN fx_postcode p ON e.pc7 = p.pc7 "
    "WHERE p.ca IS NOT NULL AND trim(p.ca) <> '' AND p.ca NOT IN ('S12000000') AND starts_with(p.ca, 'S12')")))
def q_drop_unknown_area(spark, d):
    ep = FX.fx_episode(spark, d).select("uri", "pc7").join(FX.fx_postcode(spark, d), "pc7", "left")
    return CL.drop_unknown_area(ep, "ca", sentinels=["S12000000"], prefix="S12").select("uri", "ca")


# ---- B: recodes ---------------------------------------------------------------------

@register("recode_area", sql=O.with_fx(
    ("h", values_sql(CODE_HISTORY, ["old_code", "new_code"])),
    body="SELECT a.datazone, coalesce(h1.new_code, a.ca) AS ca, coalesce(h2.new_code, a.hb) AS hb FROM fx_area a "
         "LEFT JOIN h h1 ON a.ca = h1.old_code LEFT JOIN h h2 ON a.hb = h2.old_code"))
def q_recode_area(spark, d):
    a = FX.fx_area(spark, d).select("datazone", "ca", "hb")
    hist = code_history_table(spark)
    return G.recode_area(G.recode_area(a, hist, "ca"), hist, "hb")


_NAMES_SQL = ("SELECT n_nationkey AS k, CASE n_nationkey % 3 WHEN 0 THEN n_name WHEN 1 THEN upper(n_name) "
              "ELSE replace(n_name, ' ', '  ') || ' ' END AS areaname FROM nation UNION ALL "
              "SELECT -1, 'Atlantis'")
_ALIAS_SQL = ("SELECT n_name AS alias, 'S12' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS code FROM nation "
              "UNION ALL SELECT n_name || ' council', 'S12' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') FROM nation")


@register("name_to_code", sql=O.with_fx(
    ("nm", _NAMES_SQL), ("al", _ALIAS_SQL),
    ("ak", "SELECT DISTINCT lower(regexp_replace(trim(alias), '\\s+', ' ', 'g')) AS key, code FROM al"),
    body="SELECT nm.k, nm.areaname, ak.code, ak.code IS NOT NULL AS matched FROM nm LEFT JOIN ak "
         "ON lower(regexp_replace(trim(nm.areaname), '\\s+', ' ', 'g')) = ak.key"))
def q_name_to_code(spark, d):
    n = read_table(spark, d, "nation", ["n_nationkey", "n_name"])
    names = n.select(F.col("n_nationkey").alias("k"),
                     F.when(F.col("n_nationkey") % 3 == 0, F.col("n_name"))
                     .when(F.col("n_nationkey") % 3 == 1, F.upper("n_name"))
                     .otherwise(F.concat(F.regexp_replace("n_name", " ", "  "), F.lit(" "))).alias("areaname"))
    names = names.unionByName(spark.createDataFrame([(-1, "Atlantis")], "k bigint, areaname string"))
    code = FX.area_code("S12", "n_nationkey")
    aliases = (n.select(F.col("n_name").alias("alias"), code.alias("code"))
               .unionByName(n.select(F.concat("n_name", F.lit(" council")).alias("alias"), code.alias("code"))))
    matched, unmatched = G.name_to_code(names, aliases)
    return (matched.withColumn("matched", F.lit(True))
            .unionByName(unmatched.withColumn("code", F.lit(None).cast("string")).withColumn("matched", F.lit(False)))
            .select("k", "areaname", "code", "matched"))


# ---- C: joins -------------------------------------------------------------------------

@register("join_geography", sql=O.with_fx(
    ("c", "SELECT p.year, a.ca, sum(p.numerator) AS numerator, sum(p.denominator) AS denominator "
          "FROM fx_prepared p JOIN fx_area a ON p.datazone = a.datazone GROUP BY p.year, a.ca"),
    body="SELECT c.year, c.ca, c.numerator, c.denominator, l.hb, 'S00000001' AS scotland FROM c "
         "LEFT JOIN (SELECT DISTINCT ca, hb FROM fx_area) l ON c.ca = l.ca"))
def q_join_geography(spark, d):
    area = FX.fx_area(spark, d)
    c = (FX.fx_prepared(spark, d).join(area.select("datazone", "ca"), "datazone")
         .groupBy("year", "ca").agg(F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator")))
    out = G.join_geography(c, G.council_lookup(area), "ca")
    return present(out.select("year", "ca", "numerator", "denominator", "hb", "scotland"))


def _ca_counts_sql(where: str, name: str) -> str:
    return (f"SELECT CAST(year(o_orderdate) AS INT) AS year, a.ca, CAST(count(*) AS DOUBLE) AS {name} "
            f"FROM orders JOIN fx_area a ON o_custkey = a.datazone {where} GROUP BY 1, 2")


def _ca_counts(spark, d, name, cond=None):
    o = read_table(spark, d, "orders", ["o_custkey", "o_orderdate", "o_orderstatus"])
    if cond is not None:
        o = o.where(cond)
    a = FX.fx_area(spark, d).select("datazone", "ca")
    return (o.join(a, o.o_custkey == a.datazone).groupBy(F.year("o_orderdate").cast("int").alias("year"), "ca")
            .agg(F.count(F.lit(1)).cast("double").alias(name)))


@register("join_inner_measures", sql=O.with_fx(
    ("n", _ca_counts_sql("WHERE o_orderstatus = 'F'", "numerator")), ("dd", _ca_counts_sql("", "denominator")),
    body="SELECT n.year, n.ca, n.numerator, dd.denominator FROM n JOIN dd ON n.year = dd.year AND n.ca = dd.ca"))
def q_join_inner_measures(spark, d):
    n = _ca_counts(spark, d, "numerator", F.col("o_orderstatus") == "F")
    den = _ca_counts(spark, d, "denominator")
    return n.join(den, ["year", "ca"], "inner").select("year", "ca", "numerator", "denominator")


@register("join_full_dictionary", sql=O.with_fx(
    ("n", "SELECT a.ca, CAST(count(*) AS DOUBLE) AS numerator FROM orders JOIN fx_area a ON o_custkey = a.datazone "
          "WHERE o_orderstatus = 'P' GROUP BY a.ca"),
    ("dict", "SELECT 'S12' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS ca, n_name AS areaname FROM nation "
             "UNION ALL SELECT 'S12000099', 'Nowhere'"),
    body="SELECT coalesce(n.ca, dict.ca) AS ca, dict.areaname, coalesce(n.numerator, 0) AS numerator "
         "FROM n FULL JOIN dict ON n.ca = dict.ca"))
def q_join_full_dictionary(spark, d):
    n = (_ca_counts(spark, d, "numerator", F.col("o_orderstatus") == "P").groupBy("ca")
         .agg(F.sum("numerator").alias("numerator")))
    nat = read_table(spark, d, "nation", ["n_nationkey", "n_name"])
    dic = (nat.select(FX.area_code("S12", "n_nationkey").alias("ca"), F.col("n_name").alias("areaname"))
           .unionByName(spark.createDataFrame([("S12000099", "Nowhere")], "ca string, areaname string")))
    out = n.join(dic, "ca", "full")
    return out.select("ca", "areaname", F.coalesce("numerator", F.lit(0.0)).alias("numerator"))


@register("join_parent_area", sql=(
    "SELECT 'S12' || lpad(CAST(n.n_nationkey AS VARCHAR), 6, '0') AS ca, coalesce(p.parent, 'x') AS parent "
    "FROM nation n LEFT JOIN (SELECT 'S12' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS ca, "
    "'S37' || lpad(CAST(n_regionkey AS VARCHAR), 6, '0') AS parent FROM nation WHERE n_nationkey % 2 = 0) p "
    "ON 'S12' || lpad(CAST(n.n_nationkey AS VARCHAR), 6, '0') = p.ca"))
def q_join_parent_area(spark, d):
    nat = read_table(spark, d, "nation", ["n_nationkey", "n_regionkey"])
    kids = nat.select(FX.area_code("S12", "n_nationkey").alias("ca"))
    parents = nat.where(F.col("n_nationkey") % 2 == 0).select(
        FX.area_code("S12", "n_nationkey").alias("ca"), FX.area_code("S37", "n_regionkey").alias("parent"))
    return G.join_parent_area(kids, parents, "ca", "parent")


_REG_KEY = ("CAST(l_orderkey AS VARCHAR) || lpad(CAST(l_linenumber AS VARCHAR), greatest(3, length(CAST(l_linenumber AS VARCHAR)))::INT, '0') || "
            "CAST(year(l_shipdate) AS VARCHAR)")


@register("join_registry", sql=(
    f"SELECT e.key, e.l_quantity, r.reg_quantity FROM (SELECT {_REG_KEY} AS key, l_quantity FROM lineitem) e "
    f"LEFT JOIN (SELECT {_REG_KEY} AS key, l_quantity AS reg_quantity FROM lineitem WHERE l_returnflag = 'R') r "
    "ON e.key = r.key"))
def q_join_registry(spark, d):
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_returnflag"])
    key = F.concat(F.col("l_orderkey").cast("string"), TX.pad_number("l_linenumber"),
                   F.year("l_shipdate").cast("string"))
    ext = li.select(key.alias("key"), "l_quantity")
    reg = li.where(F.col("l_returnflag") == "R").select(key.alias("key"), F.col("l_quantity").alias("reg_quantity"))
    return ext.join(reg, "key", "left")


@register("boundary_splice", sql=O.with_fx(
    ("o", "SELECT CAST(year(o_orderdate) AS INT) AS year, o_custkey, o_custkey % (SELECT max(s_suppkey) FROM supplier) + 1 AS suppkey FROM orders"),
    ("x", "SELECT o.year, 'S12' || lpad(CAST(c.c_nationkey AS VARCHAR), 6, '0') AS ca_old, "
          "'S12' || lpad(CAST(s.s_nationkey AS VARCHAR), 6, '0') AS ca_new FROM o "
          "LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN supplier s ON o.suppkey = s.s_suppkey"),
    body="SELECT year, CASE WHEN year < 1998 THEN ca_old ELSE ca_new END AS ca, CAST(count(*) AS DOUBLE) AS numerator "
         "FROM x GROUP BY 1, 2"))
def q_boundary_splice(spark, d):
    c = read_table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    s = read_table(spark, d, "supplier", ["s_suppkey", "s_nationkey"])
    last = s.select(F.max("s_suppkey")).scalar()
    o = read_table(spark, d, "orders", ["o_orderdate", "o_custkey"]).select(
        F.year("o_orderdate").cast("int").alias("year"), "o_custkey", (F.col("o_custkey") % last + 1).alias("suppkey"))
    x = (o.join(c, o.o_custkey == c.c_custkey, "left").join(s, o.suppkey == s.s_suppkey, "left")
         .select("year", FX.area_code("S12", "c_nationkey").alias("ca_old"),
                 FX.area_code("S12", "s_nationkey").alias("ca_new")))
    x = x.withColumn("ca", G.boundary_splice("ca_old", "ca_new", "year", 1998))
    return x.groupBy("year", "ca").agg(F.count(F.lit(1)).cast("double").alias("numerator"))


# ---- D: reshapes ------------------------------------------------------------------------

def _wide(spark, d):
    o = read_table(spark, d, "orders", ["o_custkey", "o_orderdate"]).withColumn("y", F.year("o_orderdate"))
    years = sorted(r["y"] for r in o.select("y").distinct().collect())  # one row a year
    return o.groupBy("o_custkey").agg(*[F.sum(F.when(F.col("y") == y, 1.0)).alias(f"n{y}") for y in years])


@register("wide_years_unpivot", sql=(
    "SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS year, CAST(count(*) AS DOUBLE) AS value FROM orders "
    "GROUP BY 1, 2"))
def q_wide_years_unpivot(spark, d):
    w = _wide(spark, d)
    return RS.wide_years_unpivot(w, ["o_custkey"], [c for c in w.columns if c != "o_custkey"], prefix="n", drop_null=True)


@register("measure_pivot", sql=(
    "SELECT CAST(year(l_shipdate) AS INT) AS year, l_linestatus, "
    + ", ".join(f"round(sum(CASE WHEN l_returnflag = '{v}' THEN l_quantity END), 6) AS {v}" for v in "ANR")
    + " FROM lineitem GROUP BY 1, 2"))
def q_measure_pivot(spark, d):
    li = read_table(spark, d, "lineitem", ["l_shipdate", "l_linestatus", "l_returnflag", "l_quantity"])
    li = li.withColumn("year", F.year("l_shipdate").cast("int"))
    return present(RS.measure_pivot(li, ["year", "l_linestatus"], "l_returnflag", ["A", "N", "R"], "l_quantity"))


@register("geo_pivot", sql=O.with_fx(
    ("j", "SELECT p.*, a.ca, a.hb, 'S00000001' AS scotland FROM fx_prepared p LEFT JOIN fx_area a "
          "ON p.datazone = a.datazone"),
    ("r", O.rollup_sql("j", ["ca", "hb", "scotland"], ["year"])),
    body="SELECT year, " + ", ".join(f"count(DISTINCT CASE WHEN substr(code, 1, 3) = '{g}' THEN code END) AS {g}"
                                     for g in ("S00", "S08", "S12")) + " FROM r GROUP BY year"))
def q_geo_pivot(spark, d):
    r = G.geo_rollup(FX.fx_prepared(spark, d), FX.fx_area(spark, d), "datazone", ["ca", "hb", "scotland"],
                     keys=["year"])
    return RS.geo_pivot(r)


@register("union_all", sql=O.with_fx(
    ("j", "SELECT p.*, a.ca, a.hb FROM fx_prepared p JOIN fx_area a ON p.datazone = a.datazone"),
    body="SELECT ca AS code, year, CAST(sum(numerator) AS DOUBLE) AS numerator, CAST(sum(denominator) AS DOUBLE) "
         "AS denominator FROM j GROUP BY 1, 2 UNION ALL SELECT hb, year, CAST(sum(numerator) AS DOUBLE), NULL "
         "FROM j GROUP BY 1, 2"))
def q_union_all(spark, d):
    j = FX.fx_prepared(spark, d).join(FX.fx_area(spark, d), "datazone")
    ca = j.groupBy(F.col("ca").alias("code"), "year").agg(F.sum("numerator").alias("numerator"),
                                                          F.sum("denominator").alias("denominator"))
    hb = j.groupBy(F.col("hb").alias("code"), "year").agg(F.sum("numerator").alias("numerator"))
    return RS.union_all([ca, hb])


@register("distinct_rows", sql=O.with_fx(body="SELECT DISTINCT ca, hb FROM fx_area"))
def q_distinct_rows(spark, d):
    return G.council_lookup(FX.fx_area(spark, d))


@register("sort_stable", sql=(
    "SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1"))
def q_sort_stable(spark, d):
    o = read_table(spark, d, "orders", ["o_custkey", "o_orderkey", "o_orderdate"])
    return RS.first_per_group(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate"])
