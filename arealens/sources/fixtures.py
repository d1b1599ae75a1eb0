"""Bindings of the health-data shapes to the driver's TPC-H-like tables.

There is no health data in the test tables, so each input shape the library
reads is derived deterministically from them (datazone = customer, council =
nation, board = region, counted event = order, hospital episode = events row).
Each binding is a Spark plan over the parquet tables, so its size grows with
the scale factor; the DuckDB oracle inlines the same definitions as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import pad_number
from ..session import materialize
from .refdata import SCOTLAND
from .tables import read_table


def area_code(prefix: str, key) -> F.Column:
    """'S12' + key zero-padded to 6 digits (longer keys stay whole)."""
    return F.concat(F.lit(prefix), pad_number(key, 6))


def fx_area(spark: SparkSession, d: str) -> DataFrame:
    """datazone -> council (ca), board (hb) and Scotland: one row per datazone."""
    c = read_table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    n = read_table(spark, d, "nation", ["n_nationkey", "n_regionkey"])
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("c_custkey").alias("datazone"),
                    area_code("S12", "n_nationkey").alias("ca"),
                    area_code("S08", "n_regionkey").alias("hb"),
                    F.lit(SCOTLAND).alias("scotland")))


def fx_prepared(spark: SparkSession, d: str, exclude_status: str | None = None) -> DataFrame:
    """Prepared fact: (year, datazone, sex_grp, age_grp) -> urgent orders / all orders.

    ``exclude_status`` drops orders of one status (an 'earlier extract' for QA).
    """
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
                                        "o_orderstatus"])
    if exclude_status:
        o = o.where(F.col("o_orderstatus") != exclude_status)
    return (o.groupBy(F.year("o_orderdate").cast("int").alias("year"),
                      F.col("o_custkey").alias("datazone"),
                      (1 + F.col("o_orderkey") % 2).cast("int").alias("sex_grp"),
                      F.least(F.floor((F.col("o_orderkey") * 7 % 101) / 5) + 1, F.lit(19))
                      .cast("int").alias("age_grp"))
            .agg(F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0))
                 .cast("double").alias("numerator"),
                 F.count(F.lit(1)).cast("double").alias("denominator")))


def _distinct_values(df: DataFrame, c: str) -> F.Column:
    """The distinct values of a small domain column (years, sexes, age bands) as a literal array.

    One aggregate job with map-side partial sets; the result is a few dozen
    values at most and becomes a constant of the plan, so it is computed
    once however often the optimizer copies it.
    """
    vals = df.agg(F.array_sort(F.collect_set(c)).alias("v")).first()["v"]
    return F.array(*[F.lit(v) for v in vals])


def area_counts(spark: SparkSession, d: str) -> DataFrame:
    """Number of datazones per area code at every level (ca, hb, Scotland)."""
    a = fx_area(spark, d)
    return (a.select(F.explode(F.array("ca", "hb", "scotland")).alias("code"))
            .groupBy("code").agg(F.count(F.lit(1)).alias("n")))


def _domains(spark: SparkSession, d: str) -> F.Column:
    """The distinct years, sexes and age bands of the prepared fact, in one
    aggregate job, as a literal struct of sorted arrays (a few dozen values)."""
    p = fx_prepared(spark, d)
    row = p.agg(F.array_sort(F.collect_set("year")).alias("year"),
                F.array_sort(F.collect_set("sex_grp")).alias("sex_grp"),
                F.array_sort(F.collect_set("age_grp")).alias("age_grp")).first()
    return F.struct(*[F.array(*[F.lit(v) for v in row[c]]).alias(c) for c in ("year", "sex_grp", "age_grp")])


def fx_population(spark: SparkSession, d: str, per_band: int = 40) -> DataFrame:
    """Population per (year, code, sex, age band): ``per_band`` residents per datazone.

    The year / sex / age domains come from the prepared fact (one aggregate
    job, a few dozen values kept as plan constants) and are exploded per area
    row, so no join is needed to form the grid.
    """
    return (area_counts(spark, d).select("code", "n", _domains(spark, d).alias("_dom"))
            .select("code", "n", "_dom", F.explode("_dom.year").alias("year"))
            .select("year", "code", "n", "_dom", F.explode("_dom.sex_grp").alias("sex_grp"))
            .select("year", "code", "sex_grp", "n", F.explode("_dom.age_grp").alias("age_grp"))
            .select("year", "code", "sex_grp", "age_grp",
                    (F.lit(float(per_band)) * F.col("n")).alias("denominator")))


def fx_population_total(spark: SparkSession, d: str, per_area: int = 20) -> DataFrame:
    """All-ages population per (year, code): ``per_area`` residents per datazone."""
    years = _distinct_values(fx_prepared(spark, d), "year")
    return (area_counts(spark, d)
            .select("code", "n", F.explode(years).alias("year"))
            .select("year", "code", (F.lit(float(per_area)) * F.col("n")).alias("denominator")))


def fx_customer_pop(spark: SparkSession, d: str) -> DataFrame:
    """Per-datazone rank inputs: (datazone, pop, acctbal, nation) from customer."""
    c = read_table(spark, d, "customer", ["c_custkey", "c_acctbal", "c_nationkey"])
    return c.select(F.col("c_custkey").alias("datazone"),
                    (100 + F.col("c_custkey") % 400).alias("pop"),
                    F.col("c_acctbal").alias("score"),
                    F.col("c_nationkey"))


def fx_episode(spark: SparkSession, d: str) -> DataFrame:
    """Hospital episodes: one stay = one user-day; deaths are 'signup' rows."""
    e = read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    day = F.to_date("ts")
    diag = (F.when(F.col("event_type") == "purchase", "C34")
            .when(F.col("event_type") == "error", "I21")
            .when(F.col("event_type") == "click", "J44")
            .when(F.col("event_type") == "view", "K25")
            .otherwise("F10"))
    return e.select(
        F.col("user_id").alias("link_no"),
        day.cast("string").alias("cis_marker"),
        F.col("event_id").alias("uri"),
        day.alias("admission_date"),
        F.date_add(day, F.floor(F.col("value") / 60).cast("int")).alias("discharge_date"),
        (F.col("user_id") * 13 % 101).cast("int").alias("age"),
        (1 + F.col("user_id") % 2).cast("int").alias("sex_grp"),
        (F.col("user_id") % 27).cast("int").alias("pc7"),
        F.concat(diag, (F.col("event_id") % 10).cast("string")).alias("main_condition"),
        F.col("event_type"),
    )


# Secondary diagnosis positions: codes cycled from the event id so that every
# position carries a deterministic, different diagnosis.
DIAG_STEMS = ["C34", "I21", "J44", "K25", "F10", "X85", "Y09", "W01"]


def other_condition(k: int) -> F.Column:
    idx = (F.col("uri") * (k + 2) + k) % len(DIAG_STEMS)
    stem = F.element_at(F.array(*[F.lit(s) for s in DIAG_STEMS]), (idx + 1).cast("int"))
    return F.concat(stem, ((F.col("uri") + k) % 10).cast("string"))


def fx_episode_wide(spark: SparkSession, d: str) -> DataFrame:
    """Episodes with five secondary diagnosis positions."""
    ep = fx_episode(spark, d)
    return ep.select("*", *[other_condition(k).alias(f"other_condition_{k}") for k in range(1, 6)])


def fx_postcode(spark: SparkSession, d: str) -> DataFrame:
    """Postcode directory: pc7 (= nation key) -> council and board codes."""
    n = read_table(spark, d, "nation", ["n_nationkey", "n_regionkey"])
    return n.select(F.col("n_nationkey").alias("pc7"),
                    area_code("S12", "n_nationkey").alias("ca"),
                    area_code("S08", "n_regionkey").alias("hb"))


def fx_simd(spark: SparkSession, d: str) -> DataFrame:
    """Deprivation ranks of datazones: rank by account balance (1 = most deprived),
    population-weighted quintiles nationally, within board and within council.

    The three cuts are one running sum: each datazone is stacked once per
    scheme (national / board / council) with the scheme's area as the key,
    so a single range-partitioned pass computes every cumulative population
    (the national key, which holds every row, is split across partitions).
    """
    from ..operators.deprivation import quintile_cut
    from ..operators.sequence import running_sums

    c = read_table(spark, d, "customer", ["c_custkey", "c_acctbal"])
    base = (c.select(F.col("c_custkey").alias("datazone"), F.col("c_acctbal").alias("score"),
                     (100 + F.col("c_custkey") % 400).alias("pop"))
            .join(fx_area(spark, d).select("datazone", "ca", "hb"), "datazone"))
    schemes = F.array(F.struct(F.lit("sc").alias("scheme"), F.lit(SCOTLAND).alias("area")),
                      F.struct(F.lit("hb").alias("scheme"), F.col("hb").alias("area")),
                      F.struct(F.lit("ca").alias("scheme"), F.col("ca").alias("area")))
    long = base.select("*", F.explode(schemes).alias("_s")).select(
        "datazone", "score", "pop", "ca", "hb", "_s.scheme", "_s.area")
    r = running_sums(long, ["scheme", "area"], ["score", "datazone"],
                     {"rank": F.lit(1), "cum": F.col("pop")}, frame="rows", totals=True)
    r = r.withColumn("q", quintile_cut(F.col("cum"), F.col("cum_total")))
    pick = lambda sch, c: F.max(F.when(F.col("scheme") == sch, F.col(c)))
    out = (r.groupBy("datazone", "pop", "ca", "hb")
           .agg(pick("sc", "rank").cast("long").alias("simd_rank"), pick("sc", "q").alias("sc_quin"),
                pick("hb", "q").alias("hb_quin"), pick("ca", "q").alias("ca_quin"))
           .select("datazone", "pop", "simd_rank", "ca", "hb", "sc_quin", "hb_quin", "ca_quin"))
    # a lookup table (one row per datazone) that several branches read: written once
    return materialize(out, "simd")


def fx_depr_lookup(spark: SparkSession, d: str, simd: DataFrame | None = None) -> DataFrame:
    """(datazone, year) -> hb, ca and the three quintiles, for every fact year."""
    s = simd if simd is not None else fx_simd(spark, d)
    years = _distinct_values(fx_prepared(spark, d), "year")
    return s.select("datazone", F.explode(years).alias("year"), "pop", "ca", "hb",
                    "sc_quin", "hb_quin", "ca_quin")


def fx_depr_population(spark: SparkSession, d: str, lookup: DataFrame | None = None) -> DataFrame:
    """Population by (year, code, quintile, quint_type), Totals included."""
    from ..operators.inequality import quintile_rollup

    lk = lookup if lookup is not None else fx_depr_lookup(spark, d)
    pop = lk.select("year", "ca", "hb", "sc_quin", "hb_quin", "ca_quin",
                    F.col("pop").cast("double").alias("denominator"))
    return quintile_rollup(pop, keys=["year"], measures=["denominator"])
