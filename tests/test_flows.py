"""Operators of the whole flows on small frames: index, running folds, incidence, closures, calendar periods, sources."""

import dataclasses
import os
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from arealens.operators import attributable as AT
from arealens.operators import episodes as E
from arealens.operators import geography as G
from arealens.operators import periods as P
from arealens.operators import qa as Q
from arealens.operators import reshape as RS
from arealens.operators import sequence
from arealens.plans import catalogue as C
from arealens.plans import planner
from arealens.plans.indicator import INDICATOR_COLUMNS, run_indicator
from arealens.sources.refdata import RR_RULE_SCHEMA, smoking_rr_rules
from arealens.sources.tables import read_tagged, split_predicates

SF = "/root/testdata/sf0.001"


# ---- relative-risk index ------------------------------------------------------------------------
def test_index_equals_the_ranges(spark):
    cur, ex = smoking_rr_rules("admissions")
    rng = random.Random(5)
    events = [(i, rng.choice("CIJKHSOZ") + f"{rng.randrange(100):02d}", rng.choice([1, 2]), rng.choice([None, *range(1, 20)]))
              for i in range(3000)] + [(9000, "C3", 1, 5), (9001, None, 1, 5), (9002, "c34", 1, 5), (9003, "C34", None, 5)]

    def risk(rules, diag, sex, band):
        for s, lo, hi, a, b, rr in rules:
            if s == sex and lo <= diag <= hi and (band is None and a is None and b is None or band is not None
                                                  and (a is None or band >= a) and (b is None or band <= b)):
                return rr
        return 0.0

    want = {i: (risk(cur, d, s, b), risk(ex, d, s, b)) for i, d, s, b in events if d and len(d) == 3}
    df = spark.createDataFrame(events, "uri int, diag string, sex_grp int, age_grp int")
    rules = [spark.createDataFrame(r, RR_RULE_SCHEMA) for r in (cur, ex)]
    out = AT.smoking_relative_risk(df, *rules)
    assert {r.uri: (r.current, r.ex) for r in out.collect()} == {i: v for i, v in want.items() if v[0] > 0}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "BroadcastHashJoin" in plan
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert all(">=" not in line and "<=" not in line for line in joins)


def test_overlapping_rules_are_an_error(spark):
    rules = spark.createDataFrame([(1, "C00", "C10", None, None, 2.0), (1, "C05", "C12", None, None, 3.0)], RR_RULE_SCHEMA)
    with pytest.raises(Exception, match="overlap"):
        AT.code_range_index(rules, "current").collect()


# ---- running folds and incidence ------------------------------------------------------------------
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_values_equal_windows(spark, inclusive):
    rng = random.Random(6)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), i, rng.choice([None, *range(50)]), rng.random() < 0.1) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, t int, x int, b boolean").repartition(3)
    values = {"hi": ("max", F.col("x")), "lo": ("min", F.col("x")), "total": ("sum", F.col("x")), "some": ("any", F.col("b")),
              "every": ("all", ~F.col("b"))}
    got = sequence.running_values(df, ["k"], ["t"], values, inclusive=inclusive, num_partitions=7)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    want = df.select("*", F.max("x").over(w).alias("hi"), F.min("x").over(w).alias("lo"), F.sum("x").over(w).alias("total"),
                     F.bool_or("b").over(w).alias("some"), F.bool_and(~F.col("b")).over(w).alias("every"))
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    whole = sequence.running_values(df, [], ["t"], {"hi": ("max", F.col("x"))}, num_partitions=5)
    w = Window.partitionBy(F.lit(0)).orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, df.withColumn("hi", F.max("x").over(w)).collect()))


def test_incidence_takes_the_latest_earlier_discharge(spark):
    day = lambda n: f"DATE '2000-01-01' + {n}"
    stays = [(1, "a", 40, 2002, 0, 10), (1, "b", 50, 2012, 3659, 3660),                                # 3,649 days: not new
             (2, "a", 40, 2002, 0, 10), (2, "b", 50, 2012, 3660, 3661),                                # 3,650 days: new
             (3, "a", 40, 2002, 0, 4000), (3, "b", 41, 2003, 100, 110), (3, "c", 52, 2012, 3900, 3901),  # the long first stay
             (4, "a", 15, 2002, 0, 1), (4, "b", 16, 2003, 400, 401),                                   # the child's stay leaves first
             (5, "a", 40, 2001, 0, 1), (5, "b", 41, 2002, 400, 401)]                                   # the early year leaves last
    rows = " UNION ALL ".join(f"SELECT {p}, '{c}', {a}, {y}, {day(s)}, {day(e)}" for p, c, a, y, s, e in stays)
    df = spark.sql(f"SELECT * FROM ({rows}) AS t(link_no, cis_marker, age, year, admission_date, discharge_date)")
    deaths = spark.sql(f"SELECT 6 AS link_no, 'd' AS cis_marker, 80 AS age, 2010 AS year, {day(50)} AS admission_date UNION ALL "
                       f"SELECT 2, 'd', 60, 2013, {day(3700)}")
    got = E.incidence(df, deaths)
    assert sorted((r.link_no, r.cis_marker) for r in got.collect()) == [
        (1, "a"), (2, "a"), (2, "b"), (3, "a"), (4, "b"), (6, "d")]


def test_qualifying_stays_in_one_aggregate(spark):
    rows = [(1, "a", 1, "X1"), (1, "a", 2, "F10"), (1, "b", 3, "X1"), (2, "a", 4, None)]
    df = spark.createDataFrame(rows, "link_no int, cis_marker string, uri int, main_condition string").selectExpr(
        "*", "date'2020-01-01' + uri AS admission_date", "date'2020-01-02' + uri AS discharge_date", "uri AS age", "1 AS sex_grp", "1 AS pc7")
    hit = E.diag_match("main_condition", "F10")
    one, two = E.stay_collapse(df, qualifies=hit), E.stay_collapse(E.semi_stay(df, hit))
    assert one.collect() == two.collect() and one.count() == 1


# ---- closures -----------------------------------------------------------------------------------------
def test_history_chains_and_cycles(spark):
    h = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "z"), ("z", "x"), ("w", "x"), ("s", "s")]
                              + [(f"n{i}", f"n{i + 1}") for i in range(20)], "old_code string, new_code string")
    resolved, cyclic = G.code_history_closure(h)
    got = {r.old_code: r.new_code for r in resolved.collect()}
    assert {k: got[k] for k in "abc"} == {"a": "d", "b": "d", "c": "d"} and got["n0"] == got["n19"] == "n20"
    assert sorted(r.code for r in cyclic.collect()) == ["s", "w", "x", "y", "z"] and not set(got) & set("swxyz")
    df = spark.createDataFrame([("a",), ("d",), ("w",), (None,)], "code string")
    assert [r.code for r in G.recode_area(df, resolved).collect()] == ["d", "d", "w", None]
    short, left = G.code_history_closure(h, hops=1)     # chains of two codes at most
    assert {"a", "n0"} <= {r.code for r in left.collect()}


def test_children_of_an_excluded_area_leave(spark):
    parents = spark.createDataFrame([("iz1", "loc1"), ("loc1", "hscp1"), ("iz2", "loc2"), ("loc2", "hscp2"), ("iz1", "loc1"),
                                     ("hscp1", None)], "code string, parent string")
    closure = G.area_closure(parents)
    assert {(r.area, r.ancestor): r.distance for r in closure.collect() if r.area == "iz1"} == {
        ("iz1", "iz1"): 0, ("iz1", "loc1"): 1, ("iz1", "hscp1"): 2}
    df = spark.createDataFrame([(c, y) for c in ("iz1", "loc1", "hscp1", "iz2", "other") for y in (2000, 2005, 2010)], "code string, year int")
    ex = spark.createDataFrame([("hscp1", None, 2005), ("loc2", 2010, None), ("other", 2005, 2005)], "code string, year_from int, year_to int")
    got = sorted((r.code, r.year) for r in G.incomplete_area_filter(df, ex, closure=closure).collect())
    assert got == [("hscp1", 2010), ("iz1", 2010), ("iz2", 2000), ("iz2", 2005), ("loc1", 2010), ("other", 2000), ("other", 2010)]
    plain = G.incomplete_area_filter(df, ex)
    assert ("iz1", 2000) in {(r.code, r.year) for r in plain.collect()}


def test_screens(spark):
    df = spark.createDataFrame([("S12", 5.0, 9.0), ("S12", 4.0, 9.0), ("S08", 40.0, 9.0), ("S08", 50.0, 9.0), ("S02", 99.0, 9.0),
                                ("S12", None, 9.0), ("S12", 9.0, 5.0)], "code string, numerator double, denominator double")
    got = G.screen_small(df, {"numerator": 4, "denominator": 5}, {"S08": ("numerator", 50)}, without=("S02", "S99"))
    assert sorted((r.code, r.numerator) for r in got.collect()) == [("S08", 50.0), ("S12", 5.0)]


# ---- calendar periods, slices ---------------------------------------------------------------------------
def test_strict_years_miss_no_year(spark):
    df = spark.createDataFrame([("A", y, float(y - 2000), 10.0) for y in (2001, 2002, 2004, 2005, 2006)],
                               "code string, year int, numerator double, denominator double")
    strict = P.rolling_mean(df, ["code"], 3, strict_years=True).collect()
    assert [(r.year, r.numerator) for r in strict] == [(2005, 5.0)]
    assert sorted(r.year for r in P.rolling_mean(df, ["code"], 3).collect()) == [2003, 2004, 2005]


def test_a_row_joins_all_its_slices(spark):
    df = spark.createDataFrame([("All", "All", 1), ("16-34", "All", 2), ("All", "Male", 3), ("16-34", "Male", 4)],
                               "age_grp string, sex_grp string, v int")
    slices = spark.createDataFrame([(1, None, None), (2, None, None), (3, "16-34", None), (4, None, "Male")],
                                   "ind_id int, age_grp string, sex_grp string")
    got = RS.match_slices(df, slices, ["age_grp", "sex_grp"])
    assert sorted((r.ind_id, r.v) for r in got.collect()) == [(1, 1), (2, 1), (3, 2), (4, 3)]


def test_observed_equals_the_checks(spark, tmp_path):
    rows = [("A", 1, 2000, 1.0, 5.0, 4.0, 6.0, "p", "t"), ("B", 1, 2000, None, 7.0, 4.0, 6.0, "p", None), ("C", 1, 2001, 2.0, 3.0, 4.0, 6.0, None, "t")]
    ind = spark.createDataFrame(rows, "code string, ind_id int, year int, numerator double, rate double, lowci double, upci double, "
                                      "def_period string, trend_axis string")
    out, seen = Q.observed(ind)
    out.write.parquet(str(tmp_path / "ind"))
    got = seen.get
    assert got["rows"] == 3 and got["ci_error_total"] == Q.qa_ci_contains(ind).collect()[0][0] == 2
    missing = Q.qa_missing(ind).collect()[0].asDict()
    assert {k: v for k, v in got.items() if k.startswith("null_")} == {k: v for k, v in missing.items() if k != "columns_ok"}


# ---- sources -----------------------------------------------------------------------------------------------
def test_tagged_reading_is_one_scan(spark, tmp_path):
    for y in (2001, 2002, 2003):
        df = spark.range(y - 2000).withColumn("more", F.lit("x")) if y == 2002 else spark.range(y - 2000)
        df.write.parquet(f"{tmp_path}/extract_{y}.parquet")
    got = read_tagged(spark, [f"{tmp_path}/extract_{y}.parquet" for y in (2001, 2002, 2003)], r"extract_(\d{4})")
    assert sorted((r.year, r.id, r.more) for r in got.collect()) == [
        (2001, 0, None), (2002, 0, "x"), (2002, 1, "x"), (2003, 0, None), (2003, 1, None), (2003, 2, None)]
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


@pytest.mark.parametrize("kind,value", [("bigint", "CASE WHEN id % 9 = 0 THEN NULL WHEN id % 3 = 0 THEN 7 ELSE id * 13 % 997 END"),
                                        ("date", "date'2020-01-01' + cast(id % 400 as int)"), ("timestamp", "timestamp_seconds(id * 977)"),
                                        ("double", "CASE WHEN id % 50 = 0 THEN double('NaN') ELSE id / 7 END"), ("int", "CAST(NULL AS int)")])
def test_every_row_falls_in_one_range(spark, tmp_path, kind, value):
    spark.range(3000).selectExpr("id", f"CAST({value} AS {kind}) AS k").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    parts = split_predicates(df, "k", 8)
    seen = Counter(r.id for p in parts for r in df.where(p).select("id").collect())
    assert len(seen) == 3000 and set(seen.values()) == {1}
    assert len(set(parts)) == len(parts) <= 9


def test_a_text_key_is_refused(spark):
    with pytest.raises(TypeError, match="string"):
        split_predicates(spark.createDataFrame([("a",)], "k string"), "k", 2)


# ---- catalogue planner --------------------------------------------------------------------------------------
@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_catalogue_rows_of_three_datasets_equal_separate_runs(spark):
    from arealens.plans.q_indicator import LEVELS
    from arealens.sources import fixtures as FX

    row = C.CatalogueEntry(1, "one", "second", "percent", 3, "calendar", 1995, 2001, "datazone11", None, None, None, False, False, None)
    other = dataclasses.replace(row, ind_id=4, dataset="three", measure="crude", crude_rate=1000, time_agg=1, pop="all")
    rows = [row, dataclasses.replace(row, ind_id=2), dataclasses.replace(row, ind_id=3, dataset="two"), other]
    fact, area = FX.fx_prepared(spark, SF), FX.fx_area(spark, SF)
    sources = {"one": fact, "two": fact.where("sex_grp = 1"), "three": fact.drop("denominator")}
    pops = {"all": FX.fx_population_total(spark, SF)}
    plan = planner.batches(rows)
    assert sorted(b.ind_ids for b in plan) == [[1, 2, 3], [4]]
    got = planner.run_catalogue(rows, sources, area, "datazone", LEVELS, pops)
    want = None
    for e in rows:
        one = run_indicator(sources[e.dataset], e.to_spec(), area, "datazone", LEVELS, population=pops.get(e.pop))
        want = one if want is None else want.unionByName(one)
    shown = lambda df: sorted(map(repr, df.select(*[F.round(c, 6) if t == "double" else F.col(c) for c, t in df.dtypes]).collect()))
    assert got.columns == INDICATOR_COLUMNS and shown(got) == shown(want)
    for bad, message in ((dataclasses.replace(row, geography=None), "geography"), (dataclasses.replace(row, stage="deprivation"), "not an indicator")):
        with pytest.raises(ValueError, match=message):
            planner.batches([bad])
    with pytest.raises(ValueError, match="no dataset"):
        planner.run_catalogue(rows, {}, area, "datazone", LEVELS, pops)
