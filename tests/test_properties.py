"""Invariants on random frames (SURVEY §5 (3))."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arealens.operators import geography as G
from arealens.operators import rates as R
from arealens.operators import sequence

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))

prepared_rows = st.lists(
    st.tuples(st.integers(1, 30), st.integers(2000, 2003), st.integers(0, 50), st.integers(50, 100)),
    min_size=5, max_size=40)


def _area(spark):
    return spark.createDataFrame([(dz, f"S12{dz % 4:06d}", f"S08{dz % 2:06d}", "S00000001") for dz in range(1, 31)],
                                 "datazone int, ca string, hb string, scotland string")


@SETTINGS
@given(prepared_rows)
def test_councils_and_boards_sum_to_scotland(spark, rows):
    df = spark.createDataFrame([(dz, y, float(n), float(d)) for dz, y, n, d in rows],
                               "datazone int, year int, numerator double, denominator double")
    r = G.geo_rollup(df, _area(spark), "datazone", ["ca", "hb", "scotland"], keys=["year"])
    sums = (r.groupBy("year").agg(
        F.sum(F.when(F.col("code").startswith("S12"), F.col("numerator"))).alias("ca"),
        F.sum(F.when(F.col("code").startswith("S08"), F.col("numerator"))).alias("hb"),
        F.sum(F.when(F.col("code") == "S00000001", F.col("numerator"))).alias("sc")).collect())
    for s in sums:
        assert s["ca"] == s["hb"] == s["sc"]


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 500), st.integers(0, 500)), min_size=1, max_size=20))
def test_rates_inside_intervals(spark, pairs):
    data = [(float(n), float(n + extra)) for n, extra in pairs]
    df = spark.createDataFrame(data, "numerator double, denominator double")
    for out in (R.rate_percent(df, round_ci=None), R.rate_crude(df, 1000)):
        for r in out.collect():
            assert r["lowci"] <= r["rate"] + 1e-9 and r["rate"] <= r["upci"] + 1e-9


@SETTINGS
@given(prepared_rows, st.randoms())
def test_row_order_does_not_matter(spark, rows, rnd: random.Random):
    schema = "datazone int, year int, numerator double, denominator double"
    data = [(dz, y, float(n), float(d)) for dz, y, n, d in rows]
    shuffled = list(data)
    rnd.shuffle(shuffled)
    a = G.geo_rollup(spark.createDataFrame(data, schema), _area(spark), "datazone", ["ca", "hb"], keys=["year"])
    b = G.geo_rollup(spark.createDataFrame(shuffled, schema).repartition(3), _area(spark), "datazone",
                     ["ca", "hb"], keys=["year"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_hot_key_spans_several_range_partitions(spark):
    rows = [("hot", i, 1.0) for i in range(3000)] + [(f"k{i}", i, 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    r = sequence._ranged(df, ["k"], ["t"], 8)
    per = {row["pid"]: row["n"] for row in
           r.where("k = 'hot'").groupBy(F.col(sequence.PID).alias("pid")).agg(F.count("*").alias("n")).collect()}
    assert len(per) >= 4 and max(per.values()) < 3000


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 2), st.integers(1, 19), st.integers(1, 300), st.integers(0, 3000)),
                min_size=1, max_size=30, unique_by=lambda t: (t[0], t[1])))
def test_easr_inside_interval(spark, strata):
    from arealens.sources.refdata import EPOP_WEIGHTS

    data = [(2000, "A", s, a, float(n), float(n + extra), float(EPOP_WEIGHTS["normal"][a]))
            for s, a, n, extra in strata]
    df = spark.createDataFrame(data, "year int, code string, sex_grp int, age_grp int, numerator double, "
                                     "denominator double, epop double")
    (r,) = R.rate_easr(df, 200000).collect()
    assert r["lowci"] <= r["rate"] + 1e-9 <= r["upci"] + 2e-9
