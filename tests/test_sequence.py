"""Skew-safe ordered operators against plain windows, including a hot key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from arealens.operators import sequence


def _data(spark):
    # key 'hot' holds most rows; several partitions must share it
    rows = [("hot", i, float(i % 7)) for i in range(400)] + [("k%d" % (i % 5), i, 1.0) for i in range(60)]
    rows.append((None, 3, 2.0))
    return spark.createDataFrame(rows, "k string, t int, v double")


def test_running_sums_equal_window(spark):
    df = _data(spark)
    got = sequence.running_sums(df, ["k"], ["t"], {"cum": F.col("v")}, frame="rows", totals=True,
                                num_partitions=6)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("k", "t", F.sum("v").over(w).alias("cum"), F.sum("v").over(Window.partitionBy("k")).alias("tot"))
    a = sorted((r["k"] or "", r["t"], r["cum"], r["cum_total"]) for r in got.collect())
    b = sorted((r["k"] or "", r["t"], r["cum"], r["tot"]) for r in exp.collect())
    assert a == b


def test_running_sums_range_frame_keeps_peers(spark):
    df = spark.createDataFrame([(i // 3, 1.0) for i in range(90)], "t int, v double")
    got = sequence.running_sums(df, [], ["t"], {"cum": F.col("v")}, num_partitions=7)
    assert {(r["t"], r["cum"]) for r in got.collect()} == {(t, 3.0 * (t + 1)) for t in range(30)}


def test_previous_values_equal_lag(spark):
    df = _data(spark)
    got = sequence.previous_values(df, ["k"], ["t"], ["v", "t"], num_partitions=6)
    w = Window.partitionBy("k").orderBy("t")
    exp = df.select("k", "t", F.lag("v").over(w).alias("pv"), F.lag("t").over(w).alias("pt"))
    a = sorted((r["k"] or "", r["t"], r["prev_v"], r["prev_t"]) for r in got.collect())
    b = sorted((r["k"] or "", r["t"], r["pv"], r["pt"]) for r in exp.collect())
    assert a == b


def test_global_rank(spark):
    df = spark.createDataFrame([(float(i * 37 % 101), i) for i in range(101)], "s double, i int")
    got = sequence.global_rank(df, ["s", "i"], num_partitions=5)
    ranks = sorted((r["s"], r["rank"]) for r in got.collect())
    assert [r for _, r in ranks] == list(range(1, 102))


def test_hot_key_spans_several_partitions(spark):
    r = sequence._ranged(_data(spark), ["k"], ["t"], 6)
    assert r.where("k = 'hot'").select(sequence.PID).distinct().count() > 1


def test_default_partitions_equal_window(spark):
    df = _data(spark)
    got = sequence.previous_values(df, ["k"], ["t"], ["v"])
    exp = df.withColumn("prev_v", F.lag("v").over(Window.partitionBy("k").orderBy("t")))
    assert sorted((x["k"] or "", x["t"], x["prev_v"]) for x in got.collect()) == \
        sorted((x["k"] or "", x["t"], x["prev_v"]) for x in exp.collect())
