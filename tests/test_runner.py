"""A keyed batch of indicators equals separate runs."""

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from arealens.plans.indicator import run_indicator
from arealens.plans.q_indicator import FLAGSHIP, LEVELS
from arealens.plans.runner import Job, run_jobs
from arealens.sources import fixtures as FX
from arealens.sources.tables import read_table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
PRIORITIES = {99011: "1-URGENT", 99012: "2-HIGH", 99013: "5-LOW"}


def _prepared(spark, ind_id=None):
    o = read_table(spark, SF, "orders", ["o_custkey", "o_orderdate", "o_orderpriority"])
    keys = [F.year("o_orderdate").cast("int").alias("year"), F.col("o_custkey").alias("datazone")]
    if ind_id is None:
        ids = F.create_map(*[x for k, v in PRIORITIES.items() for x in (F.lit(v), F.lit(k))])
        o = o.withColumn("ind_id", ids[F.col("o_orderpriority")])
        x = o.select("*", F.explode(F.array(*[F.lit(k) for k in PRIORITIES])).alias("target"))
        return (x.groupBy(*keys, F.col("target").alias("ind_id"))
                .agg(F.sum((F.col("ind_id") == F.col("target")).cast("double")).alias("numerator"),
                     F.count(F.lit(1)).cast("double").alias("denominator")))
    return (o.groupBy(*keys).agg(F.sum((F.col("o_orderpriority") == PRIORITIES[ind_id]).cast("double"))
                                 .alias("numerator"), F.count(F.lit(1)).cast("double").alias("denominator")))


def test_keyed_batch_equals_separate_runs(spark):
    area = FX.fx_area(spark, SF)
    batch = run_jobs([Job(FLAGSHIP, _prepared(spark), area, "datazone", LEVELS, keyed=True)])
    sep = None
    for k in PRIORITIES:
        one = run_indicator(_prepared(spark, k), dataclasses.replace(FLAGSHIP, ind_id=k), area, "datazone", LEVELS)
        sep = one if sep is None else sep.unionByName(one)
    key = lambda r: (r["ind_id"], r["code"], r["year"])
    a, b = sorted(batch.collect(), key=key), sorted(sep.collect(), key=key)
    assert len(a) == len(b) > 0
    assert {r["ind_id"] for r in a} == set(PRIORITIES)
    for x, y in zip(a, b):
        assert key(x) == key(y) and x["rate"] == pytest.approx(y["rate"]) and x["upci"] == pytest.approx(y["upci"])
