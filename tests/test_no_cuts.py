"""Nothing is shortened, cached past its change or zero-filled for the wrong indicator."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from arealens.functions.dates import clean_fin_year, year_end_to_start
from arealens.functions.text import pad_number
from arealens.operators.cleaning import sentinel_to_null
from arealens.plans.runner import Job, run_jobs
from arealens.plans.spec import IndicatorSpec
from arealens.sources.fixtures import area_code
from arealens.sources.tables import read_table


def _one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).collect()[0]["y"]


def test_padding_never_shortens(spark):
    assert _one(spark, 7, "int", pad_number("x")) == "007"
    assert _one(spark, 1234, "int", pad_number("x")) == "1234"
    assert _one(spark, 1234567, "bigint", area_code("S12", "x")) == "S121234567"


def test_appended_files_are_read(spark, tmp_path):
    path = str(tmp_path / "region.parquet")
    spark.range(5).write.parquet(path)
    assert read_table(spark, str(tmp_path), "region").count() == 5
    spark.range(7).write.mode("append").parquet(path)
    assert read_table(spark, str(tmp_path), "region").count() == 12


@pytest.mark.parametrize("text,year", [("304", 2003), ("1011", 2010), ("2015/16", 2015), ("2015-16", 2015), ("2015", 2015),
                                       ("9900", 9900), ("soon", None), ("", None)])
def test_financial_year_forms(spark, text, year):
    got = _one(spark, text, "string", clean_fin_year("x"))
    assert got == (2099 if text == "9900" else year)


def test_year_end_names_the_year_before(spark):
    assert _one(spark, 2016, "int", year_end_to_start("x")) == 2015


def test_sentinels_become_null(spark):
    df = spark.createDataFrame([("a",), ("*",)], "x string")
    assert [r["x"] for r in sentinel_to_null(df, "x", ["*"]).collect()] == ["a", None]


def _batch(spark, measure):
    area = spark.createDataFrame([("d1", "c1"), ("d2", "c2")], "datazone string, ca string")
    rows = [(1, 2000, "d1", 5.0, 10.0), (1, 2001, "d1", 6.0, 11.0), (1, 2002, "d1", 7.0, 12.0), (1, 2003, "d1", 2.0, 9.0),
            (2, 2000, "d1", 3.0, 8.0), (2, 2003, "d1", 1.0, 5.0)]
    prep = spark.createDataFrame(rows, "ind_id int, year int, datazone string, numerator double, denominator double")
    pop = spark.createDataFrame([(y, c, 100.0) for y in range(2000, 2004) for c in ("c1", "c2")],
                                "year int, code string, denominator double")
    spec = IndicatorSpec(ind_id=1, measure=measure, time_agg=3, yearstart=2000, yearend=2003, year_type="calendar",
                         crude_rate=1000 if measure == "crude" else None)
    return area, prep, pop, spec


@pytest.mark.parametrize("measure", ["crude", "perc_pcf"])
def test_keyed_batch_with_population_equals_separate_runs(spark, measure):
    area, prep, pop, spec = _batch(spark, measure)
    ref = pop if measure == "perc_pcf" else None
    population = pop if measure == "crude" else None
    if measure == "crude":
        prep = prep.drop("denominator")
    batch = run_jobs([Job(spec, prep, area, "datazone", ["ca"], population=population, ref_pop=ref, keyed=True,
                          ind_ids=[1, 2])])
    single = run_jobs([Job(dataclasses.replace(spec, ind_id=k), prep.where(F.col("ind_id") == k).drop("ind_id"), area,
                           "datazone", ["ca"], population=population, ref_pop=ref) for k in (1, 2)])
    a, b = (sorted(map(tuple, x.collect()), key=str) for x in (batch, single))
    assert a == b and len(a) > 0
    if measure == "crude":
        assert {r[1] for r in a} == {1, 2} and any(r[0] == "c2" for r in a)
