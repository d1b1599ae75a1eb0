"""The left join to a lookup versioned by year: which rows meet, and that neither side is sent whole to a task."""

from collections import Counter

from arealens.operators.deprivation import join_simd_year


def test_join_simd_year_keeps_every_fact_and_merges(spark, tmp_path):
    facts = [(1, 2000, 5.0), (1, 2000, 6.0), (1, 2001, 7.0), (2, 2000, 8.0), (None, 2000, 9.0), (2, None, 10.0), (9, 2000, 11.0)]
    lookup = [(1, 2000, 1), (1, 2001, 2), (2, 2000, 3), (2, 2000, 4), (None, 2000, 5), (2, None, 6), (3, 2000, 7)]
    spark.createDataFrame(lookup, "datazone long, year int, sc_quin int").write.parquet(str(tmp_path / "lookup"))
    out = join_simd_year(spark.createDataFrame(facts, "datazone long, year int, numerator double"),
                         spark.read.parquet(str(tmp_path / "lookup")))
    assert out.columns == ["datazone", "year", "numerator", "sc_quin"]
    want = []
    for z, y, n in facts:
        found = [q for a, b, q in lookup if None not in (z, y) and (a, b) == (z, y)]
        want += [(z, y, n, q) for q in found or [None]]
    assert Counter(tuple(r) for r in out.collect()) == Counter(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
