"""CSV landing: header normalisation and tolerant typing."""

from arealens.session import scratch_path
from arealens.sources.tables import read_csv


def test_csv_headers_and_bad_values(spark):
    path = scratch_path(spark, "csv-test")
    df = spark.createDataFrame([("1", "a", "2,5"), ("x", "b", "3")], "`Area Code` string, `Name-Of Area` string, `N` string")
    df.write.option("header", True).csv(path)
    out = read_csv(spark, path, types={"area_code": "int", "n": "int"})
    assert out.columns == ["area_code", "name_of_area", "n"]
    got = sorted((r["name_of_area"], r["area_code"], r["n"]) for r in out.collect())
    assert got == [("a", 1, None), ("b", None, 3)]   # unparsable values become NULL, the job does not fail
