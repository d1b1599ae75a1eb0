"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from arealens.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, round(v, 5))
    return (4, str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    exp = [tuple(r[i] for i in idx) for r in res.fetchall()]
    a = sorted(tuple(_norm(v) for v in r) for r in got)
    b = sorted(tuple(_norm(v) for v in r) for r in exp)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for p, q in zip(x, y):
            if p[0] == 2 and q[0] == 2:
                assert p[1] == pytest.approx(q[1], rel=1e-5, abs=1e-5)
            else:
                assert p == q


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["code", "ind_id", "year", "numerator", "rate", "lowci", "upci", "def_period", "trend_axis"]
    assert df.count() > 0
