"""Incremental refresh equals a full rerun."""

import os
import uuid

import pytest

from arealens.plans.indicator import INDICATOR_COLUMNS, run_indicator
from arealens.plans.q_indicator import FLAGSHIP, LEVELS
from arealens.session import ensure_checkpoint_dir
from arealens.sources import fixtures as FX
from arealens.streaming.refresh import start_refresh

SF = "/root/testdata/sf0.001"
SCHEMA = "year int, datazone bigint, sex_grp int, age_grp int, numerator double, denominator double"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_incremental_refresh_matches_full_run(spark):
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/stream-test-{uuid.uuid4().hex[:8]}"
    src, sink, ckpt = f"{base}/prepared", f"{base}/sink", f"{base}/ckpt"
    prepared = FX.fx_prepared(spark, SF).select("year", "datazone", "sex_grp", "age_grp", "numerator",
                                                "denominator")
    area = FX.fx_area(spark, SF)
    # first delivery: years up to 1998; second delivery: the rest
    prepared.where("year <= 1998").write.mode("append").parquet(src)
    q = start_refresh(spark, src, SCHEMA, FLAGSHIP, area, "datazone", LEVELS, sink, ckpt)
    q.awaitTermination(300)
    prepared.where("year > 1998").write.mode("append").parquet(src)
    q = start_refresh(spark, src, SCHEMA, FLAGSHIP, area, "datazone", LEVELS, sink, ckpt)
    q.awaitTermination(300)

    got = spark.read.parquet(sink).select(*INDICATOR_COLUMNS)
    full = run_indicator(spark.read.schema(SCHEMA).parquet(src), FLAGSHIP, area, "datazone", LEVELS)

    def key(r):
        return (r["code"], r["year"])

    a = sorted(got.collect(), key=key)
    b = sorted(full.collect(), key=key)
    assert len(a) == len(b) > 0
    for x, y in zip(a, b):
        assert key(x) == key(y)
        for c in ("numerator", "rate", "lowci", "upci"):
            assert x[c] == pytest.approx(y[c])
        assert (x["def_period"], x["trend_axis"]) == (y["def_period"], y["trend_axis"])


def test_refresh_with_an_inequality_build(spark):
    from arealens.plans.deprivation import run_deprivation
    from arealens.plans.q_depr import DEPR_PCT

    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/stream-depr-{uuid.uuid4().hex[:8]}"
    src, sink, ckpt = f"{base}/prepared", f"{base}/sink", f"{base}/ckpt"
    prepared = FX.fx_prepared(spark, SF).select("year", "datazone", "sex_grp", "age_grp", "numerator",
                                                "denominator")
    lookup = FX.fx_depr_lookup(spark, SF, FX.fx_simd(spark, SF))
    build = lambda p: run_deprivation(p, DEPR_PCT, lookup)
    prepared.where("year <= 1997").write.mode("append").parquet(src)
    start_refresh(spark, src, SCHEMA, DEPR_PCT, None, None, [], sink, ckpt, build=build).awaitTermination(300)
    prepared.where("year > 1997").write.mode("append").parquet(src)
    start_refresh(spark, src, SCHEMA, DEPR_PCT, None, None, [], sink, ckpt, build=build).awaitTermination(300)

    cols = ["code", "year", "quintile", "quint_type", "rate", "sii", "par"]
    got = sorted(tuple(r) for r in spark.read.parquet(sink).select(*cols).collect())
    full = sorted(tuple(r) for r in build(spark.read.schema(SCHEMA).parquet(src)).select(*cols).collect())
    assert len(got) == len(full) > 0
    for a, b in zip(got, full):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], nan_ok=True) if None not in a[4:] + b[4:] else a[4:] == b[4:]
